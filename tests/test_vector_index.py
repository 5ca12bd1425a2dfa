"""The stored index: codes and their bounds, and searches against every score."""

import numpy as np
import pytest

from docengine.operators import similarity as sim
from docengine.operators import vector_index as vi
from docengine.runtime import scratch_path

SCHEMA = "vec_id long, embedding array<float>"


def near_groups(seed=3, groups=8, size=60, dim=17):
    """Groups around far centres, one vector that a third of the rows share, a zero one, and some that cannot be scored."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim)) * 3
    m = np.concatenate([c + 0.3 * rng.standard_normal((size, dim)) for c in centres])
    m = np.concatenate([m, np.tile(m[:1], (size * groups // 2, 1)), np.zeros((1, dim))])
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(m)]
    return rows + [(9_000, None), (9_001, []), (9_002, [None] * dim)]


@pytest.fixture(scope="module")
def grouped(spark):
    return spark.createDataFrame(near_groups(), SCHEMA).persist()


@pytest.fixture(scope="module")
def index(spark, grouped):
    path = scratch_path(spark, "test-index")
    vi.build_index(spark, grouped, path, "vec_id", "embedding", lists=12, recall=0.95, k=3)
    return vi.open_index(spark, path)


def queries_of(grouped):
    return grouped.filter("vec_id % 37 = 0 and vec_id < 9000").selectExpr("vec_id AS query_id", "embedding AS query_vec")


def rows(df):
    return sorted(tuple(r) for r in df.select("query_id", "id", "score", "rank").collect())


def exact(grouped, k=4):
    return sim.similarity_topk(grouped, queries_of(grouped), k, "vec_id", "embedding").withColumnRenamed("vec_id", "id")


def test_codes_are_within_what_they_say():
    rng = np.random.default_rng(1)
    left = np.concatenate([rng.standard_normal((200, 9)) * rng.random((200, 1)), np.zeros((1, 9))])
    codes, step, off = vi.encoded(left)
    near = vi.decoded(vi._unpacked(codes, 9), step)
    assert (np.linalg.norm(left - near, axis=1) <= off).all() and off[-1] < 1e-6
    assert np.median(off[:-1] / np.linalg.norm(left[:-1], axis=1)) < 0.15


def test_every_score_is_within_the_bounds_of_its_list(index):
    table = index.table.select("list", "vector").collect()
    unit = sim._unit(np.array([r["vector"] for r in table], np.float64))
    query = sim._unit(np.random.default_rng(2).standard_normal((20, index.dim)))
    low, high = vi._reach(query, index.centroids, index.radii)
    own = [r["list"] for r in table]
    assert (query @ unit.T <= high[:, own]).all() and (query @ unit.T >= low[:, own]).all()


def test_search_is_exact_and_skips_lists(index, grouped):
    cost = vi.Cost(int(index.counts.sum()), index.dim)
    assert rows(vi.search(index, queries_of(grouped), 4, cost=cost)) == rows(exact(grouped))
    assert cost.codes < 0.7 * cost.queries * cost.rows


def test_search_in_slices_is_the_same(index, grouped):
    assert rows(vi.search(index, queries_of(grouped), 4, max_query_bytes=600)) == rows(exact(grouped))


def test_join_is_exact(index, grouped):
    assert rows(vi.search_join(index, queries_of(grouped), 4)) == rows(exact(grouped))


def test_probes_reach_the_recall(index, grouped):
    assert 1 <= index.probes < 12
    found = vi.search(index, queries_of(grouped), 3, probes=index.probes)
    assert sim.recall(found, exact(grouped, 3), "query_id", "id").first()["recall"] >= 0.9


def test_more_rows_are_asked_for_than_there_are(spark):
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], SCHEMA)
    index = vi.build_index(spark, few, scratch_path(spark, "test-index"), "vec_id", "embedding", lists=2)
    asked = few.selectExpr("vec_id AS query_id", "embedding AS query_vec")
    wanted = rows(sim.similarity_topk(few, asked, 9, "vec_id", "embedding").withColumnRenamed("vec_id", "id"))
    assert len(wanted) == 9 and rows(vi.search(index, asked, 9)) == wanted == rows(vi.search_join(index, asked, 9))


def test_no_vectors_and_mixed_lengths_are_refused(spark):
    with pytest.raises(ValueError, match="no vectors"):
        vi.build_index(spark, spark.createDataFrame([(1, None)], SCHEMA), "unused", "vec_id", "embedding")
    with pytest.raises(ValueError, match="numbers"):
        vi.build_index(spark, spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA), "unused", "vec_id", "embedding")
