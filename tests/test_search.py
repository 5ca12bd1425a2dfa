"""Exact, tiled and approximate search against brute force; retrieval; embedding; index sync."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docengine.operators import embedding, retrieval
from docengine.operators import similarity as sim
from conftest import plan_of, rows

RNG = np.random.default_rng(3)


def brute(index, queries, k, metric="cosine"):
    out = set()
    for q, qv in queries:
        scored = []
        for i, v in index:
            a, b = np.array(v, float), np.array(qv, float)
            if metric == "cosine":
                n = np.linalg.norm(a) * np.linalg.norm(b)
                s = a @ b / n if n else 0.0
            else:
                s = a @ b
            scored.append((-round(s + 0.0, 6), i))
        out |= {(q, i, -s + 0.0) for s, i in sorted(scored)[:k]}
    return out


@pytest.fixture(scope="module")
def data():
    base = [(f"c{i:03d}", [float(np.float32(x)) for x in RNG.standard_normal(8)]) for i in range(200)]
    copies = [(f"d{i:03d}", base[0][1]) for i in range(100)]  # a third of the index is one vector
    index = base + copies + [("z", [0.0] * 8)]
    queries = [(i, v) for i, (_, v) in enumerate(base[:7])]
    return index, queries


def frames(spark, data):
    index, queries = data
    df = spark.createDataFrame(index, "chunk_id STRING, embedding ARRAY<FLOAT>").repartition(5)
    return df, spark.createDataFrame(queries, "query_id INT, query_vec ARRAY<FLOAT>")


def hits(df):
    return {(r.query_id, r.chunk_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("limit", [sim.MAX_QUERY_BYTES, 100])
@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_exact_search_is_brute_force(spark, data, limit, metric):
    index, queries = frames(spark, data)
    got = sim.similarity_topk(index, queries, 10, "chunk_id", "embedding", metric=metric, max_query_bytes=limit)
    assert hits(got) == brute(*data, 10, metric)
    # Copies tie on the score and come in order of their ids.
    first = [r.chunk_id for r in got.filter("query_id = 0").orderBy("rank").collect()]
    if metric == "cosine":
        assert first == ["c000"] + [f"d{i:03d}" for i in range(9)]


def test_query_sets_larger_than_a_slice(spark, data):
    index, queries = frames(spark, data)
    assert len(list(sim.query_slices(queries, "query_id", "query_vec", 130))) > 1
    got = sim.similarity_topk(index, queries, 4, "chunk_id", "embedding", max_query_bytes=130)
    assert hits(got) == brute(*data, 4)


def test_task_of_small_batches_emits_k_rows_per_query(spark, data):
    index, queries = frames(spark, data)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        part = next(sim.query_slices(queries, "query_id", "query_vec"))
        schema = sim._hit_schema(index, queries, "chunk_id", "query_id")
        found = sim._search(index.coalesce(1), part, 5, "chunk_id", "embedding", schema, True)
        assert found.count() == 5 * len(data[1])
        assert hits(sim._top(found, "query_id", "chunk_id", 5)) == brute(*data, 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_vectors_of_other_lengths_are_left_out(spark):
    rows_ = [("a", [1.0, 0.0]), ("b", [1.0, 0.0, 5.0]), ("c", [0.0, 1.0]), ("d", [3.0])]
    index = spark.createDataFrame(rows_, "chunk_id STRING, embedding ARRAY<FLOAT>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id INT, query_vec ARRAY<FLOAT>")
    got = sim.similarity_topk(index, queries, 5, "chunk_id", "embedding")
    assert hits(got) == {(1, "a", 1.0), (1, "c", 0.0)}
    assert {r.chunk_id for r in sim.left_out(index, "embedding", 2).collect()} == {"b", "d"}
    mixed = queries.union(spark.createDataFrame([(2, [1.0])], queries.schema))
    with pytest.raises(ValueError, match="numbers"):
        sim.similarity_topk(index, mixed, 5, "chunk_id", "embedding")


def test_display_rows_are_not_shuffled(spark, data):
    index, queries = frames(spark, data)
    display = index.select("chunk_id", F.lit("text").alias("chunk_text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = sim.similarity_topk(index, queries, 3, "chunk_id", "embedding", cols=["chunk_text"], display=display)
        assert "BroadcastHashJoin LeftSemi" in plan_of(got) or "LeftSemi, BuildRight" in plan_of(got)
        assert {r.chunk_text for r in got.collect()} == {"text"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unusable_vectors_are_left_out(spark):
    index = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [1.0, None])], "chunk_id STRING, embedding ARRAY<FLOAT>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id INT, query_vec ARRAY<FLOAT>")
    assert [r.chunk_id for r in sim.similarity_topk(index, queries, 5, "chunk_id", "embedding").collect()] == ["a"]
    nothing = sim.similarity_topk(index, queries.limit(0), 5, "chunk_id", "embedding")
    assert nothing.count() == 0


def test_approximate_search(spark, data):
    index, queries = frames(spark, data)
    planes = sim.hyperplanes(8, 5)
    celled = sim.with_cells(index, "chunk_id", "embedding", planes)
    exact = sim.similarity_topk(index, queries, 10, "chunk_id", "embedding")
    wide = sim.similarity_approx(celled, queries, 10, planes, "chunk_id", "embedding", radius=5)
    assert hits(wide) == hits(exact)
    near = sim.similarity_approx(celled, queries, 10, planes, "chunk_id", "embedding", radius=1)
    assert near.groupBy("query_id").count().filter("count = 10").count() == len(data[1])
    found = sim.recall(near, exact, "query_id", "chunk_id").first().recall
    assert 0.3 < found <= 1.0
    # Scores of the hits are exact.
    every = {(q, i): s for q, i, s in brute(*data, len(data[0]))}
    assert all(every[(q, i)] == s for q, i, s in hits(near))
    # The size of the query set changes nothing.
    assert hits(sim.similarity_approx(celled, queries, 10, planes, "chunk_id", "embedding", max_query_bytes=1)) == hits(near)


def test_short_cells_are_widened(spark):
    index = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [-1.0, -1.0])], "chunk_id STRING, embedding ARRAY<FLOAT>")
    queries = spark.createDataFrame([(1, [1.0, 1.0])], "query_id INT, query_vec ARRAY<FLOAT>")
    planes = np.eye(2)
    celled = sim.with_cells(index, "chunk_id", "embedding", planes)
    got = sim.similarity_approx(celled, queries, 2, planes, "chunk_id", "embedding", radius=0)
    assert [r.chunk_id for r in got.orderBy("rank").collect()] == ["a", "b"]


def test_stored_cells_prune_partitions(spark, data, tmp_path):
    index, queries = frames(spark, data)
    planes = sim.hyperplanes(8, 5)
    path = str(tmp_path / "index")
    sim.with_cells(index, "chunk_id", "embedding", planes).write.partitionBy("cell").parquet(path)
    stored = spark.read.parquet(path)
    got = sim.similarity_approx(stored, queries.limit(1), 3, planes, "chunk_id", "embedding", radius=0)
    assert "PartitionFilters: [cell" in plan_of(got).replace("isnotnull(", "").replace("cell#", "cell#")
    assert got.count() == 3


DIM = [(1, "Alpha", "alphine", "M", True, "2024-01-01"), (2, "Beta 100%", "alphine", "N", False, None),
       (3, "Gamma", "gammine", "M", True, "2024-02-01")]
FACT = [(1, "Severe rash"), (1, "nausea"), (3, "RASH"), (3, "RASH")]


@pytest.fixture
def star(spark):
    dim = spark.createDataFrame(
        DIM, "drug_sk BIGINT, drug_name STRING, generic_name STRING, manufacturer STRING, "
             "is_current_version BOOLEAN, effective_date STRING")
    return dim, spark.createDataFrame(FACT, "drug_sk BIGINT, adverse_event STRING")


def test_look_ups(spark, star):
    dim, fact = star
    cols = ("drug_name",)
    assert [tuple(r) for r in retrieval.entity_summary(dim, fact, "ALPH", cols=cols).collect()] == [
        ("Alpha", 2), ("Beta 100%", 0)]
    assert [tuple(r) for r in retrieval.entity_summary(dim, fact, "%", cols=cols).collect()] == [("Beta 100%", 0)]
    assert retrieval.entity_summary(dim, fact, "' OR 1=1 --", cols=cols).count() == 0
    assert [(r.drug_name, r.adverse_event) for r in retrieval.find_by_event(dim, fact, "rash").collect()] == [
        ("Alpha", "Severe rash"), ("Gamma", "RASH")]
    asked = spark.createDataFrame([(1, "alph"), (2, "gam"), (3, "none")], "question_id INT, question STRING")
    names = retrieval.answer_names(asked, dim, fact, ["drug_name", "generic_name"], ["drug_name"])
    assert rows(names) == [(1, 1, "Alpha", 2), (1, 2, "Beta 100%", 0), (2, 1, "Gamma", 2)]
    events = retrieval.answer_events(
        spark.createDataFrame([(1, "rash")], "question_id INT, question STRING"), dim, fact, ["drug_name"])
    assert rows(events) == [(1, "Alpha", "Severe rash", 1), (1, "Gamma", "RASH", 2)]


def test_many_questions_meet_by_equality(spark, star):
    dim, fact = star
    asked = spark.createDataFrame(
        [(1, "ALPHA"), (2, "a"), (3, ""), (4, None), (5, "00%"), (6, "zz"), (7, "mm")], "question_id INT, question STRING")
    names = ["drug_name", "generic_name"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = retrieval.answer_names(asked, dim, fact, names, ["drug_name"])
        events = retrieval.answer_events(asked, dim, fact, ["drug_name"])
        for df in (got, events):
            assert "CartesianProduct" not in plan_of(df) and "NestedLoop" not in plan_of(df)
        found = {}
        for r in got.collect():
            found.setdefault(r.question_id, set()).add(r.drug_name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    every = {"Alpha", "Beta 100%", "Gamma"}
    assert found == {1: {"Alpha"}, 2: every, 3: every, 5: {"Beta 100%"}, 7: {"Gamma"}}


def test_passages_and_citations(spark):
    index = spark.createDataFrame(
        [("c1", "s1", "Alpha", "Doses", "x" * 1300, [1.0, 0.0]), ("c2", "s2", "Beta", "Risks", "y", [0.0, 1.0]),
         ("c3", "s1", "Alpha", "Doses", "z", [0.9, 0.1])],
        "chunk_id STRING, set_id STRING, drug_name STRING, section_title STRING, chunk_text STRING, embedding ARRAY<FLOAT>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id INT, query_vec ARRAY<FLOAT>")
    found = retrieval.search_passages(index, queries, 2)
    best = found.orderBy("rank").first()
    assert best.chunk_id == "c1" and best.chunk_text == "x" * 1200 + " …"
    assert rows(retrieval.citations(found)) == [(1, "Alpha — Doses")]
    within = retrieval.search_within(index, spark.createDataFrame([("s2",)], "set_id STRING"), queries, k=2)
    assert [r.chunk_id for r in within.collect()] == ["c2"]


TEXTS = [("a", "renal dosing in elderly patients"), ("b", "cardiac events were common"), ("c", None),
         ("d", "store below thirty degrees"), ("e", "renal failure and renal dosing")]


def test_text_encoder_matches_its_formula(spark):
    df = spark.createDataFrame(TEXTS, "chunk_id STRING, chunk_text STRING")
    model = embedding.fit_encoder(df, "chunk_text", dim=4096)
    got = {r.chunk_id: np.array(r.embedding) for r in embedding.embed(df, "chunk_text", model).collect()}
    words = {k: t.split() for k, t in TEXTS if t}
    vocabulary = sorted({w for ws in words.values() for w in ws})
    idf = {w: np.log((len(words) + 1) / (sum(w in ws for ws in words.values()) + 1)) for w in vocabulary}

    def vector(ws):
        v = np.array([ws.count(w) * idf[w] for w in vocabulary])
        return v / np.linalg.norm(v)

    for a in words:
        for b in words:
            assert got[a] @ got[b] == pytest.approx(vector(words[a]) @ vector(words[b]), abs=1e-5)
    asked = spark.createDataFrame([(1, "dosing for renal patients")], "query_id INT, chunk_text STRING")
    queries = embedding.embed(asked, "chunk_text", model, "query_vec")
    index = embedding.build_index(df, lambda d: embedding.embed(d, "chunk_text", model), cols=["chunk_text"])
    top = retrieval.search_passages(index, queries.select("query_id", "query_vec"), 1, cols=["chunk_text"])
    assert top.first().chunk_id in ("a", "e")


def test_sync_encodes_changed_rows_only(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "chunk_id STRING, chunk_text STRING")
    new = spark.createDataFrame([("a", "x"), ("b", "yy"), ("d", "w")], "chunk_id STRING, chunk_text STRING")

    def encoder(tag):
        return lambda d: d.withColumn("embedding", F.array(F.length("chunk_text").cast("double"), F.lit(tag)))

    index = embedding.build_index(old, encoder(0.0), cols=["chunk_text"])
    synced = embedding.sync_index(index, old, new, encoder(1.0), cols=["chunk_text"])
    assert rows(synced) == [("a", [1.0, 0.0], "x"), ("b", [2.0, 1.0], "yy"), ("d", [1.0, 1.0], "w")]
