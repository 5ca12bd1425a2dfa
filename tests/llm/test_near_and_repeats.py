import hashlib
import os
import random
import re
import sys
import tracemalloc

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import BASE, awkward, clashing, component_ids, documents, hits, sha, shingles, without_repeats  # noqa: E402

from docengine.llm import decontamination, fingerprints, near_duplicates, queries, repeats  # noqa: E402
from docengine.llm.common import Scratch  # noqa: E402


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def chains(count=60):
    """Texts where neighbours are alike and far ones are not, so that components need paths."""
    draw = random.Random(2)
    words = [f"w{draw.randrange(10 ** 6)}" for _ in range(120)]
    out = []
    for i in range(count):
        words = list(words)
        if i % 10 == 0:
            words = [f"w{draw.randrange(10 ** 6)}" for _ in range(120)]
        else:
            words[draw.randrange(120)] = f"x{i}"
        out.append((1000 - i, " ".join(words)))
    return out


@pytest.mark.parametrize("share", [80, 85])
def test_near_duplicates(spark, share):
    rows = awkward() + chains()
    docs = clashing(documents(spark, rows), "text_key", "set_key", "signature", "node", "row")
    got = near_duplicates.near_duplicates(docs, (share, 100)).collect()
    wanted = component_ids(rows, share)
    for k, (i, t) in enumerate(rows):
        if not shingles(t):
            wanted[k] = (i, 0, i)
    assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(wanted)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_of_each_keeps_a_row_per_group(spark):
    kept = near_duplicates.one_of_each(clashing(documents(spark), "component_id", "first")).collect()
    ids = [r.doc_id for r in kept]
    assert ids.count(8) == 1 and 3 in ids and 5 not in ids and 9 not in ids
    assert ids.count(2) == 2 and 7 in ids and 11 in ids  # documents without words all stay
    assert kept[0].component_id == "clash"


def test_large_group_is_joined_without_all_pairs(spark):
    draw = random.Random(5)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(80):
        own = list(words)
        own[draw.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(own)))
    got = near_duplicates.near_duplicates(documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {0}


def test_closed_buckets_leave_before_their_pivots(spark, monkeypatch):
    draw = random.Random(5)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(80):
        own = list(words)
        own[draw.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(own)))
    docs, seen = documents(spark, rows), []
    join = type(docs).join

    def watched(self, other, on=None, how=None):
        if how == "left_anti":
            seen.append(self.count())
        return join(self, other, on, how)

    monkeypatch.setattr(type(docs), "join", watched)
    got = near_duplicates.near_duplicates(docs).collect()
    # All are linked by the first pivots, so that no row is left that a pivot has to be told from.
    assert {r.component_id for r in got} == {0} and sum(seen) == 0


def test_texts_are_packed_before_their_shuffle(spark, monkeypatch):
    plan = fingerprints.beside_next(near_duplicates.keyed(documents(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan.split("Exchange hashpartitioning(range")[1]
    rows = [(i % 2, 0, i, b"k", t) for i, t in enumerate(["", "é" * 500, "a b", "x" * 300])]
    held = fingerprints.packed(spark.createDataFrame(
        rows, "range long, head int, doc_id long, text_key binary, text string").coalesce(1)).toArrow().combine_chunks().to_batches()[0]
    monkeypatch.setattr(fingerprints, "UNPACKED", 310)
    parts = list(fingerprints.unpacked(held))
    assert [len(p) for p in parts] == [1, 1, 2] and [r for p in parts for r in p] == rows


def test_workers_stay_small(spark):
    """No task of the fingerprints needs two Python workers, no rows go through workers of another kind, few texts are held at once."""
    plan = fingerprints.beside_next(near_duplicates.keyed(documents(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "ExistingRDD[range" not in plan
    rows = [(0, 0, i, b"k", chr(97 + i % 26) * (1 << 20)) for i in range(24)]
    held = fingerprints.packed(spark.createDataFrame(
        rows, "range long, head int, doc_id long, text_key binary, text string").coalesce(1)).toArrow().combine_chunks().to_batches()[0]
    tracemalloc.start()
    assert sum(len(part) for part in fingerprints.unpacked(held)) == 24
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 << 20


def test_ranges_keep_the_order_of_rows(spark):
    """Null and repeated ids, many ranges: every row is set beside the next one, the last beside the first."""
    rows = [(None if i % 9 == 0 else i // 2, f"{i} a b c d e") for i in range(120)]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).digest()))
    got = fingerprints.fingerprinted(documents(spark, rows).repartition(5)).select("doc_id", "edited_sha256").collect()
    assert key(got) == key((i, sha(fingerprints.edited(t, after).encode())) for (i, t), (_, after) in zip(order, order[1:] + order[:1]))


def around_one(base_kept: bool) -> list[tuple[int, str]]:
    """A text and 150 copies with one to six words changed: most are too far from each other, some changes recur."""
    draw = random.Random(11)
    words = [f"w{k}" for k in range(120)]
    rows = [(500, " ".join(words))] if base_kept else []
    for i in range(150):
        own = list(words)
        for _ in range(1 + i % 6):
            own[draw.choice((10, 40, 70, 100)) if i % 3 else draw.randrange(120)] = f"x{draw.randrange(6) if i % 3 else i}"
        rows.append((i, " ".join(own[:120 - i % 5])))
    return rows


def test_rows_of_a_round_are_made_once(spark, monkeypatch):
    """The anti join with the pivots runs once a round, and no pair of candidates is made into rows for its ends."""
    write, plans = Scratch.write, {}

    def watched(self, df, name, *args):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(self, df, name, *args)

    monkeypatch.setattr(Scratch, "write", watched)
    near_duplicates.near_duplicates(documents(spark, around_one(False)), (85, 100)).collect()
    met = [plan.count("LeftAnti") for plan in plans.values()]
    assert max(met) == 1 and sum(met) == sum(name.startswith("some-") for name in plans)
    links = [plan for name, plan in plans.items() if name.startswith("links-")]
    assert links and not any("explode" in plan for plan in links)


def test_closed_buckets_stay_until_they_hold_many_rows(spark):
    def after(closed, open_):
        # Buckets below 100 hold one component, the others two.
        rows = [(b, 10 * b + k, 10 * b) for b in range(closed) for k in range(2)]
        rows += [(100 + b, 10 * b + k, 10 * b + k) for b in range(open_) for k in range(2)]
        scratch = Scratch(spark, "t")
        state = scratch.write(spark.createDataFrame(rows, "bucket long, node long, component long"), "state")
        left = near_duplicates.still_open(state, scratch, "left")
        return left and sorted({r.bucket for r in left.collect()})

    assert after(1, 4) == [0, 100, 101, 102, 103]
    assert after(2, 4) == [100, 101, 102, 103]
    assert after(3, 0) is None and after(0, 0) is None


@pytest.mark.parametrize("base_kept", [True, False])
def test_large_group_of_texts_far_from_each_other(spark, base_kept):
    rows = around_one(base_kept)
    wanted = component_ids(rows, 85)
    assert 1 < len({w[2] for w in wanted}) < len(rows)
    got = near_duplicates.near_duplicates(documents(spark, rows), (85, 100)).collect()
    assert key((r.doc_id, r.n_shingles, r.component_id) for r in got) == key(wanted)


def test_components_of_a_long_path(spark):
    draw = random.Random(6)
    nodes = list(range(40))
    draw.shuffle(nodes)
    edges = [(nodes[k], nodes[k + 1]) for k in range(39)] + [(100, 101), (7, 7)]
    found = near_duplicates.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "c").collect()
    got = {r.node: r.component for r in found}
    assert all(got.get(n, 0) == 0 for n in range(40)) and got[101] == 100


def test_repeats(spark):
    rows = awkward() + [(20, "x" * 300), (21, "y" + "x" * 120 + "z" + BASE[3:60]), (22, BASE[3:52]), (23, BASE[3:53])]
    docs = clashing(documents(spark, rows), "block", "body", "mask")
    found = repeats.without_repeats(docs).collect()
    got = [(r.doc_id, r.n_bytes, sum(s.length for s in r.spans), len(r.spans), sha(bytes(r.kept))) for r in found]
    assert key(got) == key(without_repeats(rows))


def test_repeats_in_small_blocks(spark, monkeypatch):
    """Blocks of a few documents and ranges of a few names find the same."""
    draw = random.Random(8)
    parts = ["".join(draw.choice("abcdefgh ") for _ in range(70)) for _ in range(12)]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randrange(6))) + str(i)) for i in range(80)]
    monkeypatch.setattr(repeats, "BLOCK", 600)
    monkeypatch.setattr(repeats, "KEYS", 256)
    found = repeats.without_repeats(documents(spark, rows)).collect()
    got = [(r.doc_id, r.n_bytes, sum(s.length for s in r.spans), len(r.spans), sha(bytes(r.kept))) for r in found]
    assert key(got) == key(without_repeats(rows))


def test_difference_cover():
    differences = {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER}
    assert differences == set(range(repeats.PERIOD))


def test_decontamination(spark, monkeypatch):
    words = BASE.split()
    items = [(1, " ".join(words[4:20])), (2, "One, TWO!"), (3, None), (4, "..."), (None, " ".join(words[20:31])),
             (5, " ".join(words[4:20])), (6, "no such words at all in any document of this little table")]
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"), "terms", "segment")
    rows = awkward() + [(30, " ".join(words[4:14])), (31, " ".join(words[4:13])), (32, "mu nu " + " ".join(words[5:15]))]
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 150)  # several slices of the test set
    docs = clashing(documents(spark, rows), "segment", "doc", "items")
    got = decontamination.contaminated(docs, bench).collect()
    wanted = []
    for i, t in rows:
        n, hit, found = hits(t, items)
        wanted.append((i, n, len(hit), found))
    assert key((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got) == key(wanted)
    for r in got:
        inside = {p for s in r.spans for p in range(s.first, s.last + 1)}
        assert len(inside) == r.n_hit and set(r["items"]) <= set(r.near_items)


def test_slices_agree_on_documents_whose_order_changes(spark, monkeypatch):
    """Every pass over the documents gives them in another order and other partitions."""
    from pyspark.sql import functions as F

    words = BASE.split()
    items = [(k, " ".join(words[k:k + 10])) for k in range(0, 30, 5)]
    rows = [(i, " ".join([f"own{i}", *words[i:i + 12], f"tail{i}"])) for i in range(28)]
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 40)
    draw = F.udf(lambda i: int.from_bytes(os.urandom(4), "big"), "long").asNondeterministic()
    docs = documents(spark, rows).withColumn("draw", draw("doc_id")).repartition(3, "draw").sortWithinPartitions("draw")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontamination.contaminated(docs, bench).collect()}
    wanted = {i: hits(t, items) for i, t in rows}
    assert got == {i: (len(hit), found) for i, (_, hit, found) in wanted.items()}


def test_proximity_matches(spark):
    words = BASE.split()
    bench = spark.createDataFrame([(1, " ".join(words[:10]))], "item_id long, text string")
    moved = words[:4] + ["inserted"] + words[4:10]
    far = words[:4] + ["a", "b", "c", "d"] + words[4:10]
    rows = [(1, " ".join(moved)), (2, " ".join(far)), (3, " ".join(words[:10]))]
    got = {r.doc_id: r for r in decontamination.contaminated(documents(spark, rows), bench).collect()}
    assert [list(got[i].near_items) for i in (1, 2, 3)] == [["1"], [], ["1"]]
    assert [got[i].n_hit for i in (1, 2, 3)] == [0, 0, 10]


def test_proximity_match_at_the_start_of_a_segment(spark):
    """The rarest word stands one early at the very start of the only document of its segment."""
    words = BASE.split()[:10]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    swapped = " ".join([words[1], words[0], *words[2:]])
    common = " ".join(w for w in words if w != words[1])
    rows = [(1, swapped), (2, common), (3, f"before it {swapped}")]
    docs = documents(spark, rows).repartitionByRange(3, "doc_id")
    got = {r.doc_id: r for r in decontamination.contaminated(docs, bench).collect()}
    assert [list(got[i].near_items) for i in (1, 2, 3)] == [["1"], [], ["1"]]
    assert [got[i].n_hit for i in (1, 2, 3)] == [0, 0, 0]


def test_without_benchmark_keeps_clean_documents(spark):
    bench = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    kept = decontamination.without_benchmark(documents(spark), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 2, 4, 6, 7, 11]
    assert decontamination.without_benchmark(documents(spark), bench.limit(0)).count() == len(awkward())


def test_fingerprints(spark):
    rows = awkward()
    found = fingerprints.fingerprinted(clashing(documents(spark), "range", "head", "fingerprint")).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    ordered = sorted([r for r in rows if r[0] is not None and r[0] not in (2, 8)], key=lambda r: r[0])
    texts = {i: t or "" for i, t in rows}
    follows = {1: 2, 3: 4, 4: 5, 5: 6, 6: 7, 7: 8, 9: 10, 10: 11}
    for i, nxt in follows.items():
        text, n = texts[i], len(texts[i]) // 4
        new = text[:len(text) - n] + texts[nxt][:n]
        r = by_id[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(new.encode()))
        for near, other in ((r.near_edited, new), (r.near_next, texts[nxt])):
            a, b = shingles(text), shingles(other)
            real = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - real) < 0.2, (i, near, real)
    assert by_id[4].fingerprint == by_id[6].fingerprint and by_id[3].fingerprint != by_id[5].fingerprint
    assert by_id[9].group_id == by_id[5].group_id == 3 and ordered
    # The last document is followed by the first in order: the one without an id.
    last = texts[11]
    assert by_id[11].edited_sha256 == sha((last[:len(last) - len(last) // 4] + texts[None][:len(last) // 4]).encode())


def test_links_of_texts_with_equal_fingerprints(spark):
    """1 has the fingerprint of 2, one shingle more, and so just misses 3, with which 2 links."""
    second = " ".join(f"w{k}" for k in range(104))
    third = " ".join(second.split()[:92])
    print_of = lambda t: fingerprints.Printer().prints([t]).tobytes()
    first = next(t for k in range(200) if print_of(t := f"{second} u{k}") == print_of(second))
    a, b, c = (shingles(t) for t in (first, second, third))
    bound = (len(b & c), len(b | c))
    assert len(a & c) * bound[1] < bound[0] * len(a | c) and len(a & b) * bound[1] >= bound[0] * len(a | b)
    got = {r.doc_id: r for r in fingerprints.fingerprinted(
        documents(spark, [(1, first), (2, second), (3, third)]), bound).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    assert [got[i].group_id for i in (1, 2, 3)] == [1, 1, 1]


def test_empty_tables(spark):
    empty = documents(spark, [])
    bench = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    assert near_duplicates.near_duplicates(empty).count() == 0
    assert near_duplicates.one_of_each(empty).count() == 0
    assert repeats.without_repeats(empty).count() == 0
    assert decontamination.contaminated(empty, bench).count() == 0
    assert fingerprints.fingerprinted(empty).count() == 0


def test_single_document_is_its_own_next(spark):
    r = fingerprints.fingerprinted(documents(spark, [(1, BASE)])).first()
    n = len(BASE) // 4
    assert r.edited_sha256 == sha((BASE[:-n] + BASE[:n]).encode()) and r.near_next == 1.0


def test_registered_queries_against_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    run = lambda name: queries.QUERIES[name](spark, small).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run("op3_suffix_repeats")]
    assert key(got) == key(without_repeats(rows))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in run("op5_near_duplicates")]
    assert key(got) == key(component_ids(rows, 85))
    windows = {w for _, t in items for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())}
    for r in run("op6_decontamination"):
        text = dict(rows)[r.doc_id]
        n, hit, found = hits(text, items) if r.contaminated or r.doc_id % 20 == 0 else (r.n_words, (), [])
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, len(hit), len(found), sha(",".join(found).encode()))
    assert windows
    assert spark.read.parquet(f"{small}/documents.parquet").agg(F.count("*")).first()[0] == len(rows)
