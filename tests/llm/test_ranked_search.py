"""Ranked search against the score of every document, and trees against their bounds."""

import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docengine.llm import ranked_search as rs
from tests.llm.helpers import LOWER, awkward, clashing, documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k=50):
    """Sorted (item_id, rank, doc_id, score) by scoring each document for each item."""
    docs = [(i, terms_of(t)) for i, t in rows]
    n_docs, total = sum(1 for _, t in docs if t), sum(len(t) for _, t in docs)
    counts = []
    df = {}
    for i, t in docs:
        own = {}
        for w in t:
            own[w] = own.get(w, 0) + 1
        for w in own:
            df[w] = df.get(w, 0) + 1
        counts.append((i, len(t), own))
    out = []
    for item, text in items:
        asked = set(terms_of(text)) & set(df)
        weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) for w in asked}
        scores = []
        for i, n, own in counts:
            m = 50 + (50 * n * n_docs) // max(1, total)
            score = sum(weight[w] * ((10 ** 9 * own[w]) // (1000 * own[w] + 20 * m)) for w in asked if w in own)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("block, leaf", [(4096, 32), (8, 2), (3, 1)])
def test_awkward_rows(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(rs, "BLOCK", block)
    monkeypatch.setattr(rs, "LEAF", leaf)
    rows = awkward() + [(100 + k, f"word{k % 7} and word{k % 3} " * (1 + k % 5)) for k in range(60)]
    items = [(1, "word3 word1 alpha"), (1, "word3 word1 alpha"), (2, None), (3, " .,"), (4, "nowhere"),
             (None, "AND Ünï É gamma"), (5, "one two " * 50)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = clashing(documents(spark, rows), "rank", "score", "n")
    assert got(rs.ranked(docs, clashing(asked, "doc_id", "place"), k=5)) == brute(rows, items, 5)


def test_slices_give_the_same(spark, monkeypatch):
    rows, items = awkward(), [(k, f"alpha beta {w}") for k, w in enumerate("one two three four tail id".split())]
    asked = spark.createDataFrame(items, "item_id long, text string")
    whole = got(rs.ranked(documents(spark), asked))
    monkeypatch.setattr(rs, "SLICE_BYTES", 40)
    assert got(rs.ranked(documents(spark), asked)) == whole == brute(rows, items)


def test_empty_tables(spark):
    asked = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert got(rs.ranked(documents(spark, []), asked)) == []
    assert got(rs.ranked(documents(spark), asked.limit(0))) == []
    assert got(rs.ranked(documents(spark, [(1, None), (2, "")]), asked)) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 120), st.integers(0, 2 ** 32 - 1), st.sampled_from([1, 10, 10 ** 7, 10 ** 11]))
def test_no_score_is_above_its_bound(n, seed, size):
    rng = np.random.default_rng(seed)
    vocabulary = 40
    queries = [np.unique(rng.integers(0, vocabulary, rng.integers(1, 20))) for _ in range(12)]
    terms = rs.Terms(np.arange(vocabulary), np.ones(vocabulary, np.int64), rng.integers(0, rs.GROUPS, vocabulary),
                     n, n, queries)
    own = [np.unique(rng.integers(0, vocabulary, rng.integers(1, 30))) for _ in range(n)]
    own[n // 2:] = [own[0]] * (n - n // 2)  # copies
    offsets = np.concatenate([[0], np.cumsum([len(o) for o in own])])
    ids, scores = np.concatenate(own), rng.integers(1, size + 1, offsets[-1])
    t = rs.tree(list(range(n)), ids, scores, offsets, terms.group)
    t = {name: np.ascontiguousarray(t[name], kind) for name, kind in rs._FIELDS.items()}
    dense = np.zeros((n, vocabulary), np.int64)
    dense[np.repeat(np.arange(n), np.diff(offsets)), ids] = scores
    chunk = rs._Queries(terms).chunks[0]
    bounds = rs._Queries.bounds(chunk, t)
    inner, leaves = len(t["node_docs"]) - 2, len(t["node_docs"]) - 1
    for q, query in enumerate(queries):
        exact = dense[:, query].sum(axis=1)
        for leaf in range(leaves):
            found, docs = rs._scores(t, leaf, query)
            assert (found == exact[t["ids"][docs]]).all()
            node = inner + leaf
            while True:
                assert found.max() <= bounds[node, q]
                if not node:
                    break
                node = (node - 1) // 2
        best = rs._Best(5, 1)
        rs._open(t, bounds[:, q], query, best, probe=False)
        order = np.lexsort((np.arange(n), -exact))
        assert best.ids.tolist() == [i for i in order.tolist() if exact[i] > 0][:5]


def test_query_on_the_small_table(spark):
    from docengine.llm.queries import op13_ranked_search

    where = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{where}/benchmark.parquet").select("item_id", "text").collect()]
    found = got(op13_ranked_search(spark, where))
    assert found == brute(rows, items) and len(found) > 1000
