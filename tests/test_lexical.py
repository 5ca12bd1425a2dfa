"""Ranked lexical search against the score of every passage."""

import math
import random
import re

import pytest

from docengine.operators import lexical
from docengine.runtime import scratch_path

COMMON = "the of and a in".split()


def brute(passages, questions, k):
    split = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    held = {i: split(t) for i, t in passages if split(t)}
    average = sum(map(len, held.values())) / max(1, len(held))
    df = {}
    for w in held.values():
        for term in set(w):
            df[term] = df.get(term, 0) + 1
    out = []
    for q, text in questions:
        scores = []
        for i, w in held.items():
            shared = set(split(text)) & set(w)
            score = sum(math.log(1 + (len(held) - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2
                        / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / average)) for t in shared)
            if shared:
                scores.append((-round(score, 6), i))
        out += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    rare = [f"w{k}" for k in range(60)]
    passages = [(i, " ".join(rng.choice(COMMON if rng.random() < 0.7 else rare) for _ in range(rng.randint(1, 40))))
                for i in range(n)]
    passages += [(1000 + i, passages[0][1]) for i in range(n // 3)]  # one text of many copies
    passages += [(2000, None), (2001, ""), (2002, " ,.; "), (2003, "THE w1, W1! w1?"), (2004, "the " * 3000)]
    questions = [(q, " ".join(rng.choices(COMMON + rare, k=rng.randint(1, 12)))) for q in range(15)]
    questions += [(100, None), (101, ""), (102, "nowhere"), (103, "the the the of"), (104, " ".join(COMMON + rare))]
    return passages, questions


@pytest.mark.parametrize("seed, only", [(1, False), (2, True)])
def test_search_is_exact(spark, seed, only):
    passages, questions = corpus(seed)
    docs = spark.createDataFrame(passages, "id long, text string").repartition(5)
    asked = spark.createDataFrame(questions, "query_id long, text string")
    path = scratch_path(spark, "test-lexical")
    terms = lexical.asked_words(asked, "query_id", "text") if only else None
    lexical.build_lexical(spark, docs, path, "id", "text", terms)
    index = lexical.open_lexical(spark, path)
    found = sorted((r["query_id"], r["id"], r["score"], r["rank"]) for r in lexical.search(index, asked, 4).collect())
    wanted = brute(passages, questions, 4)
    assert [(q, i, r) for q, i, _, r in found] == [(q, i, r) for q, i, _, r in wanted]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(found, wanted))
    assert index.passages == len(passages) - 3


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, None)], "id long, text string")
    asked = spark.createDataFrame([(1, "word")], "query_id long, text string")
    index = lexical.build_lexical(spark, docs, scratch_path(spark, "test-lexical"), "id", "text")
    assert lexical.search(index, asked, 3).count() == 0
    some = lexical.build_lexical(spark, spark.createDataFrame([(1, "word")], "id long, text string"),
                                 scratch_path(spark, "test-lexical"), "id", "text")
    assert lexical.search(some, asked.limit(0), 3).count() == 0


def test_passages_are_cut_into_words_once(spark, tmp_path, monkeypatch):
    written = []
    write = lexical.materialize
    monkeypatch.setattr(lexical, "materialize", lambda df, label: written.append(label) or write(df, label))
    passages = spark.createDataFrame([(1, "a b b"), (2, None), (3, "")], "id long, text string")
    index = lexical.build_lexical(spark, passages, str(tmp_path / "index"), "id", "text")
    assert index.passages == 1 and index.postings.count() == 2 and written == ["words"]
