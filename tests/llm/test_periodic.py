"""Periodic runs against a search of every period at every word."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docengine.llm import periodic
from tests.llm.helpers import awkward, clashing, documents

SPLIT = periodic._WORDS


def brute_runs(words):
    """(start, length, period): all maximal stretches of every period that have no smaller one."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = q
        while i < n:
            a = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = a - q, i - a + q
            if i > a and length >= max(24, 3 * q):
                part = words[start:start + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-(10 ** 12 * r[1] // r[2]), r[0], r[2]), default=None)
    return runs, best, " ".join(w for i, w in enumerate(words) if i not in gone)


def found(words):
    record = periodic._found([1], [" ".join(words)])
    runs = [(r["start"], r["length"], r["period"]) for r in record.column(2).to_pylist()[0]]
    best = record.column(3).to_pylist()[0]
    return runs, best and (best["start"], best["length"], best["period"]), record.column(4).to_pylist()[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), max_size=14), st.integers(1, 9)), max_size=6))
def test_words_of_repeated_pieces(pieces):
    words = [w for piece, times in pieces for w in piece * times]
    assert found(words) == brute(words)


@pytest.mark.parametrize("seed", range(30))
def test_long_periods_and_nested_runs(seed):
    rng = random.Random(seed)
    words = []
    for _ in range(rng.randint(1, 4)):
        unit = [rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(1, 70))]
        unit += unit[:3] * rng.randint(0, 20)
        words += unit * rng.randint(1, 6) + unit[:rng.randint(0, len(unit))]
    assert found(words) == brute(words)


def test_one_word_and_fibonacci_words():
    assert found(["x"] * 5000) == ([(0, 5000, 1)], (0, 5000, 1), "x")
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    assert found(list(b)) == brute(list(b))


def test_documents_share_no_runs():
    record = periodic._found([1, 2], ["a b " * 8, "a b " * 8])
    assert record.column(2).to_pylist() == [[], []]


def test_long_texts_are_split_in_pieces(monkeypatch):
    monkeypatch.setattr(periodic, "PIECE", 7)
    words = ("one two three " * 12).split() + ["end"]
    assert found(words) == brute(words)


def edited(i, text):
    words = SPLIT.findall(text or "")
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if i is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    return words


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(i, text):
    runs, best, collapsed = brute(edited(i, text))
    s, n, q = best or (None, None, None)
    return (i, len(runs), s, n, q, best and 1000 * n // q, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(collapsed))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def ordered(rows):
    return sorted(rows, key=str)


def test_query_on_awkward_rows(spark, tmp_path):
    from docengine.llm.queries import op12_periodic_runs

    rows = awkward() + [(k, " loop the loop x\n" * k) for k in range(20, 90)]
    clashing(documents(spark, rows), "runs", "n_words", "collapsed", "best").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).select(*COLUMNS).collect()]
    assert ordered(got) == ordered(expected(i, t) for i, t in rows)


def test_empty_table(spark):
    assert periodic.periodic_runs(documents(spark, [])).count() == 0


def test_query_on_the_small_table(spark):
    from docengine.llm.queries import op12_periodic_runs

    where = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in op12_periodic_runs(spark, where).select(*COLUMNS).collect()]
    short = {i for i, t in rows if len(SPLIT.findall(t or "")) <= 500}
    assert len(got) == len(rows) and len(short) > 100
    assert ordered(r for r in got if r[0] in short) == ordered(expected(i, t) for i, t in rows if i in short)
