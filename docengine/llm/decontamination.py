"""Benchmark decontamination over a distributed positional inverted index.

Documents are indexed in segments: a segment holds some thousand documents and
the postings (positions, ascending) of the terms that the test set asks for,
with its documents' extents.  Segments are written once to the shared folder.
A phrase is searched from its rarest term: that term's postings, less its
place in the phrase, are the candidate starts; the postings of the other
terms, less theirs, are intersected with them from rare to frequent.  With a
``slop`` a term may stand that many words off its place: proximity matches.

Segments are searched where they are read.  The test set is the stated query
set; it goes to the tasks in slices of ``SLICE_BYTES`` of text.  Documents are
numbered once: every slice has an index of its own, whose segments may hold
other documents, and hits of all slices meet by the documents' numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import Scratch, batch, free_name, prepare, release, scratch_closed, text_column, texts

WINDOW = 10
SLOP = 2
SLICE_BYTES = 2 << 20  # text of the test set that one search sends to the tasks
CANDIDATES = 1 << 20   # candidate starts held at once

# ASCII letters in lower case, digits and all code points beyond ASCII are parts of words.
_WORD_BYTES = bytes(ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20
                    for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


@dataclass
class Phrases:
    """Windows of a slice of the test set: term numbers, and the items that each belongs to."""

    terms: dict[bytes, int]
    windows: np.ndarray      # distinct windows x WINDOW, -1 beyond the end of a short one
    items: list[list[str]]   # item ids by window


def phrases(rows: list[tuple[str, str | None]], width: int = WINDOW) -> Phrases:
    """Windows of ``width`` words of the items; an item of fewer, but not none, is one window."""
    terms: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in rows:
        ids = [terms.setdefault(w, len(terms)) for w in words(text)]
        for i in range(max(1, len(ids) - width + 1)) if ids else ():
            found.setdefault(tuple(ids[i:i + width]), set()).add(item)
    windows = np.full((len(found), width), -1, np.int64)
    for i, w in enumerate(found):
        windows[i, :len(w)] = w
    return Phrases(terms, windows, [sorted(x) for x in found.values()])


SEGMENT = ("numbers array<long>, doc_ids array<long>, first array<int>, n_words array<int>, "
           "terms array<int>, counts array<int>, postings binary")
_SEGMENT = pa.schema([("numbers", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
                      ("first", pa.list_(pa.int32())), ("n_words", pa.list_(pa.int32())),
                      ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("postings", pa.binary())])


def numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, number); the numbers stay only once they are written."""
    return texts(docs).withColumn("number", F.monotonically_increasing_id())


def index(docs: DataFrame, terms: dict[bytes, int], gap: int = WINDOW + 2 * SLOP) -> DataFrame:
    """Segments of ``numbered`` documents: one per Arrow batch, with the postings of ``terms``.

    Positions count through a segment; ``gap`` free positions before each
    document keep phrases from crossing them, and leave room for a proximity
    match that begins before its document does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b for b in batches if b.num_rows):
            number = terms.get
            first, lengths, ids, at = [], [], [np.full(gap, -1, np.int32)], gap
            for text in text_column(b):
                own = [number(w, -1) for w in words(text)]
                first.append(at)
                lengths.append(len(own))
                ids.append(np.array(own, np.int32))
                ids.append(np.full(gap, -1, np.int32))
                at += len(own) + gap
            flat = np.concatenate(ids)
            known = np.flatnonzero(flat >= 0)
            order = known[np.argsort(flat[known], kind="stable")].astype(np.int32)
            present, counts = np.unique(flat[known], return_counts=True)
            yield batch({"numbers": [text_column(b, "number")], "doc_ids": [text_column(b, "doc_id")],
                         "first": [first], "n_words": [lengths], "terms": [present], "counts": [counts],
                         "postings": [order.tobytes()]}, _SEGMENT)

    return docs.mapInArrow(run, SEGMENT)


def frequencies(segments: DataFrame, size: int) -> np.ndarray:
    """Occurrences in all documents, by term of the slice."""
    total = np.zeros(size, np.int64)
    pairs = segments.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    for r in pairs.groupBy("t.terms").agg(F.sum("t.counts").alias("n")).collect():  # terms of one slice
        total[r["terms"]] = r["n"]
    return total


class Postings:
    """The postings of a segment, one sorted array of (term, position)."""

    def __init__(self, terms, counts, positions: np.ndarray, size: int) -> None:
        self.positions = positions.astype(np.int64)
        self.start, self.count = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.count[terms] = counts
        self.start[terms] = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(terms) else 0
        self.keys = (np.repeat(np.asarray(terms, np.int64), counts) << 32) | self.positions

    def near(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether ``term`` has a posting between ``low`` and ``high``."""
        low = np.maximum(low, 0)
        at = np.searchsorted(self.keys, (term << 32) | low)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] <= ((term[hit] << 32) | high[hit])
        return hit


def matches(postings: Postings, windows: np.ndarray, order: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, start) of all matches; ``order`` lists each window's places from the rarest term on."""
    rarest = windows[np.arange(len(windows)), order[:, 0]]
    have = postings.count[rarest]
    some = np.flatnonzero(have)
    ends = np.cumsum(have[some])
    done = 0
    while done < len(some):
        base = ends[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(ends, base + CANDIDATES, side="right")))
        part = some[done:upto]
        n = have[part]
        window = np.repeat(part, n)
        within = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        start = postings.positions[postings.start[rarest[window]] + within] - order[window, 0]
        keep = start >= 0
        window, start = window[keep], start[keep]
        for k in range(1, windows.shape[1]):
            place = order[window, k]
            term = windows[window, place]
            at = start + place
            keep = (term < 0) | postings.near(term, at - slop, at + slop)
            window, start = window[keep], start[keep]
        yield window, start
        done = upto


HITS = "number long, spans array<struct<first:int,last:int>>, items array<string>, near_items array<string>"
_HITS = pa.schema([("number", pa.int64()),
                   ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                   ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])


def search(segments: DataFrame, slice_: Phrases, total: np.ndarray, slop: int = SLOP) -> DataFrame:
    """Documents of the segments with matches of a slice.

    spans: runs of words (from 0, in the document) inside exact matches;
    items: with an exact match; near_items: with a proximity match.
    """
    windows, items = slice_.windows, slice_.items
    lengths = (windows >= 0).sum(axis=1)
    rank = np.where(windows >= 0, total[np.maximum(windows, 0)], np.iinfo(np.int64).max)
    order = np.argsort(rank, axis=1, kind="stable")
    size = len(slice_.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                positions = np.frombuffer(r["postings"], np.int32)
                postings = Postings(np.array(r["terms"], np.int64), np.array(r["counts"], np.int64), positions, size)
                first, n_words = np.array(r["first"], np.int64), np.array(r["n_words"], np.int64)
                edge = np.zeros(int(first[-1] + n_words[-1]) + 2 if len(first) else 2, np.int32)
                exact, near = set(), set()
                for tolerance, out in ((0, exact), (slop, near)):
                    for window, start in matches(postings, windows, order, tolerance):
                        doc = np.searchsorted(first, start + tolerance, side="right") - 1
                        out.update(zip(doc.tolist(), window.tolist()))
                        if not tolerance:
                            np.add.at(edge, start, 1)
                            np.add.at(edge, start + lengths[window], -1)
                if not near:
                    continue
                inside = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)])
                step = np.diff(inside)
                begins, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                spans, hit, close = {}, {}, {}
                for a, z in zip(begins.tolist(), ends.tolist()):
                    d = int(np.searchsorted(first, a, side="right")) - 1
                    spans.setdefault(d, []).append({"first": a - int(first[d]), "last": z - 1 - int(first[d])})
                for d, w in exact:
                    hit.setdefault(d, set()).update(items[w])
                for d, w in near:
                    close.setdefault(d, set()).update(items[w])
                found = sorted(close)
                yield batch({"number": [r["numbers"][d] for d in found],
                             "spans": [spans.get(d, []) for d in found],
                             "items": [sorted(hit.get(d, ())) for d in found],
                             "near_items": [sorted(close[d]) for d in found]}, _HITS)

    return segments.select("numbers", "first", "n_words", "terms", "counts", "postings").mapInArrow(run, HITS)


def _covered(spans: Column) -> Column:
    """Words in the union of spans sorted by their first word."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"], a["to"] + 1) + 1)).alias("n"),
        F.greatest(a["to"], s["last"]).alias("to")))["n"]


def contaminated(docs: DataFrame, bench: DataFrame, width: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """One row per row of ``docs``:

    doc_id, n_words, n_hit (words inside an exact match), items (ids, as
    strings, of the items with an exact match, sorted), spans (the runs of
    matched words), near_items (items with a match within ``slop`` words).

    A null or empty text has no words and no match; a null item text has no
    windows, a null item id is the empty string; repeated items count once;
    repeated rows of ``docs`` each get a row.  Without items nothing matches.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "decontamination")
    bench = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    held = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    slices = max(1, -(-held // SLICE_BYTES))
    of_slice = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    # The one index of a single slice keeps the numbers; several take them from a written table.
    own = numbered(docs) if slices == 1 else scratch.write(numbered(docs), "numbered")
    hits, extents = [], None
    for k in range(slices):
        rows = [(r["item_id"], r["text"]) for r in bench.where(of_slice == k).distinct().collect()]  # one slice
        asked = phrases(rows, width)
        segments = scratch.write(index(own, asked.terms, width + 2 * slop), f"index-{k}")
        total = frequencies(segments, len(asked.terms))
        hits.append(scratch.write(search(segments, asked, total, slop), f"hits-{k}"))
        if k == 0:
            extents = scratch.write(segments.select(
                F.explode(F.arrays_zip("numbers", "doc_ids", "n_words")).alias("d")).select(
                F.col("d.numbers").alias("number"), F.col("d.doc_ids").alias("doc_id"),
                F.col("d.n_words").alias("n_words")), "extents")
        scratch.drop(f"index-{k}")
    scratch.drop("numbered")
    every = hits[0]
    for h in hits[1:]:
        every = every.unionByName(h)
    strings = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    per_doc = every.groupBy("number").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        strings("items").alias("items"), strings("near_items").alias("near_items"))
    none = F.array().cast("array<string>")
    return extents.join(per_doc, "number", "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
        F.coalesce("near_items", none).alias("near_items"))


def without_benchmark(docs: DataFrame, bench: DataFrame, width: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` for the documents that hold no window of the test set.

    Rows with equal id and text are one document; a null text has no words.
    """
    spark = prepare(docs.sparkSession)
    row, scratch = free_name(docs, "__row"), Scratch(spark, "decontamination-rows")
    numbered = scratch.write(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    with scratch_closed():
        found = contaminated(numbered.select(F.col(row).alias("doc_id"), "text"), bench, width)
        dirty = scratch.write(found.where(F.col("n_hit") > 0).select(F.col("doc_id").alias(row)), "dirty")
    release(spark)
    return numbered.join(dirty, row, "left_anti").drop(row)
