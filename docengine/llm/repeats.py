"""Removal of byte strings that repeat across documents, by difference-cover sampling.

The suffixes of all documents are compared by their first ``LENGTH`` bytes.
Positions whose residue modulo ``PERIOD`` lies in a difference cover are
sampled: any two positions have a common distance, below the period, at which
both reach a sampled one, so two equal strings share a sampled string of
``LENGTH - PERIOD + 1`` bytes in the same place.

1. Sampled strings are named: bytes in triples, names of triples in triples
   again, and so on (64-bit names); the names are sorted in ranges, and names
   of one document alone are marked.
2. The remaining suffixes are merged in where a sampled string in them occurs
   in several documents; all others repeat nowhere.  They are named to
   their full length from the names below, and sorted in ranges.
3. Neighbours in that order with equal names have equal prefixes; all but
   those of the smallest document are repeats.

Names stand for lexicographic ranks: ranks would have to be written and joined
for every byte of the corpus and level of the recursion, names are made where
the text is.  Two different strings get one name with a chance of 2^-64.

Documents are packed into blocks, ranges of doc_id, written once.  Blocks
send sorted arrays of their own distinct names and get back one bit for each,
so a string that stands in a third of the documents is one number per block;
the order of the blocks says which document is smaller.  The blocks are
bucketed by number: the bits go to them, the texts stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import Scratch, ascending, batch, prepare, release, shards, sorted_ranges, text_column, texts

LENGTH = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # a perfect difference set modulo 31
SAMPLED = LENGTH - PERIOD + 1
BLOCK = 4 << 20                 # bytes of text in a block, but for longer documents
KEYS = 1 << 20                  # names in a sorted range, on average
PARTS = 4                       # parts of the whole names, sorted one after another
CHUNK = 1 << 16

_RNG = np.random.Generator(np.random.PCG64(3))
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B, _C = (x * np.uint64(2) + np.uint64(1) for x in _RNG.integers(0, 1 << 63, 3, dtype=np.uint64))
_M = np.uint64(0xD6E8FEB86659FD93)


def _triple(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Name of three names in a row."""
    t = x * _A
    t += y * _B
    t += z * _C
    t ^= t >> np.uint64(32)
    t *= _M
    t ^= t >> np.uint64(29)
    return t


def names(text: np.ndarray, width: int) -> np.ndarray:
    """Names of the strings of ``width`` bytes (20 to 27, or 28 to 81) that start at each position."""
    out = np.zeros(max(0, len(text) - width + 1), np.uint64)
    for at in range(0, len(out), CHUNK):
        n = min(CHUNK, len(out) - at)
        b = _BYTES[text[at:at + n + width - 1]]

        def step(h: np.ndarray, size: int, to: int) -> np.ndarray:
            """Names of ``to`` bytes from those of ``size``: three that cover them."""
            count = len(b) - to + 1
            mid, last = min(size, to - size), to - size
            return _triple(h[:count], h[mid:mid + count], h[last:last + count])

        h, size = b, 1
        while size < width:
            to = min(3 * size, width)
            h, size = step(h, size, to), to
        out[at:at + n] = h
    return out


def pack_blocks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks (block, doc_ids, lengths, body) in the order of doc_id, bucketed by block.

    A null doc_id is before all; rows that share an id share a block.
    """
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                        ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, bodies, held = [], [], 0

        def block():
            return batch({"block": [number], "doc_ids": [ids], "lengths": [[len(x) for x in bodies]],
                          "body": [b"".join(bodies)]}, schema)

        for b in batches:
            for doc_id, text in zip(text_column(b, "doc_id"), text_column(b)):
                if held >= BLOCK and doc_id != ids[-1]:
                    yield block()
                    number, ids, bodies, held = number + 1, [], [], 0
                body = text.encode("utf-8", "surrogatepass")
                ids.append(doc_id)
                bodies.append(body)
                held += len(body)
        if ids:
            yield block()

    own = texts(docs)
    held = own.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(shards(docs.sparkSession), -(-held // (4 * BLOCK)))
    blocks = (own.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
              .mapInArrow(run, "block long, doc_ids array<long>, lengths array<long>, body binary"))
    return scratch.bucketed(blocks, "blocks", "block", parts)


class Block:
    """The text of a block, and which positions begin a string of its own document."""

    def __init__(self, doc_ids: list, lengths: list[int], body: bytes) -> None:
        self.text = np.frombuffer(body, np.uint8)
        self.lengths = np.array(lengths, np.int64)
        self.ends = np.cumsum(self.lengths)
        # Rows that share an id are one document: a string of one is not earlier in another.
        ids = [-(1 << 63) if i is None else i for i in doc_ids]
        rank = np.concatenate([[0], np.cumsum(np.diff(np.array(ids, np.int64)) != 0)]) if ids else np.zeros(0, np.int64)
        self.rank = rank
        # Bytes up to the document's end.
        self.left = np.repeat(self.ends.astype(np.int32), self.lengths) - np.arange(len(self.text), dtype=np.int32)

    def sampled(self) -> np.ndarray:
        at = (np.arange(0, len(self.text), PERIOD)[:, None] + np.array(COVER)).ravel()
        at = at[at < len(self.text)]
        return at[self.left[at] >= SAMPLED]

    def sample_names(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions and their names, cut to 32 bits and those of the range."""
        at = self.sampled()
        return at, names(self.text, SAMPLED)[at] >> np.uint64(32 - bits)

    def candidates(self, answers: list | None, bits: int) -> np.ndarray:
        """Marks of the positions whose strings have a sampled string that repeats."""
        at, own = self.sample_names(bits)
        distinct, back = np.unique(own, return_inverse=True)
        again = np.zeros(len(self.text) + PERIOD + 1, np.int32)
        again[at[_unpacked(distinct, 32, answers)[back]] + 1] = 1
        again = np.cumsum(again)
        return (self.left >= LENGTH) & (again[PERIOD:PERIOD + len(self.text)] > again[:len(self.text)])

    def whole_names(self, mask: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the marked strings and their names."""
        at = np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8), count=len(self.text)))
        return at, names(self.text, LENGTH)[at] if len(at) else np.zeros(0, np.uint64)

    def repeated_here(self, at: np.ndarray, own: np.ndarray, first_stays: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct names, name of each position, marks).

        Marks are of names in several documents of the block; or, if the
        first document stays, of positions that an earlier one has too.
        """
        distinct, back = np.unique(own, return_inverse=True)
        doc = self.rank[np.searchsorted(self.ends, at, side="right")]
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, back, doc)
        if first_stays:
            return distinct, back, doc > least[back]
        marks = np.zeros(len(distinct), bool)
        marks[back[doc > least[back]]] = True
        return distinct, back, marks


_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("names", pa.binary()), ("marks", pa.binary())])
_MASK = pa.schema([("block", pa.int64()), ("mask", pa.binary())])
SENT = "bucket long, block long, names binary, marks binary"


def _answer(pdf: pd.DataFrame, dtype: str, earlier_only: bool) -> pd.DataFrame:
    """For the blocks of a range: which of their names other (or earlier) blocks have, as packed bits."""
    pdf = pdf.sort_values("block", kind="stable")
    arrays = [np.frombuffer(x, dtype) for x in pdf["names"]]
    sizes = np.array([len(a) for a in arrays])
    flat = np.concatenate(arrays)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    # Neighbours in the sorted order; equal names stand in the order of their blocks.
    again = np.concatenate([[False], ordered[1:] == ordered[:-1]])
    marked = np.zeros(len(flat), bool)
    if earlier_only:
        marked[order] = again
    else:
        own = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool)
                              for m, n in zip(pdf["marks"], sizes)])
        group = np.cumsum(~again) - 1
        many = np.bincount(group) > 1
        np.logical_or.at(many, group, own[order])
        marked[order] = many[group]
    cuts = np.cumsum(sizes)[:-1]
    return pd.DataFrame({"bucket": pdf["bucket"].to_numpy(), "block": pdf["block"].to_numpy(),
                         "bits": [np.packbits(x).tobytes() for x in np.split(marked, cuts)]})


def _bits(sent: DataFrame, dtype: str, earlier_only: bool) -> DataFrame:
    """(block, bits): the answers of all ranges, in their order."""
    answers = sent.groupBy("bucket").applyInPandas(
        lambda pdf: _answer(pdf, dtype, earlier_only), "bucket long, block long, bits binary")
    return answers.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "bits"))).alias("bits"))


def _unpacked(distinct: np.ndarray, shift: int, bits: list | None) -> np.ndarray:
    """A mark for each distinct name, from the answers of its ranges."""
    found = {r["bucket"]: r["bits"] for r in bits or ()}
    out = np.zeros(len(distinct), bool)
    for bucket, a, z in sorted_ranges(distinct, shift):
        out[a:z] = np.unpackbits(np.frombuffer(found[bucket], np.uint8), count=z - a).astype(bool)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    for b in batches:
        for i in range(b.num_rows):
            r = {f.name: b.column(k)[i].as_py() for k, f in enumerate(b.schema)}
            yield r, Block(r["doc_ids"], r["lengths"], r["body"])


SPANS = "array<struct<start:long,length:long>>"
KEPT = f"doc_id long, n_bytes long, spans {SPANS}, kept binary"
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                   ("kept", pa.binary())])


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (removed runs of bytes), kept (the bytes left).

    Every byte that a string of ``LENGTH`` bytes covers which also starts in
    a document with a smaller doc_id is removed.  A null text is empty;
    texts shorter than ``LENGTH`` stay; rows that share a doc_id do not count
    as earlier to each other; a null doc_id is smaller than all others.
    Memory is bounded by a block or the longest document.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "repeats")
    blocks = pack_blocks(docs, scratch)
    release(spark)
    total = blocks.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    bits = max(0, (total * len(COVER) // PERIOD // KEYS).bit_length())      # ranges of sampled names: 2 ** bits
    wide = max(0, (total // (2 * PARTS * KEYS)).bit_length())               # ranges of a part of the whole names

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, block in _blocks(batches):
            distinct, _, marks = block.repeated_here(*block.sample_names(bits), first_stays=False)
            cut = list(sorted_ranges(distinct, 32))
            yield batch({"bucket": [k for k, _, _ in cut], "block": [r["block"]] * len(cut),
                         "names": [(distinct[a:z] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() for _, a, z in cut],
                         "marks": [np.packbits(marks[a:z]).tobytes() for _, a, z in cut]}, _SENT)

    several = scratch.write(_bits(blocks.mapInArrow(sampled, SENT), "<u4", earlier_only=False), "several")
    release(spark)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, block in _blocks(batches):
            yield batch({"block": [r["block"]], "mask": [np.packbits(block.candidates(r["bits"], bits)).tobytes()]}, _MASK)

    beside = blocks.join(several.hint("shuffle_hash"), "block", "left")
    masks = scratch.write(beside.mapInArrow(masked, "block long, mask binary"), "masks")
    beside = blocks.join(masks.hint("shuffle_hash"), "block", "left")

    def whole(part: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r, block in _blocks(batches):
                own = block.whole_names(r["mask"])[1]
                distinct = ascending(own[own % np.uint64(PARTS) == part])
                cut = list(sorted_ranges(distinct, 64 - wide))
                yield batch({"bucket": [k for k, _, _ in cut], "block": [r["block"]] * len(cut),
                             "names": [distinct[a:z].astype("<u8").tobytes() for _, a, z in cut],
                             "marks": [b""] * len(cut)}, _SENT)

        return run

    # A part of the names after another: the shuffle of one is gone before that of the next.
    for part in range(PARTS):
        earlier = scratch.write(_bits(beside.mapInArrow(whole(part), SENT), "<u8", earlier_only=True), f"earlier-{part}")
        beside_all = earlier.withColumnRenamed("bits", f"earlier_{part}").hint("shuffle_hash")
        answers = beside_all if part == 0 else answers.join(beside_all, "block", "full_outer")
        del earlier, beside_all
        release(spark)
    beside = beside.join(answers, "block", "left")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, block in _blocks(batches):
            at, own = block.whole_names(r["mask"])
            repeat = np.zeros(len(at), bool)
            for part in range(PARTS):
                chosen = np.flatnonzero(own % np.uint64(PARTS) == part)
                distinct, back, again = block.repeated_here(at[chosen], own[chosen], first_stays=True)
                repeat[chosen] = again | _unpacked(distinct, 64 - wide, r[f"earlier_{part}"])[back]
            edge = np.zeros(len(block.text) + 1, np.int32)
            np.add.at(edge, at[repeat], 1)
            np.add.at(edge, at[repeat] + LENGTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            out = {"doc_id": r["doc_ids"], "n_bytes": r["lengths"], "spans": [], "kept": []}
            for end, n in zip(block.ends, block.lengths):
                own_gone = gone[end - n:end]
                step = np.diff(np.concatenate([[0], own_gone.astype(np.int8), [0]]))
                starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                out["spans"].append([{"start": a, "length": z - a} for a, z in zip(starts.tolist(), stops.tolist())])
                out["kept"].append(block.text[end - n:end][~own_gone].tobytes())
            yield batch(out, _KEPT)

    return beside.mapInArrow(removed, KEPT)
