"""MinHash document fingerprints.

A fingerprint holds, for each of ``HASHES`` universal hash functions, the least
value over the shingles of a text (its low 16 bits), computed in numpy over
batches of documents.  Equal texts have equal fingerprints, and the share of
equal places estimates the Jaccard similarity of the shingle sets.  Bands of
fingerprints are joined in Spark to find documents that are alike; their
Jaccard similarity is verified on whole texts.  Documents count as one without
that only if their shingle sets are equal (by a digest of the whole set): texts
that differ in a few shingles often share a fingerprint.

To set a document beside the next one, documents are dealt into ranges of
doc_id and read in order; the first document of a range goes to the end of the
range before it too.  Texts are shuffled once, packed.

A worker keeps the memory of its largest task while it waits for the next one,
and an executor keeps all its workers.  So texts are handled ``UNPACKED`` bytes
at a time, and no task needs two workers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import Scratch, batch, prepare, release, shards, text_column
from docengine.llm.near_duplicates import SIMILAR, Layout, Shingler, coefficients, grouped, keyed, minima

HASHES = 128
LAYOUT = Layout(hashes=HASHES, bands=25, rows=5, dtype="<u2")
RANGE_BYTES = 16 << 20
UNPACKED = 2 << 20    # bytes of text handled at a time
FIRST = -(1 << 63)    # the place of a null doc_id


class Printer:
    """Texts -> fingerprints (rows of 16-bit numbers)."""

    def __init__(self) -> None:
        self.shingler = Shingler()
        self.multiply, self.add = coefficients(HASHES, seed=2)

    def prints(self, texts: list[str]) -> np.ndarray:
        return self.of_sets([self.shingler.shingles(t) for t in texts])

    def of_sets(self, sets: list[np.ndarray]) -> np.ndarray:
        full = np.array([len(s) > 0 for s in sets], bool)
        out = np.full((len(sets), HASHES), 0xFFFF, "<u2")
        if full.any():
            out[full] = minima([s for s in sets if len(s)], self.multiply, self.add) & 0xFFFF
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places; of two texts without words 1, of one of them 0."""
    no_a, no_b = (a == 0xFFFF).all(axis=1), (b == 0xFFFF).all(axis=1)
    return np.where(no_a == no_b, (a == b).mean(axis=1), 0.0)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or all) of the next text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def ranges_of(record: pa.RecordBatch, cuts: np.ndarray) -> np.ndarray:
    ids = record.column(record.schema.get_field_index("doc_id")).fill_null(FIRST)
    return np.searchsorted(cuts, ids.to_numpy(), side="right")


def _ranges(own: DataFrame) -> tuple[np.ndarray, DataFrame, int]:
    """(first doc_id of each range after the first, first documents for the range before theirs, number of ranges).

    Order: doc_id (null before all), then text_key.
    """
    spark = own.sparkSession
    held = own.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(shards(spark), -(-held // RANGE_BYTES))
    cuts = own.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10 * parts)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))  # one number per range
    dealt = pa.schema([("range", pa.int64()), ("id", pa.int64()), ("text_key", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges_of(b, cuts), pa.int64()), b.column(0).fill_null(FIRST), b.column(1).cast(pa.binary())], schema=dealt)

    ordered = F.coalesce("doc_id", F.lit(FIRST))
    least = F.min(F.struct("id", "text_key")).alias("first")
    firsts = sorted((r["range"], r["first"]["id"], bytes(r["first"]["text_key"]))
                    for r in own.select("doc_id", "text_key").mapInArrow(run, "range long, id long, text_key binary")
                    .groupBy("range").agg(least).collect())  # a row per range
    heads = [(firsts[i - 1][0], key, text_key) for i, (_, key, text_key) in enumerate(firsts)]
    columns = zip(*heads) if heads else ((), (), ())
    # As an Arrow table; rows of Python would go through workers of another kind, which then stay too.
    ahead = spark.createDataFrame(pa.table([pa.array(c, kind) for c, kind in zip(columns, dealt.types)], ["range", "id", "key"]))
    first = own.join(F.broadcast(ahead), (ordered == F.col("id")) & (F.col("text_key") == F.col("key")))
    return cuts, first.select(*own.columns, "range"), parts


ROWS = ("doc_id long, text_key binary, set_key binary, n_shingles long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double")
_ROWS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("set_key", pa.binary()), ("n_shingles", pa.int64()), ("n_chars", pa.int64()),
                   ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
                   ("near_edited", pa.float64()), ("near_next", pa.float64())])


def slices(b: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, ``UNPACKED`` bytes or one row at a time."""
    begin = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and size + n > UNPACKED:
            yield b.slice(begin, i - begin)
            begin, size = i, 0
        size += n
    if begin < b.num_rows:
        yield b.slice(begin)


def packed(rows: DataFrame, cuts: np.ndarray = np.zeros(0, np.int64)) -> DataFrame:
    """``rows`` (range, head, doc_id, text_key, text) with the text as n_bytes and its bytes, compressed.

    A null range is that of the document.
    """
    schema = pa.schema([("range", pa.int64()), ("head", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.binary()),
                        ("n_bytes", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for whole in batches:
            sizes = pc.binary_length(whole.column(whole.schema.get_field_index("text"))).to_numpy()
            for b in slices(whole, sizes):
                held = [t.encode("utf-8", "surrogatepass") for t in text_column(b)]
                column = {c: b.column(b.schema.get_field_index(c)) for c in schema.names[:4]}
                column["range"] = pc.coalesce(column["range"], pa.array(ranges_of(b, cuts), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(v.cast(schema.field(c).type) for c, v in column.items()),
                     pa.array(map(len, held), pa.int64()),
                     pa.array([codec.compress(t, asbytes=True) for t in held], pa.binary())], schema=schema)

    return rows.select("range", "head", "doc_id", "text_key", "text").mapInArrow(
        run, "range long, head int, doc_id long, text_key binary, n_bytes long, packed binary")


def unpacked(b: pa.RecordBatch) -> Iterator[list[tuple]]:
    """Rows (range, head, doc_id, text_key, text) of a batch of ``packed``, ``UNPACKED`` bytes or one text at a time."""
    codec = pa.Codec("zstd")
    for part in slices(b, b.column(b.schema.get_field_index("n_bytes")).to_numpy()):
        rows = []
        for *row, n, held in zip(*(text_column(part, c) for c in ("range", "head", "doc_id", "text_key", "n_bytes", "packed"))):
            text = codec.decompress(held, n, asbytes=True) if n else b""
            rows.append((*row, text.decode("utf-8", "surrogatepass")))
        yield rows


def beside_next(own: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses; ``own`` is ``keyed``.

    set_key is equal for equal shingle sets and null for empty ones.
    """
    cuts, first, parts = _ranges(own)
    dealt = own.withColumns({"range": F.lit(None).cast("long"), "head": F.lit(0)})
    both = dealt.unionByName(first.withColumn("head", F.lit(1)))
    sorted_ = packed(both, cuts).repartition(parts, "range").sortWithinPartitions("range", "head", "doc_id", "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Printer()
        last = None  # the row before, which waits for its next text, and its fingerprint
        for rows in (part for b in batches for part in unpacked(b)):
            sets = [printer.shingler.shingles(r[4]) for r in rows]
            keys = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            prints = printer.of_sets(sets)
            pairs = []
            for row, own_print, set_key, own_set in zip(rows, prints, keys, sets):
                # A document and the one after it; after the range's head nothing waits.
                if last is not None and last[0][0] == row[0]:
                    pairs.append((last, (row, own_print)))
                last = None if row[1] else (row, own_print, set_key, len(own_set))
            if not pairs:
                continue
            changed = [edited(a[0][4], z[0][4]) for a, z in pairs]
            mine, following = (np.array([p[k][1] for p in pairs]) for k in (0, 1))
            after = printer.prints(changed)
            yield batch({
                "doc_id": [a[0][2] for a, _ in pairs], "text_key": [a[0][3] for a, _ in pairs],
                "set_key": [a[2] for a, _ in pairs], "n_shingles": [a[3] for a, _ in pairs],
                "n_chars": [len(a[0][4]) for a, _ in pairs],
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
                "fingerprint": [p.tobytes() for p in mine], "edited_fingerprint": [p.tobytes() for p in after],
                "near_edited": likeness(mine, after), "near_next": likeness(mine, following)}, _ROWS)

    return sorted_.mapInArrow(run, ROWS)


def fingerprinted(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint
    (hexadecimal), near_edited, near_next, and group_id: the smallest doc_id among the documents that
    links of a verified similarity of ``similar[0] / similar[1]`` reach.

    A null text is an empty one.  Texts without words have the fingerprint
    of all bits set; among themselves their likeness is 1, to others 0, and
    each is a group of its own.  Rows that repeat an id follow each other in
    the order of their texts' hashes; a null doc_id comes before all.  A
    single document is its own next one; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "fingerprints")
    own = keyed(docs)
    rows = scratch.write(beside_next(own), "prints")
    release(spark)
    signed = rows.select("doc_id", "text_key", "set_key", "n_shingles", F.col("fingerprint").alias("signature"))
    found = rows.join(grouped(signed, own, scratch, similar, LAYOUT), "set_key", "left")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
        F.coalesce("component_id", "doc_id").alias("group_id"))
