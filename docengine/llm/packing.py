"""Best-fit packing of token sequences by minimum bin slack.

A bin (a sequence of ``capacity`` tokens) is seeded with the longest piece
left; a subset-sum over the lengths that are left, held as a bitset, finds the
fullest combination that fits beside it, which is then removed.  Bins with the
same lengths are the same problem, so a combination is taken as often as its
lengths last: the planning needs the number of pieces of each length only, at
most ``capacity`` numbers however many documents there are.  Spark counts the
lengths, numbers the pieces of a length in parallel, and every piece finds its
sequence and offset from (length, number).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docengine.llm.common import Scratch, batch, prepare, shards
from docengine.llm.tokens import encoded

CAPACITY = 2048
END_ID = 0

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")
PIECES_ARROW = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                ("ids_crc32", pa.int64())]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """The token pieces of every whole text: ids, then ``end_id``, cut every ``capacity`` tokens.

    Only longer texts are cut.  A null or empty text is the end id alone;
    repeated rows give repeated pieces; a null doc_id stays null.  With
    ``keep_ids`` a column ``ids`` holds the packed little-endian ids.
    """
    schema = pa.schema(PIECES_ARROW + ([("ids", pa.binary())] if keep_ids else []))
    step, end = 4 * capacity, end_id.to_bytes(4, "little")

    def emit(doc_ids, packed):
        out = {f.name: [] for f in schema}
        for doc_id, ids in zip(doc_ids, packed):
            ids += end
            for at in range(0, len(ids), step):
                part = ids[at:at + step]
                out["doc_id"].append(doc_id)
                out["piece"].append(at // step)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
                if keep_ids:
                    out["ids"].append(part)
        yield batch(out, schema)

    return encoded(docs, emit, PIECES + (", ids binary" if keep_ids else ""), path)


@dataclass
class Plan:
    """Rows (length, first number, first sequence, pieces per sequence, offset of the first of them)."""

    rows: np.ndarray
    sequences: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Minimum bin slack over a histogram of lengths between 1 and ``capacity``."""
    left = {n: c for n, c in counts.items() if c > 0}
    if left and not 1 <= min(left) <= max(left) <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    taken = dict.fromkeys(left, 0)
    rows, sequences = [], 0
    while left:
        used = fullest(left, capacity)
        times = min(left[n] // k for n, k in used.items())
        offset = 0
        for n, k in used.items():
            rows.append((n, taken[n], sequences, k, offset))
            taken[n] += times * k
            left[n] -= times * k
            offset += n * k
            if not left[n]:
                del left[n]
        sequences += times
    rows.sort()
    return Plan(np.array(rows, dtype=np.int64).reshape(-1, 5), sequences)


def fullest(left: dict[int, int], capacity: int) -> dict[int, int]:
    """The longest length left and the fullest combination of lengths beside it: {length: pieces}."""
    seed = max(left)
    room = capacity - seed
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    sums, steps = 1, []
    for n in sorted(left, reverse=True):
        have = min(left[n] - (n == seed), room // n if n <= room else 0)
        many = 1
        while have > 0 and not sums & goal:
            k = min(many, have)  # 1, 2, 4, .. copies: every count up to ``have`` is a sum of some
            steps.append((sums, n, k))
            sums |= (sums << (n * k)) & mask
            have -= k
            many *= 2
        if sums & goal:
            break
    used, at = {seed: 1}, sums.bit_length() - 1
    for before, n, k in reversed(steps):
        if not before >> at & 1:
            used[n] = used.get(n, 0) + k
            at -= n * k
    return used


def numbered(df: DataFrame, parts: int) -> DataFrame:
    """``number``: 0, 1, .. within each length, counted in ``parts`` shards of a length in parallel."""
    df = df.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    sizes = df.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    return (df.withColumn("number", F.row_number().over(within) - 1).join(starts, ["length", "shard"])
            .withColumn("number", F.col("number") + F.col("first")).drop("first", "shard"))


def placed(df: DataFrame, packing: Plan) -> DataFrame:
    """Adds sequence_id and offset to numbered pieces."""
    rows = packing.rows  # a few rows per length below the capacity: bounded, whatever the input
    columns = [c for c in df.columns if c != "number"]
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (rows[:, 0] << 44) + rows[:, 1]
        for b in batches:
            length, number = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "number"))
            row = rows[np.searchsorted(keys, (length << 44) + number, side="right") - 1]
            ahead = number - row[:, 1]
            sequence = row[:, 2] + ahead // np.maximum(row[:, 3], 1)
            offset = row[:, 4] + ahead % np.maximum(row[:, 3], 1) * length
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in columns] + [pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"])

    return df.mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence they go to and their offset there.

    Offsets of a sequence are gapless from 0.  Cases are those of ``pieces``;
    an empty table gives no rows.  Texts are encoded once, into a table of
    the shared folder that numbering and placing read.
    """
    spark = prepare(docs.sparkSession)
    kept = Scratch(spark, "packing").write(pieces(docs, capacity, path, end_id, keep_ids), "pieces")
    counts = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}  # capacity rows at most
    return placed(numbered(kept, shards(spark)), plan(counts, capacity))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from pieces that kept their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` tokens
    joined = F.aggregate(parts, F.lit("").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
