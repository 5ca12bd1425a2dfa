"""Nearest vectors: exact and approximate top-k for a batch of queries.

The index stays where its files are.  Every task scores its own Arrow batches
against the queries, keeps the k best rows per query across all of them, and
hands those on when it ends; no (vector, query) pair outside those is ever
emitted.  A query set beyond ``MAX_QUERY_BYTES`` is searched slice by slice,
one pass of the index for each, so that no vector of the index is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.runtime import materialize

# Scores are compared after rounding, so that copies of one vector tie and
# fall back to the id whatever the order in which a task summed them.
SCORE_DIGITS = 6
# Bytes of query vectors that are sent to every task at a time.
MAX_QUERY_BYTES = 32 << 20
# Queries scored at a time inside a task, which bounds its score matrix.
QUERY_SLICE = 256


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _id_rank(ids) -> np.ndarray:
    rank = np.empty(len(ids), dtype=np.int64)
    rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    return rank


def _best(scores: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties by id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= floor)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((rank[keep], -scores[keep]))][:k]


class _Best:
    """The k best rows of each query among the batches seen so far."""

    def __init__(self, queries: np.ndarray, k: int, unit: bool) -> None:
        self.queries, self.k, self.unit = queries, k, unit
        self.found: list[tuple[np.ndarray, pa.Array] | None] = [None] * len(queries)

    def add(self, ids: pa.Array, vectors: np.ndarray, allowed: Callable[[int], np.ndarray | None]) -> None:
        if self.unit:
            vectors = _unit(vectors)
        rank = _id_rank(ids)
        for lo in range(0, len(self.queries), QUERY_SLICE):
            block = np.round(vectors @ self.queries[lo : lo + QUERY_SLICE].T, SCORE_DIGITS) + 0.0
            for j in range(block.shape[1]):
                rows = allowed(lo + j)
                scores = block[:, j] if rows is None else block[rows, j]
                held = self.found[lo + j]
                if held is not None and len(held[0]) == self.k and (not len(scores) or scores.max() < held[0][-1]):
                    continue
                best = _best(scores, rank if rows is None else rank[rows], self.k)
                at = best if rows is None else rows[best]
                if len(at):
                    self._merge(lo + j, scores[best], ids.take(pa.array(at)))

    def _merge(self, q: int, scores: np.ndarray, ids: pa.Array) -> None:
        if self.found[q] is not None:
            scores = np.concatenate([self.found[q][0], scores])
            ids = pa.concat_arrays([self.found[q][1], ids])
            best = _best(scores, _id_rank(ids), self.k)
            scores, ids = scores[best], ids.take(pa.array(best))
        self.found[q] = scores, ids

    def rows(self, query_ids: pa.Array, names: list[str]) -> Iterator[pa.RecordBatch]:
        held = [(q, f) for q, f in enumerate(self.found) if f is not None]
        if held:
            q = np.repeat([q for q, _ in held], [len(f[0]) for _, f in held])
            yield pa.RecordBatch.from_arrays(
                [query_ids.take(pa.array(q)), pa.concat_arrays([f[1] for _, f in held]),
                 pa.array(np.concatenate([f[0] for _, f in held]))], names=names)


def _clean(df: DataFrame, vec_col: str, dim: int | None = None) -> DataFrame:
    """Vectors that can be scored: present, without NULL elements, and of ``dim`` numbers."""
    v = F.col(vec_col)
    length = F.size(v) > 0 if dim is None else F.size(v) == dim
    return df.filter(v.isNotNull() & length & ~F.exists(v, lambda x: x.isNull()))


def left_out(index: DataFrame, vec_col: str, dim: int) -> DataFrame:
    """Rows of the index that no search of ``dim`` numbers can score."""
    kept = F.size(vec_col) == dim
    sound = F.col(vec_col).isNotNull() & kept & ~F.exists(vec_col, lambda x: x.isNull())
    return index.filter(~F.coalesce(sound, F.lit(False)))


def _top(hits: DataFrame, query_id: str, id_col: str, k: int) -> DataFrame:
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), F.col(id_col).asc())
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _hit_schema(index: DataFrame, queries: DataFrame, id_col: str, query_id: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(id_col, index.schema[id_col].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


@dataclass(frozen=True)
class QuerySlice:
    """Queries that are sent to the tasks together: Arrow ids and a float matrix."""

    ids: pa.Array
    matrix: np.ndarray


def query_slices(queries: DataFrame, query_id: str, query_vec: str,
                 max_bytes: int = MAX_QUERY_BYTES) -> Iterator[QuerySlice]:
    """The queries in slices of about ``max_bytes``; all have the length of the first ones."""
    clean = _clean(queries, query_vec).select(query_id, query_vec)
    shape = clean.agg(F.sum(F.size(query_vec) * 8), F.min(F.size(query_vec)), F.max(F.size(query_vec))).first()
    if shape[0] is None:
        return
    if shape[1] != shape[2]:
        raise ValueError(f"query vectors of {shape[1]} and of {shape[2]} numbers")
    count = max(1, -(-shape[0] // max(max_bytes, 1)))
    part = F.pmod(F.xxhash64(query_id), F.lit(count))
    for n in range(count):
        held = (clean if count == 1 else clean.filter(part == n)).toArrow()
        if held.num_rows:
            yield QuerySlice(held.column(query_id).combine_chunks(), _matrix(held.column(query_vec)))


def similarity_topk(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str,
    vec_col: str,
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    cols: Sequence[str] = (),
    metric: str = "cosine",
    max_query_bytes: int = MAX_QUERY_BYTES,
    display: DataFrame | None = None,
) -> DataFrame:
    """The k nearest index rows of every query: (query id, id, score, rank, cols).

    ``cols`` are fetched from ``display`` (by the same id; the index itself by
    default) after the search.  Index rows whose vector has another length
    than the queries are left out (``left_out`` lists them).
    """
    if metric not in ("cosine", "dot"):
        raise ValueError(f"unknown metric {metric!r}")
    schema = _hit_schema(index, queries, id_col, query_id)
    found = []
    for part in query_slices(queries, query_id, query_vec, max_query_bytes):
        vectors = _clean(index, vec_col, part.matrix.shape[1]).select(id_col, vec_col)
        found.append(_search(vectors, part, k, id_col, vec_col, schema, metric == "cosine"))
    hits = _top(_all(index, found, schema), query_id, id_col, k)
    return with_columns(hits, index if display is None else display, id_col, cols)


def _all(index: DataFrame, found: list[DataFrame], schema: T.StructType) -> DataFrame:
    return reduce(DataFrame.union, found) if found else index.sparkSession.createDataFrame([], schema)


def with_columns(hits: DataFrame, display: DataFrame, id_col: str, cols: Sequence[str],
                 max_bytes: int = MAX_QUERY_BYTES) -> DataFrame:
    """Fetch display columns for the few hits instead of carrying them through the scoring.

    The hits are written once and counted; while their ids are small the
    display table is scanned with a semi join and stays where it is, and only
    the rows of hits are joined.  A hit without a display row stays, with
    NULLs.
    """
    cols = [c for c in cols if c != id_col]
    if not cols:
        return hits
    held = materialize(hits, "hits")
    ids = held.select(id_col).distinct()
    if held.count() * 64 <= max_bytes:
        ids = F.broadcast(ids)
    wanted = display.select(id_col, *cols).join(ids, id_col, "left_semi")
    return held.join(wanted, id_col, "left").select(*held.columns, *cols)


def _search(vectors: DataFrame, part: QuerySlice, k: int, id_col: str, vec_col: str, schema: T.StructType,
            unit: bool, cell_col: str | None = None, cells_of: list[np.ndarray] | None = None) -> DataFrame:
    names = schema.fieldNames()
    shared = vectors.sparkSession.sparkContext.broadcast(
        (part.ids, _unit(part.matrix) if unit else part.matrix, cells_of))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix, wanted = shared.value
        best = _Best(matrix, k, unit)
        for batch in batches:
            if not batch.num_rows:
                continue
            allowed = lambda _: None
            if wanted is not None:
                cells = batch.column(cell_col).to_numpy(zero_copy_only=False)
                allowed = lambda j: np.flatnonzero(np.isin(cells, wanted[j]))
            best.add(batch.column(id_col), _matrix(batch.column(vec_col)), allowed)
        yield from best.rows(query_ids, names)

    return vectors.mapInArrow(search, schema)


# --- approximate search ---------------------------------------------------


def hyperplanes(dim: int, bits: int, seed: int = 7) -> np.ndarray:
    """Random directions; the signs of the products with them name a cell."""
    return np.random.default_rng(seed).standard_normal((bits, dim))


def cell_numbers(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    signs = (vectors @ planes.T) >= 0
    return signs.astype(np.int64) @ (1 << np.arange(len(planes), dtype=np.int64))


def with_cells(df: DataFrame, id_col: str, vec_col: str, planes: np.ndarray, out: str = "cell",
               cols: Sequence[str] = ()) -> DataFrame:
    """Add the cell of every vector: the number made of the signs."""
    fields = [c for c in dict.fromkeys([id_col, vec_col, *cols])]
    source = _clean(df, vec_col).select(*fields)
    schema = T.StructType([*source.schema.fields, T.StructField(out, T.IntegerType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = cell_numbers(_matrix(batch.column(vec_col)), planes)
                yield batch.append_column(out, pa.array(cells, pa.int32()))

    return source.mapInArrow(label, schema)


def similarity_approx(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    planes: np.ndarray,
    id_col: str,
    vec_col: str,
    radius: int = 1,
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    cell_col: str = "cell",
    cols: Sequence[str] = (),
    max_query_bytes: int = MAX_QUERY_BYTES,
) -> DataFrame:
    """Nearest rows among the cells within ``radius`` sign flips of the query.

    ``index`` carries ``cell_col`` (``with_cells``); stored partitioned by it,
    only the probed cells are read.  A query whose cells hold fewer than k
    rows widens its radius until they do, so no query comes back short.  Cells
    only select rows inside the scoring tasks: nothing is grouped by cell, so
    a cell holding a third of the index costs no more than its share.  Query
    sets of any size are searched in the same way, slice by slice.
    """
    if not 0 < len(planes) < 31:
        raise ValueError("between 1 and 30 planes")
    schema = _hit_schema(index, queries, id_col, query_id)
    # At most 2 ** len(planes) counts.
    held = {r[cell_col]: r["count"] for r in index.groupBy(cell_col).count().collect()}
    found = []
    for part in query_slices(queries, query_id, query_vec, max_query_bytes):
        probes = _probe_masks(cell_numbers(part.matrix, planes), held, len(planes), radius, k)
        asked = sorted({int(c) for mask in probes for c in mask})
        probed = _clean(index, vec_col, part.matrix.shape[1]).filter(F.col(cell_col).isin(asked))
        found.append(_search(probed.select(id_col, vec_col, cell_col), part, k, id_col, vec_col, schema, True,
                             cell_col, [np.array(sorted(p)) for p in probes]))
    return with_columns(_top(_all(index, found, schema), query_id, id_col, k), index, id_col, cols)


def _probe_masks(own: np.ndarray, held: dict[int, int], bits: int, radius: int, k: int) -> list[set[int]]:
    """Cells each query reads: within ``radius`` flips, widened until they hold k rows."""
    cells = np.array(sorted(held), dtype=np.int64)
    counts = np.array([held[c] for c in cells], dtype=np.int64)
    out = []
    for cell in own:
        flips = np.array([int(x).bit_count() for x in cells ^ cell])
        reach = radius
        while counts[flips <= reach].sum() < k and reach < bits:
            reach += 1
        out.append({int(c) for c in cells[flips <= reach]})
    return out


def recall(approx: DataFrame, exact: DataFrame, query_id: str, id_col: str) -> DataFrame:
    """Share of the exact hits that the approximate search found."""
    found = approx.select(query_id, id_col, F.lit(1).alias("_hit"))
    return exact.select(query_id, id_col).join(found, [query_id, id_col], "left").agg(
        F.avg(F.coalesce("_hit", F.lit(0))).alias("recall")
    )


def centroids(df: DataFrame, group: Sequence[str], vec_col: str, out: str = "query_vec") -> DataFrame:
    """Mean vector per group: one aggregate over whole vectors, combined before the shuffle."""
    mean = Summarizer.mean(array_to_vector(F.col(vec_col).cast("array<double>")))
    return df.groupBy(*group).agg(vector_to_array(mean).alias(out))
