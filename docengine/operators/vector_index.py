"""A stored index of vectors in lists around trained centroids, and searches that read little of it.

``build_index`` trains the centroids (MLlib k-means), puts every vector into
the list of its nearest one and writes a table partitioned by list and sorted
by id inside.  Beside its vector a row has a code of four bits a dimension for
what the centroid leaves, and the length of what the code leaves.  Parquet
keeps the columns apart, so a scan of codes reads a sixth of the vectors' bytes.

Scores are cosines.  With c the centroid, r the largest distance from it in
its list, v' the vector that a code stands for and e its distance from v, all
on unit vectors, no score of a list is above ``q.c + r`` and each is within e
of ``q.v'``.  ``search`` reads the lists nearest to a query first, then every
list whose bound reaches the k-th best score so far, by codes; rows whose
upper bound reaches the k-th best lower bound are scored by their vectors.
The result is exact.  With ``probes`` only so many lists are read for each
query; ``build_index`` measures how many a wished recall takes.

``search_join`` is for query sets too large to be sent out: queries and index
meet by list, in tiles, and the index is read once whatever the query set.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.operators.similarity import (
    MAX_QUERY_BYTES, QUERY_SLICE, SCORE_DIGITS, QuerySlice, _all, _best, _clean, _hit_schema, _id_rank, _matrix, _top,
    _unit, query_slices, with_columns,
)
from docengine.runtime import materialize

MAX_LISTS = 4096
# Vectors that centroids are trained on at most, those with the smallest hashes of their ids.
TRAINED_ON = 1 << 16
# Vectors of the index, by the same order, that the number of probed lists is measured with.
MEASURED_WITH = 256
LEVELS = 15  # steps of a code
TILE = 512  # vectors of a list that meet a tile of queries at a time
# With ``probes`` the product of a query and what a code leaves is taken to be within so many of its deviations.
DEVIATIONS = 3
# Beyond rounding of float sums and of the scores that are compared.
SLACK = 2e-6


@dataclass(frozen=True)
class VectorIndex:
    """An opened index: its table, and what is known of its lists."""

    table: DataFrame          # list, id, code, step, off, norm, vector
    centroids: np.ndarray
    radii: np.ndarray
    counts: np.ndarray
    probes: int               # lists per query that reach the recall it was built for

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]


def _reach(unit: np.ndarray, centroids: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible score of each query in each list."""
    near, spread = unit @ centroids.T, radii * np.linalg.norm(unit, axis=1, keepdims=True) + SLACK
    return near - spread, near + spread


@dataclass
class Cost:
    """What searches have read: codes and vectors, summed over their queries."""

    rows: int
    dim: int
    queries: int = 0
    codes: int = 0
    vectors: int = 0

    @property
    def share(self) -> float:
        """Bytes of codes and vectors read for a query, as a share of the bytes of all vectors."""
        whole = 4 * self.dim
        read = self.codes * (-(-self.dim // 2) + 8) + self.vectors * whole
        return read / max(1, self.queries * self.rows * whole)


# --- building ---------------------------------------------------------------


def _packed(levels: np.ndarray) -> np.ndarray:
    """Codes of 0 to 15, two to a byte."""
    if levels.shape[1] % 2:
        levels = np.pad(levels, ((0, 0), (0, 1)))
    return (levels[:, ::2] | levels[:, 1::2] << 4).astype(np.uint8)


def _unpacked(codes: np.ndarray, dim: int) -> np.ndarray:
    out = np.empty((len(codes), 2 * codes.shape[1]), np.uint8)
    out[:, ::2], out[:, 1::2] = codes & 15, codes >> 4
    return out[:, :dim]


def _up(x: np.ndarray) -> np.ndarray:
    """Lengths as 32-bit floats that are not below them."""
    return np.nextafter((x * (1 + 1e-6)).astype(np.float32), np.float32(np.inf))


def encoded(left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, step, off) of what centroids leave of unit vectors; off: distance of code and vector."""
    step = (2 / LEVELS * np.abs(left).max(axis=1)).astype(np.float32)
    scale = np.where(step > 0, step, 1).astype(np.float64)[:, None]
    levels = np.clip(np.rint(left / scale + LEVELS / 2), 0, LEVELS).astype(np.uint8)
    off = np.linalg.norm(left - decoded(levels, step), axis=1)
    return _packed(levels), step, _up(off)


def decoded(levels: np.ndarray, step: np.ndarray) -> np.ndarray:
    return (levels - LEVELS / 2) * step.astype(np.float64)[:, None]


def _trained(vectors: DataFrame, id_col: str, vec_col: str, lists: int, iterations: int, seed: int) -> np.ndarray:
    """Centroids of unit vectors, from a bounded sample."""
    norm = F.sqrt(F.aggregate(vec_col, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    unit = F.when(norm > 0, F.transform(vec_col, lambda x: x / norm)).otherwise(
        F.transform(vec_col, lambda x: F.lit(0.0)))
    chosen = vectors.orderBy(F.xxhash64(id_col), id_col).limit(TRAINED_ON)
    sample = materialize(chosen.select(unit.alias("unit")), "trained-on").select(array_to_vector("unit").alias("features"))
    model = KMeans(k=lists, maxIter=iterations, seed=seed, initMode="random").fit(sample)
    return np.array(model.clusterCenters())


def build_index(
    spark: SparkSession,
    vectors: DataFrame,
    path: str,
    id_col: str,
    vec_col: str,
    lists: int | None = None,
    recall: float | None = None,
    k: int = 5,
    iterations: int = 6,
    seed: int = 7,
) -> VectorIndex:
    """Write the index of ``vectors`` to ``path`` and open it.

    By default as many lists as the root of the number of rows.  With
    ``recall`` the probes that reach it for k rows are measured and stored.
    Rows whose vector cannot be scored are left out (``similarity.left_out``).
    """
    vectors = _clean(vectors, vec_col).select(id_col, vec_col)
    shape = vectors.agg(F.count("*"), F.min(F.size(vec_col)), F.max(F.size(vec_col))).first()
    if shape[1] != shape[2]:
        raise ValueError(f"vectors of {shape[1]} and of {shape[2]} numbers")
    if not shape[0]:
        raise ValueError("no vectors")
    lists = min(MAX_LISTS, lists or max(1, round(shape[0] ** 0.5)))
    centroids = _trained(vectors, id_col, vec_col, lists, iterations, seed)
    schema = T.StructType([
        T.StructField("list", T.IntegerType()), T.StructField("id", vectors.schema[id_col].dataType),
        T.StructField("code", T.BinaryType()), T.StructField("step", T.FloatType()),
        T.StructField("off", T.FloatType()), T.StructField("away", T.FloatType()),
        T.StructField("norm", T.DoubleType()), T.StructField("vector", vectors.schema[vec_col].dataType)])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (centroids ** 2).sum(axis=1) / 2
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(1))
            unit = _unit(m)
            own = np.argmax(unit @ centroids.T - half, axis=1)
            left = unit - centroids[own]
            codes, step, off = encoded(left)
            yield pa.RecordBatch.from_arrays([
                pa.array(own, pa.int32()), batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()),
                pa.array(step), pa.array(off), pa.array(_up(np.linalg.norm(left, axis=1))),
                pa.array(np.linalg.norm(m, axis=1)), batch.column(1)], names=schema.fieldNames())

    # Rebalanced: a list that holds a third of the rows is written by several tasks, small ones share one.
    (vectors.mapInArrow(listed, schema).hint("rebalance", "list").sortWithinPartitions("list", "id")
     .write.partitionBy("list").parquet(f"{path}/rows"))
    held = spark.read.schema(schema).parquet(f"{path}/rows").groupBy("list").agg(F.count("*").alias("n"), F.max("away").alias("r"))
    held = {row["list"]: (row["n"], row["r"]) for row in held.collect()}  # MAX_LISTS rows at most
    about = [(n, [float(x) for x in c], *held.get(n, (0, 0.0))) for n, c in enumerate(centroids)]
    columns = "list int, centroid array<double>, count long, radius double"
    spark.createDataFrame(about, columns).coalesce(1).write.parquet(f"{path}/lists")
    probes = lists if recall is None else _probes_for(_opened(spark, path, schema, lists), recall, k)
    spark.createDataFrame([(probes, schema.json())], "probes int, schema string").write.parquet(f"{path}/about")
    return _opened(spark, path, schema, probes)


def _opened(spark: SparkSession, path: str, schema: T.StructType, probes: int) -> VectorIndex:
    about = spark.read.parquet(f"{path}/lists").orderBy("list").collect()  # MAX_LISTS rows at most
    table = spark.read.schema(schema).parquet(f"{path}/rows")
    return VectorIndex(table, np.array([r["centroid"] for r in about]), np.array([r["radius"] for r in about]),
                       np.array([r["count"] for r in about]), probes)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """A written index; what says that it is whole is written last."""
    about = spark.read.parquet(f"{path}/about").first()
    return _opened(spark, path, T.StructType.fromJson(json.loads(about["schema"])), about["probes"])


def _probes_for(index: VectorIndex, recall: float, k: int) -> int:
    """Fewest nearest lists that hold a share ``recall`` of the k nearest others of a sample's rows."""
    sample = index.table.orderBy(F.xxhash64("id"), "id").limit(MEASURED_WITH).select(
        F.col("id").alias("query_id"), F.col("vector").alias("query_vec"))
    sample = materialize(sample, "measured-with")
    hits = search(index, sample, k + 1)
    hits = hits.join(index.table.select("id", "list"), "id").filter(F.col("id") != F.col("query_id"))
    rows = hits.join(sample, "query_id").select("query_vec", "list").collect()  # MEASURED_WITH * (k + 1) at most
    if not rows:
        return len(index.centroids)
    near = _unit(np.array([r["query_vec"] for r in rows], np.float64)) @ index.centroids.T
    own = near[np.arange(len(rows)), [r["list"] for r in rows]]
    place = np.sort((near > own[:, None]).sum(axis=1)) + 1
    return int(place[min(len(place), int(np.ceil(recall * len(place)))) - 1])


# --- search -----------------------------------------------------------------


def _scan(index: VectorIndex, part: QuerySlice, k: int, wanted: np.ndarray, floor: np.ndarray, sure: float) -> DataFrame:
    """(q, list, id, lower, upper): of each task, the rows that can be among a query's k best by their codes.

    wanted: queries x lists; floor: score that a row has to be able to reach;
    sure: part of a code's distance from its vector that a score can be off by.
    """
    lists = np.flatnonzero(wanted.any(axis=0)).tolist()
    source = index.table.filter(F.col("list").isin(lists)).select("id", "code", "step", "off", "list")
    schema = T.StructType([
        T.StructField("q", T.IntegerType()), T.StructField("list", T.IntegerType()), source.schema["id"],
        T.StructField("lower", T.DoubleType()), T.StructField("upper", T.DoubleType())])
    shared = source.sparkSession.sparkContext.broadcast((_unit(part.matrix), wanted, floor, index.centroids))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, wanted, floor, centroids = shared.value
        floor = floor.copy()
        best = [np.zeros(0)] * len(unit)  # the k best lower bounds of each query
        held: list[list] = [[] for _ in unit]
        for batch in batches:
            owner = batch.column("list").to_numpy()
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(owner), -1)
            step, off = batch.column("step").to_numpy(), batch.column("off").to_numpy().astype(np.float64) * sure + SLACK
            for n in np.unique(owner).tolist():
                rows, asking = np.flatnonzero(owner == n), np.flatnonzero(wanted[:, n])
                near = centroids[n] + decoded(_unpacked(codes[rows], centroids.shape[1]), step[rows])
                for a in range(0, len(asking), QUERY_SLICE):
                    queries = asking[a:a + QUERY_SLICE]
                    for q, scores in zip(queries.tolist(), unit[queries] @ near.T):
                        lower, upper = scores - off[rows], scores + off[rows]
                        best[q] = -np.sort(-np.concatenate([best[q], lower]))[:k]
                        if len(best[q]) == k:
                            floor[q] = max(floor[q], best[q][-1])
                        good = np.flatnonzero(upper >= floor[q])
                        if len(good):
                            held[q].append((lower[good], upper[good], np.full(len(good), n),
                                            batch.column("id").take(pa.array(rows[good]))))
        for q, found in enumerate(held):
            if found:
                lower, upper, owner = (np.concatenate([f[c] for f in found]) for c in range(3))
                good = np.flatnonzero(upper >= floor[q])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(good), q), pa.int32()), pa.array(owner[good], pa.int32()),
                    pa.concat_arrays([f[3] for f in found]).take(pa.array(good)), pa.array(lower[good]),
                    pa.array(upper[good])], names=schema.fieldNames())

    return source.mapInArrow(scan, schema)


def _floors(candidates: DataFrame, k: int, n_queries: int) -> np.ndarray:
    """The k-th best lower bound of each query; below all scores for queries with fewer rows."""
    kth = candidates.groupBy("q").agg(F.slice(F.sort_array(F.collect_list("lower"), asc=False), k, 1).alias("kth"))
    floor = np.full(n_queries, -2.0)
    for row in kth.collect():  # a row per query of the slice
        if row["kth"]:
            floor[row["q"]] = row["kth"][0]
    return floor


def _rescored(index: VectorIndex, part: QuerySlice, candidates: DataFrame, schema: T.StructType) -> DataFrame:
    """Exact scores of candidates; only their lists are opened."""
    lists = [r["list"] for r in candidates.select("list").distinct().collect()]  # MAX_LISTS at most
    few = candidates.select("q", "list", "id")
    if candidates.count() * 64 <= MAX_QUERY_BYTES:
        few = F.broadcast(few)
    rows = index.table.filter(F.col("list").isin(lists)).select("list", "id", "vector").join(few, ["list", "id"])
    shared = rows.sparkSession.sparkContext.broadcast((part.ids, _unit(part.matrix)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, unit = shared.value
        for batch in batches:
            if batch.num_rows:
                q = batch.column("q").to_numpy()
                scores = (unit[q] * _unit(_matrix(batch.column("vector")))).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(batch.column("q")), batch.column("id"), pa.array(np.round(scores, SCORE_DIGITS) + 0.0)],
                    names=schema.fieldNames())

    return rows.select("q", "id", "vector").mapInArrow(score, schema)


def search(
    index: VectorIndex,
    queries: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    probes: int | None = None,
    max_query_bytes: int = MAX_QUERY_BYTES,
    cost: Cost | None = None,
) -> DataFrame:
    """(query id, id, score, rank): the k nearest rows of every query, ties by id.

    Exact, or within the ``probes`` lists nearest to each query, and more
    until they hold k rows, with rows chosen by what their codes probably
    leave.  Queries are sent out in slices of bytes; what a
    search read is added to ``cost``.
    """
    schema = _hit_schema(index.table, queries, "id", query_id)
    found = []
    for part in query_slices(queries, query_id, query_vec, max_query_bytes):
        if part.matrix.shape[1] != index.dim:
            raise ValueError(f"queries of {part.matrix.shape[1]} numbers, an index of {index.dim}")
        unit = _unit(part.matrix)
        near = np.argsort(-(unit @ index.centroids.T), axis=1, kind="stable")
        before = np.cumsum(index.counts[near], axis=1) - index.counts[near]  # rows in nearer lists
        place = np.argsort(near, axis=1)
        first = np.take_along_axis(before < k, place, axis=1)
        floor = np.full(len(unit), -2.0)
        if probes is None:
            wanted, sure = np.ones_like(first), 1.0
        else:
            wanted, sure = first | (place < probes), min(1.0, DEVIATIONS / index.dim ** 0.5)
        candidates = materialize(_scan(index, part, k, first, floor, sure), "candidates")
        floor = _floors(candidates, k, len(unit))
        rest = wanted & ~first & (_reach(unit, index.centroids, index.radii)[1] >= floor[:, None]) & (index.counts > 0)
        if rest.any():
            candidates = candidates.union(materialize(_scan(index, part, k, rest, floor, sure), "candidates"))
            floor = _floors(candidates, k, len(unit))
        least = F.element_at(F.lit([float(x) for x in floor]), F.col("q") + 1)
        candidates = materialize(candidates.filter(F.col("upper") >= least), "candidates")
        if cost is not None:
            cost.queries += len(unit)
            cost.codes += int(((first | rest) @ index.counts).sum())
            cost.vectors += candidates.count()
        found.append(_rescored(index, part, candidates, schema))
    return _top(_all(index.table, found, schema), query_id, "id", k)


# --- query sets as large as the index ---------------------------------------


def _tiles(index: VectorIndex, queries: DataFrame, query_id: str, query_vec: str, k: int) -> DataFrame:
    """(list, query_ids, queries, floors): the queries of a batch that a list can answer."""
    clean = _clean(queries, query_vec, index.dim).select(query_id, query_vec)
    schema = T.StructType([
        T.StructField("list", T.IntegerType()), T.StructField("query_ids", T.ArrayType(queries.schema[query_id].dataType)),
        T.StructField("queries", T.BinaryType()), T.StructField("floors", T.BinaryType())])
    centroids, radii, counts = index.centroids, index.radii, index.counts

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, TILE):
                some = batch.slice(a, TILE)
                unit = _unit(_matrix(some.column(1)))
                # Every row of a list scores at least this; lists that hold k rows set a floor.
                least, most = _reach(unit, centroids, radii)
                order = np.argsort(-least, axis=1, kind="stable")
                enough = np.argmax(np.cumsum(counts[order], axis=1) >= k, axis=1)
                floor = np.take_along_axis(least, np.take_along_axis(order, enough[:, None], 1), 1)[:, 0]
                if counts.sum() < k:
                    floor[:] = -2
                asked = (most >= floor[:, None]) & (counts > 0)
                for n in np.flatnonzero(asked.any(axis=0)).tolist():
                    rows = np.flatnonzero(asked[:, n])
                    ids = some.column(0).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([n], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), ids),
                        pa.array([unit[rows].tobytes()], pa.binary()), pa.array([floor[rows].tobytes()], pa.binary())],
                        names=schema.fieldNames())

    return clean.mapInArrow(tiled, schema)


def _blocks(index: VectorIndex) -> DataFrame:
    """(list, ids, vectors): rows of a list in blocks of ``TILE``, as they are read."""
    source = index.table.select("id", "vector", "list")
    schema = T.StructType([
        T.StructField("list", T.IntegerType()), T.StructField("ids", T.ArrayType(index.table.schema["id"].dataType)),
        T.StructField("vectors", T.BinaryType())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = batch.column(2).to_numpy()
            for n in np.unique(owner).tolist():
                of_list = np.flatnonzero(owner == n)
                for a in range(0, len(of_list), TILE):
                    rows = pa.array(of_list[a:a + TILE])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([n], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), batch.column(0).take(rows)),
                        pa.array([_matrix(batch.column(1).take(rows)).tobytes()], pa.binary())], names=schema.fieldNames())

    return source.mapInArrow(blocks, schema)


def search_join(index: VectorIndex, queries: DataFrame, k: int, query_id: str = "query_id",
                query_vec: str = "query_vec") -> DataFrame:
    """``search`` without a word to the driver or to all tasks about the queries: same rows, exact.

    Tiles of queries meet blocks of the lists that can hold one of their k
    nearest, by list, so a large list is split where the join is skewed; a
    meeting hands on k rows per query at most.
    """
    schema = _hit_schema(index.table, queries, "id", query_id)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                query_ids, ids = batch.column("query_ids")[row].values, batch.column("ids")[row].values
                unit = np.frombuffer(batch.column("queries")[row].as_py()).reshape(len(query_ids), -1)
                floor = np.frombuffer(batch.column("floors")[row].as_py())
                vectors = _unit(np.frombuffer(batch.column("vectors")[row].as_py()).reshape(len(ids), -1))
                rank = _id_rank(ids)
                scores = np.round(unit @ vectors.T, SCORE_DIGITS) + 0.0
                kept = [(q, b[s[b] >= floor[q] - SLACK]) for q, s in enumerate(scores) for b in [_best(s, rank, k)]]
                q = np.repeat([q for q, _ in kept], [len(b) for _, b in kept]).astype(np.int64)
                at = np.concatenate([b for _, b in kept]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [query_ids.take(pa.array(q)), ids.take(pa.array(at)), pa.array(scores[q, at])],
                    names=schema.fieldNames())

    met = _blocks(index).join(_tiles(index, queries, query_id, query_vec, k), "list")
    return _top(met.select("query_ids", "queries", "floors", "ids", "vectors").mapInArrow(meet, schema), query_id, "id", k)


def show(hits: DataFrame, display: DataFrame, id_col: str, cols: Sequence[str] = ()) -> DataFrame:
    """Hits with the columns of ``display``, under the name that ids have there."""
    return with_columns(hits.withColumnRenamed("id", id_col), display, id_col, cols)
