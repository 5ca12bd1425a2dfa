"""Exact ranked search by ball trees over sparse term vectors.

A document is the vector of its integer term scores, a query the set of its
terms, the score their inner product.  Only terms that some query asks for can
add to one, so vectors are kept in those terms; they are ordered by the sides
of some planes that they lie on, which brings like ones together, and cut into
blocks of ``BLOCK`` documents.  Each block is a ball tree: every node has the
centroid of its documents and their largest distance from it.  A query's score
in a node is at most

    q . centroid + |q| * radius

by the inequality of Cauchy and Schwarz.  The inequality also holds for each
group of terms by itself, so a node has a radius for each of ``GROUPS`` groups
and the sum over the groups is used where it is smaller: a node without the
rare terms of a query then gets nothing for its spread in other rare terms.
Radii and bounds are rounded up by more than their floating point error.

The search is best-first: the node of the highest bound is opened next, until
no bound reaches the query's k-th best score; leaves are scored in 64-bit
integers.  A first pass opens the best leaf of each block alone: the k-th best
of those scores, over all tasks, is where the second pass begins.  A task
hands on k rows per query at most, and of all rows the k best are kept.

The index is written once and read by both passes.  Queries go to the tasks in
slices of ``SLICE_BYTES`` of text, with an index for each slice.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docengine.llm.common import Scratch, batch, mix, prepare, shards, text_column, texts
from docengine.llm.decontamination import words

TOP = 50
BLOCK = 4096  # documents in a tree
ENTRIES = 1 << 19  # terms of documents in a tree, but for one longer document
LEAF = 32  # documents in a leaf at most
BY_QUERY, BY_COUNT = 384, 128  # groups of terms that few queries hold, and of the others
GROUPS = BY_QUERY + BY_COUNT
FEW = 3  # queries
SLICE_BYTES = 8 << 20
QUERIES = 256  # whose bounds a task holds at a time
DIRECTIONS = 16  # of the sketches that trees are split by
EPS = float(np.finfo(np.float64).eps)

VECTOR = "doc_id long, n long, terms array<int>, counts array<int>"
_VECTOR = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                     ("counts", pa.list_(pa.int32()))])
SCORED = "side int, doc_id long, terms array<int>, scores array<long>"
_SCORED = pa.schema([("side", pa.int32()), ("doc_id", pa.int64()), ("terms", pa.list_(pa.int32())),
                     ("scores", pa.list_(pa.int64()))])
_FIELDS = {"ids": np.int64, "known": np.uint8, "node_docs": np.int32, "c_bounds": np.int64, "c_terms": np.int32,
           "c_values": np.float64, "radii": np.float64, "whole": np.float64, "leaf_bounds": np.int64,
           "leaf_terms": np.int32, "leaf_docs": np.int32, "leaf_scores": np.int64}
TREE = ", ".join(f"{name} binary" for name in _FIELDS)
_TREE = pa.schema([(name, pa.binary()) for name in _FIELDS])
FOUND = "query int, doc_id long, score long"
_FOUND = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets from 0) of a list column."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(), offsets - offsets[0]


def vectors(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): number of terms of each whole text, and how often the asked ones stand in it."""
    size = max(1, len(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            keys, lengths = [], []
            for k, text in enumerate(text_column(record)):
                found = words(text)
                lengths.append(len(found))
                ids = np.fromiter(map(terms.get, found, repeat(-1)), np.int64, len(found))
                own, times = np.unique(ids[ids >= 0], return_counts=True)
                keys.append((own + k * size, times))
            key = np.concatenate([k for k, _ in keys]) if keys else np.zeros(0, np.int64)
            times = np.concatenate([t for _, t in keys]) if keys else np.zeros(0, np.int64)
            offsets = np.searchsorted(key, np.arange(len(lengths) + 1) * size)
            yield pa.RecordBatch.from_arrays([
                record.column(0), pa.array(lengths, pa.int64()), _lists(offsets, key % size, pa.int32()),
                _lists(offsets, times, pa.int32())], schema=_VECTOR)

    return docs.mapInArrow(run, VECTOR)


@dataclass
class Terms:
    """Weights of the asked terms, renumbered from rare to frequent, and the queries by them."""

    number: np.ndarray   # new number of a term
    weight: np.ndarray   # by new number
    group: np.ndarray    # by new number
    n_docs: int
    n_terms: int
    queries: list[np.ndarray]  # new numbers, ascending


def weighed(queries: list[list[int]], frequency: np.ndarray, n_docs: int, n_terms: int) -> Terms:
    order = np.lexsort((np.arange(len(frequency)), frequency))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    df = frequency[order].tolist()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in df], np.int64)
    asked = [np.unique(number[np.array(q, np.int64)]) for q in queries]
    holders = np.zeros(len(order), np.int64)
    first = np.zeros(len(order), np.int64)
    for k in range(len(asked) - 1, -1, -1):
        holders[asked[k]] += 1
        first[asked[k]] = k
    octave = np.array([min(BY_COUNT - 1, int(8 * math.log2(n_docs / f))) if 0 < f < n_docs else 0 for f in df], np.int64)
    group = np.where(holders > FEW, BY_QUERY + octave, first * BY_QUERY // max(1, len(asked)))
    return Terms(number, weight, group, n_docs, n_terms, asked)


def scored_vectors(vectors: DataFrame, terms: Terms) -> DataFrame:
    """(side, doc_id, terms, scores): the score that each asked term adds; documents without any go.

    side: on which sides of the planes of ``_sketches`` the vector lies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            ids, offsets = _flat(record.column(2))
            tf = _flat(record.column(3))[0].astype(np.int64)
            m = [50 + 50 * n * terms.n_docs // max(1, terms.n_terms) for n in record.column(1).to_pylist()]
            owner = np.repeat(np.arange(record.num_rows), np.diff(offsets))
            ids = terms.number[ids]
            score = terms.weight[ids] * (10 ** 9 * tf // (1000 * tf + 20 * np.array(m, np.int64)[owner]))
            order = np.lexsort((ids, owner))
            order = order[score[order] > 0]
            owner, ids, score = owner[order], ids[order], score[order]
            held, first = np.unique(owner, return_index=True)
            offsets = np.append(first, len(owner))
            sides = _sketches(ids, score, offsets) > 0
            yield pa.RecordBatch.from_arrays([
                pa.array(sides @ (1 << np.arange(DIRECTIONS)), pa.int32()), record.column(0).take(pa.array(held)),
                _lists(offsets, ids, pa.int32()), _lists(offsets, score, pa.int64())], schema=_SCORED)

    return vectors.mapInArrow(run, SCORED)


def _sketches(ids: np.ndarray, scores: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A short vector for each document whose distances follow those of the whole ones."""
    bits = mix(ids.astype(np.uint64) + np.uint64(1))
    out = np.zeros((len(offsets) - 1, DIRECTIONS))
    owner = np.repeat(np.arange(len(out)), np.diff(offsets))
    for k in range(DIRECTIONS):
        sign = (bits >> np.uint64(3 * k)).astype(np.int64) & 1
        out[:, k] = np.bincount(owner, (2 * sign - 1) * scores, minlength=len(out))
    return out


def _halved(points: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order of the documents, bounds of the nodes of each level in it): halves along the longest extent."""
    order, bounds = np.arange(len(points)), [np.array([0, len(points)])]
    for _ in range(depth):
        edges = [0]
        for a, z in zip(bounds[-1][:-1].tolist(), bounds[-1][1:].tolist()):
            own = points[order[a:z]]
            far = own[np.argmax(((own - own.mean(axis=0)) ** 2).sum(axis=1))]
            other = own[np.argmax(((own - far) ** 2).sum(axis=1))]
            order[a:z] = order[a:z][np.argsort(own @ (other - far), kind="stable")]
            edges += [(a + z) // 2, z]
        bounds.append(np.array(edges))
    return order, bounds


def tree(doc_ids: list, ids: np.ndarray, scores: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> dict:
    """The ball tree of a block; node k has the children 2k+1 and 2k+2."""
    n = len(doc_ids)
    depth = max(0, math.ceil(math.log2(n / LEAF)))
    order, levels = _halved(_sketches(ids, scores, offsets), depth)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    owner = np.repeat(place, np.diff(offsets))
    size = int(ids.max()) + 1
    values = scores.astype(np.float64)
    squares = np.bincount(owner * GROUPS + group[ids], values ** 2, minlength=n * GROUPS).reshape(n, GROUPS)
    held = np.bincount(owner, minlength=n)
    c_terms, c_values, c_counts, radii, whole = [], [], [], [], []
    for edges in levels:
        node = np.searchsorted(edges, owner, "right") - 1
        keys, entry = np.unique(node * size + ids, return_inverse=True)
        of_node, term = keys // size, keys % size
        docs_in = np.diff(edges)
        centroid = np.bincount(entry, values, minlength=len(keys)) / docs_in[of_node]
        spread = np.bincount(of_node * GROUPS + group[term], centroid ** 2,
                             minlength=len(docs_in) * GROUPS).reshape(-1, GROUPS)
        own = centroid[entry]
        apart = np.bincount(owner * GROUPS + group[ids], (values - own) ** 2 - own ** 2,
                            minlength=n * GROUPS).reshape(n, GROUPS)
        of_doc = np.repeat(np.arange(len(docs_in)), docs_in)
        n_terms = np.bincount(of_node, minlength=len(docs_in))
        error = 8 * EPS * (n_terms[of_doc] + 2 * held + 8)[:, None] * (spread[of_doc] + 2 * squares)
        apart = np.maximum(spread[of_doc] + apart, 0) + error
        radii.append(np.sqrt(np.maximum.reduceat(apart, edges[:-1], axis=0)))
        whole.append(np.sqrt(np.maximum.reduceat(apart.sum(axis=1), edges[:-1])))
        c_terms.append(term)
        c_values.append(centroid)
        c_counts.append(n_terms)
    # ``entry`` and ``keys`` are those of the leaves now.
    by_term = np.argsort(entry, kind="stable")
    return {
        "ids": np.array([0 if doc_ids[k] is None else doc_ids[k] for k in order.tolist()], np.int64),
        "known": np.array([doc_ids[k] is not None for k in order.tolist()], np.uint8),
        "node_docs": levels[-1], "c_bounds": np.concatenate([[0], np.cumsum(np.concatenate(c_counts))]),
        "c_terms": np.concatenate(c_terms), "c_values": np.concatenate(c_values),
        "radii": np.concatenate(radii), "whole": np.concatenate(whole),
        "leaf_bounds": np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(levels[-1]) - 1))]),
        "leaf_terms": ids[by_term], "leaf_docs": owner[by_term], "leaf_scores": scores[by_term],
    }


def index(scored: DataFrame, terms: Terms, parts: int) -> DataFrame:
    """One row per block: its ball tree.  A side that many documents lie on is split by their ids."""
    group = terms.group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, ids, scores, lengths, held = [], [], [], [], 0

        def built() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
            t = tree(doc_ids, np.concatenate(ids).astype(np.int64), np.concatenate(scores), offsets, group)
            return batch({name: [np.ascontiguousarray(t[name], kind).tobytes()] for name, kind in _FIELDS.items()}, _TREE)

        for record in batches:
            own, offsets = _flat(record.column(2))
            values, names = _flat(record.column(3))[0], record.column(1).to_pylist()
            a = 0
            while a < record.num_rows:
                z = int(np.searchsorted(offsets, offsets[a] + ENTRIES - held, "right")) - 1
                z = min(max(z, a + (not doc_ids)), a + BLOCK - len(doc_ids), record.num_rows)
                doc_ids += names[a:z]
                ids.append(own[offsets[a]:offsets[z]])
                scores.append(values[offsets[a]:offsets[z]])
                lengths.append(np.diff(offsets[a:z + 1]))
                held += int(offsets[z] - offsets[a])
                a = z
                if a < record.num_rows:
                    yield built()
                    doc_ids, ids, scores, lengths, held = [], [], [], [], 0
        if doc_ids:
            yield built()

    return (scored.repartitionByRange(parts, "side", "doc_id").sortWithinPartitions("side", "doc_id")
            .mapInArrow(run, TREE))


class _Best:
    """The k best (score, document) pairs of a query so far; ties by id, unknown ids last."""

    def __init__(self, k: int, least: int) -> None:
        self.k, self.least = k, max(1, least)  # lowest score that can still be among them
        self.scores, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        scores, ids, known = (np.concatenate([old, new[good]]) for old, new in
                              ((self.scores, scores), (self.ids, ids), (self.known, known)))
        best = np.lexsort((ids, 1 - known.astype(np.int8), -scores))[:self.k]
        self.scores, self.ids, self.known = scores[best], ids[best], known[best]
        if len(best) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


class _Queries:
    """The queries of a slice by term, in chunks of ``QUERIES``."""

    def __init__(self, terms: Terms) -> None:
        self.chunks = []
        for a in range(0, len(terms.queries), QUERIES):
            own = terms.queries[a:a + QUERIES]
            flat = np.concatenate(own)
            by = np.argsort(flat, kind="stable")
            holder = np.repeat(np.arange(len(own)), [len(q) for q in own])[by]
            first = np.searchsorted(flat[by], np.arange(len(terms.weight) + 1))
            counts = np.zeros((GROUPS, len(own)))
            np.add.at(counts, (terms.group[flat[by]], holder), 1)
            self.chunks.append((a, own, holder, first, np.sqrt(counts), np.sqrt([len(q) for q in own])))

    @staticmethod
    def bounds(chunk: tuple, t: dict) -> np.ndarray:
        """No query of a chunk scores more than this in a node: nodes x queries."""
        _, own, holder, first, roots, root = chunk
        n_nodes = len(t["whole"])
        node = np.repeat(np.arange(n_nodes), np.diff(t["c_bounds"]))
        n = first[t["c_terms"] + 1] - first[t["c_terms"]]
        used = n > 0
        n, start, node, value = n[used], first[t["c_terms"]][used], node[used], t["c_values"][used]
        at = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        dot = np.bincount(np.repeat(node, n) * len(own) + holder[at], np.repeat(value, n),
                          minlength=n_nodes * len(own)).reshape(n_nodes, len(own))
        spread = np.minimum(t["radii"] @ roots, t["whole"][:, None] * root)
        # Sums of as many positive numbers as a query has terms, and GROUPS more: rounded up.
        return (dot + spread) * (1 + EPS * (4 * GROUPS + 4 * root ** 2)) + 1


def _scores(t: dict, leaf: int, query: np.ndarray) -> tuple[np.ndarray, slice]:
    """Exact scores of the documents of a leaf, and which they are."""
    a, z = t["leaf_bounds"][leaf], t["leaf_bounds"][leaf + 1]
    docs = slice(t["node_docs"][leaf], t["node_docs"][leaf + 1])
    own = t["leaf_terms"][a:z]
    lo, hi = np.searchsorted(own, query, "left"), np.searchsorted(own, query, "right")
    n = hi - lo
    at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) + a
    scores = np.zeros(docs.stop - docs.start, np.int64)
    np.add.at(scores, t["leaf_docs"][at] - docs.start, t["leaf_scores"][at])
    return scores, docs


def _open(t: dict, bounds: np.ndarray, query: np.ndarray, best: _Best, probe: bool) -> int:
    """Best-first search of one tree; the number of leaves scored.  probe: of its best leaf alone."""
    inner = len(t["node_docs"]) - 2  # nodes above the leaves
    if probe:
        heap = [(-float(bounds[inner:].max()), inner + int(np.argmax(bounds[inner:])))]
    else:
        heap = [(-float(bounds[0]), 0)]
    opened = 0
    while heap and -heap[0][0] >= best.least:
        _, node = heapq.heappop(heap)
        if node < inner:
            for child in (2 * node + 1, 2 * node + 2):
                if bounds[child] >= best.least:
                    heapq.heappush(heap, (-float(bounds[child]), child))
            continue
        scores, docs = _scores(t, node - inner, query)
        best.add(scores, t["ids"][docs], t["known"][docs])
        opened += 1
    return opened


def search(trees: DataFrame, terms: Terms, least: list[int], k: int, probe: bool) -> DataFrame:
    """(query, doc_id, score): of each task, the k best documents per query that reach the query's ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _Queries(terms)
        best = [_Best(k, floor) for floor in least]
        for record in batches:
            for row in range(record.num_rows):
                t = {name: np.frombuffer(record.column(c)[row].as_py(), kind)
                     for c, (name, kind) in enumerate(_FIELDS.items())}
                t["radii"] = t["radii"].reshape(-1, GROUPS)
                for chunk in queries.chunks:
                    bounds = queries.bounds(chunk, t)
                    floors = np.array([b.least for b in best[chunk[0]:chunk[0] + len(chunk[1])]])
                    for q in np.flatnonzero(bounds[0] >= floors).tolist():
                        _open(t, bounds[:, q], chunk[1][q], best[chunk[0] + q], probe)
        for a in range(0, len(best), QUERIES):
            own = best[a:a + QUERIES]
            known = np.concatenate([b.known for b in own]) > 0
            yield batch({"query": np.repeat(np.arange(a, a + len(own)), [len(b.ids) for b in own]),
                         "doc_id": pa.array(np.concatenate([b.ids for b in own]), pa.int64(), mask=~known),
                         "score": np.concatenate([b.scores for b in own])}, _FOUND)

    return trees.mapInArrow(run, FOUND)


def _slice(docs: DataFrame, scratch: Scratch, name: str, texts_asked: list, k: int) -> DataFrame | None:
    numbers: dict[bytes, int] = {}
    queries = [[numbers.setdefault(w, len(numbers)) for w in words(t)] for t in texts_asked]
    held = [place for place, q in enumerate(queries) if q]
    if not held:
        return None
    found = scratch.write(vectors(docs, numbers), f"vectors-{name}")
    total = found.agg(F.sum((F.col("n") > 0).cast("long")).alias("docs"), F.sum("n").alias("terms")).first()
    frequency = np.zeros(len(numbers), np.int64)
    for row in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per asked term
        frequency[row["t"]] = row["count"]
    if not total["terms"]:
        return None
    terms = weighed([queries[place] for place in held], frequency, total["docs"], total["terms"])
    trees = scratch.write(index(scored_vectors(found, terms), terms, shards(docs.sparkSession)), f"trees-{name}")
    scratch.drop(f"vectors-{name}")
    best_first = Window.partitionBy("query").orderBy(F.desc("score"))
    least = [1] * len(held)
    tried = search(trees, terms, least, k, probe=True).withColumn("r", F.row_number().over(best_first))
    for row in tried.where(F.col("r") == k).collect():  # a row per query
        least[row["query"]] = row["score"]
    place = F.element_at(F.lit(held), F.col("query") + 1)
    hits = search(trees, terms, least, k, probe=False).select(place.alias("place"), "doc_id", "score")
    hits = scratch.write(hits, f"hits-{name}")
    scratch.drop(f"trees-{name}")
    return hits


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0.

    rank is 1 for the highest score; equal scores go by ascending doc_id, null
    ids last.  A null or empty text has no terms and is found by nothing; an
    item without terms has no rows.  Rows of ``docs`` that repeat are found
    each, rows of ``items`` that repeat are answered each.  Other columns,
    whatever their names, are left behind.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "ranked-search")
    docs = texts(docs)
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    held = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    slices = max(1, -(-held // SLICE_BYTES))
    of_slice = F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))
    answers = []
    for s in range(slices):
        rows = items.where(of_slice == s).collect()  # one slice
        hits = _slice(docs, scratch, str(s), [r["text"] for r in rows], k) if rows else None
        if hits is not None:
            places = spark.createDataFrame(list(enumerate(r["item_id"] for r in rows)),
                                           f"place int, item_id {items.schema['item_id'].dataType.simpleString()}")
            answers.append(hits.join(places, "place").withColumn("place", F.struct(F.lit(s), F.col("place"))))
    if not answers:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).where(F.lit(False))
    best_first = Window.partitionBy("place").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (reduce(DataFrame.unionByName, answers).withColumn("rank", F.row_number().over(best_first))
            .where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
