"""MinHash near-duplicates: banding, verification, connected components.

A document's set holds its distinct shingles of ``WORDS`` words.  Each set gets
``HASHES`` minima, one per universal hash function (multiply, add, keep the
high bits); documents that agree in all rows of a band share a bucket.  At a
similarity of 0.8 the chance that two share none is below 5e-6, at 0.85
below 1e-8.

Documents of equal sets are one node from the start.  Buckets of up to
``SMALL`` nodes compare all their nodes, larger ones compare theirs with a few
pivots at a time, first with those that share the most buckets with others, as
the text that copies were made from does: nodes that links have joined in the
meantime need no comparison, so a group of thousands of copies takes one or
two pivots.  A pivot that was compared with all others leaves its bucket, the
number of pivots grows ``GROWTH`` times from round to round, and rounds go on until
no bucket holds two nodes that are neither joined nor compared.

What is then left in a large bucket is mostly texts that differ from all others
by more than the limit.  They are told apart by their shared shingles, those
that another component has too: two nodes of different components meet in
shared ones alone, so their intersection is at most the sum, over ``PARTS``
classes of shingles, of the smaller count of shared ones.  Pairs whose sizes and
that bound rule a link out are not made, and a node whose shared shingles are
too few for any partner leaves.  Both are exact: no bucket is cut, and no
pair is lost but by the hashing itself.  Candidates pass the similarity of
their signatures (with room for its error) and then that of their whole sets,
made anew from the texts.

Components: large-star and small-star steps in turn, until nothing changes;
every step is an aggregate and a join, written to the shared folder.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from docengine.llm.common import (
    Scratch, ascending, batch, free_name, mix, prepare, release, scratch_closed, small_side, text_column, texts,
)

WORDS = 5
SMALL = 16
GROWTH = 16           # how many times as many pivots a round has as the one before
CLOSED = 4            # closed buckets leave once they hold one in so many rows
PARTS = 16            # classes that shared shingles are counted in
SIMILAR = (80, 100)   # intersection / union at least 80 / 100
ROOM = 6              # standard deviations of the signature's estimate that a candidate may fall short
CHUNK = 1 << 15       # shingles hashed at once



@dataclass(frozen=True)
class Layout:
    """How a packed signature is laid out: minima of ``dtype``, of which bands of ``rows`` are read."""

    hashes: int
    bands: int
    rows: int
    dtype: str

    @property
    def band_bytes(self) -> int:
        return self.rows * np.dtype(self.dtype).itemsize


LAYOUT = Layout(hashes=160, bands=32, rows=5, dtype="<u4")

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
MEMO = 200_000


def coefficients(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and summands of ``count`` universal hash functions."""
    draw = np.random.Generator(np.random.PCG64(seed))
    return (draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            draw.integers(0, 1 << 63, count, dtype=np.uint64))


class Shingler:
    """Texts -> 64-bit values of their distinct shingles."""

    def __init__(self, words: int = WORDS) -> None:
        self.words, self.memo = words, {}

    def word_values(self, parts: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in set(parts).difference(memo):
            memo[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return np.fromiter(map(memo.__getitem__, parts), np.uint64, len(parts))

    def shingles(self, text: str) -> np.ndarray:
        """Ascending distinct values; fewer words than a shingle has are one, no words none."""
        parts = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
        if not parts:
            return np.zeros(0, np.uint64)
        values = self.word_values(parts)
        width = min(self.words, len(parts))
        total = np.full(len(values) - width + 1, width, np.uint64)
        for k in range(width):
            total = mix(total * _BASE + values[k:len(values) - width + 1 + k])
        return ascending(total)


def minima(sets: list[np.ndarray], multiply: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Signatures (rows) of non-empty sets: the least high half of each hash function."""
    flat = np.concatenate(sets)
    ends = np.cumsum([len(s) for s in sets])
    out = np.full((len(sets), len(multiply)), np.uint64(0xFFFFFFFF), np.uint64)
    begin = 0
    while begin < len(flat):
        end = min(begin + CHUNK, len(flat))
        rows = np.arange(np.searchsorted(ends, begin, side="right"), np.searchsorted(ends, end - 1, side="right") + 1)
        cuts = np.maximum(np.concatenate([[begin], ends[rows[:-1]]]), begin) - begin
        part = flat[begin:end]
        work = np.empty_like(part)
        for j in range(len(multiply)):
            np.multiply(part, multiply[j], out=work)
            work += add[j]
            work >>= np.uint64(32)
            out[rows, j] = np.minimum(out[rows, j], np.minimum.reduceat(work, cuts))
        begin = end
    return out.astype("<u4")


_SIGNED = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("n_shingles", pa.int64()),
                     ("set_key", pa.binary()), ("signature", pa.binary())])


def keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("text_key", F.unhex(F.md5("text")))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, signature) of keyed documents.

    set_key is equal for equal sets and null, as is the signature, for empty ones.
    """
    multiply, add = coefficients(LAYOUT.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            sets = [shingler.shingles(t) for t in text_column(b)]
            full = [s for s in sets if len(s)]
            signatures = iter(minima(full, multiply, add) if full else ())
            yield batch({
                "doc_id": b.column(0), "text_key": text_column(b, "text_key"), "n_shingles": [len(s) for s in sets],
                "set_key": [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets],
                "signature": [next(signatures).tobytes() if len(s) else None for s in sets]}, _SIGNED)

    return docs.select("doc_id", "text_key", "text").mapInArrow(
        run, "doc_id long, text_key binary, n_shingles long, set_key binary, signature binary")


def bands(layout: Layout) -> Column:
    """The rows of every band of a signature, hashed to 32 bits; bands that collide only cost a comparison."""
    width = layout.band_bytes
    return F.array(*(F.hash(F.substring("signature", 1 + i * width, width)) for i in range(layout.bands)))


def buckets(nodes: DataFrame) -> DataFrame:
    """(node, n_shingles, bucket) for all bands; a bucket is a band's hash with its number."""
    return nodes.select("node", "n_shingles", F.posexplode("bands").alias("band", "key")).select(
        "node", "n_shingles", (F.col("band").cast("long") * (1 << 32) + F.col("key")).alias("bucket"))


def sizes_allow(n: Column, m: Column, similar: tuple[int, int]) -> Column:
    """Whether sets of ``n`` and ``m`` elements can be similar enough at all."""
    return similar[0] * F.greatest(n, m) <= similar[1] * F.least(n, m)


def shingle_rows(held: DataFrame) -> DataFrame:
    """(node, shingle): the distinct shingles of the texts of ``held``."""
    schema = pa.schema([("node", pa.int64()), ("shingle", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b in batches:
            for node, text in zip(text_column(b, "node"), text_column(b)):
                values = shingler.shingles(text).view(np.int64)
                for i in range(0, len(values), CHUNK):
                    part = values[i:i + CHUNK]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), node)), pa.array(part)], schema=schema)

    return held.select("node", "text").mapInArrow(run, "node long, shingle long")


def shared_counts(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shared): by class, how many shingles of a node another component holds too.

    ``rows`` is (node, shingle), ``nodes`` (node, component); nodes that share none are left out.
    """
    own = rows.join(nodes, "node")
    wide = (own.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y"))
            .where("x <> y").select("shingle"))
    part = F.shiftrightunsigned("shingle", 64 - PARTS.bit_length() + 1)
    counts = F.array(*(F.count(F.when(part == i, 1)).cast("int") for i in range(PARTS)))
    return own.join(wide, "shingle", "left_semi").groupBy("node").agg(counts.alias("shared"))


def verified(pairs: DataFrame, held: DataFrame, scratch: Scratch, name: str, similar: tuple[int, int],
             layout: Layout) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; ``held`` has (node, signature, text).

    First by signature: narrow rows, written as ``name``; then by the sets, made from the texts
    of the pairs that are left.
    """
    share = similar[0] / similar[1]
    least = int(layout.hashes * (share - ROOM * (share * (1 - share) / layout.hashes) ** 0.5))
    signatures = held.select("node", "signature")
    both = (pairs.join(signatures.withColumnsRenamed({"node": "a", "signature": "sa"}), "a")
            .join(signatures.withColumnsRenamed({"node": "b", "signature": "sb"}), "b"))
    alike = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a_id, b_id, sa, sb = (b.column(b.schema.get_field_index(c)) for c in ("a", "b", "sa", "sb"))
            x, y = (np.frombuffer(b"".join(s.to_pylist()), layout.dtype).reshape(-1, layout.hashes) for s in (sa, sb))
            keep = pa.array((x == y).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([a_id.filter(keep), b_id.filter(keep)], schema=alike)

    likely = scratch.write(both.select("a", "b", "sa", "sb").mapInArrow(estimate, "a long, b long"), name)

    def texts_of(end: str, text: str) -> DataFrame:
        needed = small_side(likely.select(F.col(end).alias("node")).distinct(), 8)
        return held.select("node", "text").join(needed, "node", "left_semi").withColumnsRenamed({"node": end, "text": text})

    full = likely.join(texts_of("b", "tb"), "b").join(texts_of("a", "ta"), "a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, last = Shingler(), OrderedDict()

        def shingles(node: int, text: str) -> np.ndarray:
            found = last.get(node)
            if found is None:
                found = last[node] = shingler.shingles(text)
                if len(last) > 64:
                    last.popitem(last=False)
            return found

        for b in batches:
            out = {"a": [], "b": []}
            for a_id, ta, b_id, tb in zip(*(text_column(b, c) for c in ("a", "ta", "b", "tb"))):
                x, y = shingles(a_id, ta), shingles(b_id, tb)
                same = len(np.intersect1d(x, y, assume_unique=True))
                if similar[1] * same >= similar[0] * (len(x) + len(y) - same):
                    out["a"].append(a_id)
                    out["b"].append(b_id)
            yield batch(out, alike)

    return full.select("a", "ta", "b", "tb").mapInArrow(compare, "a long, b long")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): the smallest node of each component, for nodes of ``edges`` (a, b).

    Large-star links every larger neighbour of a node to its least neighbour,
    small-star the smaller ones; both keep components, and in turn they end
    with every node linked to the smallest.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = scratch.write(edges.where("a <> b").select(high, low).distinct(), f"{name}-0")
    step, before = 0, None
    while True:
        # Large-star: all neighbours of u beyond u go to the least of u and its neighbours.
        ways = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = scratch.write(large, f"{name}-large-{step}")
        # Small-star: u and its smaller neighbours go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        step += 1
        state = Observation()  # comes with the write, without a job of its own
        edges = scratch.write(small.observe(state, F.count("*").alias("n"), F.sum(
            F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash")), f"{name}-{step}")
        now = state.get
        scratch.drop(f"{name}-{step - 1}", f"{name}-large-{step - 1}")
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now


def joined(members: DataFrame, component: DataFrame | None) -> DataFrame:
    """(bucket, node, component) with the components so far."""
    if component is None:
        return members.withColumn("component", F.col("node"))
    return members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))


def still_open(state: DataFrame, scratch: Scratch, name: str) -> DataFrame | None:
    """The written ``state`` without the buckets that hold one component; None if no others are left.

    Buckets of one component give no pairs. They stay while they hold fewer than one in ``CLOSED``
    rows, for which all the others would be joined, shuffled and written again.
    """
    each = state.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
    told = each.agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("x") == F.col("y"), F.col("n"))).alias("closed")).first()
    rows, closed = told["rows"] or 0, told["closed"] or 0
    if closed < rows and CLOSED * closed >= rows:
        state = scratch.write(state.join(each.where("x <> y").select("bucket"), "bucket", "left_semi"), name)
    return state if closed < rows else None


def linked(nodes: DataFrame, rows: DataFrame, keyed_docs: DataFrame, scratch: Scratch, similar: tuple[int, int],
           layout: Layout = LAYOUT) -> DataFrame | None:
    """(node, component) of the nodes with links; None if there are none.

    ``nodes`` has (node, doc_id, text_key, n_shingles, bands), a row per distinct set:
    the id and text of one of its documents.  ``rows`` has the signatures.
    """
    spark = nodes.sparkSession
    found = buckets(nodes)
    sizes = scratch.write(found.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    members = scratch.write(found.join(small_side(sizes, 16), "bucket"), "members")
    scratch.drop("sizes")
    ways = nodes.select("node", F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    ways = scratch.write(ways.join(members.select("node").distinct(), "node", "left_semi"), "asked")
    release(spark)
    # Signatures and texts of the candidates alone, each from one row of the table; rows that repeat it count once.
    ways = small_side(ways, 64)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    bodies = keyed_docs.join(ways, same).select("node", "text").dropDuplicates(["node"])
    prints = rows.select("doc_id", "text_key", "signature").join(ways, same)
    prints = prints.select("node", "signature").dropDuplicates(["node"])
    held = scratch.write(prints.join(bodies, "node"), "held")
    release(spark)

    few = members.where(F.col("size") <= SMALL)
    # At most SMALL - 1 partners in each of a node's buckets.
    close = few.select("bucket", F.col("node").alias("a"), F.col("n_shingles").alias("n")).join(
        few.select("bucket", F.col("node").alias("b"), F.col("n_shingles").alias("m")), "bucket")
    pairs = close.where((F.col("a") < F.col("b")) & sizes_allow(F.col("n"), F.col("m"), similar)).select("a", "b")
    many = members.where(F.col("size") > SMALL)
    popular = many.groupBy("node").agg(F.sum("size").alias("popular"))
    rest = many.join(popular, "node").select("bucket", "node", "n_shingles", "popular")
    links, component, chosen, shingles, pivots, step = [], None, None, None, 2, 0
    while True:
        state = joined(rest, component)
        if step:
            # Buckets that the links have closed go first; of the others, the pivots have met all nodes and go.
            # Each table is written before still_open, which reads it twice.
            state = still_open(scratch.write(state, f"named-{step}"), scratch, f"unmet-{step}")
            if state is not None:
                state = scratch.write(state.join(
                    chosen.select("bucket", F.col("p.node").alias("node")), ["bucket", "node"], "left_anti"), f"some-{step}")
                state = still_open(state, scratch, f"left-{step}")
            scratch.drop(f"named-{step}", f"unmet-{step}", f"open-{step - 1}", f"pivots-{step - 1}",
                         f"able-{step - 1}", f"pairs-{step - 1}", f"likely-{step - 1}")
            release(spark)
            if state is None:
                break
            if shingles is None:
                shingles = scratch.write(shingle_rows(held.join(
                    state.select("node").distinct(), "node", "left_semi")), "shingles")
            counts = shared_counts(shingles, state.select("node", "component").distinct())
            counts = counts.withColumn("n_shared", F.aggregate("shared", F.lit(0), lambda n, k: n + k))
            state = still_open(scratch.write(state.join(counts, "node").where(
                similar[1] * F.col("n_shared") >= similar[0] * F.col("n_shingles")), f"able-{step}"),
                scratch, f"open-{step}")
            scratch.drop(f"some-{step}", f"left-{step}")
            if state is None:
                break
            rest = state
        else:
            rest = scratch.write(state, f"open-{step}")
        # The most popular node of each of ``pivots`` parts of a bucket: an aggregate, however many nodes it has.
        told = ["node", "component", "n_shingles", *(("n_shared", "shared") if step else ())]
        chosen = (rest.groupBy("bucket", F.pmod(F.xxhash64("component"), F.lit(pivots)).alias("part"))
                  .agg(F.max_by(F.struct(*told), F.struct("popular", "node")).alias("p")).select("bucket", "p"))
        chosen = scratch.write(chosen, f"pivots-{step}")
        able = (F.col("component") != F.col("p.component")) & sizes_allow(
            F.col("n_shingles"), F.col("p.n_shingles"), similar)
        if step:
            needed = similar[0] * (F.col("n_shingles") + F.col("p.n_shingles"))
            common = reduce(Column.__add__, (F.least(F.col("shared")[i], F.col("p.shared")[i]) for i in range(PARTS)))
            able &= needed <= sum(similar) * F.least("n_shared", "p.n_shared")
            able &= needed <= sum(similar) * common
        against = (rest.join(chosen, "bucket").where(able)
                   .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")))
        pairs = against if pairs is None else pairs.union(against)
        size, made = Observation(), Observation()
        pairs = scratch.write(pairs.distinct().observe(size, F.count("*").alias("n")), f"pairs-{step}")
        if size.get["n"]:
            link = verified(pairs, held, scratch, f"likely-{step}", similar, layout)
            link = scratch.write(link.observe(made, F.count("*").alias("n")), f"links-{step}")
            if made.get["n"]:
                links.append(link)
                component = components(reduce(DataFrame.union, links), scratch, f"components-{step}")
        rest = rest.select("bucket", "node", "n_shingles", "popular")
        pairs, pivots, step = None, pivots * GROWTH, step + 1
    scratch.drop("members", "asked", "held", "shingles", f"some-{step}", f"left-{step}", f"able-{step}")
    return component


def grouped(rows: DataFrame, keyed_docs: DataFrame, scratch: Scratch, similar: tuple[int, int],
            layout: Layout = LAYOUT) -> DataFrame:
    """(set_key, component_id) of the keys in ``rows`` (doc_id, text_key, set_key, n_shingles, signature)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("first")
    classes = (rows.where(F.col("set_key").isNotNull()).withColumn("bands", bands(layout)).groupBy("set_key")
               .agg(first, *(F.first(c).alias(c) for c in ("n_shingles", "bands")))
               .select("set_key", F.monotonically_increasing_id().alias("node"), "first.doc_id", "first.text_key",
                       "n_shingles", "bands"))
    classes = scratch.write(classes, "classes")  # once written, the numbers stay
    component = linked(classes.drop("set_key"), rows, keyed_docs, scratch, similar, layout)
    named = classes.select("set_key", "node", F.col("doc_id").alias("first_id"))
    if component is None:
        named = named.withColumn("component_id", F.col("first_id"))
    else:
        named = named.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
        named = named.join(least, "component")
    named = scratch.write(named.select("set_key", "component_id"), "named")
    scratch.drop("classes")
    release(rows.sparkSession)
    return named


def near_duplicates(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links of at least
    ``similar[0] / similar[1]`` reach; kept is true for the rows that have
    it.  A null or empty text, or one without words, has an empty set and
    links with nothing, not even with others like it.  Rows that repeat an id
    are looked at one by one; a null doc_id counts as larger than all others.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "near-duplicates")
    own = keyed(docs)
    rows = scratch.write(signed(own), "signed")
    named = grouped(rows, own, scratch, similar)
    found = rows.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    ids = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", ids.alias("component_id"), F.col("doc_id").eqNullSafe(ids).alias("kept"))


def one_of_each(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """All columns of ``docs``: of each group of near-duplicates the row with the smallest doc_id.

    Of rows that repeat that id one stays; documents with empty sets all stay.
    """
    spark = prepare(docs.sparkSession)
    row, scratch = free_name(docs, "__row"), Scratch(spark, "one-of-each")
    numbered = scratch.write(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    ranked = numbered.select(F.col(row).alias("number"), F.col("doc_id").cast("long").alias("id"), "text")
    ids = ranked.select(F.col("number").alias("doc_id"), "id")
    with scratch_closed():
        # Row numbers stand for ids, so that every row is a document of its own.
        found = near_duplicates(ranked.select(F.col("number").alias("doc_id"), "text"), similar)
        first = F.min(F.struct(F.col("id").isNull(), "id", "doc_id")).alias("first")
        chosen = scratch.write(found.join(ids, "doc_id").groupBy("component_id").agg(first)
                               .select(F.col("first.doc_id").alias(row)), "chosen")
    release(spark)
    return numbered.join(chosen, row, "left_semi").drop(row)
