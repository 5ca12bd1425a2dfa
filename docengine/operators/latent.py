"""Latent text vectors: truncated singular value decomposition of hashed tf-idf.

Words fall into ``dim`` buckets; a text is the unit vector of its bucket
weights, log(1 + count) * idf.  The right singular vectors of the matrix of
all texts are the eigenvectors of its Gram matrix, dim x dim however many
texts there are: every task adds up its own, the sums meet row by row, and
only the finished matrix is decomposed in one place.  Kept are the ``rank``
directions of the largest singular values; an embedding is the unit vector of
a text's place along them.

A fitted encoder is dim * (rank + 1) numbers.  It is stored with the index,
since questions and later texts have to be put along the same directions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.operators.lexical import words
from docengine.runtime import materialize

DIM, RANK = 1024, 64
ROWS = 512  # texts whose bucket weights are held at a time


def buckets(text: Column | str, dim: int = DIM) -> Column:
    """The bucket of every word of a text; NULL for a NULL text."""
    return F.transform(words(text), lambda w: F.pmod(F.xxhash64(w), F.lit(dim)).cast("int"))


def weighted(held: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Unit vectors of bucket weights, a row per text; zero for a text without words."""
    dim = len(idf)
    at = np.concatenate([k * dim + np.asarray(b, np.int64) for k, b in enumerate(held)] or [np.zeros(0, np.int64)])
    x = np.log1p(np.bincount(at, minlength=len(held) * dim).reshape(len(held), dim)) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


@dataclass(frozen=True)
class LatentEncoder:
    idf: np.ndarray
    singular: np.ndarray    # values, descending
    directions: np.ndarray  # rank x dim

    def __call__(self, text: Column | str) -> Column:
        """Embedding of a text column as ``array<float>``."""
        idf, directions = self.idf, self.directions

        @F.pandas_udf("array<float>")
        def embed(found: pd.Series) -> pd.Series:
            out: list[np.ndarray | None] = []
            for a in range(0, len(found), ROWS):
                held = found.iloc[a:a + ROWS].tolist()
                z = weighted([np.zeros(0) if b is None else b for b in held], idf) @ directions.T
                norm = np.linalg.norm(z, axis=1, keepdims=True)
                z = np.divide(z, norm, out=np.zeros_like(z), where=norm > 0).astype(np.float32)
                out += [None if b is None else row for b, row in zip(held, z)]
            return pd.Series(out, index=found.index, dtype=object)

        return embed(buckets(text, len(idf)))


def fit_latent(texts: DataFrame, text_col: str, rank: int = RANK, dim: int = DIM) -> LatentEncoder:
    """Directions of all texts; fewer than ``rank`` when they have no more."""
    held = texts.filter(F.col(text_col).isNotNull()).select(buckets(text_col, dim).alias("b")).filter(F.size("b") > 0)
    held = materialize(held, "buckets")  # read three times; the words are found once
    found = held.select(F.explode(F.array_distinct("b")).alias("b")).groupBy("b").agg(F.count("*").alias("df"))
    n, df = held.count(), np.zeros(dim)
    for row in found.collect():  # dim rows at most
        df[row["b"]] = row["df"]
    idf = np.log((n + 1) / (df + 1)) + 1

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            own = batch.column(0)
            for a in range(0, len(own), ROWS):
                part = own.slice(a, ROWS)
                offsets = part.offsets.to_numpy()
                values = part.flatten().to_numpy()
                x = weighted(np.split(values, offsets[1:-1] - offsets[0]) if len(part) else [], idf)
                total += x.T @ x
        for k in np.flatnonzero(total.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total[k]])], names=["k", "row"])

    summed = held.mapInArrow(gram, "k int, row array<double>").groupBy("k").agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col("row")))).alias("row"))
    whole = np.zeros((dim, dim))
    for row in summed.toLocalIterator():  # dim rows of dim numbers
        whole[row["k"]] = row["row"]
    values, vectors = np.linalg.eigh((whole + whole.T) / 2)
    order = [k for k in np.argsort(-values)[:rank] if values[k] > 1e-9 * max(values.max(), 1e-300)]
    directions = vectors[:, order].T
    # A direction and its opposite are the same; the largest number is positive.
    signs = np.sign(directions[np.arange(len(order)), np.abs(directions).argmax(axis=1)])
    return LatentEncoder(idf, np.sqrt(values[order]), directions * signs[:, None])


def write_latent(spark: SparkSession, encoder: LatentEncoder, path: str) -> None:
    rows = [(-1, 0.0, encoder.idf.tolist())]
    rows += [(k, float(s), v.tolist()) for k, (s, v) in enumerate(zip(encoder.singular, encoder.directions))]
    spark.createDataFrame(rows, "k int, singular double, numbers array<double>").coalesce(1).write.parquet(path)


def open_latent(spark: SparkSession, path: str) -> LatentEncoder:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["k"])  # rank + 1
    dim = len(rows[0]["numbers"])
    return LatentEncoder(np.array(rows[0]["numbers"]), np.array([r["singular"] for r in rows[1:]]),
                         np.array([r["numbers"] for r in rows[1:]]).reshape(-1, dim))
