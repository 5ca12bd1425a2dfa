"""Severity of toxic language by cumulative-link ordinal regression.

One weight vector over sparse text features (words and their beginnings) is
shared by ordered thresholds: P(grade > k) = sigmoid(w . x - threshold_k).
The expected severity is the sum of these probabilities, the predicted grade
the number of them that reach a half.  Grades come from the labels: 0 is not
toxic; toxic rows are split at the median amount of toxic language (features
of toxic rows, each by the logarithm of its occurrences), 1 below and 2 from
it on.  The model is fitted on a
bounded sample of labelled rows (the ``SAMPLE`` smallest hashes of doc_id);
every document is scored on its whole text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import Scratch, batch, prepare, text_column, texts

SAMPLE = 16384       # labelled rows that the model is fitted on, at most
LEAST_DOCS = 5       # sample rows that a feature must occur in to get a weight
LEAST_Z = 5.0        # standard deviations its toxic rows must be away from what chance gives
BEGINNINGS = range(3, 9)
L2 = 3e-4
STEPS = 300
MEMO = 300_000       # words whose features a worker keeps

# Bytes that are no part of a word become blanks.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def words(text: str) -> Counter:
    """Occurrences of the words of a whole text, letters in lower case."""
    return Counter(text.lower().encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split())


def features(word: bytes) -> set[int]:
    """Hashes of a word and of its beginnings of 3 to 8 letters."""
    letters = word.decode("utf-8", "replace")
    return {zlib.crc32(word + b" "), *(zlib.crc32(letters[:k].encode("utf-8", "replace"))
                                       for k in BEGINNINGS if k <= len(letters))}


@dataclass
class Model:
    weights: dict[int, float]   # by feature; others have none
    thresholds: np.ndarray      # ascending
    memo: dict[bytes, tuple[int, ...]] = field(default_factory=dict)

    def hits(self, counts: Counter) -> Counter:
        """Occurrences of the features that have a weight."""
        out: Counter = Counter()
        for word, n in counts.items():
            known = self.memo.get(word)
            if known is None:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                known = self.memo[word] = tuple(self.weights.keys() & features(word))
            for f in known:
                out[f] += n
        return out

    def beyond(self, text: str) -> np.ndarray:
        """P(grade > k) for each threshold."""
        hits = self.hits(words(text))
        score = float(sum(self.weights[f] * (1 + np.log(n)) for f, n in sorted(hits.items())))
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -500, 500)))


NOTHING = Model({}, np.array([50.0, 51.0]))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(text, toxic) of the sampled rows: labelled documents with the smallest hashes of doc_id."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    # ``size`` rows of two numbers, so the texts stay where they are.
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def telling(rows: DataFrame, toxic: int, total: int) -> set[int]:
    """Features whose share of toxic rows chance does not explain."""
    schema = pa.schema([("feature", pa.int64()), ("docs", pa.int64()), ("toxic", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, bad = Counter(), Counter()
            for text, t in zip(text_column(b), text_column(b, "toxic")):
                own = set().union(*map(features, words(text)))
                docs.update(own)
                if t > 0:
                    bad.update(own)
            yield batch({"feature": list(docs), "docs": list(docs.values()), "toxic": [bad[f] for f in docs]}, schema)

    rate = toxic / total
    counts = (rows.mapInArrow(run, "feature long, docs long, toxic long").groupBy("feature")
              .agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")))
    apart = (F.col("toxic") - rate * F.col("docs")) / F.sqrt(F.col("docs") * F.lit(rate * (1 - rate)))
    return {r["feature"] for r in counts.where((F.col("docs") >= LEAST_DOCS) & (F.abs(apart) >= LEAST_Z)).collect()}


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    """Fits the model; without rows of both kinds nothing is toxic.

    Labelled rows without a document, or with a null label, are not looked
    at; of labels that contradict each other the toxic one counts.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "toxicity")
    rows = scratch.write(sample(docs, labels, size), "sample")
    kinds = rows.agg(F.count("*").alias("n"), F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("bad")).first()
    if not kinds["bad"] or kinds["bad"] == kinds["n"]:
        return NOTHING
    chosen = telling(rows, kinds["bad"], kinds["n"])
    schema = pa.schema([("features", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("toxic", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(dict.fromkeys(chosen, 1.0), np.zeros(1))
        for b in batches:
            hits = [own.hits(words(t)) for t in text_column(b)]
            yield batch({"features": [list(h) for h in hits], "n": [list(h.values()) for h in hits],
                         "toxic": text_column(b, "toxic")}, schema)

    small = rows.mapInArrow(run, "features array<long>, n array<long>, toxic int").toPandas()
    scratch.drop("sample")
    return fitted(small)


def fitted(rows: pd.DataFrame) -> Model:
    """The model of the sample's rows (features, n, toxic)."""
    toxic = rows["toxic"].to_numpy() > 0
    lengths = rows["features"].map(len).to_numpy()
    row = np.repeat(np.arange(len(rows)), lengths)
    names, column = np.unique(np.concatenate([np.asarray(f, np.int64) for f in rows["features"]]), return_inverse=True)
    n = np.concatenate([np.asarray(x, np.float64) for x in rows["n"]])
    if not len(names):
        return NOTHING
    in_toxic = np.bincount(column, toxic[row], len(names)) > 0.5 * np.bincount(column, minlength=len(names))
    amount = np.bincount(row, (1 + np.log(n)) * in_toxic[column], len(rows))
    grades = toxic.astype(np.int64)
    grades += toxic & (amount >= np.median(amount[toxic])) & (amount > amount[toxic].min())
    weights, thresholds = _ordinal(row, column, 1 + np.log(n), grades, len(names))
    return Model(dict(zip(names.tolist(), weights.tolist())), thresholds)


def _ordinal(row, column, x, grades, width) -> tuple[np.ndarray, np.ndarray]:
    """Gradient steps (Adam, whole sample) on the likelihood of the grades."""
    size, top = len(grades), int(grades.max())
    w = np.zeros(width)
    # threshold_0, then logarithms of the gaps: thresholds stay in order.
    shape = np.zeros(top)
    shape[0] = 2.0
    above = np.arange(top)[None, :] < grades[:, None]  # grade > k
    at_risk = np.arange(top)[None, :] <= grades[:, None]
    m = [np.zeros_like(w), np.zeros_like(shape)]
    v = [np.zeros_like(w), np.zeros_like(shape)]
    for step in range(1, STEPS + 1):
        thresholds = np.cumsum(np.concatenate([shape[:1], np.exp(shape[1:])]))
        score = np.bincount(row, x * w[column], size)
        p = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -500, 500)))
        # P(grade = g) = p[g-1] - p[g], with p[-1] = 1 and p[top] = 0.
        full = np.concatenate([np.ones((size, 1)), p, np.zeros((size, 1))], axis=1)
        rows = np.arange(size)
        chance = np.maximum(full[rows, grades] - full[rows, grades + 1], 1e-12)
        slope = p * (1 - p)
        slopes = np.concatenate([np.zeros((size, 1)), slope, np.zeros((size, 1))], axis=1)
        d_score = (slopes[rows, grades] - slopes[rows, grades + 1]) / chance / size
        d_threshold = np.zeros(top)
        for k in range(top):
            d_threshold[k] = (np.where(grades == k + 1, -1, 0) + np.where(grades == k, 1, 0)) @ (
                slope[:, k] / chance) / size
        g_w = np.bincount(column, x * d_score[row], width) - L2 * w
        after = np.cumsum(d_threshold[::-1])[::-1]
        g_shape = after * np.concatenate([[1.0], np.exp(shape[1:])])
        for i, (value, g) in enumerate(((w, g_w), (shape, g_shape))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            value += 0.1 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-9)
    thresholds = np.cumsum(np.concatenate([shape[:1], np.exp(shape[1:])]))
    return w, thresholds


SCORES = "expected_severity double, grade int, p_toxic double"


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and expected_severity, grade, p_toxic (the chance of a grade over 0).

    A null or empty text has no words and gets the scores of the thresholds
    alone; repeated rows are scored alike.  A column of ``docs`` that has the
    name of a score is replaced.
    """
    names = [c.split()[0] for c in SCORES.split(", ")]
    kept = docs.drop(*names)
    fields = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes)
    weights, thresholds = model.weights, model.thresholds  # at most the features of the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, thresholds)
        for b in batches:
            p = [own.beyond(t or "") for t in text_column(b)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([float(x.sum()) for x in p], pa.float64()),
                 pa.array([int((x >= 0.5).sum()) for x in p], pa.int32()),
                 pa.array([float(x[0]) for x in p], pa.float64())],
                names=[*b.schema.names, *names])

    return kept.mapInArrow(run, f"{fields}, {SCORES}")
