"""Text -> vectors, and the index table kept over them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.operators.changes import apply_changes, changed_rows, snapshot_diff

Encoder = Callable[[DataFrame], DataFrame]


def fit_encoder(df: DataFrame, text_col: str, dim: int = 1024, min_doc_freq: int = 1) -> PipelineModel:
    """Hashed, frequency-weighted, unit-length word vectors (MLlib).

    Fitting is one distributed pass; the model is ``dim`` numbers.  Keep it
    with the index: queries and later chunks have to use the same weights.
    """
    stages = [
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", minTokenLength=1),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_idf", minDocFreq=min_doc_freq),
        Normalizer(inputCol="_idf", outputCol="_unit", p=2.0),
    ]
    return Pipeline(stages=stages).fit(df.filter(F.col(text_col).isNotNull()).select(text_col))


def embed(df: DataFrame, text_col: str, model: PipelineModel, out: str = "embedding") -> DataFrame:
    """Add the vector of ``text_col`` as ``array<float>``."""
    source = df
    if text_col != model.stages[0].getInputCol():
        source = df.withColumn(model.stages[0].getInputCol(), F.col(text_col))
    kept = [F.col(c) for c in df.columns]
    return (
        model.transform(source.filter(F.col(text_col).isNotNull()))
        .select(*kept, vector_to_array("_unit", "float32").alias(out))
    )


def build_index(chunks: DataFrame, encoder: Encoder, key: str = "chunk_id",
                cols: Sequence[str] = (), vec_col: str = "embedding") -> DataFrame:
    """Index rows: key, vector, and the columns a search may return."""
    return encoder(chunks).select(key, vec_col, *[c for c in cols if c != key])


def sync_index(index: DataFrame, old: DataFrame, new: DataFrame, encoder: Encoder,
               key: str = "chunk_id", cols: Sequence[str] = (), vec_col: str = "embedding") -> DataFrame:
    """Index after its source went from ``old`` to ``new``; only changed rows are encoded."""
    diff = snapshot_diff(old, new, [key])
    fresh = build_index(changed_rows(new, diff, [key]), encoder, key, cols, vec_col)
    return apply_changes(index, diff, fresh, [key])
