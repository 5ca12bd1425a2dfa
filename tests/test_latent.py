"""Latent vectors against a decomposition of the whole matrix."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docengine.operators import latent
from docengine.runtime import scratch_path


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    topics = [[f"t{t}w{k}" for k in range(30)] for t in range(4)]
    rows = [(i, " ".join(rng.choice(topics[i % 4] if rng.random() < 0.8 else sum(topics, [])) for _ in range(rng.randint(5, 60))))
            for i in range(300)]
    rows += [(900, None), (901, ""), (902, " .,")]
    return spark.createDataFrame(rows, "id long, text string").repartition(6).persist()


def matrix(texts, encoder):
    held = texts.select("id", latent.buckets("text", len(encoder.idf)).alias("b")).filter("id < 900").orderBy("id").collect()
    return latent.weighted([np.array(r["b"]) for r in held], encoder.idf)


def test_directions_are_those_of_the_whole_matrix(texts):
    encoder = latent.fit_latent(texts, "text", rank=10, dim=128)
    x = matrix(texts, encoder)
    _, singular, right = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(encoder.singular, singular[:10])
    assert np.allclose(np.abs((encoder.directions * right[:10]).sum(axis=1)), 1)
    # No matrix of this rank is nearer to the texts than the one along these directions.
    kept = x @ encoder.directions.T @ encoder.directions
    assert np.isclose(np.linalg.norm(x - kept) ** 2, (singular[10:] ** 2).sum())


def test_embeddings_are_places_along_the_directions(texts):
    encoder = latent.fit_latent(texts, "text", rank=10, dim=128)
    got = {r["id"]: r["e"] for r in texts.select("id", encoder("text").alias("e")).collect()}
    z = matrix(texts, encoder) @ encoder.directions.T
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    assert np.allclose(np.array([got[i] for i in range(300)]), z, atol=1e-6)
    assert got[900] is None and got[901] == got[902] == [0.0] * 10
    same = z @ z.T
    topic = np.arange(300) % 4
    assert same[topic[:, None] == topic].mean() > same[topic[:, None] != topic].mean() + 0.5


def test_a_stored_encoder_is_the_same(spark, texts):
    encoder = latent.fit_latent(texts, "text", rank=5, dim=64)
    path = scratch_path(spark, "test-latent")
    latent.write_latent(spark, encoder, path)
    other = latent.open_latent(spark, path)
    assert all(np.array_equal(a, b) for a, b in zip(vars(encoder).values(), vars(other).values()))


def test_no_texts(spark, texts):
    encoder = latent.fit_latent(texts.filter("id >= 900"), "text", rank=5, dim=64)
    assert encoder.directions.shape == (0, 64)
    assert texts.limit(3).select(F.size(encoder("text")).alias("n")).filter("n <= 0").count() == 3


def test_words_are_found_once_for_a_fit(spark, monkeypatch):
    written = []
    write = latent.materialize
    monkeypatch.setattr(latent, "materialize", lambda df, label: written.append(label) or write(df, label))
    texts = spark.createDataFrame([("a b c",), ("b c d",), (None,), ("",)], "text string")
    assert len(latent.fit_latent(texts, "text", rank=2, dim=16).singular) == 2 and written == ["buckets"]
