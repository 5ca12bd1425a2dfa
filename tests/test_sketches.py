from pyspark.sql import functions as F

from conftest import rows
from docengine.operators.sketches import error_of, rolled_up, sketched
from docengine.sources.tables import append_table


def test_stored_sketches_roll_up(spark, tmp_path):
    """Batches that overlap, by day and then over all; a hot key; NULLs."""
    path = str(tmp_path / "s")
    for k in range(4):
        batch = spark.range(k * 20000, k * 20000 + 40000).select(
            F.lit(k).alias("day"), F.when(F.col("id") % 3 > 0, "hot").otherwise("rare").alias("kind"),
            F.col("id").alias("v"), F.lit(2).alias("size"), F.lit(f"2024-01-0{k + 1}").cast("timestamp").alias("t"))
        append_table(sketched(batch, ["day", "kind"], "v", "size", "t"), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 8 and stored.agg(F.max(F.length("sketch"))).first()[0] < 20000
    united = rolled_up(stored, ["kind"])
    exact = spark.range(100000).groupBy(F.when(F.col("id") % 3 > 0, "hot").otherwise("rare").alias("kind")).agg(
        F.count("*").alias("n_distinct"))
    errors = error_of(united, exact, ["kind"])
    assert errors.count() == 2 and errors.agg(F.max("relative_error")).first()[0] < 0.03
    assert rows(united.select("kind", "n_rows", "n_bytes", F.date_format("last_time", "dd"))) == [
        ("hot", 106666, 213332, "04"), ("rare", 53334, 106668, "04")]
    # In two steps as in one.
    steps = rolled_up(rolled_up(stored, ["day"]))
    assert abs(steps.first().approx_distinct - 100000) < 3000
    assert steps.first().approx_distinct == rolled_up(stored).first().approx_distinct


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), ("b", None), (None, "y")], "k STRING, v STRING")
    found = rolled_up(sketched(df, ["k"], "v"), ["k"])
    assert rows(found.select("k", "n_rows", "approx_distinct")) == [("a", 2, 0), ("b", 2, 1), (None, 1, 1)]
    assert rolled_up(sketched(df.limit(0), ["k"], "v"), ["k"]).count() == 0
    whole = rolled_up(sketched(df, ["k"], "v"))
    assert whole.first().approx_distinct == 2
    off = error_of(found.filter("k = 'b'"), spark.createDataFrame([("b", 1), ("z", 0)], "k STRING, n_distinct BIGINT"), ["k"])
    assert rows(off.select("k", "relative_error")) == [("b", 0.0), ("z", 0.0)]
