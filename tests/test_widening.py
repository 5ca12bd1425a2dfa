import pytest
from pyspark.sql import types as T

from conftest import plan_of, rows
from docengine.streaming.widening import CannotWiden, append_widening, read_widened, wider_schema, widened_schema


def of(ddl):
    return T.StructType.fromDDL(ddl)


def test_wider_schemas():
    a = of("a INT, s STRUCT<x: FLOAT>, l ARRAY<INT>, d DECIMAL(5,2)")
    b = of("A BIGINT, s STRUCT<y: STRING, x: DOUBLE>, l ARRAY<BIGINT>, d DECIMAL(7,4), n DATE")
    assert wider_schema(a, b) == of("a BIGINT, s STRUCT<x: DOUBLE, y: STRING>, l ARRAY<BIGINT>, d DECIMAL(7,4), n DATE")
    assert wider_schema(b, a) == of("A BIGINT, s STRUCT<y: STRING, x: DOUBLE>, l ARRAY<BIGINT>, d DECIMAL(7,4), n DATE")
    for x, y in (("a STRING", "a INT"), ("a BIGINT", "a DOUBLE"), ("a DECIMAL(38,0)", "a DECIMAL(38,10)"),
                 ("a STRUCT<b: INT>", "a STRUCT<b: STRING>")):
        with pytest.raises(CannotWiden, match="a"):
            wider_schema(of(x), of(y))


def write(spark, where, data, ddl):
    spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(where)
    return spark.readStream.schema(ddl).parquet(where)


def test_streams_of_growing_width(spark, tmp_path):
    table, source, checkpoint = (str(tmp_path / x) for x in ("t", "in", "checkpoint"))
    with pytest.raises(FileNotFoundError):
        read_widened(spark, table)
    steps = (([(1, 1.5)], "k INT, x FLOAT"), ([(2 ** 40, 2.25, "a", (7, ))], "k BIGINT, x DOUBLE, s STRING, n STRUCT<p: INT>"),
             ([(3,)], "k SMALLINT"), ([((2 ** 41, "z"), "b")], "n STRUCT<p: BIGINT, q: STRING>, s STRING"))
    for data, ddl in steps:
        append_widening(write(spark, source, data, ddl), table, checkpoint)
    got = read_widened(spark, table)
    assert got.schema == of("k BIGINT, x DOUBLE, s STRING, n STRUCT<p: BIGINT, q: STRING>")
    assert rows(got.selectExpr("k", "x", "s", "n.p", "n.q")) == rows(spark.createDataFrame(
        [(1, 1.5, None, None, None), (2 ** 40, 2.25, "a", 7, None), (3, None, None, None, None),
         (None, None, "b", 2 ** 41, "z")], "k BIGINT, x DOUBLE, s STRING, p BIGINT, q STRING"))
    assert rows(got.filter("k > 2").select("k")) == [(2 ** 40,), (3,)]
    assert "PushedFilters: [IsNotNull(k), GreaterThan(k,2)]" in plan_of(got.filter("k > 2").select("k"))
    # The same schema again declares nothing; one that does not fit writes nothing.
    before = spark.read.json(f"{table}.schemas").count()
    append_widening(write(spark, source, [(4,)], "k SMALLINT"), table, checkpoint)
    assert spark.read.json(f"{table}.schemas").count() == before and read_widened(spark, table).count() == 5
    with pytest.raises(CannotWiden):
        append_widening(write(spark, str(tmp_path / "bad"), [("x",)], "k STRING"), table, checkpoint)
    assert read_widened(spark, table).count() == 5 and widened_schema(spark, table) == got.schema
    with pytest.raises(ValueError, match="written by the stream"):
        append_widening(spark.readStream.schema("k INT").parquet(source), table, str(tmp_path / "another"))
