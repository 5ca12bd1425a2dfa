"""Hand-worked rows for paths, text, payloads, scores and routes."""

import json

import pytest
from pyspark.sql import functions as F

from docengine.functions import scoring, text
from docengine.functions.dates import parse_date
from docengine.operators import extraction as ex
from conftest import rows

UUID = "0a1b2c3d-0000-1111-2222-333344445555"


@pytest.mark.parametrize(
    "path, wanted",
    [(f"/v/{UUID}/x.xml", UUID), ("/v/foo.xml", "foo"), ("/v/foo.pdf", None), (f"/v/{UUID}.xml", UUID)],
)
def test_id_from_path(spark, path, wanted):
    df = spark.createDataFrame([(path,)], "p STRING")
    assert df.select(text.extract_id("p")).first()[0] == wanted


def test_strip_is_python_strip(spark):
    samples = ["  a b ", "\t\n x ", " y　", "\x1cz\x85", "   ", "", "​q"]
    df = spark.createDataFrame([(s,) for s in samples], "s STRING")
    assert [r[0] for r in df.select(text.strip("s")).collect()] == [s.strip() for s in samples]


def test_passage_trim(spark):
    df = spark.createDataFrame([("a" * 1200,), ("a" * 1201,)], "s STRING")
    got = [r[0] for r in df.select(text.trim_passage("s")).collect()]
    assert got == ["a" * 1200, "a" * 1200 + " …"]


def test_needle_is_data_not_pattern(spark):
    df = spark.createDataFrame([("100% O'Neil",), ("plain",)], "s STRING")
    assert df.filter(text.icontains("s", "%")).count() == 1
    assert df.filter(text.icontains("s", "o'neil")).count() == 1
    assert df.filter(text.icontains("s", "_")).count() == 0


def test_unreadable_dates_are_null(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-13-45",), ("soon",), ("2024",), ("2024-05",)], "s STRING")
    got = [str(r[0]) for r in df.select(parse_date("s")).collect()]
    assert got == ["2024-01-05", "None", "None", "2024-01-01", "2024-05-01"]


def payload(**fields):
    return json.dumps(fields)


FULL = {"drug_name": "n", "generic_name": "g", "indication": "i", "adverse_events": ["a"],
        "drug_interactions": ["d"], "mechanism_of_action": "m"}


def only(*names):
    return payload(**{k: FULL[k] for k in names})


SCORES = [
    (only("drug_name", "indication", "adverse_events"), 0.60, "extracted", None),
    (only("generic_name", "drug_interactions", "mechanism_of_action", "drug_name"), 0.60, "extracted", None),
    (only("drug_name", "generic_name", "drug_interactions"), 0.50, "quarantined", "low_confidence"),
    (payload(**FULL), 1.0, "extracted", None),
    (payload(adverse_events=[], drug_interactions=[]), 0.0, "quarantined", "low_confidence"),
    ("not json", 0.0, "quarantined", "schema_violation"),
    (None, 0.0, "quarantined", "schema_violation"),
    (payload(drug_name="", indication="", adverse_events=["x"]), 0.60, "extracted", None),
    (payload(drug_name=None), 0.0, "quarantined", "low_confidence"),
]


def test_score_and_route(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SCORES)], "id INT, extraction_json STRING")
    routed = ex.with_route(ex.score(df), malformed=F.col("malformed")).orderBy("id")
    got = [(r.confidence_score, r.route, r.failure_stage) for r in routed.collect()]
    assert got == [s[1:] for s in SCORES]
    good, bad = ex.route(ex.score(df))
    assert (good.count(), bad.count()) == (4, 5)


def test_run_summary_counts_every_row(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SCORES)], "id INT, extraction_json STRING")
    routed = ex.with_route(ex.score(df), malformed=F.col("malformed"))
    assert rows(ex.run_summary(routed)) == [(4, 5, 9)]
    rate = ex.quarantine_rate(routed).first()
    assert rate.alarm and rate.quarantine_pct == pytest.approx(55.56)


def test_missing_required_fields(spark):
    df = spark.createDataFrame([(payload(**FULL),), (payload(drug_name=None),), ("junk",), (None,)], "j STRING")
    got = [r[0] for r in df.select(ex.missing_fields("j")).collect()]
    assert got[0] == [] and got[1] == list(ex.REQUIRED[1:])
    assert got[2] == got[3] == list(ex.REQUIRED)


def test_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (0.9, 0.6, 0.5, 0.49, 1.0)], "s DOUBLE")
    got = [r[0] for r in df.select(scoring.score_bucket("s")).collect()]
    assert got == ["0.9–1.0", "0.6–0.7", "0.5–0.6", "< 0.5", "0.9–1.0"]


def test_stamp_has_typed_nulls(spark):
    df = ex.stamp(spark.range(1), F.lit("2024-01-01 00:00:00"), batch="b", source_url=None)
    assert dict(df.dtypes) == {"id": "bigint", "batch": "string", "source_url": "string", "extracted_at": "timestamp"}
    assert df.first().source_url is None


def test_rules_read_sections_and_text(spark):
    body = "## Brand Name: Alpha\n\nx\n\n## ADVERSE REACTIONS\n\nrash; nausea, rash"
    sections = [(0, "ADVERSE REACTIONS", "rash; nausea, rash"), (1, "1 INDICATIONS AND USAGE", "for tests")]
    df = spark.createDataFrame(
        [(body, sections)], "full_text STRING, sections ARRAY<STRUCT<ord INT, title STRING, body STRING>>"
    )
    got = json.loads(df.select(ex.label_extractor("full_text", "sections")).first()[0])
    assert got["drug_name"] == "Alpha" and got["indication"] == "for tests"
    assert got["adverse_events"] == ["rash", "nausea"]
    assert got["drug_interactions"] == [] and got["mechanism_of_action"] is None
