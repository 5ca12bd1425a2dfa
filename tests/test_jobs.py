"""End to end: files -> raw -> extracted -> gold -> index, with reruns; streams; snapshots; SQL parity."""

import json
import os

import pytest
from pyspark.sql import functions as F

from docengine.operators import extraction as ex
from docengine.operators.ingest import daily_health, ingest_summary
from docengine.plans import gold
from docengine.plans.extract import ExtractConfig, extract_batch
from docengine.plans.trust import contract_freshness, run_contracts
from docengine.runtime import materialize, materialized, path_exists
from docengine.schemas import TABLES, ensure_schema
from docengine.sources.files import read_files
from docengine.sources.tables import Snapshots, append_table, as_view, lookup_df, read_or_empty, read_table
from docengine.streaming.index_sync import compact, current_index, sync_index_stream, write_changes
from docengine.streaming.ingest import ingest_files
from conftest import rows

NS = 'xmlns="urn:hl7-org:v3"'


def label(name, events="rash; nausea", extra=""):
    def part(title, text):
        return f"<section><title>{title}</title><text>{text}</text></section>"

    body = part("LABEL", f"Drug name: {name}\nGeneric name: {name.lower()}ine\nVersion 3\nEffective 2024-01-05")
    body += part("1 INDICATIONS AND USAGE", f"{name} is indicated for testing. " * 12)
    body += part("6 ADVERSE REACTIONS", events) + part("7 DRUG INTERACTIONS", "warfarin") + extra
    return f"<document {NS}>{body}</document>"


def write(folder, name, content):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)


@pytest.fixture
def lake(spark, tmp_path):
    src = str(tmp_path / "in")
    write(src, "0a1b2c3d-0000-1111-2222-333344445555/l.xml", label("Alpha"))
    write(src, "beta.xml", label("Beta", "rash, , headache"))
    write(src, "short.xml", f"<document {NS}><section><title>x</title></section></document>")
    write(src, "broken.xml", "<document>")
    write(src, "weak.xml", f"<document {NS}><section><title>T</title><text>{'word ' * 80}</text></section></document>")
    write(src, "ignored.txt", "no")
    paths = {k: str(tmp_path / k) for k in ("raw", "ckpt", "extracted", "quarantine", "dim", "fact", "chunks")}
    return src, paths


def ingest(spark, src, paths, batch):
    ingest_files(spark, src, paths["raw"], paths["ckpt"], batch)
    return spark.read.parquet(paths["raw"])


def test_files_are_taken_exactly_once(spark, lake):
    src, paths = lake
    assert ingest(spark, src, paths, "b1").count() == 5
    assert ingest(spark, src, paths, "b2").count() == 5
    write(src, "deep/er/new.xml", label("Gamma"))
    raw = ingest(spark, src, paths, "b3")
    assert raw.count() == 6
    assert {r.set_id for r in raw.collect()} == {
        "0a1b2c3d-0000-1111-2222-333344445555", "beta", "short", "broken", "weak", "new"}
    assert read_files(spark, src).count() == 6
    row = ingest_summary(raw, "b3").first()
    assert (row.files_ingested, row.unique_labels) == (1, 1)
    assert daily_health(raw).first().files == 6
    assert set(TABLES["raw"].fieldNames()) <= set(raw.columns)


def run_extract(spark, paths, batch, **options):
    return extract_batch(
        spark, paths["raw"], paths["extracted"], paths["quarantine"], ExtractConfig(batch, **options)
    ).first()


def test_extraction_job(spark, lake):
    src, paths = lake
    ingest(spark, src, paths, "b1")
    capped = run_extract(spark, paths, "b1", limit=2)
    assert capped.pending_at_start == 2
    done = run_extract(spark, paths, "b2")
    assert done.pending_at_start == 3
    extracted = spark.read.parquet(paths["extracted"])
    assert sorted((r.drug_name, str(r.effective_date), r.label_version) for r in extracted.collect()) == [
        ("Alpha", "2024-01-05", "3"), ("Beta", "2024-01-05", "3")]
    stages = {r.set_id: r.failure_stage for r in spark.read.parquet(paths["quarantine"]).collect()}
    assert stages == {"short": "parse_error", "broken": "parse_error", "weak": "low_confidence"}
    # Nothing is left, rejected rows included, unless a retry is asked for.
    assert run_extract(spark, paths, "b3").pending_at_start == 0
    assert run_extract(spark, paths, "b4", retry_quarantined=True).pending_at_start == 3
    # A newer file of a known id has other content, so it is extracted.
    write(src, "v2/beta.xml", label("Beta", "dizziness"))
    ingest(spark, src, paths, "b5")
    assert run_extract(spark, paths, "b5").extracted == 1


def test_unreadable_answers_are_schema_violations(spark, lake):
    src, paths = lake
    ingest(spark, src, paths, "b1")
    row = run_extract(spark, paths, "b1", extractor=lambda text, sections: F.lit("I cannot do that"))
    assert row.extracted == 0
    stages = spark.read.parquet(paths["quarantine"]).groupBy("failure_stage").count()
    assert dict(stages.collect()) == {"parse_error": 2, "schema_violation": 3}


def test_gold_job_and_contracts(spark, lake, tmp_path):
    src, paths = lake
    ingest(spark, src, paths, "b1")
    run_extract(spark, paths, "b1")
    dim, fact, chunks = (Snapshots(spark, paths[k], TABLES[k]) for k in ("dim", "fact", "chunks"))
    extracted = spark.read.parquet(paths["extracted"])
    assert gold.refresh_gold(extracted, dim, fact, chunks) == {"dim": 1, "fact": 1, "chunks": 1}
    assert sorted(r.adverse_event for r in fact.read().collect()) == ["headache", "nausea", "rash", "rash"]
    keys = {r.set_id: r.drug_sk for r in dim.read().collect()}
    # A second run changes no row (times aside) and no key.
    gold.refresh_gold(extracted, dim, fact, chunks)
    assert {r.set_id: r.drug_sk for r in dim.read().collect()} == keys
    assert rows(fact.read(1).drop("created_at")) == rows(fact.read(2).drop("created_at"))
    assert dim.versions() == [1, 2]
    dim.keep_last(1)
    assert dim.versions() == [2]
    assert chunks.read().filter("chunk_id = 'beta_3_0'").count() == 1
    assert gold.chunks(extracted, versioned=False).filter("chunk_id = 'beta_0'").count() == 1
    tables = {"drug_label_raw": spark.read.schema(TABLES["raw"]).parquet(paths["raw"]),
              "drug_label_extracted": extracted, "dim_drug": dim.read(), "fact_adverse_events": fact.read(),
              "drug_label_chunks": chunks.read()}
    logs = str(tmp_path / "v"), str(tmp_path / "r")
    violations, run = run_contracts(spark, tables, "r1", *logs)
    assert [r.check_id for r in violations.collect()] == ["dim_drug__row_count"]
    assert spark.read.parquet(logs[1]).count() == 1
    assert {r.sla_status for r in contract_freshness(spark, tables).collect()} == {"ok"}
    broken = {**tables, "dim_drug": dim.read().withColumn("drug_sk", F.lit(99).cast("bigint"))}
    with pytest.raises(AssertionError, match="fact_ae__drug_sk_fk_exists"):
        run_contracts(spark, broken, "r2", *logs)


@pytest.mark.parametrize("limit", [2, None])
def test_raw_bytes_stay_out_of_the_joins(spark, lake, limit):
    from docengine.operators.joins import pending_capped
    from conftest import plan_of

    src, paths = lake
    raw = ingest(spark, src, paths, "b1")
    done = read_or_empty(spark, paths["extracted"], TABLES["extracted"])
    plan = plan_of(pending_capped(raw, done, on=["set_id", "content_hash"], order=["set_id"], limit=limit))
    wide = [line for line in plan.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert plan.count("raw_bytes") > 0 and not any("raw_bytes" in line for line in wide)


def test_snapshots_ignore_unfinished_versions(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"), TABLES["fact"])
    assert table.read().count() == 0
    df = spark.createDataFrame([(1, "a", "e")], "drug_sk BIGINT, set_id STRING, adverse_event STRING")
    assert table.write(df) == 1
    os.makedirs(tmp_path / "t" / "v=2")
    assert table.versions() == [1] and table.read().count() == 1
    assert table.write(table.read().union(table.read())) == 2
    assert table.read().count() == 2


def test_declared_schema_is_kept(spark, tmp_path):
    df = spark.createDataFrame([("1", "x", 5)], "drug_sk STRING, adverse_event STRING, extra INT")
    out = ensure_schema(df, TABLES["fact"])
    assert out.columns == TABLES["fact"].fieldNames() and out.first().drug_sk == 1
    with pytest.raises(Exception, match="NULL in NOT NULL column adverse_event"):
        ensure_schema(df.withColumn("adverse_event", F.lit(None).cast("string")), TABLES["fact"]).collect()
    path = str(tmp_path / "t")
    append_table(df, path, TABLES["fact"])
    append_table(df, path, TABLES["fact"])
    assert read_table(spark, path).count() == 2
    as_view(read_or_empty(spark, path, TABLES["fact"]), "facts_now")
    assert read_table(spark, "facts_now").count() == 2
    assert lookup_df(spark, [("a", 1)], "k STRING, n INT").first().n == 1


def test_materialized_copy_is_dropped(spark):
    df = spark.range(5)
    with materialized(df, "x") as copy:
        path = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert copy.count() == 5
    assert not path_exists(spark, path)
    assert materialize(df).dtypes == df.dtypes


def encoder(df):
    return df.withColumn("embedding", F.array(F.length("chunk_text").cast("double")))


def test_index_follows_a_stream_of_changes(spark, tmp_path):
    src, index, ckpt = (str(tmp_path / k) for k in ("src", "index", "ckpt"))
    schema = "chunk_id STRING, chunk_text STRING, n INT, op STRING"

    def push(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        sync_index_stream(stream, encoder, index, ckpt, order="n", cols=["chunk_text"], op_col="op")
        return rows(current_index(spark, index).select("chunk_id", "chunk_text", "embedding"))

    assert push([("a", "x", 1, "insert"), ("b", "yy", 2, "insert"), ("a", "xxx", 3, "update")]) == [
        ("a", "xxx", [3.0]), ("b", "yy", [2.0])]
    after = [("b", "y", [1.0]), ("c", "zz", [2.0])]
    assert push([("a", "xxx", 4, "delete"), ("b", "y", 5, "update"), ("c", "zz", 6, "insert")]) == after
    # A batch that is run again replaces itself.
    again = spark.createDataFrame([("c", "zz", 6, "insert"), ("a", None, 4, "delete"), ("b", "y", 5, "update")], schema)
    write_changes(again, encoder, index, 1, order="n", cols=["chunk_text"], op_col="op")
    assert rows(current_index(spark, index).select("chunk_id", "chunk_text", "embedding")) == after
    assert compact(spark, index) == 1
    assert sorted(os.listdir(index)) == ["base=1"]
    assert rows(current_index(spark, index).select("chunk_id", "chunk_text", "embedding")) == after
    assert compact(spark, index) == 1
    assert push([("d", "q", 7, "insert")]) == after + [("d", "q", [1.0])]
    assert push([("b", "", 8, "delete"), ("c", "z", 9, "update")]) == [("c", "z", [1.0]), ("d", "q", [1.0])]
    with pytest.raises(FileNotFoundError):
        current_index(spark, str(tmp_path / "nothing"))


def test_index_log_keeps_deletes_and_order(spark, tmp_path):
    schema = "chunk_id STRING, chunk_text STRING, n INT, op STRING"
    path = str(tmp_path / "index")

    def encode(rows):  # as a text encoder does: rows without text have no vector
        return rows.filter("chunk_text IS NOT NULL").withColumn("embedding", F.array(F.length("chunk_text").cast("double")))

    def change(batch, *data):
        write_changes(spark.createDataFrame(list(data), schema), encode, path, batch, order="n", cols=["chunk_text"], op_col="op")
        return rows(current_index(spark, path).select("chunk_id", "chunk_text"))

    assert change(0, ("a", "new", 10, "update"), ("b", "bb", 3, "insert")) == [("a", "new"), ("b", "bb")]
    assert change(1, ("b", None, 6, "delete"), ("a", "late", 5, "update")) == [("a", "new")]
    assert compact(spark, path) == 1
    assert change(2, ("b", "later but older", 4, "update"), ("a", "older", 9, "update")) == [("a", "new")]
    assert compact(spark, path, forget_before=100) == 2
    assert change(3, ("b", "back", 7, "insert")) == [("a", "new"), ("b", "back")]


def test_injected_extractor_may_be_an_arrow_function(spark):
    @F.pandas_udf("string")
    def answer(text):
        return text.map(lambda t: json.dumps({"drug_name": t.upper(), "adverse_events": ["x"], "indication": "i"}))

    df = spark.createDataFrame([("a",)], "full_text STRING")
    scored = ex.score(ex.extract(df, answer("full_text")))
    assert scored.select("x.drug_name", "confidence_score").first() == ("A", 0.6)
