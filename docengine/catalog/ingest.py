"""Ingest: raw rows, streams, summaries, pending work."""

from __future__ import annotations

from pyspark.sql import functions as F

from docengine.catalog import query
from docengine.catalog.common import AS_OF, sql_time, table, text_time
from docengine.operators.extraction import flatten_struct
from docengine.operators.ingest import daily_health, in_batch, of_type, row_count, to_raw
from docengine.operators.ingest import ingest_summary as summary
from docengine.operators.joins import pending, pending_capped, side_by_side, union_all
from docengine.operators.sections import usable_text
from docengine.operators.sketches import error_of, rolled_up, sketched
from docengine.runtime import scratch_path
from docengine.schemas import DOUBLE, TEXT, ensure_schema, layout
from docengine.sources.files import stream_table
from docengine.sources.tables import Snapshots, append_table, as_view, read_table
from docengine.streaming.ingest import append_stream, ingest_files
from docengine.streaming.widening import append_widening, read_widened

NUMBER_ID = r"/([0-9]+)(?:\.html|/)?(?:[?#][^/]*)?$"
LAST_PART = r"/([^/?#]+)/?(?:[?#][^/]*)?$"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "labels", "embeddings", "pages", "benchmark", "conversations")


@query(f"""
    SELECT url AS file_path, string_split(url, '/')[-1] AS file_name, 'html' AS file_type,
           CAST(NULL AS VARCHAR) AS source_url,
           coalesce(nullif(regexp_extract(url, '{NUMBER_ID}', 1), ''),
                    nullif(regexp_extract(url, '{LAST_PART}', 1), '')) AS set_id,
           CAST(strlen(html) AS BIGINT) AS file_size_bytes, 'run-1' AS source_batch_id,
           '2024-01-31 00:00:00.000000' AS ingest_timestamp, sha256(html) AS content_hash
    FROM pages
""")
def ingest_metadata(spark, d):
    files = table(spark, d, "pages").select(
        F.col("url").alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.octet_length("html").cast("bigint").alias("length"),
        F.encode("html", "UTF-8").alias("content"),
    )
    raw = to_raw(files, "run-1", "html", F.lit(AS_OF), (NUMBER_ID, LAST_PART))
    return raw.drop("raw_bytes", "file_modified_time").withColumn(
        "ingest_timestamp", text_time("ingest_timestamp")
    )


@query("""
    SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.xml' AS file_path,
           CAST(doc_id AS VARCHAR) AS set_id, CAST(strlen(text) AS BIGINT) AS file_size_bytes,
           sha256(text) AS content_hash
    FROM documents
""")
def ingest_stream(spark, d):
    """The documents as a stream of files, appended exactly once and read back."""
    docs = table(spark, d, "documents")
    files = stream_table(spark, d, "documents", docs.schema).select(
        F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".xml"))).alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.encode("text", "UTF-8").alias("content"),
    )
    out = scratch_path(spark, "ingest-stream")
    append_stream(to_raw(files, "run-1"), f"{out}/raw", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/raw").select("file_path", "set_id", "file_size_bytes", "content_hash")


@query(f"""
    SELECT o_orderpriority AS source_batch_id, o_orderstatus AS file_type,
           count(*) AS files_ingested, round(sum(o_totalprice) / 1e6, 2) AS total_mb,
           count(DISTINCT o_custkey) AS unique_labels,
           {sql_time("min(o_orderdate)")} AS first_file, {sql_time("max(o_orderdate)")} AS last_file
    FROM orders GROUP BY ALL
""")
def ingest_summary(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("source_batch_id"), F.col("o_orderstatus").alias("file_type"),
        F.col("o_totalprice").alias("file_size_bytes"), F.col("o_custkey").alias("set_id"),
        F.col("o_orderdate").alias("ingest_timestamp"),
    )
    return summary(rows).withColumns(
        {"first_file": text_time("first_file"), "last_file": text_time("last_file")}
    )


@query("""
    SELECT CAST(ts AS DATE) AS ingest_date, event_type, count(*) AS files,
           round(sum(value) / 1e6, 1) AS total_mb, count(DISTINCT user_id) AS unique_labels
    FROM events GROUP BY ALL
""")
def ingest_daily(spark, d):
    return daily_health(table(spark, d, "events"), "event_type", "value", "user_id", "ts")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_path, count(*) AS n FROM {t}" for t in TABLES))
def table_counts(spark, d):
    return union_all(
        [row_count(table(spark, d, t)).select(F.lit(t).alias("table_path"), "n") for t in TABLES]
    )


@query("""
    SELECT (SELECT count(*) FROM documents) AS n_documents,
           (SELECT count(*) FROM labels WHERE quality = 1) AS n_good,
           (SELECT max(n_chars) FROM documents) AS longest
""")
def scalars_side_by_side(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return side_by_side(
        spark, n_documents=row_count(docs), n_good=row_count(labels.filter("quality = 1")),
        longest=docs.agg(F.max("n_chars")),
    )


@query("""
    SELECT doc_id, source, lang, n_chars FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def pending_rows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    return pending(docs, table(spark, d, "labels"), on=["doc_id"])


@query("""
    SELECT doc_id, source, text FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY source, doc_id LIMIT 50
""")
def work_cap(spark, d):
    """The capped batch of pending work; the text is read for the chosen rows only."""
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return pending_capped(
        docs, table(spark, d, "labels"), on=["doc_id"], order=["source", "doc_id"], limit=50
    )


@query("""
    SELECT doc_id, source, lang, n_chars FROM documents
    WHERE lang = 'en' AND source IS NOT NULL AND source = 'src1' AND n_chars > 200
""")
def batch_filter(spark, d):
    """Usable texts of one type and batch."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    return usable_text(in_batch(of_type(docs, "en", "lang", "source"), "src1", "source"), "text").drop("text")


DECLARED = layout(("doc_id",), doc_id=TEXT, n_chars=DOUBLE, quality=TEXT, missing=TEXT)


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
           CAST(quality AS VARCHAR) AS quality, CAST(NULL AS VARCHAR) AS missing
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def declared_schema(spark, d):
    """A nested row flattened and brought to a declared layout."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    nested = docs.select("doc_id", F.struct("quality", "n_chars", "lang").alias("x"))
    return ensure_schema(flatten_struct(nested, "x", ("doc_id",)), DECLARED)


@query("""
    SELECT c_custkey, c_name, c_acctbal FROM customer
""")
def snapshot_rebuild(spark, d):
    """Two full rebuilds of a table; the newest version is read."""
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    kept = Snapshots(spark, scratch_path(spark, "snapshots"), customers.schema)
    kept.write(customers.filter("c_acctbal > 0"))
    kept.write(kept.read().unionByName(customers.filter("NOT coalesce(c_acctbal > 0, false)")))
    return kept.read()


@query("""
    SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY source
""")
def appended_view(spark, d):
    """Documents appended in two batches to a partitioned table, read through a view."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    path = scratch_path(spark, "appended")
    english = F.col("lang").eqNullSafe("en")
    append_table(docs.filter(english), path, partition_by=["lang"])
    append_table(docs.filter(~english), path, partition_by=["lang"])
    view = as_view(read_table(spark, path), "appended_documents")
    return view.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))


@query("""
    SELECT event_type, count(*) AS n_rows, count(DISTINCT CAST(ts AS DATE)) AS n_days,
           count(DISTINCT user_id) AS n_distinct, true AS within_3_pct
    FROM events GROUP BY event_type
""")
def distinct_rollup(spark, d):
    """Daily sketches of users, stored and united by event type, beside the exact counts."""
    events = table(spark, d, "events")
    path = scratch_path(spark, "sketches")
    append_table(sketched(events, ["event_type", F.to_date("ts").alias("day")], "user_id"), path)
    stored = read_table(spark, path)
    united = rolled_up(stored, ["event_type"]).drop("sketch")
    days = stored.groupBy("event_type").agg(F.count("*").alias("n_days"))
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("n_distinct"))
    return error_of(united, exact, ["event_type"]).join(days, "event_type").select(
        "event_type", "n_rows", "n_days", "n_distinct", (F.col("relative_error") < 0.03).alias("within_3_pct"))


@query("""
    SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice
    FROM orders
""")
def stream_widened(spark, d):
    """Finished orders streamed narrow, then the others with wider and more columns, read as one table."""
    orders = table(spark, d, "orders")
    finished = F.col("o_orderstatus").eqNullSafe("F")
    out = scratch_path(spark, "widened")
    for delivery in (
        orders.filter(finished).select("o_orderkey", F.col("o_custkey").cast("int")),
        orders.filter(~finished).select("o_orderkey", F.col("o_custkey").cast("bigint"), "o_orderpriority", "o_totalprice"),
    ):
        delivery.write.mode("append").parquet(f"{out}/in")
        arrived = spark.readStream.schema(delivery.schema).parquet(f"{out}/in")
        append_widening(arrived, f"{out}/table", f"{out}/checkpoint")
    return read_widened(spark, f"{out}/table")


@query("""
    SELECT coalesce(source, '') AS source, CAST(sum(coalesce(strlen(text), 0) + 1) AS BIGINT) AS n_bytes,
           true AS sizes_agree, true AS hashes_agree
    FROM documents GROUP BY ALL
""")
def stream_binary_files(spark, d):
    """Text files of all documents, at most 2,000 documents a file, ingested as a stream of binary files."""
    out = scratch_path(spark, "binary-files")
    docs = table(spark, d, "documents").select(F.coalesce("source", F.lit("")).alias("source"), F.col("text").alias("value"))
    docs.write.option("maxRecordsPerFile", 2000).partitionBy("source").text(f"{out}/files")
    ingest_files(spark, f"{out}/files", f"{out}/raw", f"{out}/checkpoint", "run-1", "*.txt")
    ingest_files(spark, f"{out}/files", f"{out}/raw", f"{out}/checkpoint", "run-2", "*.txt")  # nothing is new
    raw = read_table(spark, f"{out}/raw")
    source = F.regexp_extract("file_path", "/source=([^/]*)/", 1)
    return raw.groupBy(F.when(source == "__HIVE_DEFAULT_PARTITION__", "").otherwise(source).alias("source")).agg(
        F.sum("file_size_bytes").alias("n_bytes"),
        F.bool_and(F.octet_length("raw_bytes") == F.col("file_size_bytes")).alias("sizes_agree"),
        F.bool_and(F.sha2("raw_bytes", 256) == F.col("content_hash")).alias("hashes_agree"))
