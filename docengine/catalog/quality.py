"""Checks, logs, dashboards, freshness and cost."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docengine.catalog import query
from docengine.catalog.common import AS_OF, chunk_sql, sql_time, table, text_time
from docengine.catalog.documents import DOCS, document_chunks
from docengine.operators import expectations as ex
from docengine.operators import monitoring as mon
from docengine.operators.joins import no_overlap_violations
from docengine.operators.model import current_flag
from docengine.plans.trust import declared_checks
from docengine.runtime import scratch_path
from docengine.sources.contracts import Contract, load_contract
from docengine.streaming.checks import checked_append

RESULT = ["check_id", "target_table", "severity", "violation_count", "row_count_total"]


def labelled(spark, d) -> DataFrame:
    """Documents with their labels: NULL quality where there is none."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.join(table(spark, d, "labels"), "doc_id", "left")


LABELLED = "(SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"


def dated_orders(spark, d) -> DataFrame:
    orders = table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return current_flag(orders, "o_custkey", "o_orderdate", "is_current")


class CheckTables(Mapping):
    """The inputs of the checks, each planned when a check asks for it."""

    SOURCES = {
        "labelled": lambda spark, d: labelled(spark, d),
        "orders": lambda spark, d: dated_orders(spark, d),
        "large_parts": lambda spark, d: table(spark, d, "part").filter("p_size > 25"),
        "prices": lambda spark, d: prices_of(spark, d),
        "chunks": lambda spark, d: document_chunks(spark, d),
    }
    PLAIN = ("documents", "labels", "customer", "lineitem", "part")

    def __init__(self, spark, d):
        self.spark, self.d, self.held = spark, d, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.held:
            if name in self.SOURCES:
                self.held[name] = self.SOURCES[name](self.spark, self.d)
            elif name in self.PLAIN:
                self.held[name] = table(self.spark, self.d, name)
            else:
                raise KeyError(name)
        return self.held[name]

    def __iter__(self):
        return iter((*self.SOURCES, *self.PLAIN))

    def __len__(self) -> int:
        return len(self.SOURCES) + len(self.PLAIN)


ORDER_DAY = "1998-06-01"
PRICES = """
    SELECT event_type AS sku_name, day AS price_start_time,
           lead(day) OVER (PARTITION BY event_type ORDER BY day) AS price_end_time, list_price
    FROM (SELECT event_type, date_trunc('day', ts) AS day, max(value) AS list_price FROM events GROUP BY ALL)"""


def prices_of(spark, d) -> DataFrame:
    """A price list: per event type and day, in force until the next day with a price."""
    daily = (
        table(spark, d, "events")
        .groupBy(F.col("event_type").alias("sku_name"),
                 F.date_trunc("day", F.col("ts").cast("timestamp")).alias("price_start_time"))
        .agg(F.max("value").alias("list_price"))
    )
    # One row per type and day.
    following = Window.partitionBy("sku_name").orderBy("price_start_time")
    return daily.withColumns(
        {"price_end_time": F.lead("price_start_time").over(following), "currency_code": F.lit("USD")}
    )


def _share_above(condition: str, pct: int, source: str) -> str:
    return (f"SELECT CASE WHEN count(*) FILTER ({condition}) * 100.0 / count(*) > {pct} "
            f"THEN count(*) FILTER ({condition}) ELSE 0 END FROM {source}")


def _groups(keys: str, source: str) -> str:
    return (f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} "
            f"GROUP BY {keys} HAVING count(*) > 1)")


# name -> (check, SQL of its violation count, what its rows are counted over)
CHECKS: dict[str, tuple[ex.Check, str, str]] = {
    "not_null": (
        ex.expect_not_null("quality_not_null", "labelled", "quality"),
        f"SELECT count(*) FROM {LABELLED} WHERE quality IS NULL", LABELLED),
    "positive": (
        ex.expect_positive("discount_positive", "lineitem", "l_discount"),
        "SELECT count(*) FROM lineitem WHERE l_discount IS NULL OR l_discount <= 0", "lineitem"),
    "completeness": (
        ex.expect_completeness("quality_completeness_95", "labelled", "quality", 95.0),
        _share_above("quality IS NULL", 5, LABELLED), LABELLED),
    "completeness_tolerated": (
        ex.expect_completeness("quality_completeness_10", "labelled", "quality", 10.0, severity=ex.WARN),
        _share_above("quality IS NULL", 90, LABELLED), LABELLED),
    "not_future": (
        ex.expect_not_future("orderdate_not_future", "orders", "o_orderdate", ORDER_DAY),
        f"SELECT count(*) FROM orders WHERE o_orderdate > DATE '{ORDER_DAY}'", "orders"),
    "between": (
        ex.expect_between("discount_within_bounds", "lineitem", "l_discount", 0.02, 0.08),
        "SELECT count(*) FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08", "lineitem"),
    "unique": (
        ex.expect_unique("line_unique", "lineitem", ["l_orderkey", "l_linenumber"]),
        _groups("l_orderkey, l_linenumber", "lineitem"), "lineitem"),
    "unique_key": (
        ex.expect_unique("orderkey_unique", "orders", "o_orderkey"), _groups("o_orderkey", "orders"), "orders"),
    "fk_exists": (
        ex.expect_fk("part_fk_exists", "lineitem", "l_partkey", "large_parts", "p_partkey"),
        "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)",
        "lineitem"),
    "not_blank": (
        ex.expect_not_blank("text_not_blank", "documents", "text"),
        "SELECT count(*) FROM documents WHERE text IS NULL OR trim(text) = ''", "documents"),
    "length": (
        ex.expect_length("text_length_bounds", "documents", "text", severity=ex.WARN),
        "SELECT count(*) FROM documents WHERE length(text) < 100 OR length(text) > 2500", "documents"),
    "sql": (
        ex.expect_sql("good_quality", "labelled", "quality = 1"),
        f"SELECT count(*) FROM {LABELLED} WHERE NOT coalesce(quality = 1, false)", LABELLED),
    "accepted": (
        ex.expect_accepted("lang_accepted", "documents", "lang", ["en", "fr"]),
        "SELECT count(*) FROM documents WHERE lang NOT IN ('en', 'fr')", "documents"),
    "row_count": (
        ex.expect_row_count("enough_labels", "labels", 5000),
        "SELECT greatest(5000 - count(*), 0) FROM labels", "labels"),
    "max_fanout": (
        ex.expect_max_fanout("part_fanout", "lineitem", "l_partkey", 35, severity=ex.WARN),
        "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_partkey HAVING count(*) > 35)", "lineitem"),
    "exactly_one": (
        ex.expect_exactly_one("one_current_order", "orders", "o_custkey", "is_current", "o_orderdate"),
        "SELECT count(*) FROM (SELECT o_custkey FROM (SELECT o_custkey, o_orderdate = max(o_orderdate) OVER "
        "(PARTITION BY o_custkey) AS f FROM orders) GROUP BY o_custkey HAVING count(*) FILTER (f) <> 1)",
        "orders"),
    "coverage": (
        ex.expect_coverage("documents_labelled", "documents", "labels", "doc_id"),
        "SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)", "documents"),
    "no_overlap": (
        ex.expect_no_overlap("prices_no_overlap", "prices", ["sku_name"], "price_start_time", "price_end_time"),
        f"SELECT count(*) FROM (SELECT price_start_time, max(price_end_time) OVER (PARTITION BY sku_name "
        f"ORDER BY price_start_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM ({PRICES})) "
        f"WHERE reached > price_start_time", f"({PRICES})"),
    "chunk_unique": (
        ex.expect_unique("chunks_chunk_id_unique", "chunks", "chunk_id"),
        _groups("id, idx", f"(WITH {chunk_sql(DOCS)} SELECT * FROM chunks)"),
        f"(WITH {chunk_sql(DOCS)} SELECT * FROM chunks)"),
}


def _result_sql(check: ex.Check, violations: str, counted: str) -> str:
    return (
        f"SELECT '{check.check_id}' AS check_id, '{check.target_table}' AS target_table, "
        f"'{check.severity}' AS severity, CAST(({violations}) AS BIGINT) AS violation_count, "
        f"(SELECT count(*) FROM {counted}) AS row_count_total"
    )


def _check_query(check: ex.Check):
    return lambda spark, d: ex.check_results(CheckTables(spark, d), [check]).select(*RESULT)


for _name, _entry in CHECKS.items():
    query(_result_sql(*_entry), name=f"check_{_name}")(_check_query(_entry[0]))

ALL_RESULTS = " UNION ALL ".join(_result_sql(*entry) for entry in CHECKS.values())
LOG_TIME = f"{AS_OF}.000000"


def all_results(spark, d) -> DataFrame:
    return ex.check_results(CheckTables(spark, d), [entry[0] for entry in CHECKS.values()])


@query(f"""
    SELECT check_id, target_table, severity, violation_count, row_count_total,
           CAST(violation_count AS VARCHAR) || ' of ' || CAST(row_count_total AS VARCHAR)
               || ' rows violated this assertion' AS message,
           'run-1' AS run_id, '{LOG_TIME}' AS checked_at
    FROM ({ALL_RESULTS}) WHERE violation_count > 0
""")
def check_log(spark, d):
    log = ex.violations_of(all_results(spark, d), "run-1", F.lit(AS_OF))
    return log.drop("layer").withColumn("checked_at", text_time("checked_at"))


@query(f"""
    SELECT 'run-1' AS run_id, count(*) AS checks_total, count(*) FILTER (violation_count = 0) AS checks_passed,
           count(*) FILTER (violation_count > 0) AS checks_failed,
           '{LOG_TIME}' AS run_started_at, '{LOG_TIME}' AS run_finished_at
    FROM ({ALL_RESULTS})
""")
def check_runs(spark, d):
    run = ex.run_row(all_results(spark, d), "run-1", F.lit(AS_OF), F.lit(AS_OF))
    return run.withColumns({c: text_time(c) for c in ("run_started_at", "run_finished_at")})


@query(f"""
    SELECT check_id, target_table, violation_count FROM ({ALL_RESULTS})
    WHERE violation_count > 0 AND severity = 'error'
""")
def gate_failures(spark, d):
    """What the severity gate stops a run for."""
    return ex.stopping(ex.violations_of(all_results(spark, d), "run-1", F.lit(AS_OF)))


STREAM_CHECKS = [
    ex.expect_not_null("quality_not_null", "labelled", "quality", severity=ex.WARN),
    ex.expect_length("text_length_bounds", "labelled", "text", severity=ex.WARN),
    ex.expect_accepted("lang_accepted", "labelled", "lang", ["en", "fr"], severity=ex.WARN),
]
BATCH_OF = "CAST(coalesce(lang <> 'en', true) AS BIGINT)"


@query(" UNION ALL ".join(
    f"SELECT {BATCH_OF} AS batch_id, '{check}' AS check_id, 'warn' AS severity, "
    f"CAST(count(*) FILTER ({bad}) AS BIGINT) AS violation_count, count(*) AS row_count_total "
    f"FROM {LABELLED} GROUP BY ALL"
    for check, bad in (("quality_not_null", "quality IS NULL"),
                       ("text_length_bounds", "length(text) < 100 OR length(text) > 2500"),
                       ("lang_accepted", "lang NOT IN ('en', 'fr')"))))
def stream_checks(spark, d):
    """Documents that arrive in two deliveries, checked while each is appended."""
    docs = labelled(spark, d).select("doc_id", "text", "lang", "quality")
    out = scratch_path(spark, "stream-checks")
    english = F.col("lang").eqNullSafe("en")
    found = None
    for delivery in (docs.filter(english), docs.filter(~english)):
        delivery.write.mode("append").parquet(f"{out}/in")
        arrived = spark.readStream.schema(docs.schema).parquet(f"{out}/in")
        found = checked_append(arrived, f"{out}/table", f"{out}/checkpoint", STREAM_CHECKS, f"{out}/log", "run-1")
    return found.select("batch_id", "check_id", "severity", "violation_count", "row_count_total")


CONTRACT = Path(__file__).resolve().parent / "contracts" / "documents.yaml"


def _contract_row(check_id: str, severity: str, count: str) -> str:
    return (f"SELECT '{check_id}' AS check_id, 'documents' AS target_table, '{severity}' AS severity, "
            f"CAST(({count}) AS BIGINT) AS violation_count, (SELECT count(*) FROM documents) AS row_count_total")


@query(" UNION ALL ".join([
    *[_contract_row(f"documents__not_null__{c}", "error", f"SELECT count(*) FROM documents WHERE {c} IS NULL")
      for c in ("doc_id", "text", "lang")],
    _contract_row("documents__doc_id_unique", "error", _groups("doc_id", "documents")),
    _contract_row("documents__text_unique", "warn", _groups("text", "documents")),
    _contract_row("documents__length_declared", "error",
                  "SELECT count(*) FROM documents WHERE NOT coalesce(n_chars = length(text), false)"),
    _contract_row("documents__short_sources", "warn",
                  "SELECT count(*) FROM documents WHERE source NOT IN ('src0', 'src1', 'src2', 'src3')"),
    _contract_row("documents__labelled", "warn",
                  "SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    _contract_row("documents__row_count", "error", "SELECT greatest(100 - count(*), 0) FROM documents"),
]))
def contract_checks(spark, d):
    """The checks a YAML contract compiles to."""
    contract = load_contract(CONTRACT)
    return ex.check_results(CheckTables(spark, d), contract.checks()).select(*RESULT)


@query(f"""
    SELECT o.sku_name, {sql_time("o.price_start_time")} AS price_start_time
    FROM (SELECT *, max(ends) OVER (PARTITION BY sku_name ORDER BY price_start_time, ends
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
          FROM (SELECT sku_name, price_start_time,
                       price_start_time + CAST(floor(list_price) AS INTEGER) * INTERVAL 1 HOUR AS ends
                FROM ({PRICES}))) o
    WHERE reached > price_start_time
""")
def overlapping_periods(spark, d):
    """Prices in force for as many hours as their amount overlap the next day's."""
    hours = F.make_dt_interval(F.lit(0), F.floor("list_price").cast("int"))
    periods = prices_of(spark, d).withColumn("price_end_time", F.col("price_start_time") + hours)
    bad = no_overlap_violations(periods, ["sku_name"], "price_start_time", "price_end_time")
    return bad.select("sku_name", text_time("price_start_time").alias("price_start_time"))


# --- dashboards -----------------------------------------------------------


@query("""
    SELECT CAST(ts AS DATE) AS run_date, count(*) FILTER (event_type <> 'error') AS checks_passed,
           count(*) FILTER (event_type = 'error') AS checks_failed,
           CAST(round(100.0 * count(*) FILTER (event_type <> 'error') / count(*), 1) AS DOUBLE) AS pass_rate_pct
    FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 30
""")
def pass_rate(spark, d):
    """A user's events of a day as a run, its errors as failed checks."""
    failed = F.count_if(F.col("event_type") == "error")
    runs = (
        table(spark, d, "events")
        .groupBy("user_id", F.date_trunc("day", "ts").alias("run_started_at"))
        .agg(F.count("*").alias("checks_total"), failed.alias("checks_failed"),
             (F.count("*") - failed).alias("checks_passed"))
    )
    return mon.pass_rate(runs).withColumn("pass_rate_pct", F.col("pass_rate_pct").cast("double"))


def violation_log(spark, d) -> DataFrame:
    """Events as a violation log: k violations of a check at a time."""
    k = F.from_json("props", "k BIGINT")["k"]
    return table(spark, d, "events").select(
        F.col("event_type").alias("check_id"), F.lit("events").alias("target_table"),
        F.when(F.col("value") > 50, "error").otherwise("warn").alias("severity"),
        k.alias("violation_count"), F.lit(100).cast("bigint").alias("row_count_total"),
        F.concat(k.cast("string"), F.lit(" rows")).alias("message"),
        F.col("event_id").cast("string").alias("run_id"), F.col("ts").cast("timestamp").alias("checked_at"),
    )


LOG = """(SELECT event_type AS check_id, 'events' AS target_table,
    CASE WHEN value > 50 THEN 'error' ELSE 'warn' END AS severity, CAST(props->>'k' AS BIGINT) AS violation_count,
    CAST(100 AS BIGINT) AS row_count_total, (props->>'k') || ' rows' AS message,
    CAST(event_id AS VARCHAR) AS run_id, ts AS checked_at FROM events)"""


@query(f"""
    SELECT check_id, target_table, severity, count(*) AS run_count_with_failure,
           CAST(sum(violation_count) AS BIGINT) AS total_violations, {sql_time("max(checked_at)")} AS last_failed_at
    FROM {LOG} WHERE checked_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS GROUP BY ALL
""")
def top_failing(spark, d):
    return mon.top_failing(violation_log(spark, d), 7, AS_OF).withColumn(
        "last_failed_at", text_time("last_failed_at")
    )


@query(f"""
    SELECT {sql_time("checked_at")} AS checked_at, run_id, check_id, target_table, severity, violation_count,
           row_count_total, message
    FROM {LOG} ORDER BY checked_at DESC, run_id, check_id LIMIT 50
""")
def recent_violations(spark, d):
    return mon.recent_violations(violation_log(spark, d)).withColumn("checked_at", text_time("checked_at"))


@query("""
    SELECT CAST(ts AS DATE) AS quarantine_date, event_type AS failure_stage, count(*) AS rows_quarantined
    FROM events GROUP BY ALL
""")
def quarantine_watch(spark, d):
    rows = table(spark, d, "events").select(
        F.col("ts").alias("quarantined_at"), F.col("event_type").alias("failure_stage")
    )
    return mon.quarantine_watch(rows)


def _fresh_sql(name: str, column: str, hours: int, source: str) -> str:
    age = f"(epoch(TIMESTAMP '{AS_OF}') - floor(epoch(max({column})))) / 3600.0"
    return f"""SELECT '{name}' AS table_path, {sql_time(f"max({column})")} AS last_loaded_at,
        {hours} AS sla_hours, CAST(round({age}, 1) AS DOUBLE) AS hours_since_load,
        CASE WHEN max({column}) IS NULL THEN 'no_data' WHEN {age} > {hours} THEN 'BREACH' ELSE 'ok' END AS sla_status
        FROM {source}"""


@query(" UNION ALL ".join([
    _fresh_sql("events", "ts", 48, "events"),
    _fresh_sql("orders", "o_orderdate", 24, "orders"),
    _fresh_sql("lineitem", "l_shipdate", 1000000, "lineitem"),
    _fresh_sql("returns", "o_orderdate", 24, "(SELECT * FROM orders WHERE o_orderstatus = 'R')"),
]))
def freshness(spark, d):
    orders = table(spark, d, "orders")
    inputs = {
        "events": table(spark, d, "events"), "orders": orders, "lineitem": table(spark, d, "lineitem"),
        "returns": orders.filter("o_orderstatus = 'R'"),
    }
    targets = [("events", "ts", 48), ("orders", "o_orderdate", 24), ("lineitem", "l_shipdate", 1000000),
               ("returns", "o_orderdate", 24)]
    return mon.freshness(spark, inputs, targets, AS_OF).withColumns(
        {"last_loaded_at": text_time("last_loaded_at"),
         "hours_since_load": F.col("hours_since_load").cast("double")}
    )


# --- cost -----------------------------------------------------------------

STAGE = r"^docs-([a-z]+)-"


def usage_of(spark, d) -> DataFrame:
    """Events as metered usage of a job named in a tag."""
    events = table(spark, d, "events").withColumn("k", F.from_json("props", "k INT")["k"])
    k = F.col("k")
    job = F.concat(F.lit("docs-"), F.col("event_type"), F.when(k < 50, "-dev").otherwise("-prod"))
    named = F.when(k < 90, job).otherwise(F.concat(F.lit("other-"), F.col("event_type")))
    return events.select(
        F.col("event_type").alias("sku_name"), F.col("ts").cast("timestamp").alias("usage_start_time"),
        F.col("value").alias("usage_quantity"), F.create_map(F.lit("job_name"), named).alias("custom_tags"),
    )


PRICED = f"""
    usage AS (
        SELECT event_type AS sku_name, ts, value, CASE
                   WHEN CAST(props->>'k' AS INTEGER) >= 90 THEN 'other-' || event_type
                   WHEN CAST(props->>'k' AS INTEGER) < 50 THEN 'docs-' || event_type || '-dev'
                   ELSE 'docs-' || event_type || '-prod' END AS job_name
        FROM events
    ),
    prices AS ({PRICES}),
    priced AS (
        SELECT u.*, p.list_price FROM usage u JOIN prices p ON p.sku_name = u.sku_name
           AND p.price_start_time <= u.ts AND (p.price_end_time IS NULL OR p.price_end_time > u.ts)
        WHERE starts_with(job_name, 'docs-') AND u.ts >= DATE '2024-01-31' - INTERVAL 14 DAYS
    )"""
BY_JOB = f"""
    WITH {PRICED}
    SELECT CAST(ts AS DATE) AS usage_date, job_name, CAST(round(sum(CAST(value AS DECIMAL(21, 8))), 2) AS DOUBLE) AS dbus_consumed,
           CAST(round(sum(CAST(value AS DECIMAL(21, 8)) * CAST(list_price AS DECIMAL(16, 12))), 2) AS DOUBLE)
               AS estimated_cost_usd
    FROM priced GROUP BY ALL"""


@query(BY_JOB)
def cost_by_job(spark, d):
    return mon.cost_by_job(usage_of(spark, d), prices_of(spark, d), "docs-", 14, AS_OF)


@query(BY_JOB)
def cost_by_job_bucketed(spark, d):
    """The same through time buckets, the way for price lists too large to send out."""
    return mon.cost_by_job(usage_of(spark, d), prices_of(spark, d), "docs-", 14, AS_OF, bucket_seconds=86400)


@query(BY_JOB)
def cost_by_job_asof(spark, d):
    """The same by carrying the last price that began: no list of periods is sent out or repeated by bucket."""
    return mon.cost_by_job(usage_of(spark, d), prices_of(spark, d), "docs-", 14, AS_OF, asof=True)


@query(f"""
    WITH {PRICED}
    SELECT regexp_extract(job_name, '{STAGE}', 1) AS stage, CAST(round(sum(CAST(value AS DECIMAL(21, 8)) * CAST(list_price AS DECIMAL(16, 12))), 2) AS DOUBLE)
               AS cost_usd_14d,
           CAST(round(sum(CAST(value AS DECIMAL(21, 8))), 2) AS DOUBLE) AS dbus_14d
    FROM priced GROUP BY 1
""")
def cost_by_stage(spark, d):
    return mon.cost_by_stage(usage_of(spark, d), prices_of(spark, d), "docs-", STAGE, 14, AS_OF)


@query(BY_JOB.replace("CAST(list_price AS DECIMAL(16, 12))", "CAST(list_price / 10000000 AS DECIMAL(16, 12))")
       .replace("CAST(value AS DECIMAL(21, 8))", "CAST(value * 1000000 AS DECIMAL(21, 8))"))
def cost_small_prices(spark, d):
    """Large quantities at prices far below a cent."""
    usage = usage_of(spark, d).withColumn("usage_quantity", F.col("usage_quantity") * 1000000)
    prices = prices_of(spark, d).withColumn("list_price", F.col("list_price") / 10000000)
    return mon.cost_by_job(usage, prices, "docs-", 14, AS_OF)


DECLARED = [
    {"name": "doc_id", "type": "BIGINT", "nullable": False},
    {"name": "text", "type": "STRING", "nullable": False},
    {"name": "lang", "type": "INTEGER"},
    {"name": "licence", "type": "STRING"},
]


@query("""
    SELECT 'documents__declared_schema' AS check_id, CAST(2 AS BIGINT) AS violation_count, CAST(4 AS BIGINT) AS row_count_total
    FROM (SELECT count(*) FROM documents)
    UNION ALL
    SELECT 'documents__' || c || '_declared_not_null',
           CAST(CASE c WHEN 'doc_id' THEN no_id ELSE no_text END AS BIGINT), n
    FROM (SELECT count(*) FILTER (doc_id IS NULL) AS no_id, count(*) FILTER (text IS NULL) AS no_text, count(*) AS n
          FROM documents), (SELECT unnest(['doc_id', 'text']) AS c)
""")
def contract_schema(spark, d):
    """Declared against actual columns: one has another type, one is missing."""
    contract = Contract("documents", columns=DECLARED)
    tables = {"documents": table(spark, d, "documents")}
    return ex.check_results(tables, declared_checks(contract, tables)).select(
        "check_id", "violation_count", "row_count_total")


@query("""
    WITH found AS (
        SELECT 'lines__quantity' AS check_id, count(*) FILTER (l_quantity IS NULL OR l_quantity <= 0) AS bad, count(*) AS n
        FROM lineitem
        UNION ALL SELECT 'lines__discount', count(*) FILTER (l_discount < 0 OR l_discount > 0.05), count(*) FROM lineitem
        UNION ALL SELECT 'lines__broken', 1, 0 FROM (SELECT count(*) FROM lineitem)
    )
    SELECT check_id, CAST(bad AS BIGINT) AS violation_count, CAST(n AS BIGINT) AS row_count_total,
           CAST(3 AS INTEGER) AS checks, CAST((SELECT count(*) FROM found WHERE bad > 0) AS INTEGER) AS failed
    FROM found WHERE bad > 0
""")
def run_log(spark, d):
    """Checks through the runner and its logs, one of which cannot be evaluated."""
    checks = [
        ex.expect_positive("lines__quantity", "lineitem", "l_quantity"),
        ex.expect_between("lines__discount", "lineitem", "l_discount", 0.0, 0.05),
        ex.expect_sql("lines__broken", "lineitem", "no_such_column > 0"),
    ]
    out = scratch_path(spark, "run-log")
    violations, run = ex.run_checks(spark, {"lineitem": table(spark, d, "lineitem")}, checks, "r1")
    ex.log_results(violations, run, f"{out}/violations", f"{out}/runs")
    runs = spark.read.parquet(f"{out}/runs")
    counts = [F.col(c) for c in runs.columns]
    logged = runs.select("run_id", counts[1].cast("int").alias("checks"), counts[3].cast("int").alias("failed"))
    return spark.read.parquet(f"{out}/violations").join(logged, "run_id").select(
        "check_id", "violation_count", "row_count_total", "checks", "failed")
