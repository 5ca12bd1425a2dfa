"""Best rows, flags, merges, keys, facts, joins, retrieval over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.catalog import query
from docengine.catalog.common import table
from docengine.functions.text import as_json
from docengine.operators import model, retrieval
from docengine.operators.changes import snapshot_diff as diff_of
from docengine.operators.ingest import distinct_rows as distinct_of
from docengine.operators.joins import fk_orphans as orphans_of, with_child_count, with_dim
from docengine.operators.model import current_flag as flag_of
from docengine.runtime import materialize

ORDER_KEYS = ["o_custkey", "o_orderpriority"]


def _best():
    return [F.desc("o_totalprice"), F.desc("o_orderdate"), F.asc("o_orderkey")]


def orders_of(spark, d):
    return table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


RANKED = """
    SELECT *, CAST(o_orderdate AS DATE) AS d, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
        ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey) AS rn
    FROM orders"""


@query(f"""
    SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice, d AS o_orderdate
    FROM ({RANKED}) WHERE rn = 1
""")
def dedup_best(spark, d):
    rows = orders_of(spark, d).select(*ORDER_KEYS, "o_orderkey", "o_totalprice", "o_orderdate")
    return model.best_row(rows, ORDER_KEYS, _best())


@query("""
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
           coalesce(o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey), false) AS is_current_version
    FROM orders
""")
def current_flag(spark, d):
    rows = orders_of(spark, d).select("o_orderkey", "o_custkey", "o_orderdate")
    return flag_of(rows, "o_custkey", "o_orderdate")


@query("""
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
               AS is_current_version
    FROM orders
""")
def current_flag_strict(spark, d):
    rows = orders_of(spark, d).select("o_orderkey", "o_custkey", "o_orderdate")
    return flag_of(rows, "o_custkey", "o_orderdate", strict=True, tie_break=["o_orderkey"])


@query("""
    WITH r AS (
        SELECT *, CAST(o_orderdate AS DATE) AS d, o_orderstatus = 'F' AS is_old,
               row_number() OVER (PARTITION BY o_orderstatus = 'F', o_custkey, o_orderpriority
                   ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey) AS rn
        FROM orders
    ),
    t AS (SELECT * FROM r WHERE rn = 1 AND is_old), s AS (SELECT * FROM r WHERE rn = 1 AND NOT is_old)
    SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
           coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority,
           coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
           coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice, coalesce(s.d, t.d) AS o_orderdate
    FROM t FULL JOIN s ON t.o_custkey = s.o_custkey AND t.o_orderpriority = s.o_orderpriority
""")
def upsert_dim(spark, d):
    """Finished orders as the target, open ones as the source; the first order key stays."""
    rows = orders_of(spark, d).select(*ORDER_KEYS, "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    old = model.best_row(rows.filter("o_orderstatus = 'F'"), ORDER_KEYS, _best()).drop("o_orderstatus")
    new = model.best_row(rows.filter("o_orderstatus <> 'F'"), ORDER_KEYS, _best())
    changing = ["o_totalprice", "o_orderdate"]
    return model.upsert(old, new, ORDER_KEYS, changing, [*changing, "o_orderkey"])


@query("""
    SELECT c_custkey, c_name,
           100 + row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey) AS customer_sk
    FROM customer
""")
def surrogate_keys(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    return model.assign_keys(rows, ["c_custkey"], "customer_sk", 100)


DIM_DDL = """drug_sk BIGINT, set_id BIGINT, label_version STRING, drug_name STRING, effective_date DATE,
             score DOUBLE, is_current_version BOOLEAN, created_at TIMESTAMP"""


def _silver(orders):
    return orders.select(
        F.col("o_custkey").alias("set_id"), F.col("o_orderpriority").alias("label_version"),
        F.concat_ws("-", "o_orderstatus", "o_orderkey").alias("drug_name"),
        F.col("o_orderdate").alias("effective_date"), F.col("o_totalprice").alias("score"), "o_orderkey",
    )


def _next_dim(silver, dim):
    return model.refresh_dim(
        silver, dim, ["set_id", "label_version"],
        {"drug_name": "drug_name", "effective_date": "effective_date", "score": "score"},
        [F.desc("score"), F.desc("effective_date"), F.asc("o_orderkey")],
        as_of=F.lit("2024-01-31 00:00:00"),
    )


BUCKET = "substr(md5(CAST(set_id AS VARCHAR) || chr(31) || label_version), 1, 3)"
DIM_SQL = f"""
    src AS (
        SELECT o_custkey AS set_id, o_orderpriority AS label_version,
               o_orderstatus || '-' || CAST(o_orderkey AS VARCHAR) AS drug_name,
               CAST(o_orderdate AS DATE) AS effective_date, o_totalprice AS score, o_orderkey,
               o_orderstatus = 'F' AS is_old
        FROM orders
    ),
    old_keys AS (SELECT DISTINCT set_id, label_version FROM src WHERE is_old),
    new_keys AS (SELECT DISTINCT set_id, label_version FROM src
                 EXCEPT SELECT set_id, label_version FROM old_keys),
    keyed AS (
        SELECT set_id, label_version, row_number() OVER (ORDER BY {BUCKET}, set_id, label_version) AS drug_sk
        FROM old_keys
        UNION ALL
        SELECT set_id, label_version, (SELECT count(*) FROM old_keys)
               + row_number() OVER (ORDER BY {BUCKET}, set_id, label_version) AS drug_sk
        FROM new_keys
    ),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY set_id, label_version
                  ORDER BY score DESC, effective_date DESC, o_orderkey) AS rn
        FROM src
    ),
    dim AS (
        SELECT k.drug_sk, b.set_id, b.label_version, b.drug_name, b.effective_date, b.score,
               b.effective_date = max(b.effective_date) OVER (PARTITION BY b.set_id) AS is_current_version
        FROM best b JOIN keyed k ON k.set_id = b.set_id AND k.label_version = b.label_version
        WHERE rn = 1
    )"""


@query(f"WITH {DIM_SQL} SELECT * FROM dim")
def refresh_dim(spark, d):
    """Two refreshes: finished orders first, then all orders; the first keys stay."""
    silver = _silver(orders_of(spark, d))
    first = _silver(orders_of(spark, d).filter("o_orderstatus = 'F'"))
    empty = spark.createDataFrame([], T.StructType.fromDDL(DIM_DDL))
    dim = materialize(_next_dim(first, empty), "dim")
    return _next_dim(silver, dim).drop("created_at")


@query("""
    WITH best AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS rn FROM conversations
    ),
    members AS (
        SELECT conv_id, role, row_number() OVER (ORDER BY
                   substr(md5(CAST(conv_id AS VARCHAR) || chr(31) || role), 1, 3), conv_id, role) AS drug_sk
        FROM (SELECT DISTINCT conv_id, role FROM conversations)
    ),
    items AS (
        SELECT conv_id, role, turn, unnest(list_distinct(list_filter(
                   list_transform(string_split(text, ' '), lambda w: trim(w)), lambda w: w <> ''))) AS word
        FROM best WHERE rn = 1
    )
    SELECT m.drug_sk, i.conv_id, i.role, i.turn, i.word FROM items i JOIN members m USING (conv_id, role)
""")
def build_fact(spark, d):
    """Distinct words of the last turn of every role in a conversation."""
    rows = table(spark, d, "conversations").withColumn("words", F.split("text", " "))
    keys = ["conv_id", "role"]
    dim = model.assign_keys(rows.select(*keys).distinct(), keys, "drug_sk")
    return model.build_fact(rows, dim, keys, "words", "word", keep=["turn"], order=[F.desc("turn")])


@query("""
    SELECT p_partkey AS drug_sk, p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
""")
def explode_fact(spark, d):
    """Every word of every part name, repeats kept."""
    parts = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    dim = parts.select("p_partkey", F.col("p_partkey").alias("drug_sk"))
    return model.build_fact(parts, dim, ["p_partkey"], "words", "word", keep=[])


@query("""
    SELECT s_name, count(*) AS n_facts FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
    GROUP BY s_name ORDER BY n_facts DESC, s_name LIMIT 20
""")
def fact_counts_top(spark, d):
    dim = table(spark, d, "supplier").select(F.col("s_suppkey").alias("sk"), "s_name")
    fact = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("sk"))
    rows = model.facts_per_entity(dim, fact, "sk", "s_name", out="n_facts")
    return rows.withColumn("n_facts", F.col("n_facts").cast("bigint"))


@query("""
    SELECT c_custkey, c_name, substr(c_mktsegment, 1, 4) AS c_mktsegment_preview
    FROM customer ORDER BY c_name, c_custkey LIMIT 20
""")
def dim_preview(spark, d):
    return model.dim_preview(
        table(spark, d, "customer"), ["c_custkey", "c_name"], ["c_name", "c_custkey"], "c_mktsegment", chars=4
    )


@query("""
    SELECT p_brand, count(*) AS n_lines, sum(l_quantity) AS quantity
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand
""")
def dim_join(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    return (
        with_dim(lines, table(spark, d, "part"), "p_partkey", ["p_brand"])
        .groupBy("p_brand")
        .agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    )


@query("""
    SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders
    FROM customer
""")
def child_count(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return with_child_count(table(spark, d, "customer").select("c_custkey"), orders, "c_custkey", "n_orders")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)
""")
def fk_orphans(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return orphans_of(lines, table(spark, d, "part").filter("p_size > 25"), "l_partkey", "p_partkey")


@query("SELECT DISTINCT lang, source FROM documents")
def distinct_rows(spark, d):
    return distinct_of(table(spark, d, "documents"), "lang", "source")


def _until(spark, d, year: int):
    """Customers' best orders as they stood at the end of a year."""
    orders = orders_of(spark, d).filter(F.year("o_orderdate") <= year)
    return orders.groupBy(F.col("o_custkey").alias("chunk_id")).agg(
        F.max("o_totalprice").alias("best"), F.max("o_orderpriority").alias("chunk_text")
    )


UNTIL = """
    SELECT o_custkey AS chunk_id, max(o_totalprice) AS best, max(o_orderpriority) AS chunk_text
    FROM orders WHERE year(o_orderdate) <= {0} GROUP BY o_custkey"""


@query(f"""
    WITH o AS ({UNTIL.format(1997)}), n AS ({UNTIL.format(9999)})
    SELECT coalesce(n.chunk_id, o.chunk_id) AS chunk_id,
           CASE WHEN o.chunk_id IS NULL THEN 'insert' WHEN n.chunk_id IS NULL THEN 'delete' ELSE 'update' END
               AS change_type
    FROM o FULL JOIN n ON n.chunk_id = o.chunk_id
    WHERE o.chunk_id IS NULL OR n.chunk_id IS NULL OR o.best <> n.best OR o.chunk_text <> n.chunk_text
""")
def snapshot_diff(spark, d):
    """Customers' best orders before the last year against those of all orders."""
    return diff_of(_until(spark, d, 1997), _until(spark, d, 9999), ["chunk_id"])


# --- look-ups -------------------------------------------------------------


def _part_dim(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("drug_sk"), F.col("p_name").alias("drug_name"),
        F.col("p_brand").alias("generic_name"), F.col("p_type").alias("manufacturer"),
        (F.col("p_size") >= 25).alias("is_current_version"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")).alias("effective_date"),
    )


def _line_fact(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("drug_sk"), F.concat("l_returnflag", "l_linestatus").alias("adverse_event")
    )


PART_DIM = """
    dim AS (
        SELECT p_partkey AS drug_sk, p_name AS drug_name, p_brand AS generic_name, p_type AS manufacturer,
               p_size >= 25 AS is_current_version, DATE '2000-01-01' + p_size AS effective_date
        FROM part
    ),
    fact AS (SELECT l_partkey AS drug_sk, l_returnflag || l_linestatus AS adverse_event FROM lineitem)"""
SUMMARY_COLS = ("drug_name", "generic_name", "manufacturer", "effective_date")


@query(f"""
    WITH {PART_DIM}
    SELECT drug_name, generic_name, manufacturer, effective_date,
           (SELECT count(*) FROM fact f WHERE f.drug_sk = d.drug_sk) AS adverse_event_count
    FROM dim d WHERE contains(lower(drug_name), 'widget') OR contains(lower(generic_name), 'widget')
    ORDER BY is_current_version DESC, d.effective_date DESC, d.drug_sk LIMIT 5
""")
def entity_summary(spark, d):
    return retrieval.entity_summary(_part_dim(spark, d), _line_fact(spark, d), "Widget", cols=SUMMARY_COLS)


@query(f"""
    WITH {PART_DIM}
    SELECT DISTINCT drug_name, generic_name, manufacturer, adverse_event
    FROM fact JOIN dim USING (drug_sk) WHERE contains(lower(adverse_event), 'af')
    ORDER BY ALL LIMIT 20
""")
def find_by_event(spark, d):
    return retrieval.find_by_event(_part_dim(spark, d), _line_fact(spark, d), "af")


@query(f"""
    WITH {PART_DIM}
    SELECT CAST(json_object('drug_name', drug_name, 'adverse_event', adverse_event) AS VARCHAR) AS row_json FROM (
        SELECT DISTINCT drug_name, generic_name, manufacturer, adverse_event
        FROM fact JOIN dim USING (drug_sk) WHERE contains(lower(adverse_event), 'ro')
        ORDER BY ALL LIMIT 20)
""")
def answer_rows_json(spark, d):
    rows = retrieval.find_by_event(_part_dim(spark, d), _line_fact(spark, d), "RO")
    return rows.select(as_json("drug_name", "adverse_event").alias("row_json"))


@query(f"""
    WITH {PART_DIM},
    questions AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS question FROM part),
    counted AS (SELECT drug_sk, count(*) AS n FROM fact GROUP BY drug_sk),
    ranked AS (
        SELECT question AS question_id, d.*, row_number() OVER (PARTITION BY question
                   ORDER BY is_current_version DESC, effective_date DESC, drug_sk) AS rank
        FROM questions JOIN dim d ON contains(lower(d.drug_name), lower(question))
    )
    SELECT question_id, CAST(rank AS INTEGER) AS rank, drug_name, generic_name, manufacturer, effective_date,
           coalesce(n, 0) AS adverse_event_count
    FROM ranked LEFT JOIN counted USING (drug_sk) WHERE rank <= 5
""")
def answer_names(spark, d):
    words = table(spark, d, "part").select(F.split("p_name", " ")[0].alias("question")).distinct()
    questions = words.withColumn("question_id", F.col("question"))
    return retrieval.answer_names(
        questions, _part_dim(spark, d), _line_fact(spark, d), ["drug_name"], list(SUMMARY_COLS)
    )


@query(f"""
    WITH {PART_DIM},
    questions AS (SELECT DISTINCT l_returnflag AS question FROM lineitem),
    found AS (
        SELECT DISTINCT question AS question_id, drug_name, generic_name, adverse_event
        FROM questions JOIN fact ON contains(lower(adverse_event), lower(question)) JOIN dim USING (drug_sk)
    ),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY question_id
                   ORDER BY drug_name, generic_name, adverse_event) AS INTEGER) AS rank
        FROM found
    )
    SELECT * FROM ranked WHERE rank <= 20
""")
def answer_events(spark, d):
    flags = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("question")).distinct()
    questions = flags.withColumn("question_id", F.col("question"))
    return retrieval.answer_events(
        questions, _part_dim(spark, d), _line_fact(spark, d), ["drug_name", "generic_name"]
    )
