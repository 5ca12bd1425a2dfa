"""The expression library over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docengine.catalog import query
from docengine.catalog.common import AS_OF, sql_strip, sql_time, table, text_time
from docengine.functions import dates, text


@query(f"""
    SELECT doc_id, md5({sql_strip("text")}) AS stripped_md5, split_part(text, chr(10), 1) AS head,
           md5(CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END) AS rest_md5,
           substr(text, 1, 80) AS preview,
           CASE WHEN length(text) > 1200 THEN substr(text, 1, 1200) || ' …' ELSE text END AS passage,
           contains(lower(text), 'mail') AS mentions_mail, starts_with(text, 'The') AS starts_the,
           CAST(length(text) AS INTEGER) AS n, trim(text) <> '' AS not_blank
    FROM documents
""")
def fn_text(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.md5(text.strip("text")).alias("stripped_md5"), text.first_line("text").alias("head"),
        F.md5(text.after_first_line("text")).alias("rest_md5"), text.preview("text", 80).alias("preview"),
        text.trim_passage("text").alias("passage"), text.icontains("text", "MAIL").alias("mentions_mail"),
        F.col("text").startswith("The").alias("starts_the"), F.length("text").alias("n"),
        text.not_blank("text").alias("not_blank"),
    )


@query("""
    SELECT page_id, string_split(url, '/')[-1] AS base_name,
           nullif(regexp_extract(url, '^https?://([^/]+)/', 1), '') AS host,
           starts_with(url, 'https') AS secure, CAST(len(string_split(url, '/')) AS INTEGER) AS n_parts,
           CAST(page_id AS VARCHAR) || '_0' AS chunk_id
    FROM pages
""")
def fn_paths(spark, d):
    return table(spark, d, "pages").select(
        "page_id", text.base_name("url").alias("base_name"),
        text.extract_or_null("url", r"^https?://([^/]+)/").alias("host"),
        F.col("url").startswith("https").alias("secure"), F.size(F.split("url", "/")).alias("n_parts"),
        text.chunk_key("page_id", F.lit(0)).alias("chunk_id"),
    )


@query(f"""
    SELECT event_id, CAST(ts AS DATE) AS day, ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS AS in_week,
           ts >= DATE '2024-01-31' - INTERVAL 14 DAYS AS in_fortnight,
           CAST(round((epoch(TIMESTAMP '{AS_OF}') - floor(epoch(ts))) / 3600.0, 1) AS DOUBLE) AS age_hours,
           {sql_time("ts - INTERVAL 3 DAYS")} AS shifted
    FROM events
""")
def fn_dates(spark, d):
    ts = F.col("ts").cast("timestamp")
    age = dates.hours_between(dates.moment(AS_OF), ts)
    return table(spark, d, "events").select(
        "event_id", F.to_date("ts").alias("day"), dates.since("ts", 7, AS_OF).alias("in_week"),
        dates.since_date("ts", 14, AS_OF).alias("in_fortnight"),
        F.round(age, 1).cast("double").alias("age_hours"),
        text_time(ts - F.make_dt_interval(F.lit(3))).alias("shifted"),
    )


@query("""
    SELECT doc_id, try_cast(nullif(regexp_extract(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}'), '') AS DATE) AS written,
           CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words, string_split(text, ' ')[-1] AS last_word,
           md5(array_to_string(list_transform(string_split(text, ' '), lambda w: lower(w)), '|')) AS lower_words
    FROM documents
""")
def fn_arrays(spark, d):
    words = F.split("text", " ")
    return table(spark, d, "documents").select(
        "doc_id", dates.parse_date(F.regexp_extract("text", "[0-9]{4}-[0-9]{2}-[0-9]{2}", 0)).alias("written"),
        F.size(words).alias("n_words"), F.element_at(words, -1).alias("last_word"),
        F.md5(F.array_join(F.transform(words, lambda w: F.lower(w)), "|")).alias("lower_words"),
    )


@query("""
    SELECT doc_id, CAST(json_object('doc_id', doc_id, 'lang', lang, 'quality', quality) AS VARCHAR) AS row_json,
           quality IS NOT DISTINCT FROM toxic AS same, CAST(coalesce(quality = 1, false) AS INTEGER) AS weight,
           coalesce(quality, -1) AS filled, nullif(lang, 'en') AS other_lang,
           CAST(floor(n_chars / 7.0) AS INTEGER) AS sevenths
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def fn_conditions(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    rows = docs.join(table(spark, d, "labels"), "doc_id", "left")
    return rows.select(
        "doc_id", text.as_json("doc_id", "lang", "quality").alias("row_json"),
        F.col("quality").eqNullSafe(F.col("toxic")).alias("same"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int").alias("weight"),
        F.coalesce("quality", F.lit(-1)).alias("filled"), F.nullif("lang", F.lit("en")).alias("other_lang"),
        (F.col("n_chars") / 7.0).cast("int").alias("sevenths"),
    )


@query("""
    SELECT p_partkey, try_cast(strftime(DATE '2001-01-29' + p_size, '%Y-%m-%d') AS DATE) AS stated,
           try_cast(CASE WHEN p_size % 2 = 0 THEN strftime(DATE '2001-01-29' + p_size, '%Y-%m-%d')
                    ELSE '2001-02-' || lpad(CAST(p_size AS VARCHAR), 2, '0') END AS DATE) AS written
    FROM part
""")
def written_dates(spark, d):
    """Dates inside a text; every other part's may not exist."""
    day = F.date_format(F.date_add(F.lit("2001-01-29").cast("date"), F.col("p_size")), "yyyy-MM-dd")
    odd = F.concat(F.lit("2001-02-"), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    texts = table(spark, d, "part").select(
        "p_partkey", day.alias("day"),
        F.concat(F.col("p_name"), F.lit(" of "), F.when(F.col("p_size") % 2 == 0, day).otherwise(odd), F.lit(".")).alias("text"))
    found = F.regexp_extract("text", r" of ([0-9]{4}-[0-9]{2}-[0-9]{2})\.$", 1)
    return texts.select("p_partkey", dates.parse_date("day").alias("stated"), dates.parse_date(found).alias("written"))
