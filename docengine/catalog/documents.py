"""Sections, chunks, extraction, scoring, routing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.catalog import query
from docengine.catalog.common import DIGITS, EMAIL, WEB, chunk_sql, sql_strip, table
from docengine.functions.text import render_prompts
from docengine.operators import chunker, extraction as ex
from docengine.operators.model import best_row
from docengine.operators.monitoring import score_histogram as histogram
from docengine.operators.sections import LABEL_NS, explode_sections, parse_sections, sections_to_text

STRIP_TAGS = (
    "regexp_replace(regexp_replace({0}, '(?s)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>',"
    " '', 'g'), '<[^>]*>', '', 'g')"
)


def _strip_tags(expr: str) -> str:
    return sql_strip(STRIP_TAGS.format(expr))


H1 = r"(?s)<h1\b[^>]*>(.*?)</h1>"
PAGE_SECTIONS = rf"""
    blocks AS (
        SELECT page_id, unnest(regexp_extract_all(html, '(?s)<article\b[^>]*>(.*?)</article>', 1)) AS inner_html,
               generate_subscripts(regexp_extract_all(html, '(?s)<article\b[^>]*>(.*?)</article>', 1), 1) AS pos
        FROM pages
    ),
    parsed AS (
        SELECT page_id, CAST(pos - 1 AS INTEGER) AS ord,
               {_strip_tags(f"regexp_extract(inner_html, '{H1}', 1)")} AS title,
               {_strip_tags(rf'''(CASE WHEN regexp_matches(inner_html, '{H1}')
                    THEN regexp_extract(inner_html, '(?s)^(.*?)<h1\b', 1)
                         || regexp_extract(inner_html, '(?s)</h1>(.*)$', 1)
                    ELSE inner_html END)''')} AS body
        FROM blocks
    ),
    sections AS (SELECT * FROM parsed WHERE title <> '' OR body <> ''),
    texts AS (
        SELECT page_id AS id,
               string_agg({sql_strip("'## ' || title || chr(10) || chr(10) || body")},
                          chr(10) || chr(10) ORDER BY ord) AS text
        FROM sections GROUP BY page_id
    )"""


def page_texts(spark, d):
    pages = table(spark, d, "pages").select("page_id", "html")
    parsed = parse_sections(pages, "html", kind="html")
    return parsed.select("page_id", sections_to_text("sections").alias("full_text"))


@query(f"WITH {PAGE_SECTIONS} SELECT page_id, ord, title, body FROM sections")
def html_sections(spark, d):
    pages = table(spark, d, "pages").select("page_id", "html")
    return explode_sections(parse_sections(pages, "html", kind="html"), keep=("page_id",))


@query(f"WITH {PAGE_SECTIONS} SELECT page_id, text AS full_text FROM pages LEFT JOIN texts ON id = page_id")
def sections_text(spark, d):
    return page_texts(spark, d)


@query(f"""
    WITH {PAGE_SECTIONS}, {chunk_sql("SELECT id, text FROM texts", 1000, 100, 100)}
    SELECT CAST(id AS VARCHAR) || '_' || CAST(idx AS VARCHAR) AS chunk_id, id AS page_id,
           title AS section_title, idx AS chunk_index, chunk AS chunk_text
    FROM chunks
""")
def section_chunks(spark, d):
    return chunker.chunk(page_texts(spark, d), "page_id", "full_text", max_chars=1000, overlap=100)


# Labels made of pages: a section for each paragraph, every fourth without a
# title, three of them nested in each other; each fifth page ends too early.
PARAGRAPH = "<p>(?:<b>)?([^<]+)"
XML_SECTIONS = f"""
    paragraphs AS (
        SELECT page_id, unnest(regexp_extract_all(html, '{PARAGRAPH}', 1)) AS body,
               generate_subscripts(regexp_extract_all(html, '{PARAGRAPH}', 1), 1) - 1 AS k
        FROM pages WHERE page_id % 5 <> 0
    ),
    said AS (
        SELECT page_id, k, CASE WHEN k % 4 = 3 THEN '' ELSE 'Part ' || k END AS title, {sql_strip("body")} AS body
        FROM paragraphs
    ),
    sections AS (
        SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS ord, title, body
        FROM said WHERE title <> '' OR body <> ''
    ),
    texts AS (
        SELECT page_id AS id,
               string_agg({sql_strip("'## ' || title || chr(10) || chr(10) || body")},
                          chr(10) || chr(10) ORDER BY ord) AS text
        FROM sections GROUP BY page_id
    )"""


def labels_xml(spark, d):
    """(page_id, xml): labels with nested sections, some of them broken."""
    pages = table(spark, d, "pages").select("page_id", F.regexp_extract_all("html", F.lit(PARAGRAPH), F.lit(1)).alias("p"))

    def section(text, k):
        title = F.when(k % 4 == 3, "").otherwise(F.concat(F.lit("Part "), k.cast("string")))
        said = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit(">"), F.lit("&gt;"))
        closed = F.when((k % 3 == 2) | (k == F.size("p") - 1), k % 3 + 1).otherwise(0)
        return F.concat(F.lit("<component><section><title>"), title, F.lit("</title><text><paragraph>"), said,
                        F.lit("</paragraph></text>"), F.repeat(F.lit("</section></component>"), closed))

    end = F.when(F.col("page_id") % 5 == 0, "").otherwise("</document>")
    return pages.select("page_id", F.concat(
        F.lit(f'<document xmlns="{LABEL_NS}">'), F.array_join(F.transform("p", section), ""), end).alias("xml"))


@query(f"WITH {XML_SECTIONS} SELECT page_id, ord, title, body FROM sections")
def xml_sections(spark, d):
    """Nested sections in document order; a document that cannot be read gives none."""
    return explode_sections(parse_sections(labels_xml(spark, d), "xml"), keep=("page_id",))


@query(f"""
    WITH {XML_SECTIONS}, {chunk_sql("SELECT id, text FROM texts", 400, 50, 60)}
    SELECT CAST(id AS VARCHAR) || '_' || CAST(idx AS VARCHAR) AS chunk_id, id AS page_id,
           title AS section_title, idx AS chunk_index, chunk AS chunk_text
    FROM chunks
""")
def xml_section_chunks(spark, d):
    """Chunks of texts of many sections, cut at their headings first."""
    parsed = parse_sections(labels_xml(spark, d), "xml")
    texts = parsed.select("page_id", sections_to_text("sections").alias("full_text"))
    return chunker.chunk(texts, "page_id", "full_text", max_chars=400, overlap=50, min_chars=60)


DOCS = "SELECT doc_id AS id, text FROM documents"


def document_chunks(spark, d, keep=()):
    docs = table(spark, d, "documents").select("doc_id", "text", *keep)
    return chunker.chunk(docs, "doc_id", "text", keep)


@query(f"""
    WITH {chunk_sql(DOCS)}
    SELECT CAST(id AS VARCHAR) || '_' || CAST(idx AS VARCHAR) AS chunk_id, id AS doc_id, d.source, d.lang,
           title AS section_title, idx AS chunk_index, chunk AS chunk_text
    FROM chunks JOIN documents d ON d.doc_id = chunks.id
""")
def chunk_windows(spark, d):
    return document_chunks(spark, d, ("source", "lang"))


@query(f"""
    WITH {chunk_sql(DOCS, 300, 200, 150)}
    SELECT id AS doc_id, idx AS chunk_index, chunk AS chunk_text FROM chunks
""")
def chunk_windows_dense(spark, d):
    """Overlap beyond the stride: a window spans several strides."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return chunker.chunk(docs, "doc_id", "text", max_chars=300, overlap=200, min_chars=150).select(
        "doc_id", "chunk_index", "chunk_text"
    )


@query(f"""
    WITH {chunk_sql(DOCS)}
    SELECT title AS section_title, count(*) AS n_chunks, CAST(floor(avg(length(chunk))) AS INTEGER) AS avg_chars,
           CAST(min(length(chunk)) AS INTEGER) AS min_chars, CAST(max(length(chunk)) AS INTEGER) AS max_chars
    FROM chunks GROUP BY title
""")
def chunk_stats(spark, d):
    """Flagship: all documents chunked and summarised; only partial counts are shuffled."""
    return chunker.chunk_stats(document_chunks(spark, d))


@query("""
    SELECT md5(text) AS text_md5, min(doc_id) AS doc_id, min(n_chars) AS n_chars FROM documents GROUP BY 1
""")
def dedup_texts(spark, d):
    """One document per text; copies are told by their digest, so no text is shuffled."""
    docs = table(spark, d, "documents").select(F.md5("text").alias("text_md5"), "doc_id", "n_chars")
    return best_row(docs, ["text_md5"], [F.asc("doc_id")])


@query(f"""
    WITH {chunk_sql(DOCS)}
    SELECT count(*) AS n_chunks, count(DISTINCT id) AS n_documents,
           count(*) / CAST(count(DISTINCT id) AS DOUBLE) AS chunks_per_document
    FROM chunks
""")
def chunks_per_document(spark, d):
    return chunker.chunks_per_document(document_chunks(spark, d), "doc_id")


@query(f"""
    WITH {chunk_sql(DOCS)}
    SELECT CAST(id AS VARCHAR) || '_' || CAST(idx AS VARCHAR) AS chunk_id, title AS section_title,
           substr(chunk, 1, 150) AS chunk_preview
    FROM chunks ORDER BY chunk_id LIMIT 10
""")
def chunk_preview(spark, d):
    return chunker.chunk_preview(document_chunks(spark, d), ("section_title",))


@query("""
    WITH windows AS (
        SELECT doc_id, text, unnest(generate_series(0, greatest(0, CAST(ceil(length(text) / 2000.0) AS BIGINT) - 1))) AS n
        FROM documents
    ),
    prompts AS (SELECT doc_id, n, 'Read the text.' || chr(10) || substr(text, n * 2000 + 1, 2000) AS prompt FROM windows)
    SELECT doc_id, CAST(n AS INTEGER) AS n, md5(prompt) AS prompt_md5, CAST(length(prompt) AS INTEGER) AS prompt_chars
    FROM prompts
""")
def render_prompt(spark, d):
    prompts = render_prompts("text", "Read the text.\n", size=2000)
    docs = table(spark, d, "documents").select("doc_id", F.posexplode(prompts).alias("n", "prompt"))
    return docs.select("doc_id", "n", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("prompt_chars"))


@query("""
    SELECT event_id, CAST(props->>'k' AS INTEGER) AS k, NOT json_valid(props) AS malformed FROM events
""")
def payload_parse(spark, d):
    schema = T.StructType.fromDDL("k INT")
    events = table(spark, d, "events").select("event_id", "props")
    parsed = events.withColumn("x", ex.parse_payload("props", schema))
    return parsed.select("event_id", "x.k", ex.is_malformed("props", "x").alias("malformed"))


@query("""
    SELECT d.doc_id, l.doc_id IS NULL AS malformed,
           CASE WHEN l.doc_id IS NULL THEN 'quality,toxic'
                WHEN l.toxic = 0 THEN 'toxic' ELSE '' END AS missing
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def schema_violations(spark, d):
    """Labelled rows answer in JSON (without zero flags), the others in prose."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    answer = F.to_json(F.struct("quality", F.nullif("toxic", F.lit(0)).alias("toxic")))
    payload = F.when(F.col("quality").isNotNull(), answer).otherwise(F.col("text"))
    schema = T.StructType.fromDDL("quality INT, toxic INT")
    rows = docs.select("doc_id", payload.alias("payload"))
    parsed = rows.withColumn("x", ex.parse_payload("payload", schema))
    return parsed.select(
        "doc_id",
        ex.is_malformed("payload", "x").alias("malformed"),
        F.array_join(ex.missing_fields("payload", ("quality", "toxic")), ",").alias("missing"),
    )


RULES = {
    "drug_name": ex.Rule("first", EMAIL, needs="@"),
    "generic_name": ex.Rule("first", WEB, needs="://"),
    "adverse_events": ex.Rule("all", DIGITS),
    "drug_interactions": ex.Rule("all", WEB, needs="://"),
}


def extracted_documents(spark, d):
    """Payload found by rules in the whole text, parsed back to types."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "text")
    with_json = ex.extract(docs, ex.rule_extractor(RULES, "text")).drop("text")
    return with_json.withColumn("x", ex.parse_payload("extraction_json"))


@query(f"""
    SELECT doc_id, nullif(regexp_extract(text, '{EMAIL}'), '') AS drug_name,
           nullif(regexp_extract(text, '{WEB}'), '') AS generic_name,
           array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{DIGITS}'))), ',') AS adverse_events,
           false AS malformed
    FROM documents
""")
def rule_extract(spark, d):
    return extracted_documents(spark, d).select(
        "doc_id", "x.drug_name", "x.generic_name",
        F.array_join(F.array_sort("x.adverse_events"), ",").alias("adverse_events"),
        ex.is_malformed("extraction_json", "x").alias("malformed"),
    )


def routed_documents(spark, d):
    """Extraction plus labels, scored and routed.

    The label is attached after the extraction, so the text crosses no shuffle.
    """
    from docengine.functions.scoring import weighted_score

    rows = extracted_documents(spark, d).join(table(spark, d, "labels"), "doc_id", "left")
    x = F.col("x")
    score = weighted_score(
        [
            (x["drug_name"].isNotNull(), "0.20"),
            (x["generic_name"].isNotNull(), "0.15"),
            (F.col("quality") == 1, "0.20"),
            (F.size("x.adverse_events") > 0, "0.20"),
            (F.size("x.drug_interactions") > 0, "0.15"),
            (F.col("toxic") == 0, "0.10"),
        ]
    )
    return ex.with_route(
        rows.withColumn("confidence_score", score),
        parse_failed=F.col("n_chars") <= 200,
        malformed=ex.is_malformed("extraction_json", "x"),
    )


SCORED_SQL = f"""
    found AS (
        SELECT doc_id, n_chars, nullif(regexp_extract(text, '{EMAIL}'), '') AS email,
               nullif(regexp_extract(text, '{WEB}'), '') AS web,
               list_distinct(regexp_extract_all(text, '{DIGITS}')) AS digits,
               list_distinct(regexp_extract_all(text, '{WEB}')) AS webs
        FROM documents
    ),
    scored AS (
        SELECT f.*, CAST(CAST(email IS NOT NULL AS INT) * 0.20 + CAST(web IS NOT NULL AS INT) * 0.15
                  + CAST(coalesce(quality = 1, false) AS INT) * 0.20 + CAST(len(digits) > 0 AS INT) * 0.20
                  + CAST(len(webs) > 0 AS INT) * 0.15 + CAST(coalesce(toxic = 0, false) AS INT) * 0.10
                  AS DOUBLE) AS confidence_score
        FROM found f LEFT JOIN labels l ON l.doc_id = f.doc_id
    ),
    routed AS (
        SELECT *, CASE WHEN n_chars <= 200 THEN 'parse_error'
                       WHEN confidence_score < 0.6 THEN 'low_confidence' END AS failure_stage
        FROM scored
    )"""


@query(f"WITH {SCORED_SQL} SELECT doc_id, confidence_score FROM scored")
def confidence(spark, d):
    return routed_documents(spark, d).select("doc_id", "confidence_score")


@query(f"WITH {SCORED_SQL} SELECT doc_id, confidence_score, email AS drug_name, web AS generic_name, "
       "'run-1' AS source_batch_id, 'rules' AS model_endpoint, 'v1' AS prompt_version "
       "FROM routed WHERE failure_stage IS NULL")
def route_good(spark, d):
    good = routed_documents(spark, d).filter("route = 'extracted'")
    flat = good.select("doc_id", "confidence_score", "x.drug_name", "x.generic_name")
    return ex.stamp(
        flat, source_batch_id="run-1", model_endpoint="rules", prompt_version="v1"
    ).drop("extracted_at")


@query(f"WITH {SCORED_SQL} SELECT doc_id, failure_stage, CAST(confidence_score AS VARCHAR) AS failure_reason "
       "FROM routed WHERE failure_stage IS NOT NULL")
def route_quarantine(spark, d):
    bad = routed_documents(spark, d).filter("route = 'quarantined'")
    return bad.select("doc_id", "failure_stage", F.col("confidence_score").cast("string").alias("failure_reason"))


@query(f"""WITH {SCORED_SQL}
    SELECT count(*) FILTER (failure_stage IS NULL) AS extracted,
           count(*) FILTER (failure_stage IS NOT NULL) AS quarantined, count(*) AS pending_at_start,
           'run-1' AS batch_id
    FROM routed""")
def run_summary(spark, d):
    return ex.run_summary(routed_documents(spark, d), batch_id="run-1")


@query(f"""WITH {SCORED_SQL}
    SELECT count(*) FILTER (failure_stage IS NOT NULL) AS quarantined, count(*) AS total,
           CAST(round(count(*) FILTER (failure_stage IS NOT NULL) * 100.0 / count(*), 2) AS DOUBLE) AS quarantine_pct,
           count(*) FILTER (failure_stage IS NOT NULL) * 100.0 / count(*) > 5 AS alarm
    FROM routed""")
def quarantine_rate(spark, d):
    return ex.quarantine_rate(routed_documents(spark, d)).withColumn(
        "quarantine_pct", F.col("quarantine_pct").cast("double")
    )


@query(f"""WITH {SCORED_SQL}
    SELECT CASE WHEN confidence_score >= 0.9 THEN '0.9–1.0' WHEN confidence_score >= 0.8 THEN '0.8–0.9'
                WHEN confidence_score >= 0.7 THEN '0.7–0.8' WHEN confidence_score >= 0.6 THEN '0.6–0.7'
                WHEN confidence_score >= 0.5 THEN '0.5–0.6' ELSE '< 0.5' END AS confidence_bucket,
           count(*) AS labels
    FROM scored GROUP BY 1""")
def score_histogram(spark, d):
    return histogram(routed_documents(spark, d))


@query(f"""WITH {SCORED_SQL}
    SELECT doc_id, confidence_score, CAST(len(digits) AS INTEGER) AS n_adverse_events,
           CAST(len(webs) AS INTEGER) AS n_interactions, substr(email, 1, 120) AS drug_name_preview
    FROM scored ORDER BY confidence_score DESC, doc_id LIMIT 20""")
def extraction_preview(spark, d):
    rows = routed_documents(spark, d).select("doc_id", "confidence_score", "x.*")
    return ex.extraction_preview(
        rows, "confidence_score",
        {"adverse_events": "n_adverse_events", "drug_interactions": "n_interactions"},
        "drug_name", ("doc_id",),
    )
