"""Section-aware text chunks, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.text import (
    after_first_line,
    as_col,
    chunk_key,
    first_line,
    lstrip,
    strip,
)

# Section marker and the titles of untitled text.
SECTION_BREAK = "\n\n## "
HEADING = "## "
NO_HEADING = "PREAMBLE"
BLANK_HEADING = "UNTITLED"


def _let(value: Column, body) -> Column:
    """Bind ``value`` once, so that ``body`` may use it often without recomputing it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def section_array(text: Column | str) -> Column:
    """``array<struct<title, body>>`` of a text of ``## title`` blocks."""

    def titled(piece: Column) -> Column:
        heading = strip(lstrip(strip(first_line(piece)), "# "))
        title = F.coalesce(F.nullif(heading, F.lit("")), F.lit(BLANK_HEADING))
        return F.struct(title.alias("title"), strip(after_first_line(piece)).alias("body"))

    def untitled(piece: Column) -> Column:
        return F.struct(F.lit(NO_HEADING).alias("title"), strip(piece).alias("body"))

    def section(piece: Column, at: Column) -> Column:
        headless = (at == 0) & ~lstrip(piece).startswith(HEADING)
        return F.when(headless, untitled(piece)).otherwise(titled(piece))

    return F.transform(F.split(as_col(text), SECTION_BREAK), section)


def window_array(body: Column, max_chars: int, overlap: int, min_chars: int) -> Column:
    """Overlapping windows of one body.

    The body is cut once into strides of ``max_chars - overlap``; a window is
    the strides it reaches over, joined and cut to length.  Work is linear in
    the text, where one ``substring`` from the start per window is quadratic.
    """
    step = max_chars - overlap
    reach = -(-max_chars // step)
    strides = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    count = F.ceil((F.length(body) - max_chars) / step).cast("int") + 1

    def window(s: Column, i: Column) -> Column:
        return F.substring(F.array_join(F.slice(s["strides"], i, reach), ""), 1, max_chars)

    windows = _let(
        F.struct(strides.alias("strides"), count.alias("n")),
        lambda s: F.transform(F.sequence(F.lit(1), s["n"]), lambda i: window(s, i)),
    )
    # Only a last window can be short, and only when overlap < min_chars.
    if overlap < min_chars:
        windows = F.filter(windows, lambda w: F.length(w) >= min_chars)
    return F.when(F.length(body) <= max_chars, F.array(body)).otherwise(windows)


def chunk_array(
    text: Column | str, max_chars: int = 2000, overlap: int = 200, min_chars: int = 100
) -> Column:
    """``array<struct<section_title, chunk_text>>`` of the kept chunks, in text order."""
    if not 0 <= overlap < max_chars:
        raise ValueError(f"overlap must be in [0, {max_chars}), got {overlap}")
    text = as_col(text)
    sections = F.filter(section_array(text), lambda s: F.length(s["body"]) >= min_chars)
    per_section = F.transform(
        sections,
        lambda s: F.transform(
            window_array(s["body"], max_chars, overlap, min_chars),
            lambda w: F.struct(s["title"].alias("section_title"), w.alias("chunk_text")),
        ),
    )
    return F.when(text != "", F.flatten(per_section))


def chunk(
    df: DataFrame,
    id_col: str,
    text_col: str,
    keep: tuple[str, ...] = (),
    version_col: str | None = None,
    max_chars: int = 2000,
    overlap: int = 200,
    min_chars: int = 100,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per chunk, with the attributes named in ``keep`` copied onto it.

    A narrow transformation: no shuffle, no Python worker.  ``chunk_index``
    counts the kept chunks of a document from 0 without gaps.
    """
    cols = list(dict.fromkeys([id_col, *keep, *([version_col] if version_col else [])]))
    chunks = F.when(
        F.length(text_col) > min_chars, chunk_array(text_col, max_chars, overlap, min_chars)
    )
    # An outer generator and a filter behind it: in front of an inner one the
    # optimizer repeats the whole array expression to test for empty arrays.
    pieces = (
        df.select(*cols, chunks.alias("_chunks"))
        .select(*cols, F.posexplode_outer("_chunks").alias("chunk_index", "_chunk"))
        .filter(F.col("_chunk").isNotNull())
    )
    out = [
        chunk_key(id_col, "chunk_index", version_col).alias("chunk_id"),
        *cols,
        F.col("_chunk.section_title").alias("section_title"),
        "chunk_index",
        F.col("_chunk.chunk_text").alias("chunk_text"),
    ]
    if as_of is not None:
        out.append(as_of.cast("timestamp").alias("created_at"))
    return pieces.select(*out)


def chunk_stats(chunks: DataFrame, text_col: str = "chunk_text") -> DataFrame:
    """Number and length of the chunks of every section title, largest first."""
    n = F.length(text_col)
    return (
        chunks.groupBy("section_title")
        .agg(
            F.count("*").alias("n_chunks"),
            F.avg(n).cast("int").alias("avg_chars"),
            F.min(n).alias("min_chars"),
            F.max(n).alias("max_chars"),
        )
        .orderBy(F.desc("n_chunks"), "section_title")
    )


def chunks_per_document(chunks: DataFrame, id_col: str) -> DataFrame:
    """Chunks, documents and their ratio, in one pass."""
    per_id = chunks.groupBy(id_col).agg(F.count("*").alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_chunks"),
        F.count("*").alias("n_documents"),
    ).withColumn("chunks_per_document", F.try_divide(F.col("n_chunks"), F.col("n_documents")))


def chunk_preview(chunks: DataFrame, cols: tuple[str, ...] = (), n: int = 10, chars: int = 150) -> DataFrame:
    return (
        chunks.select("chunk_id", *cols, F.substring("chunk_text", 1, chars).alias("chunk_preview"))
        .orderBy("chunk_id")
        .limit(n)
    )
