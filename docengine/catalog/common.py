"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.functions.text import WHITESPACE
from docengine.runtime import apply_settings
from docengine.sources.tables import read_table

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
AS_OF = "2024-01-31 00:00:00"

# White space as a DuckDB string expression.
SQL_WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def table(spark: SparkSession, where: str, name: str) -> DataFrame:
    apply_settings(spark)
    return read_table(spark, where, name)


def text_time(c: Column | str) -> Column:
    """Timestamps as text, so that results do not depend on a client's time zone."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c.cast("timestamp"), TIME_FORMAT)


def sql_time(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_strip(expr: str) -> str:
    return f"trim({expr}, {SQL_WS})"


# e-mail addresses, web addresses and digit runs of a text.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
WEB = r"https?://[^\s]+"
DIGITS = r"[0-9]+"


def chunk_sql(source: str, max_chars: int = 2000, overlap: int = 200, min_chars: int = 100) -> str:
    """SQL of the chunker over ``source(id, text)``: (id, idx, title, chunk)."""
    step = max_chars - overlap
    nl = "chr(10)"
    heading = sql_strip(f"ltrim({sql_strip(f'split_part(piece, {nl}, 1)')}, '# ')")
    rest = f"CASE WHEN instr(piece, {nl}) > 0 THEN substr(piece, instr(piece, {nl}) + 1) ELSE '' END"
    headless = f"(pos = 1 AND NOT starts_with(ltrim(piece, {SQL_WS}), '## '))"
    return f"""
    pieces AS (
        SELECT id, unnest(string_split(text, {nl} || {nl} || '## ')) AS piece,
               generate_subscripts(string_split(text, {nl} || {nl} || '## '), 1) AS pos
        FROM ({source}) WHERE length(text) > {min_chars}
    ),
    bodies AS (
        SELECT id, pos,
               CASE WHEN {headless} THEN 'PREAMBLE'
                    ELSE coalesce(nullif({heading}, ''), 'UNTITLED') END AS title,
               {sql_strip(f"CASE WHEN {headless} THEN piece ELSE {rest} END")} AS body
        FROM pieces
    ),
    kept AS (
        SELECT id, pos, title, body,
               unnest(generate_series(0, CASE WHEN length(body) <= {max_chars} THEN 0
                   ELSE CAST(ceil((length(body) - {max_chars}) / {step}.0) AS BIGINT) END)) AS w
        FROM bodies WHERE length(body) >= {min_chars}
    ),
    cut AS (
        SELECT id, pos, w, title, substr(body, w * {step} + 1, {max_chars}) AS chunk FROM kept
    ),
    chunks AS (
        SELECT id, title, chunk,
               CAST(row_number() OVER (PARTITION BY id ORDER BY pos, w) - 1 AS INTEGER) AS idx
        FROM cut WHERE length(chunk) >= {min_chars}
    )"""
