"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space for stripping.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# Fixed value: a directory named by a UUID holds the files of that document.
UUID_DIR = r"/([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})/[^/]+\.xml$"
FILE_STEM = r"/([^/]+)\.xml$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Strip any Unicode white space from both ends (``trim`` strips blanks only)."""
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def lstrip(c: Column | str, chars: str = WHITESPACE) -> Column:
    return F.ltrim(as_col(c), F.lit(chars))


def extract_or_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that says NULL, not '', when nothing matches."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(as_col(c), "/"), -1)


def extract_id(c: Column | str, patterns: tuple[str, ...] = (UUID_DIR, FILE_STEM)) -> Column:
    """First pattern that matches the path wins; NULL when none does."""
    return F.coalesce(*[extract_or_null(c, p) for p in patterns])


def preview(c: Column | str, n: int) -> Column:
    return F.substring(as_col(c), 1, n)


def trim_passage(c: Column | str, limit: int = 1200) -> Column:
    """Cut a passage for display; the marker says that it was cut."""
    c = as_col(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(" …"))).otherwise(c)


def icontains(c: Column | str, needle: Column | str) -> Column:
    """Case-insensitive substring test.  A plain string is data, never a pattern."""
    needle = F.lit(needle) if isinstance(needle, str) else needle
    return F.contains(F.lower(as_col(c)), F.lower(needle))


def not_blank(c: Column | str) -> Column:
    c = as_col(c)
    return c.isNotNull() & (F.trim(c) != "")


def first_line(c: Column | str) -> Column:
    return F.substring_index(as_col(c), "\n", 1)


def after_first_line(c: Column | str) -> Column:
    """Everything behind the first line break, '' when there is none."""
    c = as_col(c)
    cut = F.locate("\n", c)
    return F.when(cut > 0, F.substring(c, cut + 1, F.length(c))).otherwise(F.lit(""))


def strip_tags(c: Column | str) -> Column:
    """Drop comments, script and style elements, then every remaining tag."""
    bare = F.regexp_replace(as_col(c), r"(?s)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>", "")
    return F.regexp_replace(bare, r"<[^>]*>", "")


def chunk_key(doc_id: Column | str, n: Column | str, version: Column | str | None = None) -> Column:
    """``<id>_<n>``, or ``<id>_<version>_<n>`` for documents kept in versions."""
    parts = [as_col(doc_id).cast("string"), as_col(n).cast("string")]
    if version is None:
        return F.concat(parts[0], F.lit("_"), parts[1])
    tag = F.coalesce(F.concat(as_col(version).cast("string"), F.lit("_")), F.lit(""))
    return F.concat(parts[0], F.lit("_"), tag, parts[1])


def render_prompts(c: Column | str, template: str, size: int = 24000) -> Column:
    """Array of prompts, one per ``size`` characters: the instruction text and that part of the document.

    Together the prompts render the whole text; an empty one gives a single
    prompt without text, NULL gives NULL.
    """
    # Cut in one pass: a substring from the start of the text per window would be quadratic.
    parts = F.regexp_extract_all(as_col(c), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    parts = F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))
    return F.when(as_col(c).isNotNull(), F.transform(parts, lambda p: F.concat(F.lit(template), p)))


def as_json(*cols: str) -> Column:
    """One row as a JSON object; NULL fields are kept."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
