"""Documents in mark-up -> ordered (title, body) sections -> text."""

from __future__ import annotations

from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from docengine.functions.text import WHITESPACE, as_col, strip, strip_tags

SECTIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("ord", T.IntegerType()),
            T.StructField("title", T.StringType()),
            T.StructField("body", T.StringType()),
        ]
    )
)
# Characters or bytes of documents whose sections are Python objects at a time.
SLICE = 1 << 20
# Fixed value: name space of the label documents.
LABEL_NS = "urn:hl7-org:v3"


class _SectionReader:
    """One forward pass over an XML document; no tree is built.

    ``path`` holds one entry per open element: the section it opened, if any.
    ``taking`` holds the text buffers that are open at this point.
    """

    def __init__(self, ns: str):
        self.names = {f"{ns} {part}": part for part in ("section", "title", "text")}
        self.path: list[dict | None] = []
        self.taking: list[tuple[int, list[str]]] = []
        self.found: list[dict] = []

    def start(self, name, _attrs):
        part = self.names.get(name)
        opened = None
        owner = self.path[-1] if self.path else None
        if part == "section":
            opened = {}
            self.found.append(opened)
        elif part and owner is not None and part not in owner:
            owner[part] = []
            self.taking.append((len(self.path), owner[part]))
        self.path.append(opened)

    def data(self, text):
        for _, buffer in self.taking:
            buffer.append(text)

    def end(self, _name):
        self.path.pop()
        if self.taking and self.taking[-1][0] == len(self.path):
            self.taking.pop()

    @staticmethod
    def entity(name, _is_parameter):
        raise ValueError(f"undefined entity {name}")

    def sections(self) -> list[dict]:
        out = []
        for found in self.found:
            title = "".join(found.get("title", ())).strip(WHITESPACE)
            body = "".join(found.get("text", ())).strip(WHITESPACE)
            if title or body:
                out.append({"ord": len(out), "title": title, "body": body})
        return out


def read_sections(content: bytes | None, ns: str = LABEL_NS) -> list[dict] | None:
    """Sections of one document; NULL for a NULL or unreadable document."""
    if content is None:
        return None
    reader = _SectionReader(ns)
    parser = expat.ParserCreate(namespace_separator=" ")
    parser.buffer_text = True
    parser.StartElementHandler = reader.start
    parser.EndElementHandler = reader.end
    parser.CharacterDataHandler = reader.data
    parser.SkippedEntityHandler = reader.entity
    try:
        parser.Parse(content, True)
    except (expat.ExpatError, ValueError):
        return None
    return reader.sections()


def parsed_slices(content: pa.Array, ns: str, kind: pa.DataType) -> pa.Array:
    """Sections of a batch of documents; what is held beside the two Arrow arrays is ``SLICE`` or one document."""
    done, found, size = [], [], 0
    for document in content:
        document = document.as_py()
        found.append(read_sections(document, ns))
        size += len(document or ())
        if size > SLICE:
            done.append(pa.array(found, kind))
            found, size = [], 0
    return pa.concat_arrays([*done, pa.array(found, kind)])


def xml_sections(content: Column | str, ns: str = LABEL_NS) -> Column:
    """Sections at any depth, in document order; a nested one follows its parent.

    Arbitrary nesting is out of reach of the built-in XML functions, and
    ``xpath`` fails the whole job on one malformed document, so this is the
    engine's only parser in a Python worker - fed in Arrow batches.
    """

    kind = to_arrow_type(SECTIONS)

    @F.arrow_udf(SECTIONS)
    def parse(batch: pa.Array) -> pa.Array:
        return parsed_slices(batch, ns, kind)

    return parse(as_col(content))


def html_sections(html: Column | str, block: str = "article", heading: str = "h1") -> Column:
    """Sections of web pages: one per ``block`` element, titled by its first ``heading``."""

    def section(inner: Column, at: Column) -> Column:
        head = rf"(?s)<{heading}\b[^>]*>(.*?)</{heading}>"
        title = strip(strip_tags(F.regexp_extract(inner, head, 1)))
        rest = F.concat(
            F.regexp_extract(inner, rf"(?s)\A(.*?)<{heading}\b", 1),
            F.when(
                F.regexp_like(inner, F.lit(head)),
                F.regexp_extract(inner, rf"(?s)</{heading}>(.*)\z", 1),
            ).otherwise(inner),
        )
        return F.struct(
            at.cast("int").alias("ord"), title.alias("title"), strip(strip_tags(rest)).alias("body")
        )

    blocks = F.regexp_extract_all(
        as_col(html), F.lit(rf"(?s)<{block}\b[^>]*>(.*?)</{block}>"), F.lit(1)
    )
    return F.filter(
        F.transform(blocks, section), lambda s: (s["title"] != "") | (s["body"] != "")
    )


def parse_sections(df: DataFrame, col: str, kind: str = "xml", out: str = "sections", **options) -> DataFrame:
    reader = {"xml": xml_sections, "html": html_sections}[kind]
    return df.withColumn(out, reader(col, **options))


def explode_sections(df: DataFrame, col: str = "sections", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per section; documents without one give none."""
    return df.select(*keep, F.inline_outer(col)).filter(F.col("ord").isNotNull())


def sections_to_text(sections: Column | str) -> Column:
    """``## title`` blocks joined by a blank line; NULL when there is no section."""
    sections = as_col(sections)
    blocks = F.transform(
        sections, lambda s: strip(F.concat(F.lit("## "), s["title"], F.lit("\n\n"), s["body"]))
    )
    return F.when(F.size(sections) > 0, F.array_join(blocks, "\n\n"))


def usable_text(df: DataFrame, col: str = "full_text", min_chars: int = 200) -> DataFrame:
    """Rows whose text is longer than ``min_chars``."""
    return df.filter(F.length(col) > min_chars)
