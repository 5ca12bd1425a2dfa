"""Parser and chunker against hand-worked rows and a plain-Python restatement of the rules."""

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docengine.operators.chunker import chunk, chunk_array
from docengine.operators.sections import read_sections, sections_to_text, xml_sections
from conftest import plan_of

NS = 'xmlns="urn:hl7-org:v3"'


def sections(xml):
    found = read_sections(xml if xml is None else xml.encode())
    return found if found is None else [(s["ord"], s["title"], s["body"]) for s in found]


@pytest.mark.parametrize(
    "xml, wanted",
    [
        (f"<d {NS}><section/></d>", []),
        (f"<d {NS}><section><title> A </title><text>a<b>b</b>c</text></section></d>", [(0, "A", "abc")]),
        (
            f"<d {NS}><section><title>A</title><text>x</text><section><title>B</title></section></section></d>",
            [(0, "A", "x"), (1, "B", "")],
        ),
        (f"<d {NS}><section><text>only <i>text</i></text></section></d>", [(0, "", "only text")]),
        (f"<d {NS}><section><p><title>not mine</title></p></section></d>", []),
        (f"<d {NS}><section><title>1</title><title>2</title></section></d>", [(0, "1", "")]),
        (f"<d {NS}><section><text>a<section><text>in</text></section>z</text></section></d>",
         [(0, "", "ainz"), (1, "", "in")]),
        (f"<section {NS}><title>root</title></section>", [(0, "root", "")]),
        (f"<d {NS}><section><text>a<!-- no -->b</text></section></d>", [(0, "", "ab")]),
        ('<d xmlns="other"><section><title>A</title></section></d>', []),
        ("<d><section>", None),
        (f"<d {NS}><section><text>&nope;</text></section></d>", None),
        (None, None),
    ],
)
def test_xml_sections(xml, wanted):
    assert sections(xml) == wanted


def test_xml_to_text_on_spark(spark):
    docs = [
        (1, f"<d {NS}><section><title>A</title><text>x</text></section><section><title>B</title></section></d>"),
        (2, f"<d {NS}/>"), (3, "<broken"), (4, None),
    ]
    df = spark.createDataFrame(docs, "id INT, x STRING").select("id", F.encode("x", "UTF-8").alias("x"))
    got = dict(df.select("id", sections_to_text(xml_sections("x"))).collect())
    assert got == {1: "## A\n\nx\n\n## B", 2: None, 3: None, 4: None}


def spans(size, most, overlap):
    """Start and end of every window of a body."""
    extra = math.ceil(max(0, size - most) / (most - overlap))
    return [(n * (most - overlap), n * (most - overlap) + most) for n in range(extra + 1)]


def model(text, most, overlap, least):
    """The chunk rules, restated for one text with regular expressions."""
    out = []
    for n, piece in enumerate(re.split(r"\n\n## ", text)) if text else ():
        title, body = "PREAMBLE", piece
        if n > 0 or re.match(r"\s*## ", piece):
            line, rest = re.match(r"(?s)([^\n]*)\n?(.*)", piece).groups()
            title, body = re.sub(r"\A\s*[# ]*\s*|\s+\Z", "", line) or "UNTITLED", rest
        body = re.sub(r"\A\s+|\s+\Z", "", body)
        if len(body) >= least:
            windows = [body[a:b] for a, b in spans(len(body), most, overlap)]
            out += [(title, w) for w in windows if len(w) >= least]
    return out


def run(spark, texts, most, overlap, least):
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    got = df.select("id", chunk_array("t", most, overlap, least).alias("c")).orderBy("id").collect()
    return [[tuple(c) for c in r.c or []] for r in got]


CASES = [
    "x" * 99, "x" * 100, "x" * 2000, "x" * 2001, "x" * 3800, "x" * 3801, "", None,
    "## A\n\n" + "a" * 150 + "\n\n## \n\n" + "b" * 150 + "\n\n## C\n\nshort\n\n## # D \n" + "d" * 2500,
    "intro " * 30 + "\n\n## A\nbody " + "y" * 300,
    "  \n## A\n" + "q" * 120, "## no body at all",
]


def test_hand_worked_chunks(spark):
    got = run(spark, CASES, 2000, 200, 100)
    assert [len(c) for c in got[:6]] == [0, 1, 1, 2, 2, 3]
    assert [len(c[1]) for c in got[5]] == [2000, 2000, 201]
    assert got == [model(t or "", 2000, 200, 100) for t in CASES]
    assert [c[0] for c in got[8]] == ["A", "UNTITLED", "D", "D"]


def test_short_tail_is_dropped(spark):
    assert [len(c[1]) for c in run(spark, ["z" * 120], 100, 0, 50)[0]] == [100]


letters = st.text(alphabet="ab# \né\U0001f600 ", max_size=60)
blocks = st.lists(letters, max_size=5).map("\n\n## ".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(blocks, min_size=20, max_size=40),
       st.sampled_from([(10, 0, 1), (10, 3, 5), (7, 6, 2), (5, 2, 4), (30, 20, 0)]))
def test_chunks_follow_the_rules(spark, texts, sizes):
    assert run(spark, texts, *sizes) == [model(t, *sizes) for t in texts]


def test_windows_cover_the_body(spark):
    body = "".join(chr(97 + i % 26) for i in range(12345))
    windows = [c[1] for c in run(spark, [body], 500, 77, 10)[0]]
    assert all(len(w) <= 500 for w in windows)
    assert all(a[-77:] == b[:77] for a, b in zip(windows, windows[1:-1]))
    assert windows[0] + "".join(w[77:] for w in windows[1:]) == body


def test_overlap_must_leave_a_step():
    with pytest.raises(ValueError):
        chunk_array("t", 100, 100)


def test_chunk_index_has_no_gaps_and_scan_rule_holds(spark):
    df = spark.createDataFrame([("s", "v1", CASES[8]), ("t", None, "x" * 100), ("u", "v", "x" * 101)],
                               "set_id STRING, version STRING, t STRING")
    got = chunk(df, "set_id", "t", version_col="version").select("chunk_id", "chunk_index").collect()
    assert sorted(r.chunk_id for r in got) == ["s_v1_0", "s_v1_1", "s_v1_2", "s_v1_3", "u_v_0"]
    assert chunk(df, "set_id", "t").filter("set_id = 's'").agg(F.max("chunk_index")).first()[0] == 3


def test_chunking_needs_no_shuffle_and_no_python(spark):
    df = spark.range(9).select(F.col("id").cast("string"), F.repeat(F.col("id").cast("string"), 300).alias("t"))
    plan = plan_of(chunk(df, "id", "t"))
    assert "Exchange" not in plan and "Python" not in plan
    # The array is computed once: it is not repeated in a filter.
    assert plan.count("regexp_extract_all") == 1


def test_sections_are_parsed_in_slices(monkeypatch):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    from docengine.operators import sections

    document = '<document xmlns="urn:hl7-org:v3"><section><title>T</title><text>b%d</text></section></document>'
    rows = [document % 1, None, "<broken", "", document % 2]
    monkeypatch.setattr(sections, "SLICE", 50)
    kind = to_arrow_type(sections.SECTIONS)
    for held in (rows, []):
        found = sections.parsed_slices(pa.array(held, pa.string()), sections.LABEL_NS, kind)
        assert found.type == kind and found.to_pylist() == [sections.read_sections(r) for r in held]
