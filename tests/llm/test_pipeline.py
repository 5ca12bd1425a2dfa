import inspect
import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
from helpers import awkward, clashing, component_ids, documents, hits, shingles  # noqa: E402
from test_text_operators import brute_lines  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from docengine.llm import queries  # noqa: E402

NAMES = ["toxicity", "line_templates", "near_duplicates", "decontamination", "packing"]


def test_stages_against_brute_force(spark, small, tmp_path):
    """Each stage on what its predecessor kept; what the next one reads is what this one wrote."""
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    columns, before = docs.columns, [tuple(r) for r in docs.select("doc_id", "text").collect()]
    start = len(before)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {i for i, _ in before}
            break
        assert docs.columns == columns
        after = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        if name == "toxicity":
            assert set(after) <= set(before) and 0.8 * start <= len(after) <= start
        elif name == "line_templates":
            assert sorted(after) == sorted((i, t) for i, t, _, _ in brute_lines(before))
            assert all(len(r.text) == r.n_chars for r in docs.collect())
        elif name == "near_duplicates":
            groups = component_ids(before, 80)
            keep = [(i, t) for (i, t), (_, n, c) in zip(before, groups) if i == c or not shingles(t)]
            assert sorted(after) == sorted(keep)
        else:
            clean = [(i, t) for i, t in before if not hits(t, items)[1]]
            assert sorted(after) == sorted(clean)
        before = after


def test_stages_take_awkward_tables(spark, small, tmp_path):
    for label, docs in (("awkward", clashing(documents(spark, awkward()), "row", "grade", "block", "node", "component_id")),
                        ("empty", documents(spark, []))):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, small).write.parquet(str(tmp_path / label / name))
            docs = spark.read.parquet(str(tmp_path / label / name))
            assert name == "packing" or docs.columns == columns
        assert (docs.count() > 0) == (label == "awkward")


def test_stages_keep_clashing_columns(spark, small, tmp_path):
    """Columns named as what the operators add keep their values row by row; the text says which row it is."""
    names = ("grade", "p_toxic", "n_lines", "N_DROPPED", "row", "drop_lines", "__row", "___row", "__column_1", "number")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    docs = docs.select("*", *(F.concat_ws("-", F.lit(n), F.col("doc_id")).alias(n) for n in names))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        kept = docs.select("doc_id", *(F.col(n) for n in names)).collect()
        assert kept and all(r[n] == f"{n}-{r.doc_id}" for r in kept for n in names)


def test_registered():
    found = entry.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {q[:q.index("_") + 1] for q in found if q.startswith("op")}
    assert found["pipeline"] is corpus_pipeline.run and set(queries.QUERIES) < set(found)
    assert corpus_pipeline.ORACLE_SQL is None


def test_line_templates_stage_is_native():
    from docengine.llm import line_templates

    source = inspect.getsource(line_templates)
    assert not any(x in source for x in ("mapIn", "applyIn", "udf", "pandas", "rdd"))


def test_line_templates_against_sql(spark, small):
    duckdb = __import__("pytest").importorskip("duckdb")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    wanted = db.sql(entry.oracle_sql()["op8_line_templates"])
    at = [wanted.columns.index(c) for c in ("doc_id", "text", "n_lines", "n_dropped")]
    got = queries.QUERIES["op8_line_templates"](spark, small).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r[i] for i in at) for r in wanted.fetchall())


def test_stages_leave_no_intermediate_tables(spark, small):
    """What a stage leaves in the shared folder are its rows and its verdicts, not the tables these were made from."""
    from docengine.llm.decontamination import without_benchmark
    from docengine.llm.near_duplicates import one_of_each
    from docengine.runtime import list_dirs, work_dir

    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    for run, label, left in ((lambda: one_of_each(docs), "one-of-each", ["chosen", "rows"]),
                             (lambda: without_benchmark(docs, bench), "decontamination-rows", ["dirty", "rows"])):
        before = set(list_dirs(spark, work_dir(spark)))
        found = run()
        new = [d for d in list_dirs(spark, work_dir(spark)) if d not in before]
        assert len(new) == 1 and new[0].startswith(label)
        assert list_dirs(spark, f"{work_dir(spark)}/{new[0]}") == left
        assert found.count() > 0
