"""Line de-duplication by log templates, in DataFrame functions only.

A tree of fixed depth parses every line: its number of tokens, then its first
``LEADING`` tokens, a token with a digit in it counting as a variable field.
In a leaf the most frequent token of each place makes the leaf's template;
lines that agree with it in ``AGREE`` of their places follow it, and the
places where they don't are variable fields too.  Other lines are templates of
their own, with their fields masked.  A template recurs if it occurs in
``LEAST_DOCS`` documents and between ``LEAST_CONTEXTS`` different pairs of
neighbour lines: what merely belongs to copies of a document always stands
between the same neighbours, and copies are not this operator's matter.  Lines
of recurring templates are dropped.

Every count is a hash aggregate that combines before its shuffle, so a line
that stands in a third of the documents is one row per task; the tokens of
lines are compared only in leaves with different lines, once per distinct line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import Scratch, prepare, release, small_side

LEADING = 3
LEAST_TOKENS = 3
AGREE = 0.75
LEAST_DOCS = 3
LEAST_CONTEXTS = 3
FIELD = "<*>"


def _form(line: Column) -> Column:
    """The tokens of a line with single blanks between them, variable fields masked."""
    plain = F.trim(F.when(line.contains("  "), F.regexp_replace(line, " +", " ")).otherwise(line))
    masked = F.transform(F.split(plain, " "), lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))
    return F.when(plain.rlike("[0-9]"), F.array_join(masked, " ")).otherwise(plain)


def _key(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws("\x01", *parts)))


def row_key(docs: DataFrame) -> Column:
    """Rows with equal id and text are the same document."""
    return _key(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), docs["text"])


def parsed(docs: DataFrame) -> DataFrame:
    """One row per line of at least ``LEAST_TOKENS`` tokens:

    row, line_no, leaf and body (keys of the masked line), masked (its tokens
    joined), n_tokens, and context (a 64-bit hash of the neighbour lines' masked
    tokens: only contexts of one template are ever compared).
    """
    lines = F.split("text", "\n")
    forms = docs.where(F.col("text").isNotNull()).select(
        row_key(docs).alias("row"),
        F.transform(lines, _form).alias("forms"))
    # Neighbours come from the array moved by one, so that a line's row does not carry its document.
    keys, edge, n = F.col("keys"), F.array(F.unhex(F.lit("00"))), F.size("keys")
    moved = forms.select("row", "forms", F.transform("forms", lambda m: _key(m)).alias("keys")).select(
        "row", F.col("forms").alias("masked"), keys.alias("body"),
        F.concat(edge, F.slice(keys, 1, n - 1)).alias("before"), F.concat(F.slice(keys, 2, n - 1), edge).alias("after"))
    spread = moved.select("row", F.posexplode(F.arrays_zip("masked", "body", "before", "after")).alias("line_no", "line")).select(
        "row", "line_no", "line.masked", "line.body", F.xxhash64("line.before", "line.after").alias("context"))
    n_tokens = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    return spread.withColumn("n_tokens", n_tokens).where(F.col("n_tokens") >= LEAST_TOKENS).select(
        "row", "line_no", "masked", "n_tokens",
        _key(F.col("n_tokens").cast("string"), F.substring_index("masked", " ", LEADING)).alias("leaf"),
        "body", "context")


def followed(lines: DataFrame, keys: DataFrame, scratch: Scratch) -> DataFrame:
    """(leaf, body) of the lines that follow the template of their leaf."""
    several = keys.groupBy("leaf").agg(F.min("body").alias("a"), F.max("body").alias("b")).where("a <> b").select("leaf")
    several = small_side(several, 40)
    bodies = (lines.join(several, "leaf", "left_semi").groupBy("leaf", "body", "n_tokens", "masked")
              .agg(F.count("*").alias("lines")))
    bodies = scratch.write(bodies, "bodies")  # read twice
    places = bodies.select("leaf", "lines", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    tokens = places.groupBy("leaf", "place", "token").agg(F.sum("lines").alias("lines"))
    common = tokens.groupBy("leaf", "place").agg(F.max_by("token", F.struct("lines", "token")).alias("common"))
    # All lines of a leaf have as many places: a template is as long as one line.
    template = common.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("place", "common"))).alias("common"))
    template = scratch.write(template.select("leaf", F.col("common.common").alias("common")), "template")
    release(bodies.sparkSession)
    alike = F.zip_with(F.split("masked", " "), "common", lambda token, common: token == common)
    return (bodies.join(template, "leaf").where(F.size(F.filter(alike, lambda same: same)) >= AGREE * F.col("n_tokens"))
            .select("leaf", "body"))


def named(keys: DataFrame, follow: DataFrame) -> DataFrame:
    """(row, line_no, context, template, follows): every line under the template that it counts for."""
    # A body has one leaf, so that lines need not carry theirs.
    lines = keys.select("row", "line_no", "context", "body").join(
        small_side(follow.select("body", "leaf"), 64), "body", "left")
    return lines.select("row", "line_no", "context", F.coalesce("leaf", "body").alias("template"),
                        F.col("leaf").isNotNull().alias("follows"))


def recurring(lines: DataFrame) -> DataFrame:
    """(template, follows) of the templates of ``named`` lines that recur."""
    first = lines.groupBy("template", "follows", "row").agg(F.min_by("context", "line_no").alias("context"))
    contexts = first.groupBy("template", "follows", "context").agg(F.count("*").alias("docs"))
    return (contexts.groupBy("template", "follows")
            .agg(F.sum("docs").alias("docs"), F.count("*").alias("contexts"))
            .where((F.col("docs") >= LEAST_DOCS) & (F.col("contexts") >= LEAST_CONTEXTS)).select("template", "follows"))


def without_templates(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, ``text`` without lines of recurring templates; n_lines, n_dropped (longs).

    A null text stays null with 0 lines; an empty one is one empty line and
    stays; a text of recurring lines alone becomes empty (no row is dropped).
    Rows with equal id and text count as one document and are treated alike;
    a null id is an id like others.  Columns named n_lines or n_dropped are
    replaced.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped")
    scratch = Scratch(spark, "line-templates")
    lines = parsed(docs)
    # The keys alone are written; the masked lines are read again for the few leaves that need them.
    keys = scratch.write(lines.select("row", "line_no", "leaf", "body", "context").dropDuplicates(["row", "line_no"]),
                         "keys")
    release(spark)
    follow = scratch.write(followed(lines, keys, scratch), "follow")
    scratch.drop("bodies", "template")
    release(spark)
    lines = scratch.write(named(keys, follow), "named")
    scratch.drop("keys", "follow")
    release(spark)
    found = scratch.write(recurring(lines), "found")
    release(spark)
    gone = lines.join(small_side(found, 48), ["template", "follows"], "left_semi")
    drops = scratch.write(gone.groupBy("row").agg(F.collect_set("line_no").alias("drop_lines")), "drops")
    scratch.drop("named", "found")
    release(spark)
    clash = {c: f"{c}__kept" for c in docs.columns if c in ("row", "drop_lines")}
    held = docs.withColumnsRenamed(clash)
    all_lines = F.split("text", "\n")
    dropped = F.coalesce(F.size("drop_lines"), F.lit(0))
    kept = F.array_join(F.filter(all_lines, lambda x, i: ~F.array_contains("drop_lines", i)), "\n")
    out = held.withColumn("row", row_key(held)).join(small_side(drops, 64), "row", "left")
    columns = [(F.when(dropped > 0, kept).otherwise(F.col("text")) if c == "text" else F.col(clash.get(c, c))).alias(c)
               for c in docs.columns]
    return out.select(*columns, F.coalesce(F.size(all_lines), F.lit(0)).cast("long").alias("n_lines"),
                      dropped.cast("long").alias("n_dropped"))


# The same rules in DuckDB, over a relation ``source(doc_id, text)``: relations llm_lines .. llm_kept.
def sql(source: str = "documents", prefix: str = "lt") -> str:
    return f"""
    {prefix}_docs AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS id, text FROM {source} WHERE text IS NOT NULL),
    {prefix}_cut AS (
        SELECT id, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
        FROM {prefix}_docs
    ),
    {prefix}_masked AS (
        SELECT id, text, line_no,
               list_transform(list_filter(string_split(line, ' '), lambda t: t <> ''),
                   lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END) AS tokens
        FROM {prefix}_cut
    ),
    {prefix}_forms AS (
        SELECT id, text, line_no, tokens, array_to_string(tokens, ' ') AS masked FROM {prefix}_masked
    ),
    {prefix}_ctx AS (
        SELECT *, coalesce(lag(masked) OVER w, chr(2)) || chr(1) || coalesce(lead(masked) OVER w, chr(2)) AS context
        FROM {prefix}_forms WINDOW w AS (PARTITION BY id, text ORDER BY line_no)
    ),
    {prefix}_lines AS (
        SELECT id, text, line_no, masked, context, tokens, len(tokens) AS n,
               len(tokens) || ' ' || array_to_string(tokens[1:{LEADING}], ' ') AS leaf
        FROM {prefix}_ctx WHERE len(tokens) >= {LEAST_TOKENS}
    ),
    {prefix}_bodies AS (
        SELECT leaf, masked, any_value(tokens) AS tokens, any_value(n) AS n, count(*) AS c
        FROM {prefix}_lines GROUP BY leaf, masked
    ),
    {prefix}_places AS (
        SELECT leaf, masked, n, c, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place
        FROM {prefix}_bodies WHERE leaf IN (SELECT leaf FROM {prefix}_bodies GROUP BY leaf HAVING count(*) > 1)
    ),
    {prefix}_common AS (
        SELECT leaf, place, token AS common FROM (
            SELECT leaf, place, token, row_number() OVER (PARTITION BY leaf, place ORDER BY sum(c) DESC, token DESC) AS k
            FROM {prefix}_places GROUP BY leaf, place, token) WHERE k = 1
    ),
    {prefix}_follow AS (
        SELECT p.leaf, p.masked FROM {prefix}_places p JOIN {prefix}_common m ON p.leaf = m.leaf AND p.place = m.place
        GROUP BY p.leaf, p.masked, p.n
        HAVING sum(CASE WHEN p.token = m.common THEN 1 ELSE 0 END) >= {AGREE} * p.n
    ),
    {prefix}_named AS (
        SELECT l.id, l.text, l.line_no, l.context, f.leaf IS NOT NULL AS follows,
               CASE WHEN f.leaf IS NOT NULL THEN l.leaf ELSE l.masked END AS template
        FROM {prefix}_lines l LEFT JOIN {prefix}_follow f ON l.leaf = f.leaf AND l.masked = f.masked
    ),
    {prefix}_first AS (
        SELECT follows, template, id, text, arg_min(context, line_no) AS context
        FROM {prefix}_named GROUP BY follows, template, id, text
    ),
    {prefix}_found AS (
        SELECT follows, template FROM {prefix}_first GROUP BY follows, template
        HAVING count(*) >= {LEAST_DOCS} AND count(DISTINCT context) >= {LEAST_CONTEXTS}
    ),
    {prefix}_drop AS (
        SELECT n.id, n.text, n.line_no FROM {prefix}_named n
        JOIN {prefix}_found f ON n.follows = f.follows AND n.template = f.template
    ),
    {prefix}_kept AS (
        SELECT c.id, c.text,
               string_agg(c.line, chr(10) ORDER BY c.line_no) FILTER (WHERE d.line_no IS NULL) AS kept,
               count(*) AS n_lines, count(d.line_no) AS n_dropped
        FROM {prefix}_cut c LEFT JOIN {prefix}_drop d ON c.id = d.id AND c.text = d.text AND c.line_no = d.line_no
        GROUP BY c.id, c.text
    )"""


QUERY_SQL = f"""WITH {sql()}
SELECT d.doc_id, coalesce(k.kept, CASE WHEN d.text IS NULL THEN NULL ELSE '' END) AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN lt_kept k ON coalesce(CAST(d.doc_id AS VARCHAR), '') = k.id AND d.text = k.text"""
