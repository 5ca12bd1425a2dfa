"""Embedding, similarity and passage search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from docengine.catalog import query
from docengine.catalog.common import chunk_sql, table
from docengine.catalog.documents import DOCS, document_chunks
from docengine.catalog.model import UNTIL, _until
from docengine.functions.text import trim_passage
from docengine.operators import embedding, latent, lexical, retrieval
from docengine.operators import similarity as sim
from docengine.operators import vector_index as vi
from docengine.runtime import materialize, scratch_path
from docengine.sources.files import stream_table
from docengine.streaming.index_sync import current_index, sync_index_stream

DIM = 64
PLANES = sim.hyperplanes(DIM, 4)


def vectors(spark, d):
    return table(spark, d, "embeddings")


def label_queries(spark, d):
    """One query per label: the mean vector of its members."""
    return sim.centroids(vectors(spark, d), ["label"], "embedding").withColumnRenamed("label", "query_id")


CENTROIDS = """
    positions AS (
        SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings
    ),
    queries AS (
        SELECT label AS query_id, list(x ORDER BY pos) AS q
        FROM (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM positions GROUP BY label, pos) GROUP BY label
    )"""
SCORE = "round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6)"


def _ranked(source: str, k: int) -> str:
    return f"""
    scored AS ({source}),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored
    ),
    hits AS (SELECT * FROM ranked WHERE rank <= {k})"""


@query(f"""
    WITH {CENTROIDS},
    {_ranked(f"SELECT query_id, vec_id, {SCORE} AS score, label FROM embeddings CROSS JOIN queries", 5)}
    SELECT query_id, vec_id, score, rank, label FROM hits
""")
def similarity_batch(spark, d):
    return sim.similarity_topk(
        vectors(spark, d), label_queries(spark, d), 5, "vec_id", "embedding", cols=["label"]
    )


@query("""
    WITH positions AS (
        SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings
    ),
    q AS (SELECT list(x ORDER BY pos) AS q
          FROM (SELECT pos, avg(CAST(x AS DOUBLE)) AS x FROM positions GROUP BY pos))
    SELECT vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS score
    FROM embeddings CROSS JOIN q ORDER BY score DESC, vec_id LIMIT 5
""")
def similarity_topk(spark, d):
    """One query: the mean of all vectors."""
    one = sim.centroids(vectors(spark, d).withColumn("query_id", F.lit(0)), ["query_id"], "embedding")
    hits = sim.similarity_topk(vectors(spark, d), one, 5, "vec_id", "embedding", cols=["label"])
    return hits.select("vec_id", "label", "score")


@query(f"""
    WITH {CENTROIDS},
    {_ranked(f"SELECT query_id, vec_id, {SCORE} AS score FROM embeddings CROSS JOIN queries", 3)}
    SELECT query_id, vec_id, score, rank FROM hits
""")
def similarity_tiled(spark, d):
    """In slices of a few queries: the way for query sets that are too large to send out at once."""
    return sim.similarity_topk(
        vectors(spark, d), label_queries(spark, d), 3, "vec_id", "embedding", max_query_bytes=2048
    )


def _plane_sql(vec: str) -> str:
    bits = []
    for i, plane in enumerate(np.asarray(PLANES)):
        numbers = ", ".join(repr(float(x)) for x in plane)
        bits.append(
            f"CASE WHEN list_dot_product(CAST({vec} AS DOUBLE[]), CAST([{numbers}] AS DOUBLE[])) >= 0"
            f" THEN {1 << i} ELSE 0 END"
        )
    return "(" + " + ".join(bits) + ")"


@query(f"SELECT vec_id, CAST({_plane_sql('embedding')} AS INTEGER) AS cell FROM embeddings")
def similarity_cells(spark, d):
    return sim.with_cells(vectors(spark, d), "vec_id", "embedding", PLANES).select("vec_id", "cell")


@query(f"""
    WITH {CENTROIDS},
    cells AS (SELECT *, {_plane_sql('embedding')} AS cell FROM embeddings),
    probes AS (SELECT *, {_plane_sql('q')} AS cell FROM queries),
    pairs AS (SELECT query_id, vec_id, q, embedding, bit_count(xor(c.cell, p.cell)) AS flips
              FROM cells c CROSS JOIN probes p),
    reach AS (
        SELECT query_id, min(r) AS r FROM (
            SELECT query_id, g.r, count(*) FILTER (flips <= g.r) AS n
            FROM pairs CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS r) g GROUP BY query_id, g.r)
        WHERE n >= 5 OR r = 4 GROUP BY query_id
    ),
    {_ranked(f"SELECT p.query_id, vec_id, {SCORE} AS score FROM pairs p JOIN reach USING (query_id) WHERE flips <= r", 5)}
    SELECT query_id, vec_id, score, rank FROM hits
""")
def similarity_approx(spark, d):
    index = sim.with_cells(vectors(spark, d), "vec_id", "embedding", PLANES)
    return sim.similarity_approx(index, label_queries(spark, d), 5, PLANES, "vec_id", "embedding")


def _stored(spark, d, recall=None):
    """The index of all vectors, written, and opened by its path alone."""
    path = scratch_path(spark, "vector-index")
    vi.build_index(spark, vectors(spark, d), path, "vec_id", "embedding", recall=recall)
    return vi.open_index(spark, path)


@query(f"""
    WITH {CENTROIDS},
    {_ranked(f"SELECT query_id, vec_id, {SCORE} AS score, label FROM embeddings CROSS JOIN queries", 5)}
    SELECT query_id, vec_id, score, rank, label FROM hits
""")
def stored_search(spark, d):
    """An index built, reopened and searched by its codes: bounds make the result exact."""
    hits = vi.search(_stored(spark, d), label_queries(spark, d), 5)
    return vi.show(hits, vectors(spark, d), "vec_id", ["label"])


@query()
def stored_search_recall(spark, d):
    """The same index probed for a recall of 0.97: measured recall, and share of the vectors' bytes read."""
    index = _stored(spark, d, recall=0.97)
    queries = materialize(label_queries(spark, d), "queries")
    cost = vi.Cost(int(index.counts.sum()), index.dim)
    hits = vi.search(index, queries, 5, probes=index.probes, cost=cost).withColumnRenamed("id", "vec_id")
    exact = sim.similarity_topk(vectors(spark, d), queries, 5, "vec_id", "embedding")
    return sim.recall(hits, exact, "query_id", "vec_id").select(
        "recall", F.lit(cost.share).alias("share_read"), F.lit(len(index.counts)).alias("lists"),
        F.lit(index.probes).alias("probes"))


@query(f"""
    WITH queries AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings WHERE vec_id % 100 = 0),
    {_ranked("SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), "
             "CAST(q AS DOUBLE[])), 6) AS score FROM embeddings CROSS JOIN queries", 5)}
    SELECT query_id, vec_id, score, rank FROM hits
""")
def similarity_join(spark, d):
    """The stated query set, rows whose id is divisible by 100, met with the stored index by list."""
    asked = vectors(spark, d).filter(F.col("vec_id") % 100 == 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    return vi.search_join(_stored(spark, d), asked, 5).withColumnRenamed("id", "vec_id")


def passage_index(spark, d):
    """Vectors of documents; the label stands for the entity."""
    return vectors(spark, d).withColumnRenamed("label", "set_id")


def passages(spark, d):
    """What is shown of a hit, fetched for the hits only."""
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("vec_id"), F.col("source").alias("drug_name"),
        F.col("lang").alias("section_title"), F.col("text").alias("chunk_text"),
    )


def options(spark, d):
    return {
        "id_col": "vec_id", "vec_col": "embedding", "display": passages(spark, d),
        "cols": ["drug_name", "section_title", "chunk_text"],
    }


PASSAGES = """
    passages AS (SELECT vec_id, embedding, label AS set_id FROM embeddings),
    shown AS (SELECT doc_id, source AS drug_name, lang AS section_title, text AS chunk_text FROM documents)"""
CUT = "CASE WHEN length(chunk_text) > 1200 THEN substr(chunk_text, 1, 1200) || ' …' ELSE chunk_text END"


def _passage_hits(where: str = "") -> str:
    return f"""WITH {CENTROIDS}, {PASSAGES},
    {_ranked(f"SELECT query_id, {SCORE} AS score, p.* FROM passages p CROSS JOIN queries {where}", 5)}"""


@query(f"""{_passage_hits()}
    SELECT query_id, vec_id, score, rank, drug_name, section_title, {CUT} AS chunk_text
    FROM hits LEFT JOIN shown ON doc_id = vec_id""")
def search_passages(spark, d):
    return retrieval.search_passages(passage_index(spark, d), label_queries(spark, d), **options(spark, d))


LARGE_SETS = """set_id IN (SELECT label FROM embeddings GROUP BY label
    HAVING count(*) >= (SELECT avg(n) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label)))"""


@query(f"""{_passage_hits("WHERE " + LARGE_SETS)}
    SELECT query_id, vec_id, score, rank, drug_name, section_title, {CUT} AS chunk_text
    FROM hits LEFT JOIN shown ON doc_id = vec_id""")
def search_within(spark, d):
    """Only passages of the sets that are larger than the average set."""
    sizes = vectors(spark, d).groupBy(F.col("label").alias("set_id")).agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") >= sizes.agg(F.avg("n")).scalar())
    return retrieval.search_within(passage_index(spark, d), large, label_queries(spark, d), **options(spark, d))


@query(f"""{_passage_hits()}
    SELECT query_id, coalesce(string_agg(line, chr(10) ORDER BY line), '') AS sources
    FROM (SELECT DISTINCT query_id, drug_name || ' — ' || section_title AS line
          FROM hits LEFT JOIN shown ON doc_id = vec_id) GROUP BY query_id""")
def citations(spark, d):
    hits = retrieval.search_passages(passage_index(spark, d), label_queries(spark, d), **options(spark, d))
    return retrieval.citations(hits)


def _bm25(source: str, k: int) -> str:
    """Hits of the benchmark's texts over ``source`` (id, text)."""
    split = "string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')"
    part = "tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / (SELECT avg(len) FROM lens)))"
    return f"""
    words AS (SELECT * FROM (SELECT id, unnest({split}) AS term FROM ({source})) WHERE term <> ''),
    asked AS (SELECT DISTINCT * FROM (SELECT item_id AS query_id, unnest({split}) AS term FROM benchmark)),
    lens AS (SELECT id, count(*) AS len FROM words GROUP BY id),
    counts AS (SELECT id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY id, term),
    weights AS (SELECT term, ln(1 + ((SELECT count(*) FROM lens) - count(*) + 0.5) / (count(*) + 0.5)) AS weight
                FROM counts GROUP BY term),
    scores AS (SELECT query_id, id, round(sum(weight * {part}), 6) AS score
               FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lens USING (id)
               GROUP BY query_id, id),
    hits AS (SELECT * FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM scores)
        WHERE rank <= {k})"""


def _answered(spark, d, passages, id_col, text_col, k):
    """Benchmark texts as questions over the stored postings of ``passages``."""
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    path = scratch_path(spark, "lexical")
    lexical.build_lexical(spark, passages, path, id_col, text_col, lexical.asked_words(asked, "query_id", "text"))
    return lexical.search(lexical.open_lexical(spark, path), asked, k).withColumnRenamed("id", id_col)


@query(f"WITH {_bm25(DOCS, 10)} SELECT query_id, id AS doc_id, score, rank FROM hits")
def lexical_search(spark, d):
    return _answered(spark, d, table(spark, d, "documents"), "doc_id", "text", 10)


@query(f"""
    WITH {chunk_sql(DOCS)},
    passages AS (SELECT CAST(id AS VARCHAR) || '_' || CAST(idx AS VARCHAR) AS id, id AS doc_id, title, chunk FROM chunks),
    {_bm25("SELECT id, chunk AS text FROM passages", 5)}
    SELECT query_id, id AS chunk_id, score, rank, doc_id, source, title AS section_title,
           {CUT.replace("chunk_text", "chunk")} AS chunk_text
    FROM hits JOIN passages USING (id) JOIN documents USING (doc_id)
""")
def text_search(spark, d):
    """Benchmark texts as questions, answered by passages of all documents with what a citation names."""
    chunks = document_chunks(spark, d, ("source", "lang"))
    hits = _answered(spark, d, chunks, "chunk_id", "chunk_text", 5)
    shown = sim.with_columns(hits, chunks, "chunk_id", ["doc_id", "source", "section_title", "chunk_text"])
    return shown.withColumn("chunk_text", trim_passage("chunk_text", 1200))


@query()
def text_search_dense(spark, d):
    """Benchmark texts as questions against embedded chunks of all documents."""
    chunks = document_chunks(spark, d, ("source", "lang"))
    encoder = embedding.fit_encoder(chunks, "chunk_text", dim=512)
    index = materialize(embedding.embed(chunks, "chunk_text", encoder), "index")
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("chunk_text"))
    queries = embedding.embed(asked, "chunk_text", encoder, "query_vec").select("query_id", "query_vec")
    return retrieval.search_passages(index, queries, cols=["doc_id", "source", "section_title", "chunk_text"])


@query()
def latent_recall(spark, d):
    """Documents by a stored latent encoder; of every hundredth, without its last quarter, whether its text is found."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    path = scratch_path(spark, "latent")
    latent.write_latent(spark, latent.fit_latent(docs, "text"), path)
    encoder = latent.open_latent(spark, path)
    own = docs.withColumn("text_hash", F.xxhash64("text"))
    index = materialize(own.filter(F.col("text").isNotNull()).select("doc_id", "text_hash", encoder("text").alias("embedding")), "index")
    cut = F.col("text").substr(F.lit(1), (F.length("text") * 0.75).cast("int"))
    asked = own.filter((F.col("doc_id") % 100 == 0) & (F.length("text") > 0)).select(
        F.col("doc_id").alias("query_id"), F.col("text_hash").alias("asked_hash"), encoder(cut).alias("query_vec"))
    asked = materialize(asked, "asked")
    hits = sim.similarity_topk(index, asked, 5, "doc_id", "embedding", cols=["text_hash"])
    found = hits.join(asked.select("query_id", "asked_hash"), "query_id").groupBy("query_id").agg(
        F.max((F.col("text_hash") == F.col("asked_hash")).cast("int")).alias("found"))
    return found.agg(F.count("*").alias("n_queries"), F.avg("found").alias("recall")).withColumn(
        "rank", F.lit(len(encoder.singular)))


def _encode(rows):
    """A stand-in encoder: two numbers of the row as its vector."""
    return rows.withColumn(
        "embedding", F.array(F.col("best").cast("double"), F.length("chunk_text").cast("double"))
    )


@query(f"""
    SELECT chunk_id, chunk_text, best AS first, CAST(length(chunk_text) AS DOUBLE) AS second
    FROM ({UNTIL.format(9999)})
""")
def index_sync(spark, d):
    """The index as it stood before the last year, brought to all orders by its changes."""
    old, new = _until(spark, d, 1997), _until(spark, d, 9999)
    index = embedding.build_index(old, _encode, cols=["chunk_text"])
    synced = embedding.sync_index(index, old, new, _encode, cols=["chunk_text"])
    return synced.select(
        "chunk_id", "chunk_text", F.col("embedding")[0].alias("first"), F.col("embedding")[1].alias("second")
    )


@query("""
    SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS chunk_id, arg_max(event_id, event_id) AS event_id,
           arg_max(value, event_id) AS first
    FROM events GROUP BY event_type, user_id HAVING arg_max(event_type, event_id) <> 'error'
""")
def index_sync_stream(spark, d):
    """Events as a stream of changes of (type, user); an error event deletes its key."""
    events = table(spark, d, "events")
    changes = stream_table(spark, d, "events", events.schema).select(
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("chunk_id"), "event_id", "value",
        F.when(F.col("event_type") == "error", "delete").otherwise("update").alias("change_type"),
    )
    out = scratch_path(spark, "index-sync")
    sync_index_stream(
        changes, lambda rows: rows.withColumn("embedding", F.array("value")), f"{out}/index",
        f"{out}/checkpoint", order="event_id", cols=["event_id"], op_col="change_type",
    )
    index = current_index(spark, f"{out}/index")
    return index.select("chunk_id", "event_id", F.col("embedding")[0].alias("first"))
