"""Registered queries: embedding, wire formats, similarity, search, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.catalog import sql
from vecloom.catalog.registry import load_table, register
from vecloom.catalog.rows import documents, faulty_vectors, missing_text
from vecloom.functions import models
from vecloom.functions.vector import (
    as_float_vector,
    cosine_similarity,
    dot_product,
    euclidean_distance,
    l2_normalize,
)
from vecloom.operators import ann, chunk, quality, search, wire
from vecloom.operators.embed import (
    EmbeddingConfig,
    HashingProvider,
    HostedProvider,
    ModelProvider,
    RandomProvider,
    create_embedding_provider,
    embed_queries,
)
from vecloom.session import work_path
from vecloom.sources.store import VectorTable

DIMS = 64
DOCS = "SELECT doc_id AS key, text FROM documents"
ASKED = "SELECT item_id AS key, text FROM benchmark"
SPOKEN = "SELECT conv_id || '-' || turn AS key, text FROM conversations"


def hashing(dims: int = DIMS) -> HashingProvider:
    return HashingProvider(EmbeddingConfig("hashing", dims))


def cells(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Vectors as (key, i, value) rows, for comparison value by value."""
    value = (F.round(F.col("_value").cast("double"), 6) + 0.0).alias("value")
    return df.select(key, F.posexplode(vector).alias("_i", "_value")).select(
        key, F.col("_i").cast("bigint").alias("i"), value
    )


# --- embedding -----------------------------------------------------------------------------

PROVIDER_SUMMARY = " UNION ALL ".join(
    f"SELECT '{name}' AS provider, count(*) AS rows_in, count(*) AS not_null, count(*) AS right_dims,"
    f" true AS passes FROM documents"
    for name in ("random", "custom", "hosted", "hashing")
)


@register("embedding_provider", PROVIDER_SUMMARY)
def embedding_provider(spark, folder):
    """All providers behind one interface."""
    config = EmbeddingConfig("bge-large-en", DIMS, key_column="doc_id")
    found = [
        create_embedding_provider(name, config).check(documents(spark, folder)).withColumn("provider", F.lit(name))
        for name in ("random", "custom", "hosted", "hashing")
    ]
    return reduce(DataFrame.unionByName, found)


@register(
    "embed_random",
    """WITH coefficient AS (SELECT i, ('0x' || substr(md5('a-' || i), 1, 8))::BIGINT >> 1 AS a,
        ('0x' || substr(md5('b-' || i), 1, 8))::BIGINT >> 1 AS b,
        ('0x' || substr(md5('c-' || i), 1, 8))::BIGINT >> 1 AS c FROM range(32) r(i)),
    seed AS (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT >> 1 AS s1,
        ('0x' || substr(md5(doc_id::VARCHAR), 9, 8))::BIGINT >> 1 AS s2 FROM documents)
    SELECT doc_id, i, round((((a * s1 + b * s2 + c) % 2147483647) >> 7) / 16777216::DOUBLE, 6) AS value
    FROM seed, coefficient""",
)
def embed_random(spark, folder):
    provider = RandomProvider(EmbeddingConfig("random", 32, key_column="doc_id"))
    return cells(provider.add_embeddings(documents(spark, folder)), "doc_id")


@register("embed_model", sql.hashed_cells(DOCS, DIMS, "doc_id"))
def embed_model(spark, folder):
    provider = ModelProvider(EmbeddingConfig("custom", DIMS), lambda: models.HashingEncoder(DIMS))
    return cells(provider.add_embeddings(documents(spark, folder)), "doc_id")


@register(
    "embed_hosted",
    f"""WITH split AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> '') AS words
        FROM documents),
    numbered AS (SELECT doc_id, unnest(words) AS text, unnest(range(len(words))) AS place FROM split),
    span AS (SELECT doc_id, place // 128 AS w, count(*) AS n_words FROM numbered GROUP BY ALL),
    {sql.token_cells("SELECT doc_id, place // 128 AS w, text FROM numbered", DIMS, "doc_id, w")},
    pooled AS (SELECT c.doc_id, c.b, sum(coalesce(c.v / nullif(n.n, 0), 0) * s.n_words) AS v
        FROM cell c JOIN norm n USING (doc_id, w) JOIN span s USING (doc_id, w) GROUP BY ALL),
    total AS (SELECT doc_id, sqrt(sum(v * v)) AS n FROM pooled GROUP BY ALL)
    SELECT d.doc_id, i, round(coalesce(p.v / nullif(t.n, 0), 0)::FLOAT::DOUBLE, 6) + 0.0 AS value
    FROM documents d CROSS JOIN range({DIMS}) r(i)
    LEFT JOIN pooled p ON p.doc_id = d.doc_id AND p.b = r.i LEFT JOIN total t ON t.doc_id = d.doc_id""",
)
def embed_hosted(spark, folder):
    """Long texts in windows of 128 words, averaged; nothing is cut off."""
    provider = HostedProvider(EmbeddingConfig("hosted", DIMS), max_units=128, count_units=models.word_units)
    return cells(provider.add_embeddings(documents(spark, folder)), "doc_id")


@register("embed_hashing", sql.hashed_cells(DOCS, DIMS, "doc_id"))
def embed_hashing(spark, folder):
    return cells(hashing().add_embeddings(documents(spark, folder)), "doc_id")


@register("create_embedding_provider", sql.hashed_cells(ASKED, 32, "item_id"))
def made_provider(spark, folder):
    provider = create_embedding_provider("hashing", EmbeddingConfig("hashing", 32))
    return cells(provider.add_embeddings(load_table(spark, folder, "benchmark")), "item_id")


@register("encode_batch", sql.hashed_cells(SPOKEN, DIMS, "turn_id"))
def encode_batch(spark, folder):
    """A model that gives raw counts, called 64 texts at a time; the vectors get unit length."""
    turns = load_table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "text"
    )
    provider = ModelProvider(EmbeddingConfig("custom", DIMS), lambda: models.CountingEncoder(DIMS), slice_rows=64)
    return cells(provider.add_embeddings(turns), "turn_id")


@register(
    "embed_null_on_failure",
    f"""SELECT doc_id, text IS NOT NULL AND length(text) <= 2000 AS embedded FROM ({sql.MISSING_TEXT})""",
)
def embed_null_on_failure(spark, folder):
    """The model refuses texts over 2000 characters; those rows, and rows without text, get NULL."""
    provider = ModelProvider(EmbeddingConfig("custom", DIMS), lambda: models.ShortTextEncoder(DIMS, 2000))
    found = provider.add_embeddings(missing_text(spark, folder))
    return found.select("doc_id", F.col("embedding").isNotNull().alias("embedded"))


@register(
    "validate_provider",
    "SELECT count(*) AS rows_in, count(*) AS not_null, count(*) AS right_dims, true AS passes FROM benchmark",
)
def validate_provider(spark, folder):
    return hashing().check(load_table(spark, folder, "benchmark"))


@register("embed_query", sql.hashed_cells(ASKED, DIMS, "item_id"))
def embed_query(spark, folder):
    asked = load_table(spark, folder, "benchmark").withColumnRenamed("text", "question")
    return cells(embed_queries(asked, hashing(), text="question"), "item_id")


@register("normalize_embedding_type", sql.vector_cells("SELECT * FROM embeddings", "vec_id"))
def normalize_embedding_type(spark, folder):
    doubles = F.col("embedding").cast("array<double>").alias("embedding")
    stored = load_table(spark, folder, "embeddings").select("vec_id", doubles)
    return cells(stored.select("vec_id", as_float_vector(F.col("embedding")).alias("embedding")), "vec_id")


@register(
    "l2_normalize",
    """WITH scaled AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 2)) AS v FROM embeddings),
    norm AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM scaled)
    SELECT vec_id, i, round((v[i + 1] / n)::FLOAT::DOUBLE, 6) + 0.0 AS value FROM norm, range(64) r(i)""",
)
def normalized(spark, folder):
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * (F.col("label") + 2))
    unit = l2_normalize(scaled).alias("embedding")
    return cells(load_table(spark, folder, "embeddings").select("vec_id", unit), "vec_id")


# --- wire formats --------------------------------------------------------------------------

CHUNKED_DOCS = "SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS row_num FROM documents"


@register(
    "build_requests",
    f"""SELECT (row_num - 1) // 64 AS chunk_id, count(*)::INTEGER AS texts,
    json_object('dataframe_records', list(json_object('text', text) ORDER BY row_num))::VARCHAR AS request
    FROM ({CHUNKED_DOCS}) GROUP BY 1""",
)
def build_requests(spark, folder):
    chunked = chunk.chunk_assign(documents(spark, folder).select("doc_id", "text"), 64, ["doc_id"])
    return wire.build_requests(chunked)


@register(
    "build_requests_input",
    f"""SELECT (row_num - 1) // 64 AS chunk_id, count(*)::INTEGER AS texts,
    json_object('input', list(text ORDER BY row_num))::VARCHAR AS request
    FROM ({CHUNKED_DOCS}) GROUP BY 1""",
)
def build_requests_input(spark, folder):
    chunked = chunk.chunk_assign(documents(spark, folder).select("doc_id", "text"), 64, ["doc_id"])
    return wire.build_requests(chunked, shape=wire.INPUT)


@register("parse_responses", sql.vector_cells("SELECT * FROM embeddings", "vec_id"))
def parse_responses(spark, folder):
    """Stored vectors written as response bodies, in turn in each response shape, and read back."""
    stored = load_table(spark, folder, "embeddings").select("vec_id", "embedding")
    chunked = chunk.chunk_assign(stored, 50, ["vec_id"])
    vectors = F.transform("rows", lambda r: r["embedding"])
    predictions = F.to_json(F.struct(vectors.alias("predictions")))
    nested = F.to_json(F.struct(F.transform(vectors, lambda v: F.array(v)).alias("predictions")))
    data = F.to_json(F.struct(F.transform(vectors, lambda v: F.struct(v.alias("embedding"))).alias("data")))
    shape = F.pmod("chunk_id", F.lit(3))
    body = F.when(shape == 0, predictions).when(shape == 1, nested).otherwise(data)
    responses = (
        chunked.groupBy("chunk_id")
        .agg(F.sort_array(F.collect_list(F.struct("row_num", "embedding"))).alias("rows"))
        .select("chunk_id", body.alias("response"))
    )
    return cells(wire.parse_responses(responses, chunked.drop("embedding"), 50), "vec_id")


# --- metrics -------------------------------------------------------------------------------


def _against_reverse(spark, folder, metric, name):
    vector = F.col("embedding")
    score = F.round(metric(vector, F.reverse(vector)), 6) + 0.0
    return faulty_vectors(spark, folder).select("vec_id", score.alias(name))


def _reverse_sql(expression: str, name: str) -> str:
    return f"""SELECT vec_id, round({expression}, 6) + 0.0 AS {name} FROM (SELECT vec_id,
        embedding::DOUBLE[] AS a, list_reverse(embedding)::DOUBLE[] AS b FROM ({sql.FAULTY_VECTORS}))"""


@register("sim_cosine", _reverse_sql("list_cosine_similarity(a, b)", "similarity"))
def sim_cosine(spark, folder):
    return _against_reverse(spark, folder, cosine_similarity, "similarity")


@register("sim_dot", _reverse_sql("list_inner_product(a, b)", "similarity"))
def sim_dot(spark, folder):
    return _against_reverse(spark, folder, dot_product, "similarity")


@register("dist_euclidean", _reverse_sql("list_distance(a, b)", "distance"))
def dist_euclidean(spark, folder):
    return _against_reverse(spark, folder, euclidean_distance, "distance")


# --- search --------------------------------------------------------------------------------

FIRST_QUESTION = "SELECT item_id AS key, text FROM benchmark ORDER BY item_id LIMIT 1"
SEARCH_CTE = f"WITH {sql.hashed(DOCS, DIMS, 'd_')}, {sql.hashed(ASKED, DIMS, 'q_')}"


def embedded_documents(spark, folder) -> DataFrame:
    return hashing().add_embeddings(documents(spark, folder).select("doc_id", "text"))


def first_question(spark, folder) -> list[float]:
    asked = load_table(spark, folder, "benchmark").orderBy("item_id").limit(1)
    return embed_queries(asked, hashing()).first()["embedding"]


@register(
    "vector_search",
    f"""WITH {sql.hashed(DOCS, DIMS, 'd_')}, {sql.hashed(FIRST_QUESTION, DIMS, 'q_')},
    scored AS (SELECT d.key AS doc_id, {sql.cosine('d.embedding', 'q.embedding')} AS score
        FROM d_list d CROSS JOIN q_list q)
    SELECT doc_id, text, {sql.shown()} FROM (SELECT * FROM scored WHERE NOT isnan(score) ORDER BY score DESC, doc_id LIMIT 5)
    JOIN documents USING (doc_id)""",
)
def vector_search(spark, folder):
    """Projection, null filter, hashing, validity filter and search for one question."""
    records = embedded_documents(spark, folder)
    return shown(search.vector_search(records, first_question(spark, folder), DIMS, 5, key="doc_id", columns=["text"]))


def shown(found: DataFrame) -> DataFrame:
    """Scores to six digits, after all ranking."""
    return found.withColumn("score", F.round("score", 6) + 0.0)


@register(
    "vector_search_euclidean",
    """WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1)
    SELECT vec_id, round(s, 6) + 0.0 AS score FROM (
        SELECT vec_id, list_distance(embedding::DOUBLE[], q) AS s FROM embeddings, q ORDER BY 2, 1 LIMIT 5)""",
)
def vector_search_euclidean(spark, folder):
    stored = load_table(spark, folder, "embeddings")
    query = stored.orderBy("vec_id").limit(1).first()["embedding"]
    return shown(search.vector_search(stored, query, DIMS, 5, key="vec_id", metric="euclidean"))


@register(
    "vector_search_scored",
    """WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1)
    SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) + 0.0 AS score FROM embeddings, q""",
)
def vector_search_scored(spark, folder):
    stored = load_table(spark, folder, "embeddings")
    query = stored.orderBy("vec_id").limit(1).first()["embedding"]
    found = search.vector_search_scored(stored, query, DIMS)
    return shown(found.select("vec_id", "score"))


@register(
    "top_k",
    """WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1)
    SELECT vec_id, label, round(s, 6) + 0.0 AS score FROM (SELECT vec_id, label,
        list_inner_product(embedding::DOUBLE[], q) AS s FROM embeddings, q ORDER BY 3 DESC, 1 LIMIT 10)""",
)
def top_k(spark, folder):
    stored = load_table(spark, folder, "embeddings")
    query = stored.orderBy("vec_id").limit(1).first()["embedding"]
    scored = search.vector_search_scored(stored, query, DIMS, metric="dot_product")
    return shown(search.top_k(scored, 10, "vec_id", "dot_product").select("vec_id", "label", "score"))


MANY = f"""{SEARCH_CTE},
    scored AS (SELECT q.key AS item_id, d.key AS doc_id, {sql.cosine('d.embedding', 'q.embedding')} AS score
        FROM d_list d CROSS JOIN q_list q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
        FROM scored WHERE NOT isnan(score))
    SELECT item_id, doc_id, {sql.shown()}, rank FROM ranked WHERE rank <= 5"""


def _many(spark, folder, **sizes):
    asked = embed_queries(load_table(spark, folder, "benchmark"), hashing()).select("item_id", "embedding")
    records = embedded_documents(spark, folder)
    return shown(search.vector_search_many(records, asked, DIMS, 5, key="doc_id", query_key="item_id", **sizes))


@register("vector_search_many", MANY)
def vector_search_many(spark, folder):
    return _many(spark, folder)


@register("vector_search_many_grid", MANY)
def vector_search_many_grid(spark, folder):
    """The same search with a size set so low that the queries go in several blocks."""
    return _many(spark, folder, query_bytes=8 * DIMS * 15)


# Four tables of planes, as many as the records ask for; a query's distances to them order the cells of each table.
# The four nearest cells give the fifth best score, and with it the chance that a record as near lies in a cell.
def probed(records: str, counted: str) -> str:
    """CTEs ending in `seen(query_label, vec_id, score)`: what each query is held against in the end.

    `records` gives (vec_id, label, embedding); the records of `counted` set the number of planes.
    """
    return f"""WITH wide AS (SELECT least(10, greatest(2, ceil(log2(ceil(count(*) / 16)))))::INTEGER AS b FROM ({counted})),
    plane AS (SELECT t, j, i, CASE WHEN substr(md5(t || '-' || j || '-' || i), 1, 1) < '8' THEN 1 ELSE -1 END AS h
        FROM range(4) x(t), range(10) y(j), range(64) z(i), wide WHERE j < b),
    record AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM ({records})),
    flat AS (SELECT vec_id, unnest(range(64)) AS i, unnest(e) / sqrt(list_inner_product(e, e)) AS v FROM record),
    margin AS (SELECT vec_id, t, j, sum(h * v) AS m FROM flat JOIN plane USING (i) GROUP BY ALL),
    placed AS (SELECT vec_id, t, sum(CASE WHEN m > 0 THEN 1 << j ELSE 0 END)::BIGINT AS cell FROM margin GROUP BY ALL),
    query AS (SELECT label AS query_label, vec_id AS q_id, e AS q FROM record
        WHERE vec_id IN (SELECT min(vec_id) FROM record GROUP BY label)),
    crossing AS (SELECT query_label, t, mask, sum(CASE WHEN (mask >> j) & 1 = 1 THEN abs(m) ELSE 0 END) AS cost
        FROM query JOIN margin ON q_id = vec_id, wide, unnest(range((1 << b)::BIGINT)) u(mask) GROUP BY ALL),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY query_label, t ORDER BY cost, mask) AS nth FROM crossing),
    pairs AS (SELECT query_label, vec_id, list_cosine_similarity(e, q) AS score FROM record, query),
    begun AS (SELECT DISTINCT query_label, p.vec_id FROM ordered o JOIN query USING (query_label)
        JOIN placed own ON own.vec_id = q_id AND own.t = o.t JOIN placed p ON p.t = o.t AND p.cell = xor(own.cell, mask) WHERE nth <= 4),
    fifth AS (SELECT query_label, score AS c FROM (SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY score DESC, vec_id) AS nth
        FROM begun JOIN pairs USING (query_label, vec_id)) WHERE nth = 5),
    angle AS (SELECT query_label, q_id, greatest(0, least(0.999999, coalesce(c, 0))) AS c FROM query LEFT JOIN fifth USING (query_label)),
    crossed AS (SELECT query_label, t, j, 1 / (1 + exp(least(abs(m) * 1.702 * c / sqrt(1 - c * c), 700))) AS f
        FROM angle JOIN margin ON q_id = vec_id),
    chance AS (SELECT query_label, t, mask, nth, product(CASE WHEN (mask >> j) & 1 = 1 THEN f ELSE 1 - f END) AS p
        FROM ordered JOIN crossed USING (query_label, t) GROUP BY ALL),
    summed AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY query_label, t ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM chance),
    seen AS (SELECT query_label, vec_id, score FROM (SELECT DISTINCT query_label, p.vec_id FROM summed s JOIN query USING (query_label)
        JOIN placed own ON own.vec_id = q_id AND own.t = s.t JOIN placed p ON p.t = s.t AND p.cell = xor(own.cell, mask)
        WHERE nth <= 4 OR before < 1 - pow(0.1, 0.25)) JOIN pairs USING (query_label, vec_id))"""


STORED = "SELECT vec_id, label, embedding FROM embeddings"
BEST = f"""SELECT query_label, vec_id, {sql.shown()}, rank FROM (SELECT query_label, vec_id, score,
        row_number() OVER (PARTITION BY query_label ORDER BY score DESC, vec_id)::INTEGER AS rank FROM seen) WHERE rank <= 5"""
APPROX = f"{probed(STORED, STORED)} {BEST}"


def label_questions(stored: DataFrame) -> DataFrame:
    """One query vector per label: that of its first record."""
    first = F.min(F.struct("vec_id", "embedding")).alias("_first")
    return stored.groupBy(F.col("label").alias("query_label")).agg(first).select(
        "query_label", F.col("_first.embedding").alias("embedding")
    )


@register("vector_search_approx", APPROX)
def vector_search_approx(spark, folder):
    stored = load_table(spark, folder, "embeddings")
    index = ann.CellIndex.build(stored, work_path(spark, "index"), DIMS, "vec_id")
    return shown(index.search(label_questions(stored), query_key="query_label"))


@register("vector_search_approx_join", APPROX)
def vector_search_approx_join(spark, folder):
    """The same search with the query size set so low that the queries go in several blocks."""
    stored = load_table(spark, folder, "embeddings")
    index = ann.CellIndex.build(stored, work_path(spark, "index"), DIMS, "vec_id")
    return shown(index.search(label_questions(stored), query_key="query_label", query_bytes=8 * DIMS * 3))


def recall_sql(cte: str) -> str:
    return f"""{cte},
    exact AS (SELECT query_label, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY query_label
        ORDER BY score DESC, vec_id) AS nth FROM pairs) WHERE nth <= 5),
    near AS (SELECT query_label, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY query_label
        ORDER BY score DESC, vec_id) AS nth FROM seen) WHERE nth <= 5),
    work AS (SELECT query_label, count(*) AS records_read FROM seen GROUP BY query_label)
    SELECT query_label, count(*) AS wanted, count(n.vec_id) AS found, count(n.vec_id) / count(*) AS recall,
        any_value(records_read) AS records_read, any_value(records_read) / (SELECT count(*) FROM record) AS share_read
    FROM exact x LEFT JOIN near n USING (query_label, vec_id) JOIN work USING (query_label) GROUP BY query_label"""


def measured(stored: DataFrame, index: ann.CellIndex) -> DataFrame:
    """Recall and work of a search by the settings that it has by default."""
    asked = label_questions(stored)
    exact = search.vector_search_many(stored, asked, DIMS, 5, key="vec_id", query_key="query_label")
    found = ann.recall(index.search(asked, query_key="query_label"), exact, "query_label", "vec_id")
    work = index.read_by(index.probed(asked, 5, "query_label"), "query_label")
    return found.join(work, "query_label").withColumn("share_read", F.col("records_read") / F.lit(stored.count()))


@register("vector_search_approx_recall", recall_sql(probed(STORED, STORED)))
def approximate_recall(spark, folder):
    """Share of the exact neighbours that the search finds as it runs by default, and of the records that it reads."""
    stored = load_table(spark, folder, "embeddings")
    return measured(stored, ann.CellIndex.build(stored, work_path(spark, "index"), DIMS, "vec_id"))


# Every record drawn near to the record of the same label and place that comes first: clusters of some twenty.
CLUSTERED = """SELECT r.vec_id, r.label, list_transform(range(64), lambda i: (c.embedding[i + 1] + 0.25 * r.embedding[i + 1])::FLOAT) AS embedding
    FROM embeddings r JOIN embeddings c ON c.vec_id = r.vec_id % (SELECT greatest(1, count(*) // 20) FROM embeddings)"""


@register("vector_search_approx_clusters", recall_sql(probed(CLUSTERED, CLUSTERED)))
def approximate_clusters(spark, folder):
    """The same measurement over vectors in clusters, where few cells are enough."""
    plain = load_table(spark, folder, "embeddings")
    centre = plain.select(F.col("vec_id").alias("_c"), F.col("embedding").alias("_centre"))
    near = plain.join(centre, F.col("vec_id") % max(1, plain.count() // 20) == F.col("_c"))
    mixed = F.zip_with("_centre", "embedding", lambda c, e: (c + F.lit(0.25) * e).cast("float"))
    stored = near.select("vec_id", "label", mixed.alias("embedding"))
    path = work_path(spark, "clusters")
    stored.write.parquet(path)
    stored = spark.read.parquet(path)
    return measured(stored, ann.CellIndex.build(stored, work_path(spark, "index"), DIMS, "vec_id"))


# What is left of the records after a deletion, an upsert and an append: those of the first half, turned and moved, and the rest.
FOLLOWED = """SELECT vec_id, label, CASE WHEN vec_id % 5 = 1 THEN list_transform(embedding, lambda x: -x) ELSE embedding END AS embedding
    FROM embeddings WHERE vec_id % 5 <> 0"""


@register("vector_search_approx_follow", f"{probed(FOLLOWED, 'SELECT * FROM embeddings WHERE vec_id % 5 <= 2')} {BEST}")
def approximate_follow(spark, folder):
    """An index of a table that then deletes, upserts and appends, commit by commit."""
    stored = load_table(spark, folder, "embeddings")
    rows = stored.select("vec_id", F.col("label").alias("kind"), "embedding", F.lit("Vector").alias("label"))
    schema = T.StructType([rows.schema["vec_id"], rows.schema["kind"], rows.schema["embedding"]])
    table = VectorTable(spark, work_path(spark, "table"), schema, "vec_id")
    rest = F.col("vec_id") % 5
    run = table.open_run("vectors")
    table.write_batch(rows.filter(rest <= 2), run, 0)
    index = ann.CellIndex.of_table(table, "Vector", work_path(spark, "index"), DIMS)
    table.write_batch(rows.filter(rest == 0).withColumn("deleted", F.lit(True)), run, 1)
    turned = F.transform("embedding", lambda x: -x)
    table.write_batch(rows.filter(rest == 1).withColumn("embedding", turned), run, 2)
    index.follow(table, "Vector")
    table.write_batch(rows.filter(rest >= 3), run, 3)
    index.follow(table, "Vector")
    current = table.read_label("Vector").withColumn("label", F.col("kind"))
    return shown(index.search(label_questions(current), query_key="query_label"))


@register(
    "search_guard",
    """SELECT count(*) AS records, true AS wrong_length_refused, 0::BIGINT AS found_without_records FROM embeddings""",
)
def search_guard(spark, folder):
    """A query of another length is refused; a search over no valid records finds nothing."""
    stored = load_table(spark, folder, "embeddings")
    query = stored.orderBy("vec_id").limit(1).first()["embedding"]
    try:
        search.vector_search(stored, query[1:], DIMS, key="vec_id")
        refused = False
    except search.DimensionMismatch:
        refused = True
    missing = stored.withColumn("embedding", F.lit(None).cast("array<float>"))
    none = search.vector_search(missing, query, DIMS, key="vec_id").agg(F.count(F.lit(1)).alias("found_without_records"))
    return quality.count_rows(stored).select(
        F.col("rows").alias("records"),
        F.lit(refused).alias("wrong_length_refused"),
        none.scalar().alias("found_without_records"),
    )


# --- checks on stored vectors --------------------------------------------------------------


@register(
    "verify_load",
    f"""SELECT *, embedded = total AND right_dims = total AND distinct_keys = total AS passes,
    CASE WHEN embedded = total AND right_dims = total AND distinct_keys = total THEN 'passed' ELSE 'failed' END AS status
    FROM (SELECT count(*) AS total, count(embedding) AS embedded, count_if(len(embedding) = 64)::BIGINT AS right_dims,
          count(DISTINCT vec_id) AS distinct_keys FROM ({sql.FAULTY_VECTORS}))""",
)
def verify_load(spark, folder):
    return quality.verify_load(faulty_vectors(spark, folder), DIMS, "vec_id")


@register(
    "verify_counts", f"SELECT count(*) AS total, count(embedding) AS embedded FROM ({sql.FAULTY_VECTORS})"
)
def verify_counts(spark, folder):
    return quality.verify_counts(faulty_vectors(spark, folder))


@register(
    "verify_sample",
    f"""SELECT vec_id, len(embedding)::INTEGER AS dims FROM ({sql.FAULTY_VECTORS})
    WHERE embedding IS NOT NULL ORDER BY vec_id LIMIT 3""",
)
def verify_sample(spark, folder):
    return quality.sample_dims(faulty_vectors(spark, folder), "vec_id")


@register(
    "compare_embeddings",
    """SELECT count(*) AS matched, 0::BIGINT AS only_left, 0::BIGINT AS only_right, 0::BIGINT AS repeated_keys,
    0::BIGINT AS not_comparable, round(max(list_max(list_transform(range(1, 65),
        lambda i: abs(e[i] - (e[i] / sqrt(list_inner_product(e, e)))::FLOAT::DOUBLE)))), 6) AS max_difference, true AS agrees
    FROM (SELECT embedding::DOUBLE[] AS e FROM embeddings)""",
)
def compare_embeddings(spark, folder):
    """Stored vectors against the same vectors normalized once more."""
    stored = load_table(spark, folder, "embeddings").select("vec_id", "embedding")
    again = stored.select("vec_id", l2_normalize(F.col("embedding")).alias("embedding"))
    found = quality.compare_embeddings(stored, again, "vec_id")
    return found.withColumn("max_difference", F.round("max_difference", 6))


@register(
    "compare_embeddings_differ",
    f"""WITH pair AS (SELECT vec_id, a.embedding::DOUBLE[] AS e, b.embedding::DOUBLE[] AS f, b.label AS has
        FROM embeddings a LEFT JOIN ({sql.FAULTY_VECTORS}) b USING (vec_id))
    SELECT count(*) AS matched, 0::BIGINT AS only_left, 0::BIGINT AS only_right, 0::BIGINT AS repeated_keys,
    count_if(f IS NULL OR len(f) <> 64)::BIGINT AS not_comparable, 0::DOUBLE AS max_difference, false AS agrees
    FROM pair""",
)
def compare_embeddings_differ(spark, folder):
    """Stored vectors against a copy in which some are missing or too short."""
    stored = load_table(spark, folder, "embeddings").select("vec_id", "embedding")
    return quality.compare_embeddings(stored, faulty_vectors(spark, folder), "vec_id")


@register(
    "triplet_check",
    """WITH t AS (SELECT vec_id AS anchor, vec_id + 1 AS near_id, vec_id + 2 AS far_id, embedding FROM embeddings),
    s AS (SELECT anchor, near_id, far_id, list_cosine_similarity(t.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS near,
          list_cosine_similarity(t.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS far
          FROM t JOIN embeddings b ON b.vec_id = near_id JOIN embeddings c ON c.vec_id = far_id)
    SELECT anchor, near_id AS "similar", far_id AS different, round(near, 6) + 0.0 AS sim_similar, round(far, 6) + 0.0 AS sim_different,
           near > far AS passes FROM s""",
)
def triplet_check(spark, folder):
    stored = load_table(spark, folder, "embeddings")
    triplets = stored.select(
        F.col("vec_id").alias("anchor"),
        (F.col("vec_id") + 1).alias("similar"),
        (F.col("vec_id") + 2).alias("different"),
    )
    found = quality.triplet_check(triplets, stored, "vec_id")
    for name in ("sim_similar", "sim_different"):
        found = found.withColumn(name, F.round(name, 6) + 0.0)
    return found


@register(
    "edge_case_check",
    """SELECT 4 * count(*) AS rows_in, 4 * count(*) AS not_null, 4 * count(*) AS right_dims, true AS passes
    FROM documents""",
)
def edge_case_check(spark, folder):
    """For every document: empty text, its source name, its language 500 times over, its number."""
    edges = F.array(
        F.lit(""), F.col("source"), F.repeat(F.concat("lang", F.lit(" ")), 500), F.col("doc_id").cast("string")
    )
    texts = documents(spark, folder).select(F.explode(edges).alias("text"))
    return quality.edge_case_check(texts, hashing())
