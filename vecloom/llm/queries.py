"""The registered queries of the training-text operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import lines, lm, packing, pieces, projections, ranked, sharding, simhash, sketch, suffixes, toxicity, turns, winnowing
from vecloom.llm.text import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _sha256(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


@_query
def op1_sentencepiece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.decode(pieces.encode(_documents(spark, folder), path, keys=["doc_id"]), path)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        _sha256("decoded").alias("decoded_sha256"),
    )


@_query
def op2_log_bilinear_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(spark, _documents(spark, folder), folds=10)


@_query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    model = toxicity.train(spark, documents, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.score(spark, documents, model, ["doc_id"]).select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@_query
def op4_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(spark, _documents(spark, folder), shards=40)


@_query
def op5_near_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digests(spark, _documents(spark, folder))


ORACLES["op5_near_lines"] = """
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
line AS (SELECT doc_id, unnest(range(len(parts))) AS n, unnest(parts) AS l FROM doc),
long AS (SELECT * FROM line WHERE length(l) >= 10),
seen AS (SELECT l, min((doc_id, n)) AS first FROM long GROUP BY l),
variant AS (SELECT l, first, i, md5(substr(l, 1, i - 1) || substr(l, i + 1)) AS v
    FROM (SELECT l, first, unnest(range(1, length(l) + 1)) AS i FROM seen)),
near AS (
    SELECT a.l FROM variant a JOIN variant b ON a.v = b.v AND a.i = b.i AND b.first < a.first
    UNION SELECT a.l FROM variant a JOIN seen b ON a.v = md5(b.l) AND b.first < a.first
    UNION SELECT a.l FROM seen a JOIN variant b ON md5(a.l) = b.v AND b.first < a.first),
judged AS (
    SELECT line.doc_id, line.n, line.l, s.first IS NOT NULL AND s.first <> (line.doc_id, line.n) AS equal,
           s.first IS NOT NULL AND s.first = (line.doc_id, line.n) AND line.l IN (SELECT l FROM near) AS near
    FROM line LEFT JOIN seen s ON s.l = line.l)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (equal) AS n_equal, count(*) FILTER (near) AS n_near,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY n) FILTER (NOT equal AND NOT near), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@_query
def op6_threshold_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.fingerprint_edits(spark, _documents(spark, folder))


@_query
def op7_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(spark, _documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.digests(spark, _documents(spark, folder), least=400)


ORACLES["op8_repeated_passages"] = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS (SELECT doc_id, h, unnest(range(len(h) // 2 - 399)) AS s FROM doc WHERE len(h) >= 800),
win AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 800)) AS w FROM place),
hit AS (SELECT doc_id, s FROM win WHERE w IN (SELECT w FROM win GROUP BY w HAVING count(*) > 1)),
edge AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400 THEN 0 ELSE 1 END AS fresh FROM hit),
run AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM edge),
span AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS e FROM run GROUP BY doc_id, g),
cut AS (SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS b FROM span),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(e - a) AS n_removed, max(e) AS last,
    string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) AS k FROM cut JOIN doc USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)"""


@_query
def op9_simhash_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(spark, _documents(spark, folder), size=3)
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


@_query
def op10_projected_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return projections.search(spark, vectors, "vec_id % 100 = 0", k=10)


@_query
def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    return turns.audits(spark, conversations, turns.Repair(spark, turns.damage(conversations)))


# crc32 goes bit by bit; each conversation's rows and the turns that may be added before and after them
# are steps of a recursion that keeps the cheapest way into each state: {cost, audit, turns}.
ORACLES["op11_turn_repair"] = """
WITH RECURSIVE source AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (SELECT *, xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, len(k) + 1), lambda i: list_concat([ord(k[i])::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) % 20 AS fault FROM source),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM crc),
trimmed AS (SELECT *, left(role, 1) AS r, trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
marked AS (SELECT *, t = '' AS blank, t <> '' AND i > min(i) OVER (PARTITION BY conv_id, role, text) AS again,
    lead(r) OVER (PARTITION BY conv_id ORDER BY i) AS next FROM trimmed),
fault AS (SELECT *, NOT blank AND NOT again AND right(t, 1) NOT IN ('.', '!', '?') AS cut FROM marked),
steps AS (
    SELECT conv_id, 4 * i AS k, true AS real, NOT blank AND NOT again AS live, cut::INTEGER AS cut, role, text, r FROM fault
    UNION ALL SELECT conv_id, 4 * i - j, false, false, 0, '', '', '' FROM fault, (SELECT unnest([1, 2, 3]) AS j)
    UNION ALL SELECT conv_id, 4 * max(i) + j, false, false, 0, '', '', '' FROM fault, (SELECT unnest([1, 2, 3]) AS j) GROUP BY conv_id, j),
best AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS k, {'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]} AS s0, {'c': 1000000::BIGINT, 'a': '', 'o': []::VARCHAR[]} AS s1,
        {'c': 1000000::BIGINT, 'a': '', 'o': []::VARCHAR[]} AS s2, {'c': 1000000::BIGINT, 'a': '', 'o': []::VARCHAR[]} AS s3 FROM fault
    UNION ALL
    SELECT b.conv_id, s.k,
        CASE WHEN real THEN {'c': s0.c + 3, 'a': s0.a || 'D', 'o': s0.o} ELSE s0 END,
        CASE WHEN real THEN list_sort([{'c': s1.c + 3, 'a': s1.a || 'D', 'o': s1.o},
            {'c': CASE WHEN live AND r = 's' THEN s0.c + cut ELSE 2000000 END, 'a': s0.a || 'K', 'o': list_append(s0.o, role || ':' || text)}])[1] ELSE s1 END,
        CASE WHEN real THEN list_sort(list_concat([{'c': s2.c + 3, 'a': s2.a || 'D', 'o': s2.o}],
            list_transform([s0, s1, s3], lambda x: {'c': CASE WHEN live AND r = 'u' THEN x.c + cut ELSE 2000000 END, 'a': x.a || 'K', 'o': list_append(x.o, role || ':' || text)}),
            list_transform([s0, s1, s3], lambda x: {'c': CASE WHEN live THEN x.c + 2 + cut ELSE 2000000 END, 'a': x.a || 'R', 'o': list_append(x.o, 'user:' || text)})))[1]
        ELSE list_sort(list_concat([s2], list_transform([s0, s1, s3], lambda x: {'c': x.c + 2, 'a': x.a || 'I', 'o': list_append(x.o, 'user:')})))[1] END,
        CASE WHEN real THEN list_sort([{'c': s3.c + 3, 'a': s3.a || 'D', 'o': s3.o},
            {'c': CASE WHEN live AND r = 'a' THEN s2.c + cut ELSE 2000000 END, 'a': s2.a || 'K', 'o': list_append(s2.o, role || ':' || text)},
            {'c': CASE WHEN live THEN s2.c + 2 + cut ELSE 2000000 END, 'a': s2.a || 'R', 'o': list_append(s2.o, 'assistant:' || text)}])[1]
        ELSE list_sort([s3, {'c': s2.c + 2, 'a': s2.a || 'I', 'o': list_append(s2.o, 'assistant:')}])[1] END
    FROM best b JOIN steps s ON b.conv_id IS NOT DISTINCT FROM s.conv_id AND s.k = b.k + 1),
ended AS (SELECT conv_id, list_sort([arg_max(s0, k), arg_max(s3, k)])[1] AS s FROM best GROUP BY conv_id),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (next IS NOT NULL AND r || next NOT IN ('su', 'ua', 'au')) AS illegal FROM fault GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(s.c, 0)::BIGINT AS cost, coalesce(s.a, '') AS audit,
    sha256(coalesce(array_to_string(s.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""


@_query
def op12_winnowed_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.contaminated(spark, _documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op12_winnowed_benchmark"] = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS size FROM item WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS s FROM sized)),
place AS (SELECT doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS win
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
          FROM doc JOIN (SELECT DISTINCT size FROM wanted) ON len(w) >= size)),
hit AS (SELECT doc_id, s, size, item_id FROM place JOIN wanted USING (size, win)),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + size)) FROM (SELECT DISTINCT doc_id, s, size FROM hit)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


@_query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(spark, _documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), k=20)


ORACLES["op13_ranked_search"] = rf"""
WITH word AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
posting AS (SELECT doc_id, t, count(*) AS tf FROM word GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM word GROUP BY doc_id),
whole AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM size),
weight AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM posting, whole GROUP BY t, big_n),
slow AS (SELECT doc_id, 75 + (25 * n * big_n) // big_l AS m FROM size, whole),
asked AS (SELECT item_id, t, count(*) AS q
    FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
scored AS (SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN weight USING (t) JOIN posting USING (t) JOIN slow USING (doc_id) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20"""
