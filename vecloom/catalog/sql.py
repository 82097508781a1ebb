"""SQL fragments shared by the counterparts of the registered queries."""

from __future__ import annotations

# Documents whose text is taken away for one language.
MISSING_TEXT = "SELECT doc_id, CASE WHEN lang <> 'de' THEN text END AS text, lang FROM documents"

# Vectors taken away for one label and cut short for another.
FAULTY_VECTORS = """SELECT vec_id, label, CASE WHEN label = 3 THEN NULL
    WHEN label = 7 THEN embedding[1:63] ELSE embedding END AS embedding FROM embeddings"""


def token_cells(source: str, dims: int, groups: str = "key", prefix: str = "") -> str:
    """CTE of signed word counts per group and bucket; `source` gives the groups and text."""
    return f"""{prefix}word AS (
        SELECT {groups}, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS t FROM ({source})),
    {prefix}code AS (
        SELECT {groups}, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dims} AS b,
               CASE WHEN ('0x' || substr(md5(t), 9, 1))::BIGINT < 8 THEN 1 ELSE -1 END AS s
        FROM {prefix}word WHERE t <> ''),
    {prefix}cell AS (SELECT {groups}, b, sum(s)::DOUBLE AS v FROM {prefix}code GROUP BY ALL),
    {prefix}norm AS (SELECT {groups}, sqrt(sum(v * v)) AS n FROM {prefix}cell GROUP BY ALL)"""


def hashed(source: str, dims: int, prefix: str = "") -> str:
    """CTEs ending in `vec(key, i, value)` and `list(key, embedding)`: hashing of (key, text)."""
    return f"""{token_cells(source, dims, "key", prefix)},
    {prefix}vec AS (
        SELECT s.key, r.i, coalesce(c.v / nullif(n.n, 0), 0)::FLOAT::DOUBLE AS value
        FROM ({source}) s CROSS JOIN range({dims}) r(i)
        LEFT JOIN {prefix}cell c ON c.key = s.key AND c.b = r.i
        LEFT JOIN {prefix}norm n ON n.key = s.key
        WHERE s.text IS NOT NULL),
    {prefix}list AS (SELECT key, list(value ORDER BY i) AS embedding FROM {prefix}vec GROUP BY key)"""


def hashed_cells(source: str, dims: int, key: str) -> str:
    """Query giving (key, i, value) of hashed texts."""
    return f"WITH {hashed(source, dims)} SELECT key AS {key}, i, round(value, 6) + 0.0 AS value FROM vec"


def vector_cells(source: str, key: str, vector: str = "embedding") -> str:
    """Query giving (key, i, value) of stored vectors."""
    return f"""SELECT {key}, i, round(({vector}[i + 1])::FLOAT::DOUBLE, 6) + 0.0 AS value
        FROM ({source}) s, range(64) r(i) WHERE i < len({vector})"""


def cosine(a: str, b: str) -> str:
    return f"list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[])"


def shown(score: str = "score") -> str:
    """A score as the queries give it; ranks come from the whole value."""
    return f"round({score}, 6) + 0.0 AS score"
