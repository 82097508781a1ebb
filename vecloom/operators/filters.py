"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.operators.project import quoted


def text_not_null(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop rows without text; empty text stays. The predicate reaches the scan."""
    return df.filter(quoted(text).isNotNull())


def valid_embeddings(df: DataFrame, dimensions: int, vector: str = "embedding") -> DataFrame:
    """Rows with a vector of exactly the expected length.

    Length is the whole rule: a vector holding a null value passes here, and the
    metrics give NULL for it.
    """
    return df.filter(quoted(vector).isNotNull() & (F.size(quoted(vector)) == dimensions))


def has_embedding(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with a vector of any length."""
    return df.filter(quoted(vector).isNotNull())


def select_chunk(chunked: DataFrame, chunk: int) -> DataFrame:
    """One chunk, for a look at it; loads never loop over chunks."""
    return chunked.filter(F.col("chunk_id") == chunk)
