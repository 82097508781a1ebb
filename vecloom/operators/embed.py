"""Providers that add one vector per row.

Every provider is a narrow step: no shuffle, and equal texts or keys never meet in
one task because they are equal.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from copy import copy
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.errors import PythonException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions import kernels, models
from vecloom.operators import filters
from vecloom.operators.project import quoted

VECTOR_TYPE = "array<float>"

# Context lengths of the hosted models, in tokens.
HOSTED_CONTEXT = {"bge-large-en": 512, "gte-large-en": 8192}
# Tokens that a model adds to every text, at its beginning and end.
SPECIAL_UNITS = 2

MODEL_SLICE = 64
PROBE_TEXT = "test embedding validation"


class NoQueryVector(ValueError):
    """A provider fails on the text of a query."""


@dataclass(frozen=True)
class EmbeddingConfig:
    """What to embed and how long the vectors must be."""

    endpoint_name: str
    dimensions: int
    text_column: str = "text"
    output_column: str = "embedding"
    key_column: str | None = None


class EmbeddingProvider(ABC):
    """Adds `config.output_column` to a DataFrame; providers are interchangeable."""

    def __init__(self, config: EmbeddingConfig):
        self.config = config

    @abstractmethod
    def vector(self) -> Column:
        """The vector as a column expression over the input row."""

    def outcome(self) -> Column:
        """The vector, and why there is none where that is known."""
        return F.struct(self.vector().alias("vector"), F.lit(None).cast("string").alias("reason"))

    def add_embeddings(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.config.output_column, self.vector())

    def filter_valid_embeddings(self, df: DataFrame) -> DataFrame:
        return filters.valid_embeddings(df, self.config.dimensions, self.config.output_column)

    def check(self, texts: DataFrame) -> DataFrame:
        """One row: how many texts went in, and whether every one got a good vector."""
        vector = quoted(self.config.output_column)
        embedded = self.add_embeddings(texts)
        counts = embedded.agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count(vector).alias("not_null"),
            F.count_if(F.size(vector) == self.config.dimensions).alias("right_dims"),
        )
        good = (F.col("rows_in") > 0) & (F.col("right_dims") == F.col("rows_in"))
        return counts.withColumn("passes", good)

    def validate(self, spark: SparkSession) -> bool:
        """Embed a probe text before a run, so that a broken model stops it early."""
        probe = query_frame(spark, [PROBE_TEXT], self)
        try:
            return bool(self.check(probe).first()["passes"])
        except PythonException:
            return False


class RandomProvider(EmbeddingProvider):
    """Uniform [0,1) vectors, not normalized, for measuring a load without a model.

    The values come from a key of the row (its text if no key column is named), so a
    retried task writes the same vectors again.
    """

    def vector(self) -> Column:
        key = quoted(self.config.key_column or self.config.text_column).cast("string")
        digest = F.md5(F.coalesce(key, F.lit("")))

        def seed(start: int) -> Column:
            word = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
            return F.shiftright(word, 1)

        table = kernels.coefficient_table(self.config.dimensions)

        @F.arrow_udf(VECTOR_TYPE)
        def uniform(first: pa.Array, second: pa.Array) -> pa.Array:
            return kernels.keyed_uniform(first, second, table)

        return uniform.asNondeterministic()(seed(1), seed(9))


class HashingProvider(EmbeddingProvider):
    """Signed feature hashing of the words of the whole text, L2-normalized.

    Needs no model. A text without words gets the zero vector.
    """

    def vector(self) -> Column:
        dims = self.config.dimensions

        @F.arrow_udf(VECTOR_TYPE)
        def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from kernels.hash_vectors(batches, dims)

        return hashed.asNondeterministic()(F.lower(quoted(self.config.text_column)))


class ModelProvider(EmbeddingProvider):
    """A caller's model: `factory()` runs once per task and returns `encode(texts)`.

    A text that the model fails on while it answers others gets NULL and a reason. A model
    that answers nothing, not even a probe text, is asked again `attempts` times with
    `wait` seconds between, and then fails the task: an outage is no property of the texts.
    The step is marked non-deterministic so that Spark never evaluates it twice for a row.
    """

    def __init__(
        self,
        config: EmbeddingConfig,
        factory: Callable[[], kernels.Encoder] | None = None,
        slice_rows: int = MODEL_SLICE,
        normalize: bool = True,
        max_units: int | None = None,
        count_units: Callable[[str], int] | None = None,
        attempts: int = 3,
        wait: float = 30.0,
    ):
        super().__init__(config)
        dims = config.dimensions
        self.factory = factory or (lambda: models.HashingEncoder(dims))
        self.slice_rows = slice_rows
        self.normalize = normalize
        self.max_units = max_units
        self.count_units = count_units
        self.retry = kernels.Retry(attempts, wait, "a")

    def outcome(self) -> Column:
        factory, rows, retry = self.factory, self.slice_rows, self.retry
        normalize, windows = self.normalize, (self.max_units, self.count_units)

        @F.arrow_udf(f"struct<vector:{VECTOR_TYPE},reason:string>")
        def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from kernels.encode_batches(batches, factory, rows, normalize, windows, retry)

        return encoded.asNondeterministic()(quoted(self.config.text_column).cast("string"))

    def vector(self) -> Column:
        return self.outcome()["vector"]


class HostedProvider(ModelProvider):
    """A model with a bounded context.

    Texts longer than the context are encoded in windows and averaged, so no part of
    a text is left out. The context is counted in the model's own units: `count_units`
    gives the units of a text. Without it every UTF-8 byte counts as one, since no token is
    shorter than a byte. A model that is not in the table needs its `max_units` named.
    """

    def __init__(self, config: EmbeddingConfig, factory=None, max_units: int | None = None, **kwargs):
        if max_units is None:
            if config.endpoint_name not in HOSTED_CONTEXT:
                raise ValueError(f"name max_units for the unknown model {config.endpoint_name!r}")
            max_units = HOSTED_CONTEXT[config.endpoint_name] - SPECIAL_UNITS
        super().__init__(config, factory, max_units=max_units, **kwargs)


PROVIDERS = {
    "random": RandomProvider,
    "custom": ModelProvider,
    "hosted": HostedProvider,
    "hashing": HashingProvider,
}


def create_embedding_provider(provider_type: str, config: EmbeddingConfig, **kwargs) -> EmbeddingProvider:
    if provider_type not in PROVIDERS:
        raise ValueError(f"unknown provider type {provider_type!r}; choose one of {list(PROVIDERS)}")
    return PROVIDERS[provider_type](config, **kwargs)


def query_frame(spark: SparkSession, texts: list[str], provider: EmbeddingProvider) -> DataFrame:
    """A few query texts typed by a caller, numbered, under the provider's text column."""
    rows = [(i, text) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, f"query_id bigint, `{provider.config.text_column}` string")
    key = provider.config.key_column
    if key and key not in frame.columns:
        frame = frame.withColumn(key, F.col("query_id"))
    return frame


def embed_queries(queries: DataFrame, provider: EmbeddingProvider, text: str = "text") -> DataFrame:
    """Embed query texts with the same provider as the stored records."""
    same = copy(provider)
    same.config = replace(provider.config, text_column=text)
    return same.add_embeddings(queries)


def embed_query(spark: SparkSession, text: str, provider: EmbeddingProvider) -> list[float]:
    """One query vector, for a search whose query is typed in."""
    row = provider.add_embeddings(query_frame(spark, [text], provider)).first()
    vector = row[provider.config.output_column]
    if vector is None:
        raise NoQueryVector(f"{provider.config.endpoint_name} gives no vector for the query text")
    return vector
