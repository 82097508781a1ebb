"""Approximate search by cosine: several tables of hyperplane cells, probed by margin, that follow a vector table.

A record lies in one cell of every table, told by the sides of fixed hyperplanes, and the index
holds it once for each table, in folders by table and group of cells. A search looks into
the cells nearest to the query in every table, takes the angle of the k-th best record
found there, and then looks into so many cells that a record at that angle is found with the wanted chance.
Close neighbours therefore cost few cells, and far ones many. Every candidate is scored exactly, and
once, whatever the number of tables it is found in.

The cells do not depend on the data. The index takes what a vector table has written since, commit by
commit: new versions are added to their cells, and older ones of the changed keys stop counting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions import kernels
from vecloom.operators import search
from vecloom.operators.filters import valid_embeddings
from vecloom.operators.project import quoted
from vecloom.operators.search import QUERY_BYTES
from vecloom.sources import files
from vecloom.sources.store import VectorTable, one_row, without_changed

#: Tables of an index; records of a cell that its planes aim at, and bounds of the planes' number.
TABLES, CELL_RECORDS, FEWEST_BITS, MOST_BITS = 4, 16, 2, 10
#: Records of a folder of neighbouring cells that the number of folders aims at.
FOLDER_RECORDS = 1 << 16
#: The wanted chance that a neighbour is found, and cells of a table that are looked into first.
WANTED, FIRST = 0.9, 4
#: Truth values (tables x queries x cells) that go to the tasks with a block of queries.
PROBE_BYTES = 1 << 26

SETTINGS = T.StructType([
    T.StructField(n, T.IntegerType()) for n in ("dimensions", "tables", "bits", "folder_bits")
])


def bits_for(records: int) -> int:
    """Planes of a table, so that a cell holds some records on average."""
    return min(MOST_BITS, max(FEWEST_BITS, (max(1, -(-records // CELL_RECORDS)) - 1).bit_length()))


def folder_bits_for(records: int, bits: int) -> int:
    """Leading bits of a cell that name its folder, so that folders of a table hold many records and few files."""
    return min(bits, (records // FOLDER_RECORDS).bit_length())


@dataclass
class CellIndex:
    """An index of records (a key, a vector) in a folder of the shared store.

    Vectors that are null, of another length, without direction or with values that are not finite are
    not in it. Copies and repeated keys are records each for itself. A search of an empty index finds nothing.
    """

    spark: SparkSession
    root: str
    key: T.StructField
    dimensions: int
    tables: int
    bits: int
    folder_bits: int

    @classmethod
    def build(cls, records: DataFrame, root: str, dimensions: int, key: str, vector: str = "embedding", tables: int = TABLES, bits: int | None = None) -> CellIndex:
        """A new index of some records; the number of planes follows theirs."""
        zero = F.lit(0).cast("bigint").alias("commit")
        index = cls._new(records, root, dimensions, records.schema[key], tables, bits)
        index._add(records.select(quoted(key).alias("key"), quoted(vector).alias("vector"), zero), 0)
        index._done(0)
        return index

    @classmethod
    def of_table(cls, table: VectorTable, label: str, root: str, dimensions: int, vector: str = "embedding", tables: int = TABLES, bits: int | None = None) -> CellIndex:
        """A new index of the current records of a label, which `follow` keeps up with the table."""
        through, current = table._last_commit(), table.current(label)
        index = cls._new(current, root, dimensions, table.schema[table.key], tables, bits)
        index._add(current.select(quoted(table.key).alias("key"), quoted(vector).alias("vector"), "commit"), through)
        index._done(through)
        return index

    @classmethod
    def _new(cls, records: DataFrame, root: str, dimensions: int, key: T.StructField, tables: int, bits: int | None) -> CellIndex:
        count = records.count()
        bits = bits or bits_for(count)
        values = {"dimensions": dimensions, "tables": tables, "bits": bits, "folder_bits": folder_bits_for(count, bits)}
        one_row(records.sparkSession, values, SETTINGS).write.parquet(f"{root}/settings")
        return cls(records.sparkSession, root, T.StructField(key.name, key.dataType), **values)

    @classmethod
    def open(cls, spark: SparkSession, root: str, key: str, key_type: T.DataType) -> CellIndex:
        found = spark.read.schema(SETTINGS).parquet(f"{root}/settings").first()
        return cls(spark, root, T.StructField(key, key_type), **found.asDict())

    def through(self) -> int:
        """The last commit that the index knows; a step that failed half way does not count."""
        return max(int(n) for n in files.children(self.spark, f"{self.root}/done"))

    def follow(self, table: VectorTable, label: str, vector: str = "embedding") -> int:
        """Take in what the table has written since, and say up to which commit."""
        before, last = self.through(), table._last_commit()
        if last == before:
            return last
        changes = table.changes(before, last, label)
        changed = changes.groupBy(quoted(table.key).alias("key")).agg(F.max("commit").alias("commit"))
        changed.write.mode("overwrite").parquet(f"{self.root}/changed/through={last}")
        emptied = table._emptied(label).get(label, -1)
        if emptied > before:
            one_row(self.spark, {"at": emptied}, T.StructType([T.StructField("at", T.LongType())])).write.mode("overwrite").parquet(f"{self.root}/emptied/through={last}")
        # One version of each key counts, however often it was written.
        latest = table._latest(changes.filter(F.col("commit") > emptied), table._version())
        self._add(latest.select(quoted(table.key).alias("key"), quoted(vector).alias("vector"), "commit"), last)
        self._done(last)
        return last

    def _done(self, through: int) -> None:
        files.claim(self.spark, f"{self.root}/done/{through}")

    def _planes(self) -> list[np.ndarray]:
        return [kernels.hyperplanes(self.bits, self.dimensions, t) for t in range(self.tables)]

    def _add(self, records: DataFrame, through: int) -> None:
        """Records (key, vector, commit) into their cells; a hot cell is split among tasks."""
        planes, dimensions = self._planes(), self.dimensions

        @F.arrow_udf("array<bigint>")
        def cells(vectors: pa.Array) -> pa.Array:
            matrix = kernels.to_matrix(vectors, dimensions)
            able = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
            found = np.stack([kernels.sign_cells(np.nan_to_num(matrix) @ p.T) for p in planes], axis=1)
            starts = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * len(planes))
            lists = pa.ListArray.from_arrays(starts, pa.array(found.reshape(-1)))
            return lists.take(pa.array(np.where(able, np.arange(len(matrix)), -1), mask=~able))

        valid = valid_embeddings(records, dimensions, "vector")
        placed = valid.withColumn("cells", cells.asNondeterministic()(F.col("vector"))).filter(F.col("cells").isNotNull())
        rows = placed.select("*", F.posexplode("cells").alias("tbl", "cell")).withColumn("folder", F.expr(f"shiftright(cell, {self.bits - self.folder_bits})"))
        (
            rows.hint("rebalance", "tbl", "folder").sortWithinPartitions("tbl", "folder", "cell").write.mode("overwrite")
            .partitionBy("tbl", "folder").parquet(f"{self.root}/entries/through={through}")
        )

    def _read(self, name: str, schema: str) -> DataFrame:
        if not files.exists(self.spark, f"{self.root}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}").filter(F.col("through") <= self.through())

    def entries(self, cells: dict[int, list[int]] | None = None) -> DataFrame:
        """The index rows that count (tbl, cell, key, vector, cells, commit), of some cells of each table if they are named."""
        key = self.key.dataType.simpleString()
        rows = self._read("entries", f"key {key}, vector array<float>, commit bigint, cells array<bigint>, cell bigint, through bigint, tbl int, folder bigint")
        if cells is not None:
            some = F.lit(False)
            for table, named in cells.items():
                folders = sorted({c >> (self.bits - self.folder_bits) for c in named})
                some = some | ((F.col("tbl") == table) & F.col("folder").isin(folders) & F.col("cell").isin(named))
            rows = rows.filter(some)
        if files.exists(self.spark, f"{self.root}/emptied"):
            at = self._read("emptied", "at bigint, through bigint").agg(F.max("at")).first()[0]
            rows = rows.filter(F.col("commit") > at) if at is not None else rows
        if files.exists(self.spark, f"{self.root}/changed"):
            changed = self._read("changed", f"key {key}, commit bigint, through bigint")
            rows = without_changed(rows, changed, ["key"], since="commit")
        return rows

    def _probes(self, queries: DataFrame, first: int, share: float) -> DataFrame:
        """Queries (key, _vector, _cosine) with the cells they look into: bits by table and cell."""
        planes, dimensions, cells = self._planes(), self.dimensions, 1 << self.bits

        @F.arrow_udf("binary")
        def probe(vectors: pa.Array, cosines: pa.Array) -> pa.Array:
            matrix = kernels.directions(kernels.to_matrix(vectors, dimensions))
            able = np.isfinite(matrix).all(axis=1)
            margins = [np.nan_to_num(matrix) @ p.T for p in planes]
            found = np.concatenate([kernels.cells_looked_into(m, cosines.to_numpy(), min(first, cells), share) for m in margins], axis=1)
            found &= able[:, None]
            return pa.array([row.tobytes() for row in np.packbits(found, axis=1)], pa.binary())

        return queries.withColumn("_probes", probe(F.col("_vector"), F.col("_cosine")))

    def _look(self, block: pa.Table, k: int, query_key: T.StructField) -> DataFrame:
        """The k best records of each query (query key, key, score) in the cells it looks into."""
        probes = self._unpacked(block)
        wanted = {t: np.flatnonzero(probes[t].any(axis=0)).tolist() for t in range(self.tables)}
        rows = self.entries(wanted)
        found = search._scan(rows, block, self.dimensions, k, "key", query_key, [], "vector", "cosine", probes, "cells", "tbl")
        return search._rank(found, query_key.name, "key", k, "cosine")

    def _unpacked(self, block: pa.Table) -> np.ndarray:
        cells = self.tables << self.bits
        raw = np.frombuffer(b"".join(block["_probes"].to_pylist()), np.uint8).reshape(block.num_rows, -1)
        bits = np.unpackbits(raw, axis=1, count=cells) if block.num_rows else np.zeros((0, cells), np.uint8)
        return np.ascontiguousarray(bits.astype(bool).reshape(block.num_rows, self.tables, -1).transpose(1, 0, 2))

    def _block_bytes(self, query_bytes: int) -> int:
        """A block's vectors are bounded, and so are the truth values that go with them."""
        return max(1, min(query_bytes, PROBE_BYTES // (self.tables << self.bits) * 8 * self.dimensions))

    def probed(self, queries: DataFrame, k: int, query_key: str, query_vector: str = "embedding", wanted: float = WANTED, first: int = FIRST, query_bytes: int = QUERY_BYTES) -> DataFrame:
        """The queries (query key, _vector, _cosine) with the cells that each looks into (_probes).

        The nearest cells are looked into first; the k-th best score there, or no likeness at all
        if they hold fewer records, says how far the search has to go.
        """
        field = queries.schema[query_key]
        asked = queries.select(quoted(query_key), quoted(query_vector).alias("_vector"))
        share = 1 - (1 - wanted) ** (1 / self.tables)

        def nearest(block: pa.Table) -> DataFrame:
            near = self._look(block, k, field).filter(F.col("rank") == k)
            return near.select(quoted(query_key).alias("_asked"), F.col("score").alias("_found"))

        begun = self._probes(asked.withColumn("_cosine", F.lit(0.0)), first, 0.0)
        blocks = search.query_blocks(begun, query_key, "_vector", self.dimensions, self._block_bytes(query_bytes))
        found = search.in_blocks(self.spark, blocks, nearest).groupBy("_asked").agg(F.max("_found").alias("_found"))
        known = asked.join(found, quoted(query_key) == F.col("_asked"), "left")
        far = known.select(quoted(query_key), "_vector", F.coalesce("_found", F.lit(0.0)).alias("_cosine"))
        return self._probes(far, first, share)

    def search(self, queries: DataFrame, k: int = 5, *, query_key: str, query_vector: str = "embedding", wanted: float = WANTED, first: int = FIRST, query_bytes: int = QUERY_BYTES) -> DataFrame:
        """k near records of each query: query_key, key, score, rank; equal scores by key.

        `wanted` is the chance that a record as near as the k-th best is found. A query table with one vector of a
        wrong length is refused; a query that is null or has no direction finds nothing.
        Query keys tell queries apart.
        """
        search._check("cosine", k)
        if query_key in (self.key.name, "key"):
            raise ValueError("the query key needs a name of its own")
        if not 0 < wanted < 1:
            raise ValueError("the wanted chance lies between 0 and 1")
        probed = self.probed(queries, k, query_key, query_vector, wanted, first, query_bytes)
        blocks = search.query_blocks(probed, query_key, "_vector", self.dimensions, self._block_bytes(query_bytes))

        def answer(block: pa.Table) -> DataFrame:
            return self._look(block, k, queries.schema[query_key])

        found = search.in_blocks(self.spark, blocks, answer)
        return found.select(quoted(query_key), F.col("key").alias(self.key.name), "score", F.col("rank"))

    def read_by(self, probed: DataFrame, query_key: str, query_bytes: int = QUERY_BYTES) -> DataFrame:
        """(query key, records_read): how many records each query of `probed` is held against."""
        field = probed.schema[query_key]
        schema = T.StructType([field, T.StructField("records_read", T.LongType())])

        def count(block: pa.Table) -> DataFrame:
            probes, names = self._unpacked(block), block[query_key].combine_chunks()

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                seen = np.zeros(len(names), np.int64)
                for batch in batches:
                    placed = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                    for start in range(0, batch.num_rows, 1024):
                        some = placed[start : start + 1024]
                        met = probes[0][:, some[:, 0]]
                        for t in range(1, len(probes)):
                            met |= probes[t][:, some[:, t]]
                        seen += met.sum(axis=1)
                yield pa.RecordBatch.from_arrays([names, pa.array(seen)], schema.names)

            once = self.entries().filter(F.col("tbl") == 0).select("cells")
            return once.mapInArrow(run, schema).groupBy(quoted(query_key)).agg(F.sum("records_read").alias("records_read"))

        blocks = search.query_blocks(probed, query_key, "_vector", self.dimensions, self._block_bytes(query_bytes))
        return search.in_blocks(self.spark, blocks, count)


def recall(approximate: DataFrame, exact: DataFrame, query_key: str, key: str) -> DataFrame:
    """Share of the exact neighbours that the approximate search found, per query."""
    hits = approximate.select(query_key, key, F.lit(1).alias("_hit"))
    return (
        exact.join(hits, [query_key, key], "left")
        .groupBy(query_key)
        .agg(F.count(F.lit(1)).alias("wanted"), F.count("_hit").alias("found"))
        .withColumn("recall", F.col("found") / F.col("wanted"))
    )
