"""The keyed vector table: versioned batches of parquet, resolved to one row per key on read.

A load appends and never reads or shuffles what is there: batch B of run R goes to
`run_seq=R/batch_id=B/commit=C/label=L`. Commits are numbered in the order of writing;
writing a batch again replaces exactly its files and keeps its number. The current state is
the version of each (label, key) with the highest commit. Rows with a reason against them
are kept beside the records with key and reason only, and belong to no state. A compacted
table has its one version of each key in `base/label=L/bucket=B`.

A commit counts once it is published, which is the last step of its write: what a failed or unfinished
batch leaves behind is seen by no reader.

A label is emptied by one marker: of its rows only those of later commits count.

Merging keeps reads short without writing everything again. The batches since the last
merge become one part with one version of each key, and so many parts of one level become one
part of the next; all other parts stay where they are. A manifest names the parts and the last
commit in them. Readers take the last whole manifest and the batches after it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.operators.project import quoted
from vecloom.sources import files

NULL_KEY, REPEATED_KEY = "null key", "repeated key"
# Rows of a bucket of keys in a compacted table; their number follows the rows. A key's bucket depends on its hash alone.
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 1 << 14
# Buckets that a filter on folders names one by one.
NAMED_BUCKETS = 256
# Bits of the filter of changed keys, in words of 64; what it lets through in error meets the exact join.
FILTER_BITS = 1 << 26
# Parts of a level that are merged into one of the next.
FANOUT = 4

EMPTIED_SCHEMA = T.StructType([T.StructField("label", T.StringType()), T.StructField("at", T.LongType())])
PARTS_SCHEMA = T.StructType(
    [
        T.StructField("nth", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("through", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Part:
    """A folder with one version of each key that was written in a range of commits, up to `through`."""

    level: int
    path: str
    through: int
    rows: int


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    if files.exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def one_row(spark: SparkSession, values: dict, schema: T.StructType) -> DataFrame:
    """A single row as a frame of one partition, for the small books a table keeps."""
    columns = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema if f.name in values]
    return spark.range(0, 1, 1, 1).select(*columns)


def append_rows(df: DataFrame, path: str, label: str = "label") -> None:
    """Always add the rows; the same key may then occur many times.

    Rows of a label are brought together for few files; Spark splits a label with many.
    """
    df.hint("rebalance", label).write.mode("append").partitionBy(label).parquet(path)


def without_changed(rows: DataFrame, changed: DataFrame, keys: list[str], among: Column | None = None, since: str | None = None) -> DataFrame:
    """The rows whose keys are not among the changed ones; `among` is true for all rows that may be.

    A filter of the changed keys, of FILTER_BITS at most, goes to every task. Rows that it does not let through are
    read as they are, and only the others meet the exact join. With `since`, a row goes only
    if its key changed at a higher value of that column than its own.
    """
    named = [quoted(n).alias(f"_changed_{i}") for i, n in enumerate(keys)]
    if since is None:
        changed = changed.select(*named).distinct()
    else:
        changed = changed.groupBy(*named).agg(F.max(since).alias("_since"))

    def place(columns: list[Column]) -> Column:
        return F.xxhash64(*columns).bitwiseAND(F.lit(FILTER_BITS - 1))

    # At most FILTER_BITS / 64 rows.
    hashed = changed.select(place([F.col(f"_changed_{i}") for i in range(len(keys))]).alias("_place"))
    words = hashed.groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(_place & 63 as int)))").alias("_bits"))
    placed = rows.withColumn("_place", place([quoted(n) for n in keys])).withColumn("_word", F.shiftright("_place", 6))
    placed = placed.join(F.broadcast(words), "_word", "left")
    maybe = F.coalesce(F.expr("(shiftrightunsigned(_bits, cast(_place & 63 as int)) & 1) = 1"), F.lit(False))
    names = [quoted(n) for n in rows.columns]
    clean, doubtful = placed.filter(~maybe).select(*names), placed.filter(maybe if among is None else maybe & among).select(*names)
    same = [quoted(n) == F.col(f"_changed_{i}") for i, n in enumerate(keys)]
    if since is not None:
        same.append(F.col("_since") > F.col(since))
    return clean.unionByName(doubtful.join(changed, reduce(Column.__and__, same), "left_anti"))


class VectorTable:
    """Records of `schema`, keyed by `key` within a label.

    `order_by` says which of several rows with the same key in one batch is the later
    one; without it a hash of the row decides, so the answer is the same every time.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: str,
        order_by: Sequence[str] = (),
        max_records_per_file: int = 1_000_000,
        partial_rows: bool = False,
    ):
        self.spark = spark
        self.root = root
        self.key = key
        self.order_by = list(order_by)
        self.max_records_per_file = max_records_per_file
        self.partial_rows = partial_rows
        self.schema = T.StructType([f for f in schema if f.name != "label"])
        self.stored = T.StructType(
            [T.StructField(f.name, f.dataType) for f in self.schema]
            + [
                *([T.StructField("given", T.ArrayType(T.StringType()))] if partial_rows else []),
                T.StructField("deleted", T.BooleanType()),
                T.StructField("reason", T.StringType()),
                T.StructField("run_seq", T.LongType()),
                T.StructField("batch_id", T.LongType()),
                T.StructField("commit", T.LongType()),
                T.StructField("label", T.StringType()),
            ]
        )

    @property
    def records(self) -> str:
        return f"{self.root}/records"

    def open_run(self, checkpoint: str, fresh: bool = True) -> int:
        """The run number a checkpoint belongs to; a fresh start gets a new one.

        Each run has a checkpoint folder of its own, which no other run of this or another
        table shares. One writer per table at a time.
        """
        numbers = sorted(self._runs(), reverse=True)
        mine = (n for n in numbers if not fresh and self._run(n)["checkpoint"] == checkpoint)
        if (found := next(mine, None)) is not None:
            return found
        run_seq = max(numbers, default=0) + 1
        folder = f"{checkpoint}/run-{run_seq}-{uuid.uuid4().hex}"
        self._note_run(self.root, run_seq, {"checkpoint": checkpoint, "folder": folder})
        return run_seq

    def _runs(self) -> list[int]:
        """A run is a small file by its number: no job is needed to open one."""
        names = (name.removesuffix(".json") for name in files.children(self.spark, f"{self.root}/runs"))
        return [int(name) for name in names if name.isdigit()]

    def _run(self, run_seq: int) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.root}/runs/{run_seq}.json"))

    def _note_run(self, root: str, run_seq: int, values: dict) -> None:
        files.write_text(self.spark, f"{root}/runs/{run_seq}.json", json.dumps(values))

    def checkpoint_folder(self, run_seq: int) -> str:
        return self._run(run_seq)["folder"]

    def _commit(self, folder: str) -> int:
        """The commit of a batch: the one it had before, or the next number."""
        for name in files.children(self.spark, folder):
            if name.startswith("commit="):
                return int(name.removeprefix("commit="))
        number = self._last_commit() + 1
        while not files.claim(self.spark, f"{self.root}/commits/{number}"):
            number += 1
        return number

    def _last_commit(self) -> int:
        """Commits are claimed as empty files, so that their number is the store's to give.

        Numbers have no gaps, so those in a manifest need not be listed again.
        """
        if parts := self.parts():
            number = parts[-1].through
            while files.exists(self.spark, f"{self.root}/commits/{number + 1}"):
                number += 1
            return number
        return max((int(name) for name in files.children(self.spark, f"{self.root}/commits") if name.isdigit()), default=0)

    def write_batch(
        self, df: DataFrame, run_seq: int, batch_id: int, max_records: int | None = None, many_labels: bool = False
    ) -> None:
        """Write one batch, replacing an earlier attempt at the same batch.

        `df` needs a `label` column; rows with a `reason`, and rows without a key, are kept as
        rejects. No shuffle: every task writes its own rows, but for `many_labels`, which
        brings each label's rows together. `max_records` bounds the rows of a file.
        """
        folder = f"{self.records}/run_seq={run_seq}/batch_id={batch_id}"
        commit = self._commit(folder)
        self._write(df, f"{folder}/commit={commit}", max_records, many_labels)
        self._publish_commit(commit)

    def _publish_commit(self, commit: int) -> None:
        files.claim(self.spark, f"{self.root}/published/{commit}")

    def _pending(self, after: int = 0) -> list[int]:
        """Commits after some commit that are numbered and not published: batches under way, or that failed."""
        numbered, whole = (
            {int(n) for n in files.children(self.spark, f"{self.root}/{name}") if n.isdigit()} for name in ("commits", "published")
        )
        return sorted(n for n in numbered - whole if n > after)

    def write_repeats(self, run_seq: int, batch_id: int) -> int:
        """Add the rows of a written batch that repeat a key of it to its rejects, and say how many there are.

        One row of each key stays current, as in any read; the others are refused. Only keys are shuffled.
        """
        folder = f"{self.records}/run_seq={run_seq}/batch_id={batch_id}"
        path = f"{folder}/commit={self._commit(folder)}"
        names = [T.StructField("label", T.StringType()), T.StructField("reason", T.StringType()), self.schema[self.key]]
        rows = self.spark.read.schema(T.StructType(names)).parquet(path).filter("reason is null")
        repeats = rows.groupBy("label", quoted(self.key)).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        seen = Observation()
        refused = repeats.select(quoted(self.key), "label", F.explode(F.sequence(F.lit(2), F.col("_n").cast("int"))))
        refused = refused.observe(seen, F.count(F.lit(1)).alias("rows"))
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name != self.key]
        frame = refused.select(quoted(self.key), *empty, F.lit(REPEATED_KEY).alias("reason"), "label")
        self._write(frame, path, mode="append")
        return seen.get["rows"]

    def _write(self, df: DataFrame, path: str, max_records: int | None = None, many_labels: bool = False, mode: str = "overwrite") -> None:
        if "deleted" not in df.columns:
            df = df.withColumn("deleted", F.lit(False))
        reason = F.when(quoted(self.key).isNull(), F.lit(NULL_KEY))
        if "reason" in df.columns and "reason" not in self.schema.names:
            reason = F.coalesce("reason", reason)
        given = self.schema.names
        if self.partial_rows:
            given = [name for name in given if name in df.columns]

        def stored(field: T.StructField) -> Column:
            value = quoted(field.name) if field.name in given else F.lit(None)
            kept = value if field.name == self.key else F.when(F.col("_reason").isNull(), value)
            return kept.cast(field.dataType).alias(field.name)

        columns = [stored(f) for f in self.schema]
        if self.partial_rows:
            columns.append(F.array(*[F.lit(name) for name in given]).alias("given"))
        rows = df.withColumn("_reason", reason.cast("string")).select(
            *columns, "deleted", F.col("_reason").alias("reason"), F.col("label").cast("string").alias("label")
        )
        (
            (rows.hint("rebalance", "label") if many_labels else rows)
            .write.mode(mode)
            .option("maxRecordsPerFile", min(self.max_records_per_file, max_records or self.max_records_per_file))
            .partitionBy("label")
            .parquet(path)
        )

    def _stored(self, label: str | None, after: int = 0) -> DataFrame:
        rows = read_or_empty(self.spark, self.records, self.stored)
        rows = rows if label is None else rows.filter(F.col("label") == label)
        rows = rows.filter(F.col("commit") > after) if after else rows
        pending = self._pending(after)
        return rows.filter(~F.col("commit").isin(pending)) if pending else rows

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(quoted(self.key)), F.lit(buckets)).cast("int")

    def _base(self, label: str | None) -> DataFrame:
        """The compacted rows as versions of run, batch and commit 0, with their bucket."""
        schema = T.StructType(
            [f for f in self.stored if f.name not in ("deleted", "reason", "run_seq", "batch_id", "commit", "label")]
            + [T.StructField("label", T.StringType()), T.StructField("_bucket", T.IntegerType())]
        )
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/base")
        zero = F.lit(0).cast("bigint")
        rows = rows.withColumns({"deleted": F.lit(False), "run_seq": zero, "batch_id": zero, "commit": zero})
        return rows if label is None else rows.filter(F.col("label") == label)

    def _part(self, part: Part, label: str | None) -> DataFrame:
        """The rows of a part, with their bucket."""
        schema = T.StructType([f for f in self.stored if f.name != "reason"] + [T.StructField("_bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(part.path)
        return rows if label is None else rows.filter(F.col("label") == label)

    def _emptied(self, label: str | None) -> dict[str, int]:
        """The commit as of which each emptied label was empty; a row for each such label, whose folders the driver lists as well."""
        if not files.exists(self.spark, f"{self.root}/emptied"):
            return {}
        rows = self.spark.read.schema(EMPTIED_SCHEMA).parquet(f"{self.root}/emptied")
        if pending := self._pending():
            rows = rows.filter(~F.col("at").isin(pending))
        rows = rows if label is None else rows.filter(F.col("label") == label)
        return {r["label"]: r["at"] for r in rows.groupBy("label").agg(F.max("at").alias("at")).collect()}

    def _alive(self, rows: DataFrame, emptied: dict[str, int]) -> DataFrame:
        """Without the rows that were there when their label was emptied."""
        for label, at in sorted(emptied.items()):
            rows = rows.filter((F.col("label") != label) | F.col("label").isNull() | (F.col("commit") > at))
        return rows

    def rejects(self, label: str | None = None) -> DataFrame:
        """The rows that were refused: label, key, reason, and the batch they came in."""
        refused = self._stored(label).filter(F.col("reason").isNotNull())
        return refused.select("label", quoted(self.key), "reason", "run_seq", "batch_id")

    def changes(self, after: int, through: int, label: str | None = None) -> DataFrame:
        """Every version that was written in the commits (after, through], deletions included."""
        rows = self._stored(label, after).filter(F.col("commit") <= through)
        return rows.filter(F.col("reason").isNull()).drop("reason")

    def history(self, label: str | None = None) -> DataFrame:
        """Every version of every record that is still held, deletions of single keys included; the label prunes folders."""
        through = parts[-1].through if (parts := self.parts()) else 0
        rows = self._stored(label, through).filter(F.col("reason").isNull()).drop("reason")
        for part in reversed(parts):
            rows = self._part(part, label).drop("_bucket").unionByName(rows)
        return self._base(label).drop("_bucket").unionByName(rows) if self._compacted() else rows

    def current(self, label: str | None = None) -> DataFrame:
        """The latest version of each (label, key).

        Spark keeps one row per key in every task before it shuffles (WindowGroupLimit),
        so a key with very many versions costs no more than any other. In a compacted or
        merged table only what came later is resolved. A filter of the changed keys tells
        which rows of the oldest part may have changed; they alone meet the exact join,
        and all others are read as they are.
        """
        version = self._version()
        emptied = self._emptied(label)
        if self.partial_rows:
            return self._merged(self._alive(self.history(label), emptied), F.struct(*version))
        parts = self.parts()
        later = self._stored(label, parts[-1].through if parts else 0).filter(F.col("reason").isNull()).drop("reason")
        if self._compacted():
            oldest, buckets = self._base(label), self._base_buckets()
        elif parts:
            oldest, buckets, parts = self._part(parts[0], label), self._buckets_of(parts[0].rows), parts[1:]
        else:
            return self._latest(self._alive(later, emptied), version)
        for part in parts:
            later = later.unionByName(self._part(part, label).drop("_bucket"))
        later, oldest = self._alive(later, emptied), self._alive(oldest, emptied)
        touched = [r["b"] for r in later.select(self._bucket(buckets).alias("b")).distinct().collect()]
        if not touched:
            return oldest.drop("_bucket", "deleted")
        rest = self._unchanged(oldest, later, touched).drop("_bucket", "deleted")
        return rest.unionByName(self._latest(later, version))

    def _version(self) -> list[Column]:
        row = F.xxhash64(*[quoted(name) for name in self.schema.names])
        return [F.col("commit"), *[quoted(name) for name in self.order_by], row]

    def _unchanged(self, oldest: DataFrame, later: DataFrame, touched: list[int]) -> DataFrame:
        """The rows of the oldest part whose keys do not occur later."""
        changed = later.select("label", quoted(self.key))
        among = F.col("_bucket").isin(touched) if len(touched) <= NAMED_BUCKETS else None
        return without_changed(oldest, changed, ["label", self.key], among)

    @staticmethod
    def _buckets_of(rows: int) -> int:
        return min(MOST_BUCKETS, max(1, 1 << (rows // BUCKET_ROWS).bit_length()))

    def _base_buckets(self) -> int:
        return max(int(n) for n in files.children(self.spark, f"{self.root}/buckets"))

    def parts(self) -> list[Part]:
        """The merged parts, oldest first, as the last whole manifest names them."""
        numbers = [int(n) for n in files.children(self.spark, f"{self.root}/manifests") if n.isdigit()]
        for number in sorted(numbers, reverse=True):
            path = f"{self.root}/manifests/{number}"
            if files.exists(self.spark, f"{path}/_SUCCESS"):
                rows = self.spark.read.schema(PARTS_SCHEMA).parquet(path).orderBy("nth").collect()
                return [Part(r["level"], r["path"], r["through"], r["rows"]) for r in rows]
        return []

    def _whole_through(self, after: int) -> int:
        """The last commit before which all batches were written to their end."""
        last = self._last_commit()
        found = files.matching(self.spark, f"{self.records}/run_seq=*/batch_id=*/commit=*")
        whole = set(files.matching(self.spark, f"{self.records}/run_seq=*/batch_id=*/commit=*/_SUCCESS"))
        numbers = {p: int(re.search(r"commit=(\d+)$", p)[1]) for p in found}
        pending = set(self._pending(after))
        broken = [n for p, n in numbers.items() if n > after and (n in pending or f"{p}/_SUCCESS" not in whole)]
        return min(broken) - 1 if broken else last

    def merge(self, fanout: int = FANOUT) -> list[Part]:
        """Make one part of the batches since the last merge, and merge `fanout` parts of a level into one of the next.

        Only the batches and parts that are merged are read; no other file changes. A part has one version of
        each key; the oldest one holds no deletions. The new parts are read once the manifest is whole, and
        a merge that fails leaves the table as it was. A batch that is done again after its merge has no effect. Not while a
        batch is being written, and not for tables of partial rows, which `compact` serves.
        """
        if self.partial_rows:
            raise ValueError("a table of partial rows cannot be merged by level: use compact")
        parts = before = self.parts()
        after = parts[-1].through if parts else 0
        through, emptied = self._whole_through(after), self._emptied(None)
        if through > after:
            fresh = self._write_part(self._alive(self.changes(after, through), emptied), 1, through, not parts)
            parts = [*parts, fresh]
        while len(parts) >= fanout and len({p.level for p in parts[-fanout:]}) == 1:
            some, parts = parts[-fanout:], parts[:-fanout]
            rows = self._part(some[0], None)
            for part in some[1:]:
                rows = rows.unionByName(self._part(part, None))
            rows = self._alive(rows.drop("_bucket"), emptied)
            parts = [*parts, self._write_part(rows, some[-1].level + 1, some[-1].through, not parts)]
        if parts != before:
            self._publish(parts)
        return parts

    def _write_part(self, rows: DataFrame, level: int, through: int, oldest: bool) -> Part:
        """The latest version of each key of some rows; deletions stay, unless there is nothing older that they hide."""
        path = f"{self.root}/parts/{uuid.uuid4().hex}"
        # As many buckets as the rows before they are resolved would need: no less than needed.
        buckets = self._buckets_of(rows.count())
        found = self._latest(rows, self._version(), deletions=True)
        if oldest and not self._compacted():
            found = found.filter(~F.col("deleted"))
        seen = Observation()
        (
            found.withColumn("_bucket", self._bucket(buckets)).observe(seen, F.count(F.lit(1)).alias("rows"))
            .hint("rebalance", "label", "_bucket")
            .write.option("maxRecordsPerFile", self.max_records_per_file)
            .partitionBy("label", "_bucket").parquet(path)
        )
        return Part(level, path, through, seen.get["rows"])

    def _publish(self, parts: list[Part]) -> None:
        numbers = [int(n) for n in files.children(self.spark, f"{self.root}/manifests") if n.isdigit()]
        rows = [(k, p.level, p.path, p.through, p.rows) for k, p in enumerate(parts)]
        manifest = self.spark.createDataFrame(rows, PARTS_SCHEMA).coalesce(1)
        manifest.write.parquet(f"{self.root}/manifests/{max(numbers, default=0) + 1}")

    def _compacted(self) -> bool:
        return files.exists(self.spark, f"{self.root}/base")

    def _latest(self, rows: DataFrame, version: list[Column], deletions: bool = False) -> DataFrame:
        latest = Window.partitionBy("label", quoted(self.key)).orderBy(*[v.desc() for v in version])
        found = rows.withColumn("_nth", F.row_number().over(latest)).filter(F.col("_nth") == 1).drop("_nth")
        return found if deletions else found.filter(~F.col("deleted")).drop("deleted")

    def _merged(self, rows: DataFrame, version: Column) -> DataFrame:
        """Each column from the latest row that gave it, unless the key was deleted since."""
        others = [name for name in self.schema.names if name != self.key]
        alive = ~F.col("deleted")

        def latest(name: str) -> Column:
            given = alive & F.array_contains("given", name)
            return F.max(F.when(given, F.struct(version.alias("at"), quoted(name).alias("value")))).alias(name)

        found = rows.groupBy("label", quoted(self.key)).agg(
            F.max(F.when(F.col("deleted"), version)).alias("_deleted"),
            F.max(F.when(alive, version)).alias("_version"),
            *[latest(name) for name in others],
        )

        def since_deletion(at: Column) -> Column:
            return F.col("_deleted").isNull() | (at > F.col("_deleted"))

        def kept(name: str) -> Column:
            if name == self.key:
                return quoted(name)
            return F.when(since_deletion(quoted(name)["at"]), quoted(name)["value"]).alias(name)

        return found.filter(since_deletion(F.col("_version"))).select(
            *[kept(name) for name in self.schema.names],
            F.col("_version.commit").alias("commit"),
            "label",
        )

    def read_label(self, label: str) -> DataFrame:
        return self.current(label).select(*[quoted(name) for name in self.schema.names], "label")

    def delete_label(self, label: str, run_seq: int, batch_id: int = 0) -> int:
        """Empty a label by one marker and say how many records it held; the label can be loaded again later."""
        rows = self.current(label).count()
        folder = f"{self.root}/emptied/run_seq={run_seq}/batch_id={batch_id}"
        commit = self._commit(folder)
        marker = one_row(self.spark, {"label": label, "at": commit}, EMPTIED_SCHEMA)
        marker.write.mode("overwrite").parquet(f"{folder}/commit={commit}")
        self._publish_commit(commit)
        return rows

    def compact(self, root: str) -> "VectorTable":
        """Write the current state as the base of a new table, in folders by label and bucket of keys.

        The number of buckets follows the rows. Runs, ledger and commit numbers go along, so streams resume where they were and later
        commits come after. Rejects stay in the old table.
        """
        target = VectorTable(
            self.spark, root, self.schema, self.key, self.order_by, self.max_records_per_file, self.partial_rows
        )
        names = [quoted(f.name) for f in self.schema]
        if self.partial_rows:
            names.append(F.array(*[F.lit(name) for name in self.schema.names]).alias("given"))
        buckets = self._buckets_of(self.current().count())
        (
            self.current().select(*names, "label", self._bucket(buckets).alias("_bucket"))
            .hint("rebalance", "label", "_bucket")
            .write.option("maxRecordsPerFile", self.max_records_per_file)
            .partitionBy("label", "_bucket").parquet(f"{root}/base")
        )
        files.claim(self.spark, f"{root}/buckets/{buckets}")
        for run_seq in self._runs():
            self._note_run(root, run_seq, self._run(run_seq))
        if files.exists(self.spark, f"{self.root}/ledger"):
            self.spark.read.text(f"{self.root}/ledger").write.partitionBy("run_seq", "batch_id").text(f"{root}/ledger")
        files.claim(self.spark, f"{root}/commits/{self._last_commit()}")
        return target
