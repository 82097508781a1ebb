"""Row numbers and chunk ids over a whole table, without putting it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecloom.operators.project import quoted
from vecloom.session import work_path

_PLACE = "_place"


def number_rows(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Add `row_num`, 1 to n in the order of `order_by`.

    A range-partitioned sort is written once to the shared folder with each row's place
    in its partition; the numbers are that place plus the sizes of the partitions before.
    Rows equal in `order_by` are ordered by a hash of the row, and full copies by the
    input partition they come from, so that a hot group of copies is spread over ranges.
    """
    spark = df.sparkSession
    columns = [quoted(c) for c in df.columns]
    row_hash = F.xxhash64(*columns)
    placed = (
        df.withColumn("_hash", row_hash)
        .withColumn("_from", F.spark_partition_id())
        .orderBy(*order_by, "_hash", "_from")
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .select(*columns, _PLACE)
    )
    path = work_path(spark, "ordered")
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)

    # monotonically_increasing_id keeps the partition in its upper bits, the place in the lower 33.
    part = F.shiftright(_PLACE, 33).alias("_part")
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # One row per sort partition: bounded by spark.sql.shuffle.partitions, not by the data.
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.withColumn("_part", F.shiftright(_PLACE, 33))
        .join(F.broadcast(starts), "_part")
        .select(*columns, (F.col("_start") + place + 1).alias("row_num"))
    )


def chunk_assign(df: DataFrame, chunk_size: int, order_by: Sequence[str]) -> DataFrame:
    """Add `row_num` and `chunk_id` = floor((row_num - 1) / chunk_size)."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    chunk = F.floor((F.col("row_num") - 1) / F.lit(chunk_size))
    return number_rows(df, order_by).withColumn("chunk_id", chunk)


def chunk_plan(chunked: DataFrame) -> DataFrame:
    """Rows in each chunk; the number of chunks is the number of rows here."""
    return chunked.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows_in_chunk"))


def chunk_count(rows: int, chunk_size: int) -> int:
    return -(-rows // chunk_size)


# Rows drawn in a round of a selection; each round keeps about one in so many of the rows.
PIVOTS = 64


def nth_row(rows: DataFrame, order: Sequence[str], nth: int) -> tuple[DataFrame, int] | None:
    """The row that is `nth` (from 1) in the order of some columns, as one struct `last`, and how many lie before its like.

    None if there are fewer rows. No row is sorted or moved: in rounds, some rows are drawn, all rows are
    counted by the ranges between them, and the range that holds the wanted one goes on. A drawn row has a
    range of its own for its copies, so every round ends the search or leaves fewer rows. `rows` is
    read once or twice a round: pass a written one.
    """
    spark = rows.sparkSession
    place, before, turn = F.struct(*order), 0, 0
    inside = rows
    while True:
        drawn = inside.orderBy(F.xxhash64(F.lit(turn), *order)).limit(PIVOTS).select(place.alias("_p"))
        path = work_path(spark, "pivots")
        drawn.agg(F.array_sort(F.collect_set("_p")).alias("pivots")).write.parquet(path)
        pivots = spark.read.parquet(path)
        # Even: between the pivots; odd: equal to one.
        below = F.size(F.filter("_drawn", lambda p: p < F.col("_place")))
        equal = F.array_contains("_drawn", F.col("_place")).cast("int")
        beside = inside.select(place.alias("_place"), pivots.scalar().alias("_drawn"))
        counts = sorted(beside.groupBy((below * 2 + equal).alias("range")).agg(F.count(F.lit(1)).alias("n")).collect())
        for found, n in counts:
            if before + n >= nth:
                break
            before += n
        else:
            return None
        low, odd = divmod(found, 2)

        def pivot(k: int) -> DataFrame:
            return pivots.select(F.col("pivots")[k].alias("last"))

        if odd:
            return pivot(low), before
        if low:
            inside = inside.filter(place > pivot(low - 1).scalar())
        if low < pivots.select(F.size("pivots")).first()[0]:
            inside = inside.filter(place < pivot(low).scalar())
        turn += 1


def limit_rows(df: DataFrame, max_rows: int, order_by: Sequence[str]) -> DataFrame:
    """The first `max_rows` rows by `order_by` and a hash of the row; all rows if `max_rows` is not positive.

    The last row that is let in is found on the order columns and hashes alone, which are written once and
    never sorted; the whole rows are then only filtered, so they stay in their tasks. Copies of that row are
    told apart by nothing, so as many as are still wanted are made of one of them.
    """
    if max_rows <= 0:
        return df
    names = [quoted(c) for c in df.columns]
    hashes = [F.xxhash64(*names).alias("_h1"), F.xxhash64(F.lit(1), *names).alias("_h2")]
    keys = [quoted(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
    place = F.struct(*keys, *hashes)
    path = work_path(df.sparkSession, "places")
    narrow = df.select(*keys, *hashes)
    narrow.write.parquet(path)
    found = nth_row(df.sparkSession.read.schema(narrow.schema).parquet(path), [*(f"_o{i}" for i in range(len(order_by))), "_h1", "_h2"], max_rows)
    if found is None:
        return df
    last, before = found
    below = df.filter(place < last.scalar())
    copy = df.filter(place == last.scalar()).limit(1).withColumn("_copies", F.lit(max_rows - before))
    copies = copy.select(*names, F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*names)
    return below.unionByName(copies)


def sample_rows(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    """A few records for a look, the same ones each time."""
    return df.orderBy(*order_by).limit(rows)
