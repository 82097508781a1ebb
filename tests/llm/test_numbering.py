import glob
import os

import pytest
from pyspark.sql import functions as F

from vecloom.llm import lines, simhash, suffixes
from vecloom.llm.numbering import numbered


@pytest.fixture(scope="module")
def table(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "a folder")
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def copies(spark):
    return set(glob.glob(spark.conf.get("spark.checkpoint.dir") + "/numbered-*"))


def test_pinned_rows_of_files_are_not_copied(spark, table):
    """Texts are read where they are; the results are those of a written copy."""
    for run in (
        lambda pinned: lines.drop_lines(spark, table, pinned=pinned),
        lambda pinned: simhash.one_of_each(spark, table, size=5, alike=0.8, pinned=pinned),
        lambda pinned: suffixes.drop_repeats(spark, table, least=240, pinned=pinned),
    ):
        before = copies(spark)
        found = sorted(run(True).collect())
        assert copies(spark) == before
        assert found == sorted(run(False).collect())
        assert len(copies(spark)) == len(before) + 1


def test_pinned_numbers_are_one_for_each_row(spark, table):
    found = numbered(spark, table.select("doc_id"), "number", pinned=True)
    once, again = ({r["doc_id"]: r["number"] for r in f.collect()} for f in (found, found.repartition(5)))
    assert once == again and len(set(once.values())) == len(once) == table.count()
    assert {n >> 33 for n in once.values()} == set(range(len([f for f in os.listdir(table.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "").replace("%20", " ")) if f.endswith(".parquet")])))


def test_pinned_rows_that_share_a_place_or_have_none_are_written(spark, table):
    for frame in (table.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))), table.unionByName(table), spark.range(5).toDF("doc_id")):
        before = copies(spark)
        found = numbered(spark, frame, "number", pinned=True)
        assert found.select("number").distinct().count() == frame.count()
        assert len(copies(spark)) == len(before) + 1
