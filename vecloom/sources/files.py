"""Folders of any store that Spark reaches, asked through its own file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _opened(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    place, system = _opened(spark, path)
    return [x.getPath().getName() for x in system.listStatus(place)] if system.exists(place) else []


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if another writer has made it before."""
    place, system = _opened(spark, path)
    system.mkdirs(place.getParent())
    return not system.exists(place) and system.createNewFile(place)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern of the file system matches."""
    place, system = _opened(spark, pattern)
    return [x.getPath().toString() for x in system.globStatus(place) or []]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as a file, whole or not at all; what was there before is replaced."""
    place, system = _opened(spark, path)
    aside, _ = _opened(spark, f"{place.getParent().toString()}/_{uuid.uuid4().hex}")
    system.mkdirs(place.getParent())
    stream = system.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if system.exists(place):
        system.delete(place, False)
    system.rename(aside, place)


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _opened(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def clear(spark: SparkSession, folder: str) -> None:
    """Take the files of a folder away, as an overwriting write does."""
    place, system = _opened(spark, folder)
    if system.exists(place):
        system.delete(place, True)
