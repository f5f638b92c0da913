"""Files and folders of any store that Spark reaches, by the store's own interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all that is in it; nothing if there is none."""
    store, place = _at(spark, path)
    store.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Within one store. What is at ``to`` already goes."""
    store, place = _at(spark, path)
    target = _at(spark, to)[1]
    store.delete(target, True)
    store.mkdirs(target.getParent())
    if not store.rename(place, target):
        raise OSError(f"{path} could not be moved to {to}")


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its store's name and from its root, as scans tell the paths of their files, but not escaped."""
    store, place = _at(spark, path)
    return store.makeQualified(place).toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, by the driver."""
    store, place = _at(spark, path)
    stream = store.create(place, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None if there is none."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
