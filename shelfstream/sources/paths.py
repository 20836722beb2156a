"""Listing of the shared file system through Spark's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, files = _open(spark, path)
    return files.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries right under ``path``; none when it is not there."""
    location, files = _open(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    location, files = _open(spark, path)
    stream = files.create(location, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def get_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small control file, None when there is none."""
    location, files = _open(spark, path)
    if not files.exists(location):
        return None
    stream = files.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete one file."""
    location, files = _open(spark, path)
    files.delete(location, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    location, files = _open(spark, path)
    files.delete(location, True)


def make_folder(spark: SparkSession, path: str) -> None:
    location, files = _open(spark, path)
    files.mkdirs(location)
