"""Small driver-side file work through Hadoop's file system (any store Spark resolves)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below ``path``; none if there is no such folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``path`` as a whole or not at all: under another name, then renamed.
    An existing file is an error (somebody else committed first)."""
    fs, p = _fs(spark, path)
    _, other = _fs(spark, path + ".new")
    out = fs.create(other, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(other, p):
        raise FileExistsError(path)
