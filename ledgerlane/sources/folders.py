"""Folders through Spark's own file systems, from the driver: names, sizes, removal, and joining finished files as bytes."""

from __future__ import annotations

from pyspark.sql import SparkSession

DONE = "_SUCCESS"


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none when it is absent."""
    store, p = _at(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(p)) if store.exists(p) else []


def complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote the folder ended; its mark is written last."""
    store, p = _at(spark, f"{path}/{DONE}")
    return store.exists(p)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``."""
    store, p = _at(spark, path)
    return store.getContentSummary(p).getLength() if store.exists(p) else 0


def remove(spark: SparkSession, path: str) -> None:
    store, p = _at(spark, path)
    store.delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark uses for it."""
    store, p = _at(spark, path)
    return store.makeQualified(p).toString()


def concatenate(spark: SparkSession, files: list[str], target: str) -> None:
    """One file of the bytes of all ``files``, streamed through a small buffer; it appears under its name when it is whole."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    store, whole = _at(spark, f"{target}.part")
    out = store.create(whole, True)
    try:
        for name in files:
            source, p = _at(spark, name)
            stream = source.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            finally:
                stream.close()
    finally:
        out.close()
    store.rename(whole, _at(spark, target)[1])
