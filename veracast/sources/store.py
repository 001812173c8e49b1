"""Small files on any store Spark's Hadoop client reaches: text, listing, rename as commit."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _opened(spark, path)
    return store.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in a folder, none if it does not exist."""
    store, where = _opened(spark, folder)
    if not store.exists(where):
        return []
    return sorted(f.getPath().getName() for f in store.listStatus(where))


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path, 0 if it does not exist."""
    store, where = _opened(spark, path)
    return store.getContentSummary(where).getLength() if store.exists(where) else 0


def read_text(spark: SparkSession, path: str) -> str:
    store, where = _opened(spark, path)
    source = store.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    store, where = _opened(spark, path)
    sink = store.create(where, True)
    try:
        sink.write(bytearray(text.encode()))
    finally:
        sink.close()


class AlreadyThere(RuntimeError):
    """Someone else has written the file first."""


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename in one step; an error if the target exists."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    if exists(spark, target):
        raise AlreadyThere(target)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = context._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    store, where = _opened(spark, target)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        store.makeQualified(where).toUri(), context._jsc.hadoopConfiguration()
    )
    store.mkdirs(where.getParent())
    try:
        files.rename(_opened(spark, source)[1], where, how)
    except Exception as wrong:
        if exists(spark, target) and exists(spark, source):
            raise AlreadyThere(target) from wrong
        raise


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a file whole or not at all; an error if it exists."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    try:
        move(spark, draft, path)
    except BaseException:
        remove(spark, draft)
        raise


def remove(spark: SparkSession, path: str) -> None:
    store, where = _opened(spark, path)
    store.delete(where, True)
