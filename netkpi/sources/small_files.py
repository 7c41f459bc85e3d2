"""Small text files on any storage that Spark reaches: manifests, schema versions, marks of a batch."""
from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder. Hidden ones are left out."""
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(n for s in fs.listStatus(where) if not (n := s.getPath().getName()).startswith((".", "_")))


def read(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def put(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; False, and no change, when one of that name is there."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    fs, source = _at(spark, hidden)
    stream = fs.create(source, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if _renamed(spark, hidden, path):
        return True
    fs.delete(source, False)
    return False


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder; False, and no change, when the target is there."""
    fs, to = _at(spark, target)
    fs.mkdirs(to.getParent())
    return _renamed(spark, source, target)


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(target).toUri(), spark._jsc.hadoopConfiguration())
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never_over = spark.sparkContext._gateway.new_array(option, 1)
    never_over[0] = option.NONE
    try:
        context.rename(context.makeQualified(path(source)), context.makeQualified(path(target)), never_over)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or exists(spark, target):
            return False
        raise


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
