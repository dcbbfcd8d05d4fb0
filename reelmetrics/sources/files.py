"""Small files next to datasets, on whatever file system holds the path.

These go through the file system classes that Spark itself uses, so a path may lie in any store
that the session can write to. They are for records of a few kilobytes; data is written by jobs.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if it does not exist."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all of a text; False if there is one of that name already.

    The text is written under another name first and then renamed, so nobody sees a part of it.
    """
    fs, where = _at(spark, path)
    jvm = spark._jvm
    if fs.exists(where):
        return False
    name = f".{where.getName()}.{uuid.uuid4().hex}"
    hidden = jvm.org.apache.hadoop.fs.Path(where.getParent(), name)
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    # Without the option to overwrite, this fails if another writer came first.
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(hidden), fs.makeQualified(where), options)
    except Py4JJavaError:
        fs.delete(hidden, False)
        if fs.exists(where):
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that is in it, if it is there."""
    fs, where = _at(spark, path)
    if fs.exists(where):
        fs.delete(where, True)
