"""Small files in a folder that all jobs share: names, claims that succeed once, and removal.

A claim makes a whole file appear under a name that nobody has taken. On a local file system that is a hard link, elsewhere a
rename that does not overwrite, which HDFS does atomically. An object store needs a file system whose rename has that property.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> dict[str, int]:
    """Name and time of change (milliseconds) of what lies in a folder; nothing if it does not exist."""
    system, where = _at(spark, folder)
    if not system.exists(where):
        return {}
    return {entry.getPath().getName(): entry.getModificationTime() for entry in system.listStatus(where)}


def text(spark: SparkSession, path: str) -> str:
    """Content of a small file, read by the driver."""
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def claim(spark: SparkSession, folder: str, name: str, content: str) -> bool:
    """Make ``folder/name`` hold ``content``, unless it exists already; whether this call made it."""
    system, where = _at(spark, folder)
    system.mkdirs(where)
    draft = f"{folder}/.{uuid.uuid4().hex}"
    _, source = _at(spark, draft)
    out = system.create(source, False)
    try:
        out.write(content.encode())
    finally:
        out.close()
    try:
        return _appear(spark, system, source, f"{folder}/{name}")
    finally:
        system.delete(source, False)


def _appear(spark: SparkSession, system, source, target: str) -> bool:
    if system.getUri().getScheme() == "file":
        local = [unquote(urlparse(system.makeQualified(p).toString()).path) for p in (source, _at(spark, target)[1])]
        try:
            os.link(*local)
        except FileExistsError:
            return False
        return True
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(source, fs.Path(target), plain)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True
