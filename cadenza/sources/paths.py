"""Folder questions asked through the file system Spark itself uses (HDFS, object store, local)."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, modification time) of the files in a folder; empty if there is none."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return [
        (s.getPath().getName(), s.getLen(), s.getModificationTime())
        for s in fs.listStatus(target)
        if s.isFile()
    ]


def stored_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def remove_dir(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole or not at all; False if there is one already. Of several runs that
    try, one succeeds: the text is written aside and gets its name by a rename that never replaces
    (on a local disk, by a link)."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    fs, target = _fs(spark, path)
    target = fs.makeQualified(target)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if target.toUri().getScheme() == "file":
            os.link(aside.toUri().getPath(), target.toUri().getPath())
            return True
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        plain = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files.rename(aside, target, plain)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        if fs.exists(aside):
            fs.delete(aside, False)
