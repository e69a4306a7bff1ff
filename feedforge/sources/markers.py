"""Small files on the shared file system: listing, writing once, reading."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = place(spark, path)
    return bool(fs.exists(where))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, where = place(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, where = place(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def put_once(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Write a file that must not exist yet; False if it does.

    The file is written under another name and renamed, so nobody sees a part of
    it, and of two writers one gets the name.
    """
    fs, where = place(spark, folder)
    fs.mkdirs(where)
    _, draft = place(spark, f"{folder}/.{uuid.uuid4().hex}")
    _, final = place(spark, f"{folder}/{name}")
    out = fs.create(draft, False)
    out.write(text.encode())
    out.close()
    try:
        return not fs.exists(final) and bool(fs.rename(draft, final))
    finally:
        fs.delete(draft, False)


def settled(spark: SparkSession, folder: str, name: str, text: str) -> str:
    """The text that was put under this name first: ours, or that of an earlier try."""
    path = f"{folder}/{name}"
    if not exists(spark, path) and put_once(spark, folder, name, text):
        return text
    return read_text(spark, path)
