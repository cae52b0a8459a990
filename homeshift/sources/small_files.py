"""Names and small text files (manifests, markers) on the file system of a path, whatever it is."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder; none if it is not there."""
    fs, target = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not be there yet: under another name first, then renamed, so it is whole or absent."""
    fs, target = _fs(spark, path)
    folder = target.getParent()
    fs.mkdirs(folder)
    _, part = _fs(spark, f"{folder.toString()}/.{target.getName()}-{uuid.uuid4().hex[:8]}")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(part, target):
        fs.delete(part, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that is not taken; the target's parent folder is made."""
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise FileExistsError(target)
