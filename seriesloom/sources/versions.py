"""Folders that hold versions and a marker naming the one that counts.

A version is written whole into a fresh folder before the marker is replaced in
one step, so readers find the former version or the new one, never a mixture.
"""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

MARKER = "CURRENT"


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def fresh(path: str, name: str = "version") -> str:
    """A folder below ``path`` that nothing has written to."""
    return f"{path.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, text: str) -> None:
    """Replace the marker of ``path`` by one that says ``text``."""
    target, files = _file_system(spark, f"{path}/{MARKER}")
    made, _ = _file_system(spark, fresh(path, f".{MARKER}"))
    out = files.create(made, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    context.getFileContext(files.getUri(), configuration).rename(made, target, options)


def committed(spark: SparkSession, path: str) -> str | None:
    """What the marker of ``path`` says; None without one."""
    if not exists(spark, f"{path}/{MARKER}"):
        return None
    return spark.read.text(f"{path}/{MARKER}", wholetext=True).first()[0]


def remove_others(spark: SparkSession, path: str, kept: set[str], name: str = "version") -> None:
    """Delete the versions below ``path`` that are not among ``kept``."""
    place, files = _file_system(spark, path)
    for entry in files.listStatus(place):
        found = entry.getPath().getName()
        if found.startswith(f"{name}-") and found not in kept:
            files.delete(entry.getPath(), True)
