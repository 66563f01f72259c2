"""Versions of a stored thing: numbered state files in a folder.

A writer writes its new data beside the old, then one small file that names
all that belongs to the new version. Readers take the file with the highest
number, so a version is there wholly or not at all, and a writer that is lost
on the way leaves files that nothing names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_versions"


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _file_system(spark, f"{root}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def current(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """(number, state) of the newest version; (0, None) before the first."""
    numbers = _numbers(spark, root)
    if not numbers:
        return 0, None
    fs, path = _file_system(spark, f"{root}/{FOLDER}/{numbers[-1]:010d}.json")
    jvm = spark.sparkContext._jvm
    source = fs.open(path)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    return numbers[-1], json.loads(text)


def commit(spark: SparkSession, root: str, number: int, state: dict) -> int:
    """Make ``state`` the version after ``number``, in one step. Raises if
    another writer has done so."""
    fs, target = _file_system(spark, f"{root}/{FOLDER}/{number + 1:010d}.json")
    _, draft = _file_system(spark, f"{root}/{FOLDER}/.draft-{uuid.uuid4().hex}")
    sink = fs.create(draft, True)
    sink.write(bytearray(json.dumps(state).encode()))
    sink.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"version {number + 1} of {root} was written by another writer")
    return number + 1
