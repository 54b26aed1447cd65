"""Small files beside tables (manifests, markers), by the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a file whole or not at all; one that exists already is an error.

    The text is written under a name of its own and renamed, so no reader sees
    a part of it and of two writers of one name only the first succeeds.
    """
    system, place = _at(spark, path)
    _, own = _at(spark, f"{path}.new")
    stream = system.create(own, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(place) or not system.rename(own, place):
        raise FileExistsError(path)


def graft(spark: SparkSession, source: str, target: str, replaced: str | None = None) -> None:
    """Rename the folders in ``source`` into ``target``; one that the target lacks moves whole.

    So a new day or provider is one rename, however many files it has. In a folder
    of both sides the target's files whose names begin with ``replaced`` go first.
    """
    system, place = _at(spark, target)
    entries = [e for e in system.listStatus(_at(spark, source)[1]) if not e.getPath().getName().startswith(("_", "."))]
    if replaced is not None and any(not entry.isDirectory() for entry in entries):
        for old in names(spark, target):
            if old.startswith(replaced):
                remove(spark, f"{target}/{old}")
    for entry in entries:
        name = entry.getPath().getName()
        to = _at(spark, f"{target}/{name}")[1]
        if entry.isDirectory() and system.exists(to):
            graft(spark, f"{source}/{name}", f"{target}/{name}", replaced)
        elif not system.rename(entry.getPath(), to):
            raise FileNotFoundError(f"{source}/{name}")


def remove(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)
