"""Directory listings through the Hadoop file system that owns the path."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from stratalake.layout import LANDING_SUFFIX, LakeLayout

# What a table is called beside itself while it is replaced.
_HALF_DONE = re.compile(r"_(?P<table>.+)-[0-9a-f]{12}-(?:new|old)")


def _file_system(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def entries(spark: SparkSession, uri: str) -> list[tuple[str, bool]]:
    """Name and whether it is a directory, for every entry of ``uri``, by name."""
    fs, path = _file_system(spark, uri)
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(path))


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _file_system(spark, uri)
    return fs.exists(path)


def size_in_bytes(spark: SparkSession, uri: str) -> int:
    """Bytes below ``uri``, 0 where nothing is there."""
    fs, path = _file_system(spark, uri)
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def largest_file(spark: SparkSession, uri: str) -> int:
    """Bytes of the file at ``uri``, or of the largest file directly in it."""
    fs, path = _file_system(spark, uri)
    return max((s.getLen() for s in fs.listStatus(path) if s.isFile()), default=0)


def files(spark: SparkSession, uri: str) -> dict[str, int]:
    """Bytes of each file directly in ``uri``, by name; hidden ones are left out."""
    fs, path = _file_system(spark, uri)
    found = {s.getPath().getName(): s.getLen() for s in fs.listStatus(path) if s.isFile()}
    return {name: size for name, size in sorted(found.items()) if not name.startswith(("_", "."))}


def move(spark: SparkSession, uri: str, target: str) -> None:
    """Renames a file; nothing may be at ``target``."""
    fs, path = _file_system(spark, uri)
    if not fs.rename(path, _file_system(spark, target)[1]):
        raise OSError(f"{uri} cannot be moved to {target}")


def qualified(spark: SparkSession, uri: str) -> str:
    """``uri`` with scheme and authority, so that two spellings of one place compare equal."""
    fs, path = _file_system(spark, uri)
    return fs.makeQualified(path).toString().rstrip("/")


def remove(spark: SparkSession, uri: str) -> None:
    """Deletes what is at ``uri``, if anything."""
    fs, path = _file_system(spark, uri)
    fs.delete(path, True)


def swap(spark: SparkSession, new: str, uri: str, old: str) -> None:
    """Puts ``new`` in the place of ``uri``, which goes to ``old`` meanwhile and comes back if the second rename fails."""
    fs, target = _file_system(spark, uri)
    fresh, former = _file_system(spark, new)[1], _file_system(spark, old)[1]
    there = fs.exists(target)
    if there and not fs.rename(target, former):
        raise OSError(f"{uri} cannot be moved")
    if not fs.rename(fresh, target):
        if there:
            fs.rename(former, target)
        raise OSError(f"{new} cannot be moved to {uri}")
    if there:
        fs.delete(former, True)


def recover(spark: SparkSession, uri: str) -> bool:
    """Undoes a replacement of the table at ``uri`` that ended between its two renames; tells whether there was one.

    The former rows, beside it under a hidden name, come back, and what the replacement had written goes.
    """
    parent, _, name = uri.rstrip("/").rpartition("/")
    if exists(spark, uri) or not parent or not exists(spark, parent):
        return False
    left = [entry for entry, is_directory in entries(spark, parent) if is_directory and _HALF_DONE.fullmatch(entry)]
    of_table = [entry for entry in left if _HALF_DONE.fullmatch(entry)["table"] == name]
    former = [entry for entry in of_table if entry.endswith("-old")]
    if len(former) != 1:
        return False
    fs, target = _file_system(spark, uri)
    if not fs.rename(_file_system(spark, f"{parent}/{former[0]}")[1], target):
        raise OSError(f"{parent}/{former[0]} cannot be moved back to {uri}")
    for entry in of_table:
        if entry.endswith("-new"):
            remove(spark, f"{parent}/{entry}")
    return True


def recover_all(spark: SparkSession, layer: str) -> list[str]:
    """``recover`` for every table of a layer that only has former rows; gives their names."""
    if not exists(spark, layer):
        return []
    hidden = [match["table"] for name, _ in entries(spark, layer) if (match := _HALF_DONE.fullmatch(name)) and name.endswith("-old")]
    return [name for name in sorted(set(hidden)) if recover(spark, f"{layer}/{name}")]


def scratch_directory(spark: SparkSession, uri: str) -> str:
    """A new directory that the driver's JVM deletes when it ends."""
    fs, path = _file_system(spark, uri)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return uri


def names_with_suffix(spark: SparkSession, uri: str, suffix: str) -> list[str]:
    """Entries that end in ``suffix``, files or directories, without it."""
    return [name.removesuffix(suffix) for name, _ in entries(spark, uri) if name.endswith(suffix)]


def landing_tables(spark: SparkSession, layout: LakeLayout) -> list[str]:
    return names_with_suffix(spark, layout.landing, LANDING_SUFFIX)


def bronze_tables(spark: SparkSession, layout: LakeLayout) -> list[str]:
    recover_all(spark, layout.bronze)
    return [name for name, is_directory in entries(spark, layout.bronze) if is_directory and not name.startswith(("_", "."))]
