"""Versions of a lake object: a log of markers, each naming something complete.

The log of an object is the folder ``_versions`` below it. A marker is an empty
file whose *name* is ``number.entry``: the entry names a folder or a manifest
that was written whole before. So a marker is never half there, and a reader
needs one listing. The highest number is current.

What is needed of the store is that a listing shows every file created before
it (HDFS, S3, ABFS, GCS and local file systems do); neither renames nor
exclusive creation are needed. A writer states the version it started from,
creates its marker and lists again: where another marker has its number, or
the log moved on meanwhile, it takes its marker back and fails. Of two that
race at least one fails, and none succeeds on top of a version that it has not
seen. A writer that dies between its marker and that second look leaves two
markers of one number; readers take the older file then (the smaller name at
equal times), which is the one whose writer may have succeeded.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

MARKERS = "_versions"
MANIFESTS = "_manifests"
_MARKER = re.compile(r"(\d{10})\.(.+)")


class ConcurrentPublish(RuntimeError):
    """Another writer published meanwhile; nothing of this publish is visible."""


def fs_and_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time) of a folder's entries; none where it does not exist."""
    fs, p = fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [(str(s.getPath().getName()), int(s.getModificationTime())) for s in fs.listStatus(p)]


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, entry) of the published versions, the current one last."""
    first: dict[int, tuple[int, str]] = {}
    for name, time in list_names(spark, f"{path}/{MARKERS}"):
        if found := _MARKER.fullmatch(name):
            number = int(found[1])
            first[number] = min(first.get(number, (time, found[2])), (time, found[2]))
    return [(number, entry) for number, (_, entry) in sorted(first.items())]


def current_number(spark: SparkSession, path: str) -> int:
    """Number of the current version, 0 where there is none: what a writer starts from."""
    found = versions(spark, path)
    return found[-1][0] if found else 0


def commit(spark: SparkSession, path: str, entry: str, base: int) -> int:
    """Make ``entry`` the version after ``base``, the one its writer started from."""
    number = base + 1
    taken = [n for n, _ in versions(spark, path) if n >= number]
    if taken:
        raise ConcurrentPublish(f"version {taken[-1]} of {path} exists already")
    marker = f"{number:010d}.{entry}"
    fs, p = fs_and_path(spark, f"{path}/{MARKERS}/{marker}")
    fs.create(p, False).close()
    others = [name for name, _ in list_names(spark, f"{path}/{MARKERS}")
              if (found := _MARKER.fullmatch(name)) and int(found[1]) >= number and name != marker]
    if others:
        fs.delete(p, False)
        raise ConcurrentPublish(f"version {number} of {path} exists already: {others[0]}")
    return number


def forget(spark: SparkSession, path: str, numbers: list[int]) -> None:
    """Drop the markers of old versions."""
    for name, _ in list_names(spark, f"{path}/{MARKERS}"):
        if (found := _MARKER.fullmatch(name)) and int(found[1]) in numbers:
            delete(spark, f"{path}/{MARKERS}/{name}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete what no version names any more; a failure here only leaves it there."""
    fs, p = fs_and_path(spark, path)
    try:
        fs.delete(p, True)
    except Exception:  # the publish has succeeded; the next one, or a cleaner, removes it
        pass


def write_manifest(spark: SparkSession, path: str, name: str, rows: Mapping[str, str]) -> None:
    """A manifest: one ``key <tab> value`` a line, in the order of the keys."""
    fs, p = fs_and_path(spark, f"{path}/{MANIFESTS}/{name}")
    stream = fs.create(p, False)
    try:
        stream.write(bytearray("".join(f"{k}\t{v}\n" for k, v in sorted(rows.items())).encode()))
    finally:
        stream.close()


def read_manifest(spark: SparkSession, path: str, name: str) -> dict[str, str]:
    fs, p = fs_and_path(spark, f"{path}/{MANIFESTS}/{name}")
    stream = fs.open(p)
    try:
        text = str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return dict(line.split("\t", 1) for line in text.splitlines())
