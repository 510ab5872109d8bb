"""Many small files, read in groups so that the driver knows the files of one group only.

Spark lists the files of a frame on the driver, which keeps kilobytes for each and for the tasks that read them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

GLOB = re.compile(r"[*?{}\[\]\\]")

# Files of a group.  A folder with fewer is not divided.
MOST_AT_ONCE = 16_384

# Spark takes the opening of a file for 4 MiB of work, by which a task has a handful of small files, lists each of many paths
# in a task of its own, and keeps 250 MB of listings, also of frames that are gone.
_SETTINGS = {
    "spark.sql.files.openCostInBytes": str(64 * 1024),
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}


@dataclass(frozen=True)
class FileGroup:
    """Patterns to read together, and the folder below which names of folders are values (``key=value``)."""

    patterns: tuple[str, ...]
    base: str | None = None

    @property
    def options(self) -> dict[str, str]:
        return {"basePath": self.base} if self.base else {}


def file_groups(spark: SparkSession, path: str | list[str]) -> Iterator[FileGroup]:
    """What a reader would read from ``path``, in groups of ``MOST_AT_ONCE`` files at most, each file in one of them.

    Folders stay whole where they are small enough; the files of a larger one are named.  A path that is not there is
    left to the reader to refuse.  There is one group at least.
    """
    group: list[str] = []
    size, base = 0, None
    for paths, files, below in _units(spark, [path] if isinstance(path, str) else path):
        if group and (size + files > MOST_AT_ONCE or below != base):
            yield FileGroup(tuple(group), base)
            group, size = [], 0
        group += paths
        size, base = size + files, below
    yield FileGroup(tuple(group), base)


def _pattern(path) -> str:
    """What a reader takes for this path and no other."""
    return GLOB.sub(r"\\\g<0>", path.toString())


def _units(spark: SparkSession, paths: list[str]) -> Iterator[tuple[list[str], int, str | None]]:
    """Patterns that belong in one group, how many files they have, and their base."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    named_values = hadoop.GlobFilter("*=*")
    for path in paths:
        place = hadoop.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        roots = files.globStatus(place)
        if not roots:
            yield [path], 0, None  # as given, for the reader to refuse
        for root in roots or ():
            if root.isFile():
                yield [_pattern(root.getPath())], 1, None
            else:
                yield from _folder_units(files, root.getPath(), named_values, None)


def _folder_units(files, folder, named_values, base: str | None) -> Iterator[tuple[list[str], int, str | None]]:
    within = (one for one in files.listStatus(folder, named_values) if one.isDirectory())
    parts = [one.getPath() for one in within if not one.getPath().getName().startswith(".")]
    for part in parts:
        yield from _folder_units(files, part, named_values, base or folder.toString())
    if parts:
        return
    count = len(files.listStatus(folder))
    if count <= MOST_AT_ONCE:
        yield [_pattern(folder)], count, base
        return
    names: list[str] = []
    entries = files.listStatusIterator(folder)
    while entries.hasNext():
        entry = entries.next()
        if entry.isFile():
            names.append(_pattern(entry.getPath()))
        if len(names) == MOST_AT_ONCE:
            yield names, len(names), base
            names = []
    if names:
        yield names, len(names), base


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Tasks take as many small files as their bytes allow, and listings are forgotten with their frames, until the end."""
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    try:
        for key, value in _SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
