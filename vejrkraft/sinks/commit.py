"""Partitions written aside and put in place as a whole.

A writer's tasks write into a staging folder of its own, which readers do not see. Its driver then claims the partitions it brings, one
file per partition that only one writer can create, and moves each partition's folder into place by a rename. A table never shows part of a
partition, and of two writers of one partition one is refused. ``recover`` finishes or undoes what a driver left that died
on the way.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrameWriter, SparkSession

_STAGING, _CLAIMS, _READY = "_staging-", "_claims", "_ready"


class Folder:
    """A folder in any file system the cluster can open."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.java = spark._jvm.org.apache.hadoop.fs
        self.root = folder.rstrip("/")
        self.fs = self.path().getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self.java.Path("/".join([self.root, *parts]))

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.path(*parts))

    def names(self, *parts: str) -> list[str]:
        if not self.exists(*parts):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(*parts)))

    def create(self, *parts: str) -> bool:
        """Create a file; False if somebody else has."""
        try:
            self.fs.create(self.path(*parts), False).close()
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getSimpleName():
                return False
            raise
        return True

    def move(self, source: Sequence[str], target: Sequence[str]) -> None:
        self.fs.mkdirs(self.path(*target).getParent())
        if self.exists(*target) or not self.fs.rename(self.path(*source), self.path(*target)):
            raise FileExistsError(f"cannot move {self.path(*source)} to {self.path(*target)}")

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)

    def parts(self, depth: int, *parts: str) -> list[list[str]]:
        """Partition folders ``depth`` levels down, such as [year=2024, month=1]."""
        found = [[]]
        for _ in range(depth):
            found = [[*p, n] for p in found for n in self.names(*parts, *p) if "=" in n]
        return found


def write_parts(spark: SparkSession, writer: DataFrameWriter, folder: str, depth: int, overwrite: bool) -> bool:
    """Save ``writer`` (partitioned by ``depth`` columns) to ``folder``; False if it has no rows.

    Partitions already there, or being written by somebody else, are refused with FileExistsError and nothing is
    written; with ``overwrite`` those already there are replaced.
    """
    table, staging = Folder(spark, folder), f"{_STAGING}{uuid4().hex}"
    try:
        writer.mode("errorifexists").save(f"{table.root}/{staging}/data")
        parts = table.parts(depth, staging, "data")
        if parts:
            _put(table, staging, parts, overwrite)
        return bool(parts)
    finally:
        # A staging folder marked ready belongs to ``recover``.
        if not table.exists(staging, _READY):
            table.delete(staging)
            if not table.names():
                table.delete()


def _claim(part: Sequence[str]) -> str:
    return ",".join(part)


def _put(table: Folder, staging: str, parts: list[list[str]], overwrite: bool) -> None:
    claimed: list[str] = []
    try:
        for part in parts:
            if not table.create(_CLAIMS, _claim(part)):
                raise FileExistsError(f"{table.root}: {_claim(part)} is being written by another writer")
            claimed.append(_claim(part))
        there = [_claim(p) for p in parts if table.exists(*p)]
        if there and not overwrite:
            raise FileExistsError(f"{table.root} already holds {there}")
        table.create(staging, _READY)
        _move(table, staging, parts)
        table.delete(staging)
    finally:
        if not table.exists(staging, _READY):
            for name in claimed:
                table.delete(_CLAIMS, name)
            if not table.names(_CLAIMS):
                table.delete(_CLAIMS)


def _move(table: Folder, staging: str, parts: list[list[str]]) -> None:
    for part in parts:
        if table.exists(*part):
            table.move(part, [staging, "old", *part])
        table.move([staging, "data", *part], part)


def recover(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Finish the writers that had all partitions ready and undo the others; to be called while nobody writes.

    Returns the partitions that were put in place.
    """
    table, moved = Folder(spark, folder), []
    for staging in [n for n in table.names() if n.startswith(_STAGING)]:
        if table.exists(staging, _READY):
            left = table.parts(depth, staging, "data")
            _move(table, staging, left)
            moved += [_claim(p) for p in left]
        table.delete(staging)
    table.delete(_CLAIMS)
    return moved
