"""Sets of stored tables that change all at once: versioned folders and a log of commits.

A refresh writes every table into a folder of its own below ``<root>/snapshots`` and then adds one
file to ``<root>/commits`` that names the path of every table of the set. Readers take the newest
readable commit, so until that file is there they see the set before, whole; a refresh that fails
half-way leaves folders nobody reads. Tables that a refresh does not write stay as they were. Commit
files are numbered and created only if absent, so of two refreshes that started from the same set one
fails at its commit instead of mixing with the other (on object stores without such a create, keep to
one writer).

Row counts and counts of failing values are observed while a table is written, at no extra scan.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMITS, FOLDERS = "commits", "snapshots"
ROWS = "rows"


class ConcurrentRefresh(RuntimeError):
    """Another refresh was committed since this one began."""


class SnapshotStore:
    """The sets of tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _file(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, *parts: str) -> list:
        path, files = self._file(*parts)
        return list(files.listStatus(path)) if files.exists(path) else []

    def numbers(self) -> list[int]:
        """Numbers of all commits, newest first."""
        names = [s.getPath().getName() for s in self._children(COMMITS)]
        return sorted((int(x.removesuffix(".json")) for x in names if x.endswith(".json")), reverse=True)

    def _manifest(self, number: int) -> dict[str, str] | None:
        path = f"{self.root}/{COMMITS}/{number:012d}.json"
        row = self.spark.read.text(path, wholetext=True).first()
        try:
            return json.loads(row[0])["tables"] if row else None
        except (ValueError, KeyError):
            return None  # a commit that was cut off is none

    def current(self) -> dict[str, str]:
        """Path of each table of the newest set, relative to the root; empty before the first."""
        for number in self.numbers():
            if (found := self._manifest(number)) is not None:
                return found
        return {}

    def path(self, name: str) -> str | None:
        """Where the newest set keeps table ``name``, if it has it."""
        found = self.current().get(name)
        return found and f"{self.root}/{found}"

    def begin(self) -> Draft:
        """A new set that starts as the newest one."""
        numbers = self.numbers()
        return Draft(self, numbers[0] + 1 if numbers else 1, self.current())

    def expire(self, keep: int = 2, idle_hours: float = 24) -> list[str]:
        """Delete folders that none of the newest ``keep`` sets uses and that nobody wrote to for
        ``idle_hours``; their names."""
        kept: set[str] = set()
        for number in self.numbers()[: max(1, keep)]:
            kept |= {path.split("/")[1] for path in (self._manifest(number) or {}).values()}
        oldest = 1000 * (time.time() - 3600 * idle_hours)
        gone = []
        for status in self._children(FOLDERS):
            name = status.getPath().getName()
            last = max([status.getModificationTime(), *self._touched(name)])
            if name not in kept and last <= oldest:
                path, files = self._file(FOLDERS, name)
                files.delete(path, True)
                gone.append(name)
        return gone

    def _touched(self, folder: str) -> Iterable[int]:
        return (s.getModificationTime() for s in self._children(FOLDERS, folder))


class Draft:
    """A set being written; nobody reads it before :meth:`commit`."""

    def __init__(self, store: SnapshotStore, number: int, tables: dict[str, str]):
        self.store, self.number, self.tables = store, number, dict(tables)
        self.folder = f"{FOLDERS}/{uuid.uuid4().hex}"
        self.observed: dict[str, dict[str, int]] = {}

    def write(
        self,
        name: str,
        df: DataFrame,
        month_column: str | None = None,
        counts: Mapping[str, Column] | None = None,
        keep: tuple[str, ...] | None = None,
        listed: bool = True,
        folder_column: str | None = None,
        sort: tuple[str, ...] = (),
        options: Mapping[str, str] | None = None,
    ) -> str:
        """Store table ``name`` and return its path.

        ``counts`` are aggregates over all columns of ``df``, observed with the rows while they pass;
        of the columns, ``keep`` are stored. A table that is not ``listed`` is a stepping stone: it is
        no part of the set. ``month_column`` brings the rows of a month together in a folder;
        ``folder_column`` gives each of its values a folder without moving rows between tasks. Rows of a
        task are written in the order of ``sort``; ``options`` are those of the Parquet writer.
        """
        seen = Observation()
        figures = [F.count(F.lit(1)).alias(ROWS), *[c.alias(n) for n, c in (counts or {}).items()]]
        df = df.observe(seen, *figures)
        df = df.select(*keep) if keep else df
        df = df.hint("rebalance", month_column) if month_column else df
        if sort:  # within a folder too, so that the writer sorts no more
            df = df.sortWithinPartitions(*[c for c in (month_column or folder_column, *sort) if c])
        where = f"{self.folder}/{name}"
        path = f"{self.store.root}/{where}"
        # A folder of this draft alone: overwriting only ever repeats an own failed attempt.
        writer = df.write.mode("overwrite").options(**options or {})
        folders = month_column or folder_column
        (writer.partitionBy(folders) if folders else writer).parquet(path)
        self.observed[name] = {k: v or 0 for k, v in seen.get.items()}
        if listed:
            self.tables[name] = where
        return path

    def commit(self) -> None:
        """Make this the newest set, in one step."""
        path, files = self.store._file(COMMITS, f"{self.number:012d}.json")
        newest = self.store.numbers()
        if newest and newest[0] >= self.number:
            raise ConcurrentRefresh(f"commit {self.number} of {self.store.root} exists already")
        content = json.dumps({"tables": self.tables}, indent=1).encode()
        try:
            out = files.create(path, False)
        except Exception as error:
            if "AlreadyExists" in str(error) or "already exists" in str(error):
                raise ConcurrentRefresh(f"commit {self.number} of {self.store.root} exists already") from error
            raise
        try:
            out.write(bytearray(content))
        finally:
            out.close()
