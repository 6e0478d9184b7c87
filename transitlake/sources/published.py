"""Published tables: version folders, and a log that says which of them count.

A table that others read while it is rebuilt is never overwritten.  Each build
writes folders of its own (``<table>.versions/v=<id>``) and then appends one
small file to the table's log (``<table>.commits``): the rows of a commit
name the folders that make up the table from then on, with the table's
schema.  A reader takes the newest commit, so it sees the table before or
after a build, never between; a build that dies leaves folders that no commit
names.  A commit may keep folders of earlier ones, so a table can be renewed
partition by partition at the cost of the partitions that changed.

Superseded folders stay for readers that are still at work, until
:meth:`Published.retire` removes what the last few commits no longer name.
One writer at a time is assumed (the layer runs are); if two commit at once,
the one with the greater version id is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "seq bigint, version string, through bigint, layout string, part string, folder string"


@dataclass(frozen=True)
class Commit:
    """One entry of the log: ``folders`` maps a partition folder ('' for a whole version) to its version."""

    seq: int
    through: int | None
    schema: StructType
    folders: dict[str, str]


@dataclass(frozen=True)
class Published:
    """The published table at ``path`` (its plain location, which stays unused), stored as ``fmt``."""

    path: str
    fmt: str = "parquet"

    @property
    def versions(self) -> str:
        return f"{self.path}.versions"

    def folder(self, version: str, part: str = "") -> str:
        return f"{self.versions}/v={version}" + (f"/{part}" if part else "")

    def _log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(COMMITS).parquet(f"{self.path}.commits")

    def _commits(self, spark: SparkSession, newest: int) -> list[Commit]:
        """The last ``newest`` commits, newest first (folder names only, as a table's file listing)."""
        if not _is_there(spark, f"{self.path}.commits"):
            return []
        log = self._log(spark)
        last = log.select("seq", "version").distinct().orderBy(F.desc("seq"), F.desc("version")).limit(newest)
        found: dict[tuple, Commit] = {}
        for r in log.join(F.broadcast(last), ["seq", "version"]).orderBy(F.desc("seq"), F.desc("version")).collect():
            commit = found.setdefault((r.seq, r.version), Commit(r.seq, r.through, StructType.fromJson(json.loads(r.layout)), {}))
            commit.folders[r.part] = r.folder
        return list(found.values())

    def latest(self, spark: SparkSession) -> Commit | None:
        return next(iter(self._commits(spark, 1)), None)

    def commit(self, spark: SparkSession, schema: StructType, folders: dict[str, str], through: int | None = None) -> None:
        """Make ``folders`` (partition folder -> version) the table, in one appended file."""
        before = self.latest(spark)
        seq, version = (before.seq + 1 if before else 0), uuid.uuid4().hex
        rows = [(seq, version, through, schema.json(), part, folder) for part, folder in folders.items()]
        spark.createDataFrame(rows, COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}.commits")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The table of the newest commit; None if there is none."""
        found = self.latest(spark)
        return None if found is None else self.read_commit(spark, found)

    def read_commit(self, spark: SparkSession, commit: Commit) -> DataFrame:
        reader = spark.read.format(self.fmt).schema(commit.schema)
        paths = [self.folder(v, part) for part, v in commit.folders.items()]
        if any(commit.folders):
            reader = reader.option("basePath", self.versions)
        return reader.load(paths).select(*commit.schema.names)

    def discard(self, spark: SparkSession, version: str) -> None:
        """Remove a version that will not be committed."""
        _remove(spark, [self.folder(version)])

    def retire(self, spark: SparkSession, keep: int = 2, look_back: int = 20) -> int:
        """Remove folders that only commits before the last ``keep`` name; how many."""
        commits = self._commits(spark, keep + look_back)
        needed = {(v, part) for c in commits[:keep] for part, v in c.folders.items()}
        old = {(v, part) for c in commits[keep:] for part, v in c.folders.items()} - needed
        return _remove(spark, sorted(self.folder(v, part) for v, part in old))


def _on_its_file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _is_there(spark: SparkSession, path: str) -> bool:
    files, target = _on_its_file_system(spark, path)
    return bool(files.exists(target))


def _remove(spark: SparkSession, paths: Sequence[str]) -> int:
    """Remove folders through the file system of their own paths; how many were there."""
    removed = 0
    for path in paths:
        files, target = _on_its_file_system(spark, path)
        removed += bool(files.delete(target, True))
    return removed
