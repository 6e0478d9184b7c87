"""Lake layout, raw-file sources and table sinks.

A :class:`Lake` is one root directory holding ``bronze``, ``silver`` and
``gold`` layers; every table is ``<root>/<layer>/<table>``.  On a cluster
the root must be shared storage.  :func:`shared_root` derives it from the
session's ``spark.checkpoint.dir`` and only invents a local directory when
that setting is absent (local runs and tests).
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from transitlake.sources.published import Published

LAYERS = ("bronze", "silver", "gold")

# Table formats of silver and gold (bronze is always Parquet).
FORMATS = ("parquet", "orc")

# A third smaller than the formats' own default, for trips at ten times sf0.1.
TABLE_COMPRESSION = "zstd"

# Level of gzip text files: a quarter larger than by default, for a tenth of the CPU time.
TEXT_LEVEL = {"zlib.compress.level": "BEST_SPEED"}

# Partition column of tables whose clean and faulty rows are written at once.
VERDICT = "_verdict"
CLEAN = "clean"

# Bronze table of the GPS stream.  Its file sink keeps a log of its own that
# hides other writers' files, so batch loads go to another table ("gps").
STREAMED_GPS = "gps_stream"

# Hidden (underscore) sub-directory holding a partitioned table's schema.
SCHEMA_SIDECAR = "_schema"


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


# Keep single output files to a size that a reader task handles well.
DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Falls back to the directory registered with ``setCheckpointDir``.  When
    a local session has neither, a fresh temporary folder is created and
    registered as the checkpoint directory, as tests do.  A cluster session
    without either is refused: its executors would write to their own disks.
    """
    getters = (
        lambda: spark.conf.get("spark.checkpoint.dir", None),
        lambda: spark.sparkContext.getCheckpointDir(),
    )
    for get in getters:
        try:
            found = get()
        except Exception:  # Spark Connect has no SparkContext
            found = None
        if found:
            return found
    master = spark.conf.get("spark.master", "")
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="transitlake-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(local)
    except Exception:
        pass
    return local


def _condition(error: AnalysisException) -> str:
    """Name of Spark's error condition, without its sub-condition."""
    return (error.getCondition() or "").split(".")[0]


def shared_root(spark: SparkSession, name: str = "transitlake") -> str:
    """A fresh, unique directory under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name, uuid.uuid4().hex)


@dataclass(frozen=True)
class Lake:
    """Medallion lake rooted at ``root``; ``fmt`` is the table format.

    Any of ``FORMATS``; others (table formats with a transaction log of their
    own) are refused, as their overwrite options differ.
    """

    root: str
    fmt: str = "parquet"

    def __post_init__(self):
        if self.fmt not in FORMATS:
            raise ValueError(f"unknown table format {self.fmt!r}, use one of {', '.join(FORMATS)}")

    @classmethod
    def on_shared_storage(cls, spark: SparkSession, fmt: str = "parquet") -> "Lake":
        return cls(shared_root(spark), fmt)

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS and layer != "landing":
            raise ValueError(f"unknown layer {layer!r}")
        return os.path.join(self.root, layer, table)

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        """Whether the table has been written (asks Spark, not the local disk).

        Only a missing path means "no"; any other failure is raised, because a
        caller that took it for "no table" would overwrite the stored rows.
        """
        try:
            self.read(spark, layer, table).schema
            return True
        except AnalysisException as e:
            if _condition(e) == "PATH_NOT_FOUND":
                return False
            raise

    def published(self, layer: str, table: str) -> Published:
        """The table as versions and commits (see :mod:`transitlake.sources.published`)."""
        return Published(self.path(layer, table), "parquet" if layer == "bronze" else self.fmt)

    def read(self, spark: SparkSession, layer: str, table: str, schema=None) -> DataFrame:
        """Read a table: its newest commit if it is published, else its folder.

        Of a table written with verdicts only the clean rows, without the verdict.
        """
        rows = self._stored(spark, layer, table, schema)
        if VERDICT in rows.columns:
            rows = rows.filter(F.col(VERDICT) == CLEAN).drop(VERDICT, RESCUED)
        return rows

    def read_quarantine(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        """The faulty rows of a table written with verdicts, with the verdict."""
        rows = self._stored(spark, layer, table)
        if VERDICT not in rows.columns:
            return rows.withColumn(VERDICT, F.lit(None).cast("string")).limit(0)
        return rows.filter(F.col(VERDICT) != CLEAN)

    def _stored(self, spark: SparkSession, layer: str, table: str, schema=None) -> DataFrame:
        if layer in ("silver", "gold"):
            current = self.published(layer, table).read(spark)
            if current is not None:
                return current
        return self._folder(spark, layer, table, schema)

    def _folder(self, spark: SparkSession, layer: str, table: str, schema=None) -> DataFrame:
        """A table in its plain folder.

        An empty partitioned table has no data files to infer a schema from;
        it is then read with the schema stored next to it at write time (or
        with ``schema`` when given), so it reads as an empty table.
        """
        fmt = "parquet" if layer == "bronze" else self.fmt
        path = self.path(layer, table)
        if schema is not None:
            return spark.read.format(fmt).schema(schema).load(path)
        try:
            return spark.read.format(fmt).load(path)
        except AnalysisException as e:
            if _condition(e) != "UNABLE_TO_INFER_SCHEMA":
                raise
            stored = self._stored_schema(spark, path)
            if stored is None:
                raise
            return spark.read.format(fmt).schema(stored).load(path)

    def read_gps(self, spark: SparkSession) -> DataFrame:
        """Bronze GPS lines of the batch loads and of the stream, whichever are there."""
        parts = [t for t in ("gps", STREAMED_GPS) if self.exists(spark, "bronze", t)] or ["gps"]
        out = self.read(spark, "bronze", parts[0])
        for t in parts[1:]:
            out = out.unionByName(self.read(spark, "bronze", t))
        return out

    @staticmethod
    def _schema_path(path: str) -> str:
        return os.path.join(path, SCHEMA_SIDECAR)

    def _stored_schema(self, spark: SparkSession, path: str):
        try:
            row = spark.read.text(self._schema_path(path)).first()
        except AnalysisException as e:
            if _condition(e) != "PATH_NOT_FOUND":
                raise
            return None
        return None if row is None else StructType.fromJson(json.loads(row[0]))

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
        mode: str = "overwrite",
        rebalance: bool = True,
        max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
        replace: str = "partitions",
        observation=None,
        metrics: Sequence = (),
        path: str | None = None,
    ) -> str:
        """Write a table; returns its path (``path``: another folder than the table's own).

        Partitioned writes are rebalanced on the partition columns first
        (``REBALANCE`` hint): AQE then sizes the write tasks, splitting a
        hot partition value over several tasks and merging small ones, so
        each task writes a few large files instead of one file per
        partition value it happens to hold.  With ``replace="partitions"``
        an ``overwrite`` of a partitioned table replaces only the partitions
        present in ``df`` (dynamic partition overwrite), so re-running one
        day leaves the others; ``replace="table"`` replaces the whole table
        (a full rebuild).  Bronze is always Parquet.

        ``observation`` (a ``pyspark.sql.Observation``) with ``metrics``
        (aggregate Columns) is attached *after* the rebalance, so the metrics
        are computed in the write's own result stage: a map stage re-run
        after a lost executor cannot count rows twice.
        """
        if replace not in ("partitions", "table"):
            raise ValueError(f"replace must be 'partitions' or 'table', not {replace!r}")
        fmt = "parquet" if layer == "bronze" else self.fmt
        partition_by = list(partition_by)
        if partition_by and rebalance:
            df = df.hint("rebalance", *partition_by)
        if observation is not None:
            df = df.observe(observation, *metrics)
        written = None
        if partition_by:
            written = Observation(f"lake_write_{uuid.uuid4().hex[:12]}")
            df = df.observe(written, F.count(F.lit(1)).alias("rows"))
        writer = df.write.format(fmt).mode(mode).option("maxRecordsPerFile", max_records_per_file)
        writer = writer.option("compression", TABLE_COMPRESSION)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
            # for every format: without it an overwrite drops the untouched partitions
            writer = writer.option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
        out = path or self.path(layer, table)
        writer.save(out)
        if written is not None and int(written.get["rows"]) == 0:
            # A partitioned table written empty has no files to infer a schema
            # from; keep it in a hidden sidecar (ignored by table scans).
            sidecar = spark_of(df).createDataFrame([(df.schema.json(),)], "value string")
            sidecar.coalesce(1).write.mode("overwrite").text(self._schema_path(out))
        return out


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Line-oriented text scan: one ``value`` string per line (``path``: one or a list)."""
    return spark.read.text(path)


# Column with the whole text of a record that does not fit its header.
RESCUED = "_rescued"


def read_delimited(
    spark: SparkSession, path, sep: str = ",", header: bool = True, schema=None, rescue: bool = False
) -> DataFrame:
    """Header CSV with every column read as text (no inference pass).

    With ``rescue`` there is one more column, ``_rescued``: the text of a
    record that has fewer or more fields than the header or broken quotes, else
    NULL.  The header then comes from the first file (or ``schema``).
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if rescue:
        if schema is None:
            schema = StructType([StructField(c, StringType()) for c in reader.csv(path).columns])
        schema = StructType([*schema.fields, StructField(RESCUED, StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


# A gzip file is read by one task, so text files are kept to this many records.
MAX_RECORDS_PER_TEXT_FILE = 1_000_000


def _text_writer(df: DataFrame, mode: str, compression: str):
    writer = df.write.mode(mode).option("compression", compression).options(**TEXT_LEVEL)
    return writer.option("maxRecordsPerFile", MAX_RECORDS_PER_TEXT_FILE)


def write_lines(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> str:
    """Write a one-string-column DataFrame as text lines (``compression``: such as ``gzip``)."""
    _text_writer(df, mode, compression).text(path)
    return path


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", compression: str = "none") -> str:
    """Header CSV that keeps leading/trailing spaces of values (``compression``: such as ``gzip``)."""
    (
        _text_writer(df, mode, compression)
        .option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
