"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The white space of the word contracts: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def ship(module: str) -> None:
    """Send the functions of this module to the executors by value, so that they need not have it installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def worker_state(owner: str) -> dict:
    """A dictionary that outlives a task, until the Python worker process works for another ``owner``.

    For tokenizers and what they remember; functions sent by value have no
    module of their own on the executors, so it hangs on a module made here.
    """
    module = sys.modules.setdefault("llm_worker_state", types.ModuleType("llm_worker_state"))
    if module.__dict__.get("owner") != owner:
        module.__dict__.update(owner=owner, kept={})
    return module.__dict__["kept"]


#: Rows of an Arrow batch for functions that take whole texts.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """From now on this session sends at most ``BATCH_ROWS`` rows to Python at a time.

    Batches of whole texts are held off the heap, and again in Python; Spark's
    own 10,000 rows of them take hundreds of megabytes.  A session that asks
    for fewer rows keeps its setting.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


#: Bytes of an Arrow batch for functions that take texts of any size beside small rows.
BATCH_BYTES = 4 << 20


def light_batches(spark: SparkSession) -> None:
    """From now on this session sends about ``BATCH_BYTES`` to Python at a time, however many rows that is.

    A session with a setting of its own keeps it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark alone (the path may be any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with a null text as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def crc_bucket(key: Column, buckets: int) -> Column:
    """crc32 of the key written as text, modulo ``buckets``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % buckets


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Local sessions without that setting get a temporary folder of their own; a
    cluster without it is refused, because a machine-local folder loses rows.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not (sc.master.startswith("local") and "cluster" not in sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="llm-checkpoints-"))
        folder = sc.getCheckpointDir()
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the stored rows.

    Cuts the lineage: a lost executor afterwards costs a reread, not a rerun.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_table(df: DataFrame) -> DataFrame:
    """As :func:`settle`, as compressed Parquet (for wide rows)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that ``df`` does not have (whatever its own are called)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def in_order(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``df`` written once, with ``rank`` (from 0, within ``key``) and ``total`` (rows of the key).

    Rows are dealt out by ranges of (key, order), so a key of any size is
    spread over tasks; rows equal in all of ``order`` should be alike, or a
    last term of ``order`` should tell them apart, else one task gets them all.
    A rank is the place inside the range plus the rows of the key in earlier
    ranges; ranges and keys meet in a table as long as both together.
    """
    part, at, first, n, before = fresh(df, "part", "at", "first", "n", "before")
    number = F.monotonically_increasing_id()
    by = [F.col(key), *order]
    placed = settle_table(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn(at, number)
        .withColumn(part, F.shiftright(F.col(at), 33))
    )
    heads = placed.groupBy(part, key).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(n))
    of_key = Window.partitionBy(key)
    heads = settle_table(
        heads.select(
            part,
            key,
            first,
            F.coalesce(F.sum(n).over(of_key.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before),
            F.sum(n).over(of_key).alias("total"),
        )
    )
    return placed.join(heads, [part, key]).withColumn("rank", F.col(at) - F.col(first) + F.col(before)).drop(part, at, first, before)
