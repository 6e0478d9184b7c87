"""WARC fixity audit with Merkle trees.

Pages become WARC response records, laid end to end in files of ``PER_FILE``
consecutive page ids.  Each replica of a file has a tree of digests:

* leaf: SHA-256 over the record's offset, its length and its bytes' digest, in
  the order of offsets;
* node: SHA-256 over the digests of up to ``FANOUT`` children in order;
* the root covers the whole file.

The audit compares the roots of two replicas, then the children of mismatching nodes
only, level by level, down to records.  Below a matching node nothing is
compared; each level is joined with the mismatching parents, which scans the
level's digests (not the records) once.

Replicas with different numbers of records or shifted offsets mismatch from the
first affected record on; records that only one replica has are reported as
missing from the other.

Defined cases: a null url or html is an empty one; a null page id is in a file
of its own; repeated rows are records each (ordered by content); an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake.llm.common import settle, table

PER_FILE = 1024
FANOUT = 16
#: Levels above the records: FANOUT ** LEVELS holds a file.
LEVELS = 3


def record_bytes(url: Column, payload: Column) -> Column:
    """A WARC response record (a fixed date, so that equal pages give equal records)."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def manifest(pages: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """The records of each file: file_no, seq, page_id, start, stop, digest (of the record's bytes)."""
    record = record_bytes(F.col("url"), F.col("html"))
    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.floor(F.col("page_id") / per_file), F.lit(-(2**62))).cast("long").alias("file_no"),
        F.octet_length(record).cast("long").alias("size"),
        F.sha2(record, 256).alias("digest"),
    )
    # a file holds per_file consecutive ids: the window is bounded unless ids repeat
    order = Window.partitionBy("file_no").orderBy("page_id", "digest")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        slim.withColumn("stop", F.sum("size").over(upto))
        .withColumn("seq", (F.row_number().over(order) - 1).cast("long"))
        .select("file_no", "seq", "page_id", (F.col("stop") - F.col("size")).alias("start"), "stop", "digest")
    )


def leaves(records: DataFrame) -> DataFrame:
    """Level 0: file_no, at (position), node (digest)."""
    leaf = F.sha2(F.concat_ws(":", F.col("start").cast("string"), F.col("stop").cast("string"), F.col("digest")), 256)
    return records.select("file_no", F.col("seq").alias("at"), leaf.alias("node"))


def above(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level: each node digests up to ``fanout`` children in order."""
    children = F.array_sort(F.collect_list(F.struct("at", "node")))
    return (
        level.groupBy("file_no", F.floor(F.col("at") / fanout).alias("up"))
        .agg(children.alias("children"))
        .select("file_no", F.col("up").alias("at"), F.sha2(F.array_join("children.node", ""), 256).alias("node"))
    )


def tree(records: DataFrame, levels: int = LEVELS, fanout: int = FANOUT) -> list[DataFrame]:
    """All levels, records first.  With ``fanout ** levels`` records or fewer a
    file has one root; a longer file has several, which are all compared."""
    out = [leaves(records)]
    for _ in range(levels):
        out.append(settle(above(out[-1], fanout)))
    return out


def differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """(file_no, at) of nodes that differ or that one side lacks."""
    a, b = one.withColumnRenamed("node", "node_a"), two.withColumnRenamed("node", "node_b")
    return a.join(b, ["file_no", "at"], "full_outer").filter(~F.col("node_a").eqNullSafe(F.col("node_b"))).select("file_no", "at")


def audit(original: DataFrame, replica: DataFrame, levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """(file_no, seq) of the records whose leaves mismatch, found from the roots down."""
    ours, theirs = tree(original, levels, fanout), tree(replica, levels, fanout)
    bad = differing(ours[-1], theirs[-1])
    for a, b in zip(reversed(ours[:-1]), reversed(theirs[:-1]), strict=True):
        parent = settle(bad.withColumnRenamed("at", "up"))

        def under(level: DataFrame, parent=parent) -> DataFrame:
            return level.withColumn("up", F.floor(F.col("at") / fanout)).join(parent, ["file_no", "up"], "left_semi").drop("up")

        bad = differing(under(a), under(b))
    return bad.withColumnRenamed("at", "seq")


def report(pages: DataFrame, replica: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """One row for each record of either replica: place, digests, whether the audit located damage."""
    one = settle(manifest(pages, per_file))
    two = settle(manifest(replica, per_file))
    bad = audit(one, two).withColumn("damaged", F.lit(True))
    theirs = two.select("file_no", "seq", F.col("digest").alias("replica_digest"), F.col("page_id").alias("replica_page_id"))
    return (
        one.join(theirs, ["file_no", "seq"], "full_outer")
        .join(bad, ["file_no", "seq"], "left")
        .select(
            F.coalesce("page_id", "replica_page_id").alias("page_id"),
            "file_no",
            "seq",
            "start",
            "stop",
            "digest",
            "replica_digest",
            F.coalesce("damaged", F.lit(False)).alias("damaged"),
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Audit of all pages against a replica with flipped first letters.

    The replica is made from the table: pages whose id leaves 7 by 97 have
    the case of ``<!DOCTYPE`` changed, which keeps all lengths.
    """
    pages = table(spark, sf_dir, "pages")
    hurt = F.when(F.col("page_id") % 97 == 7, F.translate(F.col("html"), "DOCTYPE", "doctype")).otherwise(F.col("html"))
    return report(pages, pages.withColumn("html", hurt))


def _record(html: str) -> str:
    return (
        "'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Date: 2020-01-01T00:00:00Z'"
        " || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html'"
        f" || chr(13) || chr(10) || 'Content-Length: ' || strlen({html}) || chr(13) || chr(10) || chr(13) || chr(10) || {html}"
        " || chr(13) || chr(10) || chr(13) || chr(10)"
    )


ORACLE = f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html,
         CASE WHEN page_id % 97 = 7 THEN translate(coalesce(html, ''), 'DOCTYPE', 'doctype') ELSE coalesce(html, '') END AS other
  FROM pages),
r AS (SELECT page_id, page_id // {PER_FILE} AS file_no, {_record("html")} AS rec, {_record("other")} AS rep FROM p),
d AS (SELECT page_id, file_no, strlen(rec)::BIGINT AS size, sha256(rec) AS digest, sha256(rep) AS replica_digest FROM r)
SELECT page_id, file_no, row_number() OVER w - 1 AS seq,
       (sum(size) OVER w - size)::BIGINT AS start, (sum(size) OVER w)::BIGINT AS stop,
       digest, replica_digest, digest <> replica_digest AS damaged
FROM d WINDOW w AS (PARTITION BY file_no ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING)
"""
