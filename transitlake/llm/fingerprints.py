"""Document fingerprints by Order MinHash.

The k-mers of a text (``K`` code points; a shorter text is one k-mer) are
numbered by occurrence, so that each (k-mer, occurrence) is one element.  For
each of ``COPIES`` random permutations the ``TUPLE`` least elements are taken,
put back into the order they have in the text, and their k-mers hashed to one
32-bit value.  Two texts agree on a value only if the same elements are least
and stand in the same order: the share of equal values falls with the edit
distance, not only with the common content.  Equal texts have equal
fingerprints.

The contract query also fingerprints an edited text, which ends with the start
of the next document.  Documents are dealt by ranges of doc_id, each range
gets a copy of the first document of the next one, and every task reads its
range in order.  Texts are shuffled once.

Defined cases: a null text is empty, and an empty text is one empty k-mer;
among rows with equal ids the order is that of the texts, so repeated rows are
neighbours; null ids come first; the next document of a single row is itself; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import ship, table, whole_text

ship(__name__)

K = 8
COPIES = 64
TUPLE = 2
#: Elements times permutations that are looked at together.
BLOCK = 400_000

_U = np.uint64
_W = np.uint32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _seeds(copies: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        r = _mix((np.arange(1, copies + 1, dtype=_U)) * _U(0x9E3779B97F4A7C15))
    return (r >> _U(32)).astype(_W), (r.astype(_W) | _W(1))


def kmers(points: np.ndarray, k: int = K) -> np.ndarray:
    """64-bit hashes of the k-mers of a text given as code points."""
    n = max(1, len(points) - k + 1)
    h = np.full(n, _U(len(points) if len(points) < k else k))
    with np.errstate(over="ignore"):
        for i in range(min(k, len(points))):
            h = h * _U(0x9E3779B97F4A7C15) + points[i : i + n]
        return _mix(h)


def numbered(hashes: np.ndarray) -> np.ndarray:
    """Occurrence number of each k-mer: how many equal ones stand before it."""
    n = len(hashes)
    bits = _U(max(1, int(n).bit_length()))
    low = (_U(1) << bits) - _U(1)
    packed = np.sort((hashes & ~low) | np.arange(n, dtype=_U))
    group = packed & ~low
    first = np.empty(n, dtype=bool)
    first[0] = True
    first[1:] = group[1:] != group[:-1]
    out = np.zeros(n, dtype=np.int64)
    if not first.all():
        starts = np.flatnonzero(first)
        run = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        out[(packed & low).astype(np.int64)] = run
    return out


def order_minhash(text: str, copies: int = COPIES, size: int = TUPLE, k: int = K) -> np.ndarray:
    """The fingerprint: one 32-bit value for each permutation."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(_U)
    hashes = kmers(points, k)
    with np.errstate(over="ignore"):
        elements = _mix(hashes + numbered(hashes).astype(_U) * _U(0xD6E8FEB86659FD93))
    element = (elements >> _U(32)).astype(_W)
    add, times = _seeds(copies)
    n = len(element)
    size = min(size, n)
    rows = max(1, BLOCK // n)
    tuples = np.empty((copies, size), dtype=np.int64)
    with np.errstate(over="ignore"):
        for start in range(0, copies, rows):
            part = slice(start, start + rows)
            ranks = (element[None, :] ^ add[part, None]) * times[part, None]
            at = np.arange(len(ranks))
            for j in range(size):
                least = ranks.argmin(axis=1)
                tuples[part, j] = least
                ranks[at, least] = _W(0xFFFFFFFF)
        tuples.sort(axis=1)
        value = np.zeros(copies, dtype=_U)
        for j in range(size):
            value = _mix(value * _U(31) + hashes[tuples[:, j]])
    return value.astype(_W)


def written(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Share of equal values."""
    return float((one == two).mean())


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of some ranges, sorted by range, id and text; a range ends with a copy of the next one's first row."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None
    for batch in batches:
        rows = []
        for part, doc_id, text, borrowed in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text", "borrowed")), strict=True):
            print_of = order_minhash(text)
            if held is not None and held[0] == part:
                _, key, before, own = held
                changed = edited(before, text)
                other = order_minhash(changed)
                rows.append((
                    key, len(before), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                    written(own), written(other), likeness(own, other), likeness(own, print_of),
                ))
            held = None if borrowed else (part, doc_id, text, print_of)
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (part, doc_id, text, borrowed), sorted inside each range ``part``;
    each range ends with the row that follows it, marked as borrowed."""
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # bounds and firsts are numbers, as many as there are ranges
    wanted = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(slim.agg(F.percentile_approx("doc_id", F.lit(wanted), F.lit(20 * ranges)).alias("b")).first()["b"] or []))
    dealt = slim.withColumn("part", _bucket(bounds))
    firsts = dealt.groupBy("part").agg(F.min(F.coalesce(F.col("doc_id"), F.lit(-(2**63)))).alias("first_id")).orderBy("part").collect()
    if not firsts:
        return dealt.select("part", "doc_id", "text", F.lit(False).alias("borrowed"))
    following = [(firsts[i]["first_id"], firsts[i - 1]["part"]) for i in range(len(firsts))]
    lent_to = spark.createDataFrame(following, "first_id long, to_part int")
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    # of rows with the first id, the one with the least text is first
    lent = (
        dealt.withColumn("first_id", key)
        .join(F.broadcast(lent_to), "first_id")
        .groupBy("to_part", "doc_id")
        .agg(F.min("text").alias("text"))
        .select(F.col("to_part").alias("part"), "doc_id", "text", F.lit(True).alias("borrowed"))
    )
    both = dealt.select("part", "doc_id", "text", F.lit(False).alias("borrowed")).union(lent)
    return both.repartition("part").sortWithinPartitions("part", "borrowed", F.col("doc_id").asc_nulls_first(), "text")


def _bucket(bounds: list[int]) -> Column:
    """How many bounds are at most the id (null: none), by binary search."""
    if not bounds:
        return F.lit(0)
    edges, steps = F.lit(bounds).cast("array<bigint>"), len(bounds).bit_length()

    def step(at: Column, i: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1), i)
        return at + F.when(F.get(edges, at + width - 1) <= F.col("doc_id"), width).otherwise(0)

    return F.aggregate(F.sequence(F.lit(steps - 1), F.lit(0), F.lit(-1)), F.lit(0), step)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness."""
    return with_next(docs).mapInArrow(
        _measured,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return fingerprints(table(spark, sf_dir, "documents"))
