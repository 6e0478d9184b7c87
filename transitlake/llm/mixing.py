"""Mixing sources to target weights by pivotal dependent rounding.

Sources have weights; together they are to give as many words as the corpus
has, shared by weight, no source more than ``MOST`` times its own size (what a
source cannot give is shared out among the others by weight again).  A
document of a source with target t and size s is to be copied t / s times on
average: the whole part for certain, the rest as a probability.

The probabilities of a source become whole copies by the pivotal method.  Two
sides exchange mass in words: one gains what the other loses, in one of the
two directions, by as much as makes one of them integral, with odds that keep
every document's mean copies as they were.  The words taken stay the same in
each exchange, so a source misses its target only by its very last document.

A source is ranked by size and dealt out over blocks of ``BLOCK`` documents,
each with large and small ones.  Inside a block all documents have the same
probability; from large to small, each is paired with the pool of all smaller
ones, whose common probability moves as the document becomes 0 or 1.  Large
documents are thus settled while many small ones can make up for them, and what
stays open at the end is small.  A block leaves at most one open document; these
meet in blocks of ``BLOCK``, paired one with another, level by level (a reduction
tree), until one is left for the source, which is drawn by its probability.
Draws come from the source, level and block alone, so reruns agree whatever
the partitions are.

Targets are found by a water level: sources above their limit are set to it,
and the level is raised for the others until no further one is above.  Each
such round is one sum over the table of sources.

Defined cases: a null text has size 0, and a document of size 0 takes 0 words;
a null source is a source of its own, last in order; equal ids and repeated
rows are documents each; an empty table, or one without any word, has targets of
0 and takes nothing; further columns are ignored.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import in_order, settle_table, ship, table, whole_text

ship(__name__)

#: Times its size that a source, and so a document, may be taken.
MOST = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
BLOCK = 512


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, origin, size, tie, salt): ``origin`` orders sources by code point, null last."""
    return settle_table(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~")).alias("origin"),
            words(whole_text()).alias("size"),
            F.xxhash64(whole_text()).alias("tie"),
        ).withColumn("salt", F.monotonically_increasing_id())
    )


def weighted_sources(rows: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(origin, source_size, weight), the weights dealt out in the order of sources."""
    sums = settle_table(rows.groupBy("origin").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit("")))
    place = (F.col("rank") % len(weights) + 1).cast("int")
    return in_order(sums, "one", [F.col("origin")]).select(
        "origin", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place).alias("weight")
    )


def with_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` with ``target``: a share by weight, ``most`` times the size at most, of all words together."""
    limit = F.col("source_size") * most
    level, held = 0.0, -1
    while True:
        full = (limit <= F.col("weight") * level) if held >= 0 else F.lit(False)
        seen = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, limit)).alias("fixed"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count_if(full).alias("n"),
        ).first()
        if seen["n"] == held:
            break
        held = seen["n"]
        if not seen["open"]:
            break
        level = ((seen["all"] or 0) - (seen["fixed"] or 0)) / seen["open"]
    return sources.withColumn("target", F.least(limit.cast("double"), F.col("weight") * level))


def _pivot(sizes: list[int], odds: list[float], draw) -> int | None:
    """Make ``odds`` integral in place, largest documents first; the place of one that stays open."""
    open_at = None
    for j, size in enumerate(sizes):
        if not 0.0 < odds[j] < 1.0:
            continue
        if open_at is None:
            open_at = j
            continue
        i = open_at
        up_i, down_i, up_j, down_j = (1 - odds[i]) * sizes[i], odds[i] * sizes[i], (1 - odds[j]) * size, odds[j] * size
        rise, fall = min(up_i, down_j), min(down_i, up_j)
        if draw() * (rise + fall) < fall:
            moved, first_ends, ends = rise, up_i <= down_j, (1.0, 0.0)
        else:
            moved, first_ends, ends = -fall, down_i <= up_j, (0.0, 1.0)
        odds_i, odds_j = odds[i] + moved / sizes[i], odds[j] - moved / size
        if first_ends:
            odds[i], odds[j], open_at = ends[0], odds_j, j
        else:
            odds[i], odds[j] = odds_i, ends[1]
        if not 1e-12 < odds[open_at] < 1 - 1e-12:  # both ended
            odds[open_at] = float(round(odds[open_at]))
            open_at = None
    return open_at


def _pool(sizes: list[int], odds: list[float], draw) -> int | None:
    """As :func:`_pivot` for equal ``odds`` and falling ``sizes``: each against the pool of all that follow."""
    rest, p = sum(sizes), odds[0]
    for i, size in enumerate(sizes):
        odds[i] = p
        rest -= size
        if rest == 0:
            return i
        up, down, pool_up, pool_down = (1 - p) * size, p * size, (1 - p) * rest, p * rest
        rise, fall = min(up, pool_down), min(down, pool_up)
        if draw() * (rise + fall) < fall:
            if up > pool_down:  # the pool is used up
                odds[i] = p + pool_down / size
                odds[i + 1 :] = [0.0] * (len(odds) - i - 1)
                return i
            odds[i], p = 1.0, p - up / rest
        else:
            if down > pool_up:
                odds[i] = p - pool_up / size
                odds[i + 1 :] = [1.0] * (len(odds) - i - 1)
                return i
            odds[i], p = 0.0, p + down / rest
        if not 1e-12 < p < 1 - 1e-12:  # both ended
            odds[i + 1 :] = [float(round(p))] * (len(odds) - i - 1)
            return None
    return None


def _round(level: int, seed: int):
    """Function of one block: its odds made integral but for one (and that one too, if it is the source's last)."""

    def settle_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "rank"], ascending=[False, True])
        draw = random.Random(f"{seed}/{level}/{rows['block'].iloc[0]}/{rows['origin'].iloc[0]}").random
        odds = rows["odds"].tolist()
        left = (_pool if len(set(odds)) == 1 else _pivot)(rows["size"].tolist(), odds, draw)
        if left is not None and rows["blocks"].iloc[0] == 1:
            odds[left] = 1.0 if draw() < odds[left] else 0.0
        return rows.assign(odds=odds)

    return settle_block


def rounded(rows: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Rows (origin, rank, total, size, odds, ...) with ``odds`` made 0 or 1 source by source."""
    whole = (F.col("odds") == 0) | (F.col("odds") == 1)
    blocks = F.ceil(F.col("total") / block).cast("long")
    now = rows.withColumn("blocks", blocks).withColumn("block", F.col("rank") % F.col("blocks"))
    longest = rows.agg(F.max("total")).first()[0] or 0
    done, level = [], 0
    while True:
        out = settle_table(now.groupBy("origin", "block").applyInPandas(_round(level, seed), now.schema))
        done.append(out.filter(whole))
        longest = -(-longest // block)
        if longest <= 1:
            break
        now = out.filter(~whole).withColumn("blocks", F.ceil(F.col("blocks") / block).cast("long")).withColumn("block", F.col("block") % F.col("blocks"))
        level += 1
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def mix(docs: DataFrame, seed: int = 0, weights=WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) for each document."""
    rows = measured(docs)
    # small unless sources are very many; written, so that its measured size decides the join
    sources = settle_table(with_targets(weighted_sources(rows, weights), most))
    mean = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    planned = rows.join(sources, "origin").withColumn("mean", mean).withColumn("certain", F.floor("mean").cast("long"))
    planned = planned.withColumn("odds", F.col("mean") - F.col("certain"))
    drawn = (F.col("size") > 0) & (F.col("odds") > 0)
    # ids as text: pandas would turn a column of ids with a null into floats
    kept = ["origin", F.col("doc_id").cast("string").alias("doc_id"), "size", "source_size", "target", "certain", "odds"]
    ranked = in_order(
        planned.filter(drawn).select(*kept, "tie", "salt"),
        "origin",
        [F.col("size").desc(), F.col("doc_id").cast("long").asc_nulls_first(), F.col("tie"), F.col("salt")],
    ).drop("tie", "salt")
    names = ["doc_id", "size", "source_size", "target", "certain", "odds"]
    both = rounded(ranked, seed, block).select(*names).unionByName(planned.filter(~drawn).select(*kept[1:-1], F.lit(0.0).alias("odds")))
    copies = (F.col("certain") + F.col("odds").cast("long")).cast("long")
    return both.select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return mix(table(spark, sf_dir, "documents"))
