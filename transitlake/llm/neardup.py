"""Near-duplicate classes by ProbMinHash.

A text is the weighted set of its five-word shingles (weight: how often a
shingle occurs; a shorter text is one shingle of all its words).  The
likeness of two texts is the probability Jaccard similarity of these sets,

    J_P(x, y) = sum over d in both of 1 / sum over e of max(x_e/x_d, y_e/y_d),

which is the plain Jaccard similarity when no shingle repeats.

Steps:

1. Texts with equal words are one text (grouped by hash), so a group of exact
   copies costs one row from here on.
2. ProbMinHash signatures: each shingle is a Poisson process whose rate is its
   weight; every arrival falls on a register picked at random, and a register
   keeps the earliest arrival.  A shingle stops as soon as its next arrival is
   later than the latest register (early termination).
3. Banding: texts that agree on all registers of a band share a bucket.  Each
   text is linked to the least text of its bucket; the connected components of
   these links are families, which hold every candidate pair.
4. Verification inside families, exactly: all pairs of a family are compared
   by an inverted index over its shingles.  A large family is cut into blocks
   of bounded size and the blocks are compared two by two in separate tasks.
   Only a spanning forest of the links is sent on, so output stays linear.
5. The connected components of the verified links are the classes.

Nothing is capped or sampled, and nothing is collected to the driver but
row counts.

Defined cases: null and empty texts (no words) are copies of one another;
repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import SPACE_CLASS, SPACES, fresh, settle, settle_table, ship, small_batches, table, whole_text, worker_state

ship(__name__)

SHINGLE = 5
THRESHOLD = 0.8
#: 28 bands of 6 registers: a pair at 0.8 shares a bucket with probability 0.9998.
BANDS, ROWS = 28, 6
#: A block holds about so many texts and shingles at most.
BLOCK_TEXTS, BLOCK_SHINGLES = 2048, 4_000_000

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public domain splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """Signatures (n_docs x registers) of weighted sets given as flat triples.

    All sets go through their arrivals together: in round t the t-th arrival of
    every shingle that is still alive is drawn, from its hash alone.
    """
    times = np.full(n_docs * registers, np.inf)
    owner = np.zeros(n_docs * registers, dtype=_U)
    latest = np.full(n_docs, np.inf)
    clock = np.zeros(len(element))
    d, e, w = doc, element.astype(_U), weight.astype(np.float64)
    turn = 0
    with np.errstate(over="ignore"):
        while len(e):
            turn += 1
            r = _mix(e + _U(turn) * _U(0x9E3779B97F4A7C15))
            clock = clock - np.log(((r >> _U(11)).astype(np.float64) + 0.5) / 2.0**53) / w
            alive = clock < latest[d]
            d, e, w, clock, r = d[alive], e[alive], w[alive], clock[alive], r[alive]
            if not len(e):
                break
            cell = d * registers + (_mix(r ^ _U(0xD1B54A32D192ED03)) % _U(registers)).astype(np.int64)
            np.minimum.at(times, cell, clock)
            won = times[cell] == clock
            owner[cell[won]] = e[won]
            latest = times.reshape(n_docs, registers).max(axis=1)
            alive = clock < latest[d]
            d, e, w, clock = d[alive], e[alive], w[alive], clock[alive]
    return owner.reshape(n_docs, registers)


def _flat(lists: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter((len(x) for x in lists), dtype=np.int64, count=len(lists))
    values = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists]) if sizes.sum() else np.zeros(0, np.int64)
    return sizes, values


def _weighted(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, value) with their counts."""
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(first)
    return doc[at], values[at], np.diff(np.append(at, len(doc)))


def _shingled(hashes: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of texts given as the hashes of their words; a short text is one shingle."""
    sizes, values = _flat(hashes)
    v, text = values.view(_U), np.repeat(np.arange(len(sizes)), sizes)
    starts, short = np.cumsum(sizes) - sizes, np.flatnonzero(sizes < SHINGLE)
    with np.errstate(over="ignore"):
        held = np.zeros(max(0, len(v) - SHINGLE + 1), dtype=_U)
        for k in range(SHINGLE):
            held = _mix(held ^ (v[k : len(held) + k] + _U(k + 1)))
        inside = text[: len(held)] == text[SHINGLE - 1 :][: len(held)]
        alone = _mix(sizes[short].astype(_U) + _U(SHINGLE + 1))
        for k in range(SHINGLE - 1):
            has = sizes[short] > k
            alone[has] = _mix(alone[has] ^ v[starts[short[has]] + k])
    doc = np.concatenate([text[: len(held)][inside], short])
    return doc, np.concatenate([held[inside], alone]).view(np.int64)


def _elements(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of a frame with the texts' ``shingles``, or with their words' ``hashes``."""
    if "shingles" not in pdf:
        return _shingled(pdf["hashes"])
    sizes, values = _flat(pdf["shingles"])
    return np.repeat(np.arange(len(pdf)), sizes), values


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    worker_state("near duplicates")
    salt = np.arange(BANDS, dtype=_U) * _U(0xA24BAED4963EE407)
    for pdf in batches:
        for start in range(0, len(pdf), 256):
            part = pdf.iloc[start : start + 256]
            d, e, w = _weighted(*_shingled(part["hashes"]))
            sig = prob_minhash(d, e.astype(np.int64).view(_U), w, len(part), BANDS * ROWS)
            with np.errstate(over="ignore"):
                key = np.repeat(salt[None, :], len(part), axis=0)
                bands = sig.reshape(len(part), BANDS, ROWS)
                for k in range(ROWS):
                    key = _mix(key ^ bands[:, :, k])
            yield pd.DataFrame({"id": part["id"].tolist(), "node": part["node"].to_numpy(), "keys": list(key.view(np.int64))})


def words_of(text: Column) -> Column:
    body = F.trim(text, F.lit(SPACES))
    return F.when(body != "", F.split(body, SPACE_CLASS + "+")).otherwise(F.array().cast("array<string>"))


def node_of(words: Column) -> Column:
    """A text's id: 60 bits of the SHA-256 of its words."""
    return F.conv(F.substring(F.sha2(F.array_join(words, " "), 256), 1, 15), 16, 10).cast("long")


def hashes_of(words: Column) -> Column:
    """Hashes of the words, in order; five of them make a shingle (see :func:`_shingled`)."""
    return F.transform(words, lambda w: F.xxhash64(w))


def components(edges: DataFrame) -> DataFrame:
    """Least node of each connected component of edges (a, b): columns node, root.

    Every round a node takes the least root among its own and its
    neighbours', its old root takes it too, and roots are followed one step
    (pointer jumping), so the number of rounds grows with the logarithm of a
    component's width.
    """
    both = settle(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")))
    while True:
        seen = both.join(roots, both.b == roots.node).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        stepped = roots.join(seen, "node").select("node", "root", F.least("root", "near").alias("next"))
        hooked = stepped.groupBy(F.col("root").alias("node")).agg(F.min("next").alias("hook"))
        met = (
            stepped.join(hooked, "node", "left")
            .select("node", "root", F.least("next", F.coalesce("hook", "next")).alias("next"))
        )
        jump = met.select(F.col("node").alias("next"), F.col("next").alias("over"))
        done = settle(
            met.join(jump, "next").select("node", F.col("root").alias("old"), F.least("next", "over").alias("root"))
        )
        changed = done.filter("root <> old").limit(1).count()
        roots = done.select("node", "root")
        if not changed:
            return roots


def likeness(x: dict, y: dict) -> float:
    """Probability Jaccard similarity of two weighted sets."""
    both = x.keys() & y.keys()
    if not both:
        return 0.0
    if all(v == 1 for v in x.values()) and all(v == 1 for v in y.values()):
        return len(both) / (len(x) + len(y) - len(both))
    keys = list(x.keys() | y.keys())
    a = np.array([x.get(k, 0) for k in keys], dtype=np.float64)
    b = np.array([y.get(k, 0) for k in keys], dtype=np.float64)
    ratio = np.divide(b, a, out=np.full(len(a), np.inf), where=a > 0)
    order = np.argsort(ratio, kind="stable")
    a, b, ratio = a[order], b[order], ratio[order]
    # sum of max(a_e/a_d, b_e/b_d): b's part where b_e/a_e is above d's ratio, else a's part
    first = np.searchsorted(ratio, ratio, side="right")
    from_a, from_b = np.concatenate([[0], np.cumsum(a)]), np.concatenate([[0], np.cumsum(b)])
    own = (a > 0) & (b > 0)
    total = from_a[first[own]] / a[own] + (from_b[-1] - from_b[first[own]]) / b[own]
    return float((1.0 / total).sum())


def _compared(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """A spanning forest of the links between texts of one block, or across two.

    A scan compares one text with all others by the inverted index.  A pair
    needs no comparison once one of the two is scanned or a path of links joins
    them, so scans end when the unscanned texts are all joined (or, across
    blocks, of one block).  They alternate between the largest group of joined
    texts and the smallest: a group of near copies is joined by a few scans.
    """
    across = int(pdf["one"].iloc[0]) != int(pdf["two"].iloc[0])
    pdf = pdf.sort_values("node", kind="stable").reset_index(drop=True)
    n = len(pdf)
    block, node = pdf["block"].to_numpy(), pdf["node"].to_numpy()
    doc, element, weight = _weighted(*_elements(pdf))
    del pdf
    counts = np.bincount(doc, minlength=n)
    ends = np.concatenate([[0], np.cumsum(counts)])
    totals = np.bincount(doc, weights=weight, minlength=n)
    plain = totals == counts
    weight = weight.astype(np.int32)
    element = np.unique(element, return_inverse=True)[1].astype(np.int32)
    order = np.argsort(element, kind="stable")
    posting_doc, posting_part = doc[order], (weight / totals[doc])[order]
    posting_end = np.concatenate([[0], np.cumsum(np.bincount(element))])
    del doc, order
    label = np.arange(n)
    unscanned = np.ones(n, dtype=bool)

    def weights(i: int) -> dict:
        own = slice(ends[i], ends[i + 1])
        return dict(zip(element[own].tolist(), weight[own].tolist(), strict=True))

    def scan(i: int) -> tuple[np.ndarray, np.ndarray]:
        """Unscanned texts of other groups that may be alike, and whether their plain Jaccard similarity says so."""
        own = slice(ends[i], ends[i + 1])
        runs = [slice(posting_end[e], posting_end[e + 1]) for e in element[own]]
        mates = np.concatenate([posting_doc[r] for r in runs])
        share = weight[own] / totals[i]
        least = np.concatenate([np.minimum(posting_part[r], p) for r, p in zip(runs, share, strict=True)])
        # J_P is at most the sum, over shared shingles, of the lesser share
        bound = np.bincount(mates, weights=least, minlength=n)
        fit = unscanned & (label != label[i]) & (bound >= threshold - 1e-9)
        if across:
            fit &= block != block[i]
        likely = np.flatnonzero(fit)
        shared = np.bincount(mates, minlength=n)[likely]
        return likely, shared / (counts[i] + counts[likely] - shared) >= threshold - 1e-12

    edges = []
    for turn in range(n):
        left = np.flatnonzero(unscanned)
        groups = np.bincount(label[left], minlength=n)
        if groups.max() == len(left) or (across and (block[left] == block[left[0]]).all()):
            break
        size = groups[label[left]]
        i = int(left[size.argmin() if turn % 2 else size.argmax()])
        unscanned[i] = False
        for j, same in zip(*(x.tolist() for x in scan(i)), strict=True):
            if label[i] == label[j]:
                continue
            if not (plain[i] and plain[j]):
                same = likeness(weights(i), weights(j)) >= threshold - 1e-12
            if same:
                label[label == label[j]] = label[i]
                edges.append((node[i], node[j]))
    return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")


def _ids_and_classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of each row, and (node, class_node) of the different texts that have near duplicates."""
    small_batches(docs.sparkSession)
    (held,) = fresh(docs, "held_words")
    # ids as text: pandas would turn a column of ids with a null into floats
    id_type = docs.schema["doc_id"].dataType if "doc_id" in docs.columns else "long"
    doc_id = (F.col("doc_id") if "doc_id" in docs.columns else F.lit(None)).cast("string").alias("id")
    texts = docs.select(doc_id, words_of(whole_text()).alias(held)).select("id", node_of(F.col(held)).alias("node"), held)
    signed = settle_table(
        texts.select("id", "node", hashes_of(F.col(held)).alias("hashes")).mapInPandas(_signed, "id string, node long, keys array<long>")
    )
    keyed = signed.select("node", "keys").dropDuplicates(["node"]).select("node", F.posexplode("keys").alias("band", "key"))
    least = keyed.groupBy("band", "key").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1")
    links = keyed.join(least, ["band", "key"]).filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    families = components(links)

    # hashes are half of what the words are to shuffle
    member = settle_table(
        texts.select("node", hashes_of(F.col(held)).alias("hashes")).join(families, "node").dropDuplicates(["node"]).select("node", "root", "hashes")
    )
    blocks = (
        member.groupBy("root")
        .agg(F.count("*").alias("n"), F.sum(F.size("hashes")).alias("m"))
        .select("root", F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("m") / BLOCK_SHINGLES), F.lit(1)).alias("n_blocks"))
    )
    cut = member.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("node"), "n_blocks"))
    meet = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))).select(
        "root", "node", "hashes", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")
    )
    found = meet.groupBy("root", "one", "two").applyInPandas(lambda pdf: _compared(pdf, threshold), "a long, b long")
    classes = components(found).withColumnRenamed("root", "class_node")
    return signed.select(F.col("id").cast(id_type).alias("doc_id"), "node"), classes


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The different texts that have near duplicates, with their class: node, class_node.

    A text that is in no row is a class of its own.
    """
    return _ids_and_classes(docs, threshold)[1]


def classed(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, node, class_node) of each row of ``docs``."""
    rows, classes = _ids_and_classes(docs, threshold)
    return settle(rows.join(classes, "node", "left").select("doc_id", "node", F.coalesce("class_node", "node").alias("class_node")))


def duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: doc_id, class_id (least doc_id of the class), class_size (rows)."""
    rows = classed(docs, threshold)
    heads = rows.groupBy("class_node").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(heads, "class_node").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with one document left of each class: that of the least
    doc_id (null last), of repeated rows with that id just one."""
    node, kept_node, kept_id = fresh(docs, "node_key", "kept_node", "kept_id")
    heads = classed(docs, threshold).groupBy("class_node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "node")).alias("head")
    )
    chosen = heads.select(F.col("head.doc_id").alias(kept_id), F.col("head.node").alias(kept_node))
    keyed = docs.withColumn(node, node_of(words_of(whole_text())))
    kept = keyed.join(chosen, (F.col(node) == F.col(kept_node)) & F.col("doc_id").eqNullSafe(F.col(kept_id)), "left_semi")
    return kept.dropDuplicates(["doc_id", node]).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """Class of every document at 0.8 over five-word shingles."""
    return duplicate_classes(table(spark, sf_dir, "documents"))
