"""Packing by cutting stock with column generation.

Each document becomes its token ids plus the end id.  Full stretches of the
sequence length are sequences of their own; what is left of each document (1
to ``capacity - 1`` tokens) is an item to be packed.

* Items fall into size classes of ``GRAIN`` tokens, rounded up.  The histogram
  of classes has at most ``capacity / GRAIN`` entries, whatever the corpus
  size: that histogram is all that reaches the driver.
* A linear program over cutting patterns (how many items of each class one
  sequence takes) covers the histogram with the fewest sequences.  Columns are
  generated: the dual prices go into an unbounded knapsack, solved by dynamic
  programming, whose best pattern enters the basis until none has a reduced
  cost below zero.
* Pattern counts are rounded down; what remains of the histogram (fewer items
  than classes times their pattern counts) is packed by first-fit decreasing.
* Documents are ranked within their class by Spark (counts per partition, then
  a running sum), and rank r takes the r-th slot of its class in the plan.

No document is split but at full sequences.  Sequences are padded to the
capacity except where their length is a power of two.

Defined cases: a null or empty text is one piece, the end id alone; repeated
rows are packed each; an empty table gives an empty result; further columns
are ignored by :func:`pack`.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitlake.llm.common import settle, ship, small_batches, table, whole_text, worker_state

ship(__name__)

CAPACITY = 4096
GRAIN = 16
END_ID = 2
#: Words whose ids a Python worker remembers; beyond, it forgets them and starts anew.
REMEMBERED = 1_000_000

_BLANK = str.maketrans("\t\n\r", "   ")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_MARK = "\x01"
#: Signs that may end a word (no apostrophe: it begins tokens of its own).
_SIGNS = '.,;:!?*%$&#|)"'
_SIGN_SET = frozenset(_SIGNS)
#: Texts without these are lower-cased before their words are looked up, as the tokenizer does later.
_BEYOND_LATIN = re.compile("[\u0130\u0250-\U0010ffff]")


class WordEncoder:
    """Ids of a text under a tokenizer that drops white space, as packed 32-bit integers.

    Words between white space are encoded once and remembered: white space is a
    boundary of this tokenizer, so the words' ids put together are the text's
    ids.  New words are encoded many at a time, with a control character
    between them whose id no other text has.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.alone: dict[str, bool] = {}
        self.remembered = remembered
        (self.mark,) = self.tokenizer.encode(_MARK, add_special_tokens=False).ids

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _stands_alone(self, letter: str) -> bool:
        """Whether a sign after this letter is always cut from it: its normal form must end in a letter too.

        The normal form of some letters ends in a combining mark, which the
        signs after it join.
        """
        if letter not in self.alone:
            normal = self.tokenizer.normalizer.normalize_str(letter) if self.tokenizer.normalizer else letter
            self.alone[letter] = letter.isalpha() and normal[-1:].isalpha()
        return self.alone[letter]

    def learn(self, words: list[str]) -> None:
        # such a letter and the signs that end a word are always cut apart, so both are learned once
        known, wanted, cut = self.known, set(), []
        for w in words:
            if w[-1:] in _SIGN_SET:
                stem = w.rstrip(_SIGNS)
                if stem and self._stands_alone(stem[-1]):
                    tail = w[len(stem) :]
                    cut.append((w, stem, tail))
                    wanted.add(stem)
                    wanted.add(tail)
                    continue
            wanted.add(w)
        self._learn([w for w in wanted if w not in known])
        for w, stem, tail in cut:
            known[w] = known[stem] + known[tail]

    def _learn(self, words: list[str]) -> None:
        for start in range(0, len(words), 2000):
            part = words[start : start + 2000]
            text = f" {_MARK} ".join(part)
            if text.count(_MARK) >= len(part):  # a word holds the mark itself
                self.known.update((w, self._ids(w).tobytes()) for w in part)
                continue
            ids = self._ids(text)
            packed = ids.tobytes()
            cuts = [-1, *np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            self.known.update((w, packed[4 * a + 4 : 4 * b]) for w, a, b in zip(part, cuts[:-1], cuts[1:], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        # the separators \x1c to \x1f are no white space to the tokenizer
        split = [
            text.translate(_BLANK).split(" ") if _SEPARATORS.search(text) else (text if _BEYOND_LATIN.search(text) else text.lower()).split()
            for text in texts
        ]
        if len(self.known) > self.remembered:
            self.known.clear()
        new: set[str] = set()
        for words in split:
            new.update(words)
        self.learn([w for w in new if w not in self.known])
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def encoder_at(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    """The worker's encoder for this file."""
    state = worker_state("packing")
    if ("words", path, remembered) not in state:
        state["words", path, remembered] = WordEncoder(path, remembered)
    return state["words", path, remembered]


def batches_of(texts: list[str], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``most`` characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, remembered: int = REMEMBERED) -> DataFrame:
    """The pieces of each document: full sequences and one rest."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_at(tokenizer_path, remembered)
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for pdf in frames:
            texts = pdf["text"].tolist()
            for start, stop in batches_of(texts):
                rows = []
                ids_of = encoder.encode(texts[start:stop])
                keys = pdf["doc_id"].iloc[start:stop].tolist()
                for doc_id, ids in zip(keys, ids_of, strict=True):
                    ids += end
                    n = len(ids) // 4
                    rows += [
                        (doc_id, at, min(capacity, n - at), zlib.crc32(ids[4 * at : 4 * (at + capacity)]), n)
                        for at in range(0, n, capacity)
                    ]
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return slim.mapInPandas(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def knapsack(price: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The dearest multiset of items that fits (dynamic programming over capacities)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fit = np.flatnonzero(sizes <= c)
        best[c] = best[c - 1]
        if len(fit):
            value = best[c - sizes[fit]] + price[fit]
            k = int(value.argmax())
            if value[k] > best[c] + 1e-12:
                best[c], last[c] = value[k], fit[k]
    pattern = np.zeros(len(sizes), dtype=np.int64)
    c = capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[capacity]), pattern


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000) -> list[tuple[np.ndarray, float]]:
    """Patterns with their (fractional) counts: revised simplex with generated columns.

    Starts from one pattern for each class (as many of it as fit).  Ends when
    no pattern has a reduced cost below zero; any stop before that leaves a
    valid, only less dense plan.
    """
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(np.float64))
    inverse = np.diag(1.0 / basis.diagonal())
    level = inverse @ demand
    for turn in range(rounds):
        price = inverse.sum(axis=0)
        value, pattern = knapsack(np.maximum(price, 0.0), sizes, capacity)
        if value <= 1.0 + 1e-7:
            break
        move = inverse @ pattern
        falls = np.flatnonzero(move > 1e-10)
        if not len(falls):
            break
        ratio = level[falls] / move[falls]
        out = int(falls[ratio.argmin()])
        step = max(0.0, float(ratio.min()))
        basis[:, out] = pattern
        level = level - step * move
        level[out] = step
        pivot = inverse[out] / move[out]
        inverse = inverse - np.outer(move, pivot)
        inverse[out] = pivot
        if turn % 200 == 199:  # rounding errors do not pile up
            inverse = np.linalg.inv(basis)
            level = inverse @ demand
    return [(basis[:, j].astype(np.int64), float(level[j])) for j in range(k) if level[j] > 1e-9]


def first_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """First-fit decreasing of what rounding left over (few items per class)."""
    room: list[int] = []
    held: list[np.ndarray] = []
    for c in np.argsort(-sizes, kind="stable"):
        for _ in range(int(demand[c])):
            at = next((i for i, r in enumerate(room) if r >= sizes[c]), None)
            if at is None:
                room.append(capacity)
                held.append(np.zeros(len(sizes), dtype=np.int64))
                at = len(room) - 1
            room[at] -= int(sizes[c])
            held[at][c] += 1
    return held


def plan(histogram: dict[int, int], units: int) -> list[tuple[int, int, int, int, int]]:
    """Slots for every item: (class, first rank, last rank + 1, items per sequence, first sequence).

    Its length is bounded by the square of the number of classes, not by the corpus.
    """
    sizes = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[c] for c in sizes.tolist()], dtype=np.int64)
    if not len(sizes):
        return []
    left = demand.copy()
    uses: list[tuple[np.ndarray, int]] = []
    for pattern, level in sorted(cutting_stock(sizes, demand.astype(np.float64), units), key=lambda x: -x[1]):
        times = int(np.floor(level + 1e-9))
        took = pattern > 0
        if took.any():
            times = min(times, int((left[took] // pattern[took]).min()))
            if times > 0:
                uses.append((pattern, times))
                left -= times * pattern
    uses += zip(first_fit(sizes, left, units), repeat(1))
    slots, rank, sequence = [], dict.fromkeys(sizes.tolist(), 0), 0
    for pattern, times in uses:
        for c, each in zip(sizes.tolist(), pattern.tolist(), strict=True):
            if each:
                slots.append((c, rank[c], rank[c] + each * times, each, sequence))
                rank[c] += each * times
        sequence += times
    return slots


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, grain: int = GRAIN, remembered: int = REMEMBERED
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``remembered`` words stay in a worker's memory; fewer take less of it and more time, with equal results.
    """
    spark = docs.sparkSession
    cut = settle(
        pieces(docs, tokenizer_path, capacity, remembered).select(
            "*",
            F.ceil(F.col("length") / grain).cast("int").alias("size"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    units = capacity // grain
    # rank of a piece in its class: rows of the class in earlier partitions, and before it in its own
    by_part = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("size", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(by_part), F.lit(0)))
    within = Window.partitionBy("size", "part").orderBy("row")
    ranked = cut.withColumn("at", F.row_number().over(within) - 1).join(
        starts.select("size", "part", "before"), ["size", "part"]
    ).withColumn("rank", F.col("before") + F.col("at"))
    counts = {r["size"]: r["n"] for r in starts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    slots = plan({c: n for c, n in counts.items() if c < units}, units)
    packed = max((s[4] + -(-(s[2] - s[1]) // s[3]) for s in slots), default=0)
    if units in counts:  # a class that fills a sequence by itself
        slots.append((units, 0, counts[units], 1, packed))
    table_of = spark.createDataFrame(slots, "size int, first long, past long, each long, sequence long")
    placed = ranked.join(
        F.broadcast(table_of), (ranked["size"] == table_of["size"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past"))
    ).select(
        cut["doc_id"], "start", "length", "ids_crc32", "doc_tokens", "row",
        (F.col("sequence") + F.expr("(rank - first) div each")).alias("sequence_id"),
    )
    # at most capacity pieces share a sequence
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0).cast("long"))).drop("row")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document packed into sequences of 4096."""
    return pack(table(spark, sf_dir, "documents"), tokenizer())
