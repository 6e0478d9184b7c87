"""Language-model scores by context-tree weighting over bytes.

A text is its UTF-8 bytes with A-Z in lower case, followed by an end mark (0xFF,
which UTF-8 never holds).  Each byte is eight binary decisions; each decision
has a tree of contexts, the last 0 to ``DEPTH`` bytes.  A node s with counts
(n0, n1) of the training bytes has the Krichevsky-Trofimov probability
``Pe(s)`` and

    Pw(s) = Pe(s)                                  at the full depth,
    Pw(s) = 1/2 Pe(s) + 1/2 prod Pw(children)      above.

After training the weights are fixed.  The probability of a decision mixes the
estimates (n1 + 1/2) / (n0 + n1 + 1) of all nodes along its context, a node
being given the share ``1/2 Pe(s) / Pw(s)`` of what the nodes above it left;
the deepest node that training visited takes the rest.  These probabilities
add up to one over all texts, and their logarithm is the code length.

On Spark, documents are dealt into chunks of about ``CHUNK_BYTES``.  Each chunk
counts its own (context, byte) grams and words; the counts are added up by
gram and word over the whole corpus.  The lower levels of the trees
are computed in groups of contexts with the same last two bytes, the levels
above (at most 257 contexts of 255 decisions) on the driver.  Every chunk is
then sent the log probabilities of just the grams that it holds, and the
counts of just the words that other chunks also train on, and scores its documents with them.  Nothing that grows
with the corpus is broadcast or collected.

Defined cases: null and empty texts are the end mark alone; a null doc_id
counts as empty text for the fold; repeated rows are counted and scored each;
without training rows every decision has probability 1/2; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from transitlake.llm.common import crc_bucket, light_batches, settle, settle_table, ship, table, whole_text

ship(__name__)

#: Bytes of context (2 to 6: a code, context and byte, is one long).
DEPTH = 5
CHUNK_BYTES = 48_000_000
END = 0xFF
_PAD = bytes([END]) * DEPTH
_ROWS = 50_000
#: Documents are packed, and unpacked, in groups of about so many bytes.
PACK_BYTES, GROUP_BYTES = 24_000_000, 1_500_000
#: Counts are held apart up to so many rows, or as many as are added up already.
APART_ROWS = 500_000


def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(context, byte) codes of all bytes and end marks, text after text, and the number of each text."""
    joined = np.frombuffer(b"".join(_PAD + t + b"\xff" for t in texts), dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    n = len(joined) - DEPTH
    codes = np.zeros(n, dtype=np.int64)
    for k in range(DEPTH + 1):
        codes <<= 8
        codes |= joined[k : k + n]
    starts = np.cumsum(sizes + DEPTH) - (sizes + DEPTH)
    real = np.ones(n, dtype=bool)
    for k in range(DEPTH):  # the paddings of later texts are no symbols
        real[starts[1:] + k - DEPTH] = False
    return codes[real], sizes


def _totals(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    at = np.argsort(keys, kind="stable")  # quick on parts that are in order
    keys, n = keys[at], n[at]
    del at
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _encoded(docs: list[tuple[int | None, bool, bytes]]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The words of some documents, one after another, as numbers into their distinct words; how many
    each document has; and which of them are training words.  A word in Arrow takes a tenth of a Python object."""
    tokens, sizes = [], []
    for _, _, text in docs:
        split = text.split()
        tokens += split
        sizes.append(len(split))
    of = np.array(sizes, dtype=np.int32)
    train = np.repeat(np.array([not held_out for _, held_out, _ in docs], dtype=bool), of)
    return pa.array(tokens, pa.binary()).dictionary_encode(), of, train


def _numbers(words: pa.DictionaryArray) -> np.ndarray:
    return words.indices.to_numpy(zero_copy_only=False)


def _word_totals(parts: list[pa.Table]) -> pa.Table:
    total = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    total = total.select(["word", "n_sum"]).rename_columns(["word", "n"])
    parts.clear()
    pa.default_memory_pool().release_unused()
    return total


def _many_apart(sizes: list[int]) -> bool:
    """Whether the parts behind the first, which is the sum so far, are worth adding up."""
    return sum(sizes[1:]) > max(sizes[0], APART_ROWS)


class Counts:
    """Training counts of the grams and words of one chunk (0: only in held-out texts)."""

    def __init__(self):
        self.words, self.grams = [], []

    def add(self, docs: list[tuple[int | None, bool, bytes]]) -> None:
        tokens, _, train = _encoded(docs)
        n = np.bincount(_numbers(tokens)[train], minlength=len(tokens.dictionary))
        self.words.append(pa.table({"word": tokens.dictionary, "n": pa.array(n, pa.int64())}))
        if _many_apart([len(x) for x in self.words]):
            self.words = [_word_totals(self.words)]
        by: dict[bool, list[bytes]] = {}
        for _, held_out, text in docs:
            by.setdefault(held_out, []).append(text)
        for held_out, texts in by.items():
            codes, _ = codes_of(texts)
            keys, n = np.unique(codes, return_counts=True)
            self.grams.append((keys, np.zeros(len(n), dtype=np.int64) if held_out else n))
        if _many_apart([len(x) for x, _ in self.grams]):
            self.grams = [_totals(self.grams)]

    def batches(self, chunk: int) -> Iterator[pa.RecordBatch]:
        names = ["chunk", "word", "gram", "n"]
        for rows in _word_totals(self.words).to_batches(max_chunksize=_ROWS):
            w, n = rows.column("word"), rows.column("n")
            columns = [pa.array([chunk] * len(w), pa.int32()), w, pa.nulls(len(w), pa.int64()), n]
            yield pa.RecordBatch.from_arrays(columns, names)
        keys, n = _totals(self.grams)
        for i in range(0, len(keys), _ROWS):
            k = keys[i : i + _ROWS]
            columns = [pa.array([chunk] * len(k), pa.int32()), pa.nulls(len(k), pa.binary()), pa.array(k), pa.array(n[i : i + _ROWS])]
            yield pa.RecordBatch.from_arrays(columns, names)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams and words of each chunk with their training counts (0: only in held-out texts)."""
    held: dict[int, tuple[Counts, list, list]] = {}
    for batch in batches:
        for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            counts, docs, size = held.setdefault(chunk, (Counts(), [], [0]))
            for doc in unpacked(blob):
                docs.append(doc)
                size[0] += len(doc[2]) + 1
                if size[0] >= GROUP_BYTES:
                    counts.add(docs)
                    docs.clear()
                    size[0] = 0
    for chunk in list(held):
        counts, docs, _ = held.pop(chunk)
        if docs:
            counts.add(docs)
        yield from counts.batches(chunk)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by chunk, many at a time, compressed: they are shuffled twice."""
    press = zstandard.ZstdCompressor(level=3)
    by: dict[int, list] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for chunk in list(by):
            blob = press.compress(pickle.dumps(by.pop(chunk)))
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([blob], pa.binary())], ["chunk", "blob"])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for chunk, doc_id, held_out, text in zip(*(batch.column(c).to_pylist() for c in ("chunk", "doc_id", "held_out")), texts, strict=True):
            by.setdefault(chunk, []).append((doc_id, held_out, text.lower()))
            size += len(text) + 100
        if size >= PACK_BYTES:
            yield from out()
            size = 0
    yield from out()


def unpacked(blob: bytes) -> list[tuple[int | None, bool, bytes]]:
    return pickle.loads(zstandard.decompress(blob))


def _gathered(blobs: list[bytes]) -> Iterator[list[tuple[int | None, bool, bytes]]]:
    """The documents of all blobs, in groups: blobs are small where chunks are many, and large where they are few."""
    docs, size = [], 0
    for blob in blobs:
        for doc in unpacked(blob):
            docs.append(doc)
            size += len(doc[2]) + 1
            if size >= GROUP_BYTES:
                yield docs
                docs, size = [], 0
    if docs:
        yield docs


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 1/2 (Stirling's series above 8)."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log Pe of the Krichevsky-Trofimov estimator."""
    out = np.zeros_like(zeros)
    some = (zeros + ones) > 0
    a, b = zeros[some], ones[some]
    out[some] = log_gamma(a + 0.5) + log_gamma(b + 0.5) - math.log(math.pi) - log_gamma(a + b + 1)
    return out


def weighted(log_pe: np.ndarray, log_children: np.ndarray) -> np.ndarray:
    """log Pw of an inner node."""
    return np.logaddexp(log_pe, log_children) - math.log(2)


def paths(codes: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The eight decisions of each code: (node, its context's last ``depth`` bytes and its
    place in the byte's tree as one key), (bit)."""
    context = ((codes >> 8) & ((1 << (8 * depth)) - 1)) << 8
    symbol, place = codes & 255, np.ones(len(codes), dtype=np.int64)
    for k in range(7, -1, -1):
        bit = (symbol >> k) & 1
        yield context | place, bit
        place = 2 * place + bit


class Lower:
    """The nodes of all contexts of two bytes or more that end in the same two."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.keys, self.zeros, self.ones, self.log_pw, self.share = {}, {}, {}, {}, {}
        for depth in range(DEPTH, 1, -1):
            nodes, bits = zip(*paths(codes, depth), strict=True)
            keys, at = np.unique(np.concatenate(nodes), return_inverse=True)
            weight = np.tile(n.astype(np.float64), 8)
            ones = np.bincount(at, weights=weight * np.concatenate(bits), minlength=len(keys))
            zeros = np.bincount(at, weights=weight, minlength=len(keys)) - ones
            log_pe = log_estimate(zeros, ones)
            if depth == DEPTH:
                log_pw, share = log_pe, np.ones(len(keys))
            else:
                deeper = self.keys[depth + 1]
                parent = ((deeper >> 8) & ((1 << (8 * depth)) - 1)) << 8 | deeper & 255
                children = np.bincount(np.searchsorted(keys, parent), weights=self.log_pw[depth + 1], minlength=len(keys))
                log_pw = weighted(log_pe, children)
                share = np.exp(log_pe - math.log(2) - log_pw)
            for held, value in ((self.keys, keys), (self.zeros, zeros), (self.ones, ones), (self.log_pw, log_pw), (self.share, share)):
                held[depth] = value


def _lower(pdf: pd.DataFrame) -> pd.DataFrame:
    """The decisions of one two-byte context: counts, and log Pw."""
    own = Lower(pdf["gram"].to_numpy(), pdf["n"].to_numpy())
    return pd.DataFrame({
        "last": int(pdf["suffix"].iloc[0]) & 255, "node": (own.keys[2] & 255) - 1,
        "zeros": own.zeros[2], "ones": own.ones[2], "log_pw": own.log_pw[2],
    })


def mixture(zeros: np.ndarray, ones: np.ndarray, share: np.ndarray, left: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level down: (what is left, mixed so far, probability of a one if this is the deepest node)."""
    kt = (ones + 0.5) / (zeros + ones + 1)
    return left * (1 - share), mixed + left * share * kt, mixed + left * kt


class Upper:
    """The levels of no and one byte of context: what they leave and have mixed, for each last byte."""

    def __init__(self, rows: list):
        zeros, ones, children = (np.zeros((256, 255)) for _ in range(3))
        for last, node, a, b, c in rows:
            zeros[last, node], ones[last, node], children[last, node] = a, b, c
        one_pe = log_estimate(zeros, ones)
        one_pw = weighted(one_pe, children)
        seen = (zeros + ones) > 0
        root0, root1 = zeros.sum(axis=0), ones.sum(axis=0)
        root_pe = log_estimate(root0, root1)
        root_pw = weighted(root_pe, np.where(seen, one_pw, 0).sum(axis=0))
        half = math.log(2)
        left, mixed, deepest = mixture(root0, root1, np.exp(root_pe - half - root_pw), np.ones(255), np.zeros(255))
        rows_left, rows_mixed, rows_deepest = mixture(
            zeros, ones, np.exp(one_pe - half - one_pw), np.tile(left, (256, 1)), np.tile(mixed, (256, 1))
        )
        self.left, self.mixed = rows_left, rows_mixed
        # probability of a one where deeper contexts were never visited
        self.deepest = np.where(seen, rows_deepest, np.where(root0 + root1 > 0, deepest, 0.5))


def _answers(pdf: pd.DataFrame, upper: Upper) -> pd.DataFrame:
    """log10 probability of each gram of one two-byte context."""
    last = int(pdf["suffix"].iloc[0]) & 255
    codes, n = pdf["gram"].to_numpy(), pdf["n"].to_numpy()
    own = Lower(codes[n > 0], n[n > 0]) if (n > 0).any() else None
    total = np.zeros(len(codes))
    for ways in zip(*(paths(codes, depth) for depth in range(2, DEPTH + 1)), strict=True):
        place = (ways[0][0] & 255) - 1
        left, mixed, one = upper.left[last, place], upper.mixed[last, place], upper.deepest[last, place]
        for depth, (node, _) in enumerate(ways, 2):
            if own is None:
                break
            at = np.minimum(np.searchsorted(own.keys[depth], node), len(own.keys[depth]) - 1)
            seen = own.keys[depth][at] == node
            after = mixture(own.zeros[depth][at], own.ones[depth][at], own.share[depth][at], left, mixed)
            left, mixed, one = (np.where(seen, new, old) for new, old in zip(after, (left, mixed, one), strict=True))
        total += np.log10(np.where(ways[0][1] == 1, one, 1 - one))
    return pd.DataFrame({"gram": codes, "value": total})


class Table:
    """Values by code: open addressing with linear probing, looked up for many codes at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, dtype=np.int64), np.zeros(size)
        at, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            free = self.keys[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            chosen = rest[free][first]
            self.keys[slot], self.values[slot] = keys[chosen], values[chosen]
            waiting = self.keys[at] != keys[rest]
            at, rest = (at[waiting] + 1) & (size - 1), rest[waiting]

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        at = self._slot(codes)
        astray = np.flatnonzero(self.keys[at] != codes)
        while len(astray):
            at[astray] = (at[astray] + 1) & (len(self.keys) - 1)
            astray = astray[self.keys[at[astray]] != codes[astray]]
        return self.values[at]


def _scored(batches: Iterator[pa.RecordBatch], tokens: int, kinds: int, ends: int) -> Iterator[pa.RecordBatch]:
    """Rows of some chunks: each chunk's answers first, then its documents."""
    chunk, words, parts, blobs = None, [], [], []
    for batch in batches:
        label = batch.column("chunk").to_numpy()
        turns = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), len(label)]
        for start, stop in zip(turns, turns[1:], strict=False):
            part = batch.slice(start, stop - start)
            if not len(part):
                continue
            if part.column("chunk")[0].as_py() != chunk:
                yield from _chunk_scores(words, parts, blobs, tokens, kinds, ends)
                chunk, words, parts, blobs = part.column("chunk")[0].as_py(), [], [], []
            kind = part.column("kind").to_numpy()
            at = [np.flatnonzero(kind == k) for k in range(3)]
            if len(at[0]):
                got = part.take(pa.array(at[0]))
                words.append((got.column("word"), got.column("value").to_numpy()))
            if len(at[1]):
                got = part.take(pa.array(at[1]))
                parts.append((got.column("gram").to_numpy(), got.column("value").to_numpy()))
            if len(at[2]):
                blobs += part.take(pa.array(at[2])).column("word").to_pylist()
    yield from _chunk_scores(words, parts, blobs, tokens, kinds, ends)


def _chunk_scores(words: list, parts: list, blobs: list[bytes], tokens: int, kinds: int, ends: int) -> Iterator[pa.RecordBatch]:
    """Scores of one chunk.  ``words`` has log10(count + 1), over the corpus, of the words
    that other chunks also train on; the others' counts are those of the chunk."""
    if not blobs:
        return
    floor = math.log10(tokens + kinds + 1)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "n_bytes", "base_score", "score"]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    # the chunk's words are held once, as numbers into its distinct words
    encoded, of, trained = [], [], []
    for docs in _gathered(blobs):
        for kept, x in zip((encoded, of, trained), _encoded(docs), strict=True):
            kept.append(x)
    one = pa.chunked_array(encoded).unify_dictionaries()
    encoded.clear()
    pa.default_memory_pool().release_unused()
    distinct = one.chunk(0).dictionary
    numbers = [_numbers(x) for x in one.chunks]
    del one
    own = np.zeros(len(distinct), dtype=np.int64)
    for x, train in zip(numbers, trained, strict=True):
        own += np.bincount(x[train], minlength=len(own))
    trained.clear()
    value = np.log10(own + 1.0)
    if words:
        at = pc.index_in(pa.concat_arrays([w for w, _ in words]), value_set=distinct)
        value[at.to_numpy(zero_copy_only=False)] = np.concatenate([v for _, v in words])
        del at
    words.clear()
    del own, distinct
    pa.default_memory_pool().release_unused()
    end = math.log10(ends + 1)
    keys, values = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    table_of = Table(keys, values)
    del keys, values
    for docs, number, size in zip(_gathered(blobs), numbers, of, strict=True):
        codes, sizes = codes_of([text for _, _, text in docs])
        scores = np.add.reduceat(table_of[codes], np.cumsum(sizes) - sizes)
        known_of, stops = value[number], np.cumsum(size, dtype=np.int64).tolist()
        rows = []
        for (doc_id, held_out, text), score, start, stop in zip(docs, scores.tolist(), [0, *stops[:-1]], stops, strict=True):
            known = known_of[start:stop]
            n = len(known) + 1
            rows.append((doc_id, held_out, n, int(np.count_nonzero(known)) + (ends > 0), len(text), float(known.sum()) + end - n * floor, score))
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Scores of each row of ``docs``; rows whose crc32(doc_id) mod 7 is 2 are held out of training."""
    spark = docs.sparkSession
    light_batches(spark)
    text = whole_text()
    held_out = crc_bucket(F.col("doc_id"), 7) == 2
    whole = docs.agg(F.sum(F.octet_length(text)).alias("b"), F.count_if(~held_out).alias("ends")).first()
    ends = whole["ends"]
    chunks = max(spark.sparkContext.defaultParallelism, -(-(whole["b"] or 0) // chunk_bytes))
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        held_out.alias("held_out"),
        F.pmod(F.xxhash64("doc_id", text), F.lit(chunks)).cast("int").alias("chunk"),
    ).mapInArrow(_packed, "chunk int, blob binary")
    held = settle_table(
        dealt.repartitionById(chunks, F.col("chunk")).mapInArrow(_counted, "chunk int, word binary, gram long, n long")
    )
    # a word's rows are as many as the chunks that have it
    of_word = Window.partitionBy("word")
    first = F.row_number().over(of_word.orderBy("chunk")) == 1
    seen = Observation(f"words_{uuid.uuid4().hex}")
    words = held.filter("word is not null").select("chunk", "word", "n", F.sum("n").over(of_word).alias("c"), first.alias("first"))
    answered = settle_table(
        words.observe(
            seen, F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("first") & (F.col("c") > 0)).alias("v")
        )
        .filter("c <> n")
        .select("chunk", "word", "c")
    )
    tokens, kinds = seen.get["n"] + ends, seen.get["v"] + (ends > 0)
    word_answers = answered.select(
        "chunk", F.lit(0).alias("kind"), "word", F.lit(None).cast("long").alias("gram"), F.log10(F.col("c") + 1).alias("value")
    )
    grams = settle(
        held.filter("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
        .withColumn("suffix", F.shiftright(F.col("gram"), 8).bitwiseAND(0xFFFF))
    )
    lower = grams.filter("n > 0").groupBy("suffix").applyInPandas(_lower, "last long, node long, zeros double, ones double, log_pw double")
    # at most 256 x 255 rows
    upper = Upper(
        [
            tuple(r)
            for r in lower.groupBy("last", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("log_pw")).collect()
        ]
    )
    values = grams.groupBy("suffix").applyInPandas(lambda pdf: _answers(pdf, upper), "gram long, value double")
    gram_answers = held.filter("gram is not null").select("chunk", "gram").join(values, "gram").select(
        "chunk", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("word"), "gram", "value"
    )
    documents = dealt.select(
        "chunk", F.lit(2).alias("kind"), F.col("blob").alias("word"), F.lit(None).cast("long").alias("gram"), F.lit(None).cast("double").alias("value")
    )
    met = word_answers.union(gram_answers).union(documents).repartitionById(chunks, F.col("chunk")).sortWithinPartitions("chunk", "kind")
    return met.mapInArrow(
        lambda batches: _scored(batches, tokens, kinds, ends),
        "doc_id long, held_out boolean, n_tokens long, n_known long, n_bytes long, base_score double, score double",
    ).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score",
        # code length per byte, the end mark counted as one
        (-F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return scores(table(spark, sf_dir, "documents"))
