"""Byte-level BPE through a sentencepiece model made from the ranks.

The model is serialised here from the vocabulary alone: each byte sequence is
written with one printable character for each byte and becomes a piece whose
score is its negative rank, with the identity normaliser and no white space
handling.  sentencepiece then merges the adjacent pair of the best score, which
is the pair of the lowest rank.

A text is cut by the pattern into pre-tokens; each is encoded by itself, and what a
worker has encoded it remembers, up to a bound.  Decoding maps pieces back to
characters and characters back to bytes.

Defined cases: null and empty texts have no tokens; repeated rows are
encoded each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import ship, table, whole_text, worker_state

ship(__name__)

#: Pre-tokens a worker remembers; beyond, it forgets them and starts anew.
REMEMBERED = 500_000
#: The first of 256 characters that stand for the bytes (letters without case or normal forms).
FIRST = 0x4E00
_TO_CHARACTER = {i: chr(FIRST + i) for i in range(256)}


def mapped(data: bytes) -> str:
    """One character for each byte."""
    return data.decode("latin-1").translate(_TO_CHARACTER)


def unmapped(text: str) -> bytes:
    return bytes(ord(c) - FIRST for c in text)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int) -> bytes:
    """A protocol-buffer field: bytes (length-delimited) or an integer."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_of(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model: pieces in order of rank, then the unknown piece."""
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[b] for b in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must count from 0 without gaps")

    def piece(text: str, score: float, kind: int) -> bytes:
        number = np.float32(score).tobytes()
        return _field(1, _field(1, text.encode()) + _varint(2 << 3 | 5) + number + _field(3, kind))

    pieces = b"".join(piece(mapped(b), -float(i), 1) for i, b in enumerate(by_rank))
    unknown = piece("<unk>", -float(len(by_rank)), 2)
    # trainer: BPE (3 = 2), vocabulary size (4), no beginning, end or padding pieces
    minus = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank)) + b"".join(_field(k, minus) for k in (41, 42, 43))
    # normaliser: identity, nothing added, removed or escaped
    normaliser = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + unknown + _field(2, trainer) + _field(3, normaliser)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Coder:
    """Encodes and decodes texts with one model."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_of(ranks))
        self.find = regex.compile(pattern).findall
        self.bytes_of = [b""] * (len(ranks) + 1)
        for i in range(len(ranks)):
            self.bytes_of[i] = unmapped(self.processor.id_to_piece(i))
        self.known: dict[str, bytes] = {}

    def learn(self, tokens: list[str]) -> None:
        for start in range(0, len(tokens), 10_000):
            part = tokens[start : start + 10_000]
            ids = self.processor.encode([mapped(t.encode("utf-8", "surrogatepass")) for t in part], num_threads=1)
            self.known.update((t, np.asarray(i, dtype="<u4").tobytes()) for t, i in zip(part, ids, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        split = [self.find(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new: set[str] = set()
        for tokens in split:
            new.update(tokens)
        self.learn([t for t in new if t not in self.known])
        return [b"".join(map(self.known.__getitem__, tokens)) for tokens in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def coder_at(path: str, pattern: str) -> Coder:
    """The worker's coder for this vocabulary."""
    state = worker_state("bpe")
    if ("bpe", path, pattern) not in state:
        state["bpe", path, pattern] = Coder(path, pattern)
    return state["bpe", path, pattern]


def _ranges(texts: list[str], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (packed 32-bit integers) and decoded bytes of each row of ``docs``."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_at(path, pattern)
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for start, stop in _ranges(texts):
                ids = coder.encode(texts[start:stop])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(start, stop - start), pa.array(ids, pa.binary()), pa.array(map(coder.decode, ids), pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return slim.mapInArrow(coded, "doc_id long, ids binary, decoded binary")


def sha256_of(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query: token count and digests of every document."""
    import public_tokenizers

    rows = encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
