"""Corpus pipeline: five training-data operators applied one after another.

Each stage takes the documents that its predecessor kept, as written Parquet.
The first four return the columns of ``documents``; the last returns the
packed pieces.  A stage drops a document only for its own reason:

1. ``toxicity``: documents that score 0.3 or more go;
2. ``quality``: documents that fail the base rules or are depleted by the line
   frequency rule go, and frequent lines are taken out of the others' text;
3. ``near_dedup``: one document of each near-duplicate class stays;
4. ``pii``: personal data is replaced by its kind;
5. ``packing``: what is left is packed into sequences of 4096 tokens.

Null, empty and repeated rows pass through as each operator defines; further
columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transitlake.llm.common import settle_table, table
from transitlake.llm.neardup import keep_one
from transitlake.llm.packing import pack, tokenizer
from transitlake.llm.pii import redact
from transitlake.llm.quality import clean
from transitlake.llm.toxicity import fit, reject_toxic, training_rows

#: Words a packing worker remembers: fewer than by default, as the stages before it leave less memory.
REMEMBERED = 200_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_toxic(docs, fit(training_rows(docs, table(spark, sf_dir, "labels"))))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer(), remembered=REMEMBERED)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

#: Learned scores and hashed signatures are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle_table(stage(spark, docs, sf_dir))
    return docs
