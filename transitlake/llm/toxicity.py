"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

1. Lexicon.  Words, and word beginnings of 4 to 7 letters, are counted by
   label over the training sample (at most ``TRAIN_ROWS`` labelled rows) (documents that hold them); those that the
   log-likelihood ratio G2 ties to the toxic label form the lexicon.  It has
   at most ``LEXICON_SIZE`` entries, a parameter of the model.
2. Features, per text: lexicon densities, distance of lexicon words to a word
   of the second person, share of capitals, punctuation and exclamation marks,
   obfuscation (letters mixed with digits or signs), lengths and repetition.
   No label, language, source or id is a feature.
3. Spark ML's ``GBTClassifier`` learns on 4 of 5 training rows, its margin is
   calibrated by ``IsotonicRegression`` on the fifth (both dealt by a hash of
   the id).

Defined cases: null texts are empty and are scored like any text; rows without
a label only get scored; null labels are no labels; repeated rows get equal scores; if the
training rows hold one class or none, the score is their share of toxic rows
(0 without rows); an empty table gives an empty result; further columns are
ignored by :func:`score` and kept by :func:`reject_toxic`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from transitlake.llm.common import crc_bucket, settle, settle_table, ship, small_batches, table, whole_text, worker_state

ship(__name__)

#: The parameter that bounds the lexicon, and the least G2 of an entry.
LEXICON_SIZE = 2000
LEAST_G2 = 30.0
PREFIXES = (4, 5, 6, 7)
TREES, DEPTH = 20, 3
THRESHOLD = 0.3
#: Rows of the training sample at most (those of the least id hash): so many ids are broadcast.
TRAIN_ROWS = 50_000
FLUSH = 200_000

# Words of the second person in English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos usted ustedes tus ti contigo".split()
)

FEATURES = [
    "lex_density", "lex_hits", "lex_distinct", "lex_best", "lex_sum", "second_person", "proximity",
    "capitals", "punctuation", "exclamations", "obfuscation", "log_words", "word_length", "distinct_words",
]

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_][*@$#0-9!]+[^\W\d_]")
_SIGNS = re.compile(r"[.,;:!?\"'()*@$#%&|<>-]")


def beginnings(word: str) -> list[str]:
    """The word itself (marked) and its beginnings that are shorter."""
    return ["=" + word] + [word[:k] for k in PREFIXES if len(word) > k]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each lexicon candidate, by label, added up in the task first."""
    worker_state("toxicity")  # lets go of what the worker held for other work
    by = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        keys = list(by[0].keys() | by[1].keys())
        columns = [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in by)]
        by[0].clear()
        by[1].clear()
        return pa.RecordBatch.from_arrays(columns, ["entry", "clean", "toxic"])

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            by[int(label)].update({b for w in set(_WORD.findall(text.lower())) for b in beginnings(w)})
            if len(by[0]) + len(by[1]) > FLUSH:
                yield flush()
    yield flush()


def lexicon_of(train: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Lexicon entries with their log odds; ``size`` bounds what the driver gets."""
    totals = train.agg(
        F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")
    ).first()
    n1, n0 = int(totals["toxic"]), int(totals["n"]) - int(totals["toxic"])
    if not n1 or not n0:
        return {}
    counted = train.select("text", "label").mapInArrow(_counts, "entry string, clean long, toxic long")
    a, b = F.col("a"), F.col("b")
    n = F.lit(float(n0 + n1))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = (a + b) / n
    g2 = 2 * (
        part(a, share * n1) + part(b, share * n0) + part(n1 - a, (1 - share) * n1) + part(n0 - b, (1 - share) * n0)
    )
    odds = F.log((a + 0.5) / (n1 - a + 0.5)) - F.log((b + 0.5) / (n0 - b + 0.5))
    best = (
        counted.groupBy("entry").agg(F.sum("toxic").cast("double").alias("a"), F.sum("clean").cast("double").alias("b"))
        .filter(a / n1 > 2 * b / n0)
        .select("entry", g2.alias("g2"), odds.alias("odds"))
        .filter(F.col("g2") >= LEAST_G2)
        .orderBy(F.desc("g2"), "entry")
        .limit(size)
    )
    return {r["entry"]: round(r["odds"], 6) for r in best.collect()}


def features_of(text: str, weight) -> list[float]:
    """The dense features of one text; ``weight(word)`` is a word's lexicon weight or 0."""
    words = _WORD.findall(text)
    lower = [w.lower() for w in words]
    n = max(1, len(words))
    letters = max(1, sum(map(len, words)))
    weights = [weight(w) for w in lower]
    hits = [i for i, x in enumerate(weights) if x]
    persons = [i for i, w in enumerate(lower) if w in SECOND_PERSON]
    near = 0.0
    if hits and persons:
        at = np.searchsorted(persons, hits)
        gaps = [
            min(abs(persons[j] - h) for j in (min(k, len(persons) - 1), max(0, k - 1))) for h, k in zip(hits, at.tolist(), strict=True)
        ]
        near = 1.0 / (1.0 + min(gaps))
    characters = max(1, len(text))
    return [
        len(hits) / n,
        math.log1p(len(hits)),
        math.log1p(len({lower[i] for i in hits})),
        max(weights, default=0.0),
        sum(weights) / n,
        len(persons) / n,
        near,
        sum(map(str.isupper, text)) / letters,
        len(_SIGNS.findall(text)) / characters,
        text.count("!") / characters,
        len(_MIXED.findall(text)) / n,
        math.log1p(len(words)),
        letters / n,
        len(set(lower)) / n,
    ]


def dense_of(text: Column, lexicon: dict[str, float]) -> Column:
    """The features as an array column; only the text goes to Python."""

    @F.arrow_udf(ArrayType(DoubleType()))
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_state("toxicity")
        memo: dict[str, float] = {}

        def weight(word: str) -> float:
            got = memo.get(word)
            if got is None:
                got = memo[word] = max((lexicon.get(b, 0.0) for b in beginnings(word)), default=0.0)
            return got

        for batch in batches:
            rows = []
            for start in range(0, len(batch), 256):
                rows += [features_of(t, weight) for t in batch.slice(start, 256).to_pylist()]
                if len(memo) > FLUSH:
                    memo.clear()
            yield pa.array(rows, pa.list_(pa.float64()))

    return measured(text)


def featured(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``docs`` (columns but ``text``) with a column ``dense``, an array of the features."""
    return docs.select(*[c for c in docs.columns if c != "text"], dense_of(F.col("text"), lexicon).alias("dense"))


class Model:
    """Trees and calibration, or a constant where there is nothing to learn from."""

    def __init__(self, lexicon: dict[str, float], trees=None, calibration=None, constant: float = 0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def transform(self, featured_rows: DataFrame) -> DataFrame:
        """Adds ``score`` and drops ``dense``."""
        from pyspark.ml.functions import array_to_vector, vector_to_array

        if self.trees is None:
            return featured_rows.withColumn("score", F.lit(self.constant)).drop("dense")
        rows = self.trees.transform(featured_rows.withColumn("features", array_to_vector("dense")))
        rows = rows.withColumn("margin", vector_to_array("rawPrediction")[1])
        if self.calibration is None:
            return rows.withColumn("score", vector_to_array("probability")[1]).select(*_names(featured_rows), "score")
        rows = self.calibration.transform(rows)
        return rows.withColumn("score", F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0))).select(*_names(featured_rows), "score")


def _names(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c != "dense"]


def fit(train: DataFrame) -> Model:
    """Learns from rows (key, text, label)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    small_batches(train.sparkSession)
    train = settle_table(train.select("key", "text", "label"))
    lexicon = lexicon_of(train)
    rows = settle(
        featured(train.select("text", F.col("label").cast("double").alias("label"), F.pmod(F.xxhash64("key"), F.lit(5)).alias("fold")), lexicon)
    )
    seen = {(r["part"], r["label"]): r["n"] for r in rows.groupBy((F.col("fold") > 0).alias("part"), "label").agg(F.count("*").alias("n")).collect()}
    total = sum(seen.values())
    if not seen.get((True, 0.0)) or not seen.get((True, 1.0)):
        return Model(lexicon, constant=(sum(n for (_, y), n in seen.items() if y) / total) if total else 0.0)
    vectors = rows.withColumn("features", array_to_vector("dense"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, minInstancesPerNode=5, seed=7, cacheNodeIds=False).fit(
        vectors.filter("fold > 0").select("features", "label")
    )
    calibration = None
    if seen.get((False, 0.0)) and seen.get((False, 1.0)):
        margins = trees.transform(vectors.filter("fold = 0")).select(vector_to_array("rawPrediction")[1].alias("margin"), "label")
        calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="calibrated").fit(margins)
    return Model(lexicon, trees, calibration)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Labelled documents whose crc32(doc_id) mod 4 is not 2: a sample of at most ``most`` labelled ids.

    The bound makes the labels small enough to be broadcast, so no text is
    shuffled to meet its label.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(crc_bucket(F.col("doc_id"), 4) != 2)
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(known), "doc_id").select(
        F.col("doc_id").cast("string").alias("key"), "text", "label"
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row of ``docs``."""
    return model.transform(featured(docs.select("doc_id", whole_text().alias("text")), model.lexicon))


def reject_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns as they were."""
    names = list(docs.columns)
    # working names, whatever the columns are called
    renamed = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    text = F.coalesce(F.col(f"c{names.index('text')}"), F.lit(""))
    scored = model.transform(renamed.withColumn("dense", dense_of(text, model.lexicon)))
    return scored.filter(F.col("score") < threshold).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def model_for(spark, sf_dir: str) -> Model:
    """The model learned from the stored documents and labels."""
    return fit(training_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query: score of every document."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, model_for(spark, sf_dir)).select(
        "doc_id",
        (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
