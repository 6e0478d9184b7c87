"""Personal data: fixed base patterns, and bootstrapped contextual extraction.

Everything is DataFrame functions; no Python runs on the executors.

Base kinds (email, ip, card, phone) are regular expressions with checks; their
matches are the seed entities.  The method then looks for identifiers that the
base patterns miss:

1. Every seed, and every candidate (text with a looser form of a kind, such
   as a telephone number without a plus sign), is an instance with lexical
   patterns: the word before it, the word after it, and the two together.
2. Pattern and instance form a graph.  A pattern scores the share of all
   occurrences of its words, over all different texts, that stand beside
   instances of its kind (each weighted by its score), and counts only with
   ``MIN_SUPPORT`` different confident instances.  An instance scores one
   if it is a seed, else the noisy-or of its patterns.
3. The scores are iterated ``ROUNDS`` times, so that found identifiers induce
   patterns of their own; candidates that reach ``CONFIDENCE`` are added as
   spans where they overlap no base span.

Patterns are matched as Java expressions with possessive loops, so that very
long texts neither overflow the stack nor take quadratic time.

Defined cases: a null or empty text has no spans; repeated rows get the same
spans each and count once in the graph; an empty table gives an empty
result; further columns are ignored by :func:`spans_of` and kept by
:func:`redact`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake.llm.common import SPACE_CLASS, fresh, settle, settle_table, table, whole_text

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "A-Za-z0-9._%+-"
#: Base patterns, written so that no loop backtracks; the matches are those of the contract's forms.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser forms in which candidates are looked for.
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++(?:\x20?[\[(]at[\])]\x20?|\x20at\x20|@)[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.:-])[0-9]{1,3}(?:[:,_-][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,5}\)?[\x20./-][0-9]{2,4}[\x20./-][0-9]{2,5}(?![0-9])",
}
#: Characters of context kept on either side of a match, to read one word from.
CONTEXT = 60
MIN_SUPPORT = 3
CONFIDENCE = 0.8
ROUNDS = 3


def luhn(digits: Column) -> Column:
    """The check sum of card numbers."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def holds(kind: Column, value: Column) -> Column:
    """Whether a base match passes its kind's check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == "phone", F.length(digits).between(10, 15))
        .otherwise(F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False)))
    )


def _matches(text: Column, kind: str, pattern: str, base: bool, wanted: Column) -> Column:
    """Matches of a pattern, in order, each with the length of the gap before it."""
    regex = F.lit(pattern)
    found = F.when(wanted, F.regexp_extract_all(text, regex, F.lit(0))).otherwise(F.array().cast("array<string>"))

    def placed(values: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        return F.get(
            F.transform(
                F.array(gaps),
                lambda g: F.transform(
                    values,
                    lambda v, i: F.struct(
                        F.lit(kind).alias("kind"),
                        F.lit(base).alias("base"),
                        i.alias("turn"),
                        F.length(F.get(g, i)).alias("gap"),
                        v.alias("value"),
                        F.right(F.get(g, i), F.lit(CONTEXT)).alias("left"),
                        F.left(F.get(g, i + 1), F.lit(CONTEXT)).alias("right"),
                    ),
                ),
            ),
            F.lit(0),
        )

    empty = F.array().cast("array<struct<kind:string,base:boolean,turn:int,gap:int,value:string,left:string,right:string>>")
    return F.get(F.transform(F.array(found), lambda v: F.when(F.size(v) > 0, placed(v)).otherwise(empty)), F.lit(0))


def occurrences(docs: DataFrame) -> DataFrame:
    """Every base match that passes, and every candidate, of each different text.

    Columns: text_md5, kind, base, start, stop (code points), value, left, right.
    """
    text = F.col("held_text")
    digits, pairs = text.rlike("[0-9]"), text.rlike(r"[0-9][\x20./:,_-]?[0-9]")
    named = text.contains("@")
    spelt = named | text.rlike(r"[\[(]at[\])]|\x20at\x20")
    dotted = text.rlike(r"[\[(]dot[\])]|\x20dot\x20") | named
    wanted = {
        ("email", True): named, ("ip", True): digits, ("card", True): pairs, ("phone", True): text.contains("+") & digits,
        ("email", False): spelt & dotted, ("ip", False): pairs, ("card", False): pairs, ("phone", False): pairs,
    }
    lists = [
        _matches(text, kind, pattern, base, wanted[kind, base])
        for base, patterns in ((True, BASE), (False, LOOSE))
        for kind, pattern in patterns.items()
    ]
    found = (
        docs.select(whole_text().alias("held_text"))
        .filter(digits | spelt)
        .select(F.md5("held_text").alias("text_md5"), F.explode(F.flatten(F.array(*lists))).alias("m"))
        .select("text_md5", "m.*")
        # copies of a text have the same matches
        .dropDuplicates(["text_md5", "kind", "base", "turn"])
    )
    so_far = Window.partitionBy("text_md5", "kind", "base").orderBy("turn")
    placed = found.withColumn("stop", F.sum(F.col("gap") + F.length("value")).over(so_far).cast("long")).withColumn(
        "start", F.col("stop") - F.length("value")
    )
    return placed.filter(~F.col("base") | holds(F.col("kind"), F.col("value"))).select(
        "text_md5", "kind", "base", "start", "stop", "value", "left", "right"
    )


def _folded(word: Column) -> Column:
    return F.translate(F.lower(word), "123456789", "000000000")


def _cues(left: Column, right: Column) -> Column:
    """The lexical patterns of an occurrence: word before, word after, both."""
    before = _folded(F.regexp_extract(left, r"(\S+)\s*$", 1))
    after = _folded(F.regexp_extract(right, r"^\s*(\S+)", 1))
    worth = r"\p{L}{2}"
    return F.filter(
        F.array(
            F.when(before.rlike(worth), F.struct(before.alias("before"), F.lit("").alias("after"))),
            F.when(after.rlike(worth), F.struct(F.lit("").alias("before"), after.alias("after"))),
            F.when(before.rlike(worth) & after.rlike(worth), F.struct(before.alias("before"), after.alias("after"))),
        ),
        lambda x: x.isNotNull(),
    )


def word_counts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """How often each of ``words`` (column word) occurs in all different texts."""
    # copies of a text are one text, dropped before the shuffle where they meet
    texts = docs.select(whole_text().alias("held_text")).groupBy(F.md5("held_text").alias("text_md5")).agg(F.first("held_text").alias("held_text"))
    every = texts.select(F.explode(F.split(_folded(F.col("held_text")), SPACE_CLASS + "+")).alias("word"))
    return every.groupBy("word").agg(F.count("*").alias("total")).join(words, "word", "left_semi")


def discovered(docs: DataFrame, found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Candidate occurrences that the pattern-instance graph is confident of."""
    base = found.filter("base").select("text_md5", F.col("start").alias("b_start"), F.col("stop").alias("b_stop"))
    loose = found.filter("not base")
    covered = (
        loose.join(base, "text_md5")
        .filter((F.col("start") < F.col("b_stop")) & (F.col("b_start") < F.col("stop")))
        .select("text_md5", "kind", "start")
        .distinct()
    )
    free = loose.join(covered, ["text_md5", "kind", "start"], "left_anti")
    all_found = found.filter("base").unionByName(free)
    edges = settle(
        all_found.select("kind", "value", F.col("base").alias("seed"), F.explode(_cues(F.col("left"), F.col("right"))).alias("cue"))
        .select("kind", "value", "seed", "cue.*")
        .groupBy("kind", "value", "before", "after")
        .agg(F.count("*").alias("times"), F.max("seed").alias("seed"))
    )
    # only patterns that a seed induced, or could still, can score; their words are counted over the corpus
    patterns = edges.groupBy("kind", "before", "after").agg(F.sum("times").alias("beside"), F.count("*").alias("values")).filter(
        F.col("values") >= MIN_SUPPORT
    )
    words = patterns.select(F.col("before").alias("word")).union(patterns.select("after")).filter("word <> ''").distinct()
    counts = settle(word_counts(docs, words))

    def total(side: str) -> DataFrame:
        return counts.select(F.col("word").alias(side), F.col("total").alias(f"{side}_total"))

    most = F.lit(2**62)
    known = settle(
        patterns.join(total("before"), "before", "left").join(total("after"), "after", "left").select(
            "kind", "before", "after",
            F.greatest(
                "beside",
                F.least(
                    F.when(F.col("before") != "", F.coalesce("before_total", F.lit(0))).otherwise(most),
                    F.when(F.col("after") != "", F.coalesce("after_total", F.lit(0))).otherwise(most),
                ),
            ).alias("total"),
        )
    )
    instances = edges.groupBy("kind", "value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for _ in range(rounds):
        scored = (
            edges.join(instances, ["kind", "value"])
            .groupBy("kind", "before", "after")
            .agg(F.sum(F.col("times") * F.col("score")).alias("mass"), F.sum((F.col("score") >= CONFIDENCE).cast("int")).alias("support"))
            .filter(F.col("support") >= MIN_SUPPORT)
            .join(known, ["kind", "before", "after"])
            .select("kind", "before", "after", (F.col("mass") / F.col("total")).alias("pattern_score"))
        )
        doubt = F.sum(F.log1p(-F.least(F.coalesce("pattern_score", F.lit(0.0)), F.lit(0.999999))))
        instances = settle(
            edges.join(scored, ["kind", "before", "after"], "left")
            .groupBy("kind", "value")
            .agg(F.max("seed").alias("seed"), doubt.alias("doubt"))
            .select("kind", "value", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp("doubt")).alias("score"))
        )
    sure = instances.filter(F.col("score") >= CONFIDENCE).select("kind", "value")
    return free.join(sure, ["kind", "value"], "left_semi")


def _order(kind: Column) -> Column:
    return reduce(lambda c, i: c.when(kind == KINDS[i], F.lit(i)), range(1, len(KINDS)), F.when(kind == KINDS[0], F.lit(0)))


def text_spans(docs: DataFrame) -> DataFrame:
    """Spans of each different text that has any: text_md5, base, spans (arrays of start, at, stop, kind)."""
    found = settle_table(occurrences(docs))
    more = discovered(docs, found)
    entry = F.struct("start", _order(F.col("kind")).alias("at"), "stop", "kind")
    lists = (
        found.filter("base").unionByName(more)
        .groupBy("text_md5")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("base"), entry))).alias("base"),
            F.array_sort(F.collect_list(F.when(~F.col("base"), entry))).alias("added"),
        )
    )

    def clear(x: Column, i: Column) -> Column:
        return ~F.exists("added", lambda y: (y.start < x.stop) & (x.start < y.stop) & (F.struct(y.start, y["at"]) < F.struct(x.start, x["at"])))

    apart = F.when(F.size("added") > 0, F.filter("added", clear)).otherwise(F.col("added"))
    return lists.select("text_md5", "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def _written(spans: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.stop.cast("string")))
    )


def spans_of(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, counts by kind, base_sha256, spans, n_added."""
    listed = text_spans(docs)
    rows = docs.select("doc_id", F.md5(whole_text()).alias("text_md5")).join(listed, "text_md5", "left")
    empty = F.array().cast("array<struct<start:bigint,at:int,stop:bigint,kind:string>>")
    base, spans = F.coalesce("base", empty), F.coalesce("spans", empty)

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(spans).alias("spans"),
        (F.size(spans) - F.size(base)).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; columns as they were."""
    md5, spans = fresh(docs, "md5_key", "found_spans")
    listed = text_spans(docs).select(F.col("text_md5").alias(md5), F.col("spans").alias(spans))
    joined = docs.withColumn(md5, F.md5(whole_text())).join(listed, md5, "left")
    text = F.col("text")
    start = F.struct(F.lit(0).cast("long").alias("done"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        fresh_span = x.start >= acc.done
        return F.struct(
            F.greatest(acc.done, x.stop).alias("done"),
            F.when(
                fresh_span,
                F.concat(
                    acc.out,
                    F.substr(text, (acc.done + 1).cast("int"), (x.start - acc.done).cast("int")),
                    F.lit("<"), F.upper(x.kind), F.lit(">"),
                ),
            )
            .otherwise(acc.out)
            .alias("out"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(acc.out, F.substr(text, (acc.done + 1).cast("int")))

    clean = F.when(F.col(spans).isNull(), text).otherwise(F.aggregate(F.col(spans), start, step, finish))
    return joined.select(*[clean.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query: personal data in every document."""
    return spans_of(table(spark, sf_dir, "documents"))
