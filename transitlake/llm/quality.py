"""Quality rules: per-document rules and cross-document line frequency.

Everything is DataFrame functions; no Python runs on the executors.

Base figures of a text (null counts as empty): words are runs of other
characters than space and \\t to \\r.  ``n_repeat_words`` counts the words that
lie in a five-word window found at least twice in the text.

Line frequency: lines are normalised (lower case, digits to 0, white space
squeezed), hashed, and for each host (``source``; null is a host of its own)
the distinct documents with that line are counted.  Equal texts are one
document, so a large group of copies does not turn its own text into
boilerplate; texts that differ anywhere are different documents, however many
lines they share.  A line in more than ``share`` of the host's distinct
texts, and more than ``min_docs`` documents, is frequent; a document that
without its frequent lines has fewer than ``min_words`` words, or less than
``min_left`` of its words, is depleted and rejected.

Defined cases: an empty or null text has 0 words and fails the base rule; a
null host is a host; repeated rows get the same verdict each and count once;
an empty table gives an empty result; further columns are ignored by
:func:`line_report` and kept by :func:`reject_poor` and :func:`clean`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import SPACE_CLASS, SPACES, fresh, settle_table, whole_text

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SHARE = 0.05
MIN_DOCS = 20
MIN_LEFT = 0.2
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """Words of a text, in order."""
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeat_words(words: Column) -> Column:
    """Words covered by five-word windows that occur at least twice.

    Each window becomes one long: the high bits of its hash and, below, its
    position (as many bits as the word count needs).  Sorting these longs
    puts equal windows side by side, in order of position.
    """
    n = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )
    bits = F.length(F.bin(n))

    def covered(h: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        packed = F.array_sort(
            F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))
        )

        def same(x: Column, y: Column) -> Column:
            return F.coalesce(x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(low)) == 0, F.lit(False))

        def positions(p: Column) -> Column:
            again = F.filter(p, lambda x, i: same(x, F.get(p, i + 1)) | ((i > 0) & same(x, F.get(p, i - 1))))
            return F.array_sort(F.transform(again, lambda x: x.bitwiseAND(low)))

        def total(at: Column) -> Column:
            # each window covers what lies before the next one begins, at most five words
            return F.aggregate(
                F.transform(at, lambda x, i: F.least(F.lit(WINDOW).cast("long"), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW).cast("long")))),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            )

        return _let(_let(packed, positions), total)

    def if_repeated(h: Column) -> Column:
        # most texts repeat no window: a hash set tells, and the sort is left out
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long"))

    return F.when(n > WINDOW, _let(hashes, if_repeated)).otherwise(F.lit(0).cast("long"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def figures(text: Column) -> list[Column]:
    """The base figures of a text as one list of named columns."""
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, SPACES) != "")
    return [
        _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"))).alias("of_words"),
        F.length(without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    ]


def normalised(line: Column) -> Column:
    digits = F.translate(F.lower(line), "123456789", "000000000")
    return F.trim(F.regexp_replace(digits, SPACE_CLASS + "+", " "))


def line_hash(line: Column) -> Column:
    """Hash of a normalised line."""
    return F.substring(F.md5(line), 1, 16)


def line_entries(text: Column) -> Column:
    """One struct for each line with a word: hash of the normalised line and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, SPACES) != "")
    return F.transform(
        lines,
        lambda x: _let(
            normalised(x),
            lambda y: F.struct(
                line_hash(y).alias("line"),
                # words of a squeezed line: its blanks plus one
                (F.length(y) - F.length(F.translate(y, " ", "")) + 1).cast("long").alias("words"),
            ),
        ),
    )


def _verdicts(docs: DataFrame, share: float = SHARE, min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS, min_left: float = MIN_LEFT) -> DataFrame:
    """As :func:`line_report`, with ``frequent_lines``: the hashes of the text's frequent lines (null for none)."""
    text = whole_text()
    narrow = settle_table(
        docs.select(
            F.col("doc_id"),
            host_of(docs).alias("host"),
            F.md5(text).alias("text_md5"),
            *figures(text),
            line_entries(text).alias("lines"),
        ).select("doc_id", "host", "text_md5", "of_words.*", "word_chars", "n_symbols", "n_dup_lines", "lines")
    )
    # one row for each line of each different text, its copies added up before the shuffle
    entries = (
        narrow.select("host", "text_md5", F.explode("lines").alias("entry"))
        .groupBy("host", F.col("entry.line").alias("line"), "text_md5")
        .agg(F.sum("entry.words").alias("words"))
    )
    hosts = narrow.select("host", "text_md5").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    counted = entries.groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    frequent = (
        counted.filter(F.col("n_docs") > min_docs)
        .join(hosts, "host")
        .filter(F.col("n_docs") > share * F.col("host_docs"))
        .select("host", "line")
    )
    # copies of a text hold the same lines: average over rows of a text, not their sum
    removed = (
        entries.join(frequent, ["host", "line"])
        .groupBy("host", "text_md5")
        .agg(F.sum("words").alias("all_words"), F.collect_list("line").alias("frequent_lines"))
    )
    rows = narrow.drop("lines")
    times = narrow.groupBy("host", "text_md5").agg(F.count("*").alias("times"))
    removed = removed.join(times, ["host", "text_md5"]).select(
        "host", "text_md5", F.expr("all_words div times").alias("n_removed_words"), "frequent_lines"
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (left < min_words) | (left < min_left * F.col("n_words"))
    return (
        rows.join(removed, ["host", "text_md5"], "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
    )


def line_report(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs``: base figures, words removed, verdict.

    Columns: doc_id, host, text_md5, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_removed_words, base_failed, kept.
    """
    return _verdicts(docs, **options).drop("frequent_lines")


def host_of(docs: DataFrame) -> Column:
    """The host a document counts under; a null or missing source is one host of its own."""
    if "source" not in docs.columns:
        return F.lit("")
    return F.coalesce(F.concat(F.lit("h:"), F.col("source").cast("string")), F.lit(""))


def reject_poor(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they were."""
    host, md5 = fresh(docs, "host_key", "md5_key")
    poor = (
        line_report(docs, **options)
        .filter(~F.col("kept"))
        .select(F.col("host").alias(host), F.col("text_md5").alias(md5))
        .distinct()
    )
    keyed = docs.withColumn(host, host_of(docs)).withColumn(md5, F.md5(whole_text()))
    return keyed.join(poor, [host, md5], "left_anti").select(*docs.columns)


def clean(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, their frequent lines taken out of ``text``.

    The other lines keep their order and form, blank ones too; the other
    columns stay as they were (``n_chars`` tells the length before).
    """
    host, md5, kept, frequent = fresh(docs, "host_key", "md5_key", "is_kept", "frequent_lines")
    marks = (
        _verdicts(docs, **options)
        .filter(~F.col("kept") | F.col("frequent_lines").isNotNull())
        # rows of one text have one verdict
        .groupBy(F.col("host").alias(host), F.col("text_md5").alias(md5))
        .agg(F.first("kept").alias(kept), F.first("frequent_lines").alias(frequent))
    )
    keyed = docs.withColumn(host, host_of(docs)).withColumn(md5, F.md5(whole_text()))
    passed = keyed.join(marks, [host, md5], "left").filter(F.coalesce(kept, F.lit(True)))

    def stays(x: Column) -> Column:
        return (without(x, SPACES) == "") | ~F.array_contains(frequent, line_hash(normalised(x)))

    text = F.when(F.col(frequent).isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(F.split("text", "\n"), stays), "\n")
    )
    return passed.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query: figures and verdict of every document."""
    from transitlake.llm.common import table

    return line_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words"
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce('h:' || source, '') AS host, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (
  SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (
  SELECT r, i, array_to_string(ws[i : i + 4], chr(1)) AS k
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 5)),
rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM rep) GROUP BY r),
raw_lines AS (
  SELECT r, host, md5(text) AS t, unnest(string_split(text, chr(10))) AS l FROM d),
lines AS (
  SELECT r, host, t, l, trim(regexp_replace(translate(lower(l), '123456789', '000000000'), '[\x20\x09-\x0D]+', ' ', 'g')) AS nl
  FROM raw_lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, (count(*) - count(DISTINCT l))::BIGINT AS n_dup_lines FROM lines GROUP BY r),
ent AS (
  SELECT r, host, t, substr(md5(nl), 1, 16) AS line, (len(nl) - len(replace(nl, ' ', '')) + 1) AS words FROM lines),
hosts AS (SELECT host, count(DISTINCT md5(text)) AS host_docs FROM d GROUP BY host),
freq AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT t) AS n FROM ent GROUP BY host, line) JOIN hosts USING (host)
  WHERE n > 20 AND n > 0.05 * host_docs),
rem AS (SELECT r, sum(words)::BIGINT AS n_removed_words FROM ent JOIN freq USING (host, line) GROUP BY r),
f AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_removed_words, 0) AS n_removed_words
  FROM d JOIN w USING (r) LEFT JOIN cov USING (r) LEFT JOIN dup USING (r) LEFT JOIN rem USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - n_removed_words >= 10 AND n_words - n_removed_words >= 0.2 * n_words AS kept,
       n_removed_words
FROM b
"""
