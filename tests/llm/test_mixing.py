"""Mixing against exact targets, whole copies, and means over many seeds."""

import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from transitlake.llm import mixing

SCHEMA = "doc_id long, text string, source string, rank int, total int, odds double, size string, block int, target string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 0.5, "x", 3, "y") for r in rows], SCHEMA)


def exact_targets(sizes):
    """sizes: source -> words.  Shares by weight, stopped at 3 times the size, in fractions."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left, open_ = {}, Fraction(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        for s in above:
            target[s] = Fraction(3 * sizes[s])
            left -= target[s]
        open_ -= above
    return target


def check(rows, got):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + count(text)
    targets = exact_targets(sizes)
    wanted = sorted((str(i), count(t), sizes[s], round(float(targets[s]), 6)) for i, t, s in rows)
    assert sorted((str(r.doc_id), r["size"], r.source_size, round(r.target, 6)) for r in got) == wanted
    assert all(r.taken == r["size"] * r.copies and 0 <= r.copies <= 3 for r in got)
    return targets, sizes


@pytest.mark.parametrize("block", [512, 4])
def test_sources_come_near_their_targets(spark, block):
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{i % 7}" if i % 11 else None) for i in range(600)] + [(1000 + i, "w", "tiny") for i in range(3)]
    df = mixing.mix(docs_of(spark, rows), block=block)
    got = df.collect()
    targets, sizes = check(rows, got)
    by_doc = {i: s for i, _, s in rows}
    for s in sizes:
        taken = sum(r.taken for r in got if by_doc[r.doc_id] == s)
        assert abs(taken - targets[s]) < 40  # the last document of the source
    again = mixing.mix(docs_of(spark, rows).repartition(5), block=block)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))


def test_odd_rows(spark):
    rows = [
        (None, "a b", None), (None, None, None), (2**60 + 1, "x y z", ""), (3, "", ""), (4, "same words", "q"), (4, "same words", "q"),
        (5, " \t\n", "q"), (6, "long " * 100_000, "é"), (7, "e", "\U0001f600"), (8, "f", "zz"),
    ]
    got = mixing.mix(docs_of(spark, rows)).collect()
    check(rows, got)
    assert {r.doc_id for r in got} == {r[0] for r in rows} and len(got) == len(rows)
    assert mixing.mix(docs_of(spark, rows).limit(0)).count() == 0
    wordless = mixing.mix(docs_of(spark, [(1, None, "a"), (2, " ", "b")])).collect()
    assert [(r.target, r.taken) for r in wordless] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize(
    "method,sizes,odds",
    [
        (mixing._pivot, [50, 40, 31, 30, 8, 5, 5, 2, 1, 1], [0.3, 0.9, 0.5, 0.25, 0.5, 0.7, 0.1, 0.6, 0.35, 0.05]),
        (mixing._pool, [50, 40, 31, 30, 8, 5, 5, 2, 1, 1], [0.3] * 10),
        (mixing._pool, [500, 40, 31, 1, 1], [0.85] * 5),
        (mixing._pool, [7], [0.4]),
        (mixing._pool, [4, 4, 4, 4], [0.25] * 4),
    ],
)
def test_means_are_kept(method, sizes, odds):
    """Over many draws each document's copies come to its odds, and the words never change but for the last one."""
    import random

    total, runs = [0.0] * len(sizes), 20_000
    for seed in range(runs):
        drawn, draw = list(odds), random.Random(seed).random
        left = method(sizes, drawn, draw)
        assert all(x in (0.0, 1.0) for i, x in enumerate(drawn) if i != left)
        assert sum(map(lambda s, x: s * x, sizes, drawn)) == pytest.approx(sum(map(lambda s, x: s * x, sizes, odds)))
        if left is not None:
            drawn[left] = 1.0 if draw() < drawn[left] else 0.0
        total = [a + b for a, b in zip(total, drawn, strict=True)]
    assert [t / runs for t in total] == pytest.approx(odds, abs=0.015)


def test_one_large_document_is_made_up_for():
    """A document of half the words is settled first; the many small ones keep the sum to a few words."""
    import random

    sizes = sorted([5000, *[1 + 7 * i % 60 for i in range(150)]], reverse=True)
    for seed in range(300):
        odds, draw = [0.55] * len(sizes), random.Random(seed).random
        left = mixing._pool(sizes, odds, draw)
        if left is not None:
            odds[left] = 1.0 if draw() < odds[left] else 0.0
        missed = abs(sum(map(lambda s, x: s * x, sizes, odds)) - 0.55 * sum(sizes))
        assert missed <= (60 if left != 0 else 5000)
        # only where the small ones together cannot make up for it does it stay open
        assert left != 0 or 0.45 * 5000 > 0.55 * sum(sizes[1:]) or 0.55 * 5000 > 0.45 * sum(sizes[1:])


def test_query_over_the_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = mixing.query(spark, sf_small)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    targets, _ = check(rows, got.collect())
    taken = got.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.max("size").alias("m")).collect()
    assert all(abs(r.t - targets[r.source]) < r.m for r in taken)
