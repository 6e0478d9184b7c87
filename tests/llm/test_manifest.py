"""The dataset manifest against plain Python trees, with many exchange rounds and odd rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from transitlake.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, rank int, block int, node string, path string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, "n", "p") for r in rows], SCHEMA)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*(enc(v) for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes, at, fanout):
    """Root of the tree over ``nodes``, and the siblings of ``nodes[at]`` as (before, after) on the way."""
    path = []
    while len(nodes) > 1:
        start = at // fanout * fanout
        run = nodes[start : start + fanout]
        path.append((run[: at - start], run[at - start + 1 :]))
        nodes = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at //= fanout
    return nodes[0], path


def brute(rows, fanout):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((-1 if r[0] is None else r[0], leaf(*r), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by_lang[x].sort(key=lambda e: e[:2])
    subroots = [climb([e[1] for e in by_lang[x]], 0, fanout)[0] for x in langs]
    out = []
    for at, x in enumerate(langs):
        root, upper = climb(subroots, at, fanout)
        nodes = [e[1] for e in by_lang[x]]
        for i, (_, node, r) in enumerate(by_lang[x]):
            path = climb(nodes, i, fanout)[1] + upper
            doc_id, text, lang, source, n_chars = r
            if zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            cur = leaf(doc_id, text, lang, source, n_chars)
            for before, after in path:
                cur = digest(*before, cur, *after)
            proof = digest(*("".join(b + a) for b, a in path))
            out.append((doc_id, node, subroots[at], root, proof, cur, cur == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("fanout,span", [(8, 4096), (2, 2), (3, 9), (8, 8)])
def test_trees_and_proofs(spark, fanout, span):
    rows = [(i, f"Text {i} ÄB" * (i % 4), lang, None if i % 5 else "s", i) for lang, n in (("en", 70), ("de", 19), ("fr", 1), ("é", 9)) for i in range(n)]
    got = rows_of(manifest.manifest(docs_of(spark, rows), fanout, span))
    assert got == brute(rows, fanout)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "A", None, "", 0), (3, "", "en", None, None), (3, "B", "en", None, None),
        (4, "same Copy", "en", "s", 9), (4, "same Copy", "en", "s", 9), (4, "same Copy", "en", "s", 9), (5, "LONG ä " * 50_000, "", "s", -1),
    ]
    got = rows_of(manifest.manifest(docs_of(spark, rows), 2, 2))
    assert got == brute(rows, 2)
    assert manifest.manifest(docs_of(spark, rows).limit(0)).count() == 0


def test_short_last_groups_reach_every_lane(spark):
    """Spare lanes stand in for missing ones, and each block gets the one root."""
    for n in (1, 3, 8, 10, 28):
        roots = spark.createDataFrame([("k", i, n, digest(str(i))) for i in range(n)], "key string, block long, blocks long, node string")
        got = {r.block: (r.top, [(s.before, s.after) for s in r.path]) for r in manifest.butterfly(roots, 3).collect()}
        nodes = [digest(str(i)) for i in range(n)]
        for i in range(n):
            top, path = climb(nodes, i, 3)
            assert got[i] == (top, [("".join(b), "".join(a)) for b, a in path])


def test_query_finds_exactly_the_changed_texts(spark, sf_small):
    got = manifest.query(spark, sf_small)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    changed = docs.filter(manifest.tampered() & (F.col("text") != manifest.lower_ascii(F.col("text")))).count()
    assert got.count() == docs.count() and got.filter("NOT verified").count() == changed > 0
