"""Merkle dataset manifest with a butterfly exchange of subtree roots.

Each document is a leaf, the SHA-256 of its fields; the leaves of a language
make a tree by ``doc_id`` in runs of ``FANOUT``, and the languages' roots make
the tree above them in the same way.  A proof is the digests of the siblings
on the way to the root.

Leaves are ranked by ranges, so a language of any size is spread over tasks,
and cut into aligned blocks of ``SPAN`` leaves (a power of the fanout), whose
subtrees are hashed one block a task group.  Above the blocks, no pass goes up
and comes down again: in round j, the ``FANOUT`` groups of ``FANOUT ** j``
blocks that form one run meet lane by lane (blocks with the same place inside
their groups), swap their roots, and each hashes the common ancestor for
itself and notes the roots of the others.  After a logarithm of rounds every
block holds its whole upper proof.  The last group of a row may be short; its
blocks then stand in for the lanes that it lacks ("spare" lanes, at most as
many as blocks in all).  At most ``FANOUT`` narrow rows meet at a key.

``prove`` then walks each block once more and folds the upper proof on.

Defined cases: null fields are ``-``; a null language comes before all others,
a null ``doc_id`` before all ids of its language; equal ids are ordered by
their leaf digest, and repeated rows are leaves each (alike, so that their
order has no effect); an empty table gives no rows; further columns are
ignored.  A null id counts as the empty text where tampering is drawn.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import in_order, settle, settle_table, ship, table

ship(__name__)

FANOUT = 8
#: Leaves of a block: a power of the fanout.
SPAN = FANOUT**4
#: Copies of a language's upper path, so that no task joins all blocks of a hot language.
COPIES = 64

PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A field as hashed: ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    parts = [field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*parts, field(text)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered() -> Column:
    """Whether a row is among those that the query tampers with."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0


def leaves(docs: DataFrame) -> DataFrame:
    """(key, doc_id, node, other): leaf digests, and those of the tampered rows (else the same).

    ``key`` orders languages as the manifest does: null as the empty text, then by bytes.
    """
    node = leaf_of(F.col("text"))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        node.alias("node"),
        F.when(tampered(), leaf_of(lower_ascii(F.col("text")))).otherwise(node).alias("other"),
    )


def _digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def _levels(nodes: list[str], total: int, fanout: int, span: int) -> list[list[str]]:
    """The block's levels, leaves first: up to one node, or as many as every block of a longer tree has."""
    out, width = [nodes], 1
    while (width < span) if total > span else (len(out[-1]) > 1):
        below = out[-1]
        out.append([_digest(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
        width *= fanout
    return out


def planted(rows: DataFrame, order: list[Column], span: int) -> DataFrame:
    """Rows (key, node, ...) with ``rank``, ``total``, ``block`` and ``blocks``."""
    return in_order(rows, "key", order).withColumns(
        {"block": F.floor(F.col("rank") / span).cast("long"), "blocks": F.ceil(F.col("total") / span).cast("long")}
    )


def block_roots(placed: DataFrame, fanout: int = FANOUT, span: int = SPAN) -> DataFrame:
    """(key, block, blocks, node): the root of each block's subtree."""

    def root(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        top = _levels(rows["node"].tolist(), int(rows["total"].iloc[0]), fanout, span)[-1][0]
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "block": [rows["block"].iloc[0]], "blocks": [rows["blocks"].iloc[0]], "node": [top]})

    slim = placed.select("key", "block", "blocks", "total", "rank", "node")
    return slim.groupBy("key", "block").applyInPandas(root, "key string, block long, blocks long, node string")


def swap(lanes: DataFrame, width: int, fanout: int = FANOUT) -> DataFrame:
    """One round: groups of ``width`` lanes that form one run exchange their roots, lane by lane."""
    live = lanes.filter(F.col("blocks") > width).select(
        "key",
        "blocks",
        F.expr(f"lane div {width * fanout}").alias("up"),
        F.expr(f"lane % {width}").alias("track"),
        F.struct(F.expr(f"lane div {width} % {fanout}").alias("digit"), "node", "spare", "path").alias("member"),
    )
    # a lane of each of the run's groups: fanout rows at most
    met = live.groupBy("key", "blocks", "up", "track").agg(F.array_sort(F.collect_list("member")).alias("run"))
    mine = met.select(
        "key", "blocks", "up", "track", "run", F.sha2(F.array_join("run.node", ""), 256).alias("parent"), F.explode("run").alias("me")
    )

    def others(side) -> Column:
        return F.array_join(F.transform(F.filter("run", side), lambda x: x.node), "")

    step = F.struct(others(lambda x: x.digit < F.col("me.digit")).alias("before"), others(lambda x: x.digit > F.col("me.digit")).alias("after"))
    # the last group that is not full yet: its rows also serve the lanes that it lacks
    last = F.expr(f"(blocks - 1) div {width * fanout}")
    held = F.expr(f"(blocks - 1) div {width} % {fanout} + 1")
    short = (F.col("blocks") > width * fanout) & (F.col("up") == last)
    times = F.when(short, F.floor((fanout - 1 - F.col("me.digit")) / held)).otherwise(F.lit(0))
    served = mine.withColumn("held", held).withColumn("step", step).withColumn("again", F.explode(F.sequence(F.lit(0).cast("long"), times.cast("long"))))
    digit = F.col("me.digit") + F.col("again") * F.col("held")
    spare = F.col("me.spare") | (F.col("again") > 0)
    swapped = served.select(
        "key",
        "blocks",
        ((F.col("up") * fanout + digit) * width + F.col("track")).cast("long").alias("lane"),
        F.col("parent").alias("node"),
        spare.alias("spare"),
        F.when(spare, F.array().cast(PATH)).otherwise(F.concat("me.path", F.array("step"))).alias("path"),
    )
    return lanes.filter(F.col("blocks") <= width).unionByName(swapped)


def butterfly(roots: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(key, block, top, path): for each block the root of its tree and the siblings on the way up."""
    roots = settle_table(roots)
    lanes = roots.select(
        "key", "blocks", F.col("block").alias("lane"), "node", F.lit(False).alias("spare"), F.array().cast(PATH).alias("path")
    )
    most, width = roots.agg(F.max("blocks")).first()[0] or 0, 1
    while width < most:
        lanes = settle(swap(lanes, width, fanout))
        width *= fanout
    return lanes.filter(~F.col("spare")).select("key", F.col("lane").alias("block"), F.col("node").alias("top"), "path")


def _walk(levels: list[list[str]], upper: list[tuple[str, str]], at: int, fanout: int):
    """(before, after) of the run's other digests for each level from a leaf to the root."""
    for nodes in levels[:-1]:
        start = at - at % fanout
        yield "".join(nodes[start:at]), "".join(nodes[at + 1 : start + fanout])
        at //= fanout
    yield from upper


def _path(cell) -> list[tuple[str, str]]:
    return [(step["before"], step["after"]) for step in (cell if cell is not None else [])]


def language_paths(tops: DataFrame, fanout: int = FANOUT, span: int = SPAN) -> DataFrame:
    """(lang_key, subroot, root, lang_path): the tree over the languages' roots, built the same way."""
    placed = planted(tops.select(F.lit("").alias("key"), "lang_key", "node"), [F.col("lang_key")], span)

    def climb(keys, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        levels = _levels(rows["node"].tolist(), int(rows["total"].iloc[0]), fanout, span)
        upper = _path(above["path"].iloc[0])
        paths = [[{"before": b, "after": a} for b, a in _walk(levels, upper, i, fanout)] for i in range(len(rows))]
        return pd.DataFrame(
            {"lang_key": rows["lang_key"].tolist(), "subroot": rows["node"].tolist(), "root": above["top"].iloc[0], "lang_path": paths}
        )

    above = butterfly(block_roots(placed, fanout, span), fanout)
    return (
        placed.groupBy("key", "block")
        .cogroup(above.groupBy("key", "block"))
        .applyInPandas(climb, f"lang_key string, subroot string, root string, lang_path {PATH}")
    )


def prove(docs_leaves: DataFrame, fanout: int = FANOUT, span: int = SPAN) -> DataFrame:
    """Every leaf with its subroot, root and proof, and the root folded up from ``other``.

    Takes (key, doc_id, node, other), see :func:`leaves`.
    """
    placed = planted(docs_leaves, [F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("salt")], span)
    uppers = settle_table(butterfly(block_roots(placed, fanout, span), fanout))
    tops = uppers.filter(F.col("block") == 0).select(F.col("key").alias("lang_key"), F.col("top").alias("node"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    langs = language_paths(tops, fanout, span).withColumn("copy", copies)
    whole = uppers.join(
        langs, (F.col("key") == F.col("lang_key")) & (F.col("block") % COPIES == F.col("copy"))
    ).select("key", "block", "subroot", "root", F.concat("path", "lang_path").alias("path"))

    def fold(keys, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        levels = _levels(rows["node"].tolist(), int(rows["total"].iloc[0]), fanout, span)
        upper = _path(above["path"].iloc[0])
        proofs, folded = [], []
        for i, node in enumerate(rows["other"].tolist()):
            proof = hashlib.sha256()
            for before, after in _walk(levels, upper, i, fanout):
                proof.update((before + after).encode("ascii"))
                node = _digest(before, node, after)
            proofs.append(proof.hexdigest())
            folded.append(node)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].tolist(),
                "leaf": rows["node"].tolist(),
                "subroot": above["subroot"].iloc[0],
                "root": above["root"].iloc[0],
                "proof_sha256": proofs,
                "folded_root": folded,
            }
        )

    # ids as text: pandas would turn a column of ids with a null into floats
    slim = placed.select("key", "block", "total", "rank", F.col("doc_id").cast("string").alias("doc_id"), "node", "other")
    proven = slim.groupBy("key", "block").cogroup(whole.groupBy("key", "block")).applyInPandas(
        fold, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return proven.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest(docs: DataFrame, fanout: int = FANOUT, span: int = SPAN) -> DataFrame:
    """The contract's rows for ``docs`` (doc_id, text, lang, source, n_chars)."""
    # written once: ranging samples its input, and texts should be hashed once only
    slim = settle_table(leaves(docs).withColumn("salt", F.monotonically_increasing_id()))
    return prove(slim, fanout, span)


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return manifest(table(spark, sf_dir, "documents"))


def crc32_sql(text: str) -> str:
    """DuckDB expression: unsigned crc32 of an ASCII text, byte by byte and bit by bit (-1: shift one bit)."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ord(substr({text}, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = (
        "lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END"
    )
    return f"xor(list_reduce({steps}, {step}, 4294967295::BIGINT), 4294967295)"


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _oracle(levels: int = 6, lang_levels: int = 3) -> str:
    """The trees level by level, joins of every row with its run (8 ** levels rows a language)."""
    ctes = [
        f"""d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS k, {_leaf_sql("text")} AS leaf,
         CASE WHEN {crc32_sql("coalesce(doc_id::VARCHAR, '')")} % 3 = 0
              THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf_sql("text")} END AS other
  FROM documents)""",
        """f0 AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, other AS cur, '' AS proof FROM d)""",
        "n0 AS (SELECT k, pos, leaf AS h FROM f0)",
    ]

    def climb(name: str, nodes: str, i: int) -> None:
        ctes.append(
            f"""r{nodes}{i} AS (
  SELECT k, pos // 8 AS up, any_value(c) AS c, list(h ORDER BY pos) AS hs
  FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM {nodes}{i}) GROUP BY k, pos // 8)"""
        )
        ctes.append(
            f"{nodes}{i + 1} AS (SELECT k, up AS pos, CASE WHEN c = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM r{nodes}{i})"
        )
        own = "(f.pos % 8)::INTEGER"
        ctes.append(
            f"""{name}{i + 1} AS (
  SELECT f.* REPLACE (f.pos // 8 AS pos,
    CASE WHEN c = 1 THEN cur ELSE sha256(array_to_string(hs[1:{own}] || [cur] || hs[{own} + 2:], '')) END AS cur,
    CASE WHEN c = 1 THEN proof ELSE proof || array_to_string(hs[1:{own}] || hs[{own} + 2:], '') END AS proof)
  FROM {name}{i} f JOIN r{nodes}{i} r ON f.k = r.k AND f.pos // 8 = r.up)"""
        )

    for i in range(levels):
        climb("f", "n", i)
    ctes.append(f"m0 AS (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS pos, h, k AS lang_key FROM n{levels})")
    ctes.append(
        f"g0 AS (SELECT doc_id, leaf, m.h AS subroot, '' AS k, m.pos AS pos, cur, proof FROM f{levels} f JOIN m0 m ON f.k = m.lang_key)"
    )
    for i in range(lang_levels):
        climb("g", "m", i)
    return (
        "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = h AS verified
FROM g{lang_levels}, m{lang_levels}"""
    )


ORACLE = _oracle()
