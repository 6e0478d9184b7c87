"""Conversation structure repair on a suffix-shared automaton.

A conversation is well formed if the initials of its roles read
``(s?(ua)+)?``: an optional system turn, then user and assistant in turn.
Rows are kept (cost 0), given the role user or assistant (2), deleted (3; blank
and duplicate rows must be), and turns with empty text inserted (2); a
truncated row that stays costs 1.  Of the cheapest repairs the one with the
ASCII-least audit (initials of the edits in order) is taken.

What a repair costs depends only on the signature, one letter a row: the
initial of its role (upper case if truncated), or ``x`` if it must go.
Signatures share their ends: from the end, rows with the same rest of
signature are one node of the automaton.  Edges carry up to ``BLOCK`` letters,
so a node is (letters, node that follows), told by a digest and kept once for
all conversations.  Level by level from the end, each node gets its cost to go
and best audit suffix for each state of the grammar.  Nodes of a level are
ranged by their letters read backwards, so that neighbours share a suffix, and
a task works out each shared suffix once.

Levels are as many as the longest conversation has blocks, and a node holds
four whole audit suffixes.  Rows are ranked by ranges, so a conversation of any
length is spread over tasks; only its final digest, which is sequential by
definition, is streamed through one task in the order of rows.

Defined cases: a null role, text, id or turn counts as one space, and rows
without an id are one conversation; rows are ordered by turn (null first), then role and
text; a role is told by its first character (an empty one by none, which no
grammar allows); repeated rows are duplicates; a conversation without rows after damage has
zeros, an empty audit and the digest of the empty text; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake.llm.common import SPACES, in_order, settle, settle_table, ship, small_batches, table

ship(__name__)

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Letters of an edge of the automaton.
BLOCK = 256
#: Copies of a node's costs, so that no task joins all conversations of a common signature.
COPIES = 16
END = "end"

# States of the grammar: at the start, after a system, a user, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that a state wants next, and the state that it leads to.
WANTED = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
NAMES = {"u": "user", "a": "assistant"}
#: Cost to go and audit suffix of each state when no row is left.
DONE = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]


def conversation_key() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(""))


def damage(turns: DataFrame) -> DataFrame:
    """(key, turn, role, text): rows dropped, emptied, unpunctuated, repeated or made the user's by crc32(``conv_id:turn``)."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    act = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20
    role, text = spaced[2], spaced[3]
    return (
        turns.filter(act != 0)
        .select(
            conversation_key().alias("key"),
            F.col("turn").cast("long").alias("turn"),
            F.when(act == 4, "user").otherwise(role).alias("role"),
            F.when(act == 1, "").when(act == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.when(act == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
        )
        .select("key", "turn", "role", "text", F.explode("copies").alias("copy"))
        .drop("copy")
    )


def signed(rows: DataFrame) -> DataFrame:
    """Rows (key, turn, role, text) with ``rank``, ``total``, ``fault``, ``initial`` and ``letter``."""
    salted = settle_table(rows.select("key", "turn", "role", "text").withColumn("salt", F.monotonically_increasing_id()))
    ranked = settle_table(in_order(salted, "key", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("salt")]).drop("salt"))
    said = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("said")
    first = ranked.groupBy("key", said).agg(F.min("rank").alias("rank")).select("key", "rank", F.lit(True).alias("first"))
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(body == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated")
    )
    start = F.substring("role", 1, 1)
    initial = F.when(start.isin("u", "a", "s"), start).otherwise("o")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return (
        ranked.join(first, ["key", "rank"], "left")
        .withColumns({"fault": fault, "initial": initial})
        .withColumn("letter", letter)
        .drop("first")
    )


def blocks_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, back, last, chunk, initials): the signature in blocks counted from the end, ``last`` being the first in time."""
    entry = F.struct("rank", "letter", "initial")
    return (
        rows.withColumn("back", F.expr(f"(total - 1 - rank) div {block}"))
        .groupBy("key", "back", F.expr(f"(total - 1) div {block}").alias("last"))
        .agg(F.array_sort(F.collect_list(entry)).alias("letters"))
        .select("key", "back", "last", F.array_join("letters.letter", "").alias("chunk"), F.array_join("letters.initial", "").alias("initials"))
    )


def illegal_pairs(blocks: DataFrame) -> DataFrame:
    """(key, illegal): neighbours whose initials are none of su, ua, au (also across blocks)."""
    after = F.lag(F.substring("initials", 1, 1), 1, "").over(Window.partitionBy("key").orderBy("back"))
    read = blocks.select("key", F.concat("initials", after).alias("read"))
    legal = F.regexp_count("read", F.lit("(?=su|ua|au)"))
    return read.groupBy("key").agg(F.sum(F.length("read") - 1 - legal).cast("long").alias("illegal"))


def _step(letter: str, after: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Cost to go and audit suffix of each state before a row, from those after it (``L``: a system turn kept)."""
    out = []
    for state in range(4):
        wanted, leads = WANTED[state]
        found = [(after[state][0] + DELETE, "D" + after[state][1])]
        if letter != "x":
            role, extra = letter.lower(), TRUNCATED if letter.isupper() else 0
            if role == wanted:
                found.append((after[leads][0] + KEEP + extra, "K" + after[leads][1]))
            elif role == "s" and state == START:
                found.append((after[SYSTEM][0] + KEEP + extra, "L" + after[SYSTEM][1]))
            found.append((after[leads][0] + REROLE + extra, "R" + after[leads][1]))
        out.append(min(found))
    for _ in range(3):  # inserted turns lead from state to state; three of them pass all states
        for state in range(4):
            cost, audit = out[WANTED[state][1]]
            out[state] = min(out[state], (cost + INSERT, "I" + audit))
    return out


def _costs(frames):
    """Nodes (node, backwards, child_costs, child_audits), ordered so that neighbours share a suffix: their costs."""
    held, stack, of_child = "", [], None
    for nodes in frames:
        out = []
        for node, backwards, costs, audits in zip(nodes["node"], nodes["backwards"], nodes["child_costs"], nodes["child_audits"], strict=True):
            child = [(int(c), a) for c, a in zip(costs, audits, strict=True)]
            if child != of_child:
                held, stack, of_child = "", [child], child
            shared = 0
            while shared < min(len(held), len(backwards)) and held[shared] == backwards[shared]:
                shared += 1
            del stack[shared + 1 :]
            for letter in backwards[shared:]:
                stack.append(_step(letter, stack[-1]))
            held = backwards
            out.append((node, [c for c, _ in stack[-1]], [a for _, a in stack[-1]]))
        yield pd.DataFrame(out, columns=["node", "costs", "audits"])


def automaton(blocks: DataFrame) -> DataFrame:
    """(key, cost, audit) of each conversation; see the module's text for the nodes."""
    blocks = settle_table(blocks.select("key", "back", "last", "chunk"))
    most = blocks.agg(F.max("back")).first()[0]
    tops, placed, costs = None, None, None
    for level in range((most if most is not None else 0) + 1):
        here = blocks.filter(F.col("back") == level)
        if level == 0:
            here = here.withColumn("child", F.lit(END))
        else:
            here = here.join(placed.filter(F.col("last") >= level).select("key", F.col("node").alias("child")), "key")
        placed = settle_table(here.withColumn("node", F.md5(F.concat("child", F.lit(":"), "chunk"))))
        nodes = placed.groupBy("node").agg(F.first("child").alias("child"), F.reverse(F.first("chunk")).alias("backwards"))
        if level == 0:
            nodes = nodes.withColumns(
                {"child_costs": F.array(*[F.lit(c).cast("long") for c, _ in DONE]), "child_audits": F.array(*[F.lit(a) for _, a in DONE])}
            )
        else:
            child = costs.select(F.col("node").alias("child"), F.col("costs").alias("child_costs"), F.col("audits").alias("child_audits"))
            nodes = nodes.join(child, "child")
        # written: ranging reads its input twice
        dealt = settle_table(nodes).repartitionByRange("child", "backwards").sortWithinPartitions("child", "backwards")
        costs = settle_table(
            dealt.select("node", "backwards", "child_costs", "child_audits").mapInPandas(_costs, "node string, costs array<long>, audits array<string>")
        )
        copies = costs.select("node", F.get("costs", START).alias("cost"), F.get("audits", START).alias("audit"), F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"))
        ended = placed.filter(F.col("last") == level).select("key", "node", F.pmod(F.hash("key"), F.lit(COPIES)).alias("copy"))
        best = ended.join(copies, ["node", "copy"]).select("key", "cost", "audit")
        tops = best if tops is None else tops.unionByName(best)
    return tops


def _edits(frames):
    """Audits (key, audit) as turns that stay: key, seq, rank (below 0: inserted), role (null: the row's own)."""
    for found in frames:
        out = []
        for key, audit in zip(found["key"], found["audit"], strict=True):
            state, rank = START, 0
            for seq, edit in enumerate(audit):
                wanted, leads = WANTED[state]
                if edit == "I":
                    out.append((key, seq, -1 - seq, NAMES[wanted]))
                elif edit != "D":
                    out.append((key, seq, rank, NAMES[wanted] if edit == "R" else None))
                state = {"D": state, "L": SYSTEM}.get(edit, leads)
                rank += edit != "I"
        yield pd.DataFrame(out, columns=["key", "seq", "rank", "new_role"])


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(key, seq, role, text): the turns after repair, in order of ``seq``."""
    edits = audits.mapInPandas(_edits, "key string, seq long, rank long, new_role string")
    return edits.join(rows.select("key", "rank", "role", "text"), ["key", "rank"], "left").select(
        "key", "seq", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def _hashed(batches):
    """SHA-256 of each conversation's lines, which come in order, whatever batches they are in."""
    held, digest = None, None

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["key", "repaired_sha256"])

    for batch in batches:
        out = []
        for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = line.encode("utf-8", "surrogatepass")
            if key == held:
                digest.update(b"\n" + data)
                continue
            if digest is not None:
                out.append((held, digest.hexdigest()))
            held, digest = key, hashlib.sha256(data)
        yield batch_of(out)
    if digest is not None:
        yield batch_of([(held, digest.hexdigest())])


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The contract's row for each conversation of ``turns``, after :func:`damage`."""
    small_batches(turns.sparkSession)
    rows = settle_table(signed(damage(turns)))
    blocks = settle(blocks_of(rows, block))
    audits = settle_table(automaton(blocks))
    lines = repaired(rows, audits).select("key", "seq", F.concat("role", F.lit(":"), "text").alias("line"))
    digests = lines.repartition("key").sortWithinPartitions("key", "seq").select("key", "line").mapInArrow(_hashed, "key string, repaired_sha256 string")
    spread = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = rows.groupBy("key").agg(
        F.coalesce(spread, F.lit(0)).alias("gaps"), *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    )
    everyone = turns.groupBy(conversation_key().alias("key")).agg(F.first("conv_id").alias("conv_id"))
    out = everyone
    for found in (counts, illegal_pairs(blocks), audits, digests):
        out = out.join(found, "key", "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        "conv_id",
        *numbers,
        F.coalesce(F.translate("audit", "L", "K"), F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Contract query over all conversations."""
    return repair(table(spark, sf_dir, "conversations"))
