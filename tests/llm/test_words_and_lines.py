"""Word-wise encoding against the tokenizer letter by letter, and the line rule against its SQL on shared templates."""

import numpy as np
from pyspark.sql import functions as F

from oracle.compare import compare
from transitlake.llm import packing, quality


def differing(encoder, words):
    got = encoder.encode(words)
    want = encoder.tokenizer.encode_batch(words, add_special_tokens=False)
    return [w for w, g, e in zip(words, got, want, strict=True) if np.frombuffer(g, "<u4").tolist() != e.ids]


def test_every_letter_before_signs():
    encoder = packing.WordEncoder(packing.tokenizer())
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    assert differing(encoder, [f"{c}." for c in letters]) == []
    normal = encoder.tokenizer.normalizer.normalize_str
    changing = [c for c in letters if normal(c) != c]
    for sign in packing._SIGNS:
        assert differing(encoder, [f"{a}{c}{sign}" for a in ("", "x") for c in changing]) == []


def test_words_that_hold_the_mark_or_only_signs():
    encoder = packing.WordEncoder(packing.tokenizer())
    words = ["\x01", "a\x01b", "...", "İ.", "İ...", "क़!", "it's.", "x1.", "1.", "ab,.", "́.", ".́", "á.", "\x1c.", "#"]
    assert differing(encoder, words) == [] and differing(encoder, [" ".join(words)] * 3) == []


def test_line_rule_and_its_sql_on_shared_templates(spark, tmp_path):
    """Documents that share several lines, which a count by one other line would take for one document."""
    import duckdb

    body = "one two three four five six seven eight nine ten eleven"
    rows = []
    for i in range(600):
        own = f"own line {chr(97 + i % 26)}{chr(97 + i // 26)} {body} {chr(98 + i % 24)}x"
        template = "Shared header 2024\nSecond shared line of all\nThird shared line" if i % 10 == 0 else f"plain {chr(97 + i % 26)}{chr(97 + i // 26)}"
        rows.append((i, f"{template}\n{own}" if i % 20 else template, "en", f"h{i % 2}" if i % 7 else None, 1))
    rows += [(1000 + i, rows[0][1], "en", None, 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    ours = quality.query(spark, str(tmp_path))
    ok, msg = compare(ours, con, quality.ORACLE)
    assert ok, msg
    # the shared lines are frequent: 60 of 600 documents, spread over three hosts
    assert ours.filter(F.col("n_removed_words") > 0).count() >= 50
