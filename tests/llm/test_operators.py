"""Small fixtures for the ten operators: odd rows, and brute force where SQL has no say."""

import collections
import hashlib
import math
import pickle
import random
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard
from pyspark.sql import functions as F

from transitlake.llm import bpe, chat, ctw, fingerprints, fixity, neardup, packing, pii, quality, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, chunk int, score double, start string"


def docs_of(spark, texts, first=1):
    """Rows with extra columns whose names the operators also use."""
    rows = [(first + i, t, None, "s1" if i % 3 else None, None, "x", 7, 0.5, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "alpha beta gamma delta".split() for b in range(40)]
    prose = [" ".join(rng.choice(words) for _ in range(80)) + ".\nsecond line here" for _ in range(12)]
    return [None, "", " \n\t ", "a", "é", prose[0], prose[0], prose[0] + " tail", *prose[1:], "long " * 20_000, "ab" * 30_000]


@pytest.fixture(scope="module")
def odd(spark):
    texts = odd_texts()
    docs = docs_of(spark, texts)
    again = docs.limit(6).union(docs.filter("doc_id = 6"))  # repeated rows
    null_id = docs.filter("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long"))
    return docs.union(again).union(null_id).cache()


def empty_of(docs):
    return docs.limit(0)


def all_docs(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


# fingerprints -------------------------------------------------------------


def brute_order_minhash(text):
    points = text
    k = fingerprints.K
    grams = [points[i : i + k] for i in range(max(1, len(points) - k + 1))]
    hashes = fingerprints.kmers(np.array([ord(c) for c in points], dtype=np.uint64))
    seen, numbers = collections.Counter(), []
    for g in grams:
        numbers.append(seen[g])
        seen[g] += 1
    with np.errstate(over="ignore"):
        elements = fingerprints._mix(hashes + np.array(numbers, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        add, times = fingerprints._seeds(fingerprints.COPIES)
        out = []
        for a, t in zip(add, times, strict=True):
            ranks = [int(((np.uint32(int(e) >> 32)) ^ a) * t) for e in elements]
            least = sorted(sorted(range(len(grams)), key=lambda i: (ranks[i], i))[: fingerprints.TUPLE])
            v = np.zeros(1, dtype=np.uint64)
            for i in least:
                v = fingerprints._mix(v * np.uint64(31) + hashes[i])
            out.append(int(v[0]) & 0xFFFFFFFF)
    return np.array(out, dtype=np.uint32)


def test_order_minhash_is_the_brute_force_one():
    for text in ["", "a", "abcdefgh", "abababababababab", "the quick brown fox jumps over the lazy dog, the quick brown fox"]:
        assert (fingerprints.order_minhash(text) == brute_order_minhash(text)).all(), text


def test_order_minhash_sees_order():
    a, b = "".join(random.Random(1).choices("abcdefgh ", k=400)), "".join(random.Random(2).choices("abcdefgh ", k=400))
    whole, turned = fingerprints.order_minhash(a + b), fingerprints.order_minhash(b + a)
    assert 0.2 < fingerprints.likeness(whole, turned) < 0.8


def test_fingerprints_of_all_documents(spark, sf_small):
    docs = all_docs(spark, sf_small)
    got = {r.doc_id: r for r in fingerprints.query(spark, sf_small).collect()}
    assert len(got) == len(docs)
    for k, (doc_id, text) in enumerate(docs):
        changed = fingerprints.edited(text, docs[(k + 1) % len(docs)][1])
        assert got[doc_id].n_chars == len(text)
        assert got[doc_id].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        if k % 20 == 0:
            assert got[doc_id].fingerprint == fingerprints.written(fingerprints.order_minhash(text))
            assert got[doc_id].edited_fingerprint == fingerprints.written(fingerprints.order_minhash(changed))


def test_fingerprints_odd_rows(odd):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == odd.count()
    by = collections.defaultdict(set)
    texts = {r.doc_id: r.text or "" for r in odd.select("doc_id", "text").collect()}
    for r in rows:
        by[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values())
    assert fingerprints.fingerprints(empty_of(odd)).count() == 0


# personal data ------------------------------------------------------------

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for k, form in FORMS.items():
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fails = {
                "email": False,
                "ip": any(int(x) > 255 for x in m.group().split(".")) if k == "ip" else False,
                "card": not (14 <= len(digits) <= 19 and luhn(digits or "0")),
                "phone": not 10 <= len(digits) <= 15,
            }
            if not fails[k]:
                out.append((m.start(), list(FORMS).index(k), m.end(), k))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_of_all_documents(spark, sf_small):
    for r, (_, text) in zip(sorted(pii.query(spark, sf_small).collect(), key=lambda r: r.doc_id), all_docs(spark, sf_small), strict=True):
        assert r.base_sha256 == hashlib.sha256(brute_spans(text).encode()).hexdigest()


def test_base_spans_of_hard_texts(spark):
    texts = [
        "a@b.com_x@y.org é tél: +1 (555) 123-4567, 1.2.3.4.5.6.7.8 and 300.1.1.1 4111 1111 1111 1111",
        "a@b a@b.c.d@e.f 1-1.2.3.4 4111-1111-1111-1111 0004111111111111111 +1+12345678901)(",
        "x" * 50 + "@y.z" + " 001.0255.0.1 1..2.3.4", "@@.+-%", None, "",
    ]
    rows = sorted(pii.spans_of(docs_of(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r.base_sha256 for r in rows] == [hashlib.sha256(brute_spans(t).encode()).hexdigest() for t in texts]


def test_very_long_texts_do_not_overflow(spark):
    text = "a." * 100_000 + " 1" + "-1" * 100_000 + " x@" + "b." * 50_000 + "c " + "9" * 100_000 + " +1" + "(" * 50_000
    row = pii.spans_of(docs_of(spark, [text])).first()
    assert (row.n_email, row.n_card, row.n_phone) == (1, 0, 0)


def test_contexts_discover_identifiers(spark):
    seeds = [f"hallo phone: +1 (55{n}) 123-45{n}7 end of record" for n in range(8)]
    unseen = [f"other phone: (55{n}) 999-88{n}1 stop here" for n in range(4)]
    plain = [f"lot (55{n}) 777-66{n}1 was sold" for n in range(4)]
    rows = pii.spans_of(docs_of(spark, seeds + unseen + plain)).orderBy("doc_id").collect()
    assert [r.n_added for r in rows] == [0] * 8 + [1] * 4 + [0] * 4
    assert rows[8].spans == "phone:13:27"
    clean = [r.text for r in pii.redact(docs_of(spark, seeds + unseen + plain)).orderBy("doc_id").collect()]
    assert clean[0] == "hallo phone: <PHONE> end of record" and clean[8] == "other phone: <PHONE> stop here" and clean[12] == plain[0]


def test_copies_change_no_spans(spark):
    seeds = [f"hallo phone: +1 (55{n}) 123-45{n}7 end of record" for n in range(8)]
    unseen = [f"other phone: (55{n}) 999-88{n}1 stop here" for n in range(4)]
    rows = pii.spans_of(docs_of(spark, seeds + unseen + unseen + ["phone: none"] + seeds[:1] * 50 + unseen[:1] * 50)).orderBy("doc_id").collect()
    once = pii.spans_of(docs_of(spark, seeds + unseen + ["phone: none"])).orderBy("doc_id").collect()
    assert [r.n_added for r in once] == [0] * 8 + [1] * 4 + [0]
    spans = [r.spans for r in once]
    assert [r.spans for r in rows] == spans[:12] + spans[8:] + spans[:1] * 50 + spans[8:9] * 50


def test_personal_data_odd_rows(odd):
    assert pii.spans_of(odd).count() == odd.count()
    kept = pii.redact(odd)
    assert kept.columns == odd.columns and kept.exceptAll(odd).count() == 0 and kept.count() == odd.count()
    assert pii.spans_of(empty_of(odd)).count() == 0 and pii.redact(empty_of(odd)).count() == 0


# byte-level BPE -----------------------------------------------------------


def reference_encoding():
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_token_and_random_texts_encode_alike():
    import public_tokenizers

    ranks, encoding = reference_encoding()
    coder = bpe.Coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = np.random.default_rng(0)
    pool = np.r_[0:128, 0:128, 128:700, 0x4E00:0x4F10, 0x1F600:0x1F640, 0x300:0x320, 0x2000:0x2030]
    texts = ["".join(map(chr, rng.choice(pool, rng.integers(0, 60)))) for _ in range(1500)] + ["a" * 50_000, "<|endoftext|>", " " * 999]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
    sample = [b for b in ranks if ranks[b] % 7 == 0]
    assert [i for i, in coder.processor.encode([bpe.mapped(b) for b in sample])] == [ranks[b] for b in sample]


def test_encoding_odd_rows(odd):
    import public_tokenizers

    rows = bpe.encoded(odd, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text or "" for r in odd.select("doc_id", "text").collect()}
    got = rows.collect()
    assert len(got) == odd.count() and all(bytes(r.decoded).decode() == texts[r.doc_id] for r in got)
    assert bpe.encoded(empty_of(odd), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


# near duplicates ----------------------------------------------------------


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return dict(collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else {tuple(w): 1})


def brute_classes(docs, threshold=0.8):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in docs]
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if slow_likeness(x, y) >= threshold:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in sets}


def slow_likeness(x, y):
    both = x.keys() & y.keys()
    if not both or 2 * len(both) < min(len(x), len(y)):
        return 0.0
    keys = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in keys) for d in both)


def test_likeness_is_the_sum_it_stands_for():
    rng = random.Random(5)
    for _ in range(30):
        x = {k: rng.randint(1, 4) for k in rng.sample(range(40), 20)}
        y = {k: rng.randint(1, 4) for k in rng.sample(range(40), 20)}
        both = x.keys() & y.keys()
        slow = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in both)
        assert math.isclose(neardup.likeness(x, y), slow, abs_tol=1e-12)


def test_scans_of_blocks_lose_no_link():
    rng = np.random.default_rng(8)
    rows = []
    for shape in (["copies"], ["chain"], ["copies", "chain", "apart"]):
        texts = []
        for kind in shape:
            core = rng.integers(0, 2**40, 40)
            for k in range(12):
                text = {"copies": core.copy(), "chain": np.roll(core, -3 * k), "apart": rng.integers(0, 2**40, 40)}[kind]
                text[: 3 * k if kind == "chain" else 2] = rng.integers(0, 2**40, 3 * k if kind == "chain" else 2)[: len(text)]
                texts.append(np.append(text, text[-1:]) if k % 3 else text)
        rows.append(texts)
    for texts in rows:
        sets = [dict(collections.Counter(t.tolist())) for t in texts]
        for across in (False, True):
            block = np.arange(len(texts)) % 2 if across else np.zeros(len(texts), dtype=int)
            pdf = pd.DataFrame({"node": range(len(texts)), "shingles": texts, "block": block, "one": 0, "two": int(across)})
            got = neardup._compared(pdf, 0.8)
            alike = {
                (i, j) for i in range(len(texts)) for j in range(i) if slow_likeness(sets[i], sets[j]) >= 0.8 and (not across or block[i] != block[j])
            }
            assert {(max(a, b), min(a, b)) for a, b in got.itertuples(index=False)} <= alike
            assert joined(len(texts), got.itertuples(index=False)) == joined(len(texts), alike)


def joined(n, edges):
    label = list(range(n))
    for a, b in edges:
        label = [label[a] if x == label[b] else x for x in label]
    return [label.index(x) for x in label]


def test_signatures_estimate_the_likeness():
    rng = np.random.default_rng(1)
    x = {int(k): int(w) for k, w in zip(rng.integers(0, 2**62, 300), rng.integers(1, 4, 300), strict=True)}
    y = dict(list(x.items())[:250]) | {int(k): 2 for k in rng.integers(0, 2**62, 40)}
    doc = np.array([0] * len(x) + [1] * len(y))
    sig = neardup.prob_minhash(doc, np.array(list(x) + list(y)).view(np.uint64), np.array([*x.values(), *y.values()]), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - neardup.likeness(x, y)) < 0.04


def test_classes_are_the_brute_force_ones(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(6)]
    texts = []
    for b in base:
        texts.append(" ".join(b))
        for edits in (0, 0, 1, 1, 2, 4, 9):
            c = list(b)
            for _ in range(edits):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append("\n".join([" ".join(c[:60]), " ".join(c[60:])]))
    texts += [None, "", "one two", "one  two", "one three", "x " * 200, "x " * 201]
    docs = docs_of(spark, texts)
    got = {r.doc_id: r.class_id for r in neardup.duplicate_classes(docs).collect()}
    assert got == brute_classes([(1 + i, t) for i, t in enumerate(texts)])
    kept = neardup.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values())) and kept.columns == docs.columns


def test_large_families_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", 4)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(100)]
    texts = []
    for n in range(30):
        c = list(base)
        for _ in range(n % 5):
            c[rng.randrange(100)] = rng.choice(words)
        texts.append(" ".join(c))
    got = {r.doc_id: r.class_id for r in neardup.duplicate_classes(docs_of(spark, texts)).collect()}
    assert got == brute_classes([(1 + i, t) for i, t in enumerate(texts)])


def test_near_duplicates_odd_rows(odd):
    assert neardup.duplicate_classes(odd).count() == odd.count()
    kept = neardup.keep_one(odd).select("doc_id").collect()
    assert len(kept) == len(set(kept)) and kept
    assert neardup.duplicate_classes(empty_of(odd)).count() == 0 and neardup.keep_one(empty_of(odd)).count() == 0


# chat ---------------------------------------------------------------------


def test_perspectives_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)
    rows = [(1, i, r, t, "x") for i, (r, t) in enumerate([("system", "be kind"), ("ann", "hi"), ("bob", None), ("ann", "é"), ("cy", "x"), (None, "?")] * 2)]
    rows += [(2, None, "ann", "null turn", "x"), (2, 1, "bob", "b", "x"), (2, 1, "bob", "b", "x"), (2, 1, "ann", "a", "x"), (3, 0, "system", "s", "x"), (None, 0, "ann", "n", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, start string")
    out = chat.perspectives(turns)
    assert out.select("conv_id", "perspective").distinct().count() == 4 + 2 + 1
    for r in chat.joined(out).collect():
        mine = [x for x in rows if x[0] == r.conv_id and (x[2] or "unknown") == r.perspective]
        said = sorted(r.rendering[m["start"] : m["stop"]] for m in r.masks)
        assert said == sorted((x[3] or "") + "<|end|>" for x in mine)
        assert f"<|user:{r.perspective}|>" not in r.rendering
    assert chat.perspectives(turns.limit(0)).count() == 0


# language model -----------------------------------------------------------


def brute_ctw(train, text):
    """log10 probability of a text, node by node."""
    D = ctw.DEPTH
    counts = collections.defaultdict(lambda: [0, 0])

    def walk(t):
        data = bytes([255] * D) + t + b"\xff"
        for p in range(D, len(data)):
            node = 1
            for bit in range(7, -1, -1):
                b = data[p] >> bit & 1
                yield data[p - D : p], node, b
                node = 2 * node + b

    contexts = collections.defaultdict(set)
    for t in train:
        for context, node, b in walk(t):
            for d in range(D + 1):
                counts[context[D - d :], node][b] += 1
                if d < D:
                    contexts[context[D - d :], node].add(context[D - 1 - d :])

    def pe(s, node):
        a, b = counts.get((s, node), (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    memo = {}

    def pw(s, node):
        if (s, node) not in memo:
            own = pe(s, node)
            memo[s, node] = own if len(s) == D else np.logaddexp(own, sum(pw(c, node) for c in contexts[s, node])) - math.log(2)
        return memo[s, node]

    total = 0.0
    for context, node, b in walk(text):
        left, p = 1.0, 0.0
        depths = [d for d in range(D + 1) if (context[D - d :], node) in counts]
        for d in depths:
            s = context[D - d :]
            share = 1.0 if d == depths[-1] else math.exp(pe(s, node) - math.log(2) - pw(s, node))
            a = counts[s, node]
            p += left * share * (a[1] + 0.5) / (sum(a) + 1)
            left *= 1 - share
        if not depths:
            p = 0.5
        total += math.log10(p if b else 1 - p)
    return total


def test_scores_are_the_brute_force_ones(spark):
    texts = ["The cat sat on the mat", "the cat ate", None, "", "Été à la mer", "the mat\nis\x0bwet", "zebra 9", "the cat sat", "THE CAT", "mer et mat"] * 2
    docs = docs_of(spark, texts)
    got = {r.doc_id: r for r in ctw.scores(docs).collect()}
    lower = [(1 + i, (t or "").encode().lower()) for i, t in enumerate(texts)]
    train = [t for i, t in lower if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(c.values()), len(c)
    assert any(r.held_out for r in got.values())
    for i, t in lower:
        tokens = [*t.split(), None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens), abs_tol=1e-9)
        assert math.isclose(r.score, brute_ctw(train, t), abs_tol=1e-6)


def test_model_is_near_the_base_on_few_held_out_texts(spark):
    rows = [r for r in ctw.query(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > 1.05 * sum(r.base_score for r in rows)
    assert sum(r.bits_per_byte for r in rows) / len(rows) < 2.7


def test_scores_odd_rows(odd):
    assert ctw.scores(odd).count() == odd.count()
    assert ctw.scores(empty_of(odd)).count() == 0


# packing ------------------------------------------------------------------


def test_cutting_stock_needs_few_sequences():
    rng = np.random.default_rng(4)
    sizes = np.arange(1, 65)
    demand = rng.integers(0, 60, 64)
    slots = packing.plan({int(s): int(d) for s, d in zip(sizes, demand, strict=True) if d}, 64)
    used = max(s[4] + -(-(s[2] - s[1]) // s[3]) for s in slots)
    assert sum(s[2] - s[1] for s in slots) == demand.sum()
    assert used <= math.ceil((sizes * demand).sum() / 64) * 1.02 + 2


def check_packed(rows, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer())
    t.encode_special_tokens = True
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc_id, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32


def test_packing_all_documents(spark, sf_small):
    rows = packing.query(spark, sf_small).collect()
    check_packed(rows, all_docs(spark, sf_small))
    lengths = collections.Counter()
    for r in rows:
        lengths[r.sequence_id] += r.length
    padding = sum(packing.CAPACITY - n for n in lengths.values() if n & (n - 1))
    assert padding < 0.05 * packing.CAPACITY * len(lengths)


def test_packing_odd_rows(spark):
    texts = odd_texts() + ["<|endoftext|> a", "x\x1cy\x01z", "İI ΑΣ. it's!!", "word. word, (word)"]
    docs = docs_of(spark, texts)
    check_packed(packing.pack(docs, packing.tokenizer()).collect(), [(1 + i, t) for i, t in enumerate(texts)])
    assert packing.pack(empty_of(docs), packing.tokenizer()).count() == 0
    twice = packing.pack(docs.union(docs), packing.tokenizer())
    assert twice.count() == 2 * packing.pack(docs, packing.tokenizer()).count()


# toxicity -----------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = toxicity.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    found = sum(r.predicted for r in scored if r.toxic == 1)
    wrong = sum(r.predicted for r in scored if r.toxic == 0)
    assert found >= 0.5 * sum(r.toxic for r in scored) and wrong <= 0.03 * len(scored)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)


def test_toxicity_ignores_held_out_labels(spark):
    docs = docs_of(spark, [f"text {i}" for i in range(40)])
    labels = spark.createDataFrame([(i, 1, 1) for i in range(1, 41)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    ids = {int(r.key) for r in toxicity.training_rows(docs, labels).collect()}
    assert ids == {i for i in range(1, 41) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 20)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(toxicity.training_rows(odd, labels))
    assert toxicity.score(odd, model).count() == odd.count()
    kept = toxicity.reject_toxic(odd, model, threshold=2.0)
    assert kept.columns == odd.columns and kept.schema == odd.schema and kept.exceptAll(odd).count() == 0 and kept.count() == odd.count()
    nothing = toxicity.fit(toxicity.training_rows(odd, labels.limit(0)))
    assert {r.score for r in toxicity.score(odd, nothing).collect()} == {0.0}
    assert toxicity.score(empty_of(odd), model).count() == 0


# quality ------------------------------------------------------------------


def brute_repeat(words):
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    return len({p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)})


def test_quality_figures(spark, odd):
    texts = odd_texts() + ["a b c d e f a b c d e f g", "x\nx\n\n \ny\nx", "#$%&|<>* plain", "a b c d e " * 3, "one\x0btwo\x0cthree\rfour five"]
    rows = quality.line_report(docs_of(spark, texts)).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t)) and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == brute_repeat(words)
        assert r.base_failed == (len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words))
    assert quality.line_report(odd).count() == odd.count()
    assert quality.line_report(empty_of(odd)).count() == 0


def test_frequent_lines_deplete(spark):
    rng = random.Random(9)

    def prose(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    banner = prose(30)
    own = [prose(40) for _ in range(60)]
    texts = [f"{banner}\n{own[i]}" for i in range(40)] + [f"{banner}\n{prose(8)}" for _ in range(5)] + own[40:] + [own[59] + "\n" + prose(12)] * 30
    rows = quality.line_report(docs_of(spark, texts).withColumn("source", F.lit("h"))).orderBy("doc_id").collect()
    assert all(r.kept and r.n_removed_words == 30 for r in rows[:40])
    assert not any(r.kept for r in rows[40:45])
    assert all(r.kept and not r.n_removed_words for r in rows[45:])  # copies are one document
    kept = quality.reject_poor(docs_of(spark, texts).withColumn("source", F.lit("h")).withColumn("host_key", F.lit(1)))
    assert kept.count() == len(texts) - 5 and "host_key" in kept.columns


def test_documents_of_a_shared_template_count_each(spark):
    rng = random.Random(10)

    def prose(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    template = [prose(6) for _ in range(10)]
    texts = ["\n".join([*template, prose(12)]) for _ in range(40)] + [prose(30) for _ in range(160)]
    texts += ["\n".join([*template, prose(3)])] * 25  # copies are one document
    rows = quality.line_report(docs_of(spark, texts).withColumn("source", F.lit("h"))).orderBy("doc_id").collect()
    assert [r.n_removed_words for r in rows] == [60] * 40 + [0] * 160 + [60] * 25
    assert not any(r.kept for r in rows[:40] + rows[200:]) and all(r.kept for r in rows[40:200])


def test_frequent_lines_are_taken_out(spark):
    import corpus_pipeline

    rng = random.Random(11)

    def prose(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    own = [prose(40) for _ in range(50)]
    texts = [f"  Page {i}  of 90\n{t}\n \n\tHOME | about\n{t[::-1]}\nPAGE {i} of 90\n" for i, t in enumerate(own[:30], 10)] + own[30:]
    texts += [texts[0], "home | about\n" * 3, None]
    docs = docs_of(spark, texts).withColumn("source", F.lit("h")).withColumn("frequent_lines", F.lit(1))
    rows = corpus_pipeline.quality(spark, docs, None)
    assert rows.columns == docs.columns
    wanted = [f"{t}\n \n{t[::-1]}\n" for t in own[:30]] + own[30:]
    assert [r.text for r in rows.orderBy("doc_id").collect()] == [*wanted, wanted[0]]
    assert quality.clean(empty_of(docs)).count() == 0


def test_cleaned_rows_are_those_that_pass(odd):
    kept = quality.clean(odd)
    assert kept.columns == odd.columns and kept.exceptAll(quality.reject_poor(odd)).count() == 0
    assert kept.count() == quality.reject_poor(odd).count()


# fixity -------------------------------------------------------------------


def test_audit_locates_damage(spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://a/"), "id").alias("url"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("html"), F.lit(1).alias("start")
    )
    flipped = pages.withColumn("html", F.when(F.col("page_id").isin(5, 1500, 2999), F.concat(F.lit("y"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    bad = fixity.report(pages, flipped).filter("damaged").select("page_id").collect()
    assert sorted(r.page_id for r in bad) == [5, 1500, 2999]
    assert fixity.report(pages, pages).filter("damaged").count() == 0


def test_audit_odd_rows(spark):
    rows = [(1, "u", "h", 0), (1, "u", "h", 0), (2, None, None, 0), (None, "u", "", 0), (5000, "v", "é" * 50_000, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, seq int")
    assert fixity.report(pages, pages).filter("not damaged").count() == 5
    lost = fixity.report(pages, pages.filter("page_id = 5000")).filter("damaged").count()
    assert lost == 4
    assert fixity.report(pages.limit(0), pages.limit(0)).count() == 0


def words_apart(blobs, words):
    """Packed documents of ``words`` words each, none of which comes twice; the bytes of their texts."""
    texts = [" ".join(f"{i:03d}{j:07d}" for j in range(words)).encode() for i in range(blobs)]
    press = zstandard.ZstdCompressor(level=3)
    return [press.compress(pickle.dumps([(1000 * i, i == 0, t)])) for i, t in enumerate(texts)], sum(map(len, texts))


def held_at_most(work):
    """Most bytes that Python and numpy held while ``work`` ran."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_chunk_is_counted_and_scored_in_few_times_its_bytes(monkeypatch):
    monkeypatch.setattr(ctw, "GROUP_BYTES", 50_000, raising=False)
    monkeypatch.setattr(ctw, "APART_ROWS", 5000, raising=False)
    blobs, size = words_apart(30, 4000)

    def batches():
        for blob in blobs:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([blob], pa.binary())], ["chunk", "blob"])

    rows = []
    assert held_at_most(lambda: rows.extend(ctw._counted(batches()))) < 8 * size
    counted = pa.Table.from_batches(rows)
    grams = counted.filter(pc.is_valid(counted.column("gram"))).column("gram").to_numpy()
    words = counted.filter(pc.is_valid(counted.column("word")))
    assert len(words) == 30 * 4000 and pc.sum(words.column("n")).as_py() == 29 * 4000
    got = []
    parts = [(grams, np.zeros(len(grams)))]
    assert held_at_most(lambda: got.extend(ctw._chunk_scores([], parts, list(blobs), 10**6, 10**5, 1))) < 6 * size
    assert [r["n_known"] for b in got for r in b.to_pylist()] == [1] + [4001] * 29
