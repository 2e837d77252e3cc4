"""Compression bands, quality classifier and URL verdicts."""

from __future__ import annotations

import base64
import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.conftest import prose

from tephra.llm import compression_rules as rules
from tephra.llm import quality_classifier as qc
from tephra.llm import url_filter
from tephra.llm.queries import op1_quality_classifier, op8_compression_rules

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"


def base_counts(text):
    """The contract's counts, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] >= 2:
            covered |= {i, i + 1, i + 2}
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, dups, len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", " ", "\n", "\t", "\x0b", "\x0c", "\r", "#", "é", "\xa0", "\x1c", "|", "中"]), max_size=80).map("".join))
def test_counts(text):
    got = rules.judge(text)
    assert tuple(got[c] for c in COLUMNS) == base_counts(text)


def test_op8_equals_the_counts(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op8_compression_rules(spark, SF).collect():
        assert tuple(r[c] for c in COLUMNS) == base_counts(texts.pop(r["doc_id"]))
        assert not (r["base_failed"] and r["kept"])
    assert not texts


def test_bands():
    rng = random.Random(3)
    noise = base64.b64encode(rng.randbytes(30_000)).decode()
    spaced = " ".join(noise[i : i + 12] for i in range(0, len(noise), 12))
    for n in (60, 200, 1000, 10_000):
        assert rules.judge(prose(n, n))["kept"], n
    assert not rules.judge(spaced)["kept"]
    assert not rules.judge("".join(f"line {i % 2} is here {i}\n" for i in range(5000)))["kept"]
    mixed = prose(1, 400) + " " + spaced  # most chunks are noise
    assert not rules.judge(mixed)["kept"]


def spaced_noise(letters, n, seed=4):
    rng, out = random.Random(seed), ""
    while len(out) < n:
        out += "".join(rng.choices(letters, k=rng.randint(3, 9))) + " "
    return out[:n]


def test_bands_reject_noise_and_repetition():
    lower, hexadecimal = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
    noise = [spaced_noise(lower, n) for n in (1500, 2048, 4096, 8192, 16384, 70_000)]
    noise += [spaced_noise(lower + lower.upper(), n) for n in (1024, 1500, 2048, 4096, 8192, 16384, 70_000)]
    noise += [spaced_noise(hexadecimal, n) for n in (4096, 8192, 16384, 70_000)]
    noise += [spaced_noise("0123456789", n) for n in (16384, 70_000)]
    for text in noise:
        got = rules.judge(text)
        assert not got["base_failed"] and not got["kept"], (len(text), text[:40], got["doc_ratio"])
    for n in (220, 900, 3500):  # half of the words are repeated: the base rules let it pass
        words = prose(n, n).split()
        passage = words[: n * 24 // 100]
        got = rules.judge(" ".join([*passage, *passage, *words[len(passage) : n - len(passage)]]))
        assert not got["base_failed"] and not got["kept"], (n, got["n_repeat_words"], got["doc_ratio"])


def test_chunks_reject_noise_in_a_part():
    rng = random.Random(6)

    def noise(n):
        text = base64.b64encode(rng.randbytes(n)).decode()
        return " ".join(text[i : i + 12] for i in range(0, n, 12))[:n]

    for clean, dirty in ((41_000, 41_000), (41_000, 17_500), (150_000, 30_000), (4200, 3900), (12_500, 2000)):
        words = prose(clean, clean // 3)[:clean]
        assert rules.judge(words)["kept"], clean
        for text in (words + " " + noise(dirty), noise(dirty) + " " + words):
            got = rules.judge(text)
            assert not got["base_failed"] and got["n_bad_chunks"] > 0 and not got["kept"], (clean, dirty, got["doc_ratio"])


def test_every_byte_is_in_a_chunk():
    for n in (0, 1, 4095, 4096, 4097, 8191, 8192, 8193):
        raw = bytes(i % 251 for i in range(n))
        chunks = rules.chunks_of(raw)
        assert len(chunks) == (0 if n < 4096 else -(-n // 4096)) and all(len(c) == 4096 for c in chunks)
        if chunks:
            assert bytes(chunks[0]) == raw[:4096] and bytes(chunks[-1]) == raw[-4096:]
    words = prose(9, 40_000)
    at = len(words) // 2
    assert rules.judge(words[:at] + " " + "0123456789abcdef" * 200 + " " + words[at:])["kept"]  # one odd part of a long text


def test_bands_keep_clean_labelled_text(spark):
    docs = spark.read.parquet(f"{SF_LABELS}/documents.parquet").join(spark.read.parquet(f"{SF_LABELS}/labels.parquet"), "doc_id")
    clean = [rules.judge(r["text"]) for r in docs.filter("quality = 1").collect()]
    assert all(c["kept"] or c["base_failed"] for c in clean) and sum(c["kept"] for c in clean) > 100


SF_LEARN = "/root/testdata/sf0.1"


def test_bands_are_learned_and_hold_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF_LEARN}/{t}.parquet") for t in ("documents", "labels"))
    assert rules.learn(docs, labels) == rules.BANDS
    held = labels.filter("quality = 1").filter(qc.fold(F.col("doc_id")) == 0)
    got = [rules.judge(r["text"]) for r in docs.join(held, "doc_id", "left_semi").collect()]
    passed = [g for g in got if not g["base_failed"]]
    wrong = sum(not g["kept"] for g in passed)
    assert len(passed) > 500 and wrong <= 0.005 * len(passed), (wrong, len(passed))


def test_learned_bands_on_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(77, 1), (77, 0), (3, None), (None, 1), (4, 7)], "doc_id bigint, quality int")
    for docs in (odd_docs, no_docs):
        assert rules.learn(docs, labels) == rules.BANDS
    # Enough texts of one length: its class moves, the others stay.
    texts = [(i, prose(i, 200)) for i in range(1, 200)]
    labels = spark.createDataFrame([(i, 1) for i, _ in texts], "doc_id bigint, quality int")
    bands = rules.learn(spark.createDataFrame(texts, "doc_id bigint, text string"), labels)
    changed = [a.min_bytes for a, b in zip(bands.docs, rules.BANDS.docs, strict=True) if a != b]
    assert changed and set(changed) <= {724, 1024, 1448, 2048}


def test_op8_odd_rows(odd_docs, no_docs):
    assert rules.quality_rules(odd_docs).count() == odd_docs.count()
    assert rules.quality_rules(no_docs).count() == 0
    kept = rules.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and [r["doc_id"] for r in kept.collect()] == [77]


# ---- classifier ---------------------------------------------------------------------------


def test_paths_of_a_printed_tree():
    text = """DecisionTreeClassificationModel: uid=x, depth=2
  If (feature 2 <= 0.5)
   If (feature 0 <= 1.0E-4)
    Predict: 0.0
   Else (feature 0 > 1.0E-4)
    Predict: 1.0
  Else (feature 2 > 0.5)
   Predict: 1.0
"""
    a, b = (2, "<=", 0.5), (2, ">", 0.5)
    assert {r.conditions for r in qc.paths(text)} == {(a,), (b,), ((0, "<=", 1e-4), a), ((0, ">", 1e-4), a)}


def test_op1_held_out_accuracy(spark):
    out = op1_quality_classifier(spark, SF_LABELS)
    labels = spark.read.parquet(f"{SF_LABELS}/labels.parquet")
    rows = out.join(labels, "doc_id").collect()
    fold = {r["doc_id"]: r["held_out"] for r in rows}
    import zlib

    assert all(held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, held in fold.items())
    test = [r for r in rows if r["held_out"]]
    right = sum(r["predicted"] == r["quality"] for r in test)
    assert len(test) > 50 and right >= 0.95 * len(test), (right, len(test))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.collect())
    assert out.count() == spark.read.parquet(f"{SF_LABELS}/documents.parquet").count()


def test_op1_score_by_hand(spark):
    docs, labels = (spark.read.parquet(f"{SF_LABELS}/{t}.parquet") for t in ("documents", "labels"))
    model = qc.fit(docs, labels)
    assert model.rules
    got = {r["doc_id"]: r for r in qc.score(docs, model).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        stats = qc.statistics(text)
        z = model.intercept
        for rule, weight in model.rules:
            holds = [stats[i] <= bound if op == "<=" else stats[i] > bound for i, op, bound in rule.conditions]
            z += weight * all(holds)
        want = 1 / (1 + math.exp(-z))
        assert abs(got[doc_id]["score"] - want) < 1e-12
        assert got[doc_id]["predicted"] == int(got[doc_id]["score"] >= 0.3)


def test_op1_sample_has_one_row_per_id(spark):
    docs = spark.range(1000).select(F.lit(1).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.union(spark.createDataFrame([(2, None), (2, "b a"), (3, None)], "doc_id bigint, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 6, 7)], "doc_id bigint, quality int")
    ids = [r["doc_id"] for r in qc.training_sample(docs, labels).collect()]
    learnt = [r[0] for r in labels.filter(qc.fold(F.col("doc_id")) != 0).select("doc_id").collect()]
    assert sorted(ids) == sorted(i for i in learnt if i <= 3) and ids
    assert qc.training_sample(docs, labels, max_rows=1).count() <= 1


def test_op1_odd_rows_and_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one_sided = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert qc.fit(odd_docs, none) == qc.Model(0.0)
    model = qc.fit(odd_docs, one_sided)
    out = qc.score(odd_docs, model)
    assert out.columns == ["doc_id", "score", "predicted"] and out.count() == odd_docs.count()
    assert out.filter("score is null or isnan(score)").count() == 0
    assert qc.score(no_docs, model).count() == 0
    kept = qc.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


# ---- URLs ---------------------------------------------------------------------------------


def test_op5_rules_and_hosts(spark):
    urls = [
        (None, "", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://A.Example.COM/en/1?x=/es/", "a.example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://x.www.example.com/en/q", "x.www.example.com", "/en/q", "www.example.com/en/", "allow"),
        ("https://badexample.com/en/q", "badexample.com", "/en/q", "com/", "allow"),
        ("x://foo.net/es/1#a", "foo.net", "/es/1", "net/es/", "block"),
        ("x://foo.net/es", "foo.net", "/es", None, "allow"),
        ("x://com", "com", "", None, "allow"),
        ("x://com/", "com", "/", "com/", "allow"),
        ("x://É.org/a://b", "É.org", "/a://b", None, "allow"),
        ("x://www.listed.org/p/?b=2&utm_source=q&a=1", "www.listed.org", "/p/", None, "block"),
        ("x://listed.org/p?a=1&b=3", "listed.org", "/p", None, "allow"),
    ]
    df = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(urls)], "page_id bigint, url string, verdict string")
    listed = spark.createDataFrame([("listed.org/p?a=1&b=2",), (None,), ("listed.org/p?a=1&b=2",), ("",)], "url string")
    out = {r["page_id"]: tuple(r)[1:5] for r in url_filter.url_verdicts(df, listed).collect()}
    assert out == {i: u[1:] for i, u in enumerate(urls)}
    assert url_filter.url_verdicts(df.limit(0), listed).count() == 0
    assert url_filter.url_verdicts(df, listed.limit(0)).filter("verdict = 'block'").count() == 2
    assert url_filter.url_verdicts(df.union(df), listed).count() == 2 * len(urls)


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark, monkeypatch):
    listed = spark.range(20_000).select(F.concat(F.lit("host.org/"), "id").alias("canonical"))
    others = spark.range(20_000, 60_000).select(F.concat(F.lit("host.org/"), "id").alias("canonical"))
    n_blocks = -(-20_000 // url_filter.URLS_PER_BLOCK)
    blocks = url_filter.bloom_filter(listed, n_blocks).cache()
    assert blocks.count() <= n_blocks
    for limit in (url_filter.BROADCAST_BYTES, 0):  # broadcast, then joined by shuffle
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", limit)
        assert url_filter.possible_hits(listed, blocks, n_blocks).count() == 20_000
        assert url_filter.possible_hits(others, blocks, n_blocks).count() < 400
