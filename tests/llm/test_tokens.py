"""Token counts, byte-level BPE and packing against the tokenizer libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import ODD_TEXTS, prose
from tokenizers import Tokenizer

from tephra.llm import bpe, packing, token_count
from tephra.llm import tokenization as T
from tephra.llm.queries import op4_token_counts, op9_packing, op10_bpe

SF = "/root/testdata/sf0.001"
COUNTER = public_tokenizers.path(token_count.TOKENIZER)
RANKS = public_tokenizers.path(bpe.RANKS)
WORDS = public_tokenizers.path(packing.TOKENIZER)
PIECES = st.sampled_from(
    ["a", "'", "s", "'s", "'ll", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "B", "1", "23", "-", "#!", "é", "中", "\U0001f600"]
    + ["the", " of", "<|endoftext|>", "_", "́", "Σ", "İ", "ǅ", "²", "Ⅰ", "﻿", "​"]
)
TEXTS = st.lists(PIECES, max_size=40).map("".join)


def texts_of(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_count_equals_the_library(text):
    assert token_count.count_tokens(text, COUNTER) == len(Tokenizer_of(COUNTER).encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_rank_encoding_equals_the_library(text):
    ids = list(array("i", bpe.encode_text(text, RANKS)))
    assert ids == T.rank_encoding(RANKS).encode_ordinary(text)
    assert T.rank_encoding(RANKS).decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_word_ids_equal_the_library(text):
    expected = Tokenizer_of(WORDS).encode(text, add_special_tokens=False).ids + [1]
    assert list(array("I", packing.token_ids(text, WORDS))) == expected


_LOADED: dict[str, Tokenizer] = {}


def Tokenizer_of(path):
    if path not in _LOADED:
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def test_whole_tokens_encode_alone_as_one_token():
    whole = token_count.whole_tokens(COUNTER)
    assert len(whole) > 40_000
    tok = Tokenizer_of(COUNTER)
    for s in random.Random(1).sample(sorted(whole), 500):
        assert len(tok.encode(s).ids) == 1 and T.PRETOKEN.fullmatch(s)


@pytest.mark.parametrize("path", [COUNTER, WORDS])
def test_every_token_comes_out_whole_when_merged_alone(path):
    """The premise of merging by ranks instead of by the listed pairs."""
    assert T.unreachable(path) == []


def test_merging_by_ranks_equals_the_library():
    rng = random.Random(5)
    vocabulary = [s for s in token_count.whole_tokens(COUNTER)]
    merge, words = T.merge(COUNTER), packing.word_ids(WORDS)
    for _ in range(3000):
        text = "".join(rng.choices(vocabulary, k=rng.randint(1, 5)))
        for p in T.PRETOKEN.findall(text):
            assert merge(p.encode()) == Tokenizer_of(COUNTER).encode(p, add_special_tokens=False).ids
        for run in T.words(text):
            assert list(array("I", words[run])) == Tokenizer_of(WORDS).encode(run, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXTS), max_size=6), st.sampled_from([1, 5, 4_000_000]))
def test_slices_of_texts_equal_the_library(texts, chars):
    slices, packing.SLICE_CHARS = packing.SLICE_CHARS, chars
    try:
        got = [list(array("I", ids)) for ids in packing.batch_ids(texts, WORDS)]
    finally:
        packing.SLICE_CHARS = slices
    assert got == [Tokenizer_of(WORDS).encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_made_up_words_are_merged_together(monkeypatch):
    """A word that is new costs no call of its own."""
    rng = random.Random(8)
    ends = ["", ",", "'s", "...42", "\u4e2d", "\u0130"]
    made_up = ["".join(rng.choices("abcdeo\u00e9\u00f1RST", k=12)) + e for e in ends for _ in range(500)]
    texts = [" ".join(rng.sample(made_up, 400)) for _ in range(20)]
    calls = []
    word_ids = packing.word_ids(WORDS)
    compute = word_ids.compute
    monkeypatch.setattr(word_ids, "compute", lambda run: calls.append(run) or compute(run))
    rows = packing.batch_ids(texts, WORDS)
    expected = [Tokenizer_of(WORDS).encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert [list(array("I", ids)) for ids in rows] == expected
    assert all(run.endswith("\u4e2d") for run in calls)


def test_memory_stays_bounded(monkeypatch):
    monkeypatch.setattr(T, "MEMORY_ENTRIES", 10)
    memory = T.Memory(len)
    assert [memory[str(i)] for i in range(100)] == [len(str(i)) for i in range(100)]
    assert memory["x" * 100] == 100 and len(memory) <= 10 and "x" * 100 not in memory


def test_op4_equals_the_library(spark):
    tok = Tokenizer_of(COUNTER)
    texts = texts_of(spark)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in op4_token_counts(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert got[i] == (len(t.encode()), n, n > 1024)


def test_op4_odd_rows(odd_docs, no_docs):
    got = sorted(map(tuple, token_count.token_counts(odd_docs).collect()), key=str)
    tok = Tokenizer_of(COUNTER)
    want = []
    for r in odd_docs.select("doc_id", "text").collect():
        n = len(tok.encode(r["text"] or "", add_special_tokens=False).ids)
        want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)
    assert token_count.token_counts(no_docs).count() == 0


def test_op10_equals_the_library(spark):
    enc = T.rank_encoding(RANKS)
    texts = texts_of(spark)
    for r in op10_bpe(spark, SF).collect():
        t = texts.pop(r["doc_id"])
        ids = enc.encode_ordinary(t)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert not texts


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 32), (40, 8), (16, 16)])
def test_op10_chunks_stitch(spark, chunk, overlap):
    """Small chunks: every text is cut, contractions and white space meet the seams, some texts are stuck."""
    rng = random.Random(chunk)
    parts = ["it's", "we'll", " ", "  ", "\n\n", " x", "1234", "---", "中文", "they've", "été", "'", "''s"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 200))) for _ in range(150)]
    texts += ["y" * 500, "z" * 500 + " end", " " * 300, "", None, prose(3, 300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    enc = T.rank_encoding(RANKS)
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(df, chunk=chunk, overlap=overlap).collect()}
    for i, t in enumerate(texts):
        assert got[i] == enc.encode_ordinary(t or ""), (i, t)


def test_op10_odd_rows(odd_docs, no_docs):
    enc = T.rank_encoding(RANKS)
    got = sorted((str(r["doc_id"]), list(r["ids"])) for r in bpe.encode(odd_docs).select("doc_id", "ids").collect())
    rows = odd_docs.select("doc_id", "text").collect()
    assert got == sorted((str(r["doc_id"]), enc.encode_ordinary(r["text"] or "")) for r in rows)
    assert bpe.encode(no_docs).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        bpe.encode(no_docs, chunk=8, overlap=9)


# ---- packing ------------------------------------------------------------------------------


def simulate(counts: dict[int, int], capacity: int) -> int:
    """Check a plan as a set of sequences; their number."""
    plan = packing.make_plan(counts, capacity)
    sequences, used = defaultdict(list), defaultdict(int)
    for length, lo, n, first, width, at in plan.runs:
        assert lo == used[length]
        used[length] += n
        for r in range(n):
            sequences[first + r % width].append((at + r // width * length, length))
    assert dict(used) == {k: v for k, v in counts.items() if v}
    for placed in sequences.values():
        end = 0
        for at, length in sorted(placed):
            assert at == end
            end += length
        assert end <= capacity
    assert sorted(sequences) == list(range(plan.n_sequences))
    return plan.n_sequences


def fewest(items: list[int], capacity: int) -> int:
    """Exact minimum by search, for a few items."""
    items = sorted(items, reverse=True)
    best = len(items)

    def put(i: int, rooms: tuple[int, ...]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k, room in enumerate(rooms):
            if room >= items[i] and room not in rooms[:k]:
                put(i + 1, (*rooms[:k], room - items[i], *rooms[k + 1 :]))
        put(i + 1, (*rooms, capacity - items[i]))

    put(0, ())
    return best


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 40), max_size=20))
def test_plans_are_packings(counts):
    simulate(counts, 30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=10))
def test_reduction_keeps_the_minimum(items):
    """What the reduction fixes, plus the best packing of the rest, is the best packing of all."""
    counts = {x: items.count(x) for x in items}
    plan = packing.Plan()
    left = packing.reduce_dominated(counts, 20, plan)
    rest = [x for x, n in left.items() for _ in range(n)]
    assert plan.n_sequences + fewest(rest, 20) == fewest(items, 20)


def test_lengths_out_of_range():
    with pytest.raises(ValueError, match="lengths"):
        packing.make_plan({5: 1}, 4)


def test_realistic_lengths_reach_the_bound():
    lengths = np.clip(np.random.default_rng(1).lognormal(6, 1, 50_000).astype(int), 2, 4096)
    values, n = np.unique(lengths, return_counts=True)
    bound = -(-int(lengths.sum()) // 4096)
    assert simulate(dict(zip(values.tolist(), n.tolist(), strict=True)), 4096) <= bound + 5


def check_rows(rows, texts, capacity):
    tok = Tokenizer_of(WORDS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    for i, t in texts.items():
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in own] == [
            (k, s, min(capacity, len(ids) - s)) for k, s in enumerate(range(0, len(ids), capacity))
        ]
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    total = 0
    for placed in by_sequence.values():
        end = 0
        for at, length in sorted(placed):
            assert at == end
            end += length
        assert end <= capacity
        total += end
    assert len(by_sequence) <= -(-total // capacity) * 1.05 + 1


def test_op9_equals_the_library(spark):
    check_rows(op9_packing(spark, SF).collect(), texts_of(spark), packing.CAPACITY)


def test_op9_small_capacity_and_odd_rows(spark, odd_docs, no_docs):
    texts = {i: t or "" for i, t in enumerate(ODD_TEXTS)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    check_rows(packing.pack(df, capacity=16, salts=2).collect(), texts, 16)
    assert packing.pack(odd_docs).select("doc_id").distinct().count() == len(ODD_TEXTS) + 2
    assert packing.pack(no_docs).count() == 0
