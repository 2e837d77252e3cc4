"""Parity-sketch join, ITQ near-duplicates, components and the pipeline against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import prose

from tephra.llm import itq_dedup, parity_join
from tephra.llm.components import components
from tephra.llm.queries import op6_itq_dedup, op7_parity_join

SF = "/root/testdata/sf0.001"


def roots(n, pairs):
    """Smallest index reachable, by union-find."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    pairs = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4:
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    pairs.append((i, j))
    return [len(s) for s in sets], roots(len(sets), pairs)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def corpus(seed):
    """Copies with edits around the limit, chains, shared passages, and texts of every small length."""
    rng = random.Random(seed)
    texts = [" ".join(f"w{rng.randrange(9)}" for _ in range(n)) for n in range(30) for _ in range(2)]
    passage = prose(99, 60).split()
    for size in (5, 8, 9, 10, 24, 60, 61, 150, 400):
        base = prose(rng.randrange(10**6), size).split()
        texts.append(" ".join(base).upper())
        for edits in (0, 1, 1, 2, 3, size // 50 + 1, size // 40 + 1, size // 25 + 1):
            texts.append("\n".join(edited(base, rng, edits)))
        texts += [" ".join(base[: size * k // 10]) for k in (7, 8, 9)]
        chain = base
        for _ in range(5):
            chain = edited(chain, rng, max(1, size // 45))
            texts.append(" ".join(chain))
        texts.append(" ".join(passage + base))
        texts.append(" ".join(passage + prose(rng.randrange(10**6), size).split()))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_op7_equals_brute_force(spark, seed):
    texts = [None, "", *corpus(seed)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    sizes, want = brute_components(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity_join.near_duplicates(df).collect()}
    assert got == {i: (sizes[i], want[i]) for i in range(len(texts))}
    assert len(set(want)) < len(want) - 20


def test_op7_whole_table(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    sizes, want = brute_components([r["text"] for r in rows])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op7_parity_join(spark, SF).collect()}
    assert got == {r["doc_id"]: (sizes[i], rows[want[i]]["doc_id"]) for i, r in enumerate(rows)}


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 10**6))
def test_linked_sets_share_a_key_and_pass_the_sketch(common, more_a, more_b, seed):
    pool = np.unique(np.random.default_rng(seed).integers(0, 2**63, common + more_a + more_b, dtype=np.uint64))
    a = np.sort(pool[: common + more_a])
    b = np.sort(np.concatenate([pool[:common], pool[common + more_a :]]))
    difference = len(np.setxor1d(a, b))
    bits = min(parity_join.sketch_bits(len(x)) for x in (a, b) if len(x))
    one, two = (parity_join.dense_sketch(x, bits).view(np.uint64) for x in (a, b))
    assert int(np.bitwise_count(one ^ two).sum()) <= difference
    if parity_join.linked(a, b):
        assert 9 * difference <= len(a) + len(b)
        shared = np.intersect1d(parity_join.join_keys(a), parity_join.join_keys(b))
        least = min(parity_join.n_shared(len(a)), parity_join.n_shared(len(b)))
        assert len(shared) >= least or np.array_equal(a, b)


def test_op7_odd_rows(spark, odd_docs, no_docs):
    out = parity_join.near_duplicates(odd_docs)
    rows = out.collect()
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[11]["component_id"] == 10 and by_id[0]["component_id"] == 0 and by_id[1]["component_id"] == 1
    assert by_id[None]["component_id"] is None
    kept = parity_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(r["doc_id"]) for r in odd_docs.collect() if r["doc_id"] != 11
    )
    assert parity_join.near_duplicates(no_docs).count() == 0 and parity_join.keep_one(no_docs).count() == 0


def test_op7_id_with_two_texts_is_linked_through_both(spark):
    rng = random.Random(8)
    one, two, three = (prose(s, 300).split() for s in (21, 22, 23))
    rows = [(1, one), (5, one), (5, two), (7, edited(two, rng, 3)), (2, three), (3, one), (3, three), (9, edited(three, rng, 3))]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows] + [(4, prose(24, 300))], "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in parity_join.near_duplicates(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 7: 1, 9: 1}
    assert sorted(r["doc_id"] for r in parity_join.keep_one(df).collect()) == [1, 4]


def test_shuffled_ids_give_the_same(spark, monkeypatch):
    texts = corpus(3)[:80]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    one = sorted(map(tuple, parity_join.near_duplicates(df).collect()))
    monkeypatch.setattr(parity_join, "BROADCAST_IDS", 0)
    assert sorted(map(tuple, parity_join.near_duplicates(df).collect())) == one


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, pairs):
    want = roots(31, pairs)
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {i: want[i] for a, b in pairs if a != b for i in (a, b)}


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1300)}


# ---- embeddings ---------------------------------------------------------------------------


def brute_vectors(rows):
    """n_links and component by row number, with all pairs."""
    n = len(rows)
    links, pairs = [0] * n, []
    unit = []
    for _, vec, label in rows:
        ok = vec and label is not None and all(x is not None and np.isfinite(x) for x in vec) and any(vec)
        x = np.array(vec, float) if ok else None
        unit.append(None if x is None else x / np.linalg.norm(x))
    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= 0.98:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    return links, roots(n, pairs)


def clustered(seed, n, dim):
    rng = np.random.default_rng(seed)
    rows, base = [], None
    for i in range(n):
        if i % 5 == 0:
            base = rng.standard_normal(dim)
        noise = rng.choice([0.0, 0.05, 0.1, 0.15, 0.2]) * rng.standard_normal(dim)
        rows.append((i, (base + noise).astype(np.float32).tolist(), int(i // 5 % 3)))
    return rows


SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("dim", [8, 64, 100])
def test_op6_recall_and_precision(spark, dim):
    rows = clustered(dim, 1200, dim)
    want_links, want = brute_vectors(rows)
    got = {r["vec_id"]: r for r in itq_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(want_links) > 300
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= want_links[i] for i in range(len(rows)))  # none below the limit
    assert found >= 0.97 * sum(want_links)
    same = sum(got[i]["component_id"] == want[i] for i in range(len(rows)))
    assert same >= 0.97 * len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_op6_code_grows_with_the_rows():
    """Wider parts keep the buckets small, more tables keep the recall."""
    assert itq_dedup.code_shape(0) == itq_dedup.code_shape(60_000) == itq_dedup.CodeShape(16, 4)
    shapes = [itq_dedup.code_shape(1 << n) for n in range(17, 45)]
    assert [s.part_bits for s in shapes] == [min(n, 32) for n in range(17, 45)]
    assert all(a.parts <= b.parts for a, b in zip(shapes, shapes[1:], strict=False)) and shapes[-1].parts < 12
    rng = np.random.default_rng(1)
    for shape in (shapes[0], shapes[7], shapes[-1]):
        flips = rng.random((4000, shape.parts, shape.part_bits)) < np.arccos(0.98) / np.pi
        met = (flips.sum(axis=2) <= 1).any(axis=1)
        assert met.mean() >= 0.98 and (flips.sum(axis=(1, 2)) <= shape.max_bits).mean() > 0.999
    assert itq_dedup.code_shape(10, 1.0).parts == 4


@pytest.mark.parametrize("width", [17, 24, 32])
def test_op6_recall_with_wide_parts(spark, monkeypatch, width):
    """Codes of several words, as a table of 2^width vectors would have."""
    monkeypatch.setattr(itq_dedup, "MIN_PART_BITS", width)
    rows = clustered(width, 800, 64)
    want_links, want = brute_vectors(rows)
    got = {r["vec_id"]: r for r in itq_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i]["n_links"] <= want_links[i] for i in range(len(rows)))
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(want_links) > 200
    assert sum(got[i]["component_id"] == want[i] for i in range(len(rows))) >= 0.97 * len(rows)


def test_op6_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (0, v, 1), (1, v, 1), (1, v, 1), (2, [2.0, 4.0, 6.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1),
        (7, [0.0, -0.0, 0.0], 1), (8, [None, 1.0, 2.0], 1), (9, [float("nan"), 1.0, 2.0], 1), (10, [float("inf"), 1.0, 2.0], 1),
        (11, [1.0, 2.0], 1), (12, [3e38, 3e38, 3e38], 3), (13, [1e-30, 1e-30, 1e-30], 3), (14, [0.0, 1.0], 4), (15, [-0.0, 1.0], 4),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA + ", n_links string")
    out = itq_dedup.near_duplicates(df)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out.collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    linked = [(0, 3, 0, True), (1, 3, 0, False), (1, 3, 0, False), (2, 3, 0, False)]
    pairs = [(12, 1, 12, True), (13, 1, 12, False), (14, 1, 14, True), (15, 1, 14, False)]
    assert got == sorted(alone + linked + pairs)
    assert itq_dedup.near_duplicates(df.limit(0)).count() == 0


def test_op6_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    links, want = brute_vectors(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op6_itq_dedup(spark, SF).collect()}
    assert got == {r[0]: (links[i], rows[want[i]][0]) for i, r in enumerate(rows)}


# ---- pipeline -----------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    from tephra.llm import compression_rules, secret_scan
    from tephra.llm.common import written

    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], sf), f"test-{name}"))
        if name != "packing":
            assert seen[-1].schema == docs.schema, name
    ids = [sorted(r["doc_id"] for r in d.select("doc_id").collect()) for d in seen]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert ids[1] == [i for i in ids[0] if compression_rules.judge(texts[i])["kept"]]
    assert set(ids[2]) < set(ids[1])
    _, group = brute_components([texts[i] for i in ids[2]])
    assert ids[3] == sorted({ids[2][g] for g in group}) and len(ids[3]) < len(ids[2])
    assert ids[4] == ids[3]
    import public_tokenizers

    path = public_tokenizers.path(secret_scan.RANKS)
    masked = {r["doc_id"]: r for r in seen[4].collect()}
    for i, r in masked.items():
        assert r["text"] == secret_scan.masked(texts[i], path)
    assert sorted(set(ids[5])) == ids[4]
    run = corpus_pipeline.run(spark, sf)
    assert run.select("doc_id", "piece", "length", "ids_crc32").exceptAll(
        seen[5].select("doc_id", "piece", "length", "ids_crc32")
    ).count() == 0
