"""Voronoi top-k, periodic runs and the conversation trie against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tephra.llm import conversation_trie, periodic_runs, queries, voronoi_topk
from tests.conftest import SF_ORACLE, SF_SMALL, rows

# ---- top-k --------------------------------------------------------------------------------

def asked():
    return F.col("id") % 50 == 0



def brute_top_k(found, k=5):
    """``found``: distinct (id, vector) pairs of integers."""
    out = []
    for qid, q in found:
        if qid % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in found if (i, v) != (qid, q))
        out += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_on_the_given_table(spark):
    table = [r for r in rows(spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet"), "vec_id", "embedding") if r[1]]
    found = [(i, tuple(int(np.floor(256.0 * float(x))) for x in v)) for i, v in table]
    assert sorted(rows(queries.op11_voronoi_topk(spark, SF_ORACLE), "query_id", "rank", "vec_id", "score")) == brute_top_k(found)


def test_top_k_in_many_groups_parts_and_blocks(spark):
    """Clustered vectors of different norms, a third of all rows one vector, ties, zero vectors, odd lengths."""
    rng = random.Random(5)
    centres = [[rng.gauss(0, 200) for _ in range(6)] for _ in range(12)]
    found = []
    for i in range(900):
        c = rng.choice(centres)
        v = (7, -3, 2, 0, 1, 5) if i % 3 == 0 else tuple(int(x + rng.gauss(0, 15)) for x in c)
        found.append((i - 100, v[: rng.choice([6, 6, 6, 4])] if i % 7 == 0 else v))
    found += [(2000, (0,) * 6), (2001, ()), (2050, (0,) * 6), (2050, (1,) * 6)]
    df = spark.createDataFrame(found, "id bigint, vec array<bigint>")
    df = df.union(df.limit(40)).withColumn("score", F.lit("clash")).withColumn("group", F.lit(1))
    got = voronoi_topk.top_k(df, asked(), group_queries=3, block_rows=60, n_pivots=9, max_sample=500)
    full = [(i, v + (0,) * (6 - len(v))) for i, v in found]
    assert sorted(rows(got, "query_id", "rank", "id", "score")) == brute_top_k(full)


def test_the_bounds_leave_rows_out():
    """Tight clusters: most classes are not sent to a group, and no needed one is missing."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, 16)) * 1000
    data = np.rint(centres[rng.integers(0, 8, 800)] + rng.standard_normal((800, 16)) * 20).astype(np.int64)
    cells = voronoi_topk.learn_cells(data, 8, rng)
    cell, angle, length = cells.locate(data)
    asked = data[:40]
    scores = asked @ data.T
    floor = np.sort(scores, axis=1)[:, -6]
    q_length, q_angle = cells.angles(asked)
    counts = {int(c): int((cell[:40] == c).sum()) for c in np.unique(cell[:40])}
    weakest = {c: float((floor / q_length)[cell[:40] == c].min()) for c in counts}
    nearest = np.full((8, 8), np.inf)
    for c in counts:
        nearest[c] = q_angle[cell[:40] == c].min(axis=0)
    groups = voronoi_topk.make_groups(cells, counts, weakest, nearest, 5)
    wanted = groups.wanting(cell, angle, length)
    assert wanted.mean() < 0.6
    for q in range(40):
        assert wanted[scores[q] >= floor[q], groups.of_cell[cell[q]]].all()


def test_top_k_odd_vectors(spark):
    big = float(2**60)
    table = [
        (0, [0.5, -0.25], 1), (1, [0.5, -0.25], 1), (50, None, 1), (100, [1.0, None], 1), (150, [float("nan"), 1.0], 1),
        (200, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (2, [big, big], 1), (250, [big, -big], None), (3, [-0.001, 0.0], 2),
    ]
    df = spark.createDataFrame(table, "vec_id bigint, embedding array<double>, label int")
    got = sorted(rows(voronoi_topk.search(df, asked())))
    top, low = (1 << 63) - 1, -(1 << 63)
    huge = {i: [min(top, max(low, int(np.floor(256.0 * x)))) for x in v] for i, v, _ in table
            if i in (0, 1, 2, 250, 3)}
    want = []
    for q in (0, 250):
        s = sorted((-min(top, max(low, sum(a * b for a, b in zip(huge[q], huge[i])))), i) for i in huge if i != q)
        want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:5])]
    assert got == sorted(want)
    assert rows(voronoi_topk.search(df.limit(0), asked())) == []
    assert rows(voronoi_topk.search(df.filter("vec_id = 1"), asked())) == []
    assert rows(voronoi_topk.search(df.filter("vec_id = 0"), asked())) == []


# ---- periodic runs ------------------------------------------------------------------------


def brute_runs(w, least=24, exponent=3):
    out = set()
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            smaller = (p for p in range(1, q) if all(w[x] == w[x + p] for x in range(i, i + size - p)))
            if j > i and size >= max(least, exponent * q) and next(smaller, None) is None:
                out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng, n):
    k, w = rng.choice([1, 2, 3, 5]), []
    while len(w) < n:
        if rng.random() < 0.6:
            p = [rng.randint(1, k) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 20, 31, 33, 40]))]
            w += (p * rng.randint(1, 9))[: rng.randint(1, 300)]
        else:
            w += [rng.randint(1, 50) for _ in range(rng.randint(1, 30))]
    return w


def test_the_transform_is_exact():
    rng = np.random.default_rng(0)
    x = rng.integers(0, periodic_runs.PRIME, (3, 64)).astype(np.uint64)
    assert (periodic_runs.inverse_ntt(periodic_runs.ntt(x)) == x).all()
    blocks, windows = (rng.integers(1, 5, s).astype(np.uint64) for s in ((4, 8), (4, 22)))
    want = [[int(((t[k : k + 8].astype(int) - b.astype(int)) ** 2).sum()) for k in range(15)] for b, t in zip(blocks, windows)]
    assert periodic_runs.mismatches(blocks, windows).tolist() == want


def test_runs_equal_brute_force():
    rng, n = random.Random(2), 0
    for size in [0, 1, 23, 24, 25, *[30, 80, 200, 500] * 60]:
        w = periodic_words(rng, size)[: size or 0]
        want = brute_runs(w)
        assert periodic_runs.find_runs(np.array(w, np.int64)) == want
        n += len(want)
    assert n > 200
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.ones(9, np.int64), min_exponent=2)


def test_runs_of_several_texts_do_not_mix():
    rng = random.Random(4)
    texts = [[b"w%d" % x for x in periodic_words(rng, rng.choice([5, 60, 200]))] for _ in range(40)]
    texts[3:3] = [[], texts[0], [b"a"] * 30, [b"a"] * 30]
    assert periodic_runs.runs_of_texts(texts) == [brute_runs(t) for t in texts]


def test_long_runs_take_linear_time():
    n = 300_000  # over 1 MB of text
    assert periodic_runs.find_runs(np.ones(n, np.int64)) == [(0, n, 1)]
    period = n // 5
    w = np.resize(np.arange(1, period + 1), n)
    assert periodic_runs.find_runs(w) == [(0, n, period)]


def brute_row(doc_id, text):
    w = [x for x in (text or "").encode().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if x]
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w) if n < 1200 else periodic_runs.runs_of_texts([w])[0]
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = (None,) * 4
    if runs:
        s, m, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, m, q, 1000 * m // q)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    short = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(short).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_run_query_equals_brute_force(spark):
    docs = rows(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id", "text")
    got = rows(queries.op12_periodic_runs(spark, SF_SMALL), *COLUMNS)
    want = [brute_row(*d) for d in docs]
    assert sorted(got) == sorted(want)
    assert sum(r[1] for r in want) > 5


def test_runs_of_odd_documents(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("runs", F.lit("clash")).withColumn("_found", F.lit("clash"))
    docs = docs.union(docs.limit(1).withColumn("text", F.lit("to be or " * 30)))
    found = periodic_runs.find(docs)
    assert set(found.columns) == {*docs.columns, "collapsed"}
    texts = dict(rows(found, "text", "collapsed"))
    assert texts[None] == texts[""] == texts["\n\t \r\n"] == ""
    assert texts["to be or " * 30] == "to be or"
    assert found.count() == docs.count()
    assert periodic_runs.find(no_docs).collect() == []


# ---- conversation trie --------------------------------------------------------------------


def brute_trie(turns):
    """``turns``: conversation -> tuple of (role, text)."""
    members, kids = defaultdict(list), defaultdict(list)
    for c, s in turns.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids[s]) or 1
        saved[s] = sum(saved[k] for k in kids[s]) + (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0)
    out = []
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(turns[c]) == len(s))
        parent = min(members[s[:-1]]) if s else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(s), parent, len(m), len(kids[s]), leaves[s], saved[s], digest))
    return sorted(out, key=repr)


def ordered(table):
    found = defaultdict(list)
    for c, turn, role, text in table:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: tuple((r, x) for _, _, r, x in sorted(v, key=lambda t: t[:2])) for c, v in found.items()}


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, ())[:h] + own[h:]
    return out


TRIE = ("conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends")
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_trie_query_equals_brute_force(spark, sf):
    table = rows(spark.read.parquet(f"{sf}/conversations.parquet"), "conv_id", "turn", "role", "text")
    got = [tuple(r) for r in queries.op13_conversation_trie(spark, sf).collect()]
    assert sorted(got, key=repr) == brute_trie(rebuilt(ordered(table)))


def random_turns(seed, n):
    rng = random.Random(seed)
    table, kept = [], []
    for c in range(n):
        s = list(rng.choice(kept)[: rng.randint(0, 9)]) if kept and rng.random() < 0.8 else []
        s += [(rng.choice("ua"), rng.choice("xyzß") * rng.randint(0, 2)) for _ in range(rng.randint(0, 4))]
        kept.append(s)
        table += [(c, None if i == 0 and c % 2 else i, r, x) for i, (r, x) in enumerate(s)]
    # A third of all conversations are one and the same, over several chunks of ids.
    table += [(c, t, "u", f"copy {t}") for c in range(100_000, 100_000 + 9000, 1) for t in range(2)]
    return table


@pytest.mark.parametrize("block", [5, 40, 8192])
def test_trie_over_many_blocks_and_levels(spark, block):
    table = random_turns(block, 300)
    found = conversation_trie.sequences(spark.createDataFrame(table, CONVERSATIONS))
    got = [tuple(r) for r in conversation_trie.trie(found, block).select(*TRIE).collect()]
    assert sorted(got, key=repr) == brute_trie(ordered(table))


def test_trie_of_odd_conversations(spark):
    text = "long " * 300_000
    table = [
        (1, None, None, None), (1, 1, "user", "a"), (2, None, "", ""), (2, 1, "user", "a"), (2, 1, "user", "a"),
        (None, 0, "user", "a"), (7, 0, "us", "era"), (8, 0, "user", "a"), (9, 0, "user", text), (10, 5, "user", text),
        (-3, 0, "user", "a"),
    ]
    df = spark.createDataFrame(table, CONVERSATIONS).withColumn("depth", F.lit("clash")).withColumn("conv", F.lit("clash"))
    found = conversation_trie.sequences(df)
    got = [tuple(r) for r in conversation_trie.trie(found).select(*TRIE).collect()]
    assert sorted(got, key=repr) == brute_trie(ordered(table))
    assert conversation_trie.trie(conversation_trie.sequences(df.limit(0))).collect() == []


def test_rebuilt_conversations_may_have_no_turns(spark):
    """Conversation 4 loses its turns to a base that is not there; it ends at the root."""
    table = [(c, t, "user", f"{c}{t}") for c in (4, 6, 5, 12) for t in range(2)]
    got = queries.rebuilt(conversation_trie.sequences(spark.createDataFrame(table, CONVERSATIONS)))
    want = {c: len(s) for c, s in rebuilt(ordered(table)).items()}
    assert 0 in want.values()
    assert dict(rows(got.select("conv", F.size("turns")))) == want
