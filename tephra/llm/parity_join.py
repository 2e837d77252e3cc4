"""N-gram Jaccard join by parity sketches.

A document is its set of five-word shingles. Linked sets (Jaccard >= 80 / 100) of sizes
a and b differ in at most (a + b) / 9 shingles, so a set of size a differs from any
partner in at most D = a // 4.

*Parity sketch.* Hash every shingle to one cell of a long bit vector and flip that bit
(XOR). Each shingle in one set only changes one cell, so the Hamming distance of two
sketches is a lower bound of the symmetric difference. The same holds for whole blocks:
at most D blocks of cells differ.

*Pigeonhole join per size band.* In a band all sketches have n blocks of 2^32 cells; a
block is kept as the XOR of its shingles' 64-bit hashes (equal when its cells are).
Linked sets agree on n - D blocks or more. With all blocks put into one order (blocks of
many shingles first), the first k blocks on which two sets agree are among the first
D + k of each: those are a document's join keys, and documents that share fewer than k
drop out. A pair belongs to the band of its smaller set, so a document near a band's
lower end emits keys for two bands.

*Verify.* Per key, each document first meets the smallest id only; links give first
components. Documents of keys that still span components are contested. Among those the
sketch is joined at full resolution, a cell per shingle, rarest shingles first: a set
needs only its size - ceil(0.8 size) + 1 rarest ones, and shingles that no other contested
set has count against a pair as they stand. The join's condition holds the bounds on
sizes, on these single shingles and on the dense sketches, so only near pairs leave it;
those are tested on the sets. So components are exact, large groups of copies cost one
test each, and heavily edited copies of one text are not paired with each other.

Null text counts as empty. Documents without words link with nothing; fewer than five
words are one shingle. Rows with the same id are one node, linked through any of their
texts; rows with a null id link with nothing and have a null component.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tephra.llm.common import free_name, setup, text_or_empty, written
from tephra.llm.components import components

N = 5
NUMERATOR, DENOMINATOR = 80, 100
FIRST_BAND = 4  # smaller sets link with equal sets only
BAND_RATIO = 2.5
BLOCKS_PER_SIZE = 1.2  # blocks of a band per shingle of its smallest set
MORE_KEYS = 8  # k - 1 is this part of the largest difference
SKETCH_BITS_PER_SHINGLE = 2
LEAST_SKETCH_BITS = 512
# Ids up to this number are broadcast to fetch their texts; more are joined by shuffle.
BROADCAST_IDS = 500_000

_U = np.uint64


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """Finalizer of a 64-bit hash (xor-shift and multiply)."""
    x = x + _U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < N:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    h = np.zeros(len(words) - N + 1, np.uint64)
    for i in range(N):
        h = h * _U(0x9E3779B97F4A7C15) + _mix(w[i : i + len(h)], i + 1)
    return np.unique(_mix(h, 99))


def max_difference(size: int) -> int:
    """Largest symmetric difference of a set of this size and a linked one."""
    return size // 4


def n_shared(size: int) -> int:
    """k: keys that a set of this size, or a larger one, shares with every linked set of its size or more."""
    return 1 + max_difference(size) // MORE_KEYS


def least_partner(size: int) -> int:
    return -(-NUMERATOR * size // DENOMINATOR)


@functools.cache
def band_starts() -> tuple[int, ...]:
    starts = [FIRST_BAND]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_RATIO)))
    return tuple(starts)


def band_of(size: int) -> int:
    return int(np.searchsorted(band_starts(), size, side="right")) - 1


def bands(size: int) -> list[int]:
    """The bands of a set: its own, and that of its smallest possible partner."""
    if size < FIRST_BAND:
        return []
    return sorted({band_of(max(FIRST_BAND, least_partner(size))), band_of(size)})


def n_blocks(band: int) -> int:
    """At least as many blocks as any member has keys (members reach 5/4 of the next band's start)."""
    start, largest = band_starts()[band], 5 * band_starts()[band + 1] // 4
    return max(math.ceil(BLOCKS_PER_SIZE * start), max_difference(largest) + n_shared(largest))


def join_keys(hashes: np.ndarray) -> np.ndarray:
    """The keys of a set, for all its bands."""
    size, out = len(hashes), []
    for band in bands(size):
        n = n_blocks(band)
        cell = _mix(hashes, 1000 + band)
        block = ((cell >> _U(32)) * _U(n)) >> _U(32)
        order = np.argsort(block, kind="stable")
        block = block[order]
        first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        content = np.bitwise_xor.reduceat(cell[order], first)
        count = np.diff(np.append(first, size))
        key = _mix(content ^ _mix(block[first], 7), 2000 + band)
        wanted = max_difference(size) + n_shared(size)
        ranked = np.lexsort((key, -count))[:wanted]
        out.append(key[ranked])
        if len(ranked) < wanted:  # too few blocks have shingles: the empty ones come last in the order
            empty = np.setdiff1d(np.arange(n, dtype=np.uint64), block[first])
            out.append(np.sort(_mix(_mix(empty, 7), 2000 + band))[: wanted - len(ranked)])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def sketch_bits(size: int) -> int:
    """A power of two; those of linked sets differ by a factor of two at most."""
    return max(LEAST_SKETCH_BITS, 1 << math.ceil(math.log2(SKETCH_BITS_PER_SHINGLE * max(size, 1))))


def dense_sketch(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Parity bits of a power-of-two number of cells, as 64-bit words."""
    flips = np.bincount((hashes & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) > 0 and DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


# ---- Spark stages -------------------------------------------------------------------------

SIGNATURE = "id bigint, n bigint, fp1 bigint, fp2 bigint"


def _as_long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
    flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, fp1, fp2 = [], [], []
        for text in batch.column(1):
            h = shingles(text.as_py())
            n.append(len(h))
            fp1.append(_as_long(int(np.bitwise_xor.reduce(_mix(h, 3)))) if len(h) else 0)
            fp2.append(_as_long(int(np.add.reduce(_mix(h, 4)))) if len(h) else 0)
        columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, fp1, fp2))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n", "fp1", "fp2"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, id); straight to the shuffle, some documents at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            found = [join_keys(shingles(t.as_py())) for t in part.column(1)]
            ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(k) for k in found])
            keys = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids, pa.int64())], ["key", "id"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return written(_texts(docs, id_col, text_col).mapInArrow(_signatures, SIGNATURE), "parity-signatures")


def shared_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, id`` of every key that two rows or more have: rows with a neighbour in the order of the key's ids."""
    rows = _texts(docs, id_col, text_col).filter("id is not null").mapInArrow(_keys, "key bigint, id bigint")
    of_key = Window.partitionBy("key").orderBy("id")
    beside = F.coalesce(F.lag("id").over(of_key), F.lead("id").over(of_key))
    return rows.withColumn("beside", beside).filter("beside is not null").select("key", "id")


def _texts_of(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text`` of the named documents."""
    ids = written(ids.select("id").distinct(), "parity-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return _texts(docs, id_col, text_col).join(ids, "id", "left_semi")


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs that are links, tested on the shingle sets. Texts are moved, not sets: they compress."""

    def test(a: pa.Array, b: pa.Array) -> pa.Array:
        ok = [linked(shingles(x.as_py()), shingles(y.as_py())) for x, y in zip(a, b, strict=True)]
        return pa.array(ok, pa.bool_())

    found = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs, id_col, text_col)
    one = found.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    two = found.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    ok = F.arrow_udf(test, "boolean").asNondeterministic()("ta", "tb")
    tested = pairs.join(two, "b").join(one, "a").withColumn("ok", ok)
    return written(tested.filter("ok").select("a", "b").distinct(), "parity-links")


def _first_meetings(shared: DataFrame) -> DataFrame:
    """Each document with the smallest id that it shares a key with."""
    hubs = shared.groupBy("key").agg(F.min("id").alias("hub"))
    met = shared.join(hubs, "key").filter("id != hub")
    return met.groupBy(F.col("id").alias("b")).agg(F.min("hub").alias("a")).select("a", "b")


def _contested(shared: DataFrame, group: DataFrame) -> DataFrame:
    """``id, component`` of the documents of keys whose documents are in different components."""
    members = shared.join(group.withColumnRenamed("node", "id"), "id", "left")
    members = members.select("key", "id", F.coalesce("component", "id").alias("component"))
    split = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return members.join(split.select("key"), "key", "left_semi").select("id", "component").distinct()


def _folded(long: Column, short: Column) -> Column:
    """A sketch folded onto the length of a shorter one: cell numbers modulo that length."""
    half = F.size(short)
    return F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def _distance(a: Column, b: Column) -> Column:
    """Hamming distance of two sketches."""
    more = F.size(a) - F.size(b)
    left = F.when(more > 0, _folded(a, b)).otherwise(a)
    right = F.when(more < 0, _folded(b, a)).otherwise(b)
    words = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(words, F.lit(0), lambda acc, x: acc + x)


def _near_contested(contested: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of contested documents of different components that can be links."""

    def prepare(batch: pa.Array) -> pa.Array:
        found = [shingles(t.as_py()) for t in batch]
        sketches = [dense_sketch(h, sketch_bits(len(h))) for h in found]
        return pa.StructArray.from_arrays([_lists(found), _lists(sketches)], ["set", "sketch"])

    made = F.arrow_udf(prepare, "struct<set:array<bigint>,sketch:array<bigint>>").asNondeterministic()
    rows = texts.select("id", made("text").alias("p")).select("id", F.size("p.set").alias("n"), "p.*")
    rows = written(rows, "parity-contested")
    tokens = rows.select("id", F.explode("set").alias("token"))
    frequent = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    held = tokens.join(frequent, "token").groupBy("id").agg(F.collect_list(F.struct("df", "token")).alias("held"))
    held = held.join(rows.select("id", "n", "sketch"), "id").join(contested, "id")
    # Single shingles come first in the order; what is left of the prefix goes to the rarest others.
    single = F.col("n") - F.size("held")
    prefix = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + 1 - F.col("single")
    rarest = F.transform(F.slice(F.sort_array("held"), F.lit(1), F.col("prefix").cast("int")), lambda x: x["token"])
    kept = held.withColumn("single", single).withColumn("prefix", prefix).filter("prefix > 0")
    kept = written(kept.select("id", "component", "n", "single", "sketch", rarest.alias("rarest")), "parity-prefixes")
    one, two = (kept.select(*(F.col(c).alias(f"{c}_{x}") for c in kept.columns)) for x in "ab")
    one = one.withColumn("token_a", F.explode("rarest_a")).drop("rarest_a")
    two = two.withColumn("token_b", F.explode("rarest_b")).drop("rarest_b")
    a, b = (lambda c: F.col(f"{c}_a")), (lambda c: F.col(f"{c}_b"))
    both = a("n") + b("n")
    near = (
        (a("token") == b("token"))
        & (a("id") < b("id"))
        & (a("component") != b("component"))
        & (DENOMINATOR * F.least(a("n"), b("n")) >= NUMERATOR * F.greatest(a("n"), b("n")))
        & (9 * (a("single") + b("single")) <= both)
        & (9 * _distance(a("sketch"), b("sketch")) <= both)
    )
    return one.join(two, near).select(a("id").alias("a"), b("id").alias("b")).distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and links (``a``, ``b``) that connect every group of near-duplicates."""
    setup(docs.sparkSession)
    sig = signatures(docs, id_col, text_col)
    classes = sig.filter("n > 0 and id is not null").groupBy("fp1", "fp2", "n").agg(F.min("id").alias("rep"))
    same = sig.select("id", "fp1", "fp2", "n").join(classes, ["fp1", "fp2", "n"]).filter("id != rep")
    same = written(same.select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct(), "parity-same")
    # One document per set from here on, with as many shared keys as a link needs. An id with another text of its own stays.
    copies = same.select(F.col("b").alias("id")).join(classes.select(F.col("rep").alias("id")), "id", "left_anti")
    shared = written(shared_keys(docs, id_col, text_col).join(copies, "id", "left_anti"), "parity-shared")
    least = F.floor((F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) / 4).cast("int") / MORE_KEYS) + 1
    enough = shared.groupBy("id").agg(F.count(F.lit(1)).alias("n_keys")).join(sig.select("id", "n"), "id")
    enough = enough.filter(F.col("n_keys") >= least).select("id").distinct()
    shared = written(shared.join(enough, "id", "left_semi"), "parity-candidates")
    links = _verified(written(_first_meetings(shared), "parity-pairs"), docs, id_col, text_col)
    contested = written(_contested(shared, components(links)), "parity-open")
    texts = _texts_of(contested, docs, id_col, text_col)
    more = _verified(written(_near_contested(contested, texts), "parity-pairs"), docs, id_col, text_col)
    return sig, same.union(links).union(more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` for every row of ``docs``."""
    sig, links = join(docs, id_col, text_col)
    group = components(links).withColumnRenamed("node", "id")
    return sig.select("id", "n").join(group, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the smallest id stays.

    Of several rows with that id all stay; rows with a null id stay.
    """
    _, links = join(docs, id_col, text_col)
    name = free_name(docs, "_gone")
    gone = written(components(links).filter("node != component").select(F.col("node").alias(name)), "parity-gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col(id_col).cast("bigint") == F.col(name), "left_anti")
