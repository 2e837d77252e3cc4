"""Best-fit packing with dominance reduction, over the histogram of piece lengths.

Documents are tokenized by Spark tasks; only texts longer than a sequence are cut.
Lengths are at most the capacity (4096), so the whole bin-packing instance is a
histogram of that many counts, whatever the number of documents. On it the driver

1. fixes document sets that provably dominate every alternative (Martello and Toth):
   a length with which nothing else fits stays alone; a length and its exact
   complement; a length and its largest partner, if no two others fit beside it, or
   if no three fit and the best two together are no longer than that partner;
2. packs the remainder best-fit decreasing, whole groups of equal sequences at a time.

The plan is a list of *runs*: "the documents of length L with ranks lo.. go to the
sequences from s on, at offset o". Spark ranks the pieces of each length (salted, so
that a common length is spread) and joins the plan by length and rank.

Null text counts as empty (one token, the end id). Repeated rows are packed one by one.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tephra.llm import tokenization as T
from tephra.llm.common import setup, written

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
RANK_SALTS = 64

PIECE = pa.struct(
    [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


# ---- tokens -------------------------------------------------------------------------------


# This tokenizer's pre-tokens: contractions, letters, single digits, other characters (fixed pattern).
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Below this code point lower-casing and composition are the same in every Unicode version.
PLAIN_BELOW = "\u0250"
# Texts of so many characters are tokenized together (one text at least).
SLICE_CHARS = 4_000_000


@functools.cache
def word_ids(path: str) -> T.Memory:
    """Ids (little-endian 32-bit) by run of non-space characters.

    This tokenizer drops white space and matches nothing across it. Runs of plain
    letters are lower-cased, split and merged here; others go through the library.
    """
    tok, merge = T.json_tokenizer(path), T.merge(path)

    def ids(run: str) -> bytes:
        if max(run) >= PLAIN_BELOW:
            found = tok.encode(run, add_special_tokens=False).ids
        else:
            found = []
            for p in PRETOKEN.findall(run.lower()):
                found += merge(p.encode() + T.WORD_END)
        return struct.pack(f"<{len(found)}I", *found)

    return T.Memory(ids)


def token_ids(text: str | None, path: str, end_id: int = END_ID) -> bytes:
    """The document's ids, then the end id, as little-endian 32-bit numbers."""
    known, out = word_ids(path).__getitem__, []
    for i, part in enumerate(T.split_special(text or "", path)):
        if i % 2:
            out.append(struct.pack("<I", T.json_tokenizer(path).token_to_id(part)))
        else:
            out += map(known, T.words(part))
    return b"".join([*out, struct.pack("<I", end_id)])


def run_ids(runs: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of plain runs, one after the other, and where each run's ids end."""
    parts, last = [], []
    for run in " ".join(runs).lower().split(" ") if runs else []:
        if run.isalpha():
            parts.append(run)
        else:
            parts += PRETOKEN.findall(run)
        last.append(len(parts))
    encoding, ends = T.spaced_encoding(path)
    ids = encoding.encode_to_numpy("".join(p + " " for p in parts))
    upto = np.concatenate([[0], np.flatnonzero(ends[ids]) + 1])
    return ids, upto[np.array(last, np.int64)]


def slice_ids(texts: list[str], path: str, end_id: int = END_ID) -> list[bytes]:
    """``token_ids`` of texts without special strings: every different run is split and merged once, all in one call."""
    runs, counts = [], []
    for text in texts:
        found = T.words(text)
        runs += found
        counts.append(len(found))
    coded = pa.array(runs, pa.large_string()).dictionary_encode()
    different = coded.dictionary.to_pylist()
    plain, other = [], []
    for i, run in enumerate(different):
        (plain if run.isascii() or max(run) < PLAIN_BELOW else other).append(i)
    ids, stops = run_ids([different[i] for i in plain] if other else different, path)
    by_library = [np.frombuffer(word_ids(path)[different[i]], "<u4") for i in other]
    stops = np.concatenate([[0], stops, len(ids) + np.cumsum([len(a) for a in by_library], dtype=np.int64)])
    place = np.empty(len(different), np.int64)
    place[np.array(plain + other, np.int64)] = np.arange(len(different))
    lists = pa.LargeListArray.from_arrays(pa.array(stops, pa.int64()), pa.array(np.concatenate([ids, *by_library]), pa.uint32()))
    lists = lists.take(pa.array(place[coded.indices.to_numpy()]))
    found = lists.flatten().to_numpy().astype("<u4", copy=False)
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *counts])]
    end = struct.pack("<I", end_id)
    return [found[a:b].tobytes() + end for a, b in itertools.pairwise(ends.tolist())]


def batch_ids(texts: Iterable[str | None], path: str, end_id: int = END_ID) -> Iterator[bytes]:
    """``token_ids`` of every text, in order, by slices of bounded size."""
    waiting, chars = [], 0
    for text in texts:
        if len(T.split_special(text or "", path)) > 1:
            yield from slice_ids(waiting, path, end_id)
            waiting, chars = [], 0
            yield token_ids(text, path, end_id)
            continue
        waiting.append(text or "")
        chars += len(waiting[-1])
        if chars >= SLICE_CHARS:
            yield from slice_ids(waiting, path, end_id)
            waiting, chars = [], 0
    yield from slice_ids(waiting, path, end_id)


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """``piece, start, length, ids_crc32`` of at most ``capacity`` tokens each."""
    view = memoryview(ids)
    parts = (view[at : at + 4 * capacity] for at in range(0, len(ids), 4 * capacity))
    return [(k, k * capacity, len(part) // 4, zlib.crc32(part)) for k, part in enumerate(parts)]


def pieces(
    docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    def batch(texts: pa.Array) -> pa.Array:
        names = PIECE.names
        found = [cut(ids, capacity) for ids in batch_ids((t.as_py() for t in texts), path, end_id)]
        return pa.array([[dict(zip(names, p, strict=True)) for p in doc] for doc in found], pa.list_(PIECE))

    tokenized = F.arrow_udf(batch, PIECES).asNondeterministic()(F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), F.explode(tokenized).alias("p")).select("id", "p.*")


# ---- the plan on the histogram ------------------------------------------------------------


@dataclass
class Plan:
    """Runs: ``n`` documents of ``length`` from rank ``lo``, ``width`` sequences from ``first``.

    The document of rank ``lo + r`` goes to sequence ``first + r % width``, at
    ``offset + (r // width) * length``.
    """

    n_sequences: int = 0
    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    used: dict[int, int] = field(default_factory=dict)

    def open(self, width: int) -> int:
        first, self.n_sequences = self.n_sequences, self.n_sequences + width
        return first

    def place(self, length: int, n: int, first: int, width: int, offset: int) -> None:
        lo = self.used.get(length, 0)
        self.used[length] = lo + n
        self.runs.append((length, lo, n, first, width, offset))


def _best_pair(lengths: list[int], left: dict[int, int], room: int) -> int:
    """Largest sum of two documents that fits in ``room`` (0: none); ``lengths`` ascending."""
    best, hi = 0, len(lengths) - 1
    for lo, small in enumerate(lengths):
        while hi >= lo and (small + lengths[hi] > room or (hi == lo and left[small] < 2)):
            hi -= 1
        if hi < lo:
            break
        best = max(best, small + lengths[hi])
    return best


def reduce_dominated(counts: dict[int, int], capacity: int, plan: Plan) -> dict[int, int]:
    """Fix dominating sets; what is left of the histogram.

    Longest first. A set {i, j} dominates when every other set with i that fits can be
    exchanged for it, item by item, without a longer sequence anywhere.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left)  # ascending, kept free of used-up lengths

    def take(length: int, n: int) -> None:
        left[length] -= n
        if not left[length]:
            del left[length]
            lengths.pop(bisect.bisect_left(lengths, length))

    for i in sorted(left, reverse=True):
        while left.get(i):
            room = capacity - i
            at = bisect.bisect_right(lengths, room) - 1
            if at >= 0 and lengths[at] == i and left[i] == 1:
                at -= 1  # its only copy is the document itself
            if at < 0:
                n = left[i]
                if 2 * i <= capacity:
                    n = 1
                plan.place(i, n, plan.open(n), n, 0)
                take(i, n)
                continue
            j = lengths[at]
            if j != room:
                # The smallest other documents, as often as there are copies (i itself aside).
                small = []
                for length in lengths:
                    small += [length] * min(3, left[length] - (length == i))
                    if len(small) >= 3:
                        break
                two, three = sum(small[:2]), sum(small[:3])
                alone = len(small) < 2 or two > room
                if not alone:
                    if len(small) >= 3 and three <= room or _best_pair(lengths, left, room) > j:
                        break
            n = left[i] // 2 if i == j else min(left[i], left[j])
            first = plan.open(n)
            plan.place(i, n, first, n, 0)
            take(i, n)
            plan.place(j, n, first, n, i)
            take(j, n)
    return left


def best_fit(counts: dict[int, int], capacity: int, plan: Plan) -> None:
    """Best-fit decreasing; groups of sequences with the same room are handled together."""
    rooms: list[int] = []  # ascending rooms that have open groups
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, width)

    def put(room: int, first: int, width: int) -> None:
        if width and room:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((first, width))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, width = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                room = capacity
                width = -(-n // (capacity // length))
                first = plan.open(width)
            times = room // length
            full = min(width, n // times)
            if full:
                plan.place(length, full * times, first, full, capacity - room)
                put(room - times * length, first, full)
                n -= full * times
            if n and full < width:  # the last, partly filled sequence
                plan.place(length, n, first + full, 1, capacity - room)
                put(room - n * length, first + full, 1)
                full, n = full + 1, 0
            put(room, first + full, width - full)


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    plan = Plan()
    best_fit(reduce_dominated(counts, capacity, plan), capacity, plan)
    return plan


# ---- the operator -------------------------------------------------------------------------


def _ranked(cut_docs: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Pieces with their rank among those of their length, and the histogram by length and salt."""
    salted = cut_docs.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)))
    sizes = written(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "packing-sizes")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("id", "piece")
    ranked = (
        salted.withColumn("rn", F.row_number().over(within))
        .join(offsets, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("rn") - 1)
        .drop("salt", "rn", "before")
    )
    return ranked, sizes


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    salts: int = RANK_SALTS,
) -> DataFrame:
    """One row per piece: id, ``piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = setup(docs.sparkSession)
    path = path or public_tokenizers.path(TOKENIZER)
    cut_docs = written(pieces(docs, id_col, text_col, path, capacity, end_id), "packing-pieces")
    ranked, sizes = _ranked(cut_docs, salts)
    # At most ``capacity`` rows reach the driver: one count per length.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = make_plan(counts, capacity)
    runs = spark.createDataFrame(plan.runs, "length bigint, lo bigint, n bigint, first bigint, width bigint, at bigint")
    # The plan's size depends on the capacity alone, not on the documents.
    placed = ranked.join(F.broadcast(runs), "length").filter(
        (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("lo") + F.col("n"))
    )
    r = F.col("rank") - F.col("lo")
    column = F.pmod(r, F.col("width"))
    row = ((r - column) / F.col("width")).cast("long")  # an exact quotient
    return placed.select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + column).alias("sequence_id"),
        (F.col("at") + row * F.col("length")).alias("offset"),
    )
