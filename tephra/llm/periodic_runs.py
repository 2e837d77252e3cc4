"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q (words q apart are identical) and length
at least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` that cannot be extended keeping the period.

*Dyadic scales.* The words, as numbers, are cut into aligned blocks of B = 8, 16, 32, ... words.
A run of period q in [B, 2B) (in [1, 16) for B = 8) is long enough to hold a whole aligned
block that occurs again q words later inside the run. So the runs of a scale show up as
occurrences of blocks at the scale's distances, in the window that follows each block.

*Zero mismatches.* For a block P and a window T the sum over j of (T[k + j] - P[j])^2 is the
sum of squares of both less twice their correlation. The correlations of all blocks come from
a number-theoretic transform modulo the prime 15 * 2^27 + 1, in exact integer arithmetic. Where
the sum is zero modulo the prime the words are compared, so a seed is a match. Two kinds of
blocks are not transformed: one with a word that does not occur again within the scale's
distances cannot occur there, and one whose whole window lies in a known run of a period up to
B occurs at that period's multiples only.

*Seeds.* A hit (block, distance d) is extended to both sides while words d apart are equal.
Scales and distances go upwards, so a shorter period is known before its multiples: hits inside
a known run at multiples of its period extend to that very run and are struck out, which keeps
the work at the sum of the runs' exponents.

Several texts are handled as one sequence, each followed by a number of its own that no word
has: a run holds each of its words three times, so none crosses such a place.

Words are ``[^\\x20\\x09-\\x0D]+``. Null text is no words; texts without words have no runs and
collapse to the empty text. Rows with equal or null ids are kept as they are, one result each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm.common import free_name, setup

MIN_LENGTH = 24
MIN_EXPONENT = 3
FIRST_BLOCK = 8  # a run of MIN_LENGTH or more holds an aligned block of 8 and its next occurrence
PRIME = 15 * (1 << 27) + 1
GENERATOR = 31  # of the multiplicative group modulo PRIME
BATCH_WORDS = 200_000  # words of the texts handled together (one longer text is handled alone)
STEP_NUMBERS = 1 << 20  # numbers transformed together

_U = np.uint64
_P = np.uint64(PRIME)


@functools.cache
def _roots(size: int, inverse: bool) -> tuple[np.ndarray, ...]:
    """Per stage of a transform of ``size``: the powers of its root of unity, largest stage first."""
    out = []
    while size > 1:
        root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        powers = np.ones(size // 2, np.uint64)
        filled = 1
        while filled < size // 2:
            step = _U(pow(root, filled, PRIME))
            powers[filled : 2 * filled] = powers[:filled] * step % _P
            filled *= 2
        out.append(powers)
        size //= 2
    return tuple(out)


def ntt(rows: np.ndarray) -> np.ndarray:
    """Transforms of the rows (a power of two long), in bit-reversed order."""
    m, n = rows.shape
    for powers in _roots(n, False):
        half = len(powers)
        x = rows.reshape(m, -1, 2, half)
        low, high = x[:, :, 0], x[:, :, 1]
        rows = np.stack(((low + high) % _P, (low + (_P - high)) * powers % _P), axis=2)
    return rows.reshape(m, n)


def inverse_ntt(rows: np.ndarray) -> np.ndarray:
    """The inverse of ``ntt``: bit-reversed order in, natural order out."""
    m, n = rows.shape
    for powers in reversed(_roots(n, True)):
        half = len(powers)
        x = rows.reshape(m, -1, 2, half)
        low, high = x[:, :, 0], x[:, :, 1] * powers % _P
        rows = np.stack(((low + high) % _P, (low + (_P - high)) % _P), axis=2)
    return rows.reshape(m, n) * _U(pow(n, -1, PRIME)) % _P


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences modulo the prime: block of each row against every place of its window."""
    m, size = blocks.shape
    width = windows.shape[1]
    length = 1 << (width - 1).bit_length()
    p = np.zeros((m, length), np.uint64)
    t = np.zeros((m, length), np.uint64)
    # A block turned round makes the convolution a correlation.
    p[:, :size], t[:, :width] = blocks[:, ::-1], windows
    places = width - size + 1
    both = inverse_ntt(ntt(p) * ntt(t) % _P)[:, size - 1 : size - 1 + places]
    squares = np.zeros((m, width + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=squares[:, 1:])
    own = (blocks * blocks % _P).sum(axis=1, keepdims=True)
    return (squares[:, size:] - squares[:, :places] + own + _U(2) * (_P - both)) % _P


def _equal_run(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    done, step, n = 0, 64, min(len(a), len(b))
    while done < n:
        differ = a[done : done + step][: n - done] != b[done : done + step][: n - done]
        if differ.any():
            return done + int(differ.argmax())
        done = min(n, done + step)
        step *= 4
    return n


def _next_distance(words: np.ndarray) -> np.ndarray:
    """How far the next occurrence of each word is (very far where there is none)."""
    order = np.argsort(words, kind="stable")
    out = np.full(len(words), len(words) + 1, np.int64)
    same = words[order][1:] == words[order][:-1]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def find_runs(
    words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, longest: int | None = None
) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence of numbers above zero, sorted by start and period.

    ``longest`` bounds the length of a run (the longest text of a batch).
    """
    if min_exponent < MIN_EXPONENT or min_length < MIN_LENGTH:
        raise ValueError("shorter runs need not hold a block and its next occurrence")
    n = len(words)
    words = words.astype(np.uint64)
    runs: list[tuple[int, int, int]] = []
    nearest = _next_distance(words)
    size = FIRST_BLOCK
    # Periods of this scale are at least ``size`` (any, in the first).
    while size * min_exponent <= (longest or n) or size == FIRST_BLOCK:
        first, last = (1, 2 * size) if size == FIRST_BLOCK else (size, 2 * size)  # distances
        starts = np.arange(0, n - size + 1, size)
        if not len(starts):
            break
        far = nearest[: len(starts) * size].reshape(-1, size).max(axis=1)
        wanted = far < last
        for start, length, period in runs:
            if period <= size:
                wanted[-(-start // size) : max(0, (start + length - last - size) // size + 1)] = False
        starts = starts[wanted]
        if len(starts):
            _scale(words, starts, size, first, last, runs, min_length, min_exponent)
        size *= 2
    return sorted({r for r in runs}, key=lambda r: (r[0], r[2]))


def _scale(
    words: np.ndarray,
    starts: np.ndarray,
    size: int,
    first: int,
    last: int,
    runs: list[tuple[int, int, int]],
    min_length: int,
    min_exponent: int,
) -> None:
    """Runs of the periods ``first`` to ``last - 1`` from the blocks at ``starts``; added to ``runs``."""
    width = size + last - first - 1
    padded = np.concatenate((words, np.zeros(last + size, np.uint64)))  # zero is no word
    hits: list[np.ndarray] = []
    step = max(1, STEP_NUMBERS // (2 * width))
    inside, around = np.arange(size), np.arange(width)
    for at in range(0, len(starts), step):
        some = starts[at : at + step]
        blocks, windows = padded[some[:, None] + inside], padded[some[:, None] + first + around]
        block, place = np.nonzero(mismatches(blocks, windows) == 0)
        hits.append(np.stack((place + first, some[block])))
    d, t = np.concatenate(hits, axis=1)
    order = np.lexsort((t, d))
    d, t = d[order], t[order]
    live = np.ones(len(d), bool)
    begins = np.searchsorted(d, np.arange(last + 1))

    def strike(start: int, end: int, period: int, only: bool = False) -> None:
        """Hits at multiples of the period whose block and copy lie inside the stretch."""
        top = min(last - 1, end - start - size)
        for dd in [period] if only else range(-(-first // period) * period, top + 1, period):
            lo, hi = begins[dd], begins[dd + 1]
            if lo < hi:
                a = lo + np.searchsorted(t[lo:hi], start)
                b = lo + np.searchsorted(t[lo:hi], end - size - dd, side="right")
                live[a:b] = False

    for start, length, period in runs:
        strike(start, start + length, period)
    at = 0
    while True:
        rest = live[at:]
        step_to = int(rest.argmax()) if len(rest) else 0
        if not len(rest) or not rest[step_to]:
            return
        at += step_to
        dist, block_at = int(d[at]), int(t[at])
        live[at] = False
        right = _equal_run(words[block_at:], words[block_at + dist :])
        if right < size:  # zero modulo the prime only
            continue
        left = _equal_run(words[:block_at][::-1], words[: block_at + dist][::-1])
        start, end = block_at - left, block_at + right + dist
        if end - start >= max(min_length, min_exponent * dist):
            runs.append((start, end - start, dist))
            strike(start, end, dist)
        else:
            strike(start, end, dist, only=True)


def text_words(text: bytes | None) -> list[bytes]:
    """Split at ASCII white space (bytes split at nothing else)."""
    return (text or b"").split()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run has after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """One sequence of numbers above zero for all texts, each text followed by a number of its own."""
    number: dict[bytes, int] = {}
    flat: list[int] = []
    for i, words in enumerate(texts):
        flat.extend([number.setdefault(w, len(number) + 1) for w in words])
        flat.append(-1 - i)
    out = np.array(flat, np.int64)
    return np.where(out < 0, len(number) - out, out).astype(np.uint64)


def runs_of_texts(
    texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[list[tuple[int, int, int]]]:
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    longest = max(map(len, texts), default=0)
    if longest < min_length:
        return out
    begins = np.cumsum([0, *(len(w) + 1 for w in texts)])
    for start, length, period in find_runs(_numbered(texts), min_length, min_exponent, longest):
        i = int(np.searchsorted(begins, start, side="right")) - 1
        out[i].append((start - int(begins[i]), length, period))
    return out


def _in_batches(texts: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    held: list[list[bytes]] = []
    size = 0
    for words in texts:
        if held and size + len(words) > BATCH_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find(
    docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period in words, by start and period) and
    ``collapsed`` (the text with one period of each run). Columns of these names are replaced."""
    setup(docs.sparkSession)

    def batch(texts: pa.Array) -> pa.Array:
        runs, short = [], []
        for some in _in_batches(text_words(t.as_py()) for t in texts):
            found = runs_of_texts(some, min_length, min_exponent)
            short += [collapsed(w, r) for w, r in zip(some, found, strict=True)]
            runs += [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in found]
        columns = [pa.array(runs, RUNS_TYPE), pa.array(short, pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays(columns, ["runs", "collapsed"])

    kind = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
    found = F.arrow_udf(batch, kind).asNondeterministic()(F.col(text_col).cast("binary"))
    name = free_name(docs, "_found")
    rest = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    out = docs.withColumn(name, found)
    return out.select(*rest, F.col(f"{name}.runs").alias("runs"), F.col(f"{name}.collapsed").alias("collapsed"))


def best_run(runs: Column) -> Column:
    """The run with the greatest exact length / period; the first of equals."""
    first = F.get(runs, F.lit(0))

    def better(best: Column, r: Column) -> Column:
        return F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)

    return F.aggregate(runs, first, better)


def runs_sha256(runs: Column) -> Column:
    """Digest of every run's ``start,length,period`` and a line feed."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
