"""Quality rules on compression bands.

The zstandard ratio (compressed bytes / UTF-8 bytes) of the whole document and of
fixed chunks, the end of the text included, must lie inside limits that depend on the
length: below the lower limit a text repeats itself, above the upper one it is noise.
The limits are those of clean labelled text of the same length with a margin (``learn``
measures them, held-out fold excluded; ``BANDS`` is what it found); the shortest have no
upper limit.

Null text counts as empty. An empty or very short text fails the base rules
(fewer than ``MIN_WORDS`` words). Repeated rows are judged one by one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm.common import free_name, setup
from tephra.llm.quality_classifier import fold

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
LEVEL = 3
CHUNK_BYTES = 4096


@dataclass(frozen=True)
class Band:
    """Limits of the ratio for texts of at least ``min_bytes`` bytes."""

    min_bytes: int
    low: float
    high: float


# Clean labelled text is measured in length classes from 256 bytes on, two per doubling.
CLASS_BYTES = tuple(round(256 * 2 ** (k / 2)) for k in range(13))
# A class with fewer clean texts learns nothing and takes the limits given as ``otherwise``.
MIN_TEXTS = 20
# Limits lie so far outside the lowest and highest ratio.
MARGIN = 0.08


@dataclass(frozen=True)
class Bands:
    """Limits of whole documents by length (ascending), and of chunks."""

    docs: tuple[Band, ...]
    chunk: Band

    def keep(self, n_bytes: int, ratio: float | None) -> bool:
        return ratio is not None and _inside(ratio, [b for b in self.docs if b.min_bytes <= n_bytes][-1])


def bands_of(clean: Sequence[tuple[int, float, float]], clean_chunk: tuple[float, float]) -> Bands:
    """Bands around the lowest and highest ratio of clean text, by length class and of chunks.

    No clean text is labelled below the first class, where the limits are wide, nor from 64 KB on,
    where the lower limit is lower as long texts reuse their vocabulary.
    """
    around = [Band(n, low * (1 - MARGIN), high * (1 + MARGIN)) for n, low, high in clean]
    low, high = clean_chunk
    chunk = Band(CHUNK_BYTES, low * (1 - MARGIN), high * (1 + MARGIN))
    return Bands((Band(0, 0.10, 9.0), *around, Band(65536, 0.30, around[-1].high)), chunk)


# What ``learn`` measures on the labelled documents of sf0.1, held-out fold excluded. Random lower-case letters
# leave the bands from 1.5 KB on, hexadecimal noise from 4 KB, digits from 16 KB; shorter ones compress like text.
CLEAN = (
    (256, 0.6016, 0.7254),
    (362, 0.5439, 0.7011),
    (512, 0.5354, 0.6820),
    (724, 0.5067, 0.6292),
    (1024, 0.4909, 0.5799),
    (1448, 0.4656, 0.5430),
    (2048, 0.4650, 0.5212),
    (2896, 0.4526, 0.5006),
    (4096, 0.4395, 0.4719),
    (5793, 0.4272, 0.4646),
    (8192, 0.4204, 0.4494),
    (11585, 0.4163, 0.4394),
    (16384, 0.4103, 0.4282),
)
CLEAN_CHUNK = (0.4440, 0.4822)
BANDS = bands_of(CLEAN, CLEAN_CHUNK)
# A text is rejected when a larger share of its chunks leaves the band than its length allows:
# (bytes from which it holds, percent). No bad chunk below 64 KB; one table or listing is no reason in a long text.
BAD_CHUNK_PERCENT = ((0, 0), (65536, 5), (1 << 20, 2))

SCHEMA = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
    "n_repeat_words:bigint,base_failed:boolean,kept:boolean,doc_ratio:double,"
    "n_chunks:bigint,n_bad_chunks:bigint>"
)
ARROW = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("doc_ratio", pa.float64())]
    + [("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64())]
)

_NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n = np.int64(len(number))
    if len(number) < 2_000_000:
        windows = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:  # the product would not fit 63 bits: number the pairs first
        _, pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
        windows = pairs[:-1].astype(np.int64) * n + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= again
    return int(covered.sum())


def dup_lines(text: str) -> int:
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line in seen:
            repeats += 1
        elif _NOT_SPACE.search(line):
            seen.add(line)
    return repeats


def _inside(ratio: float, band: Band) -> bool:
    return band.low <= ratio <= band.high


def chunks_of(raw: bytes) -> list[memoryview]:
    """The full chunks, and the last CHUNK_BYTES where they end before the text does."""
    view = memoryview(raw)
    starts = list(range(0, len(raw) - CHUNK_BYTES + 1, CHUNK_BYTES))
    if starts and len(raw) % CHUNK_BYTES:
        starts.append(len(raw) - CHUNK_BYTES)
    return [view[i : i + CHUNK_BYTES] for i in starts]


def base_counts(raw: bytes) -> tuple[int, int, bool]:
    """Words, words of repeated windows, and whether the base rules fail."""
    words = raw.split()  # bytes.split() cuts at exactly the six ASCII white-space bytes
    repeats = repeat_words(words)
    return len(words), repeats, len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)


def ratios(raw: bytes, squeeze: zstandard.ZstdCompressor) -> tuple[float | None, list[float]]:
    """Compressed share of the whole text (none for an empty one) and of its chunks."""
    whole = len(squeeze.compress(raw)) / len(raw) if raw else None
    return whole, [len(squeeze.compress(c)) / CHUNK_BYTES for c in chunks_of(raw)]


def judge(text: str | None, squeeze: zstandard.ZstdCompressor | None = None, bands: Bands = BANDS) -> dict:
    """Counts, base rules and compression verdict of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    n_words, repeats, failed = base_counts(raw)
    ratio, chunks = ratios(raw, squeeze or zstandard.ZstdCompressor(level=LEVEL))
    bad = sum(not _inside(c, bands.chunk) for c in chunks)
    percent = [p for least, p in BAD_CHUNK_PERCENT if least <= len(raw)][-1]
    good = bands.keep(len(raw), ratio) and 100 * bad <= percent * len(chunks)
    return {
        "n_words": n_words,
        "word_chars": len(text) - sum(map(text.count, _SPACE)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": dup_lines(text),
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": not failed and good,
        "doc_ratio": ratio,
        "n_chunks": len(chunks),
        "n_bad_chunks": bad,
    }


def verdict(text: Column, bands: Bands = BANDS) -> Column:
    """Struct of counts and verdict for a text column."""

    def batch(texts: pa.Array) -> pa.Array:
        squeeze = zstandard.ZstdCompressor(level=LEVEL)
        return pa.array([judge(t.as_py(), squeeze, bands) for t in texts], ARROW)

    return F.arrow_udf(batch, SCHEMA).asNondeterministic()(text)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = BANDS) -> DataFrame:
    """One row per row of ``docs``: the id, the counts, ``base_failed`` and ``kept``."""
    setup(docs.sparkSession)
    return docs.select(F.col(id_col), verdict(F.col(text_col), bands).alias("_v")).select(id_col, "_v.*")


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = BANDS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    setup(docs.sparkSession)
    name = free_name(docs, "_verdict")
    return docs.withColumn(name, verdict(F.col(text_col), bands)).filter(F.col(name)["kept"]).drop(name)


def _measured(text: Column) -> Column:
    """``n_bytes, ratio, chunk_low, chunk_high`` of a text that passes the base rules, else null."""
    fields = [("n_bytes", pa.int64()), ("ratio", pa.float64()), ("chunk_low", pa.float64()), ("chunk_high", pa.float64())]

    def one(text: str | None, squeeze: zstandard.ZstdCompressor) -> dict | None:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if base_counts(raw)[2]:
            return None
        whole, chunks = ratios(raw, squeeze)
        low, high = (min(chunks), max(chunks)) if chunks else (None, None)
        return {"n_bytes": len(raw), "ratio": whole, "chunk_low": low, "chunk_high": high}

    def batch(texts: pa.Array) -> pa.Array:
        squeeze = zstandard.ZstdCompressor(level=LEVEL)
        return pa.array([one(t.as_py(), squeeze) for t in texts], pa.struct(fields))

    schema = "struct<n_bytes:bigint,ratio:double,chunk_low:double,chunk_high:double>"
    return F.arrow_udf(batch, schema).asNondeterministic()(text)


def clean_ranges(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[int, int, float, float]], tuple | None]:
    """``(least bytes, texts, lowest, highest ratio)`` by length class, and the range of chunks, of all
    documents labelled quality 1 that pass the base rules, held-out fold excluded.

    Ids without a label, null ids and other labels take no part; an id labelled both ways is not clean.
    """
    setup(docs.sparkSession)
    known = labels.filter("doc_id is not null and quality in (0, 1)").filter(fold(F.col("doc_id")) != 0)
    clean = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    texts = docs.select("doc_id", "text").join(clean, "doc_id", "left_semi")
    rows = texts.select(_measured(F.col("text")).alias("m")).select("m.*").filter(F.col("n_bytes") >= CLASS_BYTES[0])
    least = F.greatest(*(F.when(F.col("n_bytes") >= n, F.lit(n)) for n in CLASS_BYTES), F.lit(0))
    found = rows.groupBy(least.alias("least")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ratio").alias("low"),
        F.max("ratio").alias("high"),
        F.min("chunk_low").alias("chunk_low"),
        F.max("chunk_high").alias("chunk_high"),
    )
    got = found.orderBy("least").collect()  # one row per length class
    with_chunks = [r for r in got if r["chunk_low"] is not None]
    chunk = (_down(min(r["chunk_low"] for r in with_chunks)), _up(max(r["chunk_high"] for r in with_chunks))) if with_chunks else None
    return [(r["least"], r["n"], _down(r["low"]), _up(r["high"])) for r in got], chunk


def _down(x: float) -> float:
    return math.floor(x * 10_000) / 10_000


def _up(x: float) -> float:
    return math.ceil(x * 10_000) / 10_000


def learn(docs: DataFrame, labels: DataFrame, otherwise: Sequence[tuple[int, float, float]] = CLEAN) -> Bands:
    """Bands from the labelled documents; classes with too few clean texts are taken from ``otherwise``."""
    ranges, chunk = clean_ranges(docs, labels)
    own = {least: (low, high) for least, n, low, high in ranges if n >= MIN_TEXTS}
    given = {least: (low, high) for least, low, high in otherwise}
    clean = [(n, *own.get(n, given.get(n))) for n in CLASS_BYTES if n in own or n in given]
    return bands_of(clean, chunk or CLEAN_CHUNK)
