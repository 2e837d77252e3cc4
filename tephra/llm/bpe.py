"""Byte-level BPE encoding by overlapping chunks, and decoding.

A long text becomes chunks that overlap to the right. Every chunk is cut into
pre-tokens on its own, in parallel. Two neighbours agree from the first place inside
their overlap where both start a pre-token: matching is memoryless from such a place
on, so by induction from the first chunk all pre-tokens up to the hand-over belong to
the one chunk and those after it to the next, as in the whole text. Each chunk then
encodes its own pre-tokens, and the ids are put together by chunk number. A text with
an overlap without a common start (one pre-token as long as the overlap) is encoded
whole instead; nothing is dropped.

Null text counts as empty (no ids). Rows get a key of their own, so repeated rows and
repeated or null ids each give their own result row.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm import tokenization as T
from tephra.llm.common import setup, text_or_empty, written

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 1_024
# Seams of up to this many chunks are broadcast; more are joined by shuffle.
BROADCAST_CHUNKS = 500_000


@functools.cache
def piece_ids(path: str) -> T.Memory:
    """Ids by piece of text, each pre-token merged separately, as 32-bit numbers in native order."""
    merge = T.merge(path)

    def ids(piece: str) -> bytes:
        return array("i", (i for p in T.PRETOKEN.findall(piece) for i in merge(p.encode()))).tobytes()

    return T.Memory(ids)


def encode_text(text: str, path: str) -> bytes:
    return b"".join(map(piece_ids(path).__getitem__, T.PIECE.findall(text)))


def _id_lists(found: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found]))).astype(np.int32)
    flat = np.frombuffer(b"".join(found), np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _encode(text: Column, path: str) -> Column:
    def batch(texts: pa.Array) -> pa.Array:
        return _id_lists([encode_text(t.as_py() or "", path) for t in texts])

    return F.arrow_udf(batch, "array<int>").asNondeterministic()(text)


# ---- chunks of long texts ---------------------------------------------------------------


# A contraction of the pattern is at most three characters: a cut can change what starts in the last ones.
CUT_MARGIN = 4


def pretoken_starts(text: str, last: bool) -> list[int]:
    """Starts of the pre-tokens of a chunk, and its end.

    Unless the chunk ends its text, starts that the cut could have changed are left
    out: those in the last characters, and those inside white space at the end.
    """
    starts, at = [], 0
    for piece in T.PIECE.findall(text):
        for p in T.PRETOKEN.findall(piece):
            starts.append(at)
            at += len(p)
    if last:
        return [*starts, at]
    certain = min(len(text) - CUT_MARGIN, len(text.rstrip(T.SPACE)))
    return [s for s in starts if s <= certain]


def n_chunks(length: int, chunk: int, overlap: int) -> int:
    """The last chunk is longer than the overlap, and at most a chunk and an overlap long."""
    return max(1, -(-(length - overlap) // chunk))


def _slices(chunk: int, overlap: int):
    """Chunk rows of long texts: ``text[k * chunk : (k + 1) * chunk + overlap]``, with the row's key and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, texts = batch.columns
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                n = n_chunks(len(text), chunk, overlap)
                for k in range(0, n, 64):  # bounded output batches, however long the text
                    part = range(k, min(n, k + 64))
                    here = pa.array([i] * len(part), pa.int64())
                    columns = {
                        "row_key": keys.take(here),
                        "id": ids.take(here),
                        "chunk": pa.array(part, pa.int64()),
                        "last": pa.array([x == n - 1 for x in part], pa.bool_()),
                        "part": pa.array([text[x * chunk : (x + 1) * chunk + overlap] for x in part], pa.string()),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    return run


def _zones(chunk: int, overlap: int):
    """Starts of a chunk inside the overlap with its left and its right neighbour."""
    struct = pa.struct([("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))])

    def batch(parts: pa.Array, lasts: pa.Array) -> pa.Array:
        out = []
        for part, last in zip(parts, lasts, strict=True):
            starts = pretoken_starts(part.as_py(), last.as_py())
            head = [s for s in starts if s < overlap]
            tail = [s - chunk for s in starts if chunk <= s < chunk + overlap]
            out.append({"head": head, "tail": tail})
        return pa.array(out, struct)

    return F.arrow_udf(batch, "struct<head:array<int>,tail:array<int>>").asNondeterministic()


def _encode_long(long: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``id, ids`` of texts of more than one chunk (columns ``row_key, id, text``)."""
    kind = long.schema["id"].dataType.simpleString()
    cut = long.select("row_key", "id", "text").mapInArrow(
        _slices(chunk, overlap), f"row_key bigint, id {kind}, chunk bigint, last boolean, part string"
    )
    cut = cut.repartition("row_key", "chunk")
    zoned = cut.withColumn("zone", _zones(chunk, overlap)("part", "last"))
    # The keys were made on the way; from here on they are read from this table.
    zoned = written(zoned.select("row_key", "id", "chunk", "last", "part", "zone.head", "zone.tail"), "bpe-chunks")
    starts = zoned.select("row_key", "chunk", "last", "head", "tail")
    left = starts.select("row_key", (F.col("chunk") + 1).alias("chunk"), F.col("tail").alias("left_tail"))
    right = starts.select("row_key", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("right_head"))
    joined = starts.join(left, ["row_key", "chunk"], "left").join(right, ["row_key", "chunk"], "left")
    begin = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("left_tail", "head")))
    end = F.array_min(F.array_intersect("tail", "right_head")) + chunk
    seams = joined.select(
        "row_key",
        "chunk",
        begin.alias("begin"),
        F.when(~F.col("last"), end).alias("end"),
        (begin.isNull() | (~F.col("last") & end.isNull())).alias("open"),
    )
    seams = written(seams, "bpe-seams")
    if seams.count() <= BROADCAST_CHUNKS:
        seams = F.broadcast(seams)  # numbers only; the texts stay where they are
    agreed = zoned.drop("head", "tail").join(seams, ["row_key", "chunk"])
    agreed = agreed.withColumn("end", F.coalesce("end", F.char_length("part")))

    def batch(parts: pa.Array, begins: pa.Array, ends: pa.Array, opens: pa.Array) -> pa.Array:
        found = []
        for part, begin, end, is_open in zip(parts, begins, ends, opens, strict=True):
            text, begin, end = part.as_py(), begin.as_py(), end.as_py()
            ids = []
            if not is_open.as_py():
                known, at = piece_ids(path), begin
                # The pre-tokens of the rest of the chunk, up to the hand-over to the next one.
                for piece in T.PIECE.findall(text[begin:]):
                    if at + len(piece) <= end:
                        ids.append(known[piece])
                        at += len(piece)
                        continue
                    for p in T.PRETOKEN.findall(piece):
                        if at >= end:
                            break
                        ids.append(known[p])
                        at += len(p)
                    break
            found.append(b"".join(ids))
        return _id_lists(found)

    encode_part = F.arrow_udf(batch, "array<int>").asNondeterministic()
    parts = agreed.select(
        "row_key",
        "id",
        "chunk",
        encode_part("part", "begin", "end", "open").alias("ids"),
        F.when(F.col("open"), F.lit(1)).otherwise(F.lit(0)).alias("n_open"),
    )
    # One text's ids end in one row, as its text did.
    whole = parts.groupBy("row_key").agg(
        F.first("id").alias("id"),
        F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("found"),
        F.sum("n_open").alias("n_open"),
    )
    whole = whole.filter("n_open = 0").select("id", F.flatten(F.col("found.ids")).alias("ids"))
    # Texts with an overlap on which the neighbours do not agree: encoded whole.
    stuck = seams.filter("open").select("row_key").distinct()
    own = F.when(F.col("last"), F.col("part")).otherwise(F.substring("part", 1, chunk))
    again = (
        zoned.join(stuck, "row_key", "left_semi")
        .groupBy("row_key")
        .agg(F.first("id").alias("id"), F.sort_array(F.collect_list(F.struct("chunk", own.alias("part")))).alias("found"))
        .select("id", _encode(F.array_join(F.col("found.part"), ""), path).alias("ids"))
    )
    return whole.unionByName(again)


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """``id, ids`` for every row of ``docs``; the rank file must be on every machine."""
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be positive and no longer than a chunk")
    setup(docs.sparkSession)
    path = path or public_tokenizers.path(RANKS)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    is_long = F.char_length("text") > chunk + overlap
    short = rows.filter(~is_long).select("id", _encode(F.col("text"), path).alias("ids"))
    long = rows.filter(is_long).withColumn("row_key", F.monotonically_increasing_id())
    return short.unionByName(_encode_long(long, path, chunk, overlap)).withColumnRenamed("id", id_col)


@functools.cache
def _tables(path: str) -> tuple[list[bytes], list[str]]:
    enc = T.rank_encoding(path)
    top = enc.max_token_value + 1
    raw = [b""] * top
    for token, rank in enc._mergeable_ranks.items():  # noqa: SLF001
        raw[rank] = token
    return raw, [str(i) for i in range(top)]


def _numbers(ids: pa.Scalar) -> list[int]:
    return ids.values.to_numpy().tolist() if ids.is_valid else []


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes of a column of ids: the tokens' raw bytes, one after the other."""
    path = path or public_tokenizers.path(RANKS)

    def batch(lists: pa.Array) -> pa.Array:
        raw = _tables(path)[0]
        return pa.array([b"".join(map(raw.__getitem__, _numbers(x))) for x in lists], pa.binary())

    return F.arrow_udf(batch, "binary").asNondeterministic()(ids)


def id_text_sha256(ids: Column, path: str | None = None) -> Column:
    """Digest of the decimal ids joined by commas."""
    path = path or public_tokenizers.path(RANKS)

    def batch(lists: pa.Array) -> pa.Array:
        name = _tables(path)[1]
        return pa.array(
            [hashlib.sha256(",".join(map(name.__getitem__, _numbers(x))).encode()).hexdigest() for x in lists],
            pa.string(),
        )

    return F.arrow_udf(batch, "string").asNondeterministic()(ids)
