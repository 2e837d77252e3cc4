"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded alone by the tokenizer library; the ones
that are a single pre-token and give exactly one id are *whole tokens*. A text is cut
into pre-tokens; whole tokens count one each without any merging, only the rest go
through the merges. Counts of pieces between white spaces are remembered per worker.

Null text counts as empty (0 bytes, 0 tokens). Repeated rows are counted one by one.
"""

from __future__ import annotations

import functools

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm import tokenization as T
from tephra.llm.common import setup, text_or_empty

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024


@functools.cache
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings proven to be one pre-token that encodes alone as one token."""
    tok = T.json_tokenizer(path)
    strings = []
    for raw in T.json_ranks(path):
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue  # part of a character: never a pre-token of its own
        if T.PRETOKEN.fullmatch(text) and len(T.split_special(text, path)) == 1:
            strings.append(text)
    encoded = tok.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1)


@functools.cache
def piece_counts(path: str) -> T.Memory:
    """Number of tokens by piece of text, for one tokenizer file."""
    whole, merge = whole_tokens(path), T.merge(path)

    def count(piece: str) -> int:
        return sum(1 if p in whole else len(merge(p.encode())) for p in T.PRETOKEN.findall(piece))

    return T.Memory(count)


def count_tokens(text: str | None, path: str) -> int:
    counts = piece_counts(path)
    total = 0
    for i, part in enumerate(T.split_special(text or "", path)):
        total += 1 if i % 2 else sum(map(counts.__getitem__, T.PIECE.findall(part)))
    return total


def n_tokens(text: Column, path: str) -> Column:
    """Token count of a text column; the file at ``path`` must be on every machine."""

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array([count_tokens(t.as_py(), path) for t in texts], pa.int64())

    return F.arrow_udf(batch, "bigint").asNondeterministic()(text)


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens)."""
    setup(docs.sparkSession)
    path = path or public_tokenizers.path(TOKENIZER)
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text, path).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
