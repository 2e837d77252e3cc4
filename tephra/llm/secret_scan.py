"""Secret scan: fixed patterns plus a token-efficiency test.

A random string needs many tokens: under a vocabulary learned from text it yields
few characters per token. Runs of key-like characters with a low ratio are reported
as ``lowtok``, after excluding known digests and identifiers: hexadecimal digests of
the usual lengths, UUIDs, numbers, and names made of words and numbers. Letters
are words only if their own tokens are long, whatever their case. Spans of the fixed
patterns always stay. Offsets are code points, the end exclusive.

Null text counts as empty (no spans). Repeated rows are scanned one by one.
"""

from __future__ import annotations

import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm import tokenization as T
from tephra.llm.common import free_name, setup

RANKS = "byte_bpe_50k.tiktoken"
# A key-like run of at least MIN_CHARS characters with fewer than MAX_CHARS_PER_TOKEN is random.
MIN_CHARS = 20
MAX_CHARS_PER_TOKEN = 2.2
MASK = "[secret]"

# The fixed patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
MIN_ASSIGNED = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "lowtok")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_CHARS)
DIGEST_CHARS = (32, 40, 48, 56, 64, 96, 128)
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
# Names: words (capitalised or not) and numbers, joined by - _ / or by capitals. Possessive: linear on any run.
NAME = re.compile(r"[-_/+]*+(?:(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[0-9]++)[-_/+]*+)++=*")
LETTERS = re.compile(r"[A-Za-z]+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def is_word(part: str, path: str) -> bool:
    """Letters that are one token, or many characters per token."""
    n = len(T.rank_encoding(path).encode_ordinary(part))
    return n == 1 or len(part) >= MAX_CHARS_PER_TOKEN * n


def is_known(run: str, path: str) -> bool:
    """A digest or an identifier, not a secret."""
    if len(run) in DIGEST_CHARS and HEXADECIMAL.fullmatch(run) or UUID.fullmatch(run):
        return True
    if not any(c.isalpha() for c in run):
        return True  # numbers, rules of dashes
    if not any(c.isdigit() for c in run):
        # Words or random letters: only the tokens tell them apart.
        return all(is_word(p, path) for p in LETTERS.findall(run))
    parts = NAME_PARTS.findall(run)
    # Names have long parts, on average four characters or more, and their letters are words.
    if not NAME.fullmatch(run) or sum(map(len, parts)) < 4 * len(parts):
        return False
    return all(is_word(p, path) for p in parts if p.isalpha())


def is_random(run: str, path: str) -> bool:
    return len(run) < MAX_CHARS_PER_TOKEN * len(T.rank_encoding(path).encode_ordinary(run))


def find(text: str | None, path: str) -> list[tuple[str, int, int]]:
    """All spans as (kind, start, end), by start, then kind as listed."""
    text = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        if not is_known(m[0], path) and is_random(m[0], path):
            found.append(("lowtok", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def spans(text: Column, path: str | None = None) -> Column:
    """``array<struct<kind, start, end>>`` of a text column."""
    path = path or public_tokenizers.path(RANKS)

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array(
            [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find(t.as_py(), path)] for t in texts],
            pa.list_(SPAN),
        )

    return F.arrow_udf(batch, "array<struct<kind:string,start:bigint,end:bigint>>").asNondeterministic()(text)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id, found`` (array of spans) for every row of ``docs``."""
    setup(docs.sparkSession)
    return docs.select(F.col(id_col), spans(F.col(text_col), path).alias("found"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the base digest and the span list of a scan's result."""

    def joined(spans_col: Column) -> Column:
        return F.array_join(
            F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"].isin(*KINDS[:3]))
    return found.select(
        id_col,
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def masked(text: str, path: str) -> str:
    """The text with every reported span replaced by a mask (overlapping spans by one)."""
    out, at = [], 0
    for _, start, end in find(text, path):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], MASK]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", path: str | None = None) -> DataFrame:
    """``docs`` with secrets masked in the text; the character count follows. Null texts stay null."""
    setup(docs.sparkSession)
    path = path or public_tokenizers.path(RANKS)

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array([None if not t.is_valid else masked(t.as_py(), path) for t in texts], pa.string())

    clean = F.arrow_udf(batch, "string").asNondeterministic()
    name = free_name(docs, "_clean")
    out = docs.withColumn(name, clean(F.col(text_col)))
    if chars_col in docs.columns:
        changed = ~F.col(text_col).eqNullSafe(F.col(name))
        out = out.withColumn(
            chars_col,
            F.when(changed, F.char_length(name).cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col)),
        )
    return out.withColumn(text_col, F.col(name)).drop(name)


