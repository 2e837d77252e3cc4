"""Tokenizer access inside tasks, with bounded per-worker memories.

*Pieces.* A text is cut before every white space that follows a non-space. No match of
the pre-token pattern crosses such a place: only its leading space or a run of white
space is ever followed by other characters of the same match. So each piece splits
into the same pre-tokens alone as it does in its text, and a memory of pieces is exact.

*Merging.* A pre-token is merged by ranks: always the adjacent pair whose concatenation
has the lowest rank. The JSON files list pairs instead. Both give the same ids when
every listed token, merged alone, comes out whole: what happens inside a token's span
before it is formed does not depend on its neighbours, and on the way to one token there
is only one state of two parts, the listed pair. ``unreachable`` checks that offline.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import sys

import numpy as np
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

# White space as the tokenizer patterns know it: Unicode's, without the four separators Python adds.
SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and not "\x1c" <= c <= "\x1f")
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
WORD = re.compile(f"[^{SPACE}]+")
SEPARATORS = "\x1c\x1d\x1e\x1f"
PRETOKEN = regex.compile(public_tokenizers.PATTERN)

# Entries of one memory; a full memory starts again. Long keys are not remembered.
MEMORY_ENTRIES = 500_000
MEMORY_BYTES = 48 << 20
ENTRY_BYTES = 100  # of the dictionary itself
MEMORY_KEY_CHARS = 40
# Stands for the end of a word while merging: a byte that UTF-8 never has.
WORD_END = b"\xff"


class Memory(dict):
    """A dictionary that computes missing values and keeps a bounded number of them, in bounded bytes."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute
        self.held = 0

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= MEMORY_KEY_CHARS:
            size = sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES
            if len(self) >= MEMORY_ENTRIES or self.held + size > MEMORY_BYTES:
                self.clear()
                self.held = 0
            self[key] = value
            self.held += size
        return value


def words(text: str) -> list[str]:
    """Runs of non-space characters."""
    if any(s in text for s in SEPARATORS):
        return WORD.findall(text)
    return text.split()


@functools.cache
def json_tokenizer(path: str) -> Tokenizer:
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@functools.cache
def special_strings(path: str) -> tuple[str, ...]:
    """Added special tokens, which the library finds in a text before anything else."""
    added = json_tokenizer(path).get_added_tokens_decoder().values()
    return tuple(sorted((a.content for a in added), key=len, reverse=True))


@functools.cache
def _special_pattern(path: str) -> re.Pattern | None:
    found = special_strings(path)
    return re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None


def split_special(text: str, path: str) -> list[str]:
    """Ordinary parts at even places, special strings at odd ones."""
    pattern = _special_pattern(path)
    return pattern.split(text) if pattern else [text]


# ---- merging ------------------------------------------------------------------------------


@functools.cache
def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def json_ranks(path: str) -> dict[bytes, int]:
    """Ids of a byte-level JSON vocabulary by their bytes (a word's end as ``WORD_END``), usable as ranks."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    end, letters = model.get("end_of_word_suffix") or "", byte_letters()
    ranks = {}
    for entry, number in model["vocab"].items():
        at_end = bool(end) and entry.endswith(end)
        body = entry.removesuffix(end) if at_end else entry
        if body and all(c in letters for c in body):
            ranks[bytes(letters[c] for c in body) + (WORD_END if at_end else b"")] = number
    if end:
        ranks.setdefault(WORD_END, 1 << 30)  # never left alone: its merge with any byte comes first
    return ranks


@functools.cache
def rank_encoding(path: str) -> tiktoken.Encoding:
    """The encoder of a rank file, or of a JSON vocabulary's ranks."""
    if path.endswith(".json"):
        ranks = json_ranks(path)
    else:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def spaced_encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a JSON vocabulary with word ends, for many pre-tokens in one call: a space after
    each stands for its end, so none may hold one. And, by id, whether a token ends a pre-token."""
    ranks = json_ranks(path)
    at_end = [n for t, n in ranks.items() if t.endswith(WORD_END) and t != WORD_END]
    ends = np.zeros(max(n for t, n in ranks.items() if t != WORD_END) + 1, bool)
    ends[at_end] = True
    spaced = {t[:-1] + b" " if t.endswith(WORD_END) else t: n for t, n in ranks.items() if t != b" "}
    return tiktoken.Encoding(path, pat_str="[^ ]+ ", mergeable_ranks=spaced, special_tokens={}), ends


def merge(path: str):
    """A function from a pre-token's bytes to its ids."""
    encoding = rank_encoding(path)
    known = encoding._mergeable_ranks  # noqa: SLF001
    many = encoding._core_bpe.encode_single_piece  # noqa: SLF001

    def ids(raw: bytes) -> list[int]:
        whole = known.get(raw)
        return many(raw) if whole is None else [whole]

    return ids


def unreachable(path: str) -> list[str]:
    """Merged tokens of a JSON vocabulary that do not come out whole when merged alone."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    end = model.get("end_of_word_suffix") or ""
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    place = {p: i for i, p in enumerate(pairs)}
    failed = []
    for a, b in pairs:
        at_end = bool(end) and b.endswith(end)
        parts = list((a + b).removesuffix(end) if at_end else a + b)
        if at_end:
            parts[-1] += end
        while len(parts) > 1:
            steps = [(place[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in place]
            if not steps:
                break
            i = min(steps)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if parts != [a + b]:
            failed.append(a + b)
    return failed
