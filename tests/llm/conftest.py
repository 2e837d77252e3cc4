from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = "the er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w.capitalize() if i % 9 == 0 else w)
        out.append(".\n" if i % 40 == 39 else ". " if i % 9 == 8 else " ")
    return "".join(out).strip()


ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\t \r\n",
    "a",
    "it's we'll they've I'd\n\n\nx  y   z    end ",
    "café naïve 中文文字 한국어 \U0001f600\U0001f600 é İstanbul ΣΣΣ \x1c\x1d\x85x",
    "<|endoftext|> in text <|startoftext|>and <|endoftext|><|endoftext|>",
    "x" * 3000,
    "12 345  6789 ,.;:!?  ###$$$%%%",
    "The same text twice.",
    "The same text twice.",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and odd texts, repeated rows, a null id, extra columns whose names clash with results."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (None, "no id here", "en", "s", 10), (77, prose(1, 900), None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    for name in ("id", "score", "kept", "n_tokens", "spans", "component_id", "length", "_verdict", "_gone", "stats"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
