"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of every text (shares, lengths, repetition): no label, language, source or id.
2. A random forest on a bounded sample of labelled rows; each path of each tree is a
   conjunctive rule over the statistics.
3. Lasso logistic regression on the rules' truth values keeps few of them.
4. The kept rules become one Spark column expression: a logistic of weighted conjunctions.

Null text counts as empty. Empty texts get the score their (zero) statistics have.
Without labelled rows of both classes the score is the share of good labels (0.5 if none).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm.common import free_name, setup, written

# The sample: at most so many labelled rows, by the hash of their id.
MAX_SAMPLE_ROWS = 20_000
SAMPLE_PARTITIONS = 8
HELD_OUT_FOLDS = 5
THRESHOLD = 0.3
N_TREES = 16
DEPTH = 4
LASSO = 0.002
SEED = 42

STATISTICS = (
    "log_words",
    "word_length",
    "long_words",
    "short_words",
    "upper",
    "digits",
    "symbols",
    "exclamations",
    "stops",
    "commas",
    "distinct_words",
    "top_word",
    "words_per_line",
    "repeated_lines",
    "distinct_lengths",
)

_CODES = {c: ord(c) for c in "!|.,?;:"}
_SYMBOL_CODES = [ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]"]


def statistics(text: str | None) -> list[float]:
    """The statistics of a text, in the order of ``STATISTICS``; all zero for a text without words."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = int(of[65:91].sum() + of[97:123].sum())
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    marks = sum(int(of[c]) for c in _SYMBOL_CODES)
    return [
        math.log(n),
        float(lengths.mean()),
        float((lengths > 12).mean()),
        float((lengths < 4).mean()),
        int(of[65:91].sum()) / max(letters, 1),
        int(of[48:58].sum()) / len(raw),
        marks / n,
        int(of[_CODES["!"]]) / n,
        int(of[_CODES["."]] + of[_CODES["?"]]) / n,
        int(of[_CODES[","]] + of[_CODES[";"]]) / n,
        len(counts) / n,
        max(counts.values()) / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        len(set(lengths.tolist())) / n,
    ]


_STRUCT = "struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">"


def stats_of(text: Column) -> Column:
    """Struct of the statistics of a text column."""

    def batch(texts: pa.Array) -> pa.Array:
        table = np.array([statistics(t.as_py()) for t in texts], np.float64).reshape(-1, len(STATISTICS))
        return pa.StructArray.from_arrays([pa.array(c) for c in table.T], list(STATISTICS))

    return F.arrow_udf(batch, _STRUCT).asNondeterministic()(text)


# ---- rules --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Conjunction of ``statistic <= bound`` (or ``>``) conditions."""

    conditions: tuple[tuple[int, str, float], ...]

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for i, op, bound in self.conditions:
            value = stats[STATISTICS[i]]
            out = out & (value <= bound if op == "<=" else value > bound)
        return out


@dataclass(frozen=True)
class Model:
    """Intercept and weighted rules."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def score(self, stats: Column) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


_NODE = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.Ee+]+)\)")


def paths(tree_text: str) -> set[Rule]:
    """Every path from the root (inner nodes included) in the printed form of a tree."""
    found: set[Rule] = set()
    path: list[tuple[int, tuple[int, str, float]]] = []  # (indent, condition)
    for line in tree_text.splitlines():
        m = _NODE.match(line)
        if not m:
            continue
        indent = len(m[1])
        path = [p for p in path if p[0] < indent]
        path.append((indent, (int(m[2]), m[3], float(m[4]))))
        found.add(Rule(tuple(_tightest([c for _, c in path]))))
    return found


def _tightest(conditions: list[tuple[int, str, float]]) -> list[tuple[int, str, float]]:
    """One bound per statistic and direction."""
    best: dict[tuple[int, str], float] = {}
    for i, op, bound in conditions:
        known = best.get((i, op))
        if known is None or (bound < known if op == "<=" else bound > known):
            best[i, op] = bound
    return [(i, op, bound) for (i, op), bound in sorted(best.items())]


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % HELD_OUT_FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_SAMPLE_ROWS) -> DataFrame:
    """``doc_id, label, stats`` of at most ``max_rows`` labelled ids outside the held-out fold, by id hash.

    An id that occurs several times gives one row, with its smallest text.
    """
    known = labels.filter("doc_id is not null and quality in (0, 1)").filter(fold(F.col("doc_id")) != 0)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # The chosen ids are bounded by ``max_rows``.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # One row per id, however often it occurs: its smallest text.
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return texts.select("doc_id", "label", stats_of(F.col("text")).alias("stats"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_SAMPLE_ROWS) -> Model:
    """Rules and weights from ``labels`` (doc_id, quality) and the texts of ``docs``."""
    setup(docs.sparkSession)
    # The scan keeps its own parallelism; only the bounded sample is dealt to a few partitions.
    sample = training_sample(docs, labels, max_rows).repartition(SAMPLE_PARTITIONS, "doc_id")
    sample = written(sample, "quality-sample").cache()
    try:
        size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        good, bad = size.get(1, 0), size.get(0, 0)
        if not good or not bad:
            share = (good + 1) / (good + bad + 2)
            return Model(math.log(share / (1 - share)))
        vector = array_to_vector(F.array(*(F.col("stats")[s] for s in STATISTICS)))
        rows = sample.select(F.col("label").cast("double").alias("label"), vector.alias("features"), "stats")
        forest = RandomForestClassifier(
            numTrees=N_TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=SEED
        ).fit(rows.select("label", "features"))
        rules = sorted({r for t in forest.trees for r in paths(t.toDebugString)}, key=lambda r: r.conditions)
        if not rules:
            return Model(math.log(good / bad))
        truth = F.array(*(r.column(F.col("stats")).cast("double") for r in rules))
        lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False)
        fitted = lasso.fit(rows.select("label", array_to_vector(truth).alias("features")))
        kept = [(r, float(w)) for r, w in zip(rules, fitted.coefficients.toArray(), strict=True) if abs(w) > 1e-6]
        return Model(float(fitted.intercept), tuple(kept))
    finally:
        sample.unpersist()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score, predicted`` for every row of ``docs``."""
    setup(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), stats_of(F.col(text_col)).alias("stats"))
    return rows.select(F.col("id").alias(id_col), model.score(F.col("stats")).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model predicts good, with their columns."""
    setup(docs.sparkSession)
    name = free_name(docs, "_stats")
    rows = docs.withColumn(name, stats_of(F.col(text_col)))
    return rows.filter(model.score(F.col(name)) >= THRESHOLD).drop(name)
