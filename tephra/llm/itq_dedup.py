"""Embedding near-duplicates by iterative quantisation (ITQ).

1. On a bounded sample: mean, principal axes and a rotation that makes the signs of the
   rotated axes balanced binary codes (ITQ: alternate signs and an orthogonal fit).
2. Every vector gets a code of several parts, and each part has its Hamming table; a vector
   asks each table for its part and the parts one bit away. With four parts codes up to 7 bits
   apart always meet. The parts are as wide as log2 of the number of different vectors (16 to
   32 bits), so a bucket's size does not grow with the rows; the wider they are, the more tables
   there are, so that a pair at the threshold is met with a chance of ``RECALL`` (``code_shape``).
3. Candidates (same label, codes at most 20/64 of the bits apart) are reranked with the original
   vectors: a link is a cosine of at least 0.98 in double precision.

Equal vectors are one class before the search and are counted by multiplicity, so a
vector repeated a million times is one row in the tables. Recall against brute force is
measured in the tests.

Vectors that are null, zero or hold null or non-finite components, and vectors with a
null label, link with nothing. Vectors of different lengths never link. Rows with the
same id are separate vectors. Null ids link like others, but name no component.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm.common import setup, written
from tephra.llm.components import components

MIN_COSINE = 0.98
SAMPLE_ROWS = 20_000
ROUNDS = 30
MIN_PART_BITS, MAX_PART_BITS = 16, 32
# Chance that a pair at the threshold meets in a table, if its signs differ independently.
RECALL = 0.99
SEED = 42


@dataclass(frozen=True)
class CodeShape:
    """Width and number of the parts of a code."""

    part_bits: int
    parts: int

    @property
    def bits(self) -> int:
        return self.part_bits * self.parts

    @property
    def words(self) -> int:
        return -(-self.bits // 64)

    @property
    def max_bits(self) -> int:
        return self.bits * 20 // 64


def code_shape(rows: int, min_cosine: float = MIN_COSINE) -> CodeShape:
    """Parts as wide as log2 of ``rows``, and as many tables as the recall needs.

    A random plane separates two vectors with a chance of their angle over pi.
    """
    width = min(MAX_PART_BITS, max(MIN_PART_BITS, math.ceil(math.log2(max(rows, 1)))))
    flip = math.acos(min(1.0, max(-1.0, min_cosine))) / math.pi
    met = (1 - flip) ** width + width * flip * (1 - flip) ** (width - 1)
    tables = math.ceil(math.log(1 - RECALL) / math.log1p(-min(met, 1 - 1e-9)))
    return CodeShape(width, max(4, tables))


@dataclass(frozen=True)
class Quantizer:
    """Per vector length: the mean and the projection to the code's signed axes."""

    shape: CodeShape
    models: dict[int, tuple[np.ndarray, np.ndarray]]

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of unit vectors (rows): as 64-bit words, and as parts."""
        model = self.models.get(vectors.shape[1]) or _fallback(vectors.shape[1], self.shape.bits)
        signs = (vectors - model[0]) @ model[1] > 0
        spare = 64 * self.shape.words - self.shape.bits
        words = np.packbits(np.pad(signs, ((0, 0), (0, spare))), axis=1, bitorder="little").view(np.int64)
        weights = np.left_shift(np.int64(1), np.arange(self.shape.part_bits, dtype=np.int64))
        parts = signs.reshape(len(signs), self.shape.parts, self.shape.part_bits) @ weights
        return words, parts


def _fallback(dim: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Random axes for a length that the sample lacks."""
    return np.zeros(dim), np.random.default_rng(SEED + dim).standard_normal((dim, bits))


def learn_rotation(vectors: np.ndarray, rng: np.random.Generator, bits: int) -> np.ndarray:
    """ITQ on centred rows: axes by rotation, so that signs lose least."""
    dim = vectors.shape[1]
    _, axes = np.linalg.eigh(vectors.T @ vectors)
    axes = axes[:, ::-1][:, : min(dim, bits)]
    spread = vectors @ axes
    rotation, _ = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))
    for _ in range(ROUNDS):
        signs = np.where(spread @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ spread)
        rotation = (left @ right).T
    return axes @ rotation


def learn(sample: dict[int, np.ndarray], shape: CodeShape) -> Quantizer:
    """From unit vectors (rows) by length. Short vectors get several rotations to fill the code."""
    models = {}
    for dim, rows in sample.items():
        rng = np.random.default_rng(SEED)
        mean = rows.mean(axis=0)
        columns: list[np.ndarray] = []
        while sum(c.shape[1] for c in columns) < shape.bits:
            columns.append(learn_rotation(rows - mean, rng, shape.bits))
        models[dim] = (mean, np.concatenate(columns, axis=1)[:, : shape.bits])
    return Quantizer(shape, models)


def _usable(vec: Column, label: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vec, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & ~bad & some, F.lit(False))


def _unit_rows(vectors: pa.Array) -> list[np.ndarray]:
    out = []
    for v in vectors:
        x = np.asarray(v.as_py(), np.float64)
        x = x / np.abs(x).max()  # no overflow or underflow of the norm
        out.append(x / np.sqrt(x @ x))
    return out


def _lists(numbers: np.ndarray) -> pa.Array:
    rows, width = numbers.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(numbers.ravel()))


def _codes(quantizer: Quantizer):
    shape = quantizer.shape

    def batch(vectors: pa.Array) -> pa.Array:
        rows = _unit_rows(vectors)
        dims = np.array([len(r) for r in rows], np.int64)
        words = np.zeros((len(rows), shape.words), np.int64)
        parts = np.zeros((len(rows), shape.parts), np.int64)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            words[at], parts[at] = quantizer.codes(np.stack([rows[i] for i in at]))
        return pa.StructArray.from_arrays([_lists(words), _lists(parts)], ["words", "parts"])

    return F.arrow_udf(batch, "words array<bigint>, parts array<bigint>").asNondeterministic()


def fit(classes: DataFrame, shape: CodeShape, max_rows: int = SAMPLE_ROWS) -> Quantizer:
    """A quantizer from at most ``max_rows`` classes, by hash (a bounded, repeatable sample)."""
    sample = classes.orderBy(F.xxhash64("rep", "label"), "rep").limit(max_rows).select("vec")
    found: dict[int, list[np.ndarray]] = {}
    for x in _unit_rows(sample.toArrow().column("vec").combine_chunks()):
        found.setdefault(len(x), []).append(x)
    return learn({dim: np.stack(rows) for dim, rows in found.items()}, shape)


def _tables(coded: DataFrame, shape: CodeShape, probe: bool) -> DataFrame:
    """One row per table (and per flipped bit when asking): ``label, dim, bucket, class, words``."""
    near = [0, *(1 << i for i in range(shape.part_bits))] if probe else [0]
    flips = F.array(*(F.lit(f).cast("bigint") for f in near))
    rows = coded.select("label", "dim", "class", "words", F.posexplode("parts").alias("part", "own"))
    first = F.shiftleft(F.col("part").cast("bigint"), shape.part_bits)
    keys = F.transform(flips, lambda f: F.col("own").bitwiseXOR(f) + first)
    return rows.select("label", "dim", F.explode(keys).alias("bucket"), "class", "words")


def candidates(coded: DataFrame, shape: CodeShape) -> DataFrame:
    """Pairs of classes (a < b) that meet in a table and whose codes are near."""
    held = _tables(coded, shape, probe=False).select(
        "label", "dim", "bucket", F.col("class").alias("b"), F.col("words").alias("words_b")
    )
    asked = _tables(coded, shape, probe=True).withColumnRenamed("class", "a")
    apart = F.lit(0)
    for i in range(shape.words):
        apart = apart + F.bit_count(F.col("words")[i].bitwiseXOR(F.col("words_b")[i]))
    near = apart <= shape.max_bits
    return asked.join(held, ["label", "dim", "bucket"]).filter((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def _linked(pairs: DataFrame, classes: DataFrame, min_cosine: float) -> DataFrame:
    def cosine(left: pa.Array, right: pa.Array) -> pa.Array:
        x, y = _unit_rows(left), _unit_rows(right)
        return pa.array([float(p @ q) for p, q in zip(x, y, strict=True)], pa.float64())

    one = classes.select(F.col("class").alias("a"), F.col("vec").alias("va"))
    two = classes.select(F.col("class").alias("b"), F.col("vec").alias("vb"))
    both = pairs.join(one, "a").join(two, "b")
    return both.withColumn("cosine", F.arrow_udf(cosine, "double").asNondeterministic()("va", "vb")).filter(
        F.col("cosine") >= min_cosine
    ).select("a", "b", "cosine")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    min_cosine: float = MIN_COSINE,
    max_sample: int = SAMPLE_ROWS,
) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row of ``vectors``."""
    setup(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label")
    )
    # -0.0 and 0.0 are one value: the class is named by a digest of the text form.
    shape = F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    digest = F.sha2(F.to_json(F.struct(F.col("label"), shape.alias("v"))), 256)
    usable = _usable(F.col("vec"), F.col("label"))
    rows = rows.withColumn("digest", F.when(usable, digest))
    grouped = rows.filter("digest is not null").groupBy("digest")
    classes = grouped.agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"), F.first("label").alias("label")
    ).withColumn("dim", F.size("vec"))
    classes = written(classes.withColumn("class", F.substring("digest", 1, 32)), "itq-classes")
    shape = code_shape(classes.count(), min_cosine)
    quantizer = fit(classes, shape, max_sample)
    coded = classes.select("class", "label", "dim", _codes(quantizer)("vec").alias("code"))
    coded = written(coded.select("class", "label", "dim", "code.words", "code.parts"), "itq-codes")
    pairs = written(candidates(coded, shape), "itq-pairs")
    links = written(_linked(pairs, classes, min_cosine), "itq-links")
    group = components(links).withColumnRenamed("node", "class").withColumnRenamed("component", "root")
    named = classes.select("class", "digest", "rep", "copies").join(group, "class", "left")
    named = named.withColumn("root", F.coalesce("root", "class"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "root")
    ends = links.select("a", "b").union(links.select("b", "a"))
    others = ends.join(classes.select(F.col("class").alias("b"), "copies"), "b").groupBy(F.col("a").alias("class"))
    others = others.agg(F.sum("copies").alias("around"))
    named = named.join(others, "class", "left").select(
        "digest", "component_id", (F.col("copies") - 1 + F.coalesce("around", F.lit(0))).cast("long").alias("n_links")
    )
    out = rows.select("id", "digest").join(named, "digest", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
