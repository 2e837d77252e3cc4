"""Exact top-k search by inner product: a Voronoi join.

Queries and data are grouped by pivot directions; angles are the distance, because the
angle obeys the triangle inequality and bounds an inner product:

    q.x <= |q| |x| cos(max(0, angle(q, p) - angle(p, x)))       for any pivot p

1. *Pivots* come from a bounded sample (``SAMPLE_ROWS``); they decide speed only, never results.
2. *Cells*: every distinct vector goes to its nearest pivot, with its angle to it and its norm.
   Equal vectors are one class that keeps its k + 1 smallest ids: no other can be a result.
3. *Summaries*: per cell, the classes nearest to its pivot (``ANCHORS``). A query's k + 1 best
   scores among these real vectors bound its k-th best score from below. Query cells are merged
   into groups; a group's summary is its smallest angle to every pivot and its weakest bound.
4. *Replication*: a class is sent to a group only if the bound above can reach the group's weakest
   score. What a group gets is dealt into blocks of about ``BLOCK_ROWS``, whatever cell they come
   from, so neither a full cell nor a full group is one task.
5. *Local solution*: a task holds one block and one group's queries, goes through the block cell
   by cell, leaves out the queries that the cell cannot improve, and multiplies the rest; the
   best per query are merged by a ranking that drops all but k rows before the shuffle.

Vectors are integers, products are exact: float products are used only where every sum stays
below 2^53, Python integers elsewhere. A component or score outside a long is the nearest long.

Null vectors, vectors with null or non-finite components and rows with a null id take no
part. A shorter vector's missing components are zeros (an empty vector is a zero vector).
Rows equal in id and vector are one row; a query's own row is the one with its id and its
vector. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tephra.llm.common import setup, written

K = 5
SCALE = 256
SAMPLE_ROWS = 20_000
MAX_PIVOTS = 512
ANCHORS = 8  # classes of a cell in its summary
ANCHOR_BYTES = 32 << 20  # all summaries together
GROUP_QUERIES = 4096
BLOCK_ROWS = 32_768
ROUNDS = 8
SEED = 42
SLACK = 1e-6  # of an angle, for rounding
EXACT = float(1 << 53)
STEP_QUERIES, STEP_ROWS = 512, 2048  # of one product inside a task


def quantised(vec: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component; null for vectors that take no part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def _lists(column: pa.Array | pa.ChunkedArray) -> pa.ListArray:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def dense(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows of integers, padded with zeros to the longest row (or to ``width``)."""
    lists = _lists(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    width = max(width, int(lengths.max()) if len(lengths) else 0)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows, as floats where they are exact, else as longs."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if _largest(a) * _largest(b) * max(width, 1) < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _largest(x: np.ndarray) -> float:
    return float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0


@dataclass(frozen=True)
class Cells:
    """Pivot directions (unit rows)."""

    pivots: np.ndarray

    def angles(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Norms, and angles to all pivots (a zero vector is at a right angle to each)."""
        rows = vectors.astype(np.float64)
        largest = np.abs(rows).max(axis=1, initial=0.0)
        safe = np.where(largest > 0, largest, 1.0)[:, None]
        length = np.sqrt(((rows / safe) ** 2).sum(axis=1)) * safe[:, 0]
        width = min(rows.shape[1], self.pivots.shape[1])
        unit = rows / np.where(length > 0, length, 1.0)[:, None]
        return length, np.arccos(np.clip(unit[:, :width] @ self.pivots[:, :width].T, -1.0, 1.0))

    def locate(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, angle to its pivot, norm."""
        length, angle = self.angles(vectors)
        cell = angle.argmin(axis=1)
        return cell, angle[np.arange(len(cell)), cell], length


def learn_cells(sample: np.ndarray, n_pivots: int, rng: np.random.Generator) -> Cells:
    """Pivots: directions of sample rows, moved to the mean direction of their cell a few times."""
    rows = sample.astype(np.float64)
    length = np.sqrt((rows**2).sum(axis=1))
    rows = rows[length > 0] / length[length > 0][:, None]
    if not len(rows):
        return Cells(np.eye(1, max(1, sample.shape[1])))
    pivots = rows[rng.permutation(len(rows))[:n_pivots]]
    for _ in range(ROUNDS):
        cell = (rows @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, cell, rows)
        size = np.sqrt((sums**2).sum(axis=1))
        pivots = np.where((size > 1e-9)[:, None], sums / np.maximum(size, 1e-9)[:, None], pivots)
    return Cells(pivots)


def reach(length: np.ndarray, angle: np.ndarray, pivot_angle: np.ndarray) -> np.ndarray:
    """Upper bound of a unit query's product with vectors of these norms and angles to a pivot,
    when the query is at ``pivot_angle`` or more from that pivot."""
    bound = length * np.cos(np.maximum(0.0, pivot_angle - angle - SLACK))
    return bound + np.abs(length) * 1e-9


@dataclass(frozen=True)
class Groups:
    """Query cells merged into groups, with their bounds."""

    of_cell: np.ndarray  # group of a query cell, -1 where there are no queries
    splits: list[int]  # parts of a group with very many queries
    nearest: np.ndarray  # groups x pivots: smallest angle of a query
    weakest: np.ndarray  # per group: smallest score a result of a unit query can have

    def wanting(self, cell: np.ndarray, angle: np.ndarray, length: np.ndarray) -> np.ndarray:
        """rows x groups: whether the row may be a result of the group."""
        return reach(length[:, None], angle[:, None], self.nearest[:, cell].T) >= self.weakest


def make_groups(cells: Cells, counts: dict[int, int], weakest: dict[int, float], nearest: np.ndarray, size: int) -> Groups:
    """Neighbouring query cells together until a group has about ``size`` queries."""
    left, order = set(counts), []
    at = min(left) if left else None
    while at is not None:
        order.append(at)
        left.discard(at)
        rest = sorted(left)
        at = rest[int((cells.pivots[rest] @ cells.pivots[at]).argmax())] if rest else None
    of_cell, members, filled = np.full(len(cells.pivots), -1), [], size
    for cell in order:
        if filled >= size:
            members.append([])
            filled = 0
        members[-1].append(cell)
        of_cell[cell] = len(members) - 1
        filled += counts[cell]
    return Groups(
        of_cell,
        [-(-sum(counts[c] for c in m) // (2 * size)) for m in members],
        np.array([nearest[m].min(axis=0) for m in members]).reshape(len(members), len(cells.pivots)),
        np.array([min(weakest[c] for c in m) for m in members]),
    )


class Best:
    """The k best classes of every query so far, ties to the smaller id."""

    def __init__(self, n_queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.float64)
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.row = np.empty(0, np.int64)

    def offer(self, query: np.ndarray, score: np.ndarray, row: np.ndarray, first_id: np.ndarray) -> None:
        query = np.concatenate((self.query, query))
        score = np.concatenate((self.score, score.astype(np.int64)))
        row = np.concatenate((self.row, row))
        # ~score falls as the score rises, and never overflows.
        order = np.lexsort((first_id[row], ~score, query))
        query, score, row = query[order], score[order], row[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        self.query, self.score, self.row = query[keep], score[keep], row[keep]


def solve(
    cells: Cells,
    queries: np.ndarray,
    floor: np.ndarray,
    data: np.ndarray,
    cell: np.ndarray,
    angle: np.ndarray,
    length: np.ndarray,
    first_id: np.ndarray,
    k: int,
) -> Best:
    """The k best data rows of every query, none below its ``floor``; the data go cell by cell."""
    best = Best(len(queries), k, floor)
    q_length, q_angle = cells.angles(queries)
    order = np.lexsort((angle, cell))
    starts = np.flatnonzero(np.concatenate(([True], cell[order][1:] != cell[order][:-1])))
    for begin, end in zip(starts, np.append(starts[1:], len(order)), strict=True):
        at = cell[order[begin]]
        for lo in range(begin, end, STEP_ROWS):
            part = order[lo : min(end, lo + STEP_ROWS)]
            bound = q_length * reach(length[part].max(), angle[part].max(), q_angle[:, at])
            wanting = np.flatnonzero(bound >= best.floor)
            for q in range(0, len(wanting), STEP_QUERIES):
                some = wanting[q : q + STEP_QUERIES]
                score = products(queries[some], data[part])
                hit, where = np.nonzero(score >= best.floor[some][:, None])
                best.offer(some[hit], score[hit, where], part[where], first_id)
    return best


# ---- Spark stages -------------------------------------------------------------------------


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """``vec, ids, digest``: one row per distinct vector with its k + 1 smallest ids."""
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("vec").orderBy("id")))
    return ranked.filter(F.col("place") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _located(cells: Cells):
    def batch(vectors: pa.Array) -> pa.Array:
        cell, angle, length = cells.locate(dense(vectors))
        columns = [pa.array(cell, pa.int32()), pa.array(angle), pa.array(length)]
        return pa.StructArray.from_arrays(columns, ["cell", "angle", "length"])

    return F.arrow_udf(batch, "struct<cell:int,angle:double,length:double>").asNondeterministic()


def _floors(anchors: np.ndarray, k: int):
    """A lower bound of a query's k-th best score without its own row: its (k + 1)-th best anchor's."""

    def batch(vectors: pa.Array) -> pa.Array:
        rows = dense(vectors)
        if len(anchors) <= k:
            return pa.array(np.full(len(rows), -np.inf))
        score = products(rows, anchors)
        if score.dtype != np.float64:  # sums that a double cannot hold: no bound
            return pa.array(np.full(len(rows), -np.inf))
        return pa.array(np.partition(score, len(anchors) - k - 1, axis=1)[:, len(anchors) - k - 1])

    return F.arrow_udf(batch, "double").asNondeterministic()


def _cell_angles(cells: Cells):
    """Smallest angle of the batch's queries of a cell to every pivot: ``cell, pivot, angle``."""

    def run(batches):
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            _, angle = cells.angles(dense(batch.column("vec")))
            for c in np.unique(cell):
                low = angle[cell == c].min(axis=0)
                columns = [pa.array(np.full(len(low), c, np.int32)), pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low)]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "pivot", "angle"])

    return run


def _summary(queries: DataFrame, cells: Cells, size: int) -> Groups:
    """Only numbers per cell and per pair of cells reach the driver (``MAX_PIVOTS`` squared at most)."""
    unit_floor = F.when(F.col("length") > 0, F.col("floor") / F.col("length")).otherwise(F.lit(float("-inf")))
    found = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min(unit_floor).alias("weakest")).collect()
    near = queries.select("cell", "vec").mapInArrow(_cell_angles(cells), "cell int, pivot int, angle double")
    nearest = np.full((len(cells.pivots), len(cells.pivots)), np.inf)
    for row in near.groupBy("cell", "pivot").agg(F.min("angle").alias("angle")).collect():
        nearest[row["cell"], row["pivot"]] = row["angle"]
    counts = {r["cell"]: r["n"] for r in found}
    weakest = {r["cell"]: r["weakest"] for r in found}
    return make_groups(cells, counts, weakest, nearest, size)


def _sent(groups: Groups):
    """The groups that a class may give results to."""

    def batch(cell: pa.Array, angle: pa.Array, length: pa.Array) -> pa.Array:
        numbers = (x.to_numpy(zero_copy_only=False) for x in (cell, angle, length))
        want = groups.wanting(*numbers)
        offsets = np.concatenate(([0], want.sum(axis=1).cumsum())).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.nonzero(want)[1].astype(np.int32)))

    return F.arrow_udf(batch, "array<int>").asNondeterministic()


def _solver(cells: Cells, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("own", pa.string()), ("id", pa.int64()), ("score", pa.int64())])

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        if not queries.num_rows or not data.num_rows:
            return schema.empty_table()
        ids = _lists(data["ids"])
        first_id = pc.list_element(ids, 0).to_numpy(zero_copy_only=False)
        numbers = (data[c].to_numpy() for c in ("cell", "angle", "length"))
        best = solve(
            cells, dense(queries["vec"]), queries["floor"].to_numpy(), dense(data["vec"]), *numbers, first_id, k + 1
        )
        # Classes to rows: all kept ids of a class, without the query's own row.
        kept = ids.take(pa.array(best.row))
        n_ids = kept.value_lengths().to_numpy(zero_copy_only=False)
        query, score, row = (np.repeat(x, n_ids) for x in (best.query, best.score, best.row))
        found = kept.flatten().to_numpy(zero_copy_only=False)
        query_id = queries["id"].to_numpy()[query]
        own = queries["own"].combine_chunks().take(pa.array(query))
        same = found == query_id
        if same.any():
            digest = data["own"].combine_chunks().take(pa.array(row))
            same &= pc.equal(own, digest).to_numpy(zero_copy_only=False)
        query, score, found = query[~same], score[~same], found[~same]
        order = np.lexsort((found, ~score, query))
        order = order[np.arange(len(order)) - np.searchsorted(query[order], query[order]) < k]
        columns = [queries["id"].to_numpy()[query[order]], None, found[order], score[order]]
        columns[1] = queries["own"].combine_chunks().take(pa.array(query[order]))
        return pa.table([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=schema)

    return run


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = K,
    max_sample: int = SAMPLE_ROWS,
    group_queries: int = GROUP_QUERIES,
    block_rows: int = BLOCK_ROWS,
    n_pivots: int | None = None,
) -> DataFrame:
    """``query_id, rank, id, score``: the k best other rows of every query row.

    ``rows`` has ``id`` and ``vec`` (array of long); ``is_query`` is a condition on ``id``.
    """
    setup(rows.sparkSession)
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("vec").cast("array<bigint>").alias("vec"))
    rows = rows.filter("id is not null and vec is not null").groupBy("id", "vec").agg(F.lit(1).alias("one")).drop("one")
    rows = written(rows, "voronoi-rows")
    classes = written(_classes(rows, k), "voronoi-classes")
    sample = classes.orderBy(F.xxhash64("vec"), "vec").limit(max_sample).select("vec").toArrow()
    n = classes.count()
    wanted = n_pivots or min(MAX_PIVOTS, max(4, int(math.sqrt(n) / 4)))
    cells = learn_cells(dense(sample.column("vec")), wanted, np.random.default_rng(SEED))
    located = _located(cells)
    digest = F.md5(F.array_join("vec", ",")).alias("own")
    data = classes.select("vec", "ids", digest, located("vec").alias("at")).select("vec", "ids", "own", "at.*")
    data = written(data, "voronoi-cells")
    per_cell = max(1, min(ANCHORS, ANCHOR_BYTES // (8 * len(cells.pivots) * max(1, cells.pivots.shape[1]))))
    nearest = Window.partitionBy("cell").orderBy("angle", "own")
    anchors = data.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= per_cell)
    floors = _floors(dense(anchors.select("vec").toArrow().column("vec")), k)
    asked = rows.filter(is_query).select("id", "vec", digest, located("vec").alias("at"), floors("vec").alias("floor"))
    asked = written(asked.select("id", "vec", "own", "floor", "at.*"), "voronoi-queries")
    groups = _summary(asked, cells, group_queries)
    if not groups.splits:
        empty = asked.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("bigint").alias("score"))
        return empty.limit(0)
    sent = data.withColumn("group", F.explode(_sent(groups)("cell", "angle", "length")))
    n_sent = {r["group"]: r["n"] for r in sent.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.array(*(F.lit(max(1, -(-n_sent.get(g, 0) // block_rows))) for g in range(len(groups.splits))))
    splits = F.array(*(F.lit(max(1, s)) for s in groups.splits))
    group_of = F.array(*(F.lit(int(g)) for g in groups.of_cell))
    # A class goes to one block of each part of its groups, a query to every block of its part.
    sent = sent.withColumn("block", F.pmod(F.xxhash64("vec"), F.get(blocks, F.col("group"))).cast("int"))
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.get(splits, F.col("group")) - 1)))
    asked = asked.withColumn("group", F.get(group_of, F.col("cell")))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id", "own"), F.get(splits, F.col("group"))).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("group")) - 1)))
    key = ["group", "part", "block"]
    found = (
        asked.select(*key, "id", "vec", "own", "floor")
        .groupBy(*key)
        .cogroup(sent.select(*key, "vec", "ids", "own", "cell", "angle", "length").groupBy(*key))
        .applyInArrow(_solver(cells, k), "query_id bigint, own string, id bigint, score bigint")
    )
    ranked = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "id")
    best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "id", "score")


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """``top_k`` of the quantised rows of a vector table; ``is_query`` is a condition on ``id``."""
    setup(vectors.sparkSession)
    vec = quantised(F.col(vector_col))
    return top_k(vectors.select(F.col(id_col).alias("id"), vec.alias("vec")), is_query, k)
