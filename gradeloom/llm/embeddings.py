"""Links between vectors of high cosine, by products of int8 tiles with an error bound for each vector.

Each vector is scaled to length 1 and rounded to whole multiples of a step of its own, at most 127 of them either way. What rounding
left over has a known length, so the product of two rounded vectors misses their cosine by at most

    |rounded x| * left over(y) + left over(x)        (Cauchy-Schwarz, as y has length 1)

Tiles of rounded vectors are multiplied exactly (whole numbers below 2^24 in 32-bit floats). Pairs whose upper bound is below the threshold
are no links; those whose lower bound reaches it are; only those between are computed again in double precision from the vectors.

Equal vectors are one class with a weight. Classes are dealt into blocks: to the nearest of at most ``PIVOTS`` sampled vectors, and
within a large cell by hash. A block knows its greatest angle to its pivot, so a pair of blocks too far apart to hold a link is
left out by the triangle inequality; the other pairs of blocks are multiplied, each by one task that holds one side and reads the other in
tiles. The pivots only save work: whatever they are, every pair that can be a link is multiplied. No pairs are sent on: a task
returns link counts per class, and for the components a spanning forest of the links it has found.

The rows moved grow with vectors times blocks and the products with the square of the vectors, less what the pivots leave out; that is
the price of losing no link. Blocks hold up to ``BLOCK_ROWS`` vectors, which bounds the memory of a task.

Rows: one row out per row in. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of
different lengths don't link. Rows with equal vectors link with each other, and a repeated id counts as a row of its own. A null id is no
component id; a component of null ids alone has a null one, and its rows are kept. An empty table gives an empty table. Other columns are left
out, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.components import components
from gradeloom.sources.workdir import stored

BLOCK_ROWS = 1 << 18  # classes in a block, about, at most
MIN_BLOCK_ROWS = 1 << 10
PIVOTS = 256  # at most
TASKS = 64  # pairs of blocks to have at least, if the table allows
TILE = 2048  # vectors in a tile
EXACT_DIMENSIONS = 1040  # 127 * 127 * 1040 < 2^24
SLACK = 1e-9  # far above what rounding in double precision can do to a bound


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; no row may be zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


class Tile:
    """Vectors as int8 multiples of a step each, with the lengths of the rounded unit vectors and of what was left over."""

    def __init__(self, vectors: np.ndarray):
        units = unit(vectors)
        self.vectors = vectors
        self.step = np.abs(units).max(axis=1) / 127
        self.codes = np.rint(units / self.step[:, None]).astype(np.int8)
        back = self.codes * self.step[:, None]
        rest = units - back
        self.length = np.sqrt(np.einsum("ij,ij->i", back, back)) + SLACK
        self.rest = np.sqrt(np.einsum("ij,ij->i", rest, rest)) + SLACK

    def cosines(self, mine: np.ndarray, other: Tile, theirs: np.ndarray) -> np.ndarray:
        """Cosines of pairs of rows in double precision."""
        return np.einsum("ij,ij->i", unit(self.vectors[mine]), unit(other.vectors[theirs]))


def product(a: Tile, b: Tile) -> np.ndarray:
    """Exact whole-number products of all rows of two tiles."""
    n = a.codes.shape[1]
    if n <= EXACT_DIMENSIONS:
        return a.codes.astype(np.float32) @ b.codes.astype(np.float32).T
    parts = [slice(k, k + EXACT_DIMENSIONS) for k in range(0, n, EXACT_DIMENSIONS)]
    return sum((a.codes[:, p].astype(np.float32) @ b.codes[:, p].astype(np.float32).T).astype(np.float64) for p in parts)


def tile_links(a: Tile, b: Tile, threshold: float, same: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
    """Row numbers of all links of two tiles (of one tile with itself: above the diagonal), and how many pairs were computed again."""
    whole = product(a, b)
    room = threshold - a.rest - a.length * b.rest.max() - 3 * SLACK
    least = room / np.where(room > 0, a.step * b.step.max(), a.step * b.step.min())  # no link of a row has a product below
    i, j = np.nonzero(whole >= np.nextafter(least.astype(whole.dtype), whole.dtype.type(-np.inf))[:, None])
    if same:
        above = i < j
        i, j = i[above], j[above]
    near = whole[i, j] * a.step[i] * b.step[j]
    error = a.length[i] * b.rest[j] + a.rest[i] + SLACK
    possible = near + error >= threshold
    i, j, near, error = i[possible], j[possible], near[possible], error[possible]
    link = near - error >= threshold
    between = np.flatnonzero(~link)
    for at in range(0, len(between), 1 << 15):
        k = between[at : at + (1 << 15)]
        link[k] = a.cosines(i[k], b, j[k]) >= threshold
    return i[link], j[link], len(between)


class Forest:
    """Components of the links added so far; ``root`` is the smallest number in each."""

    def __init__(self):
        self.root = np.empty(0, np.int64)

    def grow(self, n: int) -> None:
        self.root = np.append(self.root, np.arange(len(self.root), len(self.root) + n))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


class BlockPair:
    """The links between two blocks, or within one. The first block is held, the second passes by in tiles."""

    def __init__(self, threshold: float, within: bool):
        self.threshold, self.within = threshold, within
        self.held: list[tuple[int, Tile]] = []
        self.ids, self.weights, self.links = (np.empty(0, np.int64) for _ in range(3))
        self.forest = Forest()
        self.again = 0

    def add(self, first: bool, ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray) -> None:
        start, tile = len(self.ids), Tile(vectors)
        self.ids, self.weights = np.append(self.ids, ids), np.append(self.weights, weights)
        self.links = np.append(self.links, np.zeros(len(ids), np.int64))
        self.forest.grow(len(ids))
        if self.within or first:
            self.held.append((start, tile))
        if self.within or not first:
            for at, other in self.held:
                i, j, again = tile_links(other, tile, self.threshold, at == start)
                self.again += again
                i, j = i + at, j + start
                np.add.at(self.links, i, self.weights[j])
                np.add.at(self.links, j, self.weights[i])
                self.forest.add(i, j)

    def found(self) -> pa.RecordBatch:
        """A row per class with links: their number here, and the first class of its component here."""
        has = np.flatnonzero(self.links)
        root = self.ids[self.forest.root[has]]
        return pa.RecordBatch.from_pydict({"class": pa.array(self.ids[has]), "links": pa.array(self.links[has]), "other": pa.array(root)})


_FOUND = "class bigint, links bigint, other bigint"


def _multiply(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pair = None, None
        for batch in batches:
            own, other, side = (batch.column(c).to_numpy() for c in ("own", "other", "side"))
            ids, weights = batch.column("class").to_numpy(), batch.column("weight").to_numpy()
            lists = batch.column("vector")
            changes = np.flatnonzero((np.diff(own) != 0) | (np.diff(other) != 0) | (np.diff(side) != 0)) + 1
            for start, end in zip([0, *changes], [*changes, batch.num_rows]):
                if start == end:
                    continue
                if key != (own[start], other[start]):
                    if pair is not None:
                        yield pair.found()
                    key, pair = (own[start], other[start]), BlockPair(threshold, bool(own[start] == other[start]))
                for at in range(start, end, TILE):
                    stop = min(end, at + TILE)
                    vectors = lists.slice(at, stop - at).flatten().to_numpy(zero_copy_only=False).reshape(stop - at, -1)
                    pair.add(side[at] == 0, ids[at:stop], weights[at:stop], vectors)
        if pair is not None:
            yield pair.found()

    return run


def classes(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``class, vector, weight, low``: the distinct vectors that can link, how many rows have each, and the smallest id; stored."""
    usable = (
        F.col("vector").isNotNull()
        & F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
        & F.exists("vector", lambda c: c != 0)
    )
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(usable)
    grouped = rows.groupBy("vector").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("low"))
    return stored(grouped.select(F.monotonically_increasing_id().alias("class"), "vector", "weight", "low"), "vector-classes")


def _with_cells(rows: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """Each class with its nearest pivot of the same length (-1: there is none) and the angle to it."""
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for length in {len(p) for p in pivots}:
        at = [k for k, p in enumerate(pivots) if len(p) == length]
        by_length[length] = np.array(at), unit(np.array([pivots[k] for k in at]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            length = np.diff(lists.offsets.to_numpy())
            cell, angle = np.full(len(length), -1, np.int32), np.zeros(len(length))
            for n in np.unique(length):
                if n in by_length:
                    at = np.flatnonzero(length == n)
                    numbers, directions = by_length[n]
                    vectors = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
                    cosine = unit(vectors.astype(np.float64)) @ directions.T
                    best = np.argmax(cosine, axis=1)
                    cell[at] = numbers[best]
                    angle[at] = np.arccos(np.clip(cosine[np.arange(len(at)), best], -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length.astype(np.int32)), pa.array(cell), pa.array(angle)], names=[*batch.schema.names, "length", "cell", "angle"])

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes) + ", length int, cell int, angle double"
    return rows.mapInArrow(run, schema)


def block_pairs(blocks: DataFrame, pivots: list[np.ndarray], threshold: float) -> DataFrame:
    """``own, other`` of all pairs of blocks that can hold a link, from ``block, length, cell, radius``.

    Two vectors of a link are at most acos(threshold) apart, so their blocks' pivots are at most that and both radii apart.
    """
    spark = blocks.sparkSession
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6  # acos is unsteady near 1
    apart = [
        (a, b, float(np.arccos(np.clip(unit(p[None].astype(np.float64))[0] @ unit(q[None].astype(np.float64))[0], -1, 1))))
        for a, p in enumerate(pivots) for b, q in enumerate(pivots) if len(p) == len(q)
    ]
    angles = F.broadcast(spark.createDataFrame([*apart, (-1, -1, 0.0)], "cell int, other_cell int, apart double"))  # at most PIVOTS squared rows
    named = {c: f"other_{c}" for c in ("cell", "radius")} | {"block": "other"}
    mates = blocks.join(angles, "cell")
    found = mates.join(blocks.withColumnsRenamed(named), ["length", "other_cell"]).where("block <= other")
    return found.where((F.col("cell") < 0) | (F.col("apart") <= F.col("radius") + F.col("other_radius") + reach)).select(F.col("block").alias("own"), "other")


def _dealt(rows: DataFrame, threshold: float, block_rows: int | None, pivots: int) -> tuple[DataFrame, DataFrame]:
    """The classes with their blocks, and the pairs of blocks to multiply."""
    n = rows.count()
    if block_rows is None:  # so many blocks that their pairs keep the cluster busy, unless the table is small
        tasks = max(TASKS, 4 * rows.sparkSession.sparkContext.defaultParallelism)
        block_rows = min(BLOCK_ROWS, max(MIN_BLOCK_ROWS, math.ceil(n / math.sqrt(2 * tasks))))
    wanted = min(pivots, math.ceil(n / block_rows))
    sampled = [np.array(r["vector"], np.float64) for r in rows.orderBy(F.xxhash64("class")).limit(wanted).select("vector").collect()] if wanted > 1 else []
    placed = stored(_with_cells(rows, sampled), "vector-cells")
    cells = placed.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int")).select("length", "cell", "parts")
    dealt = placed.join(F.broadcast(cells), ["length", "cell"]) if len(sampled) else placed.join(cells, ["length", "cell"])
    dealt = dealt.withColumn("block", F.expr("shiftleft(cast(length as bigint), 40) + shiftleft(cast(cell + 1 as bigint), 31) + pmod(xxhash64(class), parts)"))
    blocks = dealt.groupBy("length", "cell", "block").agg(F.max("angle").alias("radius"))
    return dealt, block_pairs(stored(blocks, "vector-blocks"), sampled, threshold)


def class_links(rows: DataFrame, threshold: float, block_rows: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """``class, links, other``: per pair of blocks and class, how many rows of other classes it links with, and a class of the same component."""
    dealt, pairs = _dealt(rows, threshold, block_rows, pivots)
    vectors = dealt.select("block", "class", "weight", "vector")
    first = vectors.join(pairs.withColumnRenamed("own", "block"), "block").select(F.col("block").alias("own"), "other", F.lit(0).alias("side"), "class", "weight", "vector")
    second = vectors.join(pairs.where("own <> other").withColumnRenamed("other", "block"), "block").select("own", F.col("block").alias("other"), F.lit(1).alias("side"), "class", "weight", "vector")
    together = first.unionByName(second).repartition("own", "other").sortWithinPartitions("own", "other", "side")
    return stored(together.mapInArrow(_multiply(threshold), _FOUND), "vector-links")


def embedding_links(df: DataFrame, threshold: float = 0.9, vector: str = "embedding", block_rows: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row: links are pairs of rows whose cosine is at least ``threshold``, which is above 0."""
    rows = classes(df, vector)
    found = class_links(rows, threshold, block_rows, pivots)
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("class").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "class")
    judged = rows.join(counts, "class", "left").join(parts, "class", "left").select(
        "class", "vector", "low", (F.coalesce("links", F.lit(0).cast("long")) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "class").alias("component")
    )
    lows = judged.groupBy("component").agg(F.min("low").alias("component_id"))
    verdicts = judged.join(lows, "component").select(F.col("vector").alias("_vector"), "n_links", "component_id")
    narrow = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("_own"))
    joined = narrow.join(verdicts, F.col("_own") == F.col("_vector"), "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
