"""Near copies by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. Texts become sets of word shingles (64-bit hashes). Equal sets are one class, and only one row per class goes on.
2. A class has ``TREES`` labels, each a sequence of ``DEPTH`` MinHash values. In each tree the classes that share at least the first
   ``MIN_DEPTH`` values are a region. A region of up to ``REGION`` classes is compared as a whole; a larger one goes deeper, prefix
   by prefix, until its parts fit, so the depth adapts to each region. Classes that still crowd at full depth agree in all of a
   label's values and are joined without comparison.
3. Compared classes whose signatures agree enough (``SCREEN``, well below the threshold) are joined into rough groups: a region
   hands on a spanning forest of its joins, never its pairs.
4. Per rough group the full sets are laid together and all links at or above the threshold are found exactly, through an inverted
   list of shingles, as far as they join parts.
5. A group above ``MAX_SHINGLES`` is first laid out once per tree, by the first values of that tree's labels, and read in pieces,
   which finds most of its links at little cost. What is then still apart is compared in full: the group is dealt into chunks, a large
   component into chunks of its own, and every two chunks meet in a task, unless all of both is connected already.
6. Components of the confirmed links carry the smallest id.

A pair at the threshold 0.8 misses all regions with probability (1 - 0.8^3)^20 < 1e-6, and its signatures fall below the
screen with a probability below 1e-5; larger similarities fail less. Where all regions of a pair are so crowded that they go to full depth,
that is (1 - 0.8^6)^20, 0.3 percent at 0.8 and below 1e-6 at 0.9. Pairs of a group can also meet through others.

Rows: one row out per row in. Null, empty and blank texts have an empty set and are linked with nothing; a text with fewer words
than a shingle is one shingle as a whole. Repeated rows are equal sets. Texts are processed whole. Ids should be unique; rows that
share one are judged each by its own text. Other columns are left out, so their names cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.components import components
from gradeloom.llm.textbatch import LOWER, distinct_per_text, mix, shingles, slices, split_words, text_bytes
from gradeloom.sources.workdir import stored

TREES = 20
DEPTH = 6
MIN_DEPTH = 3
REGION = 256
SCREEN = 0.15
OVERLAP = 256
MAX_SHINGLES = 4_000_000

_LANES = TREES * DEPTH
_rng = np.random.default_rng(77)
_MULTIPLIERS = _rng.integers(1, 2**63, _LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _rng.integers(1, 2**63, _LANES, dtype=np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the borders of the texts."""
    data, offsets = text_bytes(texts)
    words = split_words(LOWER[data], offsets)
    runs, owner = shingles(words.hashes(), words, size)
    return distinct_per_text(runs, owner, len(texts))


def signatures(sets: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """16-bit MinHash values, one row per non-empty set."""
    starts = borders[:-1][np.diff(borders) > 0]
    out = np.empty((len(starts), _LANES), dtype=np.uint16)
    if not len(starts):
        return out
    ends = np.append(starts[1:], len(sets))
    at = 0
    while at < len(starts):  # pieces that stay in the processor's cache
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + 32_768, side="right")))
        piece, inner = sets[starts[at] : ends[stop - 1]], starts[at:stop] - starts[at]
        for lane in range(_LANES):
            lowest = np.minimum.reduceat((piece ^ _MASKS[lane]) * _MULTIPLIERS[lane], inner)
            out[at:stop, lane] = (mix(lowest) & np.uint64(0xFFFF)).astype(np.uint16)
        at = stop
    return out


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets, borders = shingle_sets(part.column("text"), size)
            n = np.diff(borders)
            full = n > 0
            one, two = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(sets):
                starts = borders[:-1][full]
                one[full] = np.add.reduceat(mix(sets), starts)
                two[full] = np.add.reduceat(mix(sets ^ np.uint64(0x5DEECE66D)), starts)
            signed = n > 1  # a set of one shingle has no near copies but equal ones
            rows = signatures(sets, borders)[signed[full]]
            labels, screens = (np.full(len(n), None, dtype=object) for _ in range(2))
            labels[signed] = [r.tobytes() for r in rows.astype(">u2")]
            screens[signed] = [r.tobytes() for r in rows.astype(np.uint8)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n_shingles": pa.array(n),
                    "one": pa.array(one.view(np.int64)),
                    "two": pa.array(two.view(np.int64)),
                    "labels": pa.array(labels, pa.binary()),
                    "screen": pa.array(screens, pa.binary()),
                }
            )

    return run


class _Forest:
    """Union-find over places in an array."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def _compare(lanes: np.ndarray, rows: np.ndarray, least: int, forest: _Forest) -> list[tuple[int, int]]:
    """Joins among the given rows whose signatures agree in at least ``least`` values: a spanning forest of them."""
    joins = []
    own = lanes[rows]
    for k in range(1, len(rows)):
        agree = (own[:k] == own[k]).sum(axis=1)
        for j in np.flatnonzero(agree >= least).tolist():
            if forest.join(int(rows[j]), int(rows[k])):
                joins.append((int(rows[j]), int(rows[k])))
    return joins


def _pairs(nodes: list[int], found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([nodes[i] for i, _ in found], pa.int64()), "b": pa.array([nodes[j] for _, j in found], pa.int64())})


def _rough_joins(least: int):
    """Reads rows in the order of tree and key; the rows of a key are compared as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, screens = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                screen = np.frombuffer(b"".join(screens), dtype=np.uint8).reshape(len(nodes), _LANES)
                yield _pairs(nodes, _compare(screen, np.arange(len(nodes)), least, _Forest(len(nodes))))

        for batch in batches:
            for node, tree, part, screen in zip(*(batch.column(c).to_pylist() for c in ("node", "tree", "key", "screen"))):
                if (tree, part) != key:
                    yield from flush()
                    key, nodes, screens = (tree, part), [], []
                nodes.append(node)
                screens.append(screen)
        yield from flush()

    return run


def exact_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links with ``100 * common >= percent * union`` that connect whatever all such links connect.

    Sets are taken by size. A link to an earlier set needs ``percent`` percent of the own shingles in common, so the rarest shingles
    beyond the rest already meet every linked set. Of those only sets in other parts matter: the likeliest are confirmed one by one, which mostly
    joins all of them; else all common counts are taken from the inverted list at once.
    """
    n = len(sets)
    order = sorted(range(n), key=lambda i: (len(sets[i]), i))
    sizes = np.array([len(sets[i]) for i in order])
    flat = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    by_value = np.argsort(flat, kind="stable")  # owners ascend within a value
    values, holders = flat[by_value], owner[by_value]
    change = np.ones(len(values), dtype=bool)
    change[1:] = values[1:] != values[:-1]
    first = np.flatnonzero(change)[np.cumsum(change) - 1]
    starts, places = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    starts[by_value] = first
    places[by_value] = np.arange(len(flat))
    del values, change, first, owner
    borders = np.concatenate(([0], np.cumsum(sizes)))
    part = np.arange(n)
    links: list[tuple[int, int]] = []

    def earlier(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        lengths = hi - lo
        shift = np.repeat(lo - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        return holders[shift + np.arange(len(shift))]

    def join(j: int, k: int) -> None:
        if part[j] != part[k]:
            part[part == part[k]] = part[j]
            links.append((order[j], order[k]))

    for k in range(n):
        lo, hi = starts[borders[k] : borders[k + 1]], places[borders[k] : borders[k + 1]]
        m = int(sizes[k])
        spare = m - -(-percent * m // 100) + 1
        rare = np.argpartition(hi - lo, spare - 1)[:spare] if spare < m else slice(None)
        seen = np.bincount(earlier(lo[rare], hi[rare]), minlength=1)
        maybe = np.flatnonzero(seen)
        maybe = maybe[(100 * sizes[maybe] >= percent * m) & (part[maybe] != part[k])]
        for _ in range(4):
            if not len(maybe):
                break
            j = int(maybe[np.argmax(seen[maybe])])
            common = len(np.intersect1d(sets[order[j]], sets[order[k]], assume_unique=True))
            if 100 * common >= percent * (m + sizes[j] - common):
                join(j, k)
            maybe = maybe[(maybe != j) & (part[maybe] != part[k])]
        if len(maybe):
            common = np.bincount(earlier(lo, hi), minlength=k)[maybe]
            for j in maybe[100 * common >= percent * (m + sizes[maybe] - common)].tolist():
                join(j, k)
    return links


def _confirm(percent: int, max_shingles: int | None):
    """Reads rows ordered by group and part; what goes beyond ``max_shingles`` is handled in overlapping pieces (None: never)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets, total = None, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                yield _pairs(nodes, exact_links(sets, percent))

        for batch in batches:
            for node, group, part, packed in zip(*(batch.column(c).to_pylist() for c in ("node", "group", "part", "shingles"))):
                if (group, part) != key or (max_shingles is not None and total > max_shingles):
                    yield from flush()
                    nodes, sets = (x[-OVERLAP:] if (group, part) == key else [] for x in (nodes, sets))
                    key, total = (group, part), sum(map(len, sets))
                nodes.append(node)
                sets.append(np.frombuffer(packed, dtype=np.uint64))
                total += len(sets[-1])
        yield from flush()

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets, borders = shingle_sets(part.column("text"), size)
            packed = [sets[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])]
            yield pa.RecordBatch.from_pydict({c: part.column(c) for c in ("node", "group", "part", "place")} | {"shingles": pa.array(packed, pa.binary())})

    return run


def _trees(classes: DataFrame) -> DataFrame:
    """Per class and tree its label."""
    each = classes.select("node", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "labels")
    return each.select("node", "tree", F.expr(f"substring(labels, tree * {2 * DEPTH} + 1, {2 * DEPTH})").alias("label"))


def _regions(labels: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """``node, tree, key`` of classes that share a key of at most ``most`` classes, the shortest such prefix of their label; and joins ``a, b`` of those that crowd at full depth."""
    alive, fitting = labels, []
    for depth in range(MIN_DEPTH, DEPTH + 1):
        keyed = alive.withColumn("key", F.expr(f"substring(label, 1, {2 * depth})"))
        sizes = keyed.groupBy("tree", "key").agg(F.count("*").alias("n"), F.min("node").alias("low")).where("n > 1")
        level = stored(keyed.join(sizes, ["tree", "key"]), "regions")
        fitting.append(level.where(F.col("n") <= most).select("node", "tree", "key"))
        crowded = level.where(F.col("n") > most)
        alive = crowded.select("node", "tree", "label")
        if depth == DEPTH or crowded.isEmpty():
            return reduce(DataFrame.unionByName, fitting), crowded.select(F.col("node").alias("a"), F.col("low").alias("b"))


def _parts(groups: DataFrame, classes: DataFrame, large: DataFrame) -> DataFrame:
    """``node, group, part, place``: one part for a group, but for a large one a part per tree and first label values."""
    empty = F.lit(None).cast("binary")
    small = groups.join(large, "component", "left_anti").select("node", F.col("component").alias("group"), empty.alias("part"), empty.alias("place"))
    if large.isEmpty():
        return small
    several = _trees(groups.join(large, "component").join(classes, "node")).join(groups, "node")
    part = F.concat(F.col("tree").cast("string").cast("binary"), F.expr(f"substring(label, 1, {2 * MIN_DEPTH})"))
    return small.unionByName(several.select("node", F.col("component").alias("group"), part.alias("part"), F.col("label").alias("place")))


def _chunk_pairs(members: DataFrame, max_shingles: int) -> DataFrame:
    """``node, group, part, place`` of ``members(node, group, own, n_shingles)`` that lay out every two chunks of a group, ``own`` being what is connected so far.

    Components above half a chunk are dealt into chunks of their own, the others together, whole. Two chunks of one component are left out.
    """
    room = max(max_shingles // 2, 1)
    sizes = members.groupBy("group", "own").agg(F.sum("n_shingles").alias("size"))
    small = sizes.where(F.col("size") * 2 <= room).groupBy("group").agg(F.sum("size").alias("rest"))
    dealt = members.join(sizes, ["group", "own"]).join(small, "group", "left")
    alone = F.col("size") * 2 > room
    count = lambda total: F.ceil(total / F.lit(room)).cast("long")
    whole = F.when(alone, F.col("own"))
    number = F.when(alone, F.pmod(F.xxhash64("node"), count(F.col("size")))).otherwise(F.pmod(F.xxhash64("own"), count(F.col("rest"))))
    dealt = stored(dealt.select("node", "group", whole.alias("whole"), number.alias("number")), "chunks")
    chunks = dealt.select("group", "whole", "number").distinct().withColumn("chunk", F.struct(F.coalesce(F.col("whole").cast("string"), F.lit("")).alias("whole"), "number"))
    left, right = (chunks.select("group", F.col("whole").alias(f"{side}_whole"), F.col("chunk").alias(side)) for side in ("left", "right"))
    pairs = left.join(right, "group").where("left <= right and not coalesce(left_whole = right_whole, false)")
    name = F.to_json(F.struct("left", "right")).cast("binary").alias("part")
    each = pairs.select("group", name, F.explode(F.array_distinct(F.array("left", "right"))).alias("chunk"))
    keyed = dealt.withColumn("chunk", F.struct(F.coalesce(F.col("whole").cast("string"), F.lit("")).alias("whole"), "number"))
    return keyed.join(each, ["group", "chunk"]).select("node", "group", "part", F.lit(None).cast("binary").alias("place"))


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", max_shingles: int = MAX_SHINGLES, region: int = REGION) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: a row per document; links need ``percent`` percent common shingles."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, n_shingles bigint, one bigint, two bigint, labels binary, screen binary"
    described = stored(texts.mapInArrow(_describe(shingle), schema), "signatures")
    set_key = ["one", "two", "n_shingles"]
    classes = described.where("n_shingles > 0").groupBy(*set_key).agg(F.min("doc_id").alias("node"))
    # equal sets have equal signatures, so any row of a class will do
    chosen = described.where("n_shingles > 1").groupBy(*set_key).agg(F.min("doc_id").alias("node"), F.first("labels").alias("labels"), F.first("screen").alias("screen"))
    chosen = stored(chosen.select("node", "n_shingles", "labels", "screen"), "classes")

    fitting, crowded = _regions(_trees(chosen), region)
    together = fitting.join(chosen.select("node", "screen"), "node").repartition("tree", "key").sortWithinPartitions("tree", "key")
    least = int((percent / 100 - SCREEN) * _LANES)
    joins = together.mapInArrow(_rough_joins(least), "a bigint, b bigint").unionByName(crowded)
    groups = stored(components(stored(joins.distinct(), "rough")), "rough-groups")
    totals = groups.join(chosen, "node").groupBy("component").agg(F.sum("n_shingles").alias("total"))
    large = stored(totals.where(F.col("total") > max_shingles).select("component"), "large-groups")

    def links(parts: DataFrame, limit: int | None) -> DataFrame:
        wanted = texts.join(parts, texts.doc_id == parts.node).select("node", "group", "part", "place", "text")
        sets = wanted.mapInArrow(_sets(shingle), "node bigint, group bigint, part binary, place binary, shingles binary")
        laid = sets.repartition("group", "part").sortWithinPartitions("group", "part", "place", "node")
        return stored(laid.mapInArrow(_confirm(percent, limit), "a bigint, b bigint"), "confirmed")

    confirmed = links(stored(_parts(groups, chosen, large), "parts"), max_shingles)
    found = components(confirmed)
    if not large.isEmpty():
        own = found.withColumnRenamed("component", "own")
        members = groups.join(large, "component").join(chosen.select("node", "n_shingles"), "node").join(own, "node", "left")
        members = members.select("node", F.col("component").alias("group"), F.coalesce("own", "node").alias("own"), "n_shingles")
        rest = links(stored(_chunk_pairs(stored(members, "members"), max_shingles), "parts"), None)
        found = components(confirmed.unionByName(rest))

    by_class = classes.join(found, "node", "left").select(*set_key, F.coalesce("component", "node").alias("component_id"))
    empty = described.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    full = described.join(by_class, set_key).select("doc_id", "n_shingles", "component_id")
    return full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
