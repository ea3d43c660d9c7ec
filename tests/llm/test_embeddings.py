"""Links of vectors against all pairs in double precision."""

import math

import numpy as np
import pytest

from gradeloom.llm import embeddings
from gradeloom.llm.embeddings import Tile, tile_links


def brute(rows, threshold):
    """``(vec_id, n_links, component_id)`` by row."""
    def usable(v):
        return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v)

    units = [embeddings.unit(np.array([v], np.float64))[0] if usable(v) else None for _, v in rows]
    near = [[j for j, y in enumerate(units) if j != i and x is not None and y is not None and len(x) == len(y) and x @ y >= threshold] for i, x in enumerate(units)]
    out = []
    for i in range(len(rows)):
        reached, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(near[i]), min((rows[j][0] for j in reached if rows[j][0] is not None), default=None)))
    return out


def clusters(rng, n_clusters, size, dimensions, spread):
    centres = rng.normal(size=(n_clusters, dimensions))
    return [c + spread * rng.normal(size=dimensions) * np.linalg.norm(c) / math.sqrt(dimensions) for c in centres for _ in range(size)]


@pytest.mark.parametrize("block_rows, pivots", [(None, 256), (7, 256), (11, 1), (40, 5)])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_against_all_pairs(spark, block_rows, pivots, kind):
    rng = np.random.default_rng(5)
    dtype = np.float32 if kind == "float" else np.float64
    vectors = [v.astype(dtype).tolist() for v in clusters(rng, 6, 12, 16, 0.33)]  # cosines around the threshold
    vectors += [v.astype(dtype).tolist() for v in clusters(rng, 8, 3, 5, 0.2)]
    vectors += [vectors[0]] * 5 + [[2 * c for c in vectors[1]], [-c for c in vectors[2]]]
    vectors += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [None] * 3, [1e-30] * 16, [3e38] * 16, [-0.0] * 15 + [1.0], [0.0] * 15 + [1.0]]
    rows = [(None if k % 17 == 3 else 1000 - (k if k % 13 else 0), v) for k, v in enumerate(vectors)]
    table = spark.createDataFrame([(i, v, k, "b") for k, (i, v) in enumerate(rows)], f"vec_id bigint, embedding array<{kind}>, block int, class string").repartition(5)
    got = embeddings.embedding_links(table, 0.9, block_rows=block_rows, pivots=pivots).collect()
    assert sorted(map(str, ((r["vec_id"], r["n_links"], r["component_id"]) for r in got))) == sorted(map(str, brute(rows, 0.9)))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert sum(r["n_links"] for r in got) > 200


def test_empty_table_and_nothing_usable(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert embeddings.embedding_links(spark.createDataFrame([], schema)).count() == 0
    rows = embeddings.embedding_links(spark.createDataFrame([(4, None), (4, [0.0]), (None, [])], schema)).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [(4, 0, 4, True), (4, 0, 4, True), (None, 0, None, True)]))


@pytest.mark.parametrize("dimensions", [1, 3, 64, 1500])
def test_tiles_find_what_double_precision_finds_and_compute_few_pairs_again(dimensions):
    rng = np.random.default_rng(dimensions)
    base = rng.normal(size=(1, dimensions))
    near = base + rng.uniform(0.2, 0.7, (150, 1)) * rng.normal(size=(150, dimensions))
    vectors = np.concatenate((near, rng.normal(size=(150, dimensions)), near[:20] * 1e-3))
    unit = embeddings.unit(vectors)
    want = unit[:170] @ unit[170:].T >= 0.9
    i, j, again = tile_links(Tile(vectors[:170]), Tile(vectors[170:]), 0.9)
    got = np.zeros_like(want)
    got[i, j] = True
    assert (got == want).all() and again < want.size / 4
    if dimensions == 64:
        assert 0 < again


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(200, 24)) * 10.0 ** rng.integers(-20, 20, (200, 1))
    tile = Tile(vectors)
    exact = embeddings.unit(vectors) @ embeddings.unit(vectors).T
    near = embeddings.product(tile, tile) * tile.step[:, None] * tile.step[None, :]
    assert (np.abs(near - exact) <= tile.length[:, None] * tile.rest[None, :] + tile.rest[:, None]).all()


def test_far_blocks_are_left_out(spark):
    rng = np.random.default_rng(9)
    vectors = clusters(rng, 10, 30, 32, 0.1)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    rows = embeddings.classes(table)
    dealt, pairs = embeddings._dealt(rows, 0.9, 10, 256)
    n = dealt.select("block").distinct().count()
    assert n >= 20 and pairs.count() < n * (n + 1) // 2 / 2
    got = embeddings.embedding_links(table, block_rows=10).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(brute(list(enumerate(vectors)), 0.9))


def test_a_group_of_near_copies_sends_on_a_row_per_vector_and_not_per_pair(spark):
    rng = np.random.default_rng(2)
    vectors = clusters(rng, 1, 400, 16, 0.1)
    rows = embeddings.classes(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id bigint, embedding array<double>"))
    found = embeddings.class_links(rows, 0.9, block_rows=100)
    assert found.agg({"links": "sum"}).first()[0] == 400 * 399
    blocks = found.count() / 400
    assert blocks <= 12
