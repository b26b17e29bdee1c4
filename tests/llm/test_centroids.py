"""Centroid clustering against a plain computation over all distances."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spendlens.llm.centroids import LARGEST, SIZE, cluster, nearest, walsh

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, coefficients string"


def plain(rows, count=40, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())
    centroids = [v for _, v in order[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if mine:
                centroids[k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assign()
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(d for d, _ in found)
    return sorted((i, k, d, sum(x for x, c in found if c == k), total, digests[k])
                  for (i, _), (d, k) in zip(kept, found))


def frame(spark, *rows):
    return spark.createDataFrame([(i, v, "c", "d", "e") for i, v in rows], SCHEMA)


def vectors(count, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, spread, SIZE).astype(np.float32)]) for i in range(count)]


def test_transform_is_exact_and_ordered():
    matrix = walsh()
    assert (matrix @ matrix.T == SIZE * np.eye(SIZE)).all()
    assert [(row[1:] != row[:-1]).sum() for row in matrix] == list(range(SIZE))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 30), st.integers(1, 12), st.integers(0, 10_000), st.sampled_from([1, 3, 2000, LARGEST]))
def test_search_equals_all_distances(n, k, seed, size):
    rng = np.random.default_rng(seed)
    points, centroids = rng.integers(-size, size + 1, (n, SIZE)), rng.integers(-size, size + 1, (k, SIZE))
    centroids[k // 2] = centroids[0]  # a tie
    points[0] = centroids[-1]
    found, distance = nearest(points @ walsh().T, centroids @ walsh().T)
    every = ((points[:, None] - centroids[None]).astype(object) ** 2).sum(axis=2)
    assert found.tolist() == [int(np.argmin(row)) for row in every]
    assert distance.tolist() == [min(row) for row in every]


@pytest.mark.parametrize("count", [3, 40, 300])
def test_equals_plain(spark, count):
    rows = vectors(count) + [(1000 + i, v) for i, v in vectors(5, seed=1)]  # five vectors twice
    found = cluster(frame(spark, *rows).repartition(7))
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_one_vector_holds_a_third_of_the_rows(spark):
    rows = vectors(60) + [(5000 + i, vectors(1, seed=9)[0][1]) for i in range(30)]
    assert sorted(map(tuple, cluster(frame(spark, *rows)).collect())) == plain(rows)


def test_unusable_and_repeated_rows(spark):
    good = vectors(6)
    bad = [(90, None), (91, []), (92, [0.5] * 63), (93, [0.5] * 65), (94, [None] + [0.5] * 63),
           (95, [float("nan")] + [0.5] * 63), (96, [float("-inf")] + [0.5] * 63)]
    again = [good[0], (None, good[1][1])]
    found = cluster(frame(spark, *good, *bad, *again)).collect()
    assert sorted(str(r["vec_id"]) for r in found) == sorted(["0", "0", "1", "2", "3", "4", "5", "None"])
    assert {r["distance"] for r in found} == {0}
    assert cluster(frame(spark, *bad)).collect() == []
    assert cluster(frame(spark)).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_components_beyond_exact_sums_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        cluster(frame(spark, (1, [1e9] * SIZE))).collect()
