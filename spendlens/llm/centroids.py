"""Centroid clustering of vectors, each assignment found by a Walsh-Hadamard progressive search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import column, staged

SIZE = 64  # components of a vector
SCALE = 256
LARGEST = 1 << 24  # scaled components up to here keep all sums of squares exact in 64 bits
LEVELS = (0, 1, 2, 4, 8, 16, 32, SIZE)  # coefficients finished after each step, coarse to fine
SLICE = 2048  # vectors searched at once; a slice holds one pair per vector and centroid at most


@lru_cache(maxsize=1)
def walsh() -> np.ndarray:
    """The Hadamard matrix of order 64, rows by their number of sign changes, coarse first."""
    matrix = np.ones((1, 1), dtype=np.int64)
    while len(matrix) < SIZE:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(axis=1))]


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid of each point, smaller numbers first, and its distance.

    Both arguments hold transformed vectors, whose squared distances are 64 times those of the
    vectors. The differences of the first coefficients alone bound a distance from below. After
    every level the centroid that leads so far is finished, which bounds the smallest distance
    from above; only centroids that are strictly worse than that bound go. Those that remain have
    all 64 coefficients in the end, so ties are seen.
    """
    n, k = len(points), len(centroids)
    rows, numbers = np.divmod(np.arange(n * k), k)
    partial = np.zeros(n * k, dtype=np.int64)
    bound = np.full(n, np.iinfo(np.int64).max)
    for begin, end in pairwise(LEVELS):
        step = points[rows, begin:end] - centroids[numbers, begin:end]
        partial += np.einsum("ij,ij->i", step, step)
        leads = _leaders(rows, partial)
        if end < SIZE:
            rest = points[rows[leads], end:] - centroids[numbers[leads], end:]
            finished = partial[leads] + np.einsum("ij,ij->i", rest, rest)
            bound[rows[leads]] = np.minimum(bound[rows[leads]], finished)
            stays = partial <= bound[rows]
            rows, numbers, partial = rows[stays], numbers[stays], partial[stays]
    return numbers[leads], partial[leads] // SIZE


def _leaders(rows: np.ndarray, partial: np.ndarray) -> np.ndarray:
    """Of each row's pairs the place of the first that is smallest; pairs lie row by row."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    least = np.repeat(np.minimum.reduceat(partial, starts), np.diff(np.append(starts, len(rows))))
    found = np.flatnonzero(partial == least)
    return found[np.flatnonzero(np.diff(rows[found], prepend=-1))]


def _sliced(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [nearest(points[at:at + SLICE], centroids) for at in range(0, len(points), SLICE)]
    return tuple(np.concatenate(values) for values in zip(*parts))


def _coefficients(part: pa.RecordBatch) -> np.ndarray:
    return part.column("coefficients").flatten().to_numpy().astype(np.int64).reshape(-1, SIZE)


def _usable(vector: Column) -> Column:
    """True for vectors of 64 components that are all finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == SIZE) & finite, F.lit(False))


def transformed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, coefficients) of the usable rows: floor(256 x) of each component, transformed."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
            scaled = np.floor(values * SCALE)
            if len(scaled) and np.abs(scaled).max() > LARGEST:
                raise ValueError(f"{SCALE} times a component is beyond {LARGEST}: distances would not be exact")
            found = (scaled.astype(np.int64) @ walsh().T).astype(np.int32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), SIZE)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), lists.cast(pa.list_(pa.int32()))], ["vec_id", "coefficients"])

    rows = vectors.select(column(id_col).alias("vec_id"), column(vector_col).alias("vector"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    return (rows.filter(_usable(F.col("vector")))
            .select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
            .mapInArrow(batches, f"vec_id {kind}, coefficients array<int>"))


def first_centroids(points: DataFrame, count: int, salt: str) -> np.ndarray:
    """The vectors with the smallest hashed ids; ids that repeat are ordered by their coefficients,
    and a null id, which has no decimal, comes last."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = points.orderBy(digest.asc_nulls_last(), "coefficients").limit(count).select("coefficients")
    return np.array([r.coefficients for r in rows.collect()], dtype=np.int64).reshape(-1, SIZE)


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floored mean of each one's vectors; empty ones stay.

    A task sends one row per centroid and component, summed over all its vectors, so no cluster,
    however large, meets in one place as vectors. What is collected is 64 sums per centroid.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), dtype=np.int64)
        for part in parts:
            if part.num_rows:
                found, _ = _sliced(points := _coefficients(part), centroids)
                np.add.at(sums, found, points)
                counts += np.bincount(found, minlength=len(centroids))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, SIZE)), pa.array(np.tile(np.arange(SIZE), len(used))),
             pa.array(sums[used].ravel()), pa.array(np.repeat(counts[used], SIZE))],
            ["cluster", "place", "total", "n"])

    totals = (points.select("coefficients")
              .mapInArrow(batches, "cluster long, place long, total long, n long")
              .groupBy("cluster", "place")
              .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")))
    by_cluster: dict[int, list] = {}
    counts: dict[int, int] = {}
    for row in totals.collect():
        by_cluster.setdefault(row.cluster, [0] * SIZE)[row.place] = int(row.total)
        counts[row.cluster] = row.n
    after, matrix = centroids.copy(), walsh()
    for cluster, total in by_cluster.items():
        # the transform is its own inverse but for the factor 64; Python's integers do not overflow
        sums = [sum(int(sign) * value for sign, value in zip(signs, total)) // SIZE for signs in matrix.T]
        after[cluster] = matrix @ np.array([s // counts[cluster] for s in sums], dtype=np.int64)
    return after


def cluster(vectors: DataFrame, count: int = 40, rounds: int = 5, salt: str = "2:", id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Usable are vectors of exactly 64 finite components, each taken as floor(256 x). A null vector or
    one with a null, NaN or infinite component is left out. Repeated rows are vectors of their own; a
    null id is kept, but starts no centroid unless ids run out. With fewer usable vectors than
    ``count`` there are as many centroids as vectors, and an empty table gives no rows. Distance ties
    go to the smaller number. A scaled component beyond ``LARGEST`` is an error, since its distances
    would not be exact. Other columns are not read.

    The vectors are written once, transformed; each round reads them where they lie. Centroids
    (``count`` times 64 numbers) are all that the driver holds.
    """
    points = staged(transformed(vectors, id_col, vector_col), "coefficients")
    centroids = first_centroids(points, count, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(points, centroids)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                found, distance = _sliced(_coefficients(part), centroids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(found.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"])

    kind = points.schema["vec_id"].dataType.simpleString()
    assigned = staged(points.mapInArrow(batches, f"vec_id {kind}, cluster int, distance long"), "assigned")
    inertia = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    final = centroids @ walsh() // SIZE
    names = [(number, inertia.get(number, 0), sum(inertia.values()),
              hashlib.sha256(",".join(map(str, components.tolist())).encode()).hexdigest())
             for number, components in enumerate(final)]
    by_cluster = assigned.sparkSession.createDataFrame(
        names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(by_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(count: int = 40, rounds: int = 5, salt: str = "2:") -> str:
    """The same rows in SQL: plain distances to every centroid."""
    steps = [f"""
vectors AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS number,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: isfinite(x))) = {SIZE}),
start_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY digest, p) - 1 AS cluster, p
  FROM (SELECT sha256('{salt}' || vec_id) AS digest, p FROM vectors ORDER BY digest, p LIMIT {count}))"""]
    for r in range(rounds + 1):
        steps.append(f"""
found_{r} AS MATERIALIZED (
  SELECT number, any_value(vec_id) AS vec_id, any_value(p) AS p, min(near) AS near
  FROM (SELECT v.number, v.vec_id, v.p, struct_pack(
          d := CAST(list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT),
          cluster := c.cluster) AS near
        FROM vectors v, start_{r} c)
  GROUP BY number)""")
        if r < rounds:
            steps.append(f"""
mean_{r} AS MATERIALIZED (
  SELECT cluster, list(m ORDER BY place) AS p
  FROM (SELECT cluster, place, ((s - ((s % n) + n) % n) // n)::BIGINT AS m
        FROM (SELECT near.cluster AS cluster, place, sum(p[place]) AS s, count(*) AS n
              FROM found_{r}, range(1, {SIZE + 1}) AS places(place) GROUP BY ALL))
  GROUP BY cluster),
start_{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.p, s.p) AS p FROM start_{r} s LEFT JOIN mean_{r} m USING (cluster))""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, CAST(near.cluster AS INTEGER) AS cluster, near.d AS distance,
       CAST(sum(near.d) OVER (PARTITION BY near.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM found_{rounds} f JOIN start_{rounds} c ON c.cluster = f.near.cluster
"""
