"""Centroid clustering in whole numbers, with distances bounded below by rotated coordinates.

The vectors are turned so that the first axes hold most of their spread (the
principal axes), and each is stored with its leading coordinates and the length
of the rest. The squared distance of the leading coordinates plus the squared
difference of the two rest lengths is never more than the squared distance of
the vectors, so a centroid whose bound exceeds a distance already known cannot
be the nearest. The distances to the others are computed in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerby.llm.rows import make_room
from passerby.session import cut_lineage

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: Leading coordinates that are stored.
LEADING = 16
#: A component beyond this could make a squared distance too large for 64 bits.
LARGEST = 1 << 27
#: By this share of the squared lengths, and by half, a bound in floating point may be too high.
SLACK = 1e-9
#: Vectors that are compared at once, and pairs that are verified at once.
SLICE, PAIRS = 4_096, 32_768

STORED = "vec_id long, whole binary, leading binary, rest double"
RESULT = ("vec_id long, cluster int, distance long", "cluster_inertia long, inertia long, centroid_sha256 string")


def whole(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id and components as whole numbers, floor(256 x), of the vectors that take part."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    def number(x: Column) -> Column:
        times = F.lit(float(SCALE)) * x
        return F.when(F.abs(times) < F.lit(float(LARGEST)), F.floor(times)).otherwise(
            F.raise_error(F.lit("a component is too large for distances in 64 bits")).cast("long"))

    components = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), components.alias("components")).filter(
        (F.size("components") == dimensions) & F.forall("components", finite))
    return rows.select("vec_id", F.transform("components", number).alias("whole"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _rows(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _packed(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix], pa.binary())


def starts(rows: DataFrame, centroids: int = CENTROIDS) -> np.ndarray:
    """The vectors whose ids have the smallest digests, in that order; rows that share an id by their components."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "whole").limit(centroids).select("whole").collect()
    return np.array([row.whole for row in first], np.int64)


@dataclass(frozen=True)
class Rotation:
    """The mean of all vectors and their principal axes, those of the widest spread first."""

    mean: np.ndarray
    axes: np.ndarray

    @classmethod
    def fit(cls, rows: DataFrame, dimensions: int = DIMENSIONS) -> Rotation:
        """From the sums of all products of two components: each task has one matrix, and its rows are summed by Spark."""
        names = [f"m{i}" for i in range(dimensions + 1)]

        def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((dimensions + 1, dimensions + 1))
            for batch in batches:
                values = _matrix(batch.column(0), dimensions).astype(float)
                values = np.concatenate([values, np.ones((len(values), 1))], axis=1)
                total += values.T @ values
            yield pa.RecordBatch.from_arrays([pa.array(range(dimensions + 1), pa.int32()), *map(pa.array, total.T)], ["axis", *names])

        schema = "axis int, " + ", ".join(f"{name} double" for name in names)
        sums = rows.select("whole").mapInArrow(products, schema).groupBy("axis").agg(*[F.sum(name).alias(name) for name in names])
        matrix = np.array([row[1:] for row in sorted(sums.collect())]).reshape(dimensions + 1, dimensions + 1)
        mean = matrix[dimensions, :dimensions] / matrix[dimensions, dimensions]
        spread = matrix[:dimensions, :dimensions] / matrix[dimensions, dimensions] - np.outer(mean, mean)
        return cls(mean, np.linalg.eigh((spread + spread.T) / 2)[1][:, ::-1])

    def turn(self, vectors: np.ndarray, leading: int = LEADING) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates of vectors and the lengths of the rest, each from its own coordinates."""
        turned = (vectors - self.mean) @ self.axes
        return turned[:, :leading], np.sqrt((turned[:, leading:] ** 2).sum(axis=1))


def store(rows: DataFrame, rotation: Rotation) -> DataFrame:
    """The vectors with what the filter needs, written once and read in every round."""
    width = len(rotation.mean)

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("centroids")
        for batch in batches:
            vectors = _matrix(batch.column(1), width)
            leading, rest = rotation.turn(vectors)
            columns = [batch.column(0), _packed(vectors.astype("<i4")), _packed(leading), pa.array(rest)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "whole", "leading", "rest"])

    return cut_lineage(rows.mapInArrow(turned, STORED))


@dataclass(frozen=True)
class Centroids:
    """The centroids of a round, whole and turned."""

    vectors: np.ndarray
    leading: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, rotation: Rotation) -> Centroids:
        return cls(vectors, *rotation.turn(vectors))

    def nearest(self, vectors: np.ndarray, leading: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, ties to the smaller number, and pairs verified."""
        own, theirs = (leading ** 2).sum(axis=1)[:, None], (self.leading ** 2).sum(axis=1)
        bounds = own + theirs - 2 * (leading @ self.leading.T) + (rest[:, None] - self.rest) ** 2
        slack = SLACK * (own + rest[:, None] ** 2 + theirs + self.rest ** 2) + 0.5
        every = np.arange(len(vectors))
        first = bounds.argmin(axis=1)
        distances = np.full(bounds.shape, np.iinfo(np.int64).max)
        distances[every, first] = known = self.exact(vectors, every, first)
        left = bounds <= known[:, None] + slack
        left[every, first] = False
        at, number = np.nonzero(left)
        distances[at, number] = self.exact(vectors, at, number)
        best = distances.argmin(axis=1)
        return best, distances[every, best], len(vectors) + len(at)

    def exact(self, vectors: np.ndarray, at: np.ndarray, number: np.ndarray) -> np.ndarray:
        parts = [((vectors[at[i:i + PAIRS]] - self.vectors[number[i:i + PAIRS]]) ** 2).sum(axis=1) for i in range(0, len(at), PAIRS)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def in_slices(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, int]]:
        """A stored batch in slices: (slice, vectors, nearest, distance, pairs verified)."""
        for first in range(0, batch.num_rows, SLICE):
            part = batch.slice(first, SLICE)
            vectors = _rows(part.column("whole"), "<i4", self.vectors.shape[1]).astype(np.int64)
            leading = _rows(part.column("leading"), "<f8", self.leading.shape[1])
            yield part, vectors, *self.nearest(vectors, leading, part.column("rest").to_numpy())


def moved(stored: DataFrame, centroids: Centroids) -> tuple[np.ndarray, int]:
    """The centroids after a round, and how many pairs were verified in whole numbers.

    A task gives one row of sums for each centroid; these are added by Spark as
    decimals, so no sum can overflow.
    """
    count, width = centroids.vectors.shape
    names = [f"s{i}" for i in range(width)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("centroids")
        total, members, verified = np.zeros((count, width), np.int64), np.zeros(count, np.int64), 0
        for batch in batches:
            for _, vectors, number, _, pairs in centroids.in_slices(batch):
                order = np.argsort(number, kind="stable")
                held, first = np.unique(number[order], return_index=True)
                total[held] += np.add.reduceat(vectors[order], first, axis=0)
                members += np.bincount(number, minlength=count)
                verified += pairs
        work = np.where(np.arange(count) == 0, verified, 0)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (np.arange(count, dtype=np.int32), members, work, *total.T)],
                                         ["cluster", "members", "verified", *names])

    schema = "cluster int, members long, verified long, " + ", ".join(f"{name} long" for name in names)
    added = stored.mapInArrow(sums, schema).groupBy("cluster").agg(
        F.sum("members"), F.sum("verified"), *[F.sum(F.col(name).cast("decimal(38,0)")) for name in names])
    after, verified = centroids.vectors.copy(), 0
    for cluster, members, pairs, *total in added.collect():
        verified += pairs
        if members:
            after[cluster] = [int(value) // members for value in total]
    return after, verified


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> DataFrame:
    """Vectors with their cluster after ``rounds`` rounds from ``centroids`` start vectors.

    One row for each vector with exactly ``dimensions`` components, none of them
    null or non-finite: vec_id, cluster, distance (squared, to the final
    centroid), cluster_inertia, inertia, centroid_sha256. All else takes no part.
    Fewer vectors than centroids give that many clusters; no vectors give no
    rows. Repeated rows and ids count each on its own, equal vectors as starts
    give equal centroids of which the first takes all; a vector without an id is
    clustered, and starts only where ids are too few. Extra columns play no part.
    """
    session = vectors.sparkSession
    rows = whole(vectors, dimensions)
    chosen = starts(rows, centroids)
    if not len(chosen):
        return session.createDataFrame([], ", ".join(RESULT))
    rotation = Rotation.fit(rows, dimensions)
    stored = store(rows, rotation)
    for _ in range(rounds):
        chosen, _ = moved(stored, Centroids.of(chosen, rotation))
    last = Centroids.of(chosen, rotation)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("centroids")
        for batch in batches:
            for part, _, number, distance, _ in last.in_slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)],
                                                 ["vec_id", "cluster", "distance"])

    assigned = cut_lineage(stored.mapInArrow(assign, RESULT[0]))
    # One row for each centroid.
    inertia = {row[0]: int(row[1]) for row in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in chosen.tolist()]
    figures = session.createDataFrame([(at, total, sum(inertia.values()), digests[at]) for at, total in inertia.items()],
                                      f"cluster int, {RESULT[1]}")
    return assigned.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The rounds one after the other; all numbers stay below 2^53 on the tables, so doubles are exact."""
    steps = [r"""
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS MATERIALIZED (SELECT place, unnest(range(64)) AS axis, unnest(v) AS x FROM vectors),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY digest NULLS LAST, v) - 1 AS cluster, v
    FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS digest, v FROM vectors ORDER BY digest NULLS LAST, v LIMIT 40))"""]
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
    SELECT place, min(struct_pack(d := d, c := cluster)) AS best FROM (
        SELECT place, cluster, list_inner_product(vectors.v, vectors.v) + list_inner_product(c.v, c.v) - 2 * list_inner_product(vectors.v, c.v) AS d
        FROM vectors, c{n} c) GROUP BY place)""")
        if n < ROUNDS:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (
        SELECT cluster, list(mean ORDER BY axis) AS v FROM (
            SELECT best.c AS cluster, axis, floor(sum(x) / count(*)) AS mean FROM parts JOIN a{n} USING (place) GROUP BY best.c, axis)
        GROUP BY cluster) m USING (cluster))""")
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM vectors JOIN a{ROUNDS} USING (place) JOIN c{ROUNDS} c ON c.cluster = best.c
"""


ORACLE = _oracle()
