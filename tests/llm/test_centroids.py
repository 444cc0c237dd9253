"""Clusters against plain whole-number arithmetic, the bounds against exact distances, odd rows."""

import hashlib
import math

import numpy as np
import pytest

from passerby.llm import centroids as c

SCHEMA = "cluster string, vec_id long, embedding array<double>, distance int"


def table(spark, rows):
    return spark.createDataFrame([("x", i, v, 0) for i, v in rows], SCHEMA)


def plain(rows, centroids, rounds, dimensions):
    """Sorted rows of the result, with Python's own numbers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest())
    means = [v for _, v in sorted(kept, key=lambda row: (digest(row[0]), row[1]))[:centroids]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), n) for n, m in enumerate(means)) for _, v in kept]
    for _ in range(rounds):
        nearest = assign()
        for n in range(len(means)):
            own = [v for (_, v), (_, at) in zip(kept, nearest, strict=True) if at == n]
            if own:
                means[n] = [sum(part) // len(own) for part in zip(*own, strict=True)]
    out, nearest = [], assign()
    for (i, _), (distance, n) in zip(kept, nearest, strict=True):
        out.append((i, n, distance, sum(d for d, at in nearest if at == n), sum(d for d, _ in nearest),
                    hashlib.sha256(",".join(map(str, means[n])).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(rows):
    return sorted((tuple(row) for row in rows.collect()), key=repr)


@pytest.mark.parametrize("kind", ["round", "flat", "coarse"])
def test_same_as_plain_numbers(spark, kind):
    chance = np.random.default_rng(3)
    vectors = chance.standard_normal((240, 64))
    if kind == "flat":
        vectors = vectors[:, :2] @ chance.standard_normal((2, 64)) + 0.01 * vectors
    if kind == "coarse":  # many ties and equal vectors
        vectors = np.floor(vectors[:, :1] * 2) / 2 + np.zeros((1, 64))
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    assert got(c.cluster(table(spark, rows), centroids=12, rounds=3)) == plain(rows, 12, 3, 64)


def test_odd_rows(spark):
    base = [float(i) for i in range(64)]
    rows = [(1, base), (1, base), (1, [-x for x in base]), (None, [0.5] * 64), (2, None), (3, []), (4, base[:-1]), (5, [None, *base[1:]]),
            (6, [math.nan, *base[1:]]), (7, [math.inf, *base[1:]]), (8, [-0.001] * 64)]
    assert got(c.cluster(table(spark, rows), centroids=3, rounds=2)) == plain(rows, 3, 2, 64)
    assert got(c.cluster(table(spark, rows))) == plain(rows, 40, 5, 64)
    empty = c.cluster(table(spark, rows).filter("vec_id > 100"))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        c.cluster(table(spark, [(1, [1e9] * 64)])).collect()


@pytest.mark.parametrize("size", [1, 1000, (1 << 27) - 1])
def test_bounds_never_exclude_the_nearest(size):
    chance = np.random.default_rng(size)
    vectors = chance.integers(-size, size + 1, (500, 64))
    vectors[:100] = vectors[0] + chance.integers(-1, 2, (100, 64))
    vectors = vectors.clip(-size, size)
    rotation = c.Rotation(vectors.mean(axis=0), np.linalg.eigh(np.cov(vectors.T))[1][:, ::-1])
    means = vectors[::11]
    number, distance, _ = c.Centroids.of(means, rotation).nearest(vectors, *rotation.turn(vectors))
    exact = ((vectors[:, None] - means) ** 2).sum(axis=2)
    assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_bounds_spare_most_pairs_where_few_axes_matter():
    chance = np.random.default_rng(4)
    middles = chance.integers(-4000, 4000, (40, 8))
    vectors = np.zeros((2000, 64), np.int64)
    vectors[:, :8] = middles[chance.integers(0, 40, 2000)]
    vectors = (vectors @ np.linalg.qr(chance.standard_normal((64, 64)))[0]).astype(np.int64) + chance.integers(-50, 50, (2000, 64))
    rotation = c.Rotation(vectors.mean(axis=0), np.linalg.eigh(np.cov(vectors.T))[1][:, ::-1])
    verified = c.Centroids.of(vectors[:40], rotation).nearest(vectors, *rotation.turn(vectors))[2]
    assert verified < 0.1 * 2000 * 40
