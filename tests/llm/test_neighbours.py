"""Nearest neighbours: recall against all inner products, order, ties and unusable vectors."""

import numpy as np
import pytest

from passerby.llm import neighbours as nn


def exact(ids, vectors, query_id, query, nearest):
    scores = (vectors.astype(float) * query.astype(float)).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query_id][:nearest]
    return [(int(ids[i]), float(scores[i])) for i in order]


def table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v], "x") for i, v in zip(ids, vectors, strict=True)],
                                 "vec_id long, embedding array<float>, score string")


def recall(found, ids, vectors, nearest=20):
    got = {}
    for row in found:
        got.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    hits = 0
    for query_id, rows in got.items():
        rows.sort()
        assert [rank for rank, _, _ in rows] == list(range(1, len(rows) + 1))
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        best = exact(ids, vectors, query_id, vectors[list(ids).index(query_id)], nearest)
        hits += len({v for _, v, _ in rows} & {v for v, _ in best})
    return hits / (nearest * len(got))


@pytest.mark.parametrize("stretch", [0.0, 1.0])
def test_recall_over_several_shards(spark, stretch):
    chance = np.random.default_rng(5)
    vectors = chance.standard_normal((3000, 32)) * np.exp(stretch * chance.standard_normal((3000, 1)))
    vectors, ids = vectors.astype(np.float32), np.arange(3000)
    rows = table(spark, ids, vectors)
    found = nn.search(nn.build(rows, shard_rows=900), rows.filter("vec_id % 20 = 0"), candidates=3000, block_rows=40).collect()
    assert len(found) == 150 * 20 and recall(found, ids, vectors) >= 0.9


def test_ascent_takes_in_more_until_there_are_enough():
    chance = np.random.default_rng(6)
    vectors, ids = chance.standard_normal((2000, 16)).astype(np.float32), np.arange(2000)
    forest = nn.Forest.grow(ids, vectors, trees=8)
    few, many, every = (dict((at, set(i)) for at, i, _ in forest.search(ids[:50], vectors[:50], 20, n)) for n in (30, 800, 10**9))
    hits = lambda found: sum(len(found[at] & every[at]) for at in every)
    assert hits(few) < hits(many) <= hits(every) == 50 * 20
    assert all({v for v, _ in exact(ids, vectors, at, vectors[at], 20)} == every[at] for at in every)


def test_longest_prefix_and_ranges():
    forest = nn.Forest.grow(np.arange(300), np.random.default_rng(7).standard_normal((300, 8)).astype(np.float32), trees=4)
    codes = forest.sorted[:, ::30] ^ np.uint32(1 << 9)
    for depth in (0, 1, 5, 31, 32):
        lo, hi = forest.ranges(codes, depth)
        for tree in range(4):
            for query in range(codes.shape[1]):
                same = (forest.sorted[tree] >> np.uint32(32 - depth) == codes[tree, query] >> np.uint32(32 - depth)) if depth else np.ones(300, bool)
                assert hi[tree, query] - lo[tree, query] == same.sum()
    longest = forest.longest(codes)
    for query in range(codes.shape[1]):
        best = max(32 - int(int(a) ^ int(codes[tree, query])).bit_length() for tree in range(4) for a in forest.sorted[tree])
        assert longest[query] == best


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(20, [1.0, 0.0]), (3, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (40, [0.0, 0.0]), (60, None), (80, [1.0, None]), (100, [float("nan"), 1.0]),
            (120, [float("inf"), 1.0]), (140, []), (None, [1.0, 1.0]), (160, [1.0, 2.0, 3.0]), (4, [-1.0, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = [tuple(row) for row in nn.nearest_of_every_twentieth(vectors).orderBy("query_id", "rank").collect()]
    assert found == [(20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 3, 2.0), (20, 4, 4, -1.0)]


def test_no_rows(spark):
    assert nn.nearest_of_every_twentieth(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
