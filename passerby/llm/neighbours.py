"""Approximate nearest neighbours by a forest of hash prefixes.

Every vector has, for each tree, a long string of bits: the sides of random
planes on which it lies. A tree is the sorted array of these strings. A query
descends each tree to the entries that share its longest prefix; then all trees
ascend together, one bit less at a time, and take in all entries that share the
shorter prefix, until enough candidates are found. These are compared exactly.

The vectors are dealt out over shards of bounded size, each with a forest of its
own, and the queries over blocks; every block of queries visits every shard.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passerby.functions.sizes import broadcast_if_small
from passerby.session import cut_lineage

TREES = 128
BITS = 32
#: About so many vectors make a shard, and so many queries a block.
SHARD_ROWS = 8192
BLOCK_ROWS = 4096
#: The ascent in a shard ends when its trees together give so many candidates, repeats included.
CANDIDATES = 6000
NEAREST = 20
SEED = 1


def planes(dimensions: int, trees: int, bits: int, seed: int = SEED) -> np.ndarray:
    """The normals of each tree's planes, the same in every task."""
    return np.random.default_rng(seed).standard_normal((dimensions, trees * bits)).astype(np.float32)


def strings(vectors: np.ndarray, normals: np.ndarray, trees: int) -> np.ndarray:
    """A row of bit strings for each tree, as numbers of 32 bits whose first bit is the highest."""
    out = np.empty((trees, len(vectors)), np.uint32)
    for first in range(0, len(vectors), 1024):
        sides = (vectors[first:first + 1024].astype(np.float32) @ normals > 0).reshape(-1, trees, BITS)
        packed = np.packbits(sides, axis=2).view(">u4")[:, :, 0]
        out[:, first:first + 1024] = packed.T
    return out


@dataclass
class Forest:
    """The sorted arrays of one shard, with the vectors themselves."""

    ids: np.ndarray
    vectors: np.ndarray
    sorted: np.ndarray
    order: np.ndarray

    @classmethod
    def grow(cls, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES) -> "Forest":
        """Inner products become angles by one more coordinate, which fills each vector up to the longest."""
        squares = (vectors.astype(float) ** 2).sum(axis=1)
        filled = np.concatenate([vectors, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]], axis=1)
        codes = strings(filled, planes(filled.shape[1], trees, BITS), trees)
        order = np.argsort(codes, axis=1, kind="stable").astype(np.uint32)
        return cls(ids, vectors, np.take_along_axis(codes, order.astype(np.int64), axis=1), order)

    def ranges(self, codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First entry and end, in each tree (rows) for each query (columns), of those that share ``depth`` bits."""
        if depth == 0:
            return np.zeros(codes.shape, np.int64), np.full(codes.shape, len(self.ids), np.int64)
        free = np.uint32(0xFFFFFFFF) >> np.uint32(depth) if depth < BITS else np.uint32(0)
        low, high = codes & ~free, codes | free
        lo, hi = np.empty(codes.shape, np.int64), np.empty(codes.shape, np.int64)
        for tree, line in enumerate(self.sorted):
            lo[tree], hi[tree] = np.searchsorted(line, low[tree]), np.searchsorted(line, high[tree], side="right")
        return lo, hi

    def longest(self, codes: np.ndarray) -> np.ndarray:
        """The longest prefix that each query shares with any entry of any tree."""
        depth = np.zeros(codes.shape[1], np.int64)
        for tree, line in enumerate(self.sorted):
            at = np.searchsorted(line, codes[tree])
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(line) - 1)):
                differ = (line[near] ^ codes[tree]).astype(np.float64)
                depth = np.maximum(depth, np.where(differ > 0, BITS - 1 - np.floor(np.log2(np.maximum(differ, 1))), BITS).astype(np.int64))
        return depth

    def search(self, query_ids: np.ndarray, queries: np.ndarray, nearest: int, candidates: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's number, ids, inner products) of the nearest that the forest finds, nearest first, ties to the smaller id."""
        trees = len(self.sorted)
        turned = np.concatenate([queries, np.zeros((len(queries), 1), queries.dtype)], axis=1)
        codes = strings(turned, planes(turned.shape[1], trees, BITS), trees)
        level, wanted = self.longest(codes), max(candidates, nearest + 1)
        waiting = np.ones(len(queries), bool)
        taken = np.zeros(len(self.ids), bool)
        exact = queries.astype(float)
        for depth in range(int(level.max(initial=0)), -1, -1):
            now = np.flatnonzero(waiting & (level >= depth))
            if not len(now):
                continue
            lo, hi = self.ranges(codes[:, now], depth)
            full = (hi - lo).sum(axis=0) >= wanted if depth else np.ones(len(now), bool)
            for at in np.flatnonzero(full):
                taken[:] = False
                for tree, (first, end) in enumerate(zip(lo[:, at].tolist(), hi[:, at].tolist(), strict=True)):
                    taken[self.order[tree, first:end]] = True
                found = np.flatnonzero(taken)
                found = found[self.ids[found] != query_ids[now[at]]]
                yield int(now[at]), *self.best(found, exact[now[at]], nearest)
            waiting[now[full]] = False

    def best(self, found: np.ndarray, query: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
        scores = (self.vectors[found].astype(float) * query).sum(axis=1)
        if len(found) > nearest:
            kth = np.partition(scores, len(scores) - nearest)[len(scores) - nearest]
            found, scores = found[scores >= kth], scores[scores >= kth]
        first = np.lexsort((self.ids[found], -scores))[:nearest]
        return self.ids[found[first]], scores[first]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part: with an id, no null or non-finite component, and not all zero."""
    component = F.col("embedding").cast("array<double>")
    fine = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine & F.exists(component, lambda x: x != 0))


FOREST = "shard int, dimensions int, ids binary, vectors binary, sorted binary, ordered binary"
FOUND = "query_id long, vec_id long, score double"


def build(vectors: DataFrame, trees: int = TREES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index of all usable vectors: a row of sorted arrays for each shard, written once.

    Rows are dealt out by a hash of their id; rows that repeat an id are kept
    apart by their place in the shard. Vectors of another length have shards of
    their own, as they have no inner product with the rest.
    """
    rows = usable(vectors).withColumn("dimensions", F.size("embedding"))
    shards = max(1, -(-rows.count() // shard_rows))

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        forest = Forest.grow(pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["embedding"].to_numpy()).astype(np.float32), trees)
        return pd.DataFrame({"shard": [key[0]], "dimensions": [key[1]], "ids": [forest.ids.tobytes()], "vectors": [forest.vectors.tobytes()],
                             "sorted": [forest.sorted.tobytes()], "ordered": [forest.order.tobytes()]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return cut_lineage(dealt.groupBy("shard", "dimensions").applyInPandas(grow, FOREST))


def search(index: DataFrame, queries: DataFrame, nearest: int = NEAREST, candidates: int = CANDIDATES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``nearest`` entries of the index for each query: query_id, rank, vec_id, score.

    An entry with the query's own id is none of its neighbours. Fewer are given
    only if the index has fewer of the query's length. Ties go to the smaller id;
    queries that are not usable give no rows; queries that repeat an id are one.
    """
    rows = usable(queries).dropDuplicates(["vec_id"]).withColumn("dimensions", F.size("embedding"))
    blocks = max(1, -(-rows.count() // block_rows))
    # A row of two numbers for each shard.
    shards = broadcast_if_small(index.select(F.col("shard").alias("of_shard"), F.col("dimensions").alias("of_length")))
    asked = rows.withColumn("of_block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int")).join(
        shards, F.col("dimensions") == F.col("of_length")).drop("dimensions")
    trees = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def visit(forests: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        if not len(forests) or not len(pdf):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        row = forests.iloc[0]
        ids = np.frombuffer(row["ids"], np.int64)
        shape = (-1, len(ids))
        forest = Forest(ids, np.frombuffer(row["vectors"], np.float32).reshape(len(ids), -1),
                        np.frombuffer(row["sorted"], np.uint32).reshape(shape), np.frombuffer(row["ordered"], np.uint32).reshape(shape))
        own = pdf["vec_id"].to_numpy(np.int64)
        found = list(forest.search(own, np.stack(pdf["embedding"].to_numpy()).astype(np.float32), nearest, candidates))
        return pd.DataFrame({"query_id": np.repeat(own[[at for at, _, _ in found]], [len(i) for _, i, _ in found]),
                             "vec_id": np.concatenate([i for _, i, _ in found]), "score": np.concatenate([s for _, _, s in found])})

    found = trees.groupBy("shard", "dimensions", "block").cogroup(asked.groupBy("of_shard", "of_length", "of_block")).applyInPandas(visit, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def nearest_of_every_twentieth(vectors: DataFrame) -> DataFrame:
    """The 20 nearest of each row whose id is divisible by 20, among all other rows."""
    return search(build(vectors), vectors.filter(F.col("vec_id") % 20 == 0))


