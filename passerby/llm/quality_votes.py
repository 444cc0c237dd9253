"""Quality by the votes of the nearest labelled documents in a latent-semantic space."""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.llm.rows import held_out, remembers, sample_per_class

#: Labelled documents of each class that are learnt from, about so many and at most twice as many.
LEARN_DOCS = 2000
DIMENSIONS = 64
NEIGHBOURS = 15
THRESHOLD = 0.3
#: Numbers that words and forms of words are hashed to.
WORDS, FORMS = 4096, 1024
WIDTH = WORDS + FORMS
#: Documents that are turned into vectors and compared at once.
BLOCK = 256
#: Words that a worker remembers; the memory is emptied when it is full, which changes no result.
REMEMBERED = 500_000
SEED = 10


def form_of(word: str) -> str:
    """A word's form: runs of small letters as x, of others as X, of digits as 0, of the same sign as that sign."""
    signs = ("x" if c.islower() else "X" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return re.sub(r"(.)\1+", r"\1", "".join(signs))


class Places(dict):
    """For a word, the places of its lower-cased letters and of its form in a document's vector, in one number."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        letters = "".join(filter(str.isalpha, word)).lower()
        place = xxhash.xxh3_64_intdigest(letters) % WORDS << 16 | WORDS + xxhash.xxh3_64_intdigest(form_of(word)) % FORMS
        if len(word) <= 64:
            self[word] = place
        return place


_places = Places()
remembers("quality_votes", _places.clear)


def counts_of(text: str | None) -> np.ndarray:
    """How often each place occurs in a text.

    Beside words and their forms, three signs count among the forms: the share of
    words that equal the one before, lines that equal an earlier one, and the
    magnitude of the number of words, which even an empty text has.
    """
    words = (text or "").split()
    found = Counter(words)
    places = np.fromiter(map(_places.__getitem__, found), np.int64, len(found))
    times = np.fromiter(found.values(), np.float32, len(found))
    out = np.bincount(places >> 16, times, WIDTH) + np.bincount(places & 0xFFFF, times, WIDTH)
    lines = [line for line in (text or "").split("\n") if line.strip()]
    same = sum(map(eq, words, words[1:]))
    for sign, n in ((f"same words {10 * same // max(1, len(words))}", 1 + len(words) // 4),
                    ("same line", 8 * (len(lines) - len({*lines}))),
                    (f"length {len(words).bit_length()}", 1 + len(words) // 20)):
        out[WORDS + xxhash.xxh3_64_intdigest(sign) % FORMS] += n
    return out.astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """What scoring needs; its size depends on the parameters alone, a few MB."""

    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def place(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space; words and forms weigh the same before the projection."""
        return _unit(weighed(counts, self.rarity) @ self.axes)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The share of good labels among the nearest, by similarity and by how many documents each stands for."""
        if not len(self.vectors):
            return np.zeros(len(counts))
        near = np.round(self.place(counts) @ self.vectors.T, 6)
        k = min(neighbours, near.shape[1])
        # Ties in similarity go to the earlier of the labelled vectors, which are in the order of their ids.
        best = np.argsort(-near, axis=1, kind="stable")[:, :k] if near.shape[1] <= 64 else _largest(near, k)
        vote = np.maximum(np.take_along_axis(near, best, axis=1), 1e-6) * self.weights[best]
        return (vote * self.labels[best]).sum(axis=1) / vote.sum(axis=1)


def _largest(near: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, ties to the smaller place."""
    kth = -np.partition(-near, k - 1, axis=1)[:, k - 1:k]
    above = near > kth
    level = near == kth
    chosen = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    return np.nonzero(chosen)[1].reshape(len(near), k)


def weighed(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts) * rarity
    return np.concatenate([_unit(rows[:, :WORDS]), _unit(rows[:, WORDS:])], axis=1)


def axes_of(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors of ``rows``, found from a random start by repeated projection."""
    start = np.random.default_rng(SEED).standard_normal((rows.shape[1], dimensions + 8)).astype(np.float32)
    for _ in range(4):
        start = np.linalg.qr(rows.T @ (rows @ start))[0]
    _, _, turned = np.linalg.svd(rows @ start, full_matrices=False)
    return np.ascontiguousarray((start @ turned.T)[:, :dimensions])


def learn(docs: DataFrame, labels: DataFrame, bound: int = LEARN_DOCS, dimensions: int = DIMENSIONS) -> Model:
    """A model from about ``bound`` labelled documents of each class, whole texts, none of them held out.

    The sample's ids are sent to where the texts are, its counts (a few hundred
    numbers for each document) come to the driver, which finds the axes. Where
    a document has two labels, the smaller counts.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    totals = {row["quality"]: row["count"] for row in usable.groupBy("quality").count().collect()}
    sample = F.broadcast(sample_per_class(usable, "quality", "doc_id", bound, SEED))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts_of(text) for text in batch.column(2).to_pylist()]
            places = [np.flatnonzero(row).astype(np.int32) for row in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int32())),
                pa.array([row[at] for row, at in zip(rows, places, strict=True)], pa.list_(pa.float32()))], ["doc_id", "quality", "places", "times"])

    texts = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "quality", "text")
    got = texts.mapInArrow(count, T.StructType([docs.schema["doc_id"], T.StructField("quality", T.IntegerType()),
                           T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.FloatType()))])).toPandas()
    got = got.sort_values("doc_id", kind="stable")
    counts = np.zeros((len(got), WIDTH), np.float32)
    for row, places, times in zip(counts, got["places"], got["times"], strict=True):
        row[places] = times
    quality = got["quality"].to_numpy(float)
    if not len(got):
        return Model(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), quality, quality)
    rarity = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    rows = weighed(counts, rarity)
    axes = axes_of(rows, min(dimensions, *rows.shape))
    seen = Counter(quality.tolist())
    weights = np.array([totals[int(q)] / seen[q] for q in quality])
    return Model(rarity, axes, _unit(rows @ axes), quality, weights / weights.max())


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted, replacing columns of these names.

    The score is between 0 and 1, near 1 where good labels surround a text. A
    null text is an empty one; both are judged by labelled texts of like length.
    Without labelled documents every score is 0. Repeated rows and ties give the
    same answer in every run; texts are read whole; other columns pass through.
    """
    kept = docs.drop("score", "predicted")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = kept.sparkSession.sparkContext.broadcast(model)
    at = kept.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                scores = shared.value.score(np.stack([counts_of(text) for text in part.column(at).to_pylist()]))
                scores = np.clip(np.round(scores, 6), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))],
                    [field.name for field in schema.fields])

    return kept.mapInArrow(score, schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return classify(docs.select("doc_id", "text"), learn(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
