"""Quality votes: exact neighbours, held-out accuracy, edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from passerby.llm import quality_votes as v
from passerby.llm.rows import held_out


def rows_of(n=500):
    chance = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = [chance.choice(["the", "stone", "reader", "other", "within", "thing"]) + chance.choice(["", "s", "ed", "ly"]) for _ in range(chance.randrange(15, 60))]
        good = i % 5 > 0
        rows.append((i, " ".join(words if good else [w + chance.choice(["###", "$$$", "!!"]) for w in words])))
        labels.append((i, int(good)))
    return rows, labels


def tables(spark):
    rows, labels = rows_of()
    rows += [(900, None), (901, ""), (None, "the stone"), (3, rows[3][1]), (902, "word " * 20_000)]
    docs = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, score string")
    return docs, spark.createDataFrame([*labels, (3, 1), (None, 1), (4, None), (950, 0)], "doc_id long, quality int")


def test_held_out_accuracy_and_edges(spark):
    docs, labels = tables(spark)
    found = v.scores(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3) for row in found)
    judged = [row for row in found if row.held_out and row.doc_id is not None and row.doc_id < 900]
    assert len(judged) > 60 and all(row.predicted == int(row.doc_id % 5 > 0) for row in judged)
    by_id = {row.doc_id: row for row in found}
    assert by_id[900].score == by_id[901].score and by_id[None].held_out


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = tables(spark)
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(str, v.scores(docs, labels).collect())) == sorted(map(str, v.scores(docs, turned).collect()))


def test_votes_of_the_exact_neighbours(spark):
    docs, labels = tables(spark)
    model = v.learn(docs, labels)
    counts = np.stack([v.counts_of(text) for _, text in rows_of(40)[0]])
    near = np.round(model.place(counts) @ model.vectors.T, 6)
    for row, score in zip(near, model.score(counts), strict=True):
        best = sorted(range(len(row)), key=lambda i: (-row[i], i))[:v.NEIGHBOURS]
        vote = [max(row[i], 1e-6) * model.weights[i] for i in best]
        assert np.isclose(score, sum(w * model.labels[i] for w, i in zip(vote, best, strict=True)) / sum(vote), atol=1e-5)


def test_axes_are_singular_vectors():
    rows = np.random.default_rng(1).standard_normal((60, 5)).astype(np.float32) @ np.random.default_rng(2).standard_normal((5, 40)).astype(np.float32)
    axes, exact = v.axes_of(rows, 5), np.linalg.svd(rows, full_matrices=False)[2][:5]
    assert np.allclose(np.abs(axes.T @ exact.T), np.eye(5), atol=1e-3)


def test_forms():
    assert [v.form_of(w) for w in ("Thnd***", "ABC", "a1b22", "être", "...")] == ["Xx*", "X", "x0x0", "x", "."]


def test_no_rows_and_no_labels(spark):
    docs, labels = tables(spark)
    assert v.scores(docs.limit(0), labels).count() == 0
    assert {row.score for row in v.scores(docs, labels.limit(0)).collect()} == {0.0}
