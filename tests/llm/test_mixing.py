"""Mixing: targets against a plain loop, draws, repeats and edge cases."""

from collections import Counter

import pytest

from passerby.llm import mixing


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3.0) -> dict:
    """The rule as it is told: share by weight, stop at the limit, share the excess again."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    out, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[n] for n in free)
        above = {n for n in free if unit * weight[n] >= most * sizes[n]}
        if not above:
            return out | {n: unit * weight[n] for n in free}
        for n in above:
            out[n] = most * sizes[n]
            left -= out[n]
        free -= above
    return out


CASES = [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 7}, {"z": 10, "Z": 10, "é": 10, None: 10}, {"only": 9},
    {"a": 0, "b": 50}, {"a": 0}, {f"s{i}": i * i for i in range(40)},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {row.source: row.target for row in mixing.targets(table).collect()}
    expected = plain_targets(sizes)
    assert found.keys() == expected.keys()
    for name, target in expected.items():
        assert found[name] == pytest.approx(target)


def docs_of(spark):
    rows = [(i, "w " * (1 + i % 30), f"s{i % 7}" if i % 50 else None, "x") for i in range(3000)]
    rows += [(5000, None, "s1", "x"), (5001, "", "s1", "x"), (5002, "long " * 5000, "s2", "x"), (None, "no id", "s3", "x"), (1, "w w", "s1", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target string")


def test_words_taken_come_near_the_targets(spark):
    rows = mixing.mixture(docs_of(spark)).collect()
    taken, target = Counter(), {}
    for row in rows:
        assert row.taken <= 3 * row["size"] and row.taken % max(1, row["size"]) == 0
        taken[row.source_size, row.target] += row.taken
        target[row.source_size, row.target] = row.target
    assert len(rows) == 3005
    for key, goal in target.items():
        assert taken[key] == pytest.approx(goal, rel=0.25)


def test_reruns_and_other_partitions_agree(spark):
    docs = docs_of(spark)
    one = sorted(map(tuple, mixing.mixture(docs).collect()), key=str)
    assert one == sorted(map(tuple, mixing.mixture(docs.repartition(7, "text")).collect()), key=str)


def test_documents_come_out_as_often_as_planned(spark):
    docs = docs_of(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    plan = Counter()
    for row in mixing.plan(mixing.sized(docs)).collect():
        plan[row.doc_id] += row.copies
    assert Counter(row.doc_id for row in mixed.collect()) == Counter({k: v for k, v in plan.items() if v})


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mixture(docs).count() == 0 and mixing.mix(docs).count() == 0
