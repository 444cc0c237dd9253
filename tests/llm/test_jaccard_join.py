"""Jaccard join: links and components against all pairs, texts of every kind."""

import random

import pytest

from passerby.llm import jaccard_join as jj
from passerby.llm.components import components


def plain(rows, words, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        size = min(words, len(w))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((doc_id, len(sets[i]), least[root(i)] if doc_id is not None else None) for i, (doc_id, _) in enumerate(rows)), key=str)


def texts(seed, groups=8, members=14, length=60):
    """Groups of copies with few and many changes, a line that all share, exact copies, texts of their own."""
    chance = random.Random(seed)
    word = lambda: chance.choice("abcdefgh") + str(chance.randrange(400))
    line, rows = [word() for _ in range(9)], []
    for _ in range(groups):
        base = line + [word() for _ in range(chance.randrange(5, length))]
        for m in range(members):
            copy = list(base)
            for _ in range(chance.randrange(0, 5) if m else 0):
                at = chance.randrange(len(copy))
                copy[at:at + 1] = chance.choice([[], [word()], [word(), word()]])
            rows.append(" ".join(copy))
    rows += [" ".join(word() for _ in range(30)) for _ in range(20)] + rows[:10]
    chance.shuffle(rows)
    return rows


HARD = [None, "", "  \n ", "One", "one", "one two", "One  TWO", "É x y", "é x y", "x" * 3000, "a a a a a a a a", "a a a a a"]


@pytest.mark.parametrize("words, percent, seed", [(3, 90, 1), (5, 80, 2), (3, 90, 3), (1, 50, 4)])
def test_components_as_by_all_pairs(spark, words, percent, seed):
    rows = list(enumerate(texts(seed) + HARD, start=100))
    rows += [(None, rows[0][1]), (None, None), (rows[3][0], rows[3][1]), (rows[4][0], "another text under an id of before")]
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, n long, set_id string")
    found = jj.link(docs, jj.Rule(words, percent)).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows, words, percent)


def test_no_rows_and_no_words(spark):
    assert jj.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in jj.link(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (7, "q r s t u v"), (7, "q r s t u v"), (None, "a b c d e f"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jj.one_of_each(docs).collect()), key=str) == [(3, "a b c d e f"), (7, "q r s t u v"), (9, None), (None, "a b c d e f")]


def test_one_of_each_where_ids_repeat_with_other_texts(spark):
    near = [f"w{i}" for i in range(40)]
    rows = [
        (3, " ".join(near)),
        # A near copy of 3 and a clean text under one id, then two clean texts, one of them twice.
        (7, " ".join(near + ["more"])), (7, "q r s t u v"), (8, "a b c d e f"), (8, "g h i j k l"), (8, "g h i j k l"),
        # Two near copies of each other under one id; a text, and none, under one id; a null id.
        (9, " ".join("z" + w for w in near)), (9, " ".join("z" + w for w in near[1:])), (10, "m n o p q r"), (10, None), (10, None), (None, "a b c d e f")]
    docs = spark.createDataFrame([(*row, "x", b"y") for row in rows], "doc_id long, text string, component string, set_id binary")
    found = [tuple(row)[:2] for row in jj.one_of_each(docs, jj.Rule(words=5, percent=80)).collect()]
    nines = [row for row in found if row[0] == 9]
    assert len(nines) == 1 and nines[0] in rows
    expected = [rows[0], rows[2], rows[3], rows[4], rows[8], rows[9], rows[11]]
    assert sorted((row for row in found if row[0] != 9), key=str) == sorted(expected, key=str)


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    found = {row.node: row.component for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200 + i: 200 for i in range(9)}


def test_fragments_cut_the_order_evenly():
    counts = __import__("numpy").random.default_rng(1).integers(0, 50, 1 << jj.RANGE_BITS)
    order = jj.Order.of(counts)
    shares = [counts[order.fragments == f].sum() / counts.sum() for f in range(jj.FRAGMENTS)]
    assert max(shares) < 1.1 / jj.FRAGMENTS
