"""Quality rules: counts and ratios against plain loops."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from passerby.llm import quality_rules as q


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered |= set(range(i, i + 5))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def texts():
    chance = random.Random(4)
    word = lambda: chance.choice(["the", "of", "ouon", "élan", "x###", "<b>", "日本"])
    out = [" ".join(word() for _ in range(chance.randrange(60))) for _ in range(80)]
    out += ["\n".join(chance.choice(["one line", "another line here", " ", ""]) for _ in range(20)) for _ in range(20)]
    out += [None, "", " \n\t ", "a b c d e a b c d e", "a a a a a a a", "a b c d e", "a b c d", " lead and trail ", "x " * 20_000, "line\r\nline\r\nline",
            "a\x0bb\x0cc\x1cd\u00a0e", "one two three four five " * 3 + "six"]
    return out


def test_counts(spark):
    rows = [(i, text, "x") for i, text in enumerate(texts())] + [(None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    found = q.judge(docs, [0.0] * 16).collect()
    assert len(found) == len(rows)
    for row in found:
        expected = plain_counts(row.text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == expected, row.text and row.text[:60]
        assert row.kept == (not row.base_failed)


def buckets_of(spark, texts, size):
    """Each text's buckets, one word or pair at a time."""
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        rows = spark.createDataFrame([(w,) for w in words] or [("",)], "w string").select(F.xxhash64("w").alias("h")).collect() if words else []
        hashes = [row.h for row in rows]
        pairs = [r.p for r in spark.createDataFrame(list(zip(hashes, hashes[1:], strict=False)), "a long, b long").select(F.xxhash64("a", "b").alias("p")).collect()] if len(hashes) > 1 else []
        out.append([h % size for h in hashes + pairs])
    return out


def test_weights_and_ratio(spark):
    texts = ["the of the other day and more of the same words here", "### *** $$$ the &&& of %%% ### ***", "the of the", "", None, "one", "and more of the same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (6, 1), (6, 1), (None, 1), (99, 1), (2, None)], "doc_id long, quality int")
    size = 64
    weights = q.fit(docs, labels, buckets=size)
    own = buckets_of(spark, texts, size)
    raw, good = Counter(b for bs in own for b in bs), Counter(b for i in (0, 6) for b in own[i])
    share = {b: (raw[b] + 1) / (sum(raw.values()) + size) for b in range(size)}
    expected = [round(math.log((good[b] + q.PRIOR * share[b]) / (sum(good.values()) + q.PRIOR) / share[b]), 4) for b in range(size)]
    assert weights == pytest.approx(expected)
    found = {row.doc_id: row.llr for row in q.judge(docs, weights).collect()}
    for i, bs in enumerate(own):
        assert found[i] == pytest.approx(sum(weights[b] for b in bs) / max(1, len(bs)))


def test_held_against_labels(spark):
    chance = random.Random(3)
    good = lambda: " ".join(chance.choice(["the", "of", "and", "other", "day", "more"]) + str(chance.randrange(2)) for _ in range(40))
    rows = [(i, good() if i % 4 else re.sub(r"(\d)", r"\1###", good())) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 400, 2)], "doc_id long, quality int")
    found = [row for row in q.verdicts(docs, labels).collect() if not row.base_failed]
    assert {row.kept for row in found if row.doc_id % 4} == {True} and {row.kept for row in found if row.doc_id % 4 == 0} == {False}


def test_no_rows_no_labels_no_python(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [row.kept for row in q.verdicts(docs, labels).collect()] == [True]
    assert q.verdicts(docs.limit(0), labels).count() == 0
    assert not re.search("Python|Pandas|Arrow", q.judge(docs.select("doc_id", F.lower("text").alias("text")), [0.0] * 8)._jdf.queryExecution().toString())
