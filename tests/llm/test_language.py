"""Language: sums over all segmentations, held-out accuracy, edge cases."""

import random
from functools import lru_cache

import numpy as np
import pytest

pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

from passerby.llm import language
from passerby.llm.rows import held_out

VOCABULARY = language.piece_vocabulary()
WORDS = {"en": ["the", "thing", "stone", "reader", "other", "within"], "de": ["der", "größe", "schule", "über", "nicht", "heit"],
         "fr": ["élève", "château", "autre", "être", "oiseau", "leçon"]}


def sum_of_all(word: str, chances: np.ndarray) -> float:
    """Every way of cutting a word, one after another."""
    known, marked = language.pieces(VOCABULARY), language.START + word

    @lru_cache
    def rest(at: int) -> float:
        if at == len(marked):
            return 1.0
        total, alone = 0.0, True
        for end in range(at + 1, len(marked) + 1):
            if marked[at:end] in known:
                total += chances[known[marked[at:end]]] * rest(end)
                alone = alone and end > at + 1
        return total + chances[-1] * rest(at + 1) if alone else total

    return rest(0)


def test_forward_adds_up_all_segmentations():
    chances = np.random.default_rng(3).random(len(language.pieces(VOCABULARY)) + 1)
    chances /= chances.sum()
    model = language.Model(["x"], chances[:, None], VOCABULARY)
    words = ["a", "thering", "größe", "日本語", "élle", "ñandú", "zzzzzzzz", "ǅ"]
    for word, log in zip(words, model.score(words)[:, 0], strict=True):
        assert log == pytest.approx(np.log(sum_of_all(word.lower(), chances)))


def test_fitting_raises_the_likelihood():
    words, counts = ["stone", "stones", "reader", "readers"], np.array([5.0, 3, 4, 2])
    logs = []
    for rounds in range(4):
        chances = language.fit_language(words, counts, VOCABULARY, rounds)
        logs.append(counts @ language.Model(["x"], chances[:, None], VOCABULARY).score(words)[:, 0])
    assert logs == sorted(logs)


def log_of_all(word: str, chances: np.ndarray) -> float:
    """The logarithm of the sum over all ways of cutting a word of any length, added up in logarithms."""
    known, marked = language.pieces(VOCABULARY), language.START + word
    logs = np.full(len(marked) + 1, -np.inf)
    logs[0] = 0.0
    for at in range(len(marked)):
        if marked[at] not in known:
            logs[at + 1] = np.logaddexp(logs[at + 1], logs[at] + np.log(chances[-1]))
        for end in range(at + 1, min(at + 40, len(marked)) + 1):
            if marked[at:end] in known:
                logs[end] = np.logaddexp(logs[end], logs[at] + np.log(chances[known[marked[at:end]]]))
    return logs[-1]


def test_words_of_any_length_are_summed_whole():
    random.seed(4)
    chances = np.random.default_rng(4).random(len(language.pieces(VOCABULARY)) + 1) ** 8
    chances /= chances.sum()
    model = language.Model(["x", "y"], np.stack([chances, chances[::-1]], axis=1), VOCABULARY)
    words = ["".join(random.choices("theringsao日本", k=n)) for n in (1, 15, 16, 17, 31, 33, 64, 500, 2000)]
    found = model.score(words)
    for word, (one, two) in zip(words, found, strict=True):
        assert one == pytest.approx(log_of_all(word, chances)) and two == pytest.approx(log_of_all(word, chances[::-1]))


def test_expected_counts_of_long_words():
    chances = np.random.default_rng(5).random(len(language.pieces(VOCABULARY)) + 1) ** 4
    chances /= chances.sum()
    trie = language.trie_of(VOCABULARY)
    for word in ("stone" * 3, "reading" * 80):
        used = language.expected(trie.spell([word]), trie, chances, np.array([2.0]))
        # The letters of all pieces are those of the word, each as often as it counts.
        letters = sum(n * len(form) for form, n in zip(language.pieces(VOCABULARY), used, strict=True) if n)
        assert letters == pytest.approx(2 * (len(word) + 1))
        # The derivative of the logarithm by that of a piece's chance is how often it is used.
        at = int(used.argmax())
        more = chances.copy()
        more[at] *= 1 + 1e-6
        assert used[at] == pytest.approx(2 * (log_of_all(word, more) - log_of_all(word, chances)) / 1e-6, rel=1e-3)


def test_long_words_do_not_underflow():
    model = language.Model(["x"], np.full((len(language.pieces(VOCABULARY)) + 1, 1), 1e-6), VOCABULARY)
    assert np.isfinite(model.score(["q" * 5000])).all()


def docs_of(spark):
    chance = random.Random(7)
    rows = [(i, " ".join(chance.choices(WORDS[lang], k=chance.randrange(3, 30))), lang, "x") for i, lang in enumerate(["en", "de", "fr"] * 150)]
    rows += [(900, None, "en", "x"), (901, "", "de", "x"), (902, "12 34 *** !!", "fr", "x"), (905, "² ½ ①", "es", "x"), (903, "the other " * 4000, None, "x"), (None, "der über", "de", "x"),
             (3, rows[3][1], "en", "x"), (904, "x" * 20_000, "en", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_held_out_accuracy_and_edges(spark):
    docs = docs_of(spark)
    found = language.predictions(docs).collect()
    truth = {row.doc_id: row.lang for row in docs.collect()}
    judged = [row for row in found if row.held_out and row.doc_id is not None and row.doc_id < 900]
    assert len(judged) > 50 and sum(row.lang_pred == truth[row.doc_id] for row in judged) >= 0.98 * len(judged)
    by_id = {row.doc_id: row for row in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0.0 for i in (900, 901, 902, 905))
    assert by_id[903].lang_pred == "en" and by_id[None].lang_pred == "de" and by_id[None].held_out
    assert all(0 <= row.score <= 1 for row in found) and len(found) == docs.count()


def test_held_out_rows_and_ids_are_not_learnt_from(spark):
    docs = docs_of(spark)
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert sorted(map(str, language.predictions(docs).collect())) == sorted(map(str, language.predictions(other).collect()))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "the other", None)], "doc_id long, text string, lang string")
    assert [row.lang_pred for row in language.predictions(docs).collect()] == ["und"]
    assert language.predictions(docs.limit(0)).count() == 0


def test_other_columns_pass(spark):
    docs = docs_of(spark)
    found = language.identify(docs, language.learn(docs))
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"] and dict(found.dtypes)["score"] == "double"
