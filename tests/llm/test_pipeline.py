"""The pipeline: each stage and the whole against the operators' plain counterparts on a small table."""

import os
import zlib
from array import array

import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

import corpus_pipeline as pipeline
from passerby.llm import jaccard_join, language, mixing, packing, pseudonyms

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages_are_those_asked_for():
    assert [name for name, _ in pipeline.STAGES] == ["language", "near_copies", "private_data", "mixture", "sequences"]


def jaccard_groups(rows):
    """doc_id of the smallest of each group, by all pairs."""
    sets = {}
    for row in rows:
        w = row.text.encode().lower().split()
        size = min(5, len(w))
        sets[row.doc_id] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    return {root(i) for i in ids}


def test_the_whole_as_by_plain_steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    spark.conf.set(pseudonyms.KEY_SETTING, "one")
    try:
        found = pipeline.run(spark, FOLDER).collect()
    finally:
        spark.conf.unset(pseudonyms.KEY_SETTING)
    predicted = {row.doc_id: row for row in language.predictions(docs).collect()}
    rows = [row for row in docs.collect() if predicted[row.doc_id].lang_pred != "und" and predicted[row.doc_id].score >= 0.5]
    keep = jaccard_groups(rows)
    hidden = [(row.doc_id, pseudonyms.replace(row.text, b"one")[0], row.source) for row in rows if row.doc_id in keep]
    plan = mixing.plan(mixing.sized(spark.createDataFrame(hidden, "doc_id long, text string, source string"))).collect()
    tokenizer = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    expected = []
    for row in plan:
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids + [1]
        start = 0
        for size in packing.lengths(len(ids), 2048):
            piece = zlib.crc32(array("I", ids[start:start + size]).tobytes())
            expected += [(row.doc_id, start, size, piece, len(ids))] * row.copies
            start += size
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == sorted(expected)
    assert len({row.sequence_id for row in found}) == len(found)


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    rows = [(1, "The stone and the other reader within.", "en", "s1", 38, "x"), (2, None, "en", "s1", 0, "x"), (3, "", None, None, 0, "x"),
            (4, "12 *** 34", "en", "s2", 9, "x"), (None, "The other stones are within the reach of readers.", "en", None, 49, "x"),
            (5, "Der Stein und die anderen Leser in der Schule, call (212) 555-0100.", "de", "s2", 67, "x"),
            (6, "Der Stein und die anderen Leser in der Schule, call (212) 555-0100.", "de", "s2", 67, "x")]
    docs = spark.createDataFrame([(*row, 1) for row in rows * 3],
                                 "doc_id long, text string, lang string, source string, n_chars long, score string, rows int")
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns and dict(kept.dtypes) == dict(docs.dtypes)
        stage(spark, docs.limit(0), FOLDER).count()
    assert {r.doc_id for r in pipeline.find_language(spark, docs, FOLDER).collect()} == {1, 5, 6, None}
    one = pipeline.drop_near_copies(spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in one if r.doc_id) == [1, 2, 3, 4, 5] and sum(r.doc_id is None for r in one) == 3
    assert all("555-0100" not in (r.text or "") for r in pipeline.hide_private_data(spark, docs, FOLDER).collect())
    assert pipeline.pack_sequences(spark, docs, FOLDER).count() > 0


def test_near_copies_go_and_clean_documents_stay(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1])), (3, " ".join(base[::-1])), (4, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in jaccard_join.one_of_each(docs).collect()) == [1, 3]
