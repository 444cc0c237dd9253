"""Packing: ids as the tokenizer gives them, pieces in binary lengths, edge cases."""

import zlib
from array import array

import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from passerby.llm import packing

HARD = ["", " ", "a  b", "a\n b", "a b ", " a b", "a\tb c\n", "x <|endoftext|> y", "<|endoftext|>", "it's 'll we're", "日本 語　x y",
        "a  b c\x1c d", "é ́a", "word " * 50, "x" * 500, "\n\n\n", "12 345 ... !!"]


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_equal_those_of_the_tokenizer(tokenizer):
    tokens = packing.Tokens(packing.byte_bpe())
    for _ in range(2):  # the second time from memory
        for text in HARD:
            assert list(array("I", tokens.encode(text))) == ids_of(tokenizer, text)[:-1], text


def test_memory_can_be_emptied(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    tokens = packing.Tokens(packing.byte_bpe())
    text = "one two three four five six seven"
    assert list(array("I", tokens.encode(text))) == ids_of(tokenizer, text)[:-1]


@pytest.mark.parametrize("total", [1, 2, 3, 2047, 2048, 2049, 10_000])
def test_lengths_add_up_and_are_powers_of_two(total):
    found = packing.lengths(total, 2048)
    assert sum(found) == total and all(size & (size - 1) == 0 and size <= 2048 for size in found)


def test_every_id_lies_in_one_piece(spark, tokenizer):
    rows = [(i, text, "clash") for i, text in enumerate(HARD + ["many words here " * 2000])] + [(None, "no id", "x"), (3, None, "y"), (3, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    found = packing.pack(docs, longest=64, keep_ids=True).collect()
    assert len({row.sequence_id for row in found}) == len(found)
    assert {row.sequence_id for row in found} == set(range(len(found)))
    assert all(row.offset == 0 and row.length & (row.length - 1) == 0 and row.length <= 64 for row in found)
    assert all(row.ids_crc32 == zlib.crc32(bytes(row.ids)) and len(row.ids) == 4 * row.length for row in found)
    for doc_id, text, _ in rows:
        own = sorted((row for row in found if row.doc_id == doc_id), key=lambda row: row.start)
        if doc_id == 3:
            continue
        assert b"".join(bytes(row.ids) for row in own) == array("I", ids_of(tokenizer, text)).tobytes()
        assert {row.doc_tokens for row in own} == {len(ids_of(tokenizer, text))}
    assert sorted(row.doc_tokens for row in found if row.doc_id == 3 and row.doc_tokens == 1) == [1, 1]


def test_lengths_lie_together(spark):
    docs = spark.createDataFrame([(i, "w " * i) for i in range(40)], "doc_id long, text string")
    found = sorted(packing.pack(docs).collect(), key=lambda row: row.sequence_id)
    assert [row.length for row in found] == sorted(row.length for row in found)


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_sequence_length_has_to_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], "doc_id long, text string"), longest=100)
