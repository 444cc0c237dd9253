"""Token alignment against the tokenizers themselves and a plain merge, text by text."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer

from passerby.llm import alignment as al

TEXTS = [
    "hello world", " a  b ", "line one\nline two\n\nthree", "tab\there \t x", "ﬁ ½ é ü 漢字かな交じり文", "<|endoftext|> <s> </s> <unk> <0x41>",
    "under▁score", "\x00\x01 odd", "emoji 👩‍👩‍👧‍👦 👍🏽!", "don't can't 'tis  ''s", "nbsp here   sep", "  ", "\n", " \nfoo \nfoo", "foo \nfoo\nfoo",
    "a" * 3000, "x1y2z3 " * 500, "한국어 띄어쓰기", "word\n word\r\nword", "…ends with space ", "Ünï̈ combining é",
]


def byte_letters():
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes themselves, the others in order from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + at): byte for at, byte in enumerate(others)}


LETTERS = byte_letters()
JSON = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
JSON.encode_special_tokens = True


def chance_texts(seed, n):
    chance = random.Random(seed)
    parts = ["the", "over", "Zürich", "\n", "  ", "\t", "漢字", "'s", "123", "naïve", "un", "believ", "able", " ", "👍", "-", "...", "▁"]
    return [chance.choice(["", " "]).join(chance.choice(parts) + chance.choice(["", " "]) for _ in range(chance.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizers():
    return al.Tokenizers(al.byte_bpe(), al.piece_bpe())


def plain(tokenizers, text):
    """(A ids, B ids, groups as text, links) by whole texts and a merge in Python; None where there are no tokens."""
    if not text:
        return None
    a, b = JSON.encode(" " + text, add_special_tokens=False).ids, tokenizers.second.encode(text)
    bytes_a = [bytes(LETTERS[c] for c in JSON.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(f[3:5], 16)]) if tokenizers.second.is_byte(i) else f.replace("▁", " ").encode() for i in b for f in [tokenizers.second.id_to_piece(i)]]
    if not b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode():
        return None
    spans = lambda parts: [(sum(map(len, parts[:i])), sum(map(len, parts[:i + 1]))) for i in range(len(parts))] if len(parts) < 200 else ends(parts)
    at_a, at_b = spans(bytes_a), spans(bytes_b)
    links = [(i, j) for i, j in overlaps(at_a, at_b)]
    both = sorted({e for _, e in at_a} & {e for _, e in at_b})
    groups, i, j = [], 0, 0
    for end in both:
        own_a, own_b = [], []
        while i < len(a) and at_a[i][1] <= end:
            own_a.append(str(a[i]))
            i += 1
        while j < len(b) and at_b[j][1] <= end:
            own_b.append(str(b[j]))
            j += 1
        groups.append(",".join(own_a) + "|" + ",".join(own_b))
    return a, b, ";".join(groups), links


def ends(parts):
    out, at = [], 0
    for part in parts:
        out.append((at, at + len(part)))
        at += len(part)
    return out


def overlaps(at_a, at_b):
    """All pairs whose ranges overlap, each A token against the B tokens around it."""
    first = 0
    for i, (low, high) in enumerate(at_a):
        while first < len(at_b) and at_b[first][1] <= low:
            first += 1
        j = first
        while j < len(at_b) and at_b[j][0] < high:
            yield i, j
            j += 1


def expected(tokenizers, docs):
    """Rows of `alignment` for (doc_id, text), counts over all of them."""
    found = [(doc_id, plain(tokenizers, text)) for doc_id, text in docs]
    counts = Counter((a[i], b[j]) for _, one in found if one for a, b, _, links in [one] for i, j in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    rows = []
    for doc_id, one in found:
        if one is None:
            rows.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = one
        pairs = [(a[i], b[j]) for i, j in links]
        rows.append((doc_id, len(a), len(b), groups.count(";") + 1, len(links), sum(counts[p] == most[p[1]] for p in pairs),
                     sum(counts[p] for p in pairs), hashlib.sha256(groups.encode()).hexdigest()))
    return sorted(rows, key=repr)


def test_ids_are_those_of_whole_texts(tokenizers):
    assert any(plain(tokenizers, text) is None for text in TEXTS) and sum(plain(tokenizers, text) is not None for text in TEXTS) > 15
    for text in TEXTS + chance_texts(1, 500) + TEXTS:
        whole, ours = plain(tokenizers, text), tokenizers.encode(text)
        assert (whole is None) == (ours is None), text
        if ours:
            assert [*ours] == [whole[0], whole[1]], text


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "9" * 300_000, "字" * 100_000, "!?" * 150_000, "\n" * 300_000])
def test_very_long_texts_of_one_sign(tokenizers, text):
    found = al.align_texts(tokenizers, [text])
    assert found["n_a"][0] == len(tokenizers.encode(text)[0]) and found["n_links"][0] >= max(found["n_a"][0], found["n_b"][0])


@pytest.mark.parametrize("lane, near", [(256, 32), (3, 2), (1, 1)])
def test_merge_with_any_lanes(tokenizers, monkeypatch, lane, near):
    monkeypatch.setattr(al, "LANE", lane)
    monkeypatch.setattr(al, "NEAR", near)
    texts = TEXTS + chance_texts(2, 100)
    got = al.align_texts(tokenizers, texts, keep_groups=True)
    start = 0
    for at, text in enumerate(texts):
        one = plain(tokenizers, text)
        size = int(got["n_pairs"][at])
        pairs = dict(zip(got["pairs"][start:start + size].tolist(), got["times"][start:start + size].tolist(), strict=True))
        start += size
        if one is None:
            assert (got["n_a"][at], got["n_links"][at], got["groups_sha256"][at], pairs) == (0, 0, "", {})
            continue
        a, b, groups, links = one
        assert got["groups"][at] == groups and got["n_links"][at] == len(links)
        assert pairs == Counter(a[i] * al.PAIR + b[j] for i, j in links)
    assert start == len(got["pairs"])


def test_long_texts_take_few_steps(tokenizers):
    text = "some words about nothing in particular " * 20_000
    a, b = map(np.array, tokenizers.encode(text))
    ends_a, ends_b = np.cumsum(tokenizers.a.lengths[a]), np.cumsum(tokenizers.b.lengths[b])
    begin_a, begin_b = al.lanes(ends_a, ends_b, np.array([0]))
    assert np.diff(np.append(begin_a, len(a))).max() <= al.LANE + al.NEAR
    assert al.merge(ends_a, ends_b, begin_a, begin_b)[2].tolist() == np.flatnonzero(np.isin(ends_a, ends_b)).tolist()


DOCS = "pairs string, doc_id long, text string, n int"


@pytest.mark.parametrize("pairs", [al.PAIRS, 0])
def test_counts_by_broadcast_and_by_join(spark, tokenizers, pairs):
    docs = list(enumerate(TEXTS + chance_texts(3, 60))) + [(None, "hello world"), (5, None), (5, ""), (7, "hello world"), (7, "hello world"), (9, "z" * 300_000)]
    rows = spark.createDataFrame([("x", doc_id, text, 1) for doc_id, text in docs], DOCS).repartition(3)
    got = al.alignment(rows, pairs=pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(row) for row in got.collect()), key=repr) == expected(tokenizers, docs)


def test_empty_table_and_texts_without_tokens(spark):
    docs = spark.createDataFrame([("x", 1, None, 1), ("x", 2, "", 1)], DOCS)
    for pairs in (al.PAIRS, -1):
        assert [tuple(row)[1:] for row in al.alignment(docs, pairs=pairs).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
        assert al.alignment(docs.limit(0), pairs=pairs).count() == 0
