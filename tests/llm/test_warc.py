"""WARC: round trips whatever the ranges, damaged members, copies and edge cases."""

import hashlib
import io
import random
import zlib

import pytest

from passerby.llm import warc


def plain(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        origin = first.get(data)
        revisit = origin is not None and page_id != origin
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", origin if revisit else None))
    return sorted(out, key=str)


ROWS = [(i, f"http://h{i}/", "<p>" + "ab" * (i * 7 % 90) + "</p>") for i in range(60)]
ROWS += [(100 + i, "http://same/", "same page " * 20) for i in range(30)]
ROWS += [(200, None, None), (201, "", ""), (202, "http://x/\r\nWARC-Type: evil", "é" * 60), (203, "u", "é" * 60), (204, "big", "x" * 400_000),
         (None, "no id", "z" * 200), (None, "no id", "same page " * 20), (100, "again", "same page " * 20), (205, "h", "\x1f\x8b\x08" * 50),
         (206, "u v", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello" * 9)]


@pytest.mark.parametrize("range_bytes", [997, 1 << 20])
def test_round_trip(spark, range_bytes):
    pages = spark.createDataFrame([(*row, "x") for row in ROWS], "page_id long, url string, html string, payload string")
    found = warc.round_trip(pages, range_bytes).collect()
    assert sorted(map(tuple, found), key=str) == plain(ROWS)


def long_url():
    chance = random.Random(3)
    return "http://x/" + "".join(chance.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=1_500_000))


def test_a_url_of_any_length(spark):
    rows = [(1, long_url(), "same page " * 20), (2, "http://y/", "same page " * 20), (3, "http://z/", "other")]
    found = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows)
    [(fields, _, _)] = warc.read_range(warc.Reader(io.BytesIO(data := warc.record(1, rows[0][1], b"x", "d", "response", None)), len(data)), 0, len(data))
    assert fields["warc-target-uri"] == rows[0][1]


def test_records_that_do_not_come_back_are_an_error(spark, monkeypatch):
    whole = warc.read
    monkeypatch.setattr(warc, "read", lambda *args, **named: whole(*args, **named).filter("page_id <> 2"))
    with pytest.raises(ValueError, match="2 of 3 records"):
        warc.round_trip(spark.createDataFrame([(i, "u", "x") for i in (1, 2, 3)], "page_id long, url string, html string"))


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def archive(n=40, seed=1):
    chance = random.Random(seed)
    return [warc.record(i, f"http://x/{i}", chance.randbytes(chance.randrange(3000)), "d", "response", None) for i in range(n)]


@pytest.mark.parametrize("step", [1, 7, 500, 10_000])
def test_every_record_has_one_owner(step):
    data = b"".join(archive())
    reader = lambda: warc.Reader(io.BytesIO(data), len(data))
    whole = [place for _, _, place in warc.read_range(reader(), 0, len(data))]
    assert len(whole) == 40
    if step > 1:
        parts = [place for start in range(0, len(data), step) for _, _, place in warc.read_range(reader(), start, min(start + step, len(data)))]
        assert parts == whole


def test_magic_within_other_bytes_is_no_record():
    packed = zlib.compress(b"no record", wbits=31)
    records = archive(5)
    data = b"\x1f\x8b\x08" * 9 + packed + records[0] + b"\x1f\x8b" + records[1][:50] + records[2] + packed + records[3] + records[4][:-9]
    found = list(warc.read_range(warc.Reader(io.BytesIO(data), len(data)), 0, len(data)))
    assert [fields["warc-page-id"] for fields, _, _ in found] == ["0", "2", "3"]


def test_a_record_longer_than_a_step(monkeypatch):
    monkeypatch.setattr(warc, "STEP", 64)
    data = b"".join(archive(6, seed=2))
    found = list(warc.read_range(warc.Reader(io.BytesIO(data), len(data)), 0, len(data)))
    assert [fields["warc-page-id"] for fields, _, _ in found] == [str(i) for i in range(6)]
