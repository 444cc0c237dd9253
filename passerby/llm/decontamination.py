"""Benchmark passages in documents, found by the multi-pattern search of Wu and Manber.

The test strings are the windows of ten consecutive words of the benchmark's
items. Those of one length are searched together: a table of word pairs tells
how far the place of comparison may move on, so most words of a document are
never looked at. Where a pair ends a test string, the last words select a
bucket, the words before them a string in it, and the words themselves are
compared.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.llm.rows import make_room, remembers
from passerby.session import cut_lineage

WINDOW = 10
#: Words of a block, by whose last occurrence in the test strings the search moves on.
BLOCK = 2
#: Words at the end of a test string that select its bucket.
SUFFIX = 4
#: About so many test strings are searched for in one pass; a larger benchmark takes several passes.
PASS_STRINGS = 400_000
#: An item of more words is dealt out in overlapping stretches, so that passes are of like size.
STRETCH = 5_000

#: A to Z become lower case; signs and controls of ASCII part words; all else is words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
SPAN = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
FOUND = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)),
         T.StructField("items", T.ArrayType(T.StringType()))]


def words_in(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of its lower-cased form."""
    return text.translate(FOLD).split() if text else []


def strings_of(words: list[bytes], window: int) -> Iterator[tuple[bytes, ...]]:
    """All windows; of fewer words one, of none none."""
    if words:
        for first in range(max(len(words) - window, 0) + 1):
            yield tuple(words[first:first + window])


def stretches(words: list[bytes], window: int, longest: int = STRETCH) -> Iterator[list[bytes]]:
    """Parts of a long item that have all its windows once."""
    for first in range(0, max(len(words) - window, 0) + 1, longest):
        yield words[first:first + longest + window - 1]


def joined(occurrences: Iterable[tuple[int, int]]) -> list[dict]:
    """The stretches that lie in an occurrence, those that overlap or touch as one."""
    spans: list[dict] = []
    for first, last in sorted(occurrences):
        if spans and first <= spans[-1]["last"] + 1:
            spans[-1]["last"] = max(spans[-1]["last"], last)
        else:
            spans.append({"first": first, "last": last})
    return spans


class Tables:
    """Shifts and buckets of the test strings of one length."""

    def __init__(self, strings: dict[tuple[bytes, ...], int]):
        self.length = len(next(iter(strings)))
        self.block = min(BLOCK, self.length)
        self.suffix = min(SUFFIX, self.length)
        self.furthest = self.length - self.block + 1
        self.shifts: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], int]] = defaultdict(dict)
        for string, number in strings.items():
            for end in range(self.block, self.length + 1):
                block = string[end - self.block:end]
                self.shifts[block] = min(self.shifts.get(block, self.furthest), self.length - end)
            self.buckets[string[-self.suffix:]][string[:-self.suffix]] = number

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word, number of the string) of each occurrence, overlapping ones included."""
        shift, furthest, block, end, last = self.shifts.get, self.furthest, self.block, self.length, len(words)
        while end <= last:
            step = shift(tuple(words[end - block:end]), furthest)
            if step:
                end += step
                continue
            bucket = self.buckets.get(tuple(words[end - self.suffix:end]))
            if bucket:
                number = bucket.get(tuple(words[end - self.length:end - self.suffix]))
                if number is not None:
                    yield end - self.length, number
            end += 1


class Finder:
    """The test strings of one pass, by length, and the items that each of them stands in."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        known: dict[bytes, bytes] = {}
        numbers: dict[int, dict[tuple[bytes, ...], int]] = defaultdict(dict)
        holders: list[list[str]] = []
        for item, words in items:
            for string in strings_of([known.setdefault(word, word) for word in words], window):
                number = numbers[len(string)].setdefault(string, len(holders))
                if number == len(holders):
                    holders.append([])
                if not holders[number] or holders[number][-1] != item:
                    holders[number].append(item)
        self.holders = holders
        self.tables = [Tables(strings) for strings in numbers.values()]
        self.known_items: dict[frozenset[int], list[str]] = {}

    def items_of(self, numbers: frozenset[int]) -> list[str]:
        """The items of some test strings; documents with the same passages share the answer."""
        items = self.known_items.get(numbers)
        if items is None:
            items = sorted(set().union(*(self.holders[number] for number in numbers)))
            if len(self.known_items) >= 1_000:
                self.known_items.clear()
            if len(items) <= 1_000:
                self.known_items[numbers] = items
        return items

    def find(self, words: list[bytes]) -> tuple[list[dict], list[str]]:
        """The stretches of words that lie in occurrences, and the items."""
        found = [(first, first + table.length - 1, number) for table in self.tables for first, number in table.find(words)]
        if not found:
            return [], []
        return joined((first, last) for first, last, _ in found), self.items_of(frozenset(number for _, _, number in found))


_finders: dict[str, Finder] = {}
remembers("decontamination", _finders.clear)


def finder_of(key: str, items: Broadcast, window: int) -> Finder:
    """One pass's tables for each worker process; those of another pass go."""
    if key not in _finders:
        _finders.clear()
        _finders[key] = Finder(items.value, window)
    return _finders[key]


def _search(docs: DataFrame, keys: list[str], items: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """The ``keys`` of all documents with n_words, spans and items, as far as one pass finds them."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    schema = T.StructType([docs.schema[key] for key in keys] + FOUND)
    found_types = [pa.int64(), SPANS, pa.list_(pa.string())]
    name = uuid.uuid4().hex

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("decontamination")
        finder = finder_of(name, shared, window)
        for batch in batches:
            counts, spans, items = [], [], []
            for text in batch.column(len(keys)):
                words = words_in(text.as_buffer().to_pybytes() if text.is_valid else None)
                where, which = finder.find(words)
                counts.append(len(words))
                spans.append(where)
                items.append(which)
            found = [pa.array(values, kind) for values, kind in zip((counts, spans, items), found_types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], *found], schema.names)

    return docs.select(*keys, F.col("text").cast("binary").alias("text")).mapInArrow(search, schema)


def passes(benchmark: DataFrame, window: int = WINDOW, strings: int = PASS_STRINGS) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The benchmark's items and their words in parts of about ``strings`` test strings, one after the other.

    Every part is bounded, so the whole benchmark is never in one place.
    """
    schema = "item string, words array<binary>, strings long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = [part for part in stretches(words_in(text), window) if part]
                if parts:
                    sizes = [max(len(part) - window, 0) + 1 for part in parts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(parts)), pa.array(parts, pa.list_(pa.binary())), pa.array(sizes, pa.int64())],
                        ["item", "words", "strings"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text"))
    parts = cut_lineage(items.mapInArrow(cut, schema).dropDuplicates(["item", "words"]))
    count = -(-(parts.agg(F.sum("strings")).first()[0] or 0) // strings)
    for number in range(count):
        chosen = parts.filter(F.pmod(F.xxhash64("item", "words"), F.lit(count)) == number)
        yield [(row.item, [bytes(word) for word in row.words]) for row in chosen.select("item", "words").toLocalIterator()]


def passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, strings: int = PASS_STRINGS) -> DataFrame:
    """Where the ``window``-word strings of the benchmark's items stand in each whole document.

    One row for each row of ``docs``: doc_id, n_words, spans (first and last word,
    from 0, of each stretch that lies in occurrences) and items (their item_ids in
    order of their bytes, each once). A document's null or empty text has no words.
    An item of fewer words than a window is one string, an item without words
    none; an item without an id has the empty id, and rows that repeat an
    item_id are one item with the strings of all of them. Extra columns play no
    part; without items nothing is found.

    A benchmark within ``strings`` test strings takes one pass over the
    documents. A larger one takes a pass for each part of that size, and the
    findings, not the texts, are put together by document.
    """
    parts = passes(benchmark, window, strings)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        return _search(docs, ["doc_id"], first, window)
    stored = cut_lineage(docs.select("doc_id", "text"))
    stored = stored.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    found = None
    for part in (first, second, *parts):
        one = _search(stored, ["doc_id", "file", "row"], part, window)
        # All documents come out of the first pass, only those with findings out of the others.
        found = one if found is None else found.unionByName(one.filter(F.size("spans") > 0))
    merged = found.groupBy("file", "row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    schema = T.StructType([docs.schema["doc_id"], *FOUND])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [joined((span["first"], span["last"]) for span in row) for row in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, SPANS), batch.column(3)], schema.names)

    return merged.select("doc_id", "n_words", "spans", "items").mapInArrow(join, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`passages` in figures: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the words within occurrences; the digest is that of the
    item_ids joined by commas, of the empty text if there are none.
    """
    lengths = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["last"] - span["first"] + 1)
    return passages(docs, benchmark, window).select(
        "doc_id", "n_words", lengths.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


ORACLE = r"""
WITH texts AS (
    SELECT row_number() OVER () AS place, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
strings AS (
    SELECT DISTINCT item, size, string FROM (
        SELECT item, least(len(words), 10) AS size,
               unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1), lambda i: array_to_string(words[i:i + 9], ' '))) AS string
        FROM items WHERE len(words) > 0)),
places AS (
    SELECT place, size, words, unnest(range(1, len(words) - size + 2)) AS first
    FROM texts, (SELECT DISTINCT size FROM strings) WHERE len(words) >= size),
found AS (
    SELECT p.place, p.first, p.size, s.item
    FROM (SELECT place, size, first, array_to_string(words[first:first + size - 1], ' ') AS string FROM places) p
    JOIN strings s USING (size, string)),
hit AS (
    SELECT place, count(DISTINCT word) AS n_hit
    FROM (SELECT place, unnest(range(first, first + size)) AS word FROM (SELECT DISTINCT place, first, size FROM found)) GROUP BY place),
named AS (
    SELECT place, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT place, item FROM found) GROUP BY place)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN hit USING (place) LEFT JOIN named USING (place)
"""
