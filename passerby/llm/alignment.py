"""How the tokens of two public tokenizers lie to each other, by merging their ends in lockstep.

Both token sequences of a text have the same bytes. A pointer in each moves over
the tokens as a merge does: the one whose token ends first moves on, both where
two tokens end together, which is a cut. One NumPy vector of pointers moves all
texts of a batch at once; each step emits a link for every text and the cuts,
and texts that have ended are compacted away.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.functions.sizes import join_dimension
from passerby.llm.rows import make_room, remembers
from passerby.session import cut_lineage

#: A long text takes several places in the vector of pointers; each begins at a cut near every so many tokens.
LANE = 256
#: How many tokens of a lane's beginning are looked at for such a cut.
NEAR = 32
#: Texts are taken together up to so many characters.
TOGETHER = 1 << 20
#: Id pairs whose counts are broadcast, of 16 bytes each; beyond, the counts are joined.
PAIRS = 2_000_000
#: A pair is one number, the first id times this plus the second.
PAIR = 1 << 32


def byte_bpe() -> str:
    """Where the ranks of the first vocabulary lie: those of ``byte_bpe_50k.json`` in the form that the faster of two libraries reads."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Side:
    """The bytes of each id of one tokenizer, and how ids become text in a digest."""

    def __init__(self, values: list[bytes]):
        self.values = values
        self.lengths = np.array([len(value) for value in values], np.int64)
        # Every id with each sign that may follow it, in a row of fixed width.
        self.width = len(str(len(values))) + 1
        signs = [[f"{at}{sign}".encode() for at in range(len(values))] for sign in ",|;"]
        self.text = np.array(signs, f"S{self.width}").view(np.uint8).reshape(3, len(values), self.width)


class Tokenizers:
    """Both tokenizers of a worker. Strings of special tokens in a text are plain text to them."""

    def __init__(self, first: str, second: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(first, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.first = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        self.a = Side(sorted(ranks, key=ranks.__getitem__))
        pieces = [self.second.id_to_piece(at) for at in range(self.second.get_piece_size())]
        self.b = Side([bytes([int(piece[3:5], 16)]) if self.second.is_byte(at) else piece.replace("▁", " ").encode()
                       for at, piece in enumerate(pieces)])

    def encode(self, text: str | None) -> tuple[list[int], list[int]] | None:
        """Ids of both for a space and the whole text; None if there are none, or if the bytes of either differ from it."""
        if not text:
            return None
        spaced = " " + text
        ids = self.first.encode_ordinary(spaced), self.second.encode(text)
        wanted = spaced.encode()
        for side, own in zip((self.a, self.b), ids, strict=True):
            if b"".join(map(side.values.__getitem__, own)) != wanted:
                return None
        return ids


_tokenizers: dict[tuple[str, str], Tokenizers] = {}
remembers("alignment", _tokenizers.clear)


def tokenizers_of(first: str, second: str) -> Tokenizers:
    """One pair for each worker process."""
    if (first, second) not in _tokenizers:
        _tokenizers[first, second] = Tokenizers(first, second)
    return _tokenizers[first, second]


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where merging begins in both sequences: at every text, and in long texts at a cut near every `LANE` tokens.

    ``first_a`` are the texts' first tokens. A stretch without a cut begins no lane.
    """
    after = np.arange(LANE, len(ends_a) - NEAR, LANE)[:, None] + np.arange(NEAR)
    place = np.searchsorted(ends_b, ends_a[after])
    cut = ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[after]
    some = cut.any(axis=1)
    at = after[some, cut[some].argmax(axis=1)] + 1
    begin_a = np.union1d(first_a, at)
    begin_b = np.searchsorted(ends_b, ends_a[begin_a - 1], side="right")
    begin_b[begin_a == 0] = 0
    return begin_a, begin_b


def merge(ends_a: np.ndarray, ends_b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links (places in both sequences) and cuts (last places before them), by lockstep steps over all lanes."""
    stop = np.append(begin_a[1:], len(ends_a))
    a, b = begin_a.copy(), begin_b.copy()
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    parts = [np.concatenate(part) if part else np.zeros(0, np.int64) for part in (links_a, links_b, cuts_a, cuts_b)]
    return parts[0], parts[1], np.sort(parts[2]), np.sort(parts[3])


def group_texts(sides: tuple[Side, Side], ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray,
                starts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups as text, `a1,a2|b1;a3|b2,b3;`, and where the text of each group in ``starts`` begins.

    The places of all tokens follow from the cuts, so the text is put together without a loop over tokens.
    """
    size_a, size_b = np.diff(cuts_a, prepend=-1), np.diff(cuts_b, prepend=-1)
    sign_a, sign_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    sign_a[cuts_a], sign_b[cuts_b] = 1, 2
    place_a = np.arange(len(ids_a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)
    place_b = np.arange(len(ids_b)) + np.repeat(np.cumsum(size_a), size_b)
    width = max(side.width for side in sides)
    cells = np.zeros((len(ids_a) + len(ids_b), width), np.uint8)
    cells[place_a, :sides[0].width] = sides[0].text[sign_a, ids_a]
    cells[place_b, :sides[1].width] = sides[1].text[sign_b, ids_b]
    filled = cells != 0
    lengths = np.append(0, np.cumsum(filled.sum(axis=1)))
    begins = np.append(0, np.cumsum(size_a + size_b))
    return cells[filled].tobytes(), lengths[begins[starts]]


def _together(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts are merged together."""
    first = size = 0
    for at, text in enumerate(texts):
        size += len(text or "") + 1
        if size >= TOGETHER:
            yield first, at + 1
            first, size = at + 1, 0
    if first < len(texts):
        yield first, len(texts)


def align_texts(tokenizers: Tokenizers, texts: list[str | None], keep_groups: bool = False) -> dict[str, list | np.ndarray]:
    """The columns of `alignments` for some texts, in their order."""
    both = [tokenizers.encode(text) for text in texts]
    there = np.array([ids is not None for ids in both], bool)
    rows = np.flatnonzero(there)
    out = {name: np.zeros(len(texts), np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    out |= {"groups_sha256": [""] * len(texts), "groups": [None] * len(texts) if keep_groups else None,
            "pairs": np.zeros(0, np.int64), "times": np.zeros(0, np.int64), "n_pairs": np.zeros(len(texts), np.int64)}
    if not len(rows):
        return out
    sides = list(zip(*(both[row] for row in rows), strict=True))
    count_a, count_b = (np.array([len(ids) for ids in side]) for side in sides)
    ids_a, ids_b = (np.fromiter(chain.from_iterable(side), np.int64, n.sum()) for side, n in zip(sides, (count_a, count_b), strict=True))
    # One row of bytes for all texts: each text's end is an end of both sequences.
    ends_a, ends_b = np.cumsum(tokenizers.a.lengths[ids_a]), np.cumsum(tokenizers.b.lengths[ids_b])
    first_a = np.cumsum(count_a) - count_a
    links_a, links_b, cuts_a, cuts_b = merge(ends_a, ends_b, *lanes(ends_a, ends_b, first_a))
    owner_a = np.repeat(np.arange(len(rows)), count_a)
    out["n_a"][rows], out["n_b"][rows] = count_a, count_b
    groups = np.bincount(owner_a[cuts_a], minlength=len(rows))
    out["n_groups"][rows] = groups
    owner = owner_a[links_a]
    out["n_links"][rows] = np.bincount(owner, minlength=len(rows))
    text, begins = group_texts((tokenizers.a, tokenizers.b), ids_a, ids_b, cuts_a, cuts_b, np.append(0, np.cumsum(groups)))
    for at, row in enumerate(rows):
        own = text[begins[at]:begins[at + 1] - 1]
        out["groups_sha256"][row] = hashlib.sha256(own).hexdigest()
        if keep_groups:
            out["groups"][row] = own.decode()
    # Each text's id pairs, each once with the number of its links.
    pair = ids_a[links_a] * PAIR + ids_b[links_b]
    order = np.lexsort((pair, owner))
    owner, pair = owner[order], pair[order]
    new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])))
    out["pairs"], out["times"] = pair[new], np.diff(np.append(new, len(pair)))
    out["n_pairs"][rows] = np.bincount(owner[new], minlength=len(rows))
    return out


LONGS = ("n_a", "n_b", "n_groups", "n_links")


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, kind))


def alignments(docs: DataFrame, first: str | None = None, second: str | None = None, keep_groups: bool = False) -> DataFrame:
    """How the tokens of two tokenizers lie to each other in each whole text.

    One row for each row of ``docs``: doc_id, n_a, n_b (tokens), n_groups, n_links,
    groups_sha256, pairs (each linked pair of ids once, the first id times 2^32
    plus the second), times (its links), and with ``keep_groups`` the groups as
    text. The first tokenizer is byte-level and reads a space and the text, the
    second adds that space itself. Texts that are null or empty, or whose tokens'
    bytes are not those of a space and the text, have no tokens: zeros and empty
    texts and lists. Extra columns play no part; no rows give no rows.
    """
    first, second = first or byte_bpe(), second or piece_bpe()
    types = [pa.int64()] * 4 + [pa.string()]
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(name, T.LongType()) for name in LONGS), T.StructField("groups_sha256", T.StringType()),
                           T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))]
                          + [T.StructField("groups", T.StringType())] * keep_groups)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("alignment")
        tokenizers = tokenizers_of(first, second)
        for batch in batches:
            for begin, end in _together(batch.column(1).to_pylist()):
                part = batch.slice(begin, end - begin)
                found = align_texts(tokenizers, part.column(1).to_pylist(), keep_groups)
                columns = [part.column(0), *(pa.array(found[name], kind) for name, kind in zip((*LONGS, "groups_sha256"), types, strict=True)),
                           *(_lists(found[name], found["n_pairs"], pa.int64()) for name in ("pairs", "times"))]
                if keep_groups:
                    columns.append(pa.array(found["groups"], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select("doc_id", "text").mapInArrow(align, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (its links in all texts) and best (whether that is the most of any pair with its second id)."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counts = cut_lineage(links.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum("link.times").alias("n")))
    second = F.col("pair") % PAIR
    most = counts.groupBy(second.alias("second")).agg(F.max("n").alias("most"))
    # An id of the second tokenizer has at most as many pairs as the first has ids.
    return counts.withColumn("second", second).join(most, "second").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def weigh(aligned: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """Stored alignments with n_best and count_sum instead of their pairs.

    ``n_best`` counts a text's links whose id pair has the most links of all pairs
    with that second id, ties included; ``count_sum`` sums the pairs' counts over
    the links. Up to ``pairs`` counts are broadcast, more are joined by pair.
    """
    counts = cut_lineage(pair_counts(aligned))
    named = [name for name in aligned.columns if name not in ("pairs", "times")]
    if counts.count() > pairs:
        return _weigh_by_join(aligned, counts, named)
    table = counts.sort("pair").toArrow()
    columns = (table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy(zero_copy_only=False))
    return _weigh_by_table(aligned, aligned.sparkSession.sparkContext.broadcast(columns), named)


def _weigh_by_table(aligned: DataFrame, shared: Broadcast, named: list[str]) -> DataFrame:
    schema = T.StructType([aligned.schema[name] for name in named] + [T.StructField(name, T.LongType()) for name in ("n_best", "count_sum")])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            own = batch.column(batch.schema.get_field_index("pairs"))
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(own).to_numpy(zero_copy_only=False))
            at = np.searchsorted(pair, own.flatten().to_numpy())
            times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy()
            sums = []
            for value in (np.where(best[at], times, 0), n[at] * times) if len(pair) else (times, times):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, owner, value)
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(name)) for name in named), *sums], schema.names)

    return aligned.mapInArrow(look_up, schema)


def _weigh_by_join(aligned: DataFrame, counts: DataFrame, named: list[str]) -> DataFrame:
    """Pairs that hold many rows are salted; the sums of a text are put together by its place in its file."""
    placed = aligned.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    links = placed.select("file", "row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "file", "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    met = join_dimension(links, counts, "pair", small=False)
    sums = met.groupBy("file", "row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                          F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_best", "count_sum")]
    return placed.drop("pairs", "times").join(sums, ["file", "row"], "left").select(*named, *zero)


def alignment(docs: DataFrame, first: str | None = None, second: str | None = None, pairs: int = PAIRS) -> DataFrame:
    """`alignments` with the corpus-wide counts of their links: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Texts are encoded and merged once; what the second look needs is stored.
    """
    stored = cut_lineage(alignments(docs, first, second))
    return weigh(stored, pairs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
