"""Packing documents into training sequences by powers of two.

A document of n tokens is cut into pieces of the lengths in the binary form of
n, the longest being the sequence length. Each piece is a sequence of its own:
its length is a power of two, so nothing is padded, and no sequence holds two
documents. Pieces of one length lie in one bucket, from which batches of equal
shape are read.
"""

import base64
import zlib
from array import array
from collections.abc import Iterator

import numpy
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.functions.sizes import broadcast_if_small
from passerby.llm.rows import make_room, remembers
from passerby.session import cut_lineage, run_folder

SEQUENCE = 2048
END_OF_TEXT = 1
#: Word forms that a worker remembers; the memory is emptied when it is full, which changes no result.
REMEMBERED = 300_000


SPECIAL = {"<|endoftext|>": 50256}


def byte_bpe() -> str:
    """Where the ranks of the public byte-level vocabulary lie, as the default of the operator's parameter.

    They are the vocabulary of ``byte_bpe_50k.json`` in the form that the faster
    of two libraries reads; a test holds the ids of one against the other.
    """
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Spaced(Exception):
    """A word begins or ends with white space, so its text has to be encoded as a whole."""


class Tokens(dict):
    """Token ids of texts as little-endian unsigned 32-bit numbers, remembered by word.

    The pre-tokenizer of this vocabulary always parts a text before a space that
    stands between two characters other than white space. So the ids of a text
    are those of its first word and of every further word with its space in
    front. A text in which white space meets such a space is encoded as a whole.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        super().__init__()
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens=SPECIAL)
        self.ordinary = self.encoding.encode_ordinary

    def plain(self, text: str) -> bytes:
        """A special token's string in a text is that token, as the tokenizer's file says."""
        if "<|" in text:
            return numpy.array(self.encoding.encode(text, allowed_special="all"), "<u4").tobytes()
        return array("I", self.ordinary(text)).tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise Spaced
        if len(self) >= REMEMBERED:
            self.clear()
        packed = self.plain(" " + word)
        if len(word) <= 64:
            self[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        first, *words = text.split(" ")
        if not first or first[-1].isspace():
            return self.plain(text)
        try:
            return self.plain(first) + b"".join(map(self.__getitem__, words))
        except Spaced:
            return self.plain(text)


_tokens: dict[str, Tokens] = {}
remembers("packing", _tokens.clear)


def tokens_of(vocabulary: str) -> Tokens:
    """One memory for each worker process."""
    if vocabulary not in _tokens:
        _tokens[vocabulary] = Tokens(vocabulary)
    return _tokens[vocabulary]


def lengths(total: int, longest: int) -> list[int]:
    """The longest length as often as it fits, then the set bits of the rest from the highest."""
    whole, rest = divmod(total, longest)
    return [longest] * whole + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def pieces_of(docs: DataFrame, longest: int = SEQUENCE, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Each document's pieces: doc_id, start, length, ids_crc32, doc_tokens, and ids if wanted."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence has to be a power of two")
    vocabulary = vocabulary or byte_bpe()
    fields = [docs.schema["doc_id"], *(T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32", "doc_tokens"))]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = array("I", [END_OF_TEXT]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("packing")
        tokens = tokens_of(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                owners, starts, sizes, sums, totals, kept = [], [], [], [], [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    ids = tokens.encode(text or "") + end
                    start = 0
                    for size in lengths(len(ids) // 4, longest):
                        piece = ids[4 * start:4 * (start + size)]
                        owners.append(row)
                        starts.append(start)
                        sizes.append(size)
                        sums.append(zlib.crc32(piece))
                        totals.append(len(ids) // 4)
                        if keep_ids:
                            kept.append(piece)
                        start += size
                columns = [part.column(0).take(pa.array(owners, pa.int64()))]
                columns += [pa.array(values, pa.int64()) for values in (starts, sizes, sums, totals)]
                if keep_ids:
                    columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [field.name for field in fields])

    return docs.select("doc_id", "text").mapInArrow(cut, T.StructType(fields))


def pack(docs: DataFrame, longest: int = SEQUENCE, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Documents packed into sequences of at most ``longest`` tokens.

    One row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (0: a piece is a whole sequence), and ids (little-endian
    unsigned 32-bit) with ``keep_ids``. A null or empty text is the closing token
    alone. Repeated rows and null ids are packed each on its own; extra columns
    play no part; no rows give no rows.

    The pieces are written once, a folder for each length. A sequence's number
    is its row in its file after all rows of the files before it, ordered by
    length: nothing is sorted, and a task that runs again changes no number that
    anyone has read.
    """
    path = run_folder(docs.sparkSession)
    pieces_of(docs, longest, vocabulary, keep_ids).write.partitionBy("length").parquet(path)
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in ("start", "ids_crc32", "doc_tokens"))]
                          + [T.StructField("ids", T.BinaryType())] * keep_ids + [T.StructField("length", T.LongType())])
    placed = docs.sparkSession.read.schema(schema).parquet(path).withColumns({
        "file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    # One row per file, a few for each input task: the only rows that are numbered in one place.
    files = cut_lineage(placed.groupBy("file", "length").agg(F.count("*").alias("rows")))
    before = F.expr("coalesce(sum(rows) OVER (ORDER BY length, file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    based = broadcast_if_small(files.select("file", before.alias("base")))
    named = [name for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    return placed.join(based, "file").select(
        *named, (F.col("base") + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []))
