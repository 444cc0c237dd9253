"""What several operators of this subpackage share: columns that cannot clash, learning rows, word forms."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a text are the runs without ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def words_of(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda word: word != "")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo `FOLDS`, is 0.

    A null id counts as held out, as nothing says that it may be learnt from.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sample_per_class(rows: DataFrame, label: str, key: str, bound: int, seed: int = 0) -> DataFrame:
    """About ``bound`` rows of each value of ``label``, at most twice as many, chosen by a hash of ``key``.

    The chance of a row follows from the counts of the classes, so a class of
    any size gives as many rows and nothing is sorted. The counts have one row
    per class; more than 10,000 classes are refused, as that is no label.
    """
    counts = rows.groupBy(label).count().limit(10_001).collect()
    if len(counts) > 10_000:
        raise ValueError(f"{label} has more than 10,000 values")
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(1.0)
    for row in counts:
        if row["count"] > bound:
            share = F.when(F.col(label).eqNullSafe(row[label]), bound / row["count"]).otherwise(share)
    return rows.filter(draw < share)


def carry(docs: DataFrame, *needed: str) -> DataFrame:
    """The ``needed`` columns, and all others in one column, so that no name of theirs meets an operator's own."""
    others = [F.col(f"`{name}`") for name in docs.columns if name not in needed]
    return docs.select(*needed, *([F.struct(*others).alias("carried_columns")] if others else []))


def put_down(rows: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    """Carried rows with the columns of ``docs`` again."""
    return rows.select(*[F.col(name) if name in needed else F.col(f"carried_columns.`{name}`").alias(name) for name in docs.columns])


_memories: dict[str, Callable[[], None]] = {}


def remembers(operator: str, forget: Callable[[], None]) -> None:
    """Tells how to empty what an operator remembers in a worker process."""
    _memories[operator] = forget


def make_room(operator: str) -> None:
    """Empties what other operators remember: a worker process serves one stage of a pipeline after another.

    What earlier tasks have freed goes back to the machine, as far as Arrow has kept it.
    """
    for other, forget in _memories.items():
        if other != operator:
            forget()
    pa.default_memory_pool().release_unused()
