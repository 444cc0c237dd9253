"""Links between texts by the Jaccard similarity of their word n-grams, exact, by vertical partitioning.

All n-grams have one global order, rare ones first. A text's set, written in
this order, begins with a prefix of which any similar text shares a part; texts
that share part of it are candidates. The order is cut into fragments that hold
about equally many n-grams. Each fragment counts the overlaps of its own
segments of the candidates' sets; the counts are summed for each pair.

Texts with equal sets are one node from the start. Candidates are not taken from
all pairs of a group of copies. First every node is compared with the best of
the nodes that stand first at one of its n-grams; that joins most of a group in
as many comparisons as it has members. Only pairs of different components that
could still be similar are compared then, so no link is lost.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.functions.sizes import broadcast_if_small
from passerby.llm.components import components
from passerby.llm.rows import carry, make_room, put_down, remembers
from passerby.session import cut_lineage

#: The order knows how often n-grams occur by counts of so many hash ranges.
RANGE_BITS = 19
FRAGMENTS = 8
#: Bits in which two sets' difference shows, and those of the first look.
BITS, FEW_BITS = 1024, 256
REMEMBERED = 200_000
C1, C2, C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


@dataclass(frozen=True)
class Rule:
    """Two sets are linked if their intersection is at least ``percent`` of their union."""

    words: int = 5
    percent: int = 80

    def prefix(self, n: int) -> int:
        """So many of a set's first n-grams hold one of any linked set: all but percent of ``n``, and one more."""
        return n - -(-n * self.percent // 100) + 1

    def may_link(self, difference: Column, a: Column, b: Column) -> Column:
        """Whether sets of sizes ``a`` and ``b`` of which so many members are not shared, or more, can be linked."""
        return difference * (100 + self.percent) <= (100 - self.percent) * (a + b)

    def links(self, shared: Column, a: Column, b: Column) -> Column:
        return 100 * shared >= self.percent * (a + b - shared)


class Hashes(dict):
    """64-bit hashes of words, remembered; the memory is emptied when it is full, which changes no result."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_hashes = Hashes()
remembers("jaccard_join", _hashes.clear)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * C2
    x = (x ^ (x >> np.uint64(27))) * C3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct hashes of a text's n-grams, ascending.

    A to Z count as a to z; words are parted by ASCII white space. A text of
    fewer words is one n-gram of all it has; one without words has none.
    """
    found = (text or "").encode().lower().split()
    values = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    if not len(found):
        return values
    size = min(words, len(found))
    count = len(found) - size + 1
    total = np.full(count, size, np.uint64)
    for at in range(size):
        total = mixed(total * C1 + values[at:at + count])
    return np.unique(total)


def range_counts(docs: DataFrame, words: int) -> np.ndarray:
    """How many members of sets fall into each range of hashes, over all documents.

    A fixed number of ranges, so that the counts have one size whatever the
    number of documents: 4 MB. They are added up within each task first.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("jaccard_join")
        total = np.zeros(1 << RANGE_BITS, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                sets = [shingles(text, words) for text in batch.column(0).slice(first, 200).to_pylist()]
                ranges = np.concatenate(sets) >> np.uint64(64 - RANGE_BITS)
                total += np.bincount(ranges.astype(np.int64), minlength=1 << RANGE_BITS)
        seen = np.flatnonzero(total)
        for first in range(0, len(seen), 10_000):
            part = seen[first:first + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["range", "n"])

    counted = docs.select("text").mapInArrow(count, "range int, n long").groupBy("range").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << RANGE_BITS, np.int64)
    total[counted["range"]] = counted["n"]
    return total


@dataclass
class Order:
    """The global order: by the count of an n-gram's range, then by its hash; and the fragments it is cut into."""

    counts: np.ndarray
    fragments: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, fragments: int = FRAGMENTS) -> "Order":
        places = np.argsort(counts, kind="stable")
        upto = np.cumsum(counts[places])
        cut = np.zeros(len(counts), np.int8)
        cut[places] = np.minimum(fragments - 1, (upto - counts[places]) * fragments // max(1, int(upto[-1])))
        return cls(counts, cut)

    def ranges(self, members: np.ndarray) -> np.ndarray:
        return (members >> np.uint64(64 - RANGE_BITS)).astype(np.int64)

    def arrange(self, members: np.ndarray) -> np.ndarray:
        """Ascending hashes in the global order."""
        return members[np.argsort(self.counts[self.ranges(members)], kind="stable")]

    def segments(self, members: np.ndarray) -> list[np.ndarray]:
        """A set's members in each fragment."""
        own = self.fragments[self.ranges(members)]
        return [members[own == fragment] for fragment in range(int(self.fragments.max(initial=0)) + 1)]


def parity(members: np.ndarray) -> np.ndarray:
    """Bits of which each turns with every member that falls on it: where two sets' bits differ, so do the sets."""
    odd = np.bincount((members % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def fingerprint(members: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(members.tobytes())


LONGS = T.ArrayType(T.LongType())


def sets_of(docs: DataFrame, rule: Rule, order: Order) -> DataFrame:
    """doc_id, n (size of the set), set_id, prefix (in the global order) and bits of every document."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("set_id", T.BinaryType()),
                           T.StructField("prefix", LONGS), T.StructField("bits", LONGS)])
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("jaccard_join")
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                sets = [shingles(text, rule.words) for text in part.column(1).to_pylist()]
                prefixes = [shared.value.arrange(s)[:rule.prefix(len(s)) if len(s) else 0].view(np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())), pa.array([parity(s) for s in sets], pa.list_(pa.int64()))],
                    [field.name for field in schema.fields])

    return docs.select("doc_id", "text").mapInArrow(describe, schema)


def differing(a: Column, b: Column) -> Column:
    """In how many bits two arrays of longs differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)


def folded(bits: Column) -> list[Column]:
    """The first look's bits: each stands for those of `BITS` that lie `FEW_BITS` apart, together."""
    longs, few = BITS // 64, FEW_BITS // 64
    out = []
    for at in range(few):
        value = F.get(bits, F.lit(at))
        for further in range(at + few, longs, few):
            value = value.bitwiseXOR(F.get(bits, F.lit(further)))
        out.append(value.alias(f"f{at}"))
    return out


def overlaps(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, rule: Rule, order: Order) -> DataFrame:
    """The linked ones among ``pairs`` (a, b, n_a, n_b) of nodes.

    Each fragment's segments go to where its counting is done: one of a for all
    its pairs, and one of b for each pair. A fragment's count of a pair is the
    size of the intersection of two segments; the sum over the fragments is the
    size of the intersection of the sets.
    """
    pairs = cut_lineage(pairs)
    tasks = pairs.select(F.col("b").alias("node"), F.col("a").alias("with")).union(
        pairs.select(F.col("a").alias("node"), F.lit(None).cast("long").alias("with")).distinct())
    # For each document that stands for a node: its set's id, and the nodes whose segments meet its own.
    asked = cut_lineage(tasks.join(nodes.select("node", "smallest", "set_id"), "node").groupBy("smallest", "node").agg(
        F.first("set_id").alias("set_id"), F.collect_list("with").alias("with"), F.max(F.col("with").isNull()).alias("first")))
    asked = asked.withColumnRenamed("smallest", "doc_id")
    rows = docs.select("doc_id", "text").join(broadcast_if_small(asked, 1_000_000), "doc_id").select("text", "node", "set_id", "with", "first")
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("jaccard_join")
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                out: tuple[list, list, list, list] = ([], [], [], [])
                for text, node, set_id, others, first in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    members = shingles(text, rule.words)
                    if not len(members) or fingerprint(members) != set_id:
                        continue  # another text under the same id
                    for fragment, segment in enumerate(shared.value.segments(members)):
                        if len(segment):
                            for other in others + [None] * first:
                                for column, value in zip(out, (node if other is None else other, None if other is None else node,
                                                               fragment, segment.view(np.int64)), strict=True):
                                    column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                                                  pa.array(out[3], pa.list_(pa.int64()))], ["a", "b", "fragment", "segment"])

    segments = rows.mapInArrow(cut, "a long, b long, fragment int, segment array<long>")
    firsts = segments.filter("b IS NULL").select("a", "fragment", F.col("segment").alias("of_a")).dropDuplicates(["a", "fragment"])
    seconds = segments.filter("b IS NOT NULL").join(firsts, ["a", "fragment"])
    # Rows that repeat a document count once.
    partial = seconds.groupBy("a", "b", "fragment").agg(F.max(F.size(F.array_intersect("segment", "of_a"))).alias("n"))
    summed = partial.groupBy("a", "b").agg(F.sum("n").alias("shared"))
    return cut_lineage(summed.join(pairs, ["a", "b"]).filter(rule.links(F.col("shared"), F.col("n_a"), F.col("n_b"))).select("a", "b", "shared"))


def shared_postings(nodes: DataFrame, rule: Rule) -> DataFrame:
    """key, node, n and rank of the prefixes' n-grams that several nodes have.

    Where they are two, the two have to fit each other in size and in rank.
    Every n-gram of every prefix is moved once: counting and keeping share one
    distribution by n-gram. A node's size and the rank are carried in one number.
    """
    every = nodes.select("node", "n", F.posexplode("prefix").alias("rank", "key"))
    packed = F.shiftleft(F.col("n"), 32).bitwiseOR(F.col("rank").cast("long")).alias("n_rank")
    dealt = every.select("key", "node", packed).repartition("key")

    def n(c: str) -> Column:
        return F.shiftright(F.col(c), 32)

    def rank(c: str) -> Column:
        return F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))

    seen = dealt.groupBy("key").agg(F.count("node").alias("nodes"), F.min("n_rank").alias("low"), F.max("n_rank").alias("high"))
    two_fit = (100 * n("low") >= rule.percent * n("high")) & rule.may_link(rank("low") + rank("high"), n("low"), n("high"))
    several = seen.filter((F.col("nodes") > 2) | ((F.col("nodes") == 2) & two_fit)).select("key")
    return dealt.join(several, "key").select("key", "node", n("n_rank").alias("n"), rank("n_rank").cast("int").alias("rank"))


def first_pairs(postings: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Each node with the most alike of the nodes that stand first at one of its n-grams.

    First at an n-gram is the node that has the fewest rarer ones before it,
    which is the plainest of a group of copies.
    """
    first = postings.groupBy("key").agg(F.min(F.struct("rank", "node", "n")).alias("hub")).select(
        "key", F.col("hub.node").alias("a"), F.col("hub.n").alias("n_a"), F.col("hub.rank").alias("rank_a"))
    met = postings.join(first, (postings["key"] == first["key"]) & (F.col("node") != F.col("a"))
                        & (100 * F.least("n", "n_a") >= rule.percent * F.greatest("n", "n_a")))
    pairs = met.groupBy("a", F.col("node").alias("b")).agg(F.first("n_a").alias("n_a"), F.first("n").alias("n_b"))
    bits = nodes.select("node", "bits")
    pairs = pairs.join(bits.select(F.col("node").alias("a"), F.col("bits").alias("bits_a")), "a").join(
        bits.select(F.col("node").alias("b"), F.col("bits").alias("bits_b")), "b")
    pairs = pairs.withColumn("apart", differing(F.col("bits_a"), F.col("bits_b"))).filter(rule.may_link(F.col("apart"), F.col("n_a"), F.col("n_b")))
    best = pairs.groupBy("b").agg(F.min(F.struct("apart", "a", "n_a", "n_b")).alias("best"))
    return best.select("best.a", "b", "best.n_a", "best.n_b")


def further_pairs(postings: DataFrame, nodes: DataFrame, known: DataFrame, rule: Rule) -> DataFrame:
    """All pairs of different components that could still be linked.

    They share an n-gram of their prefixes. At the first they share, all that
    comes before is not shared, and neither is more than what shows in the bits:
    both bounds have to leave room for a link.
    """
    described = nodes.select("node", *folded(F.col("bits"))).join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = cut_lineage(postings.join(described, "node"))
    mixed_keys = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    rows = cut_lineage(rows.join(mixed_keys, "key"))
    other = rows.select(*[F.col(c).alias(f"{c}_b") for c in rows.columns])
    apart = sum((F.bit_count(F.col(f"f{i}").bitwiseXOR(F.col(f"f{i}_b"))) for i in range(FEW_BITS // 64)), F.lit(0))
    fits = ((F.col("key") == F.col("key_b")) & (F.col("node") < F.col("node_b")) & (F.col("component") != F.col("component_b"))
            & (100 * F.least("n", "n_b") >= rule.percent * F.greatest("n", "n_b"))
            & rule.may_link(F.col("rank") + F.col("rank_b"), F.col("n"), F.col("n_b")) & rule.may_link(apart, F.col("n"), F.col("n_b")))
    pairs = rows.join(other, fits).groupBy(F.col("node").alias("a"), F.col("node_b").alias("b")).agg(
        F.first("n").alias("n_a"), F.first("n_b").alias("n_b"))
    bits = nodes.select("node", "bits")
    pairs = pairs.join(bits.select(F.col("node").alias("a"), F.col("bits").alias("bits_a")), "a").join(
        bits.select(F.col("node").alias("b"), F.col("bits").alias("bits_b")), "b")
    return pairs.filter(rule.may_link(differing(F.col("bits_a"), F.col("bits_b")), F.col("n_a"), F.col("n_b"))).select("a", "b", "n_a", "n_b")


def linked_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, set_id, component and component_id of every document, see `link`.

    Components of different sets can have one component_id, where rows of
    different texts repeat an id; ``component`` tells them apart.
    """
    order = Order.of(range_counts(docs, rule.words))
    sets = cut_lineage(sets_of(docs, rule, order))
    # A node for each different set: it stands for all its documents, however many.
    nodes = cut_lineage(sets.filter("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("smallest"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"),
    ).withColumn("node", F.monotonically_increasing_id()))
    postings = cut_lineage(shared_postings(nodes, rule))
    links = overlaps(docs, first_pairs(postings, nodes, rule), nodes, rule, order)
    known = components(links)
    more = overlaps(docs, further_pairs(postings, nodes, known, rule), nodes, rule, order)
    known = components(links.union(more))
    joined = nodes.select("node", "set_id", "smallest").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = joined.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = joined.join(least, "component").select("set_id", "component", "component_id")
    found = sets.select("doc_id", F.col("n").alias("n_shingles"), "set_id").join(named, "set_id", "left")
    return found.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))


def link(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    component_id is the smallest doc_id that can be reached by links, the
    document's own included. A text that is null, empty or without words has an
    empty set and is linked with nothing. Rows that repeat an id are documents
    of their own; a row without an id is linked with nothing and has no
    component. Texts are read whole; extra columns play no part.
    """
    return linked_sets(docs, rule).select("doc_id", "n_shingles", "component_id")


def with_set_ids(rows: DataFrame, rule: Rule) -> DataFrame:
    """``rows`` with the fingerprint of each text's set as ``set_id``, null for an empty set."""
    schema = T.StructType([*rows.schema.fields, T.StructField("set_id", T.BinaryType())])
    at = rows.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("jaccard_join")
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                sets = (shingles(text, rule.words) for text in part.column(at).to_pylist())
                ids = pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [field.name for field in schema.fields])

    return rows.mapInArrow(add, schema)


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id, and all rows without an id.

    Where rows of different texts repeat an id, each is a document of its own:
    of a component the smallest set_id under its smallest id stays. Of rows
    that repeat both, one stays.
    """
    groups = linked_sets(docs, rule).filter("doc_id IS NOT NULL")
    groups = cut_lineage(groups.groupBy("doc_id", "component").agg(
        F.count("*").alias("rows"), F.min(F.when(F.col("doc_id") == F.col("component_id"), F.struct("set_id"))).alias("least")))
    kept = groups.groupBy(F.col("doc_id").alias("kept_id")).agg(F.sum("rows").alias("rows"), F.count("least").alias("components")).filter("components > 0")
    # A table of its own, so that how many ids there are is counted once.
    kept = broadcast_if_small(cut_lineage(kept.select("kept_id", "rows")), 1_000_000)
    marked = carry(docs, "doc_id", "text").join(kept, F.col("doc_id") == F.col("kept_id"), "left")
    single = marked.filter("doc_id IS NULL OR rows = 1")
    # Only rows that repeat an id are looked at again: which set is theirs tells whether they are the one.
    least = groups.filter("least IS NOT NULL").select(F.col("doc_id").alias("least_id"), F.col("least.set_id").alias("least_set"))
    several = with_set_ids(marked.filter("rows > 1"), rule)
    several = several.join(least, (F.col("doc_id") == F.col("least_id")) & F.col("set_id").eqNullSafe(F.col("least_set")), "left_semi")
    repeated = several.dropDuplicates(["doc_id", "set_id"]).drop("set_id")
    return put_down(single.union(repeated), docs, "doc_id", "text")


#: The links of the whole table, and all that can be reached by them.
ORACLE = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM cut),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
edges AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reached r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s.s
"""
