"""Quality rules: counts over a text, and a likelihood ratio of hashed n-grams.

The ratio compares two multinomials over hashed words and word pairs: one of
trusted documents, one of the whole corpus. Its mean over a text's n-grams does
not grow with the text, so one threshold judges every document alike. All of it
is column expressions.
"""

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerby.llm.rows import SPACE

#: Numbers that n-grams are hashed to; the model has one weight for each.
BUCKETS = 16_384
#: Trusted are the documents labelled good; about so many of them are counted, at most twice as many.
TRUSTED_DOCS = 20_000
PRIOR = 16_384.0
#: A document whose mean log-likelihood ratio is below this is not kept.
THRESHOLD = -0.08
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` looks into it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_and_hashes(rows: DataFrame) -> DataFrame:
    """``rows`` with word_hashes, a 64-bit hash of each word of the text in order."""
    trimmed = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    return rows.withColumn("word_hashes", F.transform(words, lambda word: F.xxhash64(word)))


def pairs(hashes: Column) -> Column:
    """A hash of each word and the next."""
    n = F.size(hashes)
    return F.slice(F.zip_with(hashes, F.slice(hashes, F.lit(2), n), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(n - 1, F.lit(0)))


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a window of `WINDOW` words found twice or more in the text, the first included.

    Windows are compared by a 64-bit hash. Only where two are equal are they
    sorted with their places; the places of the equal ones then cover
    `WINDOW` words each, or fewer where the next one begins.
    """

    def windows(h: Column) -> Column:
        n = F.size(h)
        two = F.zip_with(h, F.slice(h, F.lit(2), n), lambda a, b: F.xxhash64(a, b))
        four = let(two, lambda p: F.zip_with(p, F.slice(p, F.lit(3), n), lambda a, b: F.xxhash64(a, b)))
        five = F.zip_with(four, F.slice(h, F.lit(5), n), lambda a, b: F.xxhash64(a, b))
        return F.slice(five, F.lit(1), n - (WINDOW - 1))

    def places(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: F.sort_array(F.transform(F.filter(
            s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | (F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))),
            lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                           F.lit(0), lambda total, x: total + x)

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) < F.size(w), let(places(w), covered)).otherwise(F.lit(0))

    return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(let(windows(hashes), count))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.when(F.instr(text, "\n") > 0, let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).otherwise(F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def with_counts(rows: DataFrame) -> DataFrame:
    """``rows``, which have word_hashes, with the counts and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.withColumns({
        "n_words": F.size("word_hashes").cast("long"),
        "word_chars": F.length(without(text, BLANKS)).cast("long"),
        "n_symbols": (F.length(text) - F.length(without(text, SYMBOLS))).cast("long"),
        "n_dup_lines": repeated_lines(text).cast("long"),
        "n_repeat_words": repeated_words(F.col("word_hashes")).cast("long"),
    }).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))


def bucket(value: Column, buckets: int) -> Column:
    return F.pmod(value, F.lit(buckets)).cast("int")


def grams(hashes: Column, buckets: int) -> Column:
    """The buckets of all words and word pairs of a text."""
    return F.transform(F.concat(hashes, pairs(hashes)), lambda h: bucket(h, buckets))


def trusted_ids(labels: DataFrame, bound: int = TRUSTED_DOCS) -> DataFrame:
    """doc_id of about ``bound`` documents labelled good, at most twice as many, chosen by a hash."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    n = good.count()
    draw = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return good.filter(draw < bound / max(n, bound)) if n > bound else good


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, bound: int = TRUSTED_DOCS) -> list[float]:
    """The weight of each bucket: log of its share in trusted documents over its share in all documents.

    Every n-gram of every document is counted, added up within each task first,
    so that ``buckets`` rows for each task go on. The ids of the trusted
    documents are at most twice ``bound`` numbers; they are sent to where the
    texts are. Without trusted documents all weights are 0.
    """
    rows = words_and_hashes(docs.select("doc_id", "text"))
    trusted = F.broadcast(trusted_ids(labels, bound).withColumn("trusted", F.lit(1)))
    counted = rows.join(trusted, "doc_id", "left").select("trusted", F.explode(grams(F.col("word_hashes"), buckets)).alias("bucket"))
    counts = counted.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("good")).collect()
    raw, good = ([0] * buckets for _ in range(2))
    for row in counts:
        raw[row.bucket], good[row.bucket] = row.raw, row.good
    if not sum(good):
        return [0.0] * buckets
    return _weights(raw, good)


def _weights(raw: list[int], good: list[int]) -> list[float]:
    """Trusted counts are joined by `PRIOR` n-grams in the shares of the whole corpus, so few documents say little.

    Rounded to four digits, so that the order of additions cannot move a
    document across the threshold.
    """
    everywhere = sum(raw) + len(raw)
    shares = [(n + 1) / everywhere for n in raw]
    return [round(log((n + PRIOR * share) / (sum(good) + PRIOR) / share), 4) for n, share in zip(good, shares, strict=True)]


def ratio(hashes: Column, weights: list[float]) -> Column:
    """Mean weight of a text's n-grams; 0 for a text without words."""
    # A constant, which Spark turns into one array before the query runs.
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")

    def add(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda total, h: total + F.get(table, bucket(h, len(weights))))

    n = F.greatest(2 * F.size(hashes) - 1, F.lit(1))
    return (add(hashes) + add(pairs(hashes))) / n


def judge(docs: DataFrame, weights: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the counts, base_failed, llr (the mean ratio) and kept, replacing columns of these names.

    A null or empty text has no words and fails the base rules. Texts are read
    whole; repeated rows are judged alike; other columns pass through.
    """
    own = ["word_hashes", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
    counted = with_counts(words_and_hashes(docs.drop(*own)))
    scored = counted.withColumn("llr", ratio(F.col("word_hashes"), weights)).drop("word_hashes")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.round("llr", 9) >= threshold))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The verdict on every document: its id, counts, base_failed, llr and kept."""
    return judge(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")
