"""URL filters: listed rules, and association rules that FP-growth mines from them.

The pages that a listed rule decides are the labelled ones. Every URL is a set
of tokens; FP-growth finds the combinations of tokens that a good part of the
pages has, and how surely a combination comes with a verdict. Pages without a
listed rule get the verdict of the surest mined rule whose tokens they all have,
looked up by the rarest token of each rule. All of it is column expressions and
Spark's own FP-growth.
"""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerby.functions.sizes import broadcast_if_small, join_dimension
from passerby.session import cut_lineage

#: (host, path, verdict): a rule holds for its host and all subdomains, where the path starts with its own.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
#: A rule asks for so many tokens at most.
LONGEST = 3
#: FP-growth sees so many tokens of a URL at once, which have 2**12 combinations. A URL of more frequent
#: tokens is several sets of that size, which together hold every combination of `LONGEST` of them.
AT_ONCE = 12
#: What a page without any rule gets.
DEFAULT = "allow"
SIGN = "verdict="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty if it is null or has no ``://``."""
    start = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest listed rule that fits, as (rule, verdict); null if none does. Ties go to the first by name."""
    chosen = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda rule: (-len(rule[0] + rule[1]), rule)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen if chosen is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Parts of the host, words of the path and names in the query, each once and marked by where it is from."""
    def marked(mark: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda part: part != ""), lambda part: F.concat(F.lit(mark), part))

    return F.array_distinct(F.concat(
        marked("host:", F.split(host, r"[.:@]+")), marked("path:", F.split(F.lower(path), r"[^\p{L}\p{N}]+")),
        marked("query:", F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]*)"), 1))))


def read_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """url, host, path, listed (rule and verdict) and tokens of each row."""
    rows = pages.select("page_id", "url")
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    return rows.withColumns({"listed": listed_rule(F.col("host"), F.col("path"), rules),
                             "tokens": tokens_of(F.col("url"), F.col("host"), F.col("path"))})


def frequent_tokens(rows: DataFrame, least: float) -> list[str]:
    """Tokens that at least so many pages have, the rarest first.

    There are at most (mean tokens of a page / share of pages) of them, however
    many pages there are.
    """
    counts = rows.select(F.explode("tokens").alias("token")).groupBy("token").count().filter(F.col("count") >= least).collect()
    return [row.token for row in sorted(counts, key=lambda row: (row["count"], row.token))]


def sets_of(tokens: Column, longest: int = LONGEST, at_once: int = AT_ONCE) -> Column:
    """Sets of at most ``at_once`` tokens that hold every combination of ``longest`` of them.

    The tokens are cut into groups; every ``longest`` groups together are a set.
    """
    size = at_once // longest
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / size).cast("int")), lambda i: F.slice(tokens, i * size + 1, size))
    n = F.size(groups)

    def united(chosen: list[Column]) -> Column:
        if len(chosen) == longest:
            return F.array(F.flatten(F.array(*[F.get(groups, i) for i in chosen])))
        first = chosen[-1] + 1 if chosen else F.lit(0)
        return F.flatten(F.transform(F.sequence(first, n - (longest - len(chosen))), lambda i: united([*chosen, i])))

    return F.when(F.size(tokens) <= at_once, F.array(tokens)).otherwise(united([]))


def mine(rows: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, longest: int = LONGEST) -> DataFrame:
    """Mined rules of at most ``longest`` tokens: tokens, verdict, confidence, support, key (the rule's rarest token).

    FP-growth finds the combinations that enough pages may have with a verdict;
    these are then counted over the whole token sets of all ``rows``. A rule's
    confidence is the share of a verdict in all rows that have its tokens; rows
    without a label, if there are any, count against it. A rule is dropped if
    fewer of its tokens say the same as surely, or none of them: it must be surer
    than the verdict's share of ``rows``.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double, key string")
    total = rows.count()
    frequent = frequent_tokens(rows, min_support * total) if total else []
    if not frequent:
        return empty
    order = F.array(*[F.lit(token) for token in frequent])
    own = rows.select(F.array_intersect(order, F.col("tokens")).alias("own"), F.col("listed.verdict").alias("verdict"))
    sign = F.when(F.col("verdict").isNotNull(), F.array(F.concat(F.lit(SIGN), F.col("verdict")))).otherwise(F.array().cast("array<string>"))
    sets = cut_lineage(own.select(F.explode(sets_of(F.col("own"), longest)).alias("some"), sign.alias("sign")).select(F.concat("some", "sign").alias("items")))
    # A page is one set or more, so what enough pages have is in at least as many sets.
    least = min_support * total / sets.count()
    found = FPGrowth(itemsCol="items", minSupport=least).fit(sets).freqItemsets
    signs = F.filter("items", lambda item: item.startswith(SIGN))
    plain = F.array_sort(F.filter("items", lambda item: ~item.startswith(SIGN)))
    # As many as frequent combinations at most; the parameters bound them, not the number of pages.
    needed = cut_lineage(found.filter(F.size(signs) == 1).select(plain.alias("needed")).filter(F.size("needed").between(1, longest)).distinct())
    rarest = F.array_min(F.transform("needed", lambda token: F.array_position(order, token)))
    index = broadcast_if_small(needed.withColumn("key", F.element_at(order, rarest.cast("int"))))
    hits = (own.select("own", "verdict", F.explode("own").alias("key")).join(index, "key")
            .filter(F.size(F.array_except("needed", "own")) == 0))
    both = {verdict: F.count(F.when(F.col("verdict") == verdict, 1)).alias(verdict) for verdict in ("allow", "block")}
    counts = hits.groupBy("needed", "key").agg(F.count(F.lit(1)).alias("n"), *both.values())
    rules = counts.select("needed", "key", "n", F.explode(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("hits")) for v in both])).alias("one"))
    sure = rules.select("needed", "key", "one.verdict", (F.col("one.hits") / F.col("n")).alias("confidence"), (F.col("one.hits") / total).alias("support")).filter(
        (F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
    base = {row.verdict: row["count"] / total for row in own.groupBy("verdict").count().collect() if row.verdict}
    kept: list[tuple] = []
    for row in sorted(sure.collect(), key=lambda row: (len(row.needed), row.needed, row.verdict)):
        tokens = frozenset(row.needed)
        if row.confidence > base[row.verdict] and not any(v == row.verdict and c >= row.confidence and frozenset(t) <= tokens for t, v, c, _, _ in kept):
            kept.append((row.needed, row.verdict, row.confidence, row.support, row.key))
    return spark.createDataFrame(kept, empty.schema) if kept else empty


def match(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """url and the verdict of the surest mined rule for each different URL that one fits.

    Ties in confidence go to the rule of more support, then of more tokens, then
    to block, then to the first by name.
    """
    urls = rows.filter("listed IS NULL AND url IS NOT NULL").groupBy("url").agg(F.first("tokens").alias("tokens"))
    index = broadcast_if_small(rules.withColumnRenamed("tokens", "needed"))
    hits = (urls.select("url", "tokens", F.explode("tokens").alias("key")).join(index, "key")
            .filter(F.size(F.array_except("needed", "tokens")) == 0))
    rank = F.struct("confidence", "support", F.size("needed").alias("n"), "verdict", "needed")
    return hits.groupBy("url").agg(F.max(rank).alias("best")).select("url", F.col("best.verdict").alias("mined"))


def judge(pages: DataFrame, rules: tuple = RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    Rules are mined from the pages that a listed rule decides; support and
    confidence are shares of these. ``rule`` is the listed rule, null if none
    fits; the verdict is its, else that of the mined rules, else `DEFAULT`. A
    null URL has no tokens and gets the default. Repeated rows are judged alike;
    other columns play no part; no pages give no rows. A URL that many pages have
    is matched once; a very long one may have any number of tokens.
    """
    rows = cut_lineage(read_urls(pages, rules))
    mined = match(rows, mine(rows.filter("listed IS NOT NULL"), min_support, min_confidence))
    open_to_rules = F.col("listed").isNull() & F.col("url").isNotNull()
    # Only what a mined rule can decide is joined, whatever share of the rows one URL has.
    met = join_dimension(rows.filter(open_to_rules), mined, "url", "left")
    return met.unionByName(rows.filter(~open_to_rules), allowMissingColumns=True).select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "mined", F.lit(DEFAULT)).alias("verdict"))
