"""URL filters: parsing, listed rules and mined rules against plain loops."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from passerby.llm import url_rules as u

URLS = ["http://a.example.net/en/1", "https://EXAMPLE.net/en/", "http://example.net/english", "http://net/x", "http://xnet/x", "http://b.net", "http://b.net?x=/en/",
        "http://www.example.com/de/2#top", "http://example.com/en/3", "http://notexample.com/de/2", "http://x.org/fr/1?q=1", "http://org/fr/", "ftp://ÄB.Org/fr/ä b",
        "no scheme", "", None, "://", "http://", "a://b://c.net/de/", "http://x.org/FR/", "http://h.net/a?b#c", "http://h.net#/en/", "http://user@h.net:80/en/1"]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + q), h + q, v) for h, q, v in u.RULES if (host == h or host.endswith(f".{h}")) and path.startswith(q)]
    return host, path, max(fits)[1] if fits else None


def test_host_path_and_listed_rule(spark):
    pages = spark.createDataFrame([(i, url, "x") for i, url in enumerate(URLS)] + [(None, URLS[0], "x"), (0, URLS[0], "x")], "page_id long, url string, rule string")
    found = u.judge(pages).collect()
    assert len(found) == len(URLS) + 2
    verdicts = {h + q: v for h, q, v in u.RULES}
    for row in found:
        host, path, rule = plain(URLS[row.page_id if row.page_id is not None else 0])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdicts[rule] if rule else row.verdict) and row.verdict in ("allow", "block")


def pages_of(spark):
    urls = [f"http://{h}.example.{top}/{lang}/{i}" for i in range(30) for h in ("blog", "www", "shop") for top in ("net", "com", "org") for lang in ("en", "de", "fr")]
    return spark.createDataFrame(list(enumerate(urls + ["http://net.odd/de/net"] * 5)), "page_id long, url string")


def test_mined_rules_as_by_all_combinations(spark):
    rows = u.read_urls(pages_of(spark)).cache()
    found = {(frozenset(r.tokens), r.verdict): (r.confidence, r.support) for r in u.mine(rows, 0.02, 0.7).collect()}
    seen, hits, total = Counter(), Counter(), 0
    for row in rows.collect():
        total += 1
        for n in range(1, 6):
            for combination in combinations(sorted(row.tokens), n):
                seen[frozenset(combination)] += 1
                if row.listed:
                    hits[frozenset(combination), row.listed.verdict] += 1
    expected = {}
    for (tokens, verdict), n in sorted(hits.items(), key=lambda kv: len(kv[0][0])):
        confidence = n / seen[tokens]
        if n >= 0.02 * total and confidence >= 0.7 and not any(v == verdict and t < tokens and c >= confidence for (t, v), (c, _) in expected.items()):
            expected[tokens, verdict] = (pytest.approx(confidence), pytest.approx(n / total))
            expected[tokens, verdict] = (confidence, n / total)
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k]) for k in found)


def by_all_combinations(rows, min_support, min_confidence, longest=u.LONGEST):
    """Rules of labelled (tokens, verdict) rows by counting every combination."""
    seen, hits = Counter(), Counter()
    for tokens, verdict in rows:
        for n in range(1, longest + 1):
            for combination in combinations(sorted(tokens), n):
                seen[combination] += 1
                hits[combination, verdict] += 1
    base = Counter(verdict for _, verdict in rows)
    rules = {}
    for (tokens, verdict), n in sorted(hits.items(), key=lambda kv: (len(kv[0][0]), kv[0])):
        confidence = n / seen[tokens]
        if n >= min_support * len(rows) and confidence >= min_confidence and confidence > base[verdict] / len(rows) and not any(
                v == verdict and set(t) <= set(tokens) and c >= confidence for (t, v), (c, _) in rules.items()):
            rules[tokens, verdict] = (confidence, n / len(rows))
    return rules


@pytest.mark.parametrize("tokens", [16, 25])
def test_urls_of_many_frequent_tokens(spark, tokens):
    """Half of the pages of either verdict have the same path words: these tell nothing, and the words of one verdict all."""
    chance = random.Random(tokens)
    urls = []
    for i in range(60):
        words = [f"t{n}" for n in range(tokens) if chance.random() < 0.9]
        only = ["late", "last"] if i % 3 else ["last"]
        urls.append(f"http://h{i}.example.net/" + "/".join(words + only))
        urls.append("http://c.example.net/en/" + "/".join(f"t{n}" for n in range(tokens) if chance.random() < 0.9))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = u.read_urls(pages).cache()
    plain_rows = [(r.tokens, r.listed.verdict) for r in rows.collect()]
    assert min(len(t) for t, _ in plain_rows) > u.AT_ONCE and all(verdict for _, verdict in plain_rows)
    expected = by_all_combinations(plain_rows, 0.2, 0.8)
    found = {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in u.mine(rows, 0.2, 0.8).collect()}
    assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k]) for k in found)
    assert (("path:late",), "block") in found and (("path:en",), "allow") in found


def test_tokens_of_both_verdicts_give_no_rule(spark):
    urls = [f"http://h{i}.example.net/" + "/".join(f"t{n}" for n in range(16)) for i in range(50)]
    urls += ["http://c.example.net/en/" + "/".join(f"t{n}" for n in range(16))] * 50
    found = u.mine(u.read_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))).collect()
    assert {(tuple(r.tokens), r.verdict) for r in found} >= {(("host:c",), "allow"), (("path:en",), "allow")}
    assert not any(token.startswith("path:t") for r in found for token in r.tokens if len(r.tokens) == 1)
    assert all(r.verdict == "allow" or r.confidence < 1 or any(t.startswith("host:h") for t in r.tokens) for r in found)


def test_sets_hold_every_combination(spark):
    for n in (0, 1, 12, 13, 14, 23):
        row = spark.createDataFrame([([f"t{i}" for i in range(n)],)], "tokens array<string>").select(u.sets_of(F.col("tokens")).alias("sets")).first()
        assert all(len(s) <= u.AT_ONCE for s in row.sets)
        assert {c for s in row.sets for c in combinations(sorted(s), 3)} == set(combinations(sorted(f"t{i}" for i in range(n)), 3))


def test_one_url_that_most_pages_have_and_a_very_long_one(spark):
    urls = ["http://edu/casino/1"] * 400 + [None] * 200 + [f"http://a.example.net/casino/{i}" for i in range(20)]
    urls += [f"http://c.example.net/en/{i}" for i in range(20)] + ["http://edu/" + "/".join(f"w{i}" for i in range(30_000)), "http://edu/casino/" + "x" * 300_000]
    pages = spark.createDataFrame([(i, url, "x", 1) for i, url in enumerate(urls)], "page_id long, url string, tokens string, mined int")
    found = {r.page_id: r.verdict for r in u.judge(pages).collect()}
    assert len(found) == len(urls) and {found[i] for i in range(400)} == {"block"} and {found[i] for i in range(400, 600)} == {"allow"}
    assert found[len(urls) - 2] == "allow" and found[len(urls) - 1] == "block"


def test_verdicts_as_by_trying_all_rules(spark):
    pages = pages_of(spark)
    rows = u.read_urls(pages).cache()
    rules = [r.asDict() for r in u.mine(rows.filter("listed IS NOT NULL")).collect()]
    tokens = {r.page_id: (set(r.tokens), r.listed) for r in rows.collect()}
    for row in u.judge(pages).collect():
        own, listed = tokens[row.page_id]
        fits = [(r["confidence"], r["support"], len(r["tokens"]), r["verdict"], r["tokens"]) for r in rules if own >= set(r["tokens"])]
        assert row.verdict == (listed.verdict if listed else max(fits)[3] if fits else u.DEFAULT)


def test_rules_from_labelled_pages_decide_others(spark):
    labelled = [f"http://{h}.example.net/{word}/{i}" for i in range(20) for h, word in (("a", "casino"), ("b", "casino"), ("c", "en"), ("d", "en"), ("e", "news"))]
    others = [f"http://x{i}.example.edu/casino/{i}" for i in range(60)] + [f"http://y{i}.example.edu/en/{i}" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(labelled + others)), "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in u.judge(pages).collect()}
    assert all(verdicts[len(labelled) + i] == "block" for i in range(60))
    assert all(verdicts[len(labelled) + 60 + i] == "allow" for i in range(60))
    # Three fifths of the labelled pages are blocked: what is no surer than that is no rule.
    rows = u.read_urls(pages).filter("listed IS NOT NULL")
    assert all(r.confidence > (0.6 if r.verdict == "block" else 0.4) for r in u.mine(rows, 0.01, 0.3).collect())
    assert not [r for r in u.mine(rows, 0.01, 0.3).collect() if r.tokens in (["host:net"], ["host:example"])]


def test_the_registered_query_mines_labelled_pages(spark, tmp_path):
    from passerby.llm import registry

    urls = [f"http://a.example.net/casino/{i}" for i in range(9)] + [f"http://c.example.net/en/{i}" for i in range(9)] + ["http://edu/casino/1"] * 30
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    found = registry.op8_association_url_rules(spark, str(tmp_path)).filter("rule IS NULL").collect()
    assert len(found) == 30 and {r.verdict for r in found} == {"block"}


def test_no_pages_and_no_labels(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert u.judge(empty).count() == 0
    plain_pages = spark.createDataFrame([(1, "http://a.de/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in u.judge(plain_pages).collect()} == {"allow"}


def test_no_python_in_the_plan(spark):
    plan = u.judge(pages_of(spark).select("page_id", F.lower("url").alias("url")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
