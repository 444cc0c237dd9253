"""Empty tables, very long values and odd columns, for the operators whose own tests leave them out."""

from passerby.llm import components, mixing, neighbours, packing, quality_rules, warc


def test_search_without_rows_and_with_clashing_columns(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0, -1.0], "x", 0.5) for i in range(8)], "vec_id long, embedding array<float>, rank string, score double")
    index = neighbours.build(rows)
    assert neighbours.search(index, rows.limit(0)).count() == 0
    found = neighbours.search(index, rows.filter("vec_id = 0"), nearest=3).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert neighbours.search(neighbours.build(rows.limit(0)), rows).count() == 0


def test_mixture_without_rows_and_of_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "w " * 300_000, "a", 9), (2, "x", "b", 9), (3, None, None, 9), (4, "", "b", 9)], "doc_id long, text string, source string, copies int")
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixture(docs.limit(0)).count() == 0
    taken = {r.doc_id: r for r in mixing.mixture(docs).collect()}
    assert taken[1].size == 300_000 and taken[2].size == 1 and taken[3].size == taken[4].size == 0
    assert all(r.taken <= 3 * r.size for r in taken.values())


def test_packing_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "a " * 300_000, "x"), (2, "z" * 300_000, "x")], "doc_id long, text string, length string")
    pieces = packing.pack(docs).collect()
    for doc_id in (1, 2):
        own = sorted((p.start, p.length) for p in pieces if p.doc_id == doc_id)
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))
        assert sum(n for _, n in own) == next(p.doc_tokens for p in pieces if p.doc_id == doc_id)
    assert packing.pack(docs.limit(0)).count() == 0


def test_archives_without_pages_and_of_very_long_payloads(spark):
    pages = spark.createDataFrame([(1, "http://a/" + "u" * 50_000, "p" * 3_000_000, "x"), (2, "http://a/2", "p" * 3_000_000, "x"), (3, None, None, "x")],
                                  "page_id long, url string, html string, payload_digest string")
    assert warc.round_trip(pages.limit(0)).count() == 0
    found = {r.page_id: r for r in warc.round_trip(pages, range_bytes=1000).collect()}
    assert (found[1].record_type, found[1].payload_bytes) == ("response", 3_000_000)
    assert (found[2].record_type, found[2].refers_to, found[2].payload_digest) == ("revisit", 1, found[1].payload_digest)
    assert (found[3].record_type, found[3].payload_bytes) == ("response", 0)


def test_quality_rules_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, kept string")
    assert quality_rules.judge(docs.limit(0), [0.0] * quality_rules.BUCKETS).count() == 0


def test_components_without_edges_and_of_a_star(spark):
    edges = spark.createDataFrame([], "a long, b long")
    assert components.components(edges).count() == 0
    star = spark.createDataFrame([(0, i) for i in range(1, 500)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)], "a long, b long")
    found = {r.node: r.component for r in components.components(star).collect()}
    assert all(found[i] == 0 for i in range(500)) and all(found[1000 + i] == 1000 for i in range(61))
