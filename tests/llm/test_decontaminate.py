from __future__ import annotations

from cinderlog.llm import decontaminate
from tests.llm import plain


def _judged(docs, benchmark):
    rows = decontaminate.contamination(docs, benchmark).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows), key=str)


def _expected(docs, benchmark):
    items = {r.item_id: r.text for r in benchmark.collect()}
    return sorted(((r.doc_id, *plain.contamination(r.text, items)) for r in docs.collect()), key=str)


def test_documents_match_brute_force(spark, documents, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert _judged(documents, benchmark) == _expected(documents, benchmark)


def test_short_items_overlaps_and_edges(spark, edges, nothing):
    benchmark = spark.createDataFrame(
        [(1, "one"), (2, "b c d"), (3, None), (4, ""), (5, "Repeated ROW"), (6, "word word word"), (7, "h a b"),
         (8, "straße 😀"), (9, "no key at all ...")], "item_id bigint, text string",
    )
    assert _judged(edges, benchmark) == _expected(edges, benchmark)
    assert _judged(nothing, benchmark) == []
    none = benchmark.where("false")
    assert _judged(edges, none) == _expected(edges, none)
    kept = decontaminate.drop_contaminated(edges, benchmark)
    assert kept.columns == edges.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 10}


def test_benchmark_in_blocks_gives_the_same(spark, documents, sf_dir, monkeypatch):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = _judged(documents, benchmark)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert len(list(decontaminate.benchmark_blocks(benchmark))) > 2
    assert _judged(documents, benchmark) == whole


def test_hits_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, "a b c d e f")], "doc_id bigint, text string").coalesce(1)
    found = _judged(docs, spark.createDataFrame([(1, "b c d e")], "item_id bigint, text string"))
    assert [(r[0], r[2]) for r in found] == [(1, 0), (2, 0), (3, 4)]


def test_proximity_is_told_apart(spark):
    docs = spark.createDataFrame([(1, "w1 w2 w3 w4 w5"), (2, "w1 w2 x w3 w4 w5"), (3, "w1 w2 x x x x x w3 w4 w5")], "doc_id bigint, text string")
    found = decontaminate.contamination(docs, spark.createDataFrame([(1, "w1 w2 w3 w4 w5")], "item_id bigint, text string"))
    assert sorted((r.doc_id, r.n_items, r.n_near_items) for r in found.collect()) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_repeated_items_count_once(spark, edges):
    items = spark.createDataFrame([(1, "one"), (6, "word word word"), (9, "repeated row")], "item_id bigint, text string")
    repeated = items
    for _ in range(4):
        repeated = repeated.unionAll(repeated)
    assert sum(map(len, decontaminate.benchmark_blocks(repeated))) == 3
    assert _judged(edges, repeated) == _judged(edges, items)


def test_proximity_stops_at_the_borders_of_a_document(spark):
    """Words of a neighbour complete nothing, whichever documents share a segment; swapped words at an end still match."""
    item = spark.createDataFrame([(1, "w1 w2 w3 w4 w5")], "item_id bigint, text string")
    rows = [(1, "w1 w2 w3 w4"), (2, "w5 x"), (3, "y w1"), (4, "w2 w3 w4 w5"), (5, "w1 w2 w3 w5 w4"), (6, "w2 w1 w3 w4 w5"), (7, "w1 w2 w3 w4 w5")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for partitions in (1, 7):
        found = decontaminate.contamination(docs.repartition(partitions) if partitions > 1 else docs.coalesce(1), item).collect()
        assert sorted((r.doc_id, r.n_items, r.n_near_items) for r in found) == [
            (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 0, 1), (6, 0, 1), (7, 1, 0)]
