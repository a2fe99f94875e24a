from __future__ import annotations

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from cinderlog.llm import queries
from cinderlog.llm.common import table
from tests.compare import connect, difference
from tests.llm import plain


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage reads and returns."""
    docs, found = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        found.append((name, docs, out))
        docs = out
    return {name: (a.collect(), b.collect(), b.columns) for name, a, b in found}


def test_stages_keep_the_columns(stages, spark, sf_dir):
    columns = table(spark, sf_dir, "documents").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(own == columns for name, (_, _, own) in stages.items() if name != "best_fit_packing")


def test_quality_stage(stages, spark, sf_dir):
    before, after, _ = stages["quality_rules"]
    kept = {r.doc_id for r in after}
    verdict = {r.doc_id: r.kept for r in queries.op3_quality_rules(spark, sf_dir).collect()}
    assert kept == {r.doc_id for r in before if verdict[r.doc_id]}
    for r in after:
        n, *_, repeats = plain.counts(r.text)
        assert n >= 20 and 100 * repeats <= 30 * n


def test_near_duplicate_stage(stages):
    """One document of each component of five-word similarity 0.8 or more, by brute force."""
    before, after, _ = stages["simhash_dedup"]
    assert sorted(r.doc_id for r in after) == plain.kept_of_near_copies([(r.doc_id, r.text) for r in before])


def test_decontamination_stage(stages, spark, sf_dir):
    before, after, _ = stages["benchmark_decontamination"]
    items = {r.item_id: r.text for r in table(spark, sf_dir, "benchmark").collect()}
    clean = {r.doc_id for r in before if not plain.contamination(r.text, items)[-1]}
    assert {r.doc_id for r in after} == clean


def test_secret_stage(stages):
    before, after, _ = stages["secret_scans"]
    texts = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for r in before:
        own = texts[r.doc_id]
        assert not plain.secret_spans(own.text)
        assert (own.text == r.text) == (not plain.secret_spans(r.text)) and own.n_chars == len(own.text)


def test_packing_stage(stages):
    before, after, _ = stages["best_fit_packing"]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    ends = {}
    for r in sorted(after, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024


def test_run_gives_the_rows_of_the_stages(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    _, after, _ = stages["best_fit_packing"]
    assert sorted(map(tuple, rows)) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(name, spark, sf_dir):
    assert difference(registry.queries()[name](spark, sf_dir), connect(sf_dir), registry.oracle_sql()[name]) is None


def test_all_are_registered():
    names = registry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
