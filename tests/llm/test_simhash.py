from __future__ import annotations

import itertools

import numpy as np
import pytest

from cinderlog.llm import graph, simhash
from tests.llm import plain


def _expected(rows):
    prints = {i: plain.fingerprint(t) for i, t in enumerate(t for _, t in rows)}
    least = plain.groups(prints)
    keys = [k for k, _ in rows]
    groups = {}
    for i, g in least.items():
        groups.setdefault(g, []).append(keys[i])
    named = {g: min((k for k in own if k is not None), default=None) for g, own in groups.items()}
    return sorted(((keys[i], f"{prints[i]:016x}", named[least[i]]) for i in prints), key=str)


def test_documents_match_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    found = [tuple(r) for r in simhash.near_duplicates(documents).collect()]
    assert sorted(found, key=str) == _expected(rows)


def test_edges_match_brute_force(edges):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert sorted((tuple(r) for r in simhash.near_duplicates(edges).collect()), key=str) == _expected(rows)


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one(nothing).columns == nothing.columns


def test_one_document_of_each_component_stays(edges):
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted((k for k, _ in rows), key=str) == sorted([1, 4, 6, 7, 8, 9, 10, None], key=str)


@pytest.mark.parametrize("block", [3, 20_000])
def test_links_lose_no_pair_in_groups_of_any_size(spark, block):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 4, dtype=np.uint64)
    values = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))
              for c in centres for _ in range(60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    links = simhash.links(nodes, simhash.make_plan(nodes), block=block)
    labels = {r.node: r.label for r in graph.connected_components(links, "a", "b").collect()}
    prints = {v: v & (2**64 - 1) for v in signed}
    expected = plain.groups(prints)
    found = {v: labels.get(v, v) for v in signed}
    for a, b in itertools.combinations(signed, 2):
        assert (found[a] == found[b]) == (expected[a] == expected[b])


def test_thresholds_are_the_cheapest_that_lose_nothing():
    costs = [[0, 1, 5, 9, 20, 50], [0, 100, 200, 400, 800, 900], [0, 2, 3, 4, 30, 60]]
    cost, radii = simhash.allocate(costs, 4)
    assert sum(radii) == 4 - 3 + 1
    every = (r for r in itertools.product(range(-1, 5), repeat=3) if sum(r) == 2)
    assert cost == min(sum(costs[i][t + 1] for i, t in enumerate(r)) for r in every)


def test_bits_that_go_together_share_a_group():
    gram = np.diag(np.full(64, 50.0))
    gram[0, 40] = gram[40, 0] = 50
    gram += 25 * (1 - np.eye(64)) * (gram == 0)
    assert any({0, 40} <= set(g) for g in simhash.bit_groups(100, gram, 4))


def test_components_of_a_long_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, None), (5, 5)]
    found = graph.connected_components(spark.createDataFrame(pairs, "a bigint, b bigint"), "a", "b").collect()
    assert {r.node: r.label for r in found} == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}
