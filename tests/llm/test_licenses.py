from __future__ import annotations

import random
import re
import time

from cinderlog.llm import licenses

MIT = """MIT License

Copyright (c) 2020 X

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
* Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
* Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""


def test_texts(spark, edges, nothing):
    texts = [
        (1, MIT, "MIT"), (2, BSD, "BSD-2-Clause"), (3, "words |\nLicensed under CC BY-NC 4.0.\nmore", "CC-BY-NC-4.0"),
        (4, "SPDX-License-Identifier: Apache-2.0\n", "Apache-2.0"), (5, MIT + BSD, "BSD-2-Clause,MIT"),
        (6, "Redistributions in binary form are permitted.", ""), (7, "RELEASED UNDER THE MIT LICENSE!", "MIT"),
        (8, "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software. " + MIT.split("\n\n")[2] + ".", ""),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, expected string")
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert {i: found[i].licenses for i, _, _ in texts} == {i: e for i, _, e in texts}
    assert found[8].n_unmatched == 2  # the right sentences in the wrong order
    assert all(r.sentence_ids == r.licenses == "" for r in licenses.scan(edges).collect())
    assert licenses.scan(edges).count() == 12 and licenses.scan(nothing).count() == 0


def test_every_sentence_has_a_hint_and_every_rule_known_sentences():
    for name, wordings in licenses.SENTENCES.items():
        for wording in wordings:
            assert re.search(licenses.HINT, wording), name
    assert {s for _, rule in licenses.RULES for s in rule} <= set(licenses.SENTENCES)


def _plain(ids):
    """(licences, unmatched) by taking each rule's sentences from a list, rule by rule."""
    left, names = list(ids), set()
    for name, rule in licenses.RULES:
        begun, rest = [], []
        for x in left:
            if x == rule[len(begun)]:
                begun.append(len(rest))
            rest.append(x)
            if len(begun) == len(rule):
                for at in begun:
                    rest[at] = None
                begun = []
                names.add(name)
        left = [x for x in rest if x is not None]
    return ",".join(sorted(names)), len(left)


def _text_of(ids):
    return "".join(licenses.SENTENCES[x][0] + ".\n\n" for x in ids)


def test_rules_match_brute_force(spark, monkeypatch):
    pick = random.Random(8)
    kinds = [[s for _, rule in licenses.RULES for s in rule if s.startswith(p)] for p in ("mit_", "bsd", "apache2", "")]
    rows = [(i, [pick.choice(kinds[i % 4]) for _ in range(pick.randint(0, 40))]) for i in range(120)]
    for stretch in (licenses.STRETCH, 3):
        monkeypatch.setattr(licenses, "STRETCH", stretch)
        found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(i, _text_of(x)) for i, x in rows], "doc_id bigint, text string")).collect()}
        for i, ids in rows:
            assert found[i].sentence_ids == ",".join(ids)
            assert (found[i].licenses, found[i].n_unmatched) == _plain(ids)


def test_any_number_of_sentences_takes_its_time_only(spark):
    grant = licenses.SENTENCES["mit_grant"][0] + ".\n"
    many = {
        1: grant + "Licensed under the MIT License\n" * 200_000,
        2: _text_of(["mit_grant"] * 20_000 + ["mit_notice"] * 20_000 + ["mit_as_is"] * 20_000),  # never a liability
        3: _text_of(["mit_grant", "mit_notice", "mit_as_is", "mit_liability"] * 10_000),
    }
    start = time.perf_counter()
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(many.items()), "doc_id bigint, text string")).collect()}
    assert time.perf_counter() - start < 120
    assert [found[i].licenses for i in (1, 2, 3)] == ["MIT"] * 3
    assert [found[i].n_unmatched for i in (1, 2, 3)] == [1, 60_000 - 2, 0]


def test_wrapped_sentences_are_seen(spark):
    texts = [(1, "This is free and unencumbered software released into the public\ndomain."), (2, "All rights\n  reserved.")]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert found[1].licenses == "Unlicense" and found[2].sentence_ids == "reserved"
    for wordings in licenses.SENTENCES.values():
        for wording in wordings:
            assert re.search(licenses.HINT, re.sub(" ", "\n \t", wording))
