"""Licence scans by sentences: known sentences become identifiers, and rules match runs of identifiers in order.

All of it is SQL expressions on each document, without a shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from cinderlog.functions import quoted

#: Sentence identifiers with the wordings that count as them.
SENTENCES = {
    "mit_ref": (
        "Released under the MIT License", "Licensed under the MIT License", "Distributed under the MIT License",
        "This project is licensed under the MIT License", "SPDX-License-Identifier: MIT",
    ),
    "mit_title": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "mit_grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    "mit_notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software",
    ),
    "mit_as_is": (
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to "
        "the warranties of merchantability, fitness for a particular purpose and noninfringement",
    ),
    "mit_liability": (
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether "
        "in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use "
        "or other dealings in the software",
    ),
    "bsd_grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    "bsd_source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer",
    ),
    "bsd_binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "bsd_endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "bsd_ref": ("Released under the BSD License", "Licensed under the BSD License"),
    "bsd2_ref": ("Licensed under the BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"),
    "bsd3_ref": ("Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"),
    "isc_grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "isc_ref": ("Licensed under the ISC License", "SPDX-License-Identifier: ISC"),
    "apache2_ref": (
        "Licensed under the Apache License, Version 2.0", "Licensed under the Apache License 2.0",
        "Released under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0",
    ),
    "apache2_header": ("Licensed under the Apache License, Version 2.0 (the License)",),
    "apache2_use": ("You may not use this file except in compliance with the License",),
    "gpl_program": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    "gpl2_program": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version",
    ),
    "gpl3_ref": (
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3", "Licensed under the GPLv3",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "gpl2_ref": (
        "This work is licensed under the GNU General Public License, version 2",
        "Licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "lgpl_ref": ("Licensed under the GNU Lesser General Public License, version 3",),
    "agpl_ref": ("Licensed under the GNU Affero General Public License, version 3",),
    "mpl_header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0", "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc0_ref": ("Licensed under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"),
    "cc_by_ref": (
        "Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc_by_sa_ref": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc_by_nc_ref": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "reserved": ("All rights reserved",),
}

#: Licences in the order in which they are tried, with the sentences that must follow one another; other
#: known sentences may stand between them. A sentence that one licence takes is not there for the next.
RULES = (
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is", "mit_liability")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT", ("mit_ref",)),
    ("MIT", ("mit_title",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("BSD-3-Clause", ("bsd3_ref",)),
    ("BSD-2-Clause", ("bsd2_ref",)),
    ("BSD", ("bsd_ref",)),
    ("ISC", ("isc_grant",)),
    ("ISC", ("isc_ref",)),
    ("Apache-2.0", ("apache2_header", "apache2_use")),
    ("Apache-2.0", ("apache2_ref",)),
    ("GPL-3.0-or-later", ("gpl_program",)),
    ("GPL-2.0-or-later", ("gpl2_program",)),
    ("GPL-3.0-only", ("gpl3_ref",)),
    ("GPL-2.0-only", ("gpl2_ref",)),
    ("LGPL-3.0-only", ("lgpl_ref",)),
    ("AGPL-3.0-only", ("agpl_ref",)),
    ("MPL-2.0", ("mpl_header",)),
    ("CC0-1.0", ("cc0_ref",)),
    ("CC-BY-4.0", ("cc_by_ref",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_ref",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_ref",)),
    ("Unlicense", ("unlicense",)),
)

#: Every known sentence has one of these words, whatever parts them, so a text without any has no known sentence.
HINT = (
    "(?i)licen|copyright|permission|redistribut|warrant|liab|public[^A-Za-z0-9]+domain|rights[^A-Za-z0-9]+reserved"
    "|provided[^A-Za-z0-9]+that"
)

#: Where a sentence ends; a wrapped line goes on.
SENTENCE_END = r"[.!?]+[ \t\r\n]+|[.!?]+$|:[ \t\r]*\n|\n[ \t\r]*\n"


def normal(sentence: str) -> str:
    """A sentence as lower-case words and numbers, parted by single blanks."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Identifier by normalised wording; a wording with a sentence end inside is known by what stands before it."""
    return {
        normal(re.split(SENTENCE_END, wording)[0]): name for name, wordings in SENTENCES.items() for wording in wordings
    }


def sentence_ids(text: str) -> str:
    """SQL: identifiers of the known sentences of a text, in order. A sentence that is not known as a whole is looked
    up by its lines, so that a licence line counts after a line without an end."""
    pairs = ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in known_sentences().items())
    words = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' '))"
    looked = "try_element_at(map({}), {})"
    whole = looked.format(pairs, words.format("s"))
    lines = f"transform(split(s, '\\\\n', -1), l -> {looked.format(pairs, words.format('l'))})"
    return (
        f"CASE WHEN {text} RLIKE {quoted(HINT)} THEN filter(flatten(transform(split({text}, {quoted(SENTENCE_END)}, -1), "
        f"s -> CASE WHEN s NOT RLIKE {quoted(HINT)} AND NOT contains(s, ' ') THEN CAST(array() AS array<string>) "
        f"WHEN {whole} IS NOT NULL THEN array({whole}) ELSE {lines} END)), i -> i IS NOT NULL) "
        "ELSE CAST(array() AS array<string>) END"
    )


#: Identifiers that are walked at once: what a walk takes is put together for so many, and then for the text.
STRETCH = 1_000
_WALK = "struct<at:int,gone:int,k:int,open:array<int>,n:int,taken:array<int>>"
_TEXT = "struct<walk:{walk},taken:array<array<int>>>".format(walk=_WALK)


def walk(sentences: tuple[str, ...], gone: str = "CAST(array() AS array<int>)", ids: str = "ids") -> str:
    """SQL: how often the sentences follow one another among the identifiers, as (n, taken), taken being their places.

    One walk from the left: the next sentence that is waited for is taken where it first comes, and after the last one the
    first is waited for again; what is begun and not ended is not taken. Places in `gone`, in order, are passed over.
    The time is that of the identifiers, however many rules they begin.
    """
    wanted = f"array({', '.join(map(quoted, sentences))})"
    empty = "CAST(array() AS array<int>)"

    def state(at: str, g: str, k: str, opened: str, n: str, taken: str) -> str:
        return f"CAST(named_struct('at', {at}, 'gone', {g}, 'k', {k}, 'open', {opened}, 'n', {n}, 'taken', {taken}) AS {_WALK})"

    step = (
        f"CASE WHEN try_element_at(gone, s.gone + 1) = s.at THEN {state('s.at + 1', 's.gone + 1', 's.k', 's.open', 's.n', 's.taken')} "
        f"WHEN x <> {wanted}[s.k] THEN {state('s.at + 1', 's.gone', 's.k', 's.open', 's.n', 's.taken')} "
        f"WHEN s.k < {len(sentences) - 1} THEN {state('s.at + 1', 's.gone', 's.k + 1', 'array_append(s.open, s.at)', 's.n', 's.taken')} "
        f"ELSE {state('s.at + 1', 's.gone', '0', empty, 's.n + 1', 'concat(s.taken, s.open, array(s.at))')} END"
    ).replace("try_element_at(gone,", f"try_element_at({gone},")
    fresh = state("t.walk.at", "t.walk.gone", "t.walk.k", "t.walk.open", "t.walk.n", empty)
    one = f"aggregate(slice({ids}, i * {STRETCH} + 1, {STRETCH}), {fresh}, (s, x) -> {step})"
    # the stretch is walked once and then put in place: a list of one holds it meanwhile
    put = (
        f"transform(array({one}), w -> CAST(named_struct('walk', w, 'taken', array_append(t.taken, w.taken)) AS {_TEXT}))[0]"
    )
    start = f"CAST(named_struct('walk', {state('0', '0', '0', empty, '0', empty)}, 'taken', CAST(array() AS array<array<int>>)) AS {_TEXT})"
    walked = (
        f"aggregate(sequence(0, (size({ids}) - 1) DIV {STRETCH}), {start}, (t, i) -> {put}, "
        "t -> named_struct('n', t.walk.n, 'taken', flatten(t.taken)))"
    )
    there = " AND ".join(f"array_contains({ids}, {quoted(x)})" for x in dict.fromkeys(sentences))
    return f"CASE WHEN {there} THEN {walked} ELSE named_struct('n', 0, 'taken', {empty}) END"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, sentence_ids, licenses and n_unmatched.

    sentence_ids are the known sentences in order, licenses the names found, each once and sorted; both joined by
    commas and empty if there are none, as for a null or empty text. n_unmatched counts known sentences that no rule
    took. Repeated rows each get their row. Very long texts, and any number of known sentences, take time in proportion.
    """
    found = docs.select(F.col(key).alias("id"), F.expr(sentence_ids(f"`{text}`")).alias("ids"))
    counts, taken, walked = [], [], {}
    for at, (name, sentences) in enumerate(RULES):
        if len(sentences) == 1:
            # a sentence that makes a licence by itself: no other rule waits for it
            count = f"size(filter(ids, i -> i = {quoted(sentences[0])}))"
        else:
            column, rest = f"walk_{at}", [w for w, before in walked.items() if set(before) & set(sentences)]
            if len(rest) > 1:
                raise ValueError("a sentence may be taken by two rules at most")
            found = found.withColumn(column, F.expr(walk(sentences, *[f"{w}.taken" for w in rest])))
            walked[column], count = sentences, f"{column}.n"
        counts.append(f"named_struct('name', {quoted(name)}, 'n', {count})")
        taken.append(f"{count} * {len(sentences)}")
    names = f"transform(filter(array({', '.join(counts)}), c -> c.n > 0), c -> c.name)"
    return found.selectExpr(
        f"id AS `{key}`", "array_join(ids, ',') AS sentence_ids",
        f"CASE WHEN size(ids) > 0 THEN array_join(array_sort(array_distinct({names})), ',') ELSE '' END AS licenses",
        f"CASE WHEN size(ids) > 0 THEN CAST(size(ids) - ({' + '.join(taken)}) AS BIGINT) ELSE 0L END AS n_unmatched",
    )
