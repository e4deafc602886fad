"""The licence scan against a plain version in Python."""

from llm_tables import SF01, docs, odd  # noqa: F401
import re

import duckdb
import pytest
import __spark_entry__ as E

from sluice.llm import licences as L


def brute(text):
    ids, rules = L.sentence_ids(L.NOTICES)
    text = text or ""
    sequences = []
    for end in (L.SENTENCE_END, L.LINE_END):
        words = (" ".join(re.sub(r"[^a-z0-9.]+|\.(?![0-9])", " ", s.lower()).split()) for s in re.split(end, text))
        sequences.append([ids[s] for s in words if s in ids])

    def inside(order, sequence):
        rest = iter(sequence)
        return all(i in rest for i in order)
    return (*sequences, sorted({n for n, order in rules if any(inside(order, s) for s in sequences)}))


def test_given_documents(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall())
    got = E.queries()["op5_licence_sentences"](spark, SF01).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r["doc_id"]])
        assert [r["sentence_ids"], r["line_ids"], r["licences"]] == [" ".join(map(str, x)) for x in want]
    assert {x for r in got for x in r["licences"].split()} == {"Apache-2.0", "MIT", "GPL-3.0", "CC-BY-NC-4.0"}


MIT = next(n for n in L.NOTICES if n.licence == "MIT" and len(n.sentences) == 2).sentences
CASES = {
    "Foo. Released under the MIT License. Bar": ["MIT"],
    "RELEASED, UNDER### the\n * MIT   license": ["MIT"],
    "not released under the MIT License": [],
    "text before\nLicensed under CC BY-NC 4.0\ntext after": ["CC-BY-NC-4.0"],
    "Licensed under CC BY 4.0. Licensed under the Apache\n License, Version 2.0.": ["Apache-2.0", "CC-BY-4.0"],
    f"{MIT[0]}: {MIT[1]}.": [],
    f"{MIT[0]}.\n\nsome gap.\n\n{MIT[1]}.": ["MIT"],
    f"{MIT[1]}.\n\n{MIT[0]}.": [],
    "/* " + MIT[0].replace(", ", ",\n * ") + ".\n *\n * " + MIT[1].replace(" in ", "\n * in ") + ".": ["MIT"],
    "SPDX-License-Identifier: MIT\ncode()": ["MIT"],
    "SPDX-License-Identifier: XYZ\nMIT": [],
}


@pytest.mark.parametrize("text", CASES)
def test_cases(docs, text):
    row = L.scan(docs([(1, text)])).first()
    assert row["licences"] == CASES[text]
    assert (row["sentence_ids"], row["line_ids"], row["licences"]) == brute(text)


def test_odd_rows(odd, docs):
    out = L.scan(odd)
    assert out.count() == 10 and all(r["licences"] == [] for r in out.collect())
    assert L.scan(docs([])).collect() == []
    plan = out._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_every_notice_is_found_by_its_own_sentences(docs):
    rows = [(i, ".\n".join(n.sentences) + ".") for i, n in enumerate(L.NOTICES)]
    got = {r["doc_id"]: r["licences"] for r in L.scan(docs(rows)).collect()}
    assert all(n.licence in got[i] for i, n in enumerate(L.NOTICES))


PUBLISHED = {
    "GPL-3.0-or-later": """Copyright (C) 2020  A. Person

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "BSD-3-Clause": """Copyright (c) 2020, A. Person

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS "AS IS".""",
    "MIT": """Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.""",
}


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
def test_published_headers(docs, mark):
    """Plain and commented, where an empty line is a comment mark alone."""
    texts = ["\n".join((mark + line).rstrip() for line in t.split("\n")) for t in PUBLISHED.values()]
    texts.append(texts[1].replace("met:\n" + mark.rstrip() + "\n", "met:\n").replace("1. ", "* ").replace("the copyright holder ", "Google Inc. "))
    got = {r["doc_id"]: r["licences"] for r in L.scan(docs(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(4)] == [[n] for n in (*PUBLISHED, "BSD-3-Clause")]
