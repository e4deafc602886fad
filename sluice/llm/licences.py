"""Licence scan by sentence rules, on DataFrame functions only.

A text is split into sentences, which are normalised (lower case, words only).
A sentence that belongs to a known licence notice becomes its identifier; all
others are gaps. A licence is recognised where the identifiers of one of its
rules follow each other in the text in the rule's order, with any gaps. The
split is made twice, at sentence ends alone, so that a sentence may be wrapped
over lines, and at line ends as well, so that a line may stand by itself. The
sentences of all rules are a fixed small map inside the expression, so the scan
is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked


@dataclass(frozen=True)
class Notice:
    """A licence and the sentences that announce it, in order."""
    licence: str
    sentences: tuple[str, ...]


#: The rules. Sentences are compared after normalising, so case, punctuation and line breaks do not matter.
NOTICES = (
    Notice("Apache-2.0", ("Licensed under the Apache License, Version 2.0",)),
    Notice("Apache-2.0", ("SPDX-License-Identifier: Apache-2.0",)),
    Notice("Apache-2.0", ("Licensed under the Apache License, Version 2.0 (the \"License\")",
                          "you may not use this file except in compliance with the License")),
    Notice("MIT", ("Released under the MIT License",)),
    Notice("MIT", ("Licensed under the MIT License",)),
    Notice("MIT", ("SPDX-License-Identifier: MIT",)),
    Notice("MIT", ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                   "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                   "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                   "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                   "furnished to do so, subject to the following conditions",
                   "The above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the Software")),
    Notice("GPL-3.0", ("This work is licensed under the GNU General Public License, version 3",)),
    Notice("GPL-3.0-or-later", ("SPDX-License-Identifier: GPL-3.0-or-later",)),
    Notice("GPL-3.0-or-later", ("either version 3 of the License, or (at your option) any later version",
                                "You should have received a copy of the GNU General Public License along with this program")),
    Notice("CC-BY-NC-4.0", ("Licensed under CC BY-NC 4.0",)),
    Notice("CC-BY-4.0", ("Licensed under CC BY 4.0",)),
    Notice("CC-BY-SA-4.0", ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",)),
    Notice("BSD-3-Clause", ("Redistributions of source code must retain the above copyright notice, this list of conditions "
                            "and the following disclaimer",
                            "Redistributions in binary form must reproduce the above copyright notice, this list of "
                            "conditions and the following disclaimer in the documentation and/or other materials "
                            "provided with the distribution",
                            "may be used to endorse or promote products derived from this software without specific prior "
                            "written permission")),
    # The sentences of the notices as they are published, with the usual names in them.
    Notice("GPL-3.0-or-later", ("This program is free software: you can redistribute it and/or modify it under the terms of "
                                "the GNU General Public License as published by the Free Software Foundation, either "
                                "version 3 of the License, or (at your option) any later version",
                                "You should have received a copy of the GNU General Public License along with this program")),
    *(Notice("BSD-3-Clause", (first, "Redistributions in binary form must reproduce the above copyright notice, this list of "
                              "conditions and the following disclaimer in the documentation and/or other materials "
                              "provided with the distribution", f"{name}nor the names of {whose} contributors may be used to "
                              "endorse or promote products derived from this software without specific prior written "
                              "permission"))
      for lead in ("", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                       "provided that the following conditions are met: ")
      for first in (f"{lead}Redistributions of source code must retain the above copyright notice, this list of "
                    "conditions and the following disclaimer",)
      # The last one follows a name that ends with a point, such as Google Inc.
      for name, whose in (("Neither the name of the copyright holder ", "its"), ("Neither the name of the copyright holder ", "the"),
                          ("Neither the name of the copyright holders ", "its"), ("Neither the name of the <organization> ", "its"),
                          ("Neither the name of the University ", "its"), ("Neither the name of the author ", "its"),
                          ("Neither the name of Google LLC ", "its"), ("", "its"))),
)

#: Sentences end at . ; ! ? before anything but a letter or digit, and at a line that is empty but for comment marks.
SENTENCE_END = r"[.;!?]+(?![A-Za-z0-9])|\n[\s*#/%-]*\n"
LINE_END = SENTENCE_END + r"|\n"
#: Everything but words; a point stays within numbers such as 2.0.
_NOT_WORD = r"[^a-z0-9.]+|\.(?![0-9])"


def split_sentences(text: str) -> list[str]:
    """Normalised sentences of one string; the rules pass through it."""
    parts = (re.sub(_NOT_WORD, " ", s.lower()) for s in re.split(SENTENCE_END, text))
    return [" ".join(s.split()) for s in parts if s.strip()]


def sentence_ids(notices: tuple[Notice, ...]) -> tuple[dict[str, int], list[tuple[str, tuple[int, ...]]]]:
    """Identifier of every known sentence, and the rules as (licence, identifiers in order)."""
    ids: dict[str, int] = {}
    rules = []
    for notice in notices:
        parts = [p for s in notice.sentences for p in split_sentences(s)]
        rules.append((notice.licence, tuple(ids.setdefault(p, len(ids) + 1) for p in parts)))
    return ids, rules


def known_sentences(text: Column, end: str, ids: dict[str, int]) -> Column:
    """Array of the identifiers of known sentences, in text order."""
    table = F.create_map(*[F.lit(x) for s, i in ids.items() for x in (s, i)])
    clean = lambda s: F.trim(F.regexp_replace(F.lower(s), _NOT_WORD, " "))
    # A known sentence holds one of these, which spares the others the normalising.
    likely = lambda s: F.regexp_like(s, F.lit(r"(?i)licen[sc]e|permission|redistribution|copyright"))
    sentences = F.filter(F.split(F.coalesce(text, F.lit("")), end), likely)
    return F.array_compact(F.transform(sentences, lambda s: F.try_element_at(
        table, F.trim(F.regexp_replace(clean(s), " +", " ")))))


def scan(docs: DataFrame, text: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """``docs`` with ``sentence_ids`` and ``line_ids`` (identifiers of the known
    sentences of either split, in text order) and ``licences`` (sorted array of
    the licences recognised).

    Defined cases: a null or empty text has no identifiers and no licences;
    rows are scanned one by one, so repeated rows come out equal; input columns
    named like an added one are replaced by it.
    """
    ids, rules = sentence_ids(notices)
    if any(not re.search(r"licen[sc]e|permission|redistribution|copyright", s) for s in ids):
        raise ValueError("every sentence of a notice must hold one of the words a sentence is looked up for")
    rows = docs.select(packed(docs), known_sentences(F.col(f"`{text}`"), SENTENCE_END, ids).alias("sentence_ids"),
                       known_sentences(F.col(f"`{text}`"), LINE_END, ids).alias("line_ids"))
    line = lambda c: F.concat(F.lit(" "), F.array_join(F.transform(c, lambda i: i.cast("string")), "  "), F.lit(" "))
    rows = rows.withColumn("by_sentence", line("sentence_ids")).withColumn("by_line", line("line_ids"))
    found = []
    for name, order in rules:
        pattern = "%" + "%".join(f" {i} " for i in order) + "%"
        found.append(F.when(F.col("by_sentence").like(pattern) | F.col("by_line").like(pattern), F.lit(name)))
    added = ("sentence_ids", "line_ids", "licences")
    return rows.select(*unpacked(rows, docs.columns, added), "sentence_ids", "line_ids",
                       F.array_sort(F.array_distinct(F.array_compact(F.array(*found)))).alias("licences"))


def _sql(notices: tuple[Notice, ...] = NOTICES) -> str:
    """DuckDB SQL for ``scan`` on ``documents``, identifiers joined by blanks.
    Its patterns know no look-ahead, so they take the character after a point
    along, which the normalising drops or keeps."""
    ids, rules = sentence_ids(notices)
    known = "[" + ", ".join(f"'{s}'" for s in ids) + "]"
    clean = ("trim(regexp_replace(regexp_replace(regexp_replace(lower(s), '[^a-z0-9.]+', ' ', 'g'), "
             "'\\.+([^0-9]|$)', ' \\1', 'g'), ' +', ' ', 'g'))")
    end = r"[.;!?]+(?:[^A-Za-z0-9]|$)|\n\s*\n"
    found = lambda e: (f"list_filter(list_transform(string_split_regex(coalesce(text, ''), '{e}'), "  # noqa: E731
                       f"lambda s: list_position({known}, {clean})), lambda i: i > 0)")
    line = lambda c: f"' ' || array_to_string({c}, '  ') || ' '"
    cases = []
    for name, order in rules:
        pattern = "%" + "%".join(f" {i} " for i in order) + "%"
        cases.append(f"CASE WHEN {line('a')} LIKE '{pattern}' OR {line('b')} LIKE '{pattern}' THEN '{name}' END")
    return f"""
WITH t AS (SELECT doc_id, {found(end)} AS a, {found(end + '|' + chr(92) + 'n')} AS b FROM documents)
SELECT doc_id, array_to_string(a, ' ') AS sentence_ids, array_to_string(b, ' ') AS line_ids,
       array_to_string(list_sort(list_distinct(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL))), ' ') AS licences
FROM t"""


SQL = _sql()
