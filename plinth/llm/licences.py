"""License scans by sentence rules.

A text falls into units at line ends and at ends of sentences. Normalised, one unit or
several in a row may be a known licence sentence; so each text becomes a sequence of
sentence identifiers with gaps between. Rules are ordered sequences of identifiers;
they are tried in order, the more specific first, and a sentence serves one match only.
Anything may stand between two sentences of a match but the rule's own first sentence.

Defined results: a null or empty text has no match; places count code points of the
whole text, the end exclusive; a sentence that lines break is still one sentence; very
long texts are read whole; of rules that tie for a sentence the first in order has it;
repeated rows give the same matches; an empty table gives no rows; only the id and the
matches are returned, so other columns' names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.words import arrow_map

# Sentences of licences and licence notices, as they are published.
SENTENCES: dict[str, str] = {
    "cc-by-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-line": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-line": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-work": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "mit-line": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-line": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl3-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mpl2-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "apache-under": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-limits": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl-line": "Distributed under the Boost Software License, Version 1.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

#: (licence, rule, sentences), in the order in which they are tried.
Rule = tuple[str, str, tuple[str, ...]]
RULES: tuple[Rule, ...] = (
    ("MIT", "mit-text", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", "mit-grant-notice", ("mit-grant", "mit-notice")),
    ("ISC", "isc-text", ("isc-grant", "isc-as-is")),
    ("BSD-3-Clause", "bsd-3-text", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", "bsd-2-text", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", "apache-header", ("apache-under", "apache-use", "apache-copy", "apache-as-is", "apache-limits")),
    ("Apache-2.0", "apache-short-header", ("apache-under", "apache-use")),
    ("GPL-3.0-or-later", "gpl-3-header", ("gpl-free", "gpl-hope", "gpl-details")),
    ("GPL-3.0-or-later", "gpl-3-grant", ("gpl-free",)),
    ("GPL-2.0-or-later", "gpl-2-header", ("gpl2-free", "gpl-hope", "gpl-details")),
    ("GPL-2.0-or-later", "gpl-2-grant", ("gpl2-free",)),
    ("LGPL-2.1-or-later", "lgpl-21-grant", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", "lgpl-3-grant", ("lgpl3-free",)),
    ("AGPL-3.0-or-later", "agpl-3-grant", ("agpl3-free",)),
    ("Zlib", "zlib-text", ("zlib-as-is", "zlib-grant")),
    ("BSL-1.0", "bsl-line", ("bsl-line",)),
    ("MPL-2.0", "mpl-2-header", ("mpl2-form", "mpl2-copy")),
    ("MPL-2.0", "mpl-2-form", ("mpl2-form",)),
    ("Apache-2.0", "apache-line", ("apache-line",)),
    ("MIT", "mit-line", ("mit-line",)),
    ("MIT", "mit-licensed", ("mit-licensed",)),
    ("GPL-3.0-only", "gpl-3-line", ("gpl3-line",)),
    ("GPL-2.0-only", "gpl-2-line", ("gpl2-line",)),
    ("LGPL-3.0-only", "lgpl-3-line", ("lgpl3-line",)),
    ("CC-BY-4.0", "cc-by-line", ("cc-by-line",)),
    ("CC-BY-4.0", "cc-by-work", ("cc-by-work",)),
    ("CC-BY-SA-4.0", "cc-by-sa-line", ("cc-by-sa-line",)),
    ("CC-BY-SA-4.0", "cc-by-sa-work", ("cc-by-sa-work",)),
    ("CC-BY-NC-4.0", "cc-by-nc-line", ("cc-by-nc-line",)),
    ("CC-BY-NC-4.0", "cc-by-nc-work", ("cc-by-nc-work",)),
    ("CC-BY-ND-4.0", "cc-by-nd-line", ("cc-by-nd-line",)),
    ("CC-BY-ND-4.0", "cc-by-nd-work", ("cc-by-nd-work",)),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa-line", ("cc-by-nc-sa-line",)),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa-work", ("cc-by-nc-sa-work",)),
    ("CC-BY-NC-ND-4.0", "cc-by-nc-nd-line", ("cc-by-nc-nd-line",)),
    ("CC-BY-NC-ND-4.0", "cc-by-nc-nd-work", ("cc-by-nc-nd-work",)),
    ("Unlicense", "unlicense", ("unlicense",)),
    ("CC0-1.0", "cc0-line", ("cc0-line",)),
)

_UNIT = re.compile(r"[^\n.!?;:]+(?:[.!?;:]+(?=[^\s.!?;:])[^\n.!?;:]*)*[.!?;:]*")
_WORD = re.compile(r"[^\W_]+")



def normalised(text: str) -> list[str]:
    """Lower-cased words of letters and digits; a number or letter that counts a list's items is left out."""
    words = _WORD.findall(text.lower())
    return words[1:] if len(words) > 1 and re.match(r"\s*(?:\(?[0-9a-z]\)|[0-9]+[.)])\s", text.lower()) else words


class Book:
    """Sentences by their first two words, and rules."""

    def __init__(self, sentences: dict[str, str], rules: Sequence[Rule]) -> None:
        self.by_start: dict[tuple[str, ...], list[tuple[tuple[str, ...], str]]] = {}
        for name, text in sentences.items():
            words = tuple(normalised(text))
            self.by_start.setdefault(words[:2], []).append((words, name))
        for known in self.by_start.values():
            known.sort(key=lambda x: -len(x[0]))
        firsts = {re.escape(k[0]) for k in self.by_start}
        self.may_start = re.compile(rf"[\W_]*(?:\(?[0-9a-z][.)]\s[\W_]*)?(?:{'|'.join(sorted(firsts))})\b", re.IGNORECASE)
        self.rules = rules

    def sentences(self, text: str) -> list[tuple[str | None, int, int]]:
        """(identifier, start, end) of known sentences, with None for each unknown unit."""
        units = [(m.start(), m.end()) for m in _UNIT.finditer(text)]
        out: list[tuple[str | None, int, int]] = []
        at = 0
        while at < len(units):
            start, end = units[at]
            hit = self._known(text, units, at) if self.may_start.match(text, start, end) else None
            if hit is None:
                if text[start:end].strip():
                    out.append((None, start, end))
                at += 1
                continue
            name, last = hit
            lead = re.match(r"\s*", text[start:end]).end()
            stop = units[last][1]
            out.append((name, start + lead, stop))
            at = last + 1
        return out

    def _known(self, text: str, units: list[tuple[int, int]], at: int) -> tuple[str, int] | None:
        words: list[str] = []
        ends: list[tuple[int, int]] = []
        longest = None
        for last in range(at, len(units)):
            words += normalised(text[slice(*units[last])])
            ends.append((len(words), last))
            if longest is None and len(words) >= 2:
                if (known := self.by_start.get(tuple(words[:2]))) is None:
                    return None
                longest = len(known[0][0])
            if longest is not None and len(words) >= longest:
                break
        if longest is None:
            return None
        for sentence, name in known:
            for n, last in ends:
                if n == len(sentence) and tuple(words[:n]) == sentence:
                    return name, last
        return None

    def matches(self, text: str | None) -> list[tuple[str, str, int, int]]:
        """(licence, rule, start, end), by place."""
        found = self.sentences(text) if text else []
        if not any(name for name, _, _ in found):
            return []
        found = [x for x in found if x[0]]
        free = [name for name, _, _ in found]
        out = []
        for licence, rule, names in self.rules:
            if names[0] not in free:
                continue
            for at, name in enumerate(free):
                if name != names[0]:
                    continue
                places = [at]
                for nxt in range(at + 1, len(free)):
                    if len(places) == len(names) or free[nxt] == names[0]:
                        break
                    if free[nxt] == names[len(places)]:
                        places.append(nxt)
                if len(places) == len(names):
                    out.append((licence, rule, found[places[0]][1], found[places[-1]][2]))
                    for p in places:
                        free[p] = None
        return sorted(out, key=lambda m: m[2:])


BOOK = Book(SENTENCES, RULES)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", book: Book = BOOK) -> DataFrame:
    """One row for each document: id and matches, an array of (licence, rule, start, end)."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    fields = [("licence", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = [n for n, _ in fields]
        rows = [[dict(zip(names, m)) for m in book.matches(t)] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.struct(fields)))], names=["id", "matches"])

    return arrow_map(picked, each, f"id {kind}, matches array<struct<licence:string,rule:string,start:long,end:long>>").withColumnRenamed("id", id_col)


