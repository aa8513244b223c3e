"""Licence recognition by sentences: known sentences become identifiers, identifier sequences are matched by rules.

A text is cut into pieces at line breaks and after ``.``, ``!`` or ``?`` before white space. Pieces are normalised (lower
case, runs of anything but letters and digits to one space, so comment marks and quotes vanish). From each piece on, the
longest run of pieces that together spell a known licence sentence is mapped to its identifier, so a sentence may be
wrapped over any number of lines or stand in a comment; a piece that begins none is unknown (0). A rule is an ordered
sequence of identifiers that names a licence; between two of them up to ``gap`` unknown pieces may stand, such as the
numbers of clauses. Longer rules are asked first and use up what they match, so the notice of a licence does not
also count as a shorter rule within it. Licences of ``weak`` rules are named only where no other one is.

Sentences and rules are data: both may be given by the caller. Texts are judged by themselves inside Spark's tasks, with
the two tables, whose size the caller knows, and nothing is shuffled.

Nulls and edges: a null or empty text has no pieces and no licence; a licence that matches more than once is named once;
rows with a repeated id stay separate; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

# Known licence sentences, with their identifiers.
SENTENCES = {
    1: "Released under the MIT License.",
    2: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    3: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    4: "Licensed under the Apache License, Version 2.0.",
    5: "You may not use this file except in compliance with the License.",
    6: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    7: "This work is licensed under the GNU General Public License, version 3.",
    8: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    9: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    10: "See the GNU General Public License for more details.",
    11: "Licensed under CC BY-NC 4.0.",
    12: "Licensed under CC BY 4.0.",
    13: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    14: "All rights reserved.",
    15: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    16: "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    17: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    18: "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    19: "See the License for the specific language governing permissions and limitations under the License.",
    20: "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    21: "You should have received a copy of the GNU General Public License along with this program.",
    22: "If not, see <https://www.gnu.org/licenses/>.",
    23: "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    24: "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    25: "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    26: "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    27: "See the GNU Lesser General Public License for more details.",
    28: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    29: "See the GNU Affero General Public License for more details.",
    30: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    31: "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    32: "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    33: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    34: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    35: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    36: "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    37: "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    38: "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    39: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    40: "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    41: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    42: "This is free and unencumbered software released into the public domain.",
    43: "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    44: "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    45: "This software is distributed without any warranty.",
    46: "You should have received a copy of the CC0 Public Domain Dedication along with this software.",
    47: "This software is provided 'as-is', without any express or implied warranty.",
    48: "In no event will the authors be held liable for any damages arising from the use of this software.",
    49: "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    50: "Distributed under the Boost Software License, Version 1.0.",
    51: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    52: "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    53: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    54: "Licensed under CC BY-SA 4.0.",
    55: "Licensed under the MIT License.",
    56: "This project is licensed under the MIT License.",
    57: "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    58: "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    59: "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    60: "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    61: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission of the copyright holder.",
}

# Short names of licences, whose tags `SPDX-License-Identifier: name` are sentences too, from 100 on.
TAGGED = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-2.0", "ISC", "0BSD", "Unlicense", "CC0-1.0", "Zlib", "BSL-1.0", "EPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0"]
SENTENCES |= {100 + i: f"SPDX-License-Identifier: {name}" for i, name in enumerate(TAGGED)}

# Rules as ordered identifiers.
RULES = [
    ("MIT", [2, 3, 15, 16]),
    ("MIT", [2, 3, 15]),
    ("MIT", [2, 3]),
    ("MIT", [1]),
    ("MIT", [55]),
    ("MIT", [56]),
    ("MIT", [58]),
    ("MIT-grant", [2]),
    ("Apache-2.0", [17, 6, 18, 19]),
    ("Apache-2.0", [17, 6, 18]),
    ("Apache-2.0", [17, 6]),
    ("Apache-2.0", [17]),
    ("Apache-2.0", [4, 5, 6, 18, 19]),
    ("Apache-2.0", [4, 5, 6]),
    ("Apache-2.0", [4, 5]),
    ("Apache-2.0", [4]),
    ("GPL-3.0-or-later", [8, 9, 10, 21, 22]),
    ("GPL-3.0-or-later", [8, 9, 10, 21]),
    ("GPL-3.0-or-later", [8, 9, 10]),
    ("GPL-3.0-or-later", [8, 9]),
    ("GPL-3.0-or-later", [8]),
    ("GPL-3.0-only", [7]),
    ("GPL-2.0-or-later", [20, 9, 10]),
    ("GPL-2.0-or-later", [20]),
    ("GPL-2.0-only", [23, 9, 10]),
    ("GPL-2.0-only", [23]),
    ("LGPL-2.1-or-later", [24, 26, 27]),
    ("LGPL-2.1-or-later", [24]),
    ("LGPL-3.0-or-later", [25, 26, 27]),
    ("LGPL-3.0-or-later", [25]),
    ("AGPL-3.0-or-later", [28, 9, 29]),
    ("AGPL-3.0-or-later", [28]),
    ("MPL-2.0", [30, 31]),
    ("MPL-2.0", [30, 32]),
    ("MPL-2.0", [30]),
    ("BSD-4-Clause", [13, 33, 34, 38]),
    ("BSD-3-Clause", [13, 33, 34, 35, 36, 37]),
    ("BSD-3-Clause", [13, 33, 34, 35]),
    ("BSD-3-Clause", [13, 33, 34, 61]),
    ("BSD-2-Clause", [13, 33, 34, 36, 37]),
    ("BSD-2-Clause", [13, 33, 34]),
    ("BSD", [13]),
    ("BSD", [57]),
    ("ISC", [39, 40]),
    ("ISC", [39]),
    ("ISC", [60, 40]),
    ("ISC", [60]),
    ("0BSD", [41, 40]),
    ("0BSD", [41]),
    ("Unlicense", [42, 43]),
    ("Unlicense", [42]),
    ("CC0-1.0", [44, 45, 46]),
    ("CC0-1.0", [44]),
    ("Zlib", [47, 48, 49]),
    ("Zlib", [49]),
    ("BSL-1.0", [50]),
    ("EPL-2.0", [59]),
    ("CC-BY-NC-4.0", [11]),
    ("CC-BY-NC-4.0", [53]),
    ("CC-BY-SA-4.0", [54]),
    ("CC-BY-SA-4.0", [52]),
    ("CC-BY-4.0", [12]),
    ("CC-BY-4.0", [51]),
    ("proprietary", [14]),
    *((name, [100 + i]) for i, name in enumerate(TAGGED)),
]

# Licences that notices of others also seem to claim.
WEAK = {"proprietary"}

BREAK = r"[.!?]+\s|\n"
WORD = re.compile("[a-z0-9]+")
GAP = 6


def normal(sentence: str) -> str:
    return " ".join(WORD.findall(sentence.lower()))


def in_order(rules: list) -> list:
    """Rules as they are asked: longer ones first."""
    return sorted(rules, key=lambda r: (-len(r[1]), r[1]))


class Recogniser:
    def __init__(self, sentences: dict[int, str], rules: list, weak: set[str], gap: int):
        self.first: dict = {}  # a word to the words that may follow it; under "" the sentence that ends there
        for number, sentence in sentences.items():
            node = self.first
            for word in normal(sentence).split():
                node = node.setdefault(word, {})
            node[""] = number
        self.rules, self.weak, self.gap, self.cut = in_order(rules), weak, gap, re.compile(BREAK)

    def sentences(self, text: str | None) -> tuple[int, list[int], list[int]]:
        """How many pieces there are, the known sentences in order, and how many unknown pieces stand before each."""
        pieces = [x for x in self.cut.split(text.lower()) if x.strip(" ")] if text else []
        first, search, ids, unknown, at, since = self.first.get, WORD.search, [], [], 0, 0
        while at < len(pieces):
            word = search(pieces[at])
            if word is not None and first(word.group()) is not None:
                found, end = self._longest(pieces, at)
                if found is not None:
                    ids.append(found)
                    unknown.append(since)
                    at, since = end, 0
                    continue
            at += 1
            since += 1
        return len(pieces), ids, unknown

    def _longest(self, pieces: list[str], at: int) -> tuple[int | None, int]:
        node, found, end = self.first, None, at
        while at < len(pieces):
            words = WORD.findall(pieces[at])
            for word in words:
                node = node.get(word)
                if node is None:
                    return found, end
            at += 1
            if words and "" in node:
                found, end = node[""], at
        return found, end

    def licences(self, ids: list[int], unknown: list[int]) -> list[str]:
        left, names = list(ids), set()
        for name, rule in self.rules:
            for at in range(len(left) - len(rule) + 1):
                span = range(at, at + len(rule))
                if left[at] == rule[0] and [left[k] for k in span] == rule and all(unknown[k] <= self.gap for k in span[1:]):
                    names.add(name)
                    for k in span:
                        left[k] = 0
        return sorted(names - self.weak or names)


def scan(docs: DataFrame, sentences: dict[int, str] | None = None, rules: list | None = None, weak: set[str] | None = None, gap: int = GAP) -> DataFrame:
    """(doc_id, n_sentences: pieces of the text, n_known, sentence_ids array<int>, licenses array<string> sorted) of docs (doc_id, text)."""
    recogniser = Recogniser(SENTENCES if sentences is None else sentences, RULES if rules is None else rules, WEAK if weak is None else weak, gap)
    kinds = {"n_sentences": pa.int64(), "n_known": pa.int64(), "sentence_ids": pa.list_(pa.int32()), "licenses": pa.list_(pa.string())}

    def scanned(batches):
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                n, ids, unknown = recogniser.sentences(text)
                rows.append((n, len(ids), ids, recogniser.licences(ids, unknown) if ids else []))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds.values()))], names=["doc_id", *kinds])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scanned, f"doc_id {id_type}, n_sentences long, n_known long, sentence_ids array<int>, licenses array<string>")
