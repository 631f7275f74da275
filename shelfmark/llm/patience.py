"""Licence scan: patience alignment of texts with licence templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

# Notices of common licences, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose "
    "with or without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
}

_NO_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
    "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, "
    "OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_3 = _BSD_2 + (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission. "
)


def _gnu(program: str, version: str, later: bool) -> str:
    """The usual header of a GNU licence."""
    which = (
        f"either version {version} of the License, or (at your option) any later version."
        if later
        else f"version {version} of the License."
    )
    return (
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        f"the GNU {program} as published by the Free Software Foundation; {which} This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        f"{program} for more details."
    )


# The usual permission texts and file headers, by SPDX identifier.
TEXTS = {
    "AGPL-3.0-only": [_gnu("Affero General Public License", "3", False)],
    "AGPL-3.0-or-later": [_gnu("Affero General Public License", "3", True)],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ],
    "BSD-2-Clause": [_BSD_2 + _NO_WARRANTY],
    "BSD-3-Clause": [_BSD_3 + _NO_WARRANTY],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file "
        "LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ],
    "CC-BY-NC-ND-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
        "International License."
    ],
    "CC-BY-NC-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
        "International License."
    ],
    "CC-BY-ND-4.0": [
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."
    ],
    "CC-BY-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ],
    "GPL-2.0-only": [_gnu("General Public License", "2", False)],
    "GPL-2.0-or-later": [_gnu("General Public License", "2", True)],
    "GPL-3.0-only": [_gnu("General Public License", "3", False)],
    "GPL-3.0-or-later": [_gnu("General Public License", "3", True)],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ],
    "LGPL-2.1-only": [_gnu("Lesser General Public License", "2.1", False)],
    "LGPL-2.1-or-later": [_gnu("Lesser General Public License", "2.1", True)],
    "LGPL-3.0-only": [_gnu("Lesser General Public License", "3", False)],
    "LGPL-3.0-or-later": [_gnu("Lesser General Public License", "3", True)],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will "
        "the authors be held liable for any damages arising from the use of this software. Permission "
        "is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely, subject to the following restrictions:"
    ],
}
LICENSES = {n: [*([TEMPLATES[n]] if n in TEMPLATES else []), *TEXTS.get(n, [])] for n in sorted({*TEMPLATES, *TEXTS})}

# ``SPDX-License-Identifier:`` and the licence expression behind it.
_ID = r"(?:\([ \t]*)*[A-Za-z0-9][A-Za-z0-9.+-]*(?:[ \t]*\))*"
_SPDX = re.compile(
    rf"SPDX-License-Identifier:[ \t]*({_ID}(?:[ \t]+(?:AND|OR|WITH|and|or|with)[ \t]+{_ID})*)"
)


def declared(text: str) -> list[tuple[str, int, int]]:
    """Identifier, first word and end word of all licences in SPDX lines; not of exceptions."""
    known = {n.lower(): n for n in LICENSES}
    out = []
    done = words = 0  # words up to ``done``
    for line in _SPDX.finditer(text):
        words += len(words_of(text[done : line.start()]))
        done = line.end()
        size = len(words_of(line[0]))
        before = ""
        for part in re.findall(r"[A-Za-z0-9][A-Za-z0-9.+-]*", line[1]):
            name = part.rstrip(".-")
            if name.upper() not in ("AND", "OR", "WITH") and before.upper() != "WITH":
                out.append((known.get(name.lower(), name), words, words + size))
            before = name
        words += size
    return out


# Letters, digits, and what ties version numbers and names together; ASCII is enough here.
_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 or c == 45 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k] = v
            piles[k] = i
        below[i] = piles[k - 1] if k else -1
    out = []
    i = piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Matched (text position, template position) pairs, both increasing.

    What a stretch has in common at either end is matched; then words that occur once in
    both stretches are anchors, a longest increasing run of them is matched, and the gaps
    between are aligned in the same way.
    """
    matched: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
        if a >= b or c >= d:
            continue
        wanted = {w: i for i, w in zip(range(c, d), template[c:d], strict=True)}
        once = Counter(template[c:d])
        here = Counter(w for w in text[a:b] if w in once)
        anchors = [
            (i, wanted[w])
            for i, w in zip(range(a, b), text[a:b], strict=True)
            if here.get(w) == 1 and once[w] == 1
        ]
        keep = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        matched += keep
        if keep:
            edges = [(a - 1, c - 1), *keep, (b, d)]
            todo += [
                (x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:], strict=False)
            ]
    return sorted(matched)


class Scanner:
    """Finds the templates that a text holds to at least ``floor`` of their words.

    A word of the text counts for one template only: copies that match more words take theirs
    first, and what is left of a copy must still reach the floor. Where a template has a
    sibling that differs in few words, a copy must have most of those words, so that a notice
    of one version is never taken for another.
    """

    def __init__(self, templates: Mapping[str, str | Sequence[str]], floor: float):
        self.floor = floor
        self.templates = [
            (name, words_of(t))
            for name, forms in templates.items()
            for t in ([forms] if isinstance(forms, str) else forms)
        ]
        self.counts = [Counter(t) for _, t in self.templates]
        self.users: dict[bytes, list[tuple[int, int]]] = {}
        for k, counts in enumerate(self.counts):
            for w, n in counts.items():
                self.users.setdefault(w, []).append((k, n))
        # fewest words that are enough
        self.needed = [
            next((n for n in range(len(t) + 1) if self._enough(n, t)), 0) if t else 0 for _, t in self.templates
        ]
        self.telling = [self._telling(k) for k in range(len(self.templates))]

    def _enough(self, n: int, template: list[bytes]) -> bool:
        return n / len(template) >= self.floor

    def _telling(self, k: int) -> list[set[int]]:
        """For each sibling of a template, the places in which the template differs from it."""
        name, template = self.templates[k]
        out = []
        for (other, words), counts in zip(self.templates, self.counts, strict=True):
            if other == name or not template:
                continue
            if self._enough((self.counts[k] & counts).total(), template):
                same = align(words, template)
                if self._enough(len(same), template) and len(same) < len(template):
                    out.append(set(range(len(template))) - {j for _, j in same})
        return out

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(name, coverage, first word, end word) of the best match of each template found."""
        words = words_of(text)
        at: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.users:
                at.setdefault(w, []).append(i)
        # no alignment can cover more than the words that are there at all
        most = [0] * len(self.templates)
        for w, spots in at.items():
            for k, n in self.users[w]:
                most[k] += min(n, len(spots))
        copies = []
        for k, (name, template) in enumerate(self.templates):
            if not template or not self._enough(most[k], template):
                continue
            for pairs in self._copies(words, k, at):
                places = {j for _, j in pairs}
                if self._enough(len(pairs), template) and all(
                    2 * len(places & t) > len(t) for t in self.telling[k]
                ):
                    spots = [i for i, _ in pairs]
                    copies.append((-len(pairs), spots[0], spots[-1], name, len(template), spots))
        taken: set[int] = set()
        best: dict[str, tuple[float, int, int]] = {}
        for name, first, end in declared(text or ""):
            best.setdefault(name, (1.0, first, end))
        for _, first, last, name, size, spots in sorted(copies):
            if sum(i not in taken for i in spots) / size < self.floor:
                continue
            taken.update(spots)
            got = (len(spots) / size, first, last + 1)
            if name not in best or (-got[0], got[1]) < (-best[name][0], best[name][1]):
                best[name] = got
        return [(name, *got) for name, got in best.items()]

    def _copies(self, words: list, k: int, at: dict) -> Iterator[list[tuple[int, int]]]:
        """Alignments of a template with every stretch of the text that may hold a copy.

        Only words of the template matter, so foreign words in a copy, however many, change
        nothing. A stretch may hold a copy if it has enough of the template's words in the
        template's order. Each such stretch is taken as it ends first and starts last; then it
        grows, up to its neighbours, as long as that adds words. Of the stretches of a copy
        that add up to one number of words each, the one that aligns best counts.
        """
        template, counts = self.templates[k][1], self.counts[k]
        size, need = len(template), self.needed[k]
        spots = sorted(i for w in counts for i in at.get(w, ()))
        found = [words[i] for i in spots]
        ahead, back = _masks(template), _masks(template[::-1])

        def grown(masks: dict, places: range) -> list[int]:
            """For 1, 2, ... words in order the place at which so many are there first."""
            out: list[int] = []
            for i, held in zip(places, _in_order(masks, size, (found[i] for i in places)), strict=True):
                if held > len(out):
                    out.append(i)
            return out

        tight = []
        start = 0
        while start < len(found):
            end = None
            for i, held in enumerate(_in_order(ahead, size, found[start:]), start):
                if held >= need:
                    end = i
                    break
            if end is None:
                break
            tight.append((grown(back, range(end, start - 1, -1))[need - 1], end))
            start = end + 1
        low = 0
        for n, (first, _) in enumerate(tight):
            high = tight[n + 1][0] if n + 1 < len(tight) else len(found)
            last = grown(ahead, range(first, high))[-1]
            starts = grown(back, range(last, low - 1, -1))
            best: list[tuple[int, int]] = []
            for held in range(len(starts), need - 1, -1):
                if len(best) >= held:
                    break
                a = starts[held - 1]
                ends = grown(ahead, range(a, last + 1))
                pairs = align(found[a : ends[held - 1] + 1], template) if len(ends) >= held else []
                if len(pairs) > len(best):
                    best = [(a + i, j) for i, j in pairs]
            low = last + 1
            if len(best) >= need:
                yield [(spots[i], j) for i, j in best]


def _masks(template: list[bytes]) -> dict[bytes, int]:
    """For each word, the places of a template that hold it, as bits."""
    out: dict[bytes, int] = {}
    for j, w in enumerate(template):
        out[w] = out.get(w, 0) | 1 << j
    return out


def _in_order(masks: dict[bytes, int], size: int, words: Iterable[bytes]) -> Iterator[int]:
    """After each word, how many words of a template have been there in its order.

    The number is that of zeros in a row of bits which one addition a word brings up to date.
    """
    full = (1 << size) - 1
    row = full
    for w in words:
        hit = row & masks[w]
        row = (row + hit | row - hit) & full
        yield size - row.bit_count()


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, str | Sequence[str]] = LICENSES,
    floor: float = 0.9,
) -> DataFrame:
    """Licence notices in whole texts: id and ``licenses``, sorted by name.

    Each entry has ``name``, ``coverage`` (share of the template's words that align, at least
    ``floor``), and the words [``first``, ``end``) between which they lie. Of several
    occurrences the one that covers most counts, then the first. Words of the text count for
    the template that matches most of them, and versions are told apart: see :class:`Scanner`.
    Any number of foreign words may stand in a copy. Work and memory grow with the words of a
    text that some template has.
    A name may have several templates. Licences declared by ``SPDX-License-Identifier`` lines
    are entries of coverage 1, whether or not there is a template. A null, empty or clean text
    has an empty list. Repeated rows and null ids stay rows of their own; other columns are
    ignored; an empty table gives no rows. One pass, no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    entry = pa.struct(
        [("name", pa.string()), ("coverage", pa.float64()), ("first", pa.int64()), ("end", pa.int64())]
    )

    def run(batches):
        scanner = Scanner(templates, floor)
        for batch in batches:
            found = [
                [dict(zip(("name", "coverage", "first", "end"), f, strict=True)) for f in sorted(scanner.scan(t.as_py()))]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, type=pa.list_(entry))], names=[id_col, "licenses"]
            )

    return docs.select(id_col, text_col).mapInArrow(
        run,
        f"`{id_col}` {kind}, licenses array<struct<name: string, coverage: double, first: bigint, end: bigint>>",
    )
