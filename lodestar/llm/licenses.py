"""License scan by patience alignment.

A text is compared with license templates.  Words that occur once in both are
anchors; the longest increasing subsequence of their positions is kept, and
the gaps between them are aligned in the same way, down to gaps without common
unique words (equal words next to a gap's ends are taken first).  A template's
coverage is the share of its words that the alignment matches.

A template is looked for wherever a stretch of twice its length holds enough
of its distinct words, which no stretch with the wanted coverage misses.
Overlapping stretches are one place.  Where copies stand close together, a
place holds every word several times and has no anchors, so its stretches of
twice the template's length are aligned as well, by a longest common
subsequence, and the best alignment counts.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of a template's words that must be matched.
COVERAGE = 0.8

# Public license notices and texts.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        https://www.gnu.org/licenses/.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions""",
}

_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def words_of(text: str) -> list[str]:
    """Lower-cased words without surrounding punctuation."""
    return _WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    piles: list[int] = []  # smallest last value of a subsequence of each length
    tops: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        at = bisect_left(piles, v)
        before.append(tops[at - 1] if at else -1)
        if at == len(piles):
            piles.append(v)
            tops.append(i)
        else:
            piles[at], tops[at] = v, i
    out, i = [], tops[-1] if tops else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions of ``a`` and ``b``, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, at, to = todo.pop()
        while lo < hi and at < to and a[lo] == b[at]:
            out.append((lo, at))
            lo, at = lo + 1, at + 1
        while lo < hi and at < to and a[hi - 1] == b[to - 1]:
            hi, to = hi - 1, to - 1
            out.append((hi, to))
        if lo == hi or at == to:
            continue
        in_a, in_b = Counter(a[lo:hi]), Counter(b[at:to])
        place = {w: j for j, w in enumerate(b[at:to], at) if in_b[w] == 1}
        anchors = [(i, place[a[i]]) for i in range(lo, hi) if in_a[a[i]] == 1 and a[i] in place]
        chain = [anchors[k] for k in increasing([j for _, j in anchors])]
        out += chain
        for (i, j), (i2, j2) in zip([(lo - 1, at - 1), *chain], [*chain, (hi, to)]):
            if chain and i + 1 < i2 and j + 1 < j2:
                todo.append((i + 1, i2, j + 1, j2))
    return sorted(out)


def exact(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions of a longest common subsequence, for short stretches."""
    rest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]  # longest of a[i:] and b[j:]
    for i in range(len(a) - 1, -1, -1):
        row, below = rest[i], rest[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i] == b[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif rest[i + 1][j] >= rest[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, words_of(text)
        self.vocabulary = frozenset(self.words)
        self.bits: dict[str, int] = {}
        for j, w in enumerate(self.words):
            self.bits[w] = self.bits.get(w, 0) | 1 << j

    def common(self, words: list[str]) -> int:
        """Length of the longest common subsequence with the template, by bit vectors."""
        full = (1 << len(self.words)) - 1
        v = full
        for w in words:
            m = self.bits.get(w)
            if m is not None:
                u = v & m
                v = (v + u | v - u) & full
        return len(self.words) - v.bit_count()

    def densest(self, at: list[int], words: list[str], lo: int, hi: int, least: int) -> tuple[int, int] | None:
        """The first stretch of twice the template's length in ``words[lo:hi]`` with the longest common subsequence, if longer than ``least``.

        Blocks of three lengths, one length apart, hold every such stretch; only those that can beat the best are searched.
        """
        n = len(self.words)
        best = None
        for block in range(lo, hi, n):
            if self.common(words[block:min(block + 3 * n, hi)]) <= least:
                continue
            for p in at[bisect_left(at, block):bisect_left(at, block + n)]:
                got = self.common(words[p:min(p + 2 * n, hi)])
                if got > least:
                    best, least = (p, min(p + 2 * n, hi)), got
        return best

    def places(self, at: list[int], words: list[str], coverage: float) -> list[tuple[int, int]]:
        """Stretches of twice the template's length that hold enough of its distinct words; ``at``: where those occur."""
        need = len(self.vocabulary) - int((1 - coverage) * len(self.words) + 1e-9)
        reach = 2 * len(self.words)
        found: list[tuple[int, int]] = []
        inside: Counter = Counter()
        left = 0
        best = None
        for right, p in enumerate(at):
            inside[words[p]] += 1
            while p - at[left] >= reach:
                w = words[at[left]]
                inside[w] -= 1
                if not inside[w]:
                    del inside[w]
                left += 1
            if len(inside) >= need:
                if best is not None and at[left] < best[1]:
                    best = (best[0], p + 1)
                else:
                    if best is not None:
                        found.append(best)
                    best = (at[left], p + 1)
        return [*found, best] if best is not None else found


_TEMPLATES = [Template(n, t) for n, t in TEMPLATES.items()]
_ALL_WORDS = frozenset().union(*(t.vocabulary for t in _TEMPLATES))


def scan(text: str | None, coverage: float = COVERAGE) -> list[tuple[float, int, str, int, int]]:
    """Licenses found: (coverage, matched words, name, first word, last word), best first; longer templates win ties."""
    words = words_of(text or "")
    hits = [i for i, w in enumerate(words) if w in _ALL_WORDS]
    present = {words[i] for i in hits}
    out = []
    for t in _TEMPLATES:
        if len(present & t.vocabulary) < len(t.vocabulary) - int((1 - coverage) * len(t.words) + 1e-9):
            continue
        best = None
        at = [i for i in hits if words[i] in t.vocabulary]
        for lo, hi in t.places(at, words, coverage):
            if best is not None and best[0] == len(t.words):
                break
            got = align(words[lo:hi], t.words)
            whole = (len(got), lo + got[0][0], lo + got[-1][0]) if got else None
            if hi - lo <= 2 * len(t.words) and whole is not None and (best is None or whole[0] > best[0]):
                best = whole
            stretch = t.densest(at, words, lo, hi, max(best[0] if best is not None else 0, math.ceil(coverage * len(t.words) - 1e-9) - 1))
            if stretch is not None:
                got = exact(words[stretch[0]:stretch[1]], t.words)
                best = (len(got), stretch[0] + got[0][0], stretch[0] + got[-1][0])
            if whole is not None and (best is None or whole[0] > best[0]):
                best = whole
        if best is not None and best[0] >= coverage * len(t.words) - 1e-9:
            out.append((best[0] / len(t.words), best[0], t.name, best[1], best[2]))
    return sorted(out, key=lambda r: (-r[1], -r[0], r[2]))


def _scan(coverage: float):
    def run(batches):
        for b in batches:
            found = [scan(t.as_py(), coverage) for t in b.column(1)]
            top = [f[0] if f else (0.0, 0, None, None, None) for f in found]
            yield pa.record_batch({
                "doc_id": b.column(0), "license": pa.array([t[2] for t in top], pa.string()), "coverage": pa.array([t[0] for t in top], pa.float64()),
                "matched_words": pa.array([t[1] for t in top], pa.int64()), "first_word": pa.array([t[3] for t in top], pa.int64()),
                "last_word": pa.array([t[4] for t in top], pa.int64()),
                "licenses": pa.array([sorted(r[2] for r in f) for f in found], pa.list_(pa.string()))})
    return run


def scan_documents(docs: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, license, coverage, matched_words, first_word, last_word, licenses)``, one row per row of ``docs``.

    ``license`` is the template with the most matched words among those
    covered enough (ties: better coverage, then name), null if there is none;
    then ``coverage`` and ``matched_words`` are 0 and ``licenses`` is empty.
    Null and empty texts have none.  Null and repeated ids are passed on.
    Only ``doc_id`` and ``text`` are read.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_scan(coverage), "doc_id long, license string, coverage double, matched_words long, first_word long, last_word long, licenses array<string>")
