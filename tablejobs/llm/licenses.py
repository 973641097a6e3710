"""License notices in documents, found by patience alignment with templates.

A template is a list of words. Where a document holds some of its telling words close together, that region is aligned
with the template: words that occur once in both are anchors, the longest increasing run of anchors is kept, and the
gaps between kept anchors are aligned the same way. The share of the template's words that end up aligned is its
coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablejobs.llm.common import ids_and_texts, slices

# Short notices by which texts are put under public licenses.
NOTICES = {
    "MIT": "Released under the MIT License",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "all-rights-reserved": "All rights reserved",
}
#: Share of a template's words that must be aligned.
COVERAGE = 0.8

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        at = bisect_left(tops, value)
        if at == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[at], piles[at] = value, i
        before[i] = piles[at - 1] if at else -1
    found = []
    i = piles[-1] if piles else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned places (text, template), increasing in both."""
    found: list[tuple[int, int]] = []
    stack = [(0, len(text), 0, len(template))]
    while stack:
        a, b, c, d = stack.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        once = {w for w, n in in_template.items() if n == 1 and in_text[w] == 1}
        if not once:
            continue
        place = {text[i]: i for i in range(a, b) if text[i] in once}
        anchors = [(place[template[j]], j) for j in range(c, d) if template[j] in once]
        kept = [anchors[k] for k in longest_increasing([i for i, _ in anchors])]
        found += kept
        for (i, j), (k, m) in zip([(a - 1, c - 1), *kept], [*kept, (b, d)]):
            stack.append((i + 1, k, j + 1, m))
    return sorted(found)


class Scanner:
    """Templates, and the words that tell them: those that fewest templates share."""

    def __init__(self, templates: Mapping[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = {name: words_of(text) for name, text in templates.items()}
        self.by_word: dict[str, list[str]] = {}
        for name, words in self.templates.items():
            for word in set(words):
                self.by_word.setdefault(word, []).append(name)

    def regions(self, words: list[str]) -> Iterator[tuple[str, int, int]]:
        """Where a template may lie: runs in which enough of its words occur within twice its length."""
        places: dict[str, list[int]] = {}
        for i, word in enumerate(words):
            for name in self.by_word.get(word, ()):
                places.setdefault(name, []).append(i)
        for name, found in places.items():
            size = len(self.templates[name])
            needed = self.coverage * size
            begin = 0
            while begin < len(found):
                stop = begin
                while stop + 1 < len(found) and found[stop + 1] - found[stop] <= max(2, size // 4):
                    stop += 1
                if stop - begin + 1 >= needed:
                    yield name, found[begin], found[stop] + 1
                begin = stop + 1

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, one behind the last) for every notice in the text."""
        words = words_of(text)
        found = []
        for name, begin, stop in self.regions(words):
            template = self.templates[name]
            while stop - begin >= self.coverage * len(template):  # a region may hold a notice several times
                window = words[begin : min(stop, begin + 2 * len(template))]
                pairs = align(window, template)
                if len(pairs) < self.coverage * len(template):
                    begin += 1 if not pairs else max(1, pairs[0][0])
                    continue
                found.append((name, len(pairs) / len(template), begin + pairs[0][0], begin + pairs[-1][0] + 1))
                begin += pairs[-1][0] + 1
        return sorted(found, key=lambda one: (one[2], one[0]))


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """Per notice found: id, license, coverage, first_word, end_word.

    Words are runs of letters and digits in lower case, with versions such as ``2.0`` whole; places count words of the
    text. Null and empty texts hold no notice, nor does a template without words match. A notice that a text holds
    several times gives a row for each; repeated rows repeat their results, a null id stays null. An empty table gives
    no rows. Further columns are not read. A text is scanned within its row, so no shuffle takes place.
    """
    source = ids_and_texts(docs, id_col, text_col)
    schema = T.StructType([source.schema["id"]]).add("license", "string").add("coverage", "double")
    schema = schema.add("first_word", "long").add("end_word", "long")
    scanner = Scanner({name: text for name, text in templates.items() if words_of(text)}, coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                row, found = [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    own = scanner.scan(text)
                    row += [i] * len(own)
                    found += own
                columns = list(zip(*found)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int32())),
                        pa.array(columns[0], pa.string()),
                        pa.array(columns[1], pa.float64()),
                        pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.int64()),
                    ],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)
