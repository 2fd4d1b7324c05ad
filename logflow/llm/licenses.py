"""License scans: patience alignment of texts with license templates."""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logflow.session import ship_package

# Public license notices and the operative parts of short licenses, by name.  What stands in braces tells
# licenses apart (name, version, kind): a text must have those words one after another.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
        is hereby granted, {provided that the above copyright notice} and this permission notice appear in all
        copies.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. {Neither the name} of the copyright
        holder nor the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission.""",
    "Apache-2.0-header": """Licensed under the {Apache License, Version 2.0} (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}. If a copy
        of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "MIT-notice": "Released under the {MIT License}.",
    "BSD-notice": "Released under the {BSD License}.",
    "Apache-2.0-notice": "Licensed under the {Apache License, Version 2.0}.",
    "MPL-2.0-notice": "Licensed under the {Mozilla Public License, Version 2.0}.",
}
FAMILY = {"GPL": "GNU General", "LGPL": "GNU Lesser General", "AGPL": "GNU Affero General"}
VERSIONS = [("GPL", "2"), ("GPL", "3"), ("LGPL", "2.1"), ("LGPL", "3"), ("AGPL", "3")]
for _kind, _version in VERSIONS:
    _name = f"{_kind}-{_version if '.' in _version else _version + '.0'}"
    TEMPLATES[f"{_name}-header"] = f"""This program is free software: you can redistribute it and/or modify it under the
        terms of the {{{FAMILY[_kind]} Public License}} as published by the Free Software Foundation, either
        {{version {_version}}} of the License, or (at your option) any later version."""
    TEMPLATES[f"{_name}-notice"] = (
        f"This work is licensed under the {{{FAMILY[_kind]} Public License, version {_version}}}."
    )
COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _kind, _long in COMMONS.items():
    TEMPLATES[f"CC-{_kind}-4.0-notice"] = f"Licensed under {{CC {_kind} 4.0}}."
    TEMPLATES[f"CC-{_kind}-4.0-deed"] = (
        f"This work is licensed under a {{Creative Commons {_long} 4.0}} International License."
    )

EDGES = "\"'`.,;:!?()[]{}<>*#%&$~_-/\\|«»“”‘’…"

SCAN = "doc_id long, license string, coverage double, matched_words int, template_words int, first_word int, last_word int"


def words_of(text: str | None) -> list[str]:
    """Lower-case words without punctuation around them; a word of punctuation alone is an empty one."""
    return [w.strip(EDGES) for w in (text or "").lower().split()]


def template_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words of a template and the stretches of them that stood in braces."""
    words, fixed = [], []
    for i, part in enumerate(re.split("[{}]", text)):
        some = [w for w in words_of(part) if w]
        if i % 2 and some:
            fixed.append((len(words), len(words) + len(some)))
        words += some
    return words, fixed


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence of different values."""
    tails, ends, before = [], [], []
    for i, v in enumerate(values):
        at = bisect_left(tails, v)
        before.append(ends[at - 1] if at else -1)
        tails[at : at + 1], ends[at : at + 1] = [v], [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment: increasing pairs of positions of equal words.

    In each gap, equal words at both ends are matched first; then words that occur once in either side anchor
    the longest run in the same order, and the gaps between anchors are aligned in turn.
    """
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        once = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if w in place and in_a[w] == 1]
        anchors = [once[k] for k in longest_increasing([j for _, j in once])]
        out += anchors
        if anchors:
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:], strict=False)]
    return sorted(out)


def overlaps(ids: np.ndarray, most: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words, how many it has of a template's, of each word at most ``most[id]``."""
    own = np.flatnonzero(most[ids])
    own = own[np.argsort(ids[own], kind="stable")]
    word = ids[own]
    # A place counts in windows that start after the place of the same word ``most`` occurrences before it.
    back = np.arange(len(own)) - most[word]
    same = back >= np.searchsorted(word, word)
    first = np.maximum(np.where(same, own[np.maximum(back, 0)] + 1, 0), own - size + 1)
    last = np.minimum(own, len(ids) - size)
    use = first <= last
    change = np.bincount(first[use], minlength=len(ids) + 2) - np.bincount(last[use] + 1, minlength=len(ids) + 2)
    return np.cumsum(change)[: len(ids) - size + 1]


def common_length(words: list[str], places: Mapping[str, int], length: int) -> int:
    """Length of the longest common subsequence with a template, ``places`` being each of its words' places as bits."""
    full = (1 << length) - 1
    left = full
    for word in words:
        if both := left & places.get(word, 0):
            left = ((left + both) | (left - both)) & full
    return length - left.bit_count()


class Scanner:
    """Finds templates in texts; the words of all templates are numbered once."""

    def __init__(self, templates: Mapping[str, str], least: float, stretch: float) -> None:
        self.templates, self.fixed = {}, {}
        for name, t in templates.items():
            self.templates[name], self.fixed[name] = template_of(t)
        vocabulary = sorted({w for t in self.templates.values() for w in t})
        self.number = {w: i for i, w in enumerate(vocabulary)}
        self.least, self.stretch = least, stretch
        self.most, self.places = {}, {}
        for name, t in self.templates.items():
            self.most[name] = np.bincount([self.number[w] for w in t], minlength=len(vocabulary) + 1)
            self.places[name] = {w: sum(1 << j for j, x in enumerate(t) if x == w) for w in t}

    def possible(self, ids: np.ndarray, name: str, size: int) -> np.ndarray:
        """The starts of windows that hold all the template's fixed stretches."""
        ok = np.ones(len(ids), bool)
        for a, b in self.fixed[name]:
            length = b - a
            here = np.ones(max(0, len(ids) - length + 1), bool)
            for k, word in enumerate(self.templates[name][a:b]):
                here &= ids[k : k + len(here)] == self.number[word]
            upto = np.concatenate([[0], np.cumsum(here)])
            start = np.arange(len(ids))
            end = np.clip(start + size - length + 1, 0, len(here))
            ok &= upto[end] > upto[np.minimum(start, len(here))]
        return ok

    def whole(self, pairs: list[tuple[int, int]], name: str) -> bool:
        """Whether the fixed stretches are aligned to words that follow each other."""
        at = {j: i for i, j in pairs}
        return all(
            a in at and all(at.get(j) == at[a] + j - a for j in range(a, b)) for a, b in self.fixed[name]
        )

    def find(self, words: list[str], ids: np.ndarray, name: str, size: int) -> Iterator[tuple[int, int, int]]:
        """Matched words, first and last word of all places of a template, the best first, of equal ones the first.

        A window is ``size`` words, or fewer before the next place found and at the end.  Windows wait in the order
        of an upper bound: first shared words, then the longest common subsequence, then the alignment itself.  The
        subsequence changes by at most one from a window to its neighbour, which rules out windows around as well.
        """
        template, places = self.templates[name], self.places[name]
        target = math.ceil(self.least * len(template))
        bounds = overlaps(np.concatenate([ids, np.full(size - 1, -1)]), self.most[name], size)
        full = np.flatnonzero((bounds >= target) & self.possible(ids, name, size))
        waiting = [(-int(bounds[s]), int(s), 0, 0, ()) for s in full]
        heapq.heapify(waiting)
        out, firsts, lasts = np.zeros(len(words), bool), [], []
        while waiting:
            value, start, state, seen_end, pairs = heapq.heappop(waiting)
            after = bisect_right(firsts, start)
            if out[start] or after and lasts[after - 1] >= start:
                continue
            end = min(start + size, len(words), *firsts[after : after + 1])
            if state == 2 and seen_end == end:
                first, last = start + pairs[0][0], start + pairs[-1][0]
                insort(firsts, first)
                insort(lasts, last)
                yield -value, first, last
                continue
            window = words[start:end]
            if state == 0 or seen_end != end:
                length = common_length(window, places, len(template)) if len(window) >= target else len(window)
                if short := max(0, target - length):
                    out[max(0, start - short + 1) : min(start + short, end)] = True
                    continue
                if length < -value:
                    heapq.heappush(waiting, (-length, start, 1, end, ()))
                    continue
            pairs = align(window, template)
            if len(pairs) >= target and self.whole(pairs, name):
                heapq.heappush(waiting, (-len(pairs), start, 2, end, pairs))

    def scan(self, text: str | None) -> Iterator[tuple[str, float, int, int, int, int]]:
        """Name, coverage, matched words, template words, first and last word of each place, in order of place.

        Of places that overlap the one with most matched words stays, of equal ones that of greater coverage, then
        the first, then the one whose name sorts first.
        """
        words = words_of(text)
        ids = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        found = []
        for name, template in self.templates.items():
            need = self.least * len(template)
            hits = self.most[name][ids] > 0
            if not len(words) or hits.sum() < need:
                continue
            size = int(len(template) * self.stretch) + 2
            sums = np.concatenate([[0], np.cumsum(hits)])
            width = min(size, len(words))
            if (sums[width:] - sums[:-width]).max() < need:
                continue
            for n, first, last in self.find(words, ids, name, size):
                found.append((-n, -n / len(template), first, name, last))
        firsts, lasts, kept = [], [], []
        for minus, share, first, name, last in sorted(found):
            before = bisect_right(firsts, last)
            if before and lasts[before - 1] >= first:
                continue
            insort(firsts, first)
            insort(lasts, last)
            kept.append((name, -share, -minus, len(self.templates[name]), first, last))
        yield from sorted(kept, key=lambda place: place[4])


def scan_licenses(
    documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = 0.8, stretch: float = 1.5
) -> DataFrame:
    """One row for each place of a document where at least ``least`` of a template's words align: SCAN's columns.

    A template is looked for in all windows of ``stretch`` times its length (and two words).  The words that it has in
    braces must all be there, one after another.  Of one template's windows the best gives a place, of equal ones the
    first; then the words outside it are searched again, so that repeated notices give a place each.  Where several
    templates claim overlapping places, the one with most matched words keeps it.  Words are compared in lower case
    without the punctuation around them.

    Null and empty texts have no rows; repeated documents have repeated rows; other columns are ignored.  The
    templates are a small fixed set and go to every task.
    """
    ship_package(documents.sparkSession)
    names = [c.split()[0] for c in SCAN.split(", ")]
    types = [pa.int64(), pa.string(), pa.float64(), *[pa.int32()] * 4]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least, stretch)
        for batch in batches:
            rows = [
                (doc_id, *found)
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)
                for found in scanner.scan(text.as_py())
            ]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return documents.select("doc_id", "text").mapInArrow(work, SCAN)
