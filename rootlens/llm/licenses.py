"""License scan by patience alignment of texts with license templates.

Words are runs of ASCII letters and digits in lower case, or of other characters'
bytes. A template is compared with windows of the text twice as long as the
template, one from each word of the text that the template holds, so that a notice
is found alike wherever it stands, and more than once. Words that a window and the
template both hold exactly once are the anchors; the longest increasing run of
anchors is kept, and each gap between two of them is aligned in the same way, after
the equal words next to its anchors. At both ends the alignment goes on, over the
window's edges too, while a further word of it stands within a template's length.
Coverage is the share of the template's words that are aligned. So a notice counts
if twice its template's length of text somewhere holds the least coverage.

A window is skipped only if it cannot do better: by the words it shares with the
template, whatever their order, or by their longest common subsequence. Spark deals
out the documents and nothing is shuffled; the templates are a fixed list.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rootlens.llm import textops as tx
from rootlens.llm.frames import small_batches

MIN_COVERAGE = 0.8
SLICE_BYTES = 1 << 21

# Public license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
}

_BLANK = np.ones(256, bool)
_BLANK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by document) of the words."""
    low = tx.LOWER[data]
    starts, ends, woff = tx.words(low, off, _BLANK)
    return tx.hash_words(low, starts, ends), woff


def increasing(values: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence of distinct values, by piles."""
    tops: list[int] = []
    at_top: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        pile = bisect.bisect_left(tops, v)
        before.append(at_top[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at_top.append(i)
        else:
            tops[pile], at_top[pile] = v, i
    out, i = [], at_top[-1] if at_top else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def common(text: list[int], places: dict[int, int], size: int) -> int:
    """Words of a longest common subsequence with a template of ``size`` words; no alignment
    has more. ``places`` has a bit for each place of a word in the template."""
    every = (1 << size) - 1
    free = every
    for word in text:
        met = free & places[word]
        free = ((free + met) | (free - met)) & every
    return size - free.bit_count()


def align(text: list[int], template: list[int], left: bool = False, right: bool = False) -> list[tuple[int, int]]:
    """Pairs (index in text, index in template) of aligned words, rising in both; ``left`` and
    ``right`` tell whether an aligned word stands next to that end of both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template), left, right)]
    while gaps:
        a, b, c, d, left, right = gaps.pop()
        # equal words next to an anchor belong to it
        while left and a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while right and a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        where = {w: j for j, w in enumerate(template[c:d], c) if in_template[w] == 1}
        shared = [(i, where[w]) for i, w in enumerate(text[a:b], a) if in_text[w] == 1 and w in where]
        anchors = [shared[k] for k in increasing([j for _, j in shared])]
        if not anchors:
            continue
        out += anchors
        ends = [(a - 1, c - 1), *anchors, (b, d)]
        for k in range(len(ends) - 1):
            (i, j), (x, y) = ends[k], ends[k + 1]
            gaps.append((i + 1, x, j + 1, y, left if k == 0 else True, right if k == len(ends) - 2 else True))
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], min_coverage: float):
        self.min_coverage = min_coverage
        hashed = {}
        for name, text in templates.items():
            found, _ = word_hashes(*tx.flat(pa.array([text])))
            if len(found):
                hashed[name] = found
        self.vocabulary = np.unique(np.concatenate(list(hashed.values()))) if hashed else np.zeros(0, tx.U64)
        self.names = list(hashed)
        self.templates = [np.searchsorted(self.vocabulary, h) for h in hashed.values()]
        self.members = [np.isin(np.arange(len(self.vocabulary)), t) for t in self.templates]
        self.counts = [np.bincount(t, minlength=len(self.vocabulary)) for t in self.templates]
        self.places = [{int(w): sum(1 << int(j) for j in np.flatnonzero(t == w)) for w in set(t)} for t in self.templates]

    def _shared(self, k: int, where: np.ndarray, found: np.ndarray, doc: np.ndarray, woff: np.ndarray) -> np.ndarray:
        """For the window from each word, how many words it shares with the template, as multisets.

        An occurrence counts in the windows that begin after the one as many places
        before it as the template holds the word."""
        order = np.lexsort((found, doc))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(found[order]) != 0) | (np.diff(doc[order]) != 0)
        group = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        back = np.arange(len(order)) - self.counts[k][found[order]]
        first = np.searchsorted(where, np.maximum(where - 2 * len(self.templates[k]) + 1, woff[doc]))
        after = np.zeros(len(order), np.int64)
        after[order] = np.where(back >= group, order[np.maximum(back, 0)] + 1, 0)
        change = np.bincount(np.maximum(first, after), minlength=len(where) + 1)
        change[1:] -= 1
        return np.cumsum(change)[:-1]

    def _best(self, k: int, need: int, run: np.ndarray, ends: np.ndarray, shared: np.ndarray, found: np.ndarray) -> list[tuple[int, int]]:
        """The alignment with most words, then the first one, among the windows from the words of ``run``."""
        template = self.templates[k].tolist()
        best: list[tuple[int, int]] = []
        for s in run[np.argsort(-shared[run], kind="stable")].tolist():
            if shared[s] < len(best):
                break
            if shared[s] == len(best) and s >= best[0][0]:
                continue
            window = found[s : ends[s]].tolist()
            most = common(window, self.places[k], len(template))
            if most < need or most < len(best) or (most == len(best) and s >= best[0][0]):
                continue
            pairs = [(s + i, j) for i, j in align(window, template)]
            if len(pairs) >= need and (not best or (len(pairs), -pairs[0][0]) > (len(best), -best[0][0])):
                best = pairs
        return best

    def _beyond(self, k: int, pairs: list[tuple[int, int]], where: np.ndarray, found: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
        """The alignment with what follows it and stands before it, as far as each next word
        is at most a template's length away within the document from ``low`` to ``high``."""
        template = self.templates[k].tolist()
        size = len(template)
        added = [(0, 0)]
        while added:  # to the right
            i, j = pairs[-1]
            end = int(np.searchsorted(where, min(where[i] + size + 1, high)))
            added = [(i + 1 + x, j + 1 + y) for x, y in align(found[i + 1 : end].tolist(), template[j + 1 :], left=True)]
            pairs = pairs + added
        added = [(0, 0)]
        while added:  # to the left
            i, j = pairs[0]
            start = int(np.searchsorted(where, max(where[i] - size, low)))
            added = [(start + x, y) for x, y in align(found[start:i].tolist(), template[:j], right=True)]
            pairs = added + pairs
        return pairs

    def scan(self, hashes: np.ndarray, woff: np.ndarray) -> list[list[tuple]]:
        """For each document its (coverage, matched, license, first word, last word), best first."""
        n_docs = len(woff) - 1
        out: list[list[tuple]] = [[] for _ in range(n_docs)]
        if not len(self.vocabulary) or not len(hashes):
            return out
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        at = np.flatnonzero(self.vocabulary[place] == hashes)
        ids = place[at]
        for k, template in enumerate(self.templates):
            need = max(1, int(np.ceil(self.min_coverage * len(template))))
            own = self.members[k][ids]
            where, found = at[own], ids[own]
            if len(where) < need:
                continue
            doc = np.searchsorted(woff, where, "right") - 1
            ends = np.searchsorted(where, np.minimum(where + 2 * len(template), woff[doc + 1]))
            shared = self._shared(k, where, found, doc, woff)
            starts = np.flatnonzero(shared >= need)
            if not len(starts):
                continue
            best: dict[int, tuple] = {}
            for run in np.split(starts, np.flatnonzero((np.diff(starts) > 1) | (np.diff(doc[starts]) > 0)) + 1):
                pairs = self._best(k, need, run, ends, shared, found)
                if not pairs:
                    continue
                d = int(doc[run[0]])
                base = woff[d]
                pairs = self._beyond(k, pairs, where, found, base, woff[d + 1])
                span = where[pairs[0][0]] - base, where[pairs[-1][0]] - base
                row = (len(pairs) / len(template), len(pairs), self.names[k], int(span[0]), int(span[1]))
                held = best.get(d)
                if held is None or (row[0], -row[3]) > (held[0], -held[3]):
                    best[d] = row
            for d, row in best.items():
                out[d].append(row)
        for rows in out:
            rows.sort(key=lambda r: (-r[1] * (r[0] >= self.min_coverage), -r[0], r[2]))
        return out


RESULT = (
    "doc_id long, license string, coverage double, n_matched int, first_word int, last_word int, "
    "licenses array<struct<license: string, coverage: double, n_matched: int, first_word: int, last_word: int>>"
)


def scan_licenses(
    documents: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    min_coverage: float = MIN_COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: the license with most aligned words among the templates
    covered to ``min_coverage``, where its words begin and end, and all such licenses.

    Defined cases: without a covered template, or with a null or empty text,
    license and the figures are null and licenses is empty; of equal numbers of
    words the larger coverage, then the smaller name wins; of equal windows the
    first; a template without words is left out; a null id stays null; repeated
    rows are scanned each; an empty table gives no rows; other columns are ignored.
    """
    small_batches(documents)
    rows = documents.select(documents[id_column].cast("long").alias("doc_id"), documents[text_column].alias("_text"))
    held = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("n_matched", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, min_coverage)
        for whole in batches:
            for batch in tx.slices(whole, "_text", SLICE_BYTES):
                found = scanner.scan(*word_hashes(*tx.flat(batch.column("_text"))))
                every = [
                    [dict(zip(held.names, (name, coverage, n, first, last), strict=True)) for coverage, n, name, first, last in rows_]
                    for rows_ in found
                ]
                best = [rows_[0] if rows_ else dict.fromkeys(held.names) for rows_ in every]
                columns = [pa.array([b[f.name] for b in best], f.type) for f in held]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *columns, pa.array(every, pa.list_(held))],
                    names=["doc_id", *held.names, "licenses"],
                )

    return rows.mapInArrow(run, RESULT)
