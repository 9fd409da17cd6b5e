"""License scans: winnowed fingerprints, an inverted index of templates, banded alignment.

Templates are few, whatever the corpus: their index travels to the tasks. A text's winnowed
fingerprints are looked up there; templates that share some are aligned with the text around
the shared places, inside a band, and the aligned words give coverage and spans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rosterloom.llm.common import in_arrow, texts
from rosterloom.llm.license_texts import TEXTS

# Texts by which licenses are named or granted.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
}

_BSD_CONDITIONS = TEMPLATES["BSD-2-Clause"]
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU_HEADER = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
    "published by the Free Software Foundation, either version {version} of the License, or (at your option) any later "
    "version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.")
_GNU = {"GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.1": ("Lesser General", "2.1"),
        "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3")}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}

TEMPLATES |= {
    "MIT-text": TEMPLATES["MIT"] + (
        " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "BSD-2-Clause-text": f"{_BSD_CONDITIONS} {_BSD_WARRANTY}",
    "BSD-3-Clause-text": (
        f"{_BSD_CONDITIONS} 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        f"endorse or promote products derived from this software without specific prior written permission. {_BSD_WARRANTY}"),
    "BSD-2-Clause-notice": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause-notice": "Licensed under the BSD 3-Clause License.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "ISC-notice": "Released under the ISC License.",
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, version 2.0.",
    "CC0-1.0-notice": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "CC0-1.0-short-notice": "Licensed under CC0 1.0.",
    **{f"{n}-notice": f"This work is licensed under the GNU {kind} Public License, version {v}."
       for n, (kind, v) in _GNU.items() if n != "GPL-3.0"},
    **{f"{n}-short-notice": f"Licensed under the GNU {n.split('-')[0]}, version {v}." for n, (_, v) in _GNU.items()},
    **{f"{n}-header": _GNU_HEADER.format(what="library" if n[0] == "L" else "program",
                                         name=f"{kind} Public License", version=v)
       for n, (kind, v) in _GNU.items() if n != "GPL-3.0"},
    # Every version, so that none is taken for another.
    **{f"CC-{kind}-{v}-notice": f"This work is licensed under a Creative Commons {name} {v} {scope} License."
       for kind, name in _CC.items() for v, scope in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"),
                                                      ("4.0", "International")) if (kind, v) != ("BY", "4.0")},
    **{f"CC-{kind}-{v}-short-notice": f"Licensed under CC {kind} {v}." for kind in _CC for v in ("1.0", "2.0", "2.5", "3.0", "4.0")},
} | TEXTS

_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPAN = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first", pa.int64()), ("last", pa.int64()),
                   ("n_words", pa.int64())])


@dataclass(frozen=True)
class Settings:
    """``gram`` words per fingerprint, the least of each ``window`` of them kept; a region is reported
    if ``coverage`` of the template's words are aligned in order, within ``band`` words (at most a quarter of
    the template) of the diagonal."""

    gram: int = 3
    window: int = 4
    coverage: float = 0.8
    band: int = 8


def _fingerprints(ids: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed hashes of word n-grams and their places: in each window the least, the last of equals.

    A text of no more than a window's grams keeps its least one, a text shorter than a gram none.
    """
    n = len(ids) - settings.gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(settings.gram):
        h = (h + ids[k:k + n]) * _MIX
        h ^= h >> np.uint64(31)
    w = min(settings.window, n)
    views = np.lib.stride_tricks.sliding_window_view(h[::-1], w)[::-1]
    at = np.arange(n - w + 1) + w - 1 - views.argmin(axis=1)
    at = np.unique(at)
    return h[at], at


def word_hashes(words: list[str], cache: dict[str, int]) -> np.ndarray:
    from xxhash import xxh64_intdigest
    out = []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxh64_intdigest(w)
        out.append(h)
    return np.array(out, np.uint64)


def align(template: np.ndarray, text: np.ndarray, start: int, band: int) -> tuple[int, int, int]:
    """Most words of ``template`` in order in ``text``, word i at most ``band`` from ``start + i``
    (a longest common subsequence), and the range of ``text`` they span; among equals, the shortest range, then the earliest.
    """
    above: dict[int, tuple[int, int]] = {}  # by distance from the diagonal: words so far, place of the first
    best = (0, 0, 0, 0)  # words, minus the range's length, minus its end, its begin
    for i, t in enumerate(template):
        row: dict[int, tuple[int, int]] = {}
        for d in range(-band, band + 1):
            j = start + i + d
            if not 0 <= j < len(text):
                continue
            options = [x for x in (above.get(d + 1), row.get(d - 1)) if x is not None]
            if t == text[j]:
                n, first = above.get(d, (0, j))
                options.append((n + 1, first))
                best = max(best, (n + 1, first - j, -j, first))
            if options:
                row[d] = max(options)
        above = row
    return best[0], best[3], 1 - best[2] if best[0] else 0


def most_aligned(template: np.ndarray, text: np.ndarray, start: int, band: int) -> int:
    """At least what :func:`align` finds: words of ``template`` that occur within ``band`` of their place."""
    padded = np.zeros(len(template) + 2 * band, np.uint64)
    known = np.zeros(len(padded), bool)
    first, last = max(start - band, 0), min(start + len(template) + band, len(text))
    if first >= last:
        return 0
    padded[first - start + band:last - start + band] = text[first:last]
    known[first - start + band:last - start + band] = True
    hit = np.zeros(len(template), bool)
    for d in range(2 * band + 1):
        hit |= known[d:d + len(template)] & (padded[d:d + len(template)] == template)
    return int(hit.sum())


class Scanner:
    """Templates with their inverted index of fingerprints."""

    def __init__(self, templates: dict[str, str], settings: Settings = Settings()):
        self.settings, self.cache, self.names, self.words = settings, {}, list(templates), []
        self.index: dict[int, list[tuple[int, int]]] = {}
        short = set()
        for k, text in enumerate(templates.values()):
            ids = word_hashes(_WORD.findall(text.lower()), {})
            self.words.append(ids)
            # Templates keep every gram, so that a text's winnowed ones are found wherever its windows lie.
            for h, at in zip(*_fingerprints(ids, Settings(settings.gram, 1))):
                self.index.setdefault(int(h), []).append((k, int(at)))
                if len(ids) < settings.gram + settings.window - 1:
                    short.add(int(h))
        self.known = np.array(sorted(self.index), np.uint64)
        # Winnowing promises nothing for less than a window: these are looked up among all grams.
        self.short = np.array(sorted(short), np.uint64)

    def _starts(self, ids: np.ndarray) -> dict[int, set[int]]:
        """Where a template may begin, by template."""
        found: dict[int, set[int]] = {}
        for known, settings in ((self.known, self.settings), (self.short, Settings(self.settings.gram, 1))):
            hashes, places = _fingerprints(ids, settings)
            if not len(known):
                continue
            # The index may be much longer than a text: a binary search of each hash.
            hit = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
            for h, at in zip(hashes[hit], places[hit]):
                for k, offset in self.index[int(h)]:
                    found.setdefault(k, set()).add(int(at) - offset)
        return found

    def scan(self, text: str | None) -> tuple[list[dict], int]:
        """Reported regions with code point spans, and the number of words."""
        lowered = (text or "").lower()
        words = _WORD.findall(lowered)
        if len(self.cache) > 300_000:
            self.cache.clear()
        ids = word_hashes(words, self.cache)
        found = []
        for k, begun in self._starts(ids).items():
            template, done = self.words[k], -1
            for start in sorted(begun):
                if start < done:
                    continue
                band, least = min(self.settings.band, len(template) // 4), self.settings.coverage * len(template)
                if most_aligned(template, ids, start, band) < least:
                    continue
                n, first, last = align(template, ids, start, band)
                if n >= least:
                    found.append((first, -last, -n / len(template), -n, k))
                    done = last
        if not found:
            return [], len(words)
        places = [m.span() for m in _WORD.finditer(text)]
        if len(places) != len(words):  # lower-casing has split or joined words: places in the lower-cased text
            places = [m.span() for m in _WORD.finditer(lowered)]
        out, reach = [], -1
        for first, last, coverage, _, k in sorted(found):
            if -last <= reach:  # inside a longer region, or the same one at less coverage or by fewer words
                continue
            reach = -last
            out.append({"license": self.names[k], "coverage": -coverage, "first": places[first][0],
                        "last": places[-last - 1][1], "n_words": -last - first})
        return out, len(words)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, n_words, licenses``, the latter
    ``array<struct<license, coverage, first, last, n_words>>`` by place (code points, end exclusive).

    Words are runs of letters and digits in any case. Null and empty texts have none. A
    template shorter than a fingerprint's words is never found. Repeated rows are repeated; other columns are not read.
    Each text is scanned where it lies, whole: no shuffle.
    """
    wanted = TEMPLATES if templates is None else templates
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("licenses", pa.list_(_SPAN))])

    def run(batches):
        scanner = Scanner(wanted, settings)
        for batch in batches:
            results = [scanner.scan(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_words": [n for _, n in results],
                                              "licenses": [r for r, _ in results]}, schema=schema)

    return in_arrow(texts(docs), run, "doc_id long, n_words long, licenses array<struct<"
                    "license:string,coverage:double,first:long,last:long,n_words:long>>")
