"""License scans by patience alignment of texts with templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from importlib import resources

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_COVERAGE = 0.8
# A template of so few words is laid over the text as a whole.
SHORT_WORDS = 25

# Public license texts and notices, by SPDX name.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to"
        ' in writing, software distributed under the License is distributed on an "AS IS" BASIS,'
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
        " for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        ' software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial"
        ' portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,'
        " EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS"
        " FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT"
        " HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
        " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE"
        " USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License version 3.",
        "SPDX-License-Identifier: GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either version"
        " 3 of the License, or (at your option) any later version. This program is distributed in the"
        " hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for"
        " more details.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
        " License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "BSD-3-Clause": (
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: Redistributions of source code"
        " must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. Redistributions in binary form must reproduce the above copyright notice, this"
        " list of conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution. Neither the name of the copyright holder nor the names of"
        " its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission.",
    ),
    "ISC": (
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this permission"
        " notice appear in all copies.",
    ),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/.",
    ),
}

# What the licenses of one family have in common, apart from name and version.
_PROGRAM = (
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU"
    " {1}General Public License as published by the Free Software Foundation; {2} This {0} is"
    " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
    " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General"
    " Public License for more details."
)
_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR'
    " IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND"
    " FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR"
    " CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
    " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY"
    " THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
    " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
    " POSSIBILITY OF SUCH DAMAGE."
)
_ISC_DISCLAIMER = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS'
    " SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE"
    " AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES"
    " WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,"
    " NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE"
    " OF THIS SOFTWARE."
)


def _gnu(kind: str, version: str) -> tuple[str, ...]:
    full = f"{kind} " if kind else ""
    short = {"": "GPL", "Lesser": "LGPL", "Library": "LGPL", "Affero": "AGPL"}[kind]
    plain = version.removesuffix(".0")
    either = f"either version {plain} of the License, or (at your option) any later version."
    return (
        f"This work is licensed under the GNU {full}General Public License, version {plain}.",
        f"Licensed under the GNU {full}General Public License version {plain}.",
        f"Licensed under the {short} version {plain}.",
        f"SPDX-License-Identifier: {short}-{version}",
        *(_PROGRAM.format(what, full, either) for what in ("program", "library")),
        *(_PROGRAM.format(what, full, f"version {plain} of the License.") for what in ("program", "library")),
    )


def _creative_commons(code: str, words: str, version: str) -> tuple[str, ...]:
    place = "International" if version == "4.0" else "Unported"
    return (
        f"Licensed under CC {code} {version}.",
        f"This work is licensed under a Creative Commons {words} {version} {place} License.",
        f"SPDX-License-Identifier: CC-{code}-{version}",
    )


def _more(name: str, *texts: str) -> None:
    TEMPLATES[name] = tuple(dict.fromkeys((*TEMPLATES.get(name, ()), *texts)))


for _kind, _short, _versions in (
    ("", "GPL", ("1.0", "2.0", "3.0")), ("Library", "LGPL", ("2.0",)),
    ("Lesser", "LGPL", ("2.1", "3.0")), ("Affero", "AGPL", ("3.0",)),
):
    for _version in _versions:
        _more(f"{_short}-{_version}", *_gnu(_kind, _version))
for _code, _words in (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
):
    for _version in ("3.0", "4.0"):
        _more(f"CC-{_code}-{_version}", *_creative_commons(_code, _words, _version))
for _name, _title in (("BSD-2-Clause", "BSD 2-Clause"), ("BSD-3-Clause", "BSD 3-Clause"), ("ISC", "ISC")):
    _more(_name, f"Licensed under the {_title} License.", f"Released under the {_title} License.",
          f"SPDX-License-Identifier: {_name}")
_more("BSD-3-Clause", TEMPLATES["BSD-3-Clause"][1] + _DISCLAIMER)
_CONDITIONS = TEMPLATES["BSD-3-Clause"][1].split(" Neither the name")[0]
_more("BSD-2-Clause", _CONDITIONS, _CONDITIONS + _DISCLAIMER)
_more("ISC", TEMPLATES["ISC"][1] + _ISC_DISCLAIMER)
_more("0BSD", TEMPLATES["ISC"][1].split(", provided that")[0] + "." + _ISC_DISCLAIMER)
_more("MIT-0", "SPDX-License-Identifier: MIT-0",
      TEMPLATES["MIT"][3].split(", subject to")[0] + "." + TEMPLATES["MIT"][3].split("of the Software.")[1])
for _version in ("1.1", "2.0"):
    _more(f"MPL-{_version}", f"Licensed under the Mozilla Public License, version {_version}.",
          f"SPDX-License-Identifier: MPL-{_version}")
_more("CC0-1.0", "Licensed under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0",
      "This work is released under the Creative Commons CC0 1.0 Universal Public Domain Dedication.",
      "To the extent possible under law, the author has waived all copyright and related or"
      " neighboring rights to this work.")  # fmt: skip
_more("Unlicense", "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense",
      "This is free and unencumbered software released into the public domain.")

# What a short notice says besides the name and version of its license.
GENERIC = frozenset(
    "this work is licensed released under a the of license licence version v spdx identifier"
    " international unported universal terms".split()
)
# Words that tell apart licenses whose long notices agree otherwise.
DISTINCT = frozenset("lesser library affero apache mozilla".split())
# A longer template is a whole license, with numbers that tell nothing of its version.
NOTICE_WORDS = 250


def all_templates() -> dict[str, tuple[str, ...]]:
    """The notices, and the whole texts in `license_texts`."""
    folder = resources.files("tallyloom.llm") / "license_texts"
    whole = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}
    return {name: (*texts, *([whole[name]] if name in whole else [])) for name, texts in TEMPLATES.items()}


_WORD = re.compile(r"[^\W_]+")


def words_in(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of equal words, in order on both sides.

    Equal ends are aligned first. Words that stand once on either side are
    candidates; the longest increasing subsequence of them is kept as anchors, and
    the gaps between anchors are aligned the same way. A gap without such a word
    takes its rarest common word as an anchor.
    """
    pairs: list[tuple[int, int]] = []
    open_gaps = [(0, len(a), 0, len(b))]
    while open_gaps:
        a0, a1, b0, b1 = open_gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        once = {w for w, n in in_a.items() if n == 1 and in_b.get(w) == 1}
        if once:
            place = {b[j]: j for j in range(b0, b1) if b[j] in once}
            candidates = [(i, place[a[i]]) for i in range(a0, a1) if a[i] in once]
            anchors = _increasing(candidates)
        else:
            shared = [w for w in in_a if w in in_b]
            if not shared:
                continue
            word = min(shared, key=lambda w: (in_a[w] * in_b[w], w))
            anchors = [(a.index(word, a0, a1), b.index(word, b0, b1))]
        pairs.extend(anchors)
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        for (i0, j0), (i1, j1) in zip(edges, edges[1:], strict=False):
            if i0 + 1 < i1 and j0 + 1 < j1:
                open_gaps.append((i0 + 1, i1, j0 + 1, j1))
    return sorted(pairs)


def _increasing(candidates: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of candidates, ordered by first, that also increases by second."""
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(candidates):
        k = bisect_left(ends, j)
        before.append(at[k - 1] if k else -1)
        ends[k:] = [j, *ends[k + 1 :]]
        at[k:] = [n, *at[k + 1 :]]
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(candidates[n])
        n = before[n]
    return out[::-1]


class Scanner:
    """Templates ready for alignment."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]], least_coverage: float) -> None:
        self.least = least_coverage
        self.templates: list[tuple[str, list[str], Counter, frozenset[str]]] = []
        for name, texts in templates.items():
            for text in texts:
                words = words_in(text)
                if words:
                    self.templates.append((name, words, Counter(words), self._needed(words)))

    @staticmethod
    def _needed(words: list[str]) -> frozenset[str]:
        """Words that must be matched: name and version."""
        if len(words) <= SHORT_WORDS:
            return frozenset(set(words) - GENERIC)
        if len(words) <= NOTICE_WORDS:
            return frozenset(w for w in words if w.isdigit() or w in DISTINCT)
        return frozenset()

    def scan(self, text: str | None) -> dict[str, tuple[float, int, int, int]]:
        """By license the best coverage, its words matched, and its first and last word."""
        words = words_in(text)
        counts = Counter(words)
        all_found: list[tuple[int, float, int, int, str]] = []
        for name, template, wanted, needed in self.templates:
            size = len(template)
            short = size <= SHORT_WORDS
            if len(words) < self.least * size or not all(w in counts for w in needed):
                continue
            # no alignment can cover more than the words at hand
            if sum(min(n, counts.get(w, 0)) for w, n in wanted.items()) < self.least * size:
                continue
            if short:
                regions = self._laid_over(words, template, min(needed or wanted, key=lambda w: (counts[w], w)))
            else:
                regions = self._regions(words, size, wanted)
            for low, high in regions:
                pairs = patience(words[low:high], template)
                covered = {template[j] for _, j in pairs}
                coverage = len(pairs) / size
                if coverage < self.least or not needed <= covered:
                    continue
                first, last = low + pairs[0][0], low + pairs[-1][0]
                if size > NOTICE_WORDS and self._names_a_sibling(words[first : last + 1], wanted):
                    continue
                if short and last - first + 1 > size / self.least:
                    continue
                all_found.append((len(pairs), coverage, first, last, name))
        return self._best(all_found)

    @staticmethod
    def _names_a_sibling(words: list[str], wanted: Counter) -> bool:
        """Whether the text has a name of a sibling more often than the license itself.

        Whole licenses of a family differ by little else.
        """
        return any(n > wanted[w] for w, n in Counter(w for w in words if w in DISTINCT).items())

    @staticmethod
    def _best(all_found: list[tuple[int, float, int, int, str]]) -> dict[str, tuple[float, int, int, int]]:
        """Of two licenses in the same words the one that matches more of them, or else
        the one whose template leaves fewer words unmatched; by license the best."""
        kept: list[tuple[int, float, int, int, str]] = []
        best: dict[str, tuple[float, int, int, int]] = {}
        for found in sorted(all_found, key=lambda x: (-x[0], -x[1])):
            matched, coverage, first, last, name = found
            if any(
                other[:2] > found[:2] and other[4] != name
                and min(last, other[3]) - max(first, other[2]) + 1 >= 0.8 * (last - first + 1)
                for other in kept
            ):
                continue
            kept.append(found)
            if (coverage, matched) > best.get(name, (0.0, 0, 0, 0))[:2]:
                best[name] = (coverage, matched, first, last)
        return best

    def _laid_over(self, words: list[str], template: list[str], word: str) -> list[tuple[int, int]]:
        """Where a short template may lie by this word of it, with little to spare."""
        spare = 1 + len(template) // 4
        first = template.index(word)
        last = len(template) - template[::-1].index(word)
        return [
            (max(0, i - last + 1 - spare), i + len(template) - first + spare)
            for i, w in enumerate(words)
            if w == word
        ]

    def _regions(self, words: list[str], size: int, wanted: Counter) -> list[tuple[int, int]]:
        """Every stretch of the text whose words suffice for the coverage.

        A window of one and a half templates slides over the text, and the template's
        words in it are counted. Windows that suffice are merged where they meet.
        Besides each merged stretch, the fullest windows of a long one are regions of
        their own, so that words further off draw nothing away.
        """
        length, least = size + size // 2 + 2, self.least * size
        have: Counter = Counter()
        total, runs, full = 0, [], []
        for i, w in enumerate(words):
            if w in wanted:
                have[w] += 1
                total += have[w] <= wanted[w]
            if i >= length and (gone := words[i - length]) in wanted:
                total -= have[gone] <= wanted[gone]
                have[gone] -= 1
            if total >= least:
                low = max(0, i + 1 - length)
                if runs and low <= runs[-1][1]:
                    runs[-1][1] = i + 1
                else:
                    runs.append([low, i + 1])
                if full and i < full[-1][1] + size // 2:
                    if total > full[-1][0]:
                        full[-1] = (total, i)
                else:
                    full.append((total, i))
        regions = {(max(0, low - size // 2), min(len(words), high + size // 2)) for low, high in runs}
        regions |= {(max(0, i + 1 - length), i + 1) for _, i in full}
        return sorted(regions)


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, tuple[str, ...]] | None = None,
    least_coverage: float = LEAST_COVERAGE,
) -> DataFrame:
    """A row for each document and license found: doc_id, license, coverage, n_matched,
    first_word, last_word.

    `coverage` is the share of the template's words that the alignment matches; of
    several texts of one license the best counts, and of two licenses found in the
    same words the one that matches more of them. Words are letters and digits,
    case ignored. Short notices must also match the words that set them apart, without
    many others between; long ones the numbers and names that tell versions and
    siblings apart. A text that names a sibling ("Affero", "Lesser") more often than a
    whole license does isn't that license; a sibling without a template gives no row.
    `first_word` and `last_word` number the document's words from 0.

    Null and empty texts hold no license. Repeated rows give their rows again;
    other columns are ignored.
    """
    templates = dict(all_templates() if templates is None else templates)
    ready: list[Scanner] = []

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not ready:
            ready.append(Scanner(templates, least_coverage))
        for frame in frames:
            rows = [
                (doc_id, name, *result)
                for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True)
                for name, result in ready[0].scan(text).items()
            ]
            yield pd.DataFrame(
                rows,
                columns=["doc_id", "license", "coverage", "n_matched", "first_word", "last_word"],
            ).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(
        found,
        "doc_id bigint, license string, coverage double, n_matched int, first_word int, last_word int",
    )
