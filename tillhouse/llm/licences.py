"""Licence scans: passages compared with licence templates by the Dice coefficient over word bigrams.

Texts and templates become words: pieces between white space, lower-cased, letters and digits only.  Dice is
twice the common bigrams over the bigrams of both sides, where a bigram counts as often as both sides hold it.
A passage is a run of words of a text; the best run for a template begins and ends with one of its bigrams.

A template of m bigrams can reach a coefficient t only with passages of m * t / (2 - t) to m * (2 - t) / t
bigrams, of which at least m * t / (2 - t) are its own.  So a template is a candidate for a text only if that
many of its bigrams stand that close together somewhere; all others are pruned before any passage is compared.

Neighbours differ in few words ("version 2" and "version 3", "Lesser", "NoDerivatives").  A template may name
phrases that a passage has to hold word for word, and counts only for passages that hold them.  From every place
where a passage of a template can begin, the best one that reaches ``THRESHOLD`` is a claim; of those of one template
that overlap, the best stays.  A claim yields to an overlapping one of a longer template that nearly holds its whole
template (two-clause BSD to three-clause BSD).  Of the others that overlap, the best coefficient stays, then the longer
template, the earlier passage, the shorter one, the template listed first.  The best claim of each licence is reported.

Whole licences are known by their opening passage or, if short, by all of it.  A null or empty text has no
licence.  Every row is judged; other columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.texts import pieces, row_sums, slices, whole

THRESHOLD = 0.8
#: A template is part of another if this share of its bigrams is in it and it is at most this much as long.
PART = 0.9

#: Name, text, and phrases that must be there.
Template = tuple[str, str] | tuple[str, str, tuple[str, ...]]

# Notices, openings and short licences by their SPDX ids, as published.
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
    compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
    Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
    on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
    the specific language governing permissions and limitations under the License."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
    notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
    above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
    materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
    ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
    SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
    LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
    CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
    SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
    ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
    INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
    ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
    THIS SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation
    the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
    permit persons to whom the Software is furnished to do so"""
_MIT_NOTICE = """, subject to the following conditions: The above copyright notice and this permission notice shall be included
    in all copies or substantial portions of the Software."""
_JSON = "The Software shall be used for Good, not Evil."
_MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
    THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
    COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
    OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GNU_NOTICE = """This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as
    published by the Free Software Foundation, either version {version} of the License, or (at your option) any later
    version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
    implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details."""
_GNU_ONLY = "under the terms of the GNU {kind} version {version} as published by the Free Software Foundation"
_GNU_LINE = "This work is licensed under the GNU {kind}, version {version}"
_GNU_OPENING = """GNU {kind} Version {version}, {date} Copyright (C) {years} Free Software Foundation, Inc. Everyone is permitted to
    copy and distribute verbatim copies of this license document, but changing it is not allowed."""
# SPDX id, short name, kind, version, date, years of the copyright line.
_GNU = [
    ("GPL-2.0", "GPL", "General Public License", "2", "June 1991", "1989, 1991"),
    ("GPL-3.0", "GPL", "General Public License", "3", "29 June 2007", "2007"),
    ("LGPL-2.1", "LGPL", "Lesser General Public License", "2.1", "February 1999", "1991, 1999"),
    ("LGPL-3.0", "LGPL", "Lesser General Public License", "3", "29 June 2007", "2007"),
    ("AGPL-3.0", "AGPL", "Affero General Public License", "3", "19 November 2007", "2007"),
]
_CC_KINDS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
_CC_LINE = "This work is licensed under a Creative Commons {kind} {version} {scope} License"
_CC_OPENING = """Creative Commons {kind} 4.0 International Public License By exercising the Licensed Rights (defined below), You
    accept and agree to be bound by the terms and conditions of this Creative Commons {kind} 4.0 International Public License"""


def gnu_templates() -> list[Template]:
    """Notices of programs and libraries, one-line forms and openings of the GNU licences."""
    out = []
    for name, short, kind, version, date, years in _GNU:
        own, full = f"GNU {kind.split()[0]}", version if "." in version else f"{version}.0"
        values = {"kind": kind, "version": version, "date": date, "years": years}
        out += [(name, _GNU_NOTICE.format(thing=thing, **values), (own, f"version {version}")) for thing in ("program", "library")]
        out += [(name, text.format(**values), (own, f"version {version}")) for text in (_GNU_ONLY, _GNU_LINE, _GNU_OPENING)]
        out += [(name, f"GNU {kind} v{v}", (own, f"License v{v}")) for v in dict.fromkeys([version, full])]
        out += [(name, f"Licensed under the {short}v{v}", (f"the {short}v{v}",)) for v in dict.fromkeys([version, full])]
    return out


def cc_templates() -> list[Template]:
    """Sentence and short form of each kind and version, and the opening of the public licences of version 4."""
    out = []
    for short, kind in _CC_KINDS.items():
        for version, scope in _CC_VERSIONS.items():
            name, marks = f"CC-{short}-{version}", (f"Commons {kind} {version}",)
            out.append((name, _CC_LINE.format(kind=kind, version=version, scope=scope), marks))
            out.append((name, f"Licensed under CC {short} {version}", (f"CC {short} {version}",)))
        out.append((f"CC-{short}-4.0", _CC_OPENING.format(kind=kind), (f"Commons {kind} 4.0",)))
    return out


TEMPLATES: list[Template] = [
    ("0BSD", f"{_ISC}. {_ISC_DISCLAIMER}", ("hereby granted the",)),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0", ("Apache License", "Version 2.0")),
    ("Apache-2.0", _APACHE, ("Apache License", "Version 2.0")),
    ("Apache-2.0", """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,
        REPRODUCTION, AND DISTRIBUTION 1. Definitions.""", ("Version 2.0",)),
    ("BSD-2-Clause", _BSD),
    ("BSD-2-Clause", f"{_BSD} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES}", ("endorse or promote",)),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES} {_BSD_DISCLAIMER}", ("endorse or promote",)),
    *cc_templates(),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "Licensed under CC0 1.0", ("CC0 1.0",)),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal", ("CC0 1.0",)),
    *gnu_templates(),
    ("ISC", f"{_ISC}{_ISC_NOTICE}", ("provided that",)),
    ("ISC", f"{_ISC}{_ISC_NOTICE} {_ISC_DISCLAIMER}", ("provided that",)),
    ("JSON", f"{_MIT}{_MIT_NOTICE} {_JSON}", ("not Evil",)),
    ("JSON", f"{_MIT}{_MIT_NOTICE} {_JSON} {_MIT_DISCLAIMER}", ("not Evil",)),
    ("MIT", "Released under the MIT License", ("MIT License",)),
    ("MIT", "Licensed under the MIT License", ("MIT License",)),
    ("MIT", f"{_MIT}{_MIT_NOTICE}", ("substantial portions",)),
    ("MIT", f"{_MIT}{_MIT_NOTICE} {_MIT_DISCLAIMER}", ("substantial portions",)),
    ("MIT-0", f"{_MIT}. {_MIT_DISCLAIMER}", ("do so the",)),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""", ("v. 2.0",)),
    ("MPL-2.0", """Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that
        creates, contributes to the creation of, or owns Covered Software.""", ("Version 2.0",)),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]


def normalised(words: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{N}]+", "")


def known_words(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words per row, and the place of each word in ``vocabulary``, -1 for others."""
    counts, codes, names = pieces(texts)
    plain = normalised(names)
    ids = np.asarray(pc.fill_null(pc.index_in(plain, value_set=vocabulary), -1)).astype(np.int64)
    ids[np.asarray(pc.equal(plain, ""))] = -2
    laid = ids[codes]
    word = laid != -2
    return row_sums(counts, word.astype(np.int64)), laid[word]


@dataclass
class Templates:
    names: list[str]
    vocabulary: pa.Array
    bigrams: np.ndarray  # distinct bigrams of all templates, sorted
    owned: list[dict[int, int]]  # of each template: bigram -> times
    marks: list[frozenset[int]]  # of each template: bigrams a passage must hold
    threshold: float
    sizes: list[int] = field(init=False)
    wholes: list[list[int]] = field(init=False)  # of each template: longer ones of other licences that nearly hold it

    def __post_init__(self):
        self.sizes = [sum(own.values()) for own in self.owned]
        every = range(len(self.names))
        self.wholes = [[b for b in every if self.names[a] != self.names[b] and self._part(a, b)] for a in every]

    def _part(self, a: int, b: int) -> bool:
        common = sum((Counter(self.owned[a]) & Counter(self.owned[b])).values())
        return common >= PART * self.sizes[a] and self.sizes[a] <= PART * self.sizes[b]

    @classmethod
    def of(cls, templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD) -> Templates:
        phrases = [(i, phrase) for i, (_, _, *must) in enumerate(templates) for phrase in (must[0] if must else ())]
        texts = pa.array([t[1] for t in templates] + [phrase for _, phrase in phrases], pa.string())
        plain = normalised(pieces(texts)[2])
        vocabulary = pc.unique(plain.filter(pc.not_equal(plain, "")))
        counts, ids = known_words(texts, vocabulary)
        keys = [(w[:-1] * len(vocabulary) + w[1:]).tolist() for w in np.split(ids, np.cumsum(counts)[:-1])]
        bigrams = np.array(sorted({k for own in keys for k in own}), np.int64)
        place = {k: i for i, k in enumerate(bigrams.tolist())}
        marks: list[set[int]] = [set() for _ in templates]
        for (i, _), own in zip(phrases, keys[len(templates):]):
            marks[i].update(place[k] for k in own)
        owned = [dict(Counter(place[k] for k in own)) for own in keys[: len(templates)]]
        return cls([t[0] for t in templates], vocabulary, bigrams, owned, [frozenset(m) for m in marks], threshold)

    def bounds(self, template: int) -> tuple[int, int]:
        """Fewest own bigrams, and most bigrams at all, of a passage that reaches the threshold."""
        m, t = self.sizes[template], self.threshold
        return int(np.ceil(m * t / (2 - t) - 1e-9)), int(np.floor(m * (2 - t) / t + 1e-9))

    def find(self, texts: pa.Array) -> list[tuple[int, int, float, int, int]]:
        """``row, template, dice, first word, words`` of the claims that stay."""
        counts, ids = known_words(texts, self.vocabulary)
        if len(ids) < 2:
            return []
        keys = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(self.vocabulary) + ids[1:], -1)
        at = np.flatnonzero(keys >= 0)
        bigram = np.minimum(np.searchsorted(self.bigrams, keys[at]), len(self.bigrams) - 1)
        there = self.bigrams[bigram] == keys[at]
        at, bigram = at[there], bigram[there]
        row_end = np.cumsum(counts)
        row = np.searchsorted(row_end, at, side="right")
        inside = at + 2 <= row_end[row]
        at, bigram, row = at[inside], bigram[inside], row[inside]
        held = np.zeros(len(self.bigrams), bool)
        held[bigram] = True
        claims: dict[int, list[tuple[int, float, int, int]]] = {}
        for template, owned in enumerate(self.owned):
            if not held[list(self.marks[template])].all():
                continue
            mine = np.isin(bigram, list(owned))
            p, b, r = at[mine], bigram[mine], row[mine]
            least, most = self.bounds(template)
            close = np.searchsorted(p, p + most) - np.arange(len(p)) >= least  # enough of its bigrams within reach
            for i in np.flatnonzero(close).tolist():
                dice, first, n = self.passage(template, p, b, r, i, most)
                if dice >= self.threshold:
                    claims.setdefault(int(r[i]), []).append((template, dice, first, n))
        return [(k, t, d, first - int(row_end[k] - counts[k]), n) for k in sorted(claims) for t, d, first, n in self.settled(claims[k])]

    def settled(self, claims: list[tuple[int, float, int, int]]) -> list[tuple[int, float, int, int]]:
        """The claims of one text that stay; no two of them overlap."""
        by: dict[int, list[tuple[int, float, int, int]]] = {}
        for claim in claims:
            by.setdefault(claim[0], []).append(claim)
        best = {template: self.apart(own) for template, own in by.items()}
        starts = {template: [c[2] for c in own] for template, own in best.items()}

        def meets(template: int, claim: tuple[int, float, int, int]) -> bool:
            k = bisect_left(starts.get(template, []), claim[2] + claim[3])
            return k > 0 and best[template][k - 1][2] + best[template][k - 1][3] > claim[2]

        return self.apart([c for own in best.values() for c in own if not any(meets(t, c) for t in self.wholes[c[0]])])

    def apart(self, claims: list[tuple[int, float, int, int]]) -> list[tuple[int, float, int, int]]:
        """Of claims that overlap the best, in the order of the text."""
        starts: list[int] = []
        kept: list[tuple[int, float, int, int]] = []
        for claim in sorted(claims, key=lambda c: (-c[1], -self.sizes[c[0]], c[2], c[3], c[0])):
            first, n = claim[2:]
            k = bisect_left(starts, first + n)
            if k and kept[k - 1][2] + kept[k - 1][3] > first:
                continue
            starts.insert(k, first)
            kept.insert(k, claim)
        return kept

    def passage(self, template: int, p: np.ndarray, b: np.ndarray, r: np.ndarray, i: int, most: int) -> tuple[float, int, int]:
        """Dice, first word and words of the best passage that begins with the template's bigram at ``i`` and holds its marks."""
        m, missing = self.sizes[template], set(self.marks[template])
        left, common, best = dict(self.owned[template]), 0, (0.0, 0, 0)
        for j in range(i, len(p)):
            n = int(p[j] - p[i]) + 1
            if n > most or r[j] != r[i]:
                break
            if left[int(b[j])]:
                left[int(b[j])] -= 1
                common += 1
            missing.discard(int(b[j]))
            dice = 2 * common / (n + m)
            if dice > best[0] and not missing:
                best = (dice, int(p[i]), n + 1)
        return best


def scan_licences(docs: DataFrame, templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, licences`` of every row of ``docs`` (doc_id, text); licences: array of (licence, dice, first_word, n_words)."""
    ready = Templates.of(templates, threshold)
    kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                best: list[dict[str, dict]] = [{} for _ in range(part.num_rows)]
                for row, template, dice, first, n in ready.find(whole(part.column("text"))):
                    name = ready.names[template]
                    if (-dice, first) < ((-best[row][name]["dice"], best[row][name]["first_word"]) if name in best[row] else (0, 0)):
                        best[row][name] = {"licence": name, "dice": dice, "first_word": first, "n_words": n}
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([[b[n] for n in sorted(b)] for b in best], kind)], ["doc_id", "licences"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, licences array<struct<licence string, dice double, first_word long, n_words long>>")


def licence_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_licences, licences, best_licence, best_dice`` of every row."""
    rows = scan_licences(docs)
    best = F.array_max(F.transform("licences", lambda x: F.struct(x["dice"].alias("dice"), x["licence"].alias("licence"))))
    return rows.select(
        "doc_id", F.size("licences").alias("n_licences"), F.array_join(F.col("licences.licence"), ",").alias("licences"),
        best["licence"].alias("best_licence"), best["dice"].alias("best_dice"),
    )
