"""Licence texts in documents, also where words were changed, added or left out.

The words of all licence texts make one generalised suffix automaton. A document
is streamed through it: after each word it gives the longest run of words up to
there that stands in any licence text. Runs that cannot be made longer and are
long enough are placed in the texts they come from and chained, in the order of
both; a chain that covers enough of its text is a span with that licence.

Phrases and identifiers are texts too, of which every word must be there.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from guestlens.llm.tables import ship

# --- Fixed values: phrases that name a licence, and its label ------------------
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# --- Fixed values: licence identifiers, as they follow their tag ---------------
IDENTIFIERS = {
    "MIT": "mit",
    "Apache-2.0": "apache",
    "GPL-2.0": "gpl",
    "GPL-3.0": "gpl",
    "LGPL-2.1": "lgpl",
    "LGPL-3.0": "lgpl",
    "AGPL-3.0": "agpl",
    "MPL-2.0": "mpl",
    "BSD-2-Clause": "bsd",
    "BSD-3-Clause": "bsd",
    "ISC": "isc",
    "Zlib": "zlib",
    "Unlicense": "unlicense",
    "CC-BY-4.0": "cc-by",
    "CC-BY-SA-4.0": "cc-by-sa",
    "CC0-1.0": "cc0",
}

# --- Fixed values: short notices, of which every word counts --------------------
NOTICES = {
    "Creative Commons Attribution 4.0 International": "cc-by",
    "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa",
    "GNU Lesser General Public License": "lgpl",
    "GNU Affero General Public License": "agpl",
    "Mozilla Public License": "mpl",
    "Boost Software License": "boost",
    "Eclipse Public License": "epl",
}

# --- Fixed values: licence texts ------------------------------------
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: 1. Redistributions of source code must retain
the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS
BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of
the {0} as published by the Free Software Foundation, either version {1} of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the {0} for more details."""

TEXTS = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. """ + _AS_IS),
    ("bsd", f"{_BSD_TERMS} {_BSD_AS_IS}"),
    ("bsd", f"{_BSD_TERMS} {_BSD_NAMES} {_BSD_AS_IS}"),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear
in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    ("gpl", _GNU_NOTICE.format("GNU General Public License", 3)),
    ("lgpl", _GNU_NOTICE.format("GNU Lesser General Public License", 3)),
    ("agpl", _GNU_NOTICE.format("GNU Affero General Public License", 3)),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software. Permission is granted to
anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. 2. Altered source versions must be
plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may
not be removed or altered from any source distribution."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to
copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("cc0", """To the extent possible under law, the author(s) have dedicated all copyright and related and
neighboring rights to this software to the public domain worldwide. This software is distributed without
any warranty."""),
]

#: Fewest words of a run that is chained, most words between two runs of a chain
#: (in the document and in the licence text), and the least share of a licence
#: text that a chain must cover.
LEAST_RUN, GAP, LEAST_SHARE = 4, 40, 0.6
#: Share of a span from which a better one of another licence takes its place.
MOST_OVERLAP = 0.5

#: ASCII upper case becomes lower case; all else in ASCII but letters and digits a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def licence_words(text: str | bytes | None) -> list[bytes]:
    """Words of ASCII letters and digits and of all other letters and signs."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    #: Least share that must be covered; a phrase and an identifier are covered whole.
    share: float
    base: bool = False


def templates() -> list[Template]:
    """Phrases of the base first, then notices and identifiers, then texts."""
    found = [Template(label, tuple(licence_words(p)), 1.0, True) for p, label in PHRASES.items()]
    found += [Template(label, tuple(licence_words(p)), 1.0) for p, label in NOTICES.items()]
    tag = "SPDX-License-Identifier: "
    found += [Template(label, tuple(licence_words(tag + name)), 1.0) for name, label in IDENTIFIERS.items()]
    return found + [Template(label, tuple(licence_words(text)), LEAST_SHARE) for label, text in TEXTS]


@dataclass(frozen=True)
class Span:
    """Words ``first`` to before ``end`` hold ``covered`` words of a template."""

    label: str
    first: int
    end: int
    covered: int
    share: float
    base: bool


class Automaton:
    """Generalised suffix automaton of the words of several texts.

    A state stands for runs of words that end at the same places. ``next`` leads
    on by a word, ``link`` to the state of the longest run that ends alike but at
    more places, ``length`` is the length of a state's longest run.
    """

    def __init__(self, texts: list[tuple[bytes, ...]]):
        self.word: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in texts:
            last = 0
            for word in words:
                last = self._add(last, self.word.setdefault(word, len(self.word)))

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: int, to: int) -> int:
        """A state for those runs of ``to`` that are no longer than by ``state`` and
        ``word``: they have a place more than the others."""
        twin = self._state(self.length[state] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = twin
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = twin
            state = self.link[state]
        return twin

    def _add(self, last: int, word: int) -> int:
        to = self.next[last].get(word)
        if to is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            to = self.next[state][word]
            self.link[new] = to if self.length[to] == self.length[state] + 1 else self._split(state, word, to)
        return new

    def path(self, words: tuple[bytes, ...]) -> list[int]:
        """The states passed on reading a run that stands in a text."""
        states, state = [], 0
        for word in words:
            state = self.next[state][self.word[word]]
            states.append(state)
        return states

    def by_length(self) -> list[int]:
        """All states but the first, each after the one it links to."""
        return sorted(range(1, len(self.next)), key=self.length.__getitem__)

    def matches(self, words: list[bytes], least: int, marked: list[bool]) -> tuple[list, list]:
        """The matching statistics where they matter, as (end, length, state): runs
        of at least so many words that stand in a text and cannot be made longer on
        either side, and every place at which a marked state is reached."""
        find, step, link, full = self.word.get, self.next, self.link, self.length
        runs, reached = [], []
        state = length = 0
        for i, word in enumerate(words):
            number = find(word)
            if number is None:
                if length:
                    if length >= least:
                        runs.append((i, length, state))
                    state = length = 0
                continue
            to = step[state].get(number)
            if to is None:
                if length >= least:
                    runs.append((i, length, state))
                while to is None:  # every known word leads on from the first state
                    state = link[state]
                    to = step[state].get(number)
                length = full[state]
            state = to
            length += 1
            if marked[state]:
                reached.append((i + 1, length, state))
        if length >= least:
            runs.append((len(words), length, state))
        return runs, reached


def chains(anchors: list[tuple[int, int, int]], gap: int) -> Iterator[tuple[int, int, int]]:
    """(first, end, covered) of chains of anchors (place in the document, place in
    the template, words), the best first; each anchor is in one chain.

    In a chain both places rise, with at most ``gap`` words between anchors; words
    that two anchors share count once. Ends rise with places, so only anchors of a
    bounded stretch before are looked at.
    """
    score, back, start = [], [], 0
    for i, (place, spot, n) in enumerate(anchors):
        while anchors[start][0] + anchors[start][2] < place - gap:
            start += 1
        best, before = n, -1
        for j in range(start, i):
            place_j, spot_j, n_j = anchors[j]
            if place_j < place and spot_j < spot and spot - spot_j - n_j <= gap:
                shared = max(0, place_j + n_j - place, spot_j + n_j - spot)
                if shared < n and score[j] + n - shared > best:
                    best, before = score[j] + n - shared, j
        score.append(best)
        back.append(before)
    used = [False] * len(anchors)
    for i in sorted(range(len(anchors)), key=lambda i: (-score[i], i)):
        if used[i]:
            continue
        j, last = i, i
        while j >= 0 and not used[j]:
            used[j] = True
            last, j = j, back[j]
        yield anchors[last][0], anchors[i][0] + anchors[i][2], score[i] - (score[j] if j >= 0 else 0)


class Licences:
    """Spans of licence texts in the words of documents."""

    def __init__(self, found: list[Template], least_run: int = LEAST_RUN, gap: int = GAP):
        self.templates, self.gap = found, gap
        self.least = least_run
        automaton = self.automaton = Automaton([t.words for t in found])
        #: Per state: templates that end in each of its runs, if the run is no
        #: shorter; and where its runs end in templates that are chained.
        self.whole: list[list[int]] = [[] for _ in automaton.next]
        self.ends: list[list[tuple[int, int]]] = [[] for _ in automaton.next]
        for k, template in enumerate(found):
            path = automaton.path(template.words)
            if template.share == 1:
                self.whole[path[-1]].append(k)
            else:
                # Reading from the start passes the states of all beginnings.
                for i, state in enumerate(path):
                    self.ends[state].append((k, i + 1))
        states = automaton.by_length()
        for s in states:
            self.whole[s] = self.whole[s] + self.whole[automaton.link[s]]
        for s in reversed(states):
            if automaton.length[automaton.link[s]] >= least_run:
                self.ends[automaton.link[s]] = self.ends[automaton.link[s]] + self.ends[s]
        self.marked = [bool(w) for w in self.whole]

    def spans(self, words: list[bytes]) -> tuple[list[Span], float]:
        """All spans by place, and the greatest share of a template that is covered,
        also by a chain too small for a span."""
        runs, reached = self.automaton.matches(words, self.least, self.marked)
        out = []
        for end, length, state in reached:
            for template in (self.templates[k] for k in self.whole[state]):
                n = len(template.words)
                if n <= length:
                    out.append(Span(template.label, end - n, end, n, 1.0, template.base))
        anchors: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for end, length, state in runs:
            for k, spot in self.ends[state]:
                anchors[k].append((end - length, spot - length, length))
        score, found = 1.0 if out else 0.0, []
        for k, own in anchors.items():
            template = self.templates[k]
            for first, end, covered in chains(sorted(own), self.gap):
                share = covered / len(template.words)
                score = max(score, share)
                if share >= template.share:
                    found.append(Span(template.label, first, end, covered, share, False))
        return sorted(out + _distinct(found), key=lambda s: (s.first, s.end, s.label)), score


def _distinct(spans: list[Span]) -> list[Span]:
    """Texts that share most of their words are found together: of spans that lie
    on each other the one that covers most stays, and its whole template first."""
    kept: list[Span] = []
    open_spans: list[Span] = []
    # Groups of spans that touch, so that work stays within a group.
    end = -1
    for span in sorted(spans, key=lambda s: s.first):
        if span.first >= end:
            kept += _best(open_spans)
            open_spans = []
        open_spans.append(span)
        end = max(end, span.end)
    return kept + _best(open_spans)


def _best(spans: list[Span]) -> list[Span]:
    kept: list[Span] = []
    for span in sorted(spans, key=lambda s: (-s.covered, -s.share, s.first, s.label)):
        over = [min(span.end, o.end) - max(span.first, o.first) for o in kept]
        if all(n <= MOST_OVERLAP * (span.end - span.first) for n in over):
            kept.append(span)
    return kept


@lru_cache(maxsize=1)
def licences() -> Licences:
    """One automaton per worker process."""
    return Licences(templates())


def licensed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, spans, score of every document.

    ``spans`` lists label, first and end word, covered words of the licence text,
    their share of it, and whether it is a phrase of the base; several may lie on
    one place. ``score`` is the greatest share of any licence text that a chain
    covers, 0 without a run of four words of one.

    Defined cases: a null or empty text has no words, spans or score; a document of
    any length is read once, from start to end; repeated rows and ties give equal
    rows; null doc_ids stay null; no rows give no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    span = pa.struct(
        [("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("share", pa.float64()), ("base", pa.bool_())]
    )
    schema = (
        f"doc_id {kind}, n_words long, "
        "spans array<struct<label: string, first: long, end: long, covered: long, share: double, base: boolean>>, score double"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = licences()
        for batch in batches:
            counts, spans, scores = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                words = licence_words(text.as_py())
                found, score = own.spans(words)
                counts.append(len(words))
                spans.append([vars(s) for s in found])
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(scores, pa.float64())],
                names=["doc_id", "n_words", "spans", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(scan, schema)
