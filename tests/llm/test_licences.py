"""Licence spans against brute force, and changed, cut and repeated licence texts."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from guestlens.llm import licences
from guestlens.llm.catalog import QUERIES
from tests.llm.fixtures import documents, rows, saved

GIVEN = "/root/testdata/sf0.001"
OWN = licences.licences()
TEXTS = [(label, text) for label, text in licences.TEXTS]
PROSE = "it was a cold day and the wind blew over the hills as we walked to the old mill by the river".split()


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base(text):
    own = words(text)
    found = []
    for phrase, label in licences.PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(own)) if own[i : i + len(p)] == p]
    return found


def brute(doc_id, text):
    found = base(text)
    starts = [i for i, _ in found]
    return (doc_id, len(words(text)), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({k for _, k in found})))


@pytest.mark.parametrize("case", ["fixture", "given", "given_hundredth", "empty"])
def test_base_equals_brute_force(spark, tmp_path, case):
    if case.startswith("given"):
        folder = GIVEN if case == "given" else "/root/testdata/sf0.01"
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    else:
        values = [] if case == "empty" else [*rows(), *((900 + i, t, None, None, 0) for i, (_, t) in enumerate(TEXTS))]
        folder = saved(documents(spark, values), tmp_path)
        docs = [v[:2] for v in values]
    found = QUERIES["op11_scan_licences"](spark, folder).collect()
    assert sorted((tuple(r)[:6] for r in found), key=repr) == sorted((brute(*d) for d in docs), key=repr)
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 0 or r.n_words)


def labels(text):
    spans, score = OWN.spans(licences.licence_words(text))
    return sorted({s.label for s in spans if not s.base}), score


@pytest.mark.parametrize("label,text", TEXTS, ids=[f"{label}{k}" for k, (label, _) in enumerate(TEXTS)])
def test_a_licence_inside_prose(label, text):
    spans, score = OWN.spans(licences.licence_words(" ".join([*PROSE, text.upper(), *PROSE])))
    own = [s for s in spans if not s.base and s.share == 1 and s.label == label]
    assert score == 1
    assert any((s.first, s.end) == (len(PROSE), len(PROSE) + len(words(text))) for s in own)
    assert {s.label for s in spans if s.covered > 10} == {label}


@pytest.mark.parametrize("label,text", [t for t in TEXTS if len(t[1].split()) > 60], ids=lambda x: x[:8])
def test_changed_words_are_bridged(label, text):
    own = words(text)
    changed = [w if i % 11 else f"other{i}" for i, w in enumerate(own)]
    dropped = [w for i, w in enumerate(own) if i % 13]
    for some in (changed, dropped):
        spans, score = OWN.spans(some_words := [w.encode() for w in some])
        chained = [s for s in spans if s.covered > 20]
        assert [s.label for s in chained] == [label] and 0.6 <= chained[0].share < 1 and score >= chained[0].share
        assert chained[0].end - chained[0].first > 0.9 * len(some_words)


def test_copies_in_one_document_are_separate_spans():
    text = " ".join(PROSE).join(["", *[TEXTS[0][1] + " "] * 50])
    spans, _ = OWN.spans(licences.licence_words(text))
    own = [s for s in spans if s.label == "mit" and s.covered > 100]
    assert len(own) == 50 and all(a.end <= b.first for a, b in zip(own, own[1:]))


def test_a_part_of_a_licence_is_scored_but_not_labelled():
    found, score = labels(" ".join(words(TEXTS[0][1])[:40]))
    assert found == [] and 0.1 < score < 0.6


def test_identifiers_and_notices():
    assert labels("# SPDX-License-Identifier: BSD-3-Clause") == (["bsd"], 1.0)
    assert labels("under the GNU Lesser General Public License v3")[0] == ["lgpl"]
    assert labels("SPDX License MIT") == ([], 0.0)
    assert labels("Creative Commons Attribution-ShareAlike 4.0 International")[0] == ["cc-by-sa"]


def test_prose_is_left_alone():
    rng = random.Random(0)
    vocabulary = sorted({w for _, t in TEXTS for w in words(t)})
    for k in range(20):
        assert labels(" ".join(rng.choices(vocabulary if k % 2 else PROSE, k=2000)))[0] == []


def test_phrases_overlap_and_repeat():
    spans, _ = OWN.spans(licences.licence_words("MIT license mit LICENSE; apache license, cc-by cc by"))
    assert [(s.first, s.label) for s in spans if s.base] == [(0, "mit"), (2, "mit"), (4, "apache"), (6, "cc-by"), (8, "cc-by")]


def test_clashing_columns_are_ignored(spark):
    docs = documents(spark)
    for name in ("n_words", "spans", "score", "label", "first"):
        docs = docs.withColumn(name, docs.lang)
    found, plain = licences.licensed(docs), licences.licensed(documents(spark))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))


LETTERS = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14)


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS.map(tuple), min_size=1, max_size=4), LETTERS, st.integers(1, 4))
def test_matching_statistics(texts, document, least):
    """Runs are those of the definition: the longest at their end, not longer at the next."""
    automaton = licences.Automaton(texts)
    parts = {t[i:j] for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    longest = [max((n for n in range(1, i + 2) if tuple(document[i + 1 - n : i + 1]) in parts), default=0) for i in range(len(document))]
    runs, reached = automaton.matches(document, least, [True] * len(automaton.next))
    assert [(e, n) for e, n, _ in runs] == [
        (i + 1, n) for i, n in enumerate(longest) if n >= least and (i + 1 == len(longest) or longest[i + 1] <= n)
    ]
    assert [(e, n) for e, n, _ in reached] == [(i + 1, n) for i, n in enumerate(longest) if n]


ANCHORS = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), st.integers(1, 5)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(ANCHORS)
def test_the_first_chain_is_the_best(anchors):
    """Against all chains, for anchors whose ends rise with their places."""
    by_place = {}
    for place, spot, n in sorted(anchors):
        by_place.setdefault(place, (spot, n))
    own, end = [], 0
    for place, (spot, n) in sorted(by_place.items()):
        if place + n > end:
            own.append((place, spot, n))
            end = place + n

    def after(i):
        best = own[i][2]
        for j in range(i):
            (p, s, n), (q, t, m) = own[j], own[i]
            shared = max(0, p + n - q, s + n - t)
            if s < t and shared < m and q - p - n <= 10 and t - s - n <= 10:
                best = max(best, after(j) + m - shared)
        return best

    found = list(licences.chains(own, 10))
    assert (found[0][2] if found else 0) == max((after(i) for i in range(len(own))), default=0)
