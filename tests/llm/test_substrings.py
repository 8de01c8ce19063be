"""Removal of repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from guestlens.llm import substrings
from guestlens.llm.catalog import QUERIES
from tests.llm.fixtures import documents, rows, saved, words

GIVEN = "/root/testdata/sf0.001"


def cut(docs, window=35):
    """(doc_id, n_words, kept words) in order of docs."""
    texts = [words(t) for _, t in docs]
    starts = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), [x for i, x in enumerate(w) if i not in gone]))
    return out


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in row)


@pytest.mark.parametrize("which", ["fixture", "given", "empty"])
def test_query(spark, tmp_path, which):
    if which == "given":
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{GIVEN}/documents.parquet").collect()]
        folder = GIVEN
    else:
        values = [] if which == "empty" else rows()
        docs, folder = [v[:2] for v in values], saved(documents(spark, values), tmp_path)
    found = QUERIES["op3_remove_repeated_passages"](spark, folder).collect()
    wanted = [(d, n, n - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for d, n, k in cut(docs)]
    assert sorted((tuple(r) for r in found), key=key) == sorted(wanted, key=key)


@pytest.mark.parametrize("window,seed", [(5, 1), (4, 2), (1, 3), (2, 4), (35, 5)])
def test_repeats_at_every_offset(spark, window, seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(window + 9)]
    docs = []
    for d in range(60):
        w = [f"u{d}x{i}" if rng.random() < 0.7 else rng.choice("ab") for i in range(rng.randrange(4 * window))]
        if rng.random() < 0.5:
            start, at = rng.randrange(9), rng.randrange(len(w) + 1)
            w[at:at] = passage[start : start + rng.choice([window - 1, window, window + 3])]
        docs.append((d, " ".join(w)))
    table = documents(spark, [(d, t, None, None, None) for d, t in docs])
    found = substrings.without_repeats(table, window, shard_bytes=400)
    got = sorted((r.doc_id, r.n_words, r.kept_text) for r in found.collect())
    assert got == sorted((d, n, " ".join(k)) for d, n, k in cut(docs, window))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 12))
def test_window_hashes_tell_windows_apart(letters, size):
    hashes = substrings.window_hashes(np.array(letters, dtype=np.uint64) * np.uint64(77), size)
    runs = [tuple(letters[i : i + size]) for i in range(len(letters) - size + 1)]
    assert len(hashes) == len(runs)
    assert len(set(runs)) == len(set(zip(runs, hashes.tolist()))) == len(set(hashes.tolist()))


def test_buckets_cover_the_set_in_order():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2)
    sent = substrings.Sent.of(keys, np.zeros(500, np.uint32), np.ones(500, bool))
    for buckets in (1, 3, 64):
        cuts = sent.cuts(buckets)
        assert cuts[0] == 0 and cuts[-1] == len(sent.key) and (np.diff(cuts) >= 0).all()
        table = sent.rows(9, buckets, True)
        assert b"".join(table.column("keys").to_pylist()) == sent.key.tobytes()


def test_equal_rows_are_dealt_once(spark):
    """A third of all rows are one row: a task holds it once, and it comes out whole."""
    rng = random.Random(6)
    same = " ".join(f"s{i}" for i in range(60))
    part = " ".join(f"s{i}" for i in range(20, 45))
    docs = [(7, same)] * 300 + [(8, "too short")] * 5 + [(None, None)] * 3
    docs += [(100 + d, " ".join(f"u{d}x{i}" for i in range(rng.randrange(50))) + f" {part if d % 2 else ''}") for d in range(300)]
    table = documents(spark, [(d, t, None, None, None) for d, t in docs])
    rows_ = substrings._different(table).collect()
    assert len(rows_) == 303 and sum(r.copies for r in rows_) == 608
    found = substrings.without_repeats(table, 20, shard_bytes=400)
    got = [(r.doc_id, r.n_words, r.kept_text) for r in found.collect()]
    assert sorted(got, key=key) == sorted(((d, n, " ".join(k)) for d, n, k in cut(docs, 20)), key=key)
