"""Near duplicates and components against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from guestlens.llm import neardups
from guestlens.llm.catalog import QUERIES
from guestlens.llm.components import components, forest
from tests.llm.fixtures import documents, rows, saved

GIVEN = "/root/testdata/sf0.001"


def shingles(text, size=3):
    found = (text or "").encode().lower().split()
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1)) or frozenset([tuple(found)])


def grouped(docs, size=3, percent=85):
    """(doc_id, n_shingles, component) in order of docs, all pairs compared."""
    sets = [shingles(t, size) for _, t in docs]
    top = list(range(len(docs)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                top[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            smallest[find(i)] = min(d, smallest.get(find(i), d))
    return [(d, len(sets[i]), smallest.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def chained(n=220, seed=1):
    """Copies of copies, each with a few words changed: neighbours are linked,
    distant ones are not. Some families stop short of a link."""
    rng = random.Random(seed)
    out, words = [], [f"v{i}" for i in range(120)]
    for k in range(n):
        words = list(words)
        for _ in range(rng.choice([1, 1, 2, 3, 9])):
            words[rng.randrange(len(words))] = f"n{k}{rng.randrange(9)}"
        out.append((k, " ".join(words)))
        if k % 50 == 49:
            words = [f"f{k}w{i}" for i in range(rng.choice([6, 40, 120]))]
    return out


@pytest.mark.parametrize("which", ["fixture", "given", "chained", "empty"])
def test_groups(spark, tmp_path, which):
    if which == "given":
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{GIVEN}/documents.parquet").collect()]
        folder = GIVEN
    else:
        values = {"empty": [], "fixture": rows(), "chained": [(d, t, "en", "s", 0) for d, t in chained()]}[which]
        docs = [v[:2] for v in values]
        folder = saved(documents(spark, values), tmp_path)
    found = QUERIES["op9_near_duplicates"](spark, folder).collect()
    wanted = grouped(docs)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted((tuple(r)[:3] for r in found), key=key) == sorted(wanted, key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_blocks_of_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardups, "TOGETHER", 16)
    docs = chained(150, seed=3)
    found = neardups.near_duplicates(documents(spark, [(d, t, None, None, None) for d, t in docs]), 3, 85)
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == sorted((d, c) for d, _, c in grouped(docs))


def test_trees_join_all_that_is_similar_in_a_bucket():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**16, 128).astype("<u2")
    group = []
    for k in range(40):
        own = base.copy()
        own[rng.choice(128, 8, replace=False)] = rng.integers(0, 2**16, 8)
        group.append({"class": bytes([k]), "side": 2, "sketch": own.tobytes()})
    found = neardups._tree(100)(group)
    assert len(found) == 39 and len({top for _, top in forest(*zip(*found))}) == 1


def test_pairs_of_blocks_compare_across_only():
    sketch = np.zeros(128, "<u2").tobytes()
    one = np.array([1, 2], dtype=np.int64)
    group = [{"class": bytes([k]), "side": k % 2, "sketch": sketch, "root": bytes([k]), "shingles": one} for k in range(6)]
    for found in (neardups._tree(100)(group), neardups._across(100, 85)(group)):
        assert len(found) == 5 and all((a[0] - b[0]) % 2 for a, b in found)
    apart = [{**r, "shingles": np.array([k, 9], dtype=np.int64)} for k, r in enumerate(group)]
    assert neardups._across(100, 85)(apart) == []


def test_sketches_estimate_similarity_for_sets_of_any_size():
    rng = np.random.default_rng(2)
    for n in (1, 3, 20, 400):
        agree = []
        for _ in range(60):
            shared = rng.integers(0, 2**63, n).astype(np.uint64)
            a, b = (np.concatenate([shared, rng.integers(0, 2**63, n).astype(np.uint64)]) for _ in range(2))
            x, y, z = neardups.sketches([a, b, np.random.default_rng(0).permutation(a)])
            assert (x == z).all()
            agree.append((x == y).mean())
        assert np.mean(agree) == pytest.approx(1 / 3, abs=0.06)


def test_sketches_of_many_sets_equal_sketches_of_one():
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 700, 5, 128)]
    together = neardups.sketches(sets)
    assert all((together[i] == neardups.sketches([s])[0]).all() for i, s in enumerate(sets))


def _name(i):
    return hashlib.md5(str(i).encode()).digest()


@pytest.mark.parametrize("held", [3, 100_000])
def test_components(spark, held, monkeypatch):
    from guestlens.llm import components as module

    if held < 10:  # every link by itself: contraction alone must find them
        monkeypatch.setattr(module, "_shorter", lambda links: links)
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(300) if i % 40] + [(rng.randrange(400, 900), rng.randrange(400, 900)) for _ in range(300)]
    pairs.append((7, 7))
    links = spark.createDataFrame([(_name(a), _name(b)) for a, b in pairs], "a binary, b binary").repartition(6)
    found = {bytes(r.node): bytes(r.root) for r in components(links).collect()}
    wanted = dict(forest([_name(a) for a, _ in pairs], [_name(b) for _, b in pairs]))
    nodes = {_name(x) for p in pairs if p[0] != p[1] for x in p}
    assert set(found) == nodes
    assert {n: found[n] for n in nodes} == {n: wanted.get(n, n) for n in nodes}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_one_per_group_keeps_columns_and_one_row(spark):
    from tests.llm.fixtures import wide

    docs = wide(spark)
    found = neardups.one_per_group(docs, 3, 85)
    assert found.columns == docs.columns
    bare = sum(not shingles(r[1]) for r in rows())
    full = {c for (d, n, c), r in zip(grouped([r[:2] for r in rows()]), rows()) if n and c is not None}
    kept = found.collect()
    assert sum(not shingles(r.text) for r in kept) == bare
    worded = [r.doc_id for r in kept if shingles(r.text)]
    assert sorted(d for d in worded if d is not None) == sorted(full) and worded.count(None) == 1
