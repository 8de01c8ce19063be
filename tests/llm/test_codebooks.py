"""Vector codes against a brute force with Python's whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from guestlens.llm import codebooks

SCHEMA = "vec_id long, embedding array<double>, label string"


def square(x, y):
    return sum((a - b) ** 2 for a, b in zip(x, y))


def brute(rows, parts=16, entries=64, rounds=2):
    """[(vec_id, code, error, label_error)], text of the books."""
    rows = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(rows[0][1]) if rows else 0
    rows = [r for r in rows if len(r[1]) == dims]
    width = dims // parts
    cut = [[[math.floor(256 * c) for c in r[1][p * width : (p + 1) * width]] for p in range(parts)] for r in rows]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    best = lambda x, book: min((square(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [best(v[p], books[p])[1] for v in cut]
            for k in set(own):
                used = [v[p] for v, o in zip(cut, own) if o == k]
                books[p][k] = [sum(c) // len(used) for c in zip(*used)]
    found = [[best(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(far for far, _ in f) for f in found]
    of_label = {}
    for r, e in zip(rows, errors):
        of_label[r[2]] = of_label.get(r[2], 0) + e
    text = ",".join(str(c) for book in books for e in book for c in e)
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, of_label[r[2]]) for r, f, e in zip(rows, found, errors)], text


def compared(spark, rows, **settings):
    found, books = codebooks.compressed(spark.createDataFrame(rows, SCHEMA), **settings)
    ours = [(r.vec_id, "".join(f"{c:02x}" for c in r.codes), r.error, r.label_error) for r in found.collect()]
    wanted, text = brute(rows, **settings)
    assert sorted(ours, key=repr) == sorted(wanted, key=repr)
    assert books.digest() == hashlib.sha256(text.encode()).hexdigest()


def vectors(n, dims, seed=0, scale=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, scale) for _ in range(dims)], rng.choice(["a", "b", None])) for i in range(n)]


@pytest.mark.parametrize("dims", [16, 48, 80])
def test_codes_equal_brute_force(spark, dims):
    """Parts of 1, 3 and 5 components, of which the last two are padded."""
    compared(spark, vectors(300, dims))


def test_ties_and_repeated_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 1 / 256, -1 / 256]) for _ in range(32)], None) for i in range(200)]
    compared(spark, rows + rows[:50] + [(None, [0.0] * 32, "x")])


def test_nulls_and_odd_vectors_are_left_out(spark):
    rows = vectors(90, 32)
    rows += [(500, None, "a"), (501, [None] + [0.0] * 31, "a"), (502, [math.nan] * 32, "b"), (503, [math.inf] + [0.0] * 31, "b"), (504, [], None), (505, [1.0] * 16, "a")]
    compared(spark, rows)
    found, _ = codebooks.compressed(spark.createDataFrame(rows, SCHEMA))
    assert found.where("vec_id >= 500").count() == 0


def test_few_and_no_vectors(spark):
    compared(spark, vectors(5, 16))
    compared(spark, [])
    compared(spark, [(1, None, None)])


def test_large_components_stay_exact(spark):
    rows = vectors(100, 32, scale=1e6)
    compared(spark, rows)
    compared(spark, vectors(80, 32) + [(1000, [1e7] * 32, "a"), (1001, [-1e7 - 0.004] * 32, None)])
    found, _ = codebooks.compressed(spark.createDataFrame([(i, [(-1) ** i * 1e300] * 16, "a") for i in range(70)], SCHEMA), entries=1)
    assert {r.label_error for r in found.collect()} == {2**63 - 1}


def test_other_settings(spark):
    compared(spark, vectors(120, 24), parts=4, entries=7, rounds=3)
    compared(spark, vectors(40, 5), parts=1, entries=9, rounds=1)


def test_vectors_that_cannot_be_cut(spark):
    with pytest.raises(ValueError, match="equal parts"):
        codebooks.compressed(spark.createDataFrame(vectors(3, 17), SCHEMA))


def test_a_hot_label_and_clashing_columns(spark):
    rows = vectors(400, 16)
    wide = spark.createDataFrame(rows, SCHEMA)
    for name in ("codes", "error", "label_name", "label_error", "part", "n", "sum"):
        wide = wide.withColumn(name, F.lit("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = codebooks.compressed(wide)[0].collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.vec_id, r.error, r.label_error) for r in found) == sorted((r[0], r[2], r[3]) for r in brute(rows)[0])


def test_rows_of_the_transform_change_ever_more_often():
    for size in (1, 2, 4, 8, 64):
        matrix = codebooks.walsh(size)
        assert (np.abs(np.diff(matrix, axis=1)).sum(1) // 2).tolist() == list(range(size))
        assert (matrix @ matrix.T == size * np.eye(size, dtype=int)).all()


NUMBER = st.integers(-(2**20), 2**20)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9).flatmap(lambda n: st.tuples(
    st.lists(st.lists(NUMBER, min_size=n, max_size=n), min_size=1, max_size=20),
    st.lists(st.lists(st.integers(-3, 3), min_size=n, max_size=n), min_size=1, max_size=12),
)))
def test_nearest_is_exact(case):
    parts, entries = case
    parts += entries
    for kind in (np.int64, object):
        index, far = codebooks.nearest(np.array(parts, kind), np.array(entries, kind))
        wanted = [min((square(x, e), k) for k, e in enumerate(entries)) for x in parts]
        assert list(zip(far.tolist(), index.tolist())) == wanted
