import pytest
from pyspark.sql import functions as F

from guestlens.operators import rows as operators
from guestlens.operators.rows import fits_bits, hot_keys, insert_if_absent, keep_first, lookup, mark_present, may_contain


def skewed(spark, n=6_000):
    """A third of all rows has key 0, another sixth key 1, the rest is spread;
    some keys are null or unknown to the table."""
    return spark.range(n).selectExpr(
        "id AS row",
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 6 = 1 THEN 1 WHEN id % 60 = 2 THEN null ELSE id % 97 END AS key",
        "id * 7 % 11 AS value",
    )


def table(spark):
    return spark.range(60).selectExpr("id AS key", "concat('name ', id) AS name")


HOWS = ["inner", "left", "left_semi", "left_anti"]


@pytest.fixture(params=["10m", "-1"])
def threshold(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def shuffled(spark):
    """No broadcasts and no adaptive execution: what a split key must do by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("how", HOWS)
def test_lookup_equals_a_plain_join(spark, how, threshold):
    rows = skewed(spark)
    expected = sorted(map(str, rows.join(table(spark), "key", how).collect()))
    found = lookup(rows, table(spark), "key", how, hot=hot_keys(rows, ["key"], 100), row_id="row")
    assert found.columns == rows.join(table(spark), "key", how).columns
    assert sorted(map(str, found.collect())) == expected


@pytest.mark.parametrize("how", HOWS)
def test_equal_rows_maps_and_stored_rows(spark, how, threshold, tmp_path):
    """Rows without an id, a third of them equal, with a column that has no hash."""
    rows = skewed(spark).selectExpr("key", "map(key % 2 = 0, 1) AS m").where("key IS NOT NULL")
    rows.unionByName(spark.sql("SELECT CAST(null AS BIGINT) AS key, map(true, 1) AS m")).write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    expected = sorted(map(str, stored.join(table(spark), "key", how).collect()))
    found = lookup(stored, table(spark), "key", how, hot=hot_keys(stored, ["key"], 100))
    assert sorted(map(str, found.collect())) == expected


def sizes(df, where):
    return sorted(r["count"] for r in df.where(where).groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_hot_key_is_split_over_many_tasks(spark, shuffled):
    rows = skewed(spark)
    found = lookup(rows, table(spark), "key", hot=hot_keys(rows, ["key"], 100), row_id="row")
    assert len(sizes(found, "key = 0")) > 4


def test_equal_rows_of_a_hot_key_are_split(spark, shuffled, tmp_path):
    spark.range(6_000).selectExpr("0L AS key", "1 AS v").write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    found = lookup(stored, table(spark), "key", hot=hot_keys(stored, ["key"], 100))
    assert len(sizes(found, "true")) > 4 and found.count() == 6_000


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_rows_without_a_key_are_spread(spark, shuffled, how):
    rows = spark.range(9_000).selectExpr("id AS row", "CASE WHEN id % 3 > 0 THEN id % 50 END AS key")
    found = lookup(rows, table(spark), "key", how, hot=hot_keys(rows, ["key"]), row_id="row")
    per_task = sizes(found, "key IS NULL")
    assert sum(per_task) == 3_000 and len(per_task) == 8 and per_task[-1] < 2 * per_task[0]


def test_every_hot_key_is_split(spark, shuffled):
    rows = spark.range(30_000).selectExpr("id AS row", "id % 1500 AS key")
    many = spark.range(1_500).selectExpr("id AS key", "id AS name")
    hot = hot_keys(rows, ["key"], 10)
    assert hot.count() == 1_500 and {r._splits for r in hot.collect()} == {2}
    assert lookup(rows, many, "key", hot=hot, row_id="row").count() == 30_000


def test_hot_keys_are_those_above_the_limit(spark):
    hot = {r.key: r._splits for r in hot_keys(skewed(spark), ["key"], 500).collect()}
    assert set(hot) == {0, 1}
    assert hot[0] == 5  # 2,062 rows: a third, and every 97th of the rest


def test_keep_first_with_a_hot_key(spark):
    df = skewed(spark).where("key IS NOT NULL").repartition(7)
    found = {r.key: r.row for r in keep_first(df, ["key"], "row").collect()}
    expected = {}
    for r in sorted(df.collect(), key=lambda r: r.row):
        expected.setdefault(r.key, r.row)
    assert found == expected


def test_keep_first_keeps_a_row_whole(spark):
    df = spark.createDataFrame([(1, 2, None, "late"), (1, 1, None, "first"), (2, 1, "x", None)], "k int, o int, a string, b string")
    assert sorted(map(tuple, keep_first(df, ["k"], "o").collect())) == [(1, 1, None, "first"), (2, 1, "x", None)]
    assert keep_first(df, ["k"], "o", keep_order=False).columns == ["k", "a", "b"]


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    incoming = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (None, "none")], "k int, v string")
    added = insert_if_absent(incoming, target, ["k"], "v")
    assert [tuple(r) for r in added.collect()] == [(2, "a")]


def test_semi_and_anti_add_up(spark):
    rows = skewed(spark)
    parts = [lookup(rows, table(spark), "key", how, row_id="row").count() for how in ("left_semi", "left_anti")]
    assert sum(parts) == rows.count()


def test_keys_of_other_types_zeros_and_pairs(spark, tmp_path):
    """Keys compare as in a join, whatever their types, before and after the filter."""
    target = spark.sql("SELECT * FROM VALUES (CAST(1 AS INT), 0.0D), (2, 5D), (3, double('NaN')) AS t(k, d)")
    incoming = spark.sql("SELECT * FROM VALUES (1L, -0.0D, 1), (3000000000L, 5D, 2), (3L, double('NaN'), 3), (2L, 6D, 4) AS t(k, d, o)")
    for key in (["k"], ["d"], ["k", "d"]):
        fresh = keep_first(incoming, key, "o")
        wanted = fresh.join(target.select(*key), key, "left_anti")
        found = insert_if_absent(incoming, target, key, "o")
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_the_filter_loses_no_key_and_lets_few_others_through(spark, monkeypatch):
    rows, wanted = spark.range(200_000).selectExpr("id AS key"), spark.range(0, 400_000, 400).selectExpr("id AS key")
    assert 500 <= may_contain(rows, wanted, ["key"]).count() < 520
    monkeypatch.setattr(operators, "FILTER_BITS", 1 << 14)
    kept = may_contain(rows, wanted, ["key"])
    assert kept.count() < 20_000
    assert kept.join(wanted, "key").count() == 500
    monkeypatch.setattr(operators, "FILTER_BITS", 64)
    found = insert_if_absent(wanted.withColumn("o", F.lit(1)), rows, ["key"], "o")
    assert sorted(r.key for r in found.collect()) == list(range(200_000, 400_000, 400))


def test_an_append_does_not_move_the_target(spark, tmp_path):
    """A target with one key in a third of its rows: no task reads them shuffled."""
    skewed(spark, 300_000).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    incoming = spark.range(50).selectExpr("id * 3 AS key", "id AS o")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = insert_if_absent(incoming, target, ["key"], "o")
        tree = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # From the scan upwards: the filter's join and the distinct keys, then the exchange.
        above = tree[: tree.index("FileScan parquet")].splitlines()[::-1]
        steps = [s for line in above for s in ("BroadcastHashJoin", "HashAggregate", "Exchange hashpartitioning") if s in line]
        assert steps[:3] == ["BroadcastHashJoin", "HashAggregate", "Exchange hashpartitioning"]
        assert sorted(r.key for r in found.collect()) == [3 * i for i in range(50) if 3 * i > 96]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marks_of_present_keys_are_exact_and_move_no_row(spark):
    ids = [-(2**31), -65, -64, -1, 0, 1, 63, 64, 2**31 - 1]
    table = spark.createDataFrame([(i,) for i in [*ids, 0, None]], "key int")
    probes = sorted({j for i in ids for j in (i - 1, i, i + 1) if -(2**31) <= j < 2**31})
    rows = spark.createDataFrame([(i,) for i in [*probes, None]], "key int")
    marked = mark_present(rows, table, "key", "known")
    assert {r.key: r.known for r in marked.collect()} == {i: i in ids for i in [*probes, None]}
    assert marked.count() == len(probes) + 1
    tree = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree


def test_keys_far_apart_are_not_broadcast_as_bits(spark, monkeypatch):
    near, far = spark.range(640), spark.range(640).selectExpr("id * 64 AS id")
    monkeypatch.setattr(operators, "FILTER_BITS", 64 * 10)
    assert fits_bits(near, "id") and not fits_bits(far, "id")
