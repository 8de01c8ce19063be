"""What the physical plans must and must not contain."""

import re

import pytest

from guestlens.operators.rows import keep_first, lookup
from guestlens.plans import catalog, kpis, star

FOLDER = "/root/testdata/sf0.001"
# Queries whose result is a plan; the others return tables they have written.
LAZY = [n for n in catalog.QUERIES if n not in ("full_run_from_files", "full_run_report", "refresh_cascade", "load_ledger")]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    for bad in ("Python", "Pandas", "Cartesian", "NestedLoop"):
        assert bad not in text


@pytest.mark.parametrize("name", [n for n in LAZY if n.startswith("kpi_") and n != "kpi_coverage"])
def test_sums_are_taken_before_the_shuffle(spark, name):
    assert "partial_sum" in plan(catalog.QUERIES[name](spark, FOLDER))


def test_only_needed_columns_are_read(spark):
    text = plan(catalog.QUERIES["kpi_groups_city"](spark, FOLDER))
    line_scan = next(s for s in re.findall(r"ReadSchema: (.*)", text) if "l_orderkey" in s)
    assert line_scan == "struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>"


def test_filters_reach_the_scan(spark, tmp_path):
    star.reviews(spark, FOLDER).write.parquet(str(tmp_path / "r"))
    reviews = spark.read.parquet(str(tmp_path / "r"))
    drivers = kpis.profile_drivers(reviews, star.users(spark, FOLDER), star.lodging_types(spark, FOLDER))
    assert "PushedFilters: [IsNotNull(rating_overall)" in plan(drivers)


def test_reviews_are_shuffled_once_for_the_groups(spark, tmp_path):
    """One exchange of sums by lodging, one of the lodgings, one by group."""
    star.reviews(spark, FOLDER).write.parquet(str(tmp_path / "r"))
    star.lodgings(spark, FOLDER).write.parquet(str(tmp_path / "l"))
    sums = kpis.lodging_sums(spark.read.parquet(str(tmp_path / "r")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(kpis.group_drivers(sums, spark.read.parquet(str(tmp_path / "l"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("\n\n")[0]
    assert len(re.findall(r"\bExchange \(", tree)) == 3


def test_keep_first_reduces_before_the_shuffle(spark):
    lines = star.table(spark, FOLDER, "lineitem")
    tree = plan(keep_first(lines, ["l_orderkey"], "l_linenumber"))
    assert "partial_min_by" in tree


def test_small_tables_are_broadcast_and_large_ones_are_not(spark):
    orders, customers = star.table(spark, FOLDER, "orders"), star.table(spark, FOLDER, "customer")
    customers = customers.withColumnRenamed("c_custkey", "o_custkey")
    assert "BroadcastHashJoin" in plan(lookup(orders, customers, "o_custkey", row_id="o_orderkey"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")
    try:
        text = plan(lookup(orders, customers, "o_custkey", row_id="o_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Limit" not in text


def test_a_shuffled_lookup_reads_only_what_it_needs(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalog.QUERIES["orphan_counts"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = set(re.findall(r"ReadSchema: struct<(.*)>", text))
    # Spark adds a column of its own for the row number in the file, which it makes up.
    assert {s.replace(",_tmp_metadata_row_index:bigint", "") for s in scans if "o_" in s} == {"o_custkey:bigint"}
