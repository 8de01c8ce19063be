from guestlens.operators.quality import parent_rule, reconcile, row_rules, table_report, unique_rule
from guestlens.schemas import TABLES
from pyspark.sql import functions as F


def counts(df):
    return {(r.rule, r.column_name): r.violations for r in df.collect()}


def test_row_rules(spark):
    df = spark.createDataFrame(
        [(1, "HOSTEL", 3, 999.99), (None, "it's", 9, 999.996), (2, None, 5, None)],
        "id int, kind string, stars int, rate double",
    )
    report = row_rules(
        df, "t", ["id", "kind"], {"kind": 5}, {"rate": "decimal(5,2)"},
        {"kind": ["HOSTEL", "it's"], "stars": [0, 3, 5]},
    )
    assert counts(report) == {
        ("required", "id"): 1, ("required", "kind"): 1, ("length", "kind"): 1,
        ("precision", "rate"): 1, ("domain", "kind"): 0, ("domain", "stars"): 1,
    }


def test_rules_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "id int")
    assert counts(row_rules(empty, "t", ["id"])) == {("required", "id"): 0}
    assert counts(unique_rule(empty, "t", ["id"])) == {("unique", "id"): 0}
    assert counts(parent_rule(empty, "t", "id", empty, "id")) == {("parent", "id"): 0}


def test_unique_counts_rows_beyond_the_first(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert counts(unique_rule(df, "t", ["a", "b"])) == {("unique", "a,b"): 2}


def test_parent_counts_rows_not_values(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert counts(parent_rule(child, "t", "k", parent, "id")) == {("parent", "k"): 3}


def test_table_report_uses_the_declared_rules(spark):
    table = TABLES["kpi_hostel_ranking"]
    row = (1, "3|HOSTEL|city|Rome", 9.0, 1, None, 3)
    df = spark.createDataFrame(
        [row, row],
        "id_hostel int, group_key string, avg_overall double, rank_in_group int, "
        "deviation_from_group double, review_count int",
    )
    hostels = spark.createDataFrame([(1,)], "id_hostel int")
    groups = spark.createDataFrame([("other",)], "group_key string")
    found = counts(table_report(df, table, {"stg_hostels": hostels, "kpi_equivalent_groups": groups}))
    assert found["required", "deviation_from_group"] == 2
    assert found["unique", "id_hostel"] == 1
    assert found["parent", "id_hostel"] == 0
    assert found["parent", "group_key"] == 2


def test_reconcile(spark):
    df = spark.range(990)
    assert tuple(reconcile(df, "t", F.lit(1000), 0.01).first()) == ("t", 990, 1000, True)
    assert not reconcile(df, "t", F.lit(1000), 0.009).first().within_tolerance
