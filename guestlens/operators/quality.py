"""Data-quality rules as one tidy report.

Each rule gives rows of (rule, table_name, column_name, violations). All
per-row rules of a table share one scan; uniqueness and parent links count per
key first, so a frequent key does not pile up in one task.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from guestlens.functions.text import literal
from guestlens.schemas import Table


def _report(rows: list[tuple[str, str, str, str]]) -> str:
    """Report rows of (rule, table, column, SQL for the violations) as text."""
    structs = [
        f"struct('{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name, "
        f"CAST({n} AS BIGINT) AS violations)"
        for rule, table, column, n in rows
    ]
    return f"inline(array({', '.join(structs)}))"


def row_rules(
    df: DataFrame,
    table: str,
    required: list[str] = (),
    lengths: dict[str, int] | None = None,
    decimals: dict[str, str] | None = None,
    domains: dict[str, list] | None = None,
) -> DataFrame:
    """Missing values, over-long text, numbers out of range, unknown values."""
    tests = row_tests(required, lengths, decimals, domains)
    totals = df.agg(*[F.expr(f"count_if({t}) AS _{i}") for i, t in enumerate(tests.values())])
    rows = [(rule, table, c, f"_{i}") for i, (rule, c) in enumerate(tests)]
    return totals.selectExpr(_report(rows))


def row_tests(
    required: list[str] = (),
    lengths: dict[str, int] | None = None,
    decimals: dict[str, str] | None = None,
    domains: dict[str, list] | None = None,
) -> dict[tuple[str, str], str]:
    """(rule, column): what holds for a row that breaks the rule, as SQL."""
    tests = {("required", c): f"{c} IS NULL" for c in required}
    tests |= {("length", c): f"length({c}) > {n}" for c, n in (lengths or {}).items()}
    tests |= {("precision", c): f"abs({c}) >= {_limit(kind)}" for c, kind in (decimals or {}).items()}
    return tests | {
        ("domain", c): f"{c} NOT IN ({', '.join(_constant(v) for v in values)})"
        for c, values in (domains or {}).items()
    }


def _limit(kind: str) -> Decimal:
    """The smallest size that no longer fits ``decimal(p,s)`` once rounded.

    A comparison, because a failed ``try_cast`` costs an exception per row.
    """
    precision, scale = map(int, kind.removeprefix("decimal(").removesuffix(")").split(","))
    return Decimal(10) ** (precision - scale) - Decimal(5) * Decimal(10) ** (-scale - 1)


def _constant(value) -> str:
    return literal(value) if isinstance(value, str) else str(value)


def unique_rule(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Rows beyond the first of each key; a key with a null is not compared.

    Texts are compared by hash and length, so that no long text is shuffled.
    """
    kinds = dict(df.dtypes)
    parts = [
        part
        for c in key
        for part in ([F.sha2(c, 256), F.length(c)] if kinds[c] == "string" else [F.col(c)])
    ]
    keys = df.na.drop("any", subset=key).select(*[p.alias(f"_{i}") for i, p in enumerate(parts)])
    per_key = keys.groupBy(*keys.columns).agg(F.count("*").alias("n"))
    surplus = per_key.agg(F.expr("coalesce(sum(n - 1), 0) AS n"))
    return surplus.selectExpr(_report([("unique", table, ",".join(key), "n")]))


def observe_unique(df: DataFrame, key: list[str], seen: Observation) -> DataFrame:
    """The same rows; ``seen`` counts those beyond the first of each key.

    For rows that lie together and in order by the key already, as ``keep_first``
    leaves them: then they are neither shuffled nor sorted for it.
    """
    copies = F.count("*").over(Window.partitionBy(*key))
    surplus = F.coalesce(F.round(F.sum((F.col("_copies") - 1) / F.col("_copies"))), F.lit(0))
    return df.withColumn("_copies", copies).observe(seen, surplus.cast("bigint").alias(_unique(key))).drop("_copies")


def _unique(key: list[str]) -> str:
    return f"unique {','.join(key)}"


def parent_rule(
    df: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str, count: str = "count(*)"
) -> DataFrame:
    """Rows whose value does not exist in the parent; nulls are not checked.

    ``count`` is the aggregate that gives the rows of a value.
    """
    per_value = df.where(f"{column} IS NOT NULL").groupBy(column).agg(F.expr(count).alias("n"))
    known = parent.select(F.col(parent_column).alias(column))
    lost = per_value.join(known, column, "left_anti")
    total = lost.agg(F.expr("coalesce(sum(n), 0) AS n"))
    return total.selectExpr(_report([("parent", table, column, "n")]))


def table_report(df: DataFrame, table: Table, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every rule declared for a table; ``parents`` holds the parent tables."""
    parts = [
        row_rules(df, table.name, table.required, table.lengths, table.decimals, table.domains)
    ]
    if table.key:
        parts.append(unique_rule(df, table.name, list(table.key)))
    for column, (name, parent_column) in table.parents.items():
        if parents and name in parents:
            parts.append(parent_rule(df, table.name, column, parents[name], parent_column))
    return reduce(DataFrame.unionByName, parts)


def _within(tolerance: float) -> Column:
    off = F.abs(F.col("actual") - F.col("expected"))
    return (off <= F.col("expected") * F.lit(tolerance)).alias("within_tolerance")


def reconcile(df: DataFrame, name: str, expected: Column, tolerance: float = 0.01) -> DataFrame:
    """Row count against an expected volume, as one report row."""
    counted = df.agg(F.count("*").alias("actual"), expected.cast("bigint").alias("expected"))
    return counted.select(F.lit(name).alias("table_name"), "actual", "expected", _within(tolerance))


def volumes(history: DataFrame, tolerance: float = 0.01, earlier: int = 5) -> DataFrame:
    """Rows of each version of a table against what its earlier versions let expect.

    ``history`` holds table_name, publication and rows. Expected is the lower median
    of the ``earlier`` versions before; the first version has none, and no verdict.
    """
    before = Window.partitionBy("table_name").orderBy("publication").rowsBetween(-earlier, -1)
    counts = F.array_sort(F.collect_list("rows").over(before))
    middle = F.try_element_at("_counts", F.expr("CAST((size(_counts) + 1) DIV 2 AS INT)"))
    known = history.where("rows IS NOT NULL").withColumn("_counts", counts)
    expected = F.when(F.size("_counts") > 0, middle.cast("bigint"))
    counted = known.select("table_name", "publication", F.col("rows").alias("actual"), expected.alias("expected"))
    return counted.select("*", _within(tolerance))
