"""Row selection by key: keep-first, insert-if-absent, and lookups that stay
balanced when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, key: list[str], order: str | list[str], keep_order: bool = True, seen: Observation | None = None
) -> DataFrame:
    """The first row per key in the given order.

    ``min_by`` keeps one row per key in every map task before the shuffle, so a
    key with very many copies never meets in one task. ``seen`` observes the rows
    left out, as ``duplicate``.
    """
    order = [order] if isinstance(order, str) else order
    wanted = [c for c in df.columns if keep_order or c not in order]
    rest = [c for c in wanted if c not in key]
    sums = [F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")]
    if seen is not None:
        sums.append(F.count("*").alias("_rows"))
    first = df.groupBy(*key).agg(*sums)
    if seen is not None:
        first = first.observe(seen, F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate"))
    return first.select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in wanted])


#: Bits of the filter that ``insert_if_absent`` puts before the target, 64 to a row:
#: at most 2^20 rows are broadcast, whatever comes in.
FILTER_BITS = 1 << 26


def _key_hash(key: list[str], kinds: dict[str, str]) -> Column:
    """A bit for a key of the given types. Minus zero equals zero, as in a join; a
    value that has no place in its type equals no value of it, so it has no bit."""
    values = [F.expr(f"try_cast(`{c}` AS {kinds[c]})") for c in key]
    values = [v + F.lit(0.0).cast(kinds[c]) if kinds[c] in ("float", "double") else v for c, v in zip(key, values)]
    known = reduce(lambda a, b: a & b, [v.isNotNull() for v in values])
    return F.when(known, F.pmod(F.xxhash64(*values), F.lit(FILTER_BITS)))


def may_contain(rows: DataFrame, wanted: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key may be among the wanted ones: all that are, and others by
    chance, wanted keys / ``FILTER_BITS`` of them.

    The wanted keys are reduced to one bit each, and the words that hold those bits
    are broadcast, so the rows are tested where they are read.
    """
    kinds = {c: t for c, t in rows.dtypes if c in key}
    bit = _key_hash(key, kinds)
    bits = wanted.select(bit.alias("_bit")).where("_bit IS NOT NULL")
    words = bits.groupBy(F.expr("_bit DIV 64").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_bit % 64 AS INT)))").alias("_bits")
    )
    marked = rows.withColumn("_bit", bit).withColumn("_word", F.expr("_bit DIV 64"))
    kept = marked.join(F.broadcast(words), "_word").where("getbit(_bits, CAST(_bit % 64 AS INT)) = 1")
    return kept.drop("_bit", "_word", "_bits")


def _bit_sets(table: DataFrame, key: str) -> DataFrame:
    """The whole numbers of a column, 64 neighbours to a row: _word and _bits."""
    bit = f"bit_or(shiftleft(1L, CAST({key} & 63 AS INT)))"
    known = table.where(f"{key} IS NOT NULL")
    return known.groupBy(F.expr(f"shiftright({key}, 6)").alias("_word")).agg(F.expr(bit).alias("_bits"))


def fits_bits(table: DataFrame, key: str) -> bool:
    """Whether the key's values lie close enough together to be broadcast as bit sets."""
    return _bit_sets(table, key).count() <= FILTER_BITS // 64


def mark_present(rows: DataFrame, table: DataFrame, key: str, name: str) -> DataFrame:
    """Adds ``name``: whether the row's key, a whole number, occurs in the table.

    Exact, and no row is moved: ids given out in turn are a bit each, so the table may
    be far larger than one that is broadcast by rows. Ask ``fits_bits`` before.
    """
    sets = F.broadcast(_bit_sets(table, key))
    found = rows.join(sets, F.expr(f"shiftright({key}, 6)") == F.col("_word"), "left")
    present = F.expr(f"coalesce(getbit(_bits, CAST({key} & 63 AS INT)) = 1, false)")
    return found.withColumn(name, present).drop("_word", "_bits")


def insert_if_absent(
    incoming: DataFrame, target: DataFrame, key: list[str], order: str | list[str]
) -> DataFrame:
    """The incoming rows to append: first per key, and not yet in the target.

    Rows with a null in the key are left out, as a key cannot be null. Only keys
    of the target that may be among the incoming ones leave the task that reads
    them, once each, so an append moves what comes in and not the target.
    """
    complete = incoming.na.drop("any", subset=key)
    fresh = keep_first(complete, key, order)
    there = may_contain(target.select(*key), complete.select(*key), key).distinct()
    return fresh.join(there, key, "left_anti")


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; an upper guess when it does not know better."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(table: DataFrame) -> bool:
    """Whether the table is known to be below the session's broadcast threshold."""
    conf = table.sparkSession._jsparkSession.sessionState().conf()
    return planned_bytes(table) <= int(conf.autoBroadcastJoinThreshold())


def hot_keys(
    df: DataFrame, key: list[str], rows_per_split: int = 5_000_000, count: str = "count(*)"
) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows, and into how many splits
    their rows go. ``count`` is the aggregate that gives the rows of a key.

    Every such key is named, so there are fewer than rows / ``rows_per_split`` of
    them: that bounds the list, which is broadcast, at any size of the input.
    """
    counts = df.na.drop("any", subset=key).groupBy(*key).agg(F.expr(count).alias("_n"))
    splits = f"CAST(ceil(_n / {rows_per_split}) AS INT) AS _splits"
    return counts.where(f"_n > {rows_per_split}").selectExpr(*key, splits)


#: Names a row of a stored Parquet table that has no id of its own.
STORED_ROW = ("_metadata.file_path", "_metadata.row_index")


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str | list[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    row_id: str | tuple[str, ...] = STORED_ROW,
) -> DataFrame:
    """Join many ``rows`` to a ``table`` that is unique on ``key``.

    A table below the session's broadcast threshold is broadcast. A larger one
    is shuffled, with the rows of hot keys spread over several splits and the
    matching table row repeated once per split, so that no task gets all rows
    of one key. ``hot`` names those keys; by default they are counted in a pass
    over the key of ``rows``, which should then be a stored table.

    ``row_id`` names what tells rows of one key apart, and is all that is read
    beside the columns asked for. Rows with a null in the key match nothing; a
    left or left_anti join keeps them, spread in the same way. ``how`` may be
    inner, left, left_semi or left_anti.
    """
    key = [key] if isinstance(key, str) else key
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), key, how)

    row_id = (row_id,) if isinstance(row_id, str) else row_id
    hot = F.broadcast(hot_keys(rows, key) if hot is None else hot)
    # Any split will do for a row without a key, as the table has none of those.
    no_key = " OR ".join(f"`{k}` IS NULL" for k in key)
    spread = f"xxhash64({', '.join(row_id)})"
    split_rows = (
        rows.withColumn("_spread", F.expr(spread))
        .join(hot, key, "left")
        .withColumn("_split", F.expr(f"CAST(CASE WHEN {no_key} THEN pmod(_spread, {2**30}) ELSE coalesce(pmod(_spread, _splits), 0) END AS INT)"))
        .drop("_splits", "_spread")
    )
    split_table = (
        table.join(hot, key, "left")
        .withColumn("_split", F.expr("explode(sequence(0, coalesce(_splits, 1) - 1))"))
        .drop("_splits")
    )
    return split_rows.join(split_table, [*key, "_split"], how).drop("_split")
