"""Delimited files as all-text DataFrames with a file-order column.

Quoting, splitting and decoding are Spark's CSV reader; this module only adds
the rules the input needs: rows with too many fields are left out, short rows
are padded with null, null tokens become null, file order is kept, and files
with line breaks inside quotes are read in as many tasks as any others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from guestlens.functions.text import literal, null_tokens
from guestlens.operators.rows import planned_bytes

ROW_ORDER = "_row_order"
_CORRUPT = "_corrupt_record"

#: Files up to which a row's place holds the number of its file in the order of names,
#: which are broadcast; beyond that it holds the name, some 100 bytes with every row.
NUMBERED_FILES = 100_000

#: Splits of files with line breaks in quotes up to which what is known of them,
#: some 200 bytes each, is broadcast.
BROADCAST_SPLITS = 200_000


def require_inputs(spark: SparkSession, paths: list[str | list[str]]) -> None:
    """Raise ``FileNotFoundError`` naming every path that does not exist."""
    missing = []
    for path in paths:
        try:
            spark.read.text(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError(f"input files not found: {missing}")


#: Bytes of text that a compressed file holds, at a guess, for each of its own.
PACKED = 4


@contextmanager
def whole_files(spark: SparkSession, path: str | list[str]) -> Iterator[None]:
    """While compressed files are read, give each task the fewer of them: they count by
    their size on disk, and hold several times that. Other files are read as ever."""
    factories = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    name = spark._jvm.org.apache.hadoop.fs.Path
    files = spark.read.text(path).inputFiles()
    # One file of a kind tells for all of that ending.
    kinds = {f.rsplit(".", 1)[-1]: f for f in files}
    if not any(factories.getCodec(name(f)) for f in kinds.values()):
        yield
        return
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    spark.conf.set(conf, str(max(1, most // PACKED)))
    try:
        yield
    finally:
        spark.conf.set(conf, before)


# -- quotes as patterns ------------------------------------------------------------

#: Inside a quoted field, up to its end or that of the line.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'


def _quoted(sep: str) -> str:
    """Pattern of a whole quoted field. Only a quote that starts a field opens
    one; any other quote is a character like the rest."""
    return rf'(^|{re.escape(sep)})"{_INSIDE}"(?={re.escape(sep)}|$)'


def _field(sep: str) -> tuple[str, str]:
    """Patterns of the rest of a field up to the separator, and of fields that end
    in the line with the separators behind them. Text behind a closing quote
    belongs to the field."""
    rest = f"[^{re.escape(sep)}]*+" if len(sep) == 1 else f"(?:(?!{re.escape(sep)}).)*+"
    return rest, rf'(?:(?:"{_INSIDE}"{rest}|(?!"){rest}){re.escape(sep)})*+'


def _ends_open(sep: str) -> tuple[str, str]:
    """Patterns of lines that end inside quotes: of those that start outside, and
    of those that start inside."""
    rest, fields = _field(sep)
    opens = rf'{fields}"{_INSIDE}\z'
    return rf"^{opens}", rf'^{_INSIDE}(?:\z|"{rest}{re.escape(sep)}{opens})'


def _turns(sep: str) -> dict[str, Column]:
    """Whether a line ends inside quotes if it starts outside, and if it starts
    inside. A line without a quote changes nothing."""
    outside, inside = _ends_open(sep)
    plain = ~F.contains("value", F.lit('"'))
    return {"from_outside": ~plain & F.col("value").rlike(outside), "from_inside": plain | F.col("value").rlike(inside)}


def files_with_open_quotes(spark: SparkSession, path: str | list[str], sep: str = ";") -> list[str]:
    """Files with a line that ends inside a quoted field, which therefore runs
    on into the next line. The list grows with such files, not with all files."""
    lines = spark.read.text(path).where(_turns(sep)["from_outside"])
    files = lines.select(F.col("_metadata.file_path").alias("file")).distinct()
    return sorted(r.file for r in files.collect())


# -- records that run over lines ---------------------------------------------------


def _state(outside: str, inside: str, order: Window, start: str = "false") -> Column:
    """Whether quotes are open behind each row, in the given order.

    Every row turns the state before it into ``outside`` or ``inside``. Where both
    are equal, what came before does not matter; where both change it, the state
    flips; else it stays. So the state is that of the last row that sets it,
    flipped as often as rows have flipped it since.
    """
    flips = F.sum(F.expr(f"CAST({outside} AND NOT {inside} AS LONG)")).over(order)
    sets = F.expr(f"{outside} = {inside}")
    last = F.last(F.when(sets, F.struct(F.expr(outside).alias("state"), flips.alias("flips"))), True).over(order)
    since = F.coalesce(F.pmod(flips - last["flips"], F.lit(2)), F.pmod(flips, F.lit(2))) == 1
    return F.coalesce(last["state"], F.expr(start)) != since


def _splits(lines: DataFrame) -> DataFrame:
    """file, block, and for each split: whether it starts inside quotes, the last
    line of the record that it starts in, the split that record starts in, and
    whether its lines are more than a record each.

    The state at the start of a split follows from all before it in the file. So
    each split is first reduced to what it makes of either state, in its own task;
    only these two outcomes are put together in file order.
    """
    changes = "from_outside OR NOT from_inside"
    outcome = "aggregate(turns, {0}, (open, t) -> if(open, t.from_inside, t.from_outside))"
    per_split = lines.groupBy("file", "block").agg(
        F.expr(f"array_sort(collect_list(struct(id, from_outside, from_inside)) FILTER (WHERE {changes}))").alias("turns"),
        F.expr("min(id) FILTER (WHERE NOT from_inside)").alias("first_end"),
    )
    reduced = per_split.selectExpr(
        "file", "block", "first_end", "size(turns) > 0 AS turning",
        f"{outcome.format('false')} AS if_outside", f"{outcome.format('true')} AS if_inside",
    )
    in_file = Window.partitionBy("file").orderBy("block")
    known = reduced.withColumn("open", _state("if_outside", "if_inside", in_file))
    known = known.withColumn("starts_inside", F.lag("open", 1, False).over(in_file))
    # A record ends in the first line of a split that ends it, if there is one.
    known = known.withColumn("all_inside", F.expr("starts_inside AND first_end IS NULL"))
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(~F.col("all_inside"), F.col("block")), True).over(before)
    # The first split of a file holds its header, which is no row.
    return known.select(
        "file", "block", "starts_inside", "first_end", owner.alias("owner"),
        F.expr("block = 0 OR starts_inside OR turning").alias("mixed"),
    )


def _many_splits(spark: SparkSession, lines: DataFrame, files: list[str]) -> bool:
    """Whether there may be more splits than can be broadcast, by the files' sizes."""
    conf = spark._jsparkSession.sessionState().conf()
    least = min(int(conf.filesMaxPartitionBytes()), int(conf.filesOpenCostInBytes()))
    return planned_bytes(lines) / max(1, least) + len(files) > BROADCAST_SPLITS


def _records(spark: SparkSession, files: list[str], sep: str) -> DataFrame:
    """file, block, id, record, header: the records of files with line breaks in
    quotes, split like any other file.

    Lines of a split in which nothing is quoted over a line end are records where
    they are. Lines of other splits are sorted per split, the first of them with
    the split in which their record starts, and joined to records there.
    """
    place = ["file", "block", "id"]
    lines = spark.read.text(files).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    lines = lines.withColumns(_turns(sep))
    splits = _splits(lines)
    if not _many_splits(spark, lines, files):
        splits = F.broadcast(splits)
    filled = F.trim("value") != ""
    alone = lines.join(splits.where("NOT mixed"), ["file", "block"], "left_semi").where(filled)
    alone = alone.select(*place, F.col("value").alias("record"), F.lit(False).alias("header"))

    owner = F.expr("if(starts_inside AND (first_end IS NULL OR id <= first_end), owner, block)")
    mixed = lines.join(splits.where("mixed"), ["file", "block"]).select(
        "value", *place, "from_outside", "from_inside", owner.alias("owner")
    )
    in_order = Window.partitionBy("file", "owner").orderBy("block", "id")
    mixed = mixed.withColumn("open", _state("from_outside", "from_inside", in_order))
    mixed = mixed.withColumn("inside", F.lag("open", 1, False).over(in_order))
    mixed = mixed.where(filled | F.col("open") | F.col("inside"))
    mixed = mixed.withColumn("number", F.sum(F.expr("CAST(NOT inside AS LONG)")).over(in_order))
    # The rows of a record are where the window left them, so nothing moves again.
    parts = F.array_sort(F.collect_list(F.struct("block", "id", "value"))).alias("parts")
    joined = mixed.groupBy("file", "owner", "number").agg(parts).selectExpr(
        "file", "parts[0].block AS block", "parts[0].id AS id",
        "array_join(transform(parts, p -> p.value), '\\n') AS record",
        "owner = 0 AND number = 1 AS header",
    )
    return alone.unionByName(joined)


def _parsed(records: DataFrame, names: list[str], schema: str, options: dict[str, str]) -> DataFrame:
    """Records as rows; a file whose header differs is refused."""
    rows = records.withColumn("row", F.from_csv("record", schema, options))
    same = " AND ".join(
        f"coalesce(lower(row.`{n}`) = lower({literal(n)}), false)" for n in names if not re.fullmatch(r"_c\d+", n)
    )
    refuse = "CAST(raise_error(concat('CSV header does not conform to the schema: ', file)) AS BOOLEAN)"
    rows = rows.where(f"if(header, if({same or 'true'}, false, {refuse}), true)")
    return rows.select("row.*", *[F.col(c).alias(f"_{c}") for c in ("file", "block", "id")])


def _in_order(spark: SparkSession, rows: DataFrame, files: list[str]) -> DataFrame:
    """``ROW_ORDER`` instead of _file, _block and _id. It goes along with every row, so
    it holds the file's number instead of its name: names are only for other files."""
    # Spark lists files as file:///folder/name and gives rows file:/folder/name.
    names = sorted({re.sub(r"^([\w.+-]+):///", r"\1:/", f) for f in files})
    known = F.split(F.lit("\n".join(names if len(names) <= NUMBERED_FILES else [])), "\n")
    numbers = spark.range(1).select(F.posexplode(known).alias("_number", "_file"))
    numbered = rows.join(F.broadcast(numbers), "_file", "left")
    name = F.when(F.col("_number").isNull(), F.col("_file"))
    place = F.struct("_number", name.alias("_file"), "_block", "_id").alias(ROW_ORDER)
    return numbered.select(*[f"`{c}`" for c in rows.columns if c not in ("_file", "_block", "_id")], place)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ";",
    multi_line: bool | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Read a delimited file, or a folder or list of them, with a header row.

    Every column is text; ``ROW_ORDER`` sorts rows by file name and position.

    ``multi_line`` says whether quoted fields may hold line breaks. If true, Spark
    reads each file in one task, since it cannot know where a split begins. By
    default one more pass over the text finds the files in which a quoted field
    is open at the end of a line. The lines of those are joined to records by
    this module, split by split; a line break in quotes, of whichever kind, is
    then read as a line feed. All other files are left to Spark, split as well.

    ``seen`` observes the rows ``read`` and the ``surplus`` ones left out.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    reader = (
        spark.read.options(**options)
        .option("header", True)
        # Every file's header is compared with the first one's.
        .option("enforceSchema", False)
        # A pruned parse would not see surplus fields.
        .option("columnPruning", False)
    )
    names = reader.option("multiLine", False).csv(path).columns
    schema = ", ".join(f"`{n}` string" for n in [*names, _CORRUPT])
    reader = reader.schema(schema)
    # Directly after the scan: ids rise with the position inside one split, and
    # file and split start put the splits in order.
    place = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    ]
    broken = files_with_open_quotes(spark, path, sep) if multi_line is None else []
    found = reader.option("multiLine", bool(multi_line)).csv(path)
    files = found.inputFiles()
    if broken:
        found = found.where(~F.col("_metadata.file_path").isin(broken))
    placed = found.select("*", *place)
    if broken:
        records = _records(spark, [unquote(f) for f in broken], sep)
        placed = placed.unionByName(_parsed(records, names, schema, options))
    ordered = _in_order(spark, placed, files)

    # Surplus separators outside quoted fields mark a row with too many fields.
    # Spark refuses a scan of the corrupt column alone, as in a bare count, so
    # the test also names a data column, of which it takes no characters.
    record = f"concat_ws('', {_CORRUPT}, left(`{names[0]}`, 0))"
    bare = f"if(contains({record}, '\"'), regexp_replace({record}, {literal(_quoted(sep))}, '$1'), {record})"
    separators = f"length({bare}) - length(replace({bare}, {literal(sep)}, ''))"
    ordered = ordered.withColumn("_fits", F.expr(f"{_CORRUPT} IS NULL OR {separators} <= {len(names) - 1}"))
    if seen is not None:
        ordered = ordered.observe(seen, F.count("*").alias("read"), F.expr("count_if(NOT _fits)").alias("surplus"))
    kept = ordered.where("_fits")
    return kept.selectExpr(*[f"{null_tokens(f'`{n}`')} AS `{n}`" for n in names], ROW_ORDER)
