"""The given star-schema tables seen as lodgings, users and reviews.

customer is the lodging (segment as type, balance band as stars, nation and
region as places), part is the user, and a line of an order is a review of the
order's customer. Returned lines have no overall rating and open lines no
safety rating, so nulls occur in every group.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from guestlens.sources.shared import shared_folder

_SCHEMAS: dict[str, StructType] = {}

#: Lines of a text file that holds its kind's share of them.
FILE_ROWS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once, as that is a job."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def places(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").selectExpr(
        "n_nationkey AS c_nationkey", "n_name", "n_regionkey AS r_regionkey"
    )
    return nation.join(table(spark, folder, "region"), "r_regionkey").drop("r_regionkey")


def lodgings(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return customer.join(places(spark, folder), "c_nationkey").selectExpr(
        "c_custkey AS id_hostel",
        "c_name AS name",
        "c_mktsegment AS type",
        "CAST(floor(greatest(c_acctbal, 0D) / 2000) AS INT) AS star_rating",
        "n_name AS city_name",
        "r_name AS city_country",
    )


def lodging_types(spark: SparkSession, folder: str) -> DataFrame:
    """Lodgings without their places: all that the profile drivers need. With no
    join in it, Spark knows its size."""
    customer = table(spark, folder, "customer")
    return customer.selectExpr("c_custkey AS id_hostel", "c_mktsegment AS type")


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS id_user",
        "p_brand AS gender_code",
        "CAST(floor(p_size / 10) AS STRING) AS age_range",
        "p_type AS trip_code",
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return table(spark, folder, "lineitem").join(orders, "l_orderkey")


def reviews(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines as reviews; ``lines`` are the order lines where they are at hand."""
    return (order_lines(spark, folder) if lines is None else lines).selectExpr(
        "l_orderkey * 10 + l_linenumber AS id_review",
        "o_custkey AS id_hostel",
        "l_partkey AS id_user",
        "CAST(l_shipdate AS DATE) AS review_date",
        "CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS rating_overall",
        "CASE WHEN l_linestatus <> 'O' THEN l_discount END AS rating_safety",
        "l_tax AS rating_location",
        "floor(l_extendedprice / l_quantity / 200) AS rating_staff",
        "floor(datediff(l_shipdate, o_orderdate) / 10) AS rating_atmosphere",
        "floor(o_totalprice / 1000) AS rating_cleanliness",
        "l_linenumber AS rating_facilities",
    )


# -- the same data as dirty delimited files ------------------------------------


def write_details_file(spark: SparkSession, folder: str) -> str:
    """customer as a details file: null tokens, quoted separators, decimals in
    whole-number columns, mixed flags, and a second copy of some rows."""
    customer = table(spark, folder, "customer").join(places(spark, folder), "c_nationkey")
    segment = F.col("c_mktsegment")
    copies = F.when(segment == "BUILDING", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = customer.withColumn("copy", F.explode(copies))
    stars = F.floor(F.col("c_acctbal") / 2000).cast("string")
    text = rows.select(
        F.col("c_custkey").alias("id_hostel"),
        F.when(segment == "MACHINERY", "NA")
        .when(F.col("copy") == 1, "second copy")
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.when(F.col("c_acctbal") < -500, "N/A").otherwise(segment).alias("type"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.concat(stars, F.lit(".9"))).alias("starRating"),
        F.when(F.col("r_name") == "ASIA", F.concat("n_name", F.lit('; "old" town')))
        .otherwise(F.col("n_name"))
        .alias("city.name"),
        F.col("r_name").alias("city.country"),
        F.when(segment == "FURNITURE", "null").otherwise(F.col("c_nationkey").cast("string")).alias("totalRatings"),
        F.when(segment == "AUTOMOBILE", "True")
        .when(segment == "BUILDING", "False")
        .when(segment == "FURNITURE", "")
        .when(segment == "HOUSEHOLD", "1")
        .otherwise("0.0")
        .alias("freeCancellation.isAvailable"),
        F.col("c_nationkey").alias("unused"),
        "copy",
    ).orderBy("id_hostel", "copy")
    return _write_text(text.drop("copy"), shared_folder(spark, "details"))


_FILE_ORDER = [
    "id_review", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def kept_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines in the order of a reviews file, joined once for all that is made of
    them. They stay on the executors' disks until ``unpersist``."""
    return _ordered_lines(spark, folder, _FILE_ORDER).persist(StorageLevel.DISK_ONLY)


def write_reviews_file(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> str:
    """Order lines as a reviews file, in a total order, so that file order can
    be restated in SQL. Line numbers repeat within an order, which gives
    duplicate review ids. ``lines`` are those of ``kept_lines`` where they are at hand."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    ordered = _ordered_lines(spark, folder, _FILE_ORDER) if lines is None else lines
    text = ordered.select(
        "id_review",
        F.col("o_custkey").alias("id_hostel"),
        F.when((flag == "A") & (status == "O"), "").otherwise(F.col("l_partkey").cast("string")).alias("id_user"),
        F.when(flag == "A", "None").otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("review_date"),
        F.when(flag == "A", "-nan").otherwise(flag).alias("user_gender_code"),
        status.alias("user_age"),
        F.col("o_orderpriority").alias("user_trip_code"),
        F.when(status == "O", "NA").otherwise(F.col("o_orderstatus")).alias("user_nationality_code"),
        F.concat(F.lit('the "'), F.col("o_orderstatus"), F.lit('"; isles')).alias("user_nationality_name"),
        F.col("l_linenumber").alias("user_number_reviews"),
        F.when((flag == "R") & (status == "F"), F.concat(F.col("l_quantity").cast("string"), F.lit("d")))
        .otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string")))
        .alias("review_rating_overall"),
        F.when(status == "O", "n/a").otherwise(F.col("l_discount").cast("string")).alias("review_safety_rate"),
        F.col("l_tax").alias("review_location_rate"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity") / 200).alias("review_staff_rate"),
        F.floor(F.datediff("l_shipdate", "o_orderdate") / 10).alias("review_atmosphere_rate"),
        F.floor(F.col("o_totalprice") / 1000).alias("review_cleanliness_rate"),
        F.col("l_linenumber").alias("review_facilities_rate"),
    )
    return _write_text(text, shared_folder(spark, "reviews"))


def _ordered_lines(spark: SparkSession, folder: str, order: list[str]) -> DataFrame:
    """Order lines in the given order, which begins with ``id_review``.

    Lines and orders are joined in ranges of the order key, which are ranges of the
    review id as well, so that the lines are shuffled once and joined once. The
    ranges are made from counts of lines, some ``FILE_ROWS`` each.
    """
    id_review = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_review")
    lines = table(spark, folder, "lineitem")
    ends = [F.min("l_orderkey"), F.max("l_orderkey"), F.min("l_linenumber"), F.max("l_linenumber")]
    rows, low, high, *numbers = lines.agg(F.count("*"), *ends).first()
    if None in (low, *numbers) or not 0 <= numbers[0] <= numbers[1] < 10:
        # Ids of different orders may overlap.
        return order_lines(spark, folder).select("*", id_review).orderBy(*order)
    width = (high - low) // (16 * (1 + rows // FILE_ROWS)) + 1
    cell = F.expr(f"CAST((l_orderkey - {low}) DIV {width} AS INT)")
    counts = {r.cell: r["count"] for r in lines.groupBy(cell.alias("cell")).count().collect()}
    parts, before = [], 0
    for c in range((high - low) // width + 1):
        parts.append(before // FILE_ROWS)
        before += counts.get(c, 0)
    part = F.get(F.split(F.lit(",".join(map(str, parts))), ",").cast("array<int>"), cell).alias("part")
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    lines, orders = (t.select("*", part).repartitionById(parts[-1] + 1, "part") for t in (lines, orders))
    joined = lines.join(orders, ["part", "l_orderkey"]).drop("part").select("*", id_review)
    return joined.sortWithinPartitions(*order)


def write_bad_rows(spark: SparkSession, folder: str) -> str:
    """Order lines as text lines, good and bad ones, in eight kinds of files with a
    header each. Line breaks in quotes are in every other file."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id", "l_partkey AS part", "l_partkey % 8 AS kind", "CAST(l_orderkey % 4 AS INT) AS file"
    )
    text = F.expr(
        """CASE kind WHEN 0 THEN concat(id, ';plain;', part) WHEN 1 THEN concat(id, ';short')
        WHEN 2 THEN concat(id, ';5" bed;', part) WHEN 3 THEN concat(id, ';"two\\nlines; ', part, '";', part)
        WHEN 4 THEN concat(id, ';"a ""q""; ', part, '";', part) WHEN 5 THEN concat(id, ';surplus;', part, ';', part)
        WHEN 6 THEN concat(id, ';at the end;', part, ';') ELSE concat(id, ';5" x;2;6" y') END"""
    )
    own_file = F.when(F.col("kind") == 3, 1).otherwise(0) + 2 * F.col("file")
    return _write_lines(lines.select(own_file.alias("file"), text.alias("value")), 8, "id;name;score", "bad-rows")


def write_surplus_rows(spark: SparkSession, folder: str, like: str) -> str:
    """Events as lines with more fields than a file of reviews has, in four kinds of
    files with the header of the files ``like``."""
    names = spark.read.option("sep", ";").option("header", True).csv(like).columns
    lines = table(spark, folder, "events").selectExpr(
        "CAST(event_id % 4 AS INT) AS file", f"concat(event_id, '{';' * len(names)}', event_type) AS value"
    )
    return _write_lines(lines, 4, ";".join(names), "surplus")


def _write_lines(lines: DataFrame, kinds: int, header: str, name: str) -> str:
    """Lines (file, value) as text files, some ``FILE_ROWS`` rows each, with a header
    on top; ``file`` is one of so many ``kinds``. A file is sorted and written in one
    task, so more lines make more files of each kind and not larger ones."""
    spark = lines.sparkSession
    parts = max(1, -(-lines.count() // (FILE_ROWS * kinds)))
    own_file = F.col("file") + kinds * F.pmod(F.xxhash64("value"), F.lit(parts)).cast("int")
    rows = lines.select(own_file.alias("file"), F.lit(1).alias("place"), "value")
    heads = spark.range(kinds * parts).select(
        F.col("id").cast("int").alias("file"), F.lit(0).alias("place"), F.lit(header).alias("value")
    )
    path = shared_folder(spark, name)
    dealt = rows.unionByName(heads).repartitionById(kinds * parts, "file").sortWithinPartitions("file", "place")
    dealt.select("file", "value").write.partitionBy("file").text(path)
    return f"{path}/*"


def _write_text(df: DataFrame, path: str) -> str:
    # A file of ``FILE_ROWS`` lines is read in one task anyway, so it may be compressed.
    packed = df.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    packed.option("sep", ";").option("header", True).option("escape", '"').csv(path)
    return path
