"""The given tables written out as files."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from guestlens.plans import star
from guestlens.sources.delimited import read_delimited

FOLDER = "/root/testdata/sf0.001"


def test_more_lines_make_more_files_and_not_larger_ones(spark, monkeypatch):
    monkeypatch.setattr(star, "FILE_ROWS", 200)
    reviews = star.write_reviews_file(spark, FOLDER)
    written = {
        "lineitem": star.write_bad_rows(spark, FOLDER),
        "events": star.write_surplus_rows(spark, FOLDER, reviews),
    }
    for name, path in written.items():
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
        heads = lines.where("value LIKE 'id;%' OR value LIKE 'id_review;%'").groupBy("file").count()
        sizes = [r["count"] for r in lines.groupBy("file").count().collect()]
        assert [r["count"] for r in heads.collect()] == [1] * len(sizes)
        assert max(sizes) < 3 * 200
        read = Observation()
        read_delimited(spark, path, seen=read).write.format("noop").mode("overwrite").save()
        assert read.get["read"] == star.table(spark, FOLDER, name).count()


def test_reviews_are_written_in_order_of_ids_by_one_shuffle_of_the_lines(spark, monkeypatch):
    monkeypatch.setattr(star, "FILE_ROWS", 500)
    order = ["id_review", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    ordered = star._ordered_lines(spark, FOLDER, order)
    keys = [tuple(r) for r in ordered.select(*order).collect()]
    lines = star.order_lines(spark, FOLDER).selectExpr("l_orderkey * 10 + l_linenumber AS id_review", *order[1:])
    assert keys == sorted(tuple(r) for r in lines.collect())
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 2 * 500
    assert "rangepartitioning" not in ordered._jdf.queryExecution().toString()


def test_reviews_are_written_packed_and_read_as_they_were(spark):
    path = star.write_reviews_file(spark, FOLDER)
    files = spark.read.text(path).inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)
    seen = Observation()
    read_delimited(spark, path, seen=seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"read": star.table(spark, FOLDER, "lineitem").count(), "surplus": 0}


def test_kept_lines_serve_the_reviews_and_their_file(spark):
    lines = star.kept_lines(spark, FOLDER)
    try:
        rows = star.reviews(spark, FOLDER, lines)
        assert sorted(map(str, rows.collect())) == sorted(map(str, star.reviews(spark, FOLDER).collect()))
        # Nothing is joined or shuffled for a second use of them.
        tree = rows._jdf.queryExecution().executedPlan().toString()
        assert tree.index("InMemoryTableScan") < tree.index("Join")
        texts = [
            [r.value for r in spark.read.text(p).orderBy("_metadata.file_path", F.monotonically_increasing_id()).collect()]
            for p in (star.write_reviews_file(spark, FOLDER, lines), star.write_reviews_file(spark, FOLDER))
        ]
        assert texts[0] == texts[1]
    finally:
        lines.unpersist()
