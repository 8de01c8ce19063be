"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the key `-ln(u) / w`, where u is a hash of the document in
(0, 1) and w its quality weight. Within a source, documents are taken in the
order of their keys until the words taken reach the source's budget. A budget of
more than the source's own words takes complete epochs of all documents first,
and only the rest of it is sampled.

No source is ever sorted or gathered in one place. The key becomes a whole
number of `DIGITS` digits in base `BASE`; sums per digit show which digit holds
the end of the budget, and the next digit is looked at in that part alone. What
a task sees of a source is at most BASE sums, however many documents it has.

Rows equal in doc_id and text have one key. Where a budget ends among them, as many
as fit are taken: such rows are written, and numbered by file and place in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from guestlens.llm.tables import split_words, stored
from guestlens.sources.shared import shared_folder

BASE = 4096
DIGITS = 4

#: Weights of the sources in the order of their names, the words of
#: the mix as a share of all words, and the most often a document may be taken.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2

#: Characters that count against a document's quality weight.
POOR = r"[0-9#*$%&|<>]+"


def quality_weight(text: Column) -> Column:
    """From 0.1 to 1: the share of characters that are no digits or odd signs."""
    text = F.coalesce(text, F.lit(""))
    fine = F.length(F.regexp_replace(text, POOR, "")) / F.greatest(F.length(text), F.lit(1))
    return F.lit(0.1) + F.lit(0.9) * fine


def position(identity: Column, weight: Column) -> Column:
    """The sampling key as a whole number below BASE ** DIGITS, in key order."""
    digest = F.conv(F.substring(F.md5(identity.cast("binary")), 1, 12), 16, 10).cast("double")
    uniform = (digest + F.lit(0.5)) / F.lit(float(2**48))
    key = -F.log(uniform) / weight
    top = BASE**DIGITS
    scaled = F.floor((F.lit(1.0) - F.exp(-key)) * F.lit(float(top)))
    return F.least(F.greatest(scaled, F.lit(0)), F.lit(top - 1)).cast("long")


def budgets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size -> the same with its place, target, epochs and rest.

    Sources by code point, null last, get the weights in turn. A target stops at
    `most` times the source's size, and what is above goes to the others by
    weight. There is one row per source, which is what a recipe holds.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.alias("weight"), rank.alias("place"))
    everything = Window.partitionBy(F.lit(1))
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    rows = rows.withColumn("level", level)
    capped = F.col("cap") <= F.col("level") * F.col("weight")
    shared_level = F.max(F.when(~capped, F.col("level"))).over(everything)
    target = F.when(capped, F.col("cap")).otherwise(shared_level * F.col("weight"))
    rows = rows.select("source", "place", "source_size", target.alias("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("epochs", epochs.cast("long"))
    return rows.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))


def sampled_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """One row per document: doc (all its columns), size, source_size, target, copies.

    docs needs doc_id, text and source; size is its number of words. copies says
    how often the mix holds the document.

    Defined cases: a null text has size 0; a null source is a source of its own,
    the last; rows equal in doc_id and text share a key, and as many of them are
    taken as bring the sum nearest to the budget, whichever; the document at the
    end of a budget is taken if that brings the sum nearer to it; a document of
    size 0 is taken in complete epochs alone, or if its key comes before the end;
    no rows give no rows. Reruns agree, as keys depend on the documents only.
    """
    spark = docs.sparkSession
    identity = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col("source").alias("source"),
        F.size(split_words(F.col("text"))).cast("long").alias("size"),
        position(identity, quality_weight(F.col("text"))).alias("key"),
        F.xxhash64(identity).alias("twin"),
    )
    narrow = stored(rows.select("source", "size", "key", "twin"), "mix-keys")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(budgets(sizes, weights, share, most), "mix-budgets")
    ends = stored(_ends(narrow, plan), "mix-ends")
    matched = rows.join(ends.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source")), "left")
    equal = (F.col("key") == F.col("end")) & (F.col("twin") == F.col("end_twin"))
    before = (F.col("key") < F.col("end")) | ((F.col("key") == F.col("end")) & (F.col("twin") < F.col("end_twin")))
    some = (F.col("some") > 0) & (F.col("some") < F.col("members"))
    sampled = before | (equal & (F.col("some") == F.col("members")))

    def mixed(rows: DataFrame, sampled: Column) -> DataFrame:
        copies = F.col("epochs") + F.coalesce(sampled, F.lit(False)).cast("long")
        return rows.select("doc", "size", "source_size", "target", copies.alias("copies"))

    if ends.where(some).isEmpty():
        return mixed(matched, sampled)
    shared = F.coalesce(equal & some, F.lit(False))
    ties = matched.where(shared).select("doc", "size", "source_size", "target", "epochs", "some", F.col("place").cast("int"))
    return mixed(matched.where(~shared), sampled).unionByName(mixed(_numbered(spark, ties), F.col("number") < F.col("some")))


def _numbered(spark: SparkSession, ties: DataFrame) -> DataFrame:
    """The rows with their number within `place`, from 0.

    A file holds rows of one place, so a number is the row's index in its file and
    the rows of the files before it. Only the list of files is ever ordered.
    """
    folder = shared_folder(spark, "mix-ties")
    ties.write.partitionBy("place").parquet(folder)
    file = F.col("_metadata.file_path").alias("file")
    written = spark.read.schema(ties.schema).parquet(folder).select("*", file, F.col("_metadata.row_index").alias("index"))
    files = written.groupBy("place", "file").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("place").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = files.select("file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"))
    return written.join(first, "file").withColumn("number", F.col("first") + F.col("index"))


def _crossing(sums: DataFrame, step: str) -> DataFrame:
    """The first step of each source at which its budget is reached, with the words
    before it; `inside` says how many each step holds."""
    through = F.sum("inside").over(Window.partitionBy("source").orderBy(step)) + F.col("before")
    first = F.row_number().over(Window.partitionBy("source").orderBy(step))
    reached = sums.withColumn("through", through).where("through >= rest").withColumn("first", first).where("first = 1")
    return reached.withColumn("before", F.col("through") - F.col("inside")).drop("through", "first")


def _ends(narrow: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with where the sampled part of the mix ends: at the key `end`, and
    among the `members` rows of hash `end_twin` there, after `some` of them."""
    found = plan.where("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    for level in range(DIGITS):
        span = BASE ** (DIGITS - level - 1)
        state = found.select(F.col("source").alias("its_source"), "rest", "prefix", "before")
        part = narrow.join(
            state,
            F.col("source").eqNullSafe(F.col("its_source")) & (F.floor(F.col("key") / (span * BASE)) == F.col("prefix")),
        )
        sums = part.groupBy("source", "rest", "before", F.floor(F.col("key") / span).alias("digit")).agg(F.sum("size").alias("inside"))
        reached = _crossing(sums, "digit").select("source", "rest", F.col("digit").alias("prefix"), "before")
        found = stored(reached, "mix-digits")
    state = found.select(F.col("source").alias("its_source"), "rest", "prefix", "before")
    part = narrow.join(state, F.col("source").eqNullSafe(F.col("its_source")) & (F.col("key") == F.col("prefix")))
    sums = part.groupBy("source", "rest", "prefix", "before", "twin").agg(F.sum("size").alias("inside"), F.count("*").alias("members"))
    each = F.col("inside") / F.col("members")
    nearest = F.floor((2 * (F.col("rest") - F.col("before")) + each) / (2 * each))
    last = _crossing(sums, "twin").select(
        F.col("source").alias("its_source"),
        F.col("prefix").alias("end"),
        F.col("twin").alias("end_twin"),
        "members",
        F.greatest(F.least(nearest, F.col("members")), F.lit(0)).cast("long").alias("some"),
    )
    joined = plan.join(last, F.col("source").eqNullSafe(F.col("its_source")), "left")
    return joined.drop("its_source", "rest")
