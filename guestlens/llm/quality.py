"""Quality rules: counts per text, and divergence from the text's language.

Each language has a reference made from all of its different texts that pass the
base rules: how often six classes of characters occur, and how often its `COMMON`
most frequent words do. Copies count once, so no group of them can become the
reference.
A document is rejected when its own histogram lies too far from the reference by
Jensen-Shannon distance (base 2, so from 0 to 1). Short texts are not judged,
because their histograms say little.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestlens.llm.tables import GAP, WORD, split_words, stored

#: Words of the repeated windows, and the limits of the base rules.
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = r"[^#*$%&|<>]+"

#: Most frequent words per language in the word histogram.
COMMON = 24
#: So many references are broadcast, of the languages with the most rows. Each of
#: the others has fewer than one in so many rows, and meets its rows in a shuffle.
BROADCAST = 1_000
#: Texts below these sizes are not judged by the histogram in question.
LEAST_CHARS_JUDGED = 600
LEAST_WORDS_JUDGED = 60
#: Greatest distance that is kept.
MOST_CHAR_DISTANCE = 0.28
MOST_WORD_DISTANCE = 0.42

CLASSES = 6
#: Buckets of text hashes; those that hold copies are broadcast.
BUCKETS = 1 << 20


def measures(docs: DataFrame) -> DataFrame:
    """doc (all columns), lang, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n, and the counts of character classes, without any shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"), F.col("lang").alias("lang"), text.alias("t"))
    rows = rows.select(
        "doc",
        "lang",
        "t",
        split_words(F.col("t")).alias("words"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.regexp_replace("t", "[a-z]+", "").alias("no_lower"),
    )
    rows = rows.select("*", F.regexp_replace("no_lower", "[A-Z]+", "").alias("no_letters"), _windows().alias("windows"))
    rows = rows.select(
        "*",
        F.regexp_replace("no_letters", r"[0-9]+", "").alias("no_digits"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(_numbered())).alias("placed"),
    )
    rows = rows.select("*", F.regexp_replace("no_digits", GAP, "").alias("rest"), F.sort_array(_repeated()).alias("starts"))
    plain_rest = F.length(F.regexp_replace("rest", r"[\x00-\x7F]+", ""))
    return rows.select(
        "doc",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered().alias("n_repeat_words"),
        F.length("t").alias("n"),
        F.array(
            F.length("t") - F.length("no_lower"),
            F.length("no_lower") - F.length("no_letters"),
            F.length("no_letters") - F.length("no_digits"),
            F.length("no_digits") - F.length("rest"),
            F.length("rest") - plain_rest,
            plain_rest,
        ).alias("classes"),
    )


def lowered() -> Column:
    """The words of a measured row in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col("doc")["text"], F.lit(""))), GAP), "").alias("lowered")


def spaced() -> Column:
    """The text of a measured row in lower case, with a space of its own on either side
    of each word: so a word is found as text, without splitting."""
    text = F.lower(F.coalesce(F.col("doc")["text"], F.lit("")))
    for gap in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(gap), F.lit(" "))
    return F.concat(F.lit(" "), F.replace(text, F.lit(" "), F.lit("  ")), F.lit(" ")).alias("spaced")


def _windows() -> Column:
    inside = ", ".join(f"words[i + {k}]" for k in range(WINDOW))
    return F.expr(
        f"if(size(words) < {WINDOW}, cast(array() as array<bigint>),"
        f" transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({inside})))"
    )


def _numbered() -> Column:
    return F.expr("transform(windows, (h, i) -> struct(h, i))")


def _repeated() -> Column:
    """Places of the windows that occur at least twice, null if there are none."""
    return F.expr(
        "transform(filter(placed, (x, i) ->"
        " (i > 0 and placed[i - 1].h = x.h) or (i < size(placed) - 1 and placed[i + 1].h = x.h)), x -> x.i)"
    )


def _covered() -> Column:
    step = f"least({WINDOW}, coalesce(get(starts, k + 1), p + {WINDOW}) - p)"
    return F.expr(f"coalesce(aggregate(transform(starts, (p, k) -> {step}), 0L, (a, x) -> a + x), 0L)")


def references(measured: DataFrame) -> DataFrame:
    """lang, documents, classes, common, counts: one row per language that has a reference.

    ``measured`` is a stored result of ``measures``. Every text that passes the base rules counts, once per language however many
    copies there are. The sums of classes and words are one pass over these texts,
    summed in each task before they are shuffled, and the most frequent words are
    chosen per task before they meet.
    """
    taught = measured.where("lang is not null").where(~base_failed())
    rows = _different(taught.select("lang", lowered(), F.col("doc")["text"].alias("t"), "classes"))
    # The sums of classes, and the number of words, go under "0" to "6" in rows of their own:
    # those without a word, which come first.
    sums = F.expr("concat(classes, array(size(lowered)))").alias("sums")
    places = F.expr(f"posexplode(concat(array_repeat(cast(null as string), {CLASSES + 1}), lowered)) as (k, w)")
    counted = rows.select("lang", sums, places).selectExpr(
        "lang", "w is not null as is_word", "coalesce(w, cast(k as string)) as word", "if(w is null, cast(get(sums, k) as long), 1L) as n"
    )
    counted = counted.groupBy("lang", "is_word", "word").agg(F.sum("n").alias("n"))
    # There are fewer sums than words to choose, so the choice keeps them all.
    order = Window.partitionBy("lang", "is_word").orderBy(F.col("n").desc(), "word")
    top = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= COMMON)
    sum_of = lambda k: F.max(F.when(~F.col("is_word") & (F.col("word") == str(k)), F.col("n")))
    chosen = top.groupBy("lang").agg(
        F.array(*[sum_of(k) for k in range(CLASSES)]).alias("classes"),
        sum_of(CLASSES).alias("n_words"),
        F.sort_array(F.collect_list(F.when(F.col("is_word"), F.struct("place", "word", "n")))).alias("top"),
    )
    rows_of = measured.where("lang is not null").groupBy("lang").agg(F.count("*").alias("documents"))
    joined = chosen.join(rows_of, "lang")
    return joined.select(
        "lang",
        "documents",
        F.transform("classes", lambda x: x.cast("double")).alias("reference_classes"),
        F.expr("coalesce(top.word, cast(array() as array<string>))").alias("common"),
        F.expr(
            "concat(coalesce(transform(top, x -> cast(x.n as double)), cast(array() as array<double>)),"
            " array(cast(n_words - coalesce(aggregate(top, 0L, (a, x) -> a + x.n), 0L) as double)))"
        ).alias("reference_words"),
    )


def _different(rows: DataFrame) -> DataFrame:
    """One row of each lang and text t, moving only texts that may have copies.

    A bucket of hashes with copies sends all of its texts to the exact comparison,
    so a hash that collides costs a move and never a text.
    """
    hashed = F.xxhash64("lang", "t")
    copied = rows.select(hashed.alias("h")).groupBy("h").count().where("count > 1")
    # At most BUCKETS rows of one number, whatever the size of the corpus.
    buckets = F.broadcast(copied.select(F.expr(f"pmod(h, {BUCKETS}L)").alias("bucket")).distinct())
    inside = F.pmod(hashed, F.lit(BUCKETS).cast("long")) == F.col("bucket")
    moved = rows.drop("lowered").join(buckets, inside, "left_semi").distinct()
    moved = moved.withColumn("lowered", F.array_remove(F.split(F.lower("t"), GAP), ""))
    return rows.join(buckets, inside, "left_anti").unionByName(moved)


def base_failed() -> Column:
    """Of a row of measures: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def distance(p: str, q: str) -> str:
    """SQL text: Jensen-Shannon distance of two arrays of counts."""
    total = "aggregate({0}, 0D, (a, x) -> a + x)"
    part = "if({0} > 0, {0} * log2(2 * {0} / ({0} + {1})), 0D)"
    x, y = f"(x / {total.format(p)})", f"(y / {total.format(q)})"
    both = f"zip_with(transform({p}, x -> {x}), transform({q}, y -> {y}), (x, y) -> {part.format('x', 'y')} + {part.format('y', 'x')})"
    return f"sqrt(greatest(0D, 0.5D * aggregate({both}, 0D, (a, x) -> a + x)))"


def _referred(measured: DataFrame, known: DataFrame) -> DataFrame:
    """The measured rows with the reference of their language, if it has one."""
    same = F.col("lang") == F.col("reference_lang")
    if known.count() <= BROADCAST:
        return measured.join(F.broadcast(known), same, "left")
    frequent = F.broadcast(stored(known.orderBy(F.desc("documents"), "reference_lang").limit(BROADCAST), "quality-frequent"))
    rare = known.join(frequent.select(F.col("reference_lang").alias("name")), F.col("reference_lang") == F.col("name"), "left_anti")
    labelled = measured.where("lang is not null")
    first = labelled.join(frequent, same, "left_semi").unionByName(measured.where("lang is null"))
    rest = labelled.join(frequent, same, "left_anti")
    return first.join(frequent, same, "left").unionByName(rest.join(rare.hint("merge"), same, "left"))


def judged(docs: DataFrame) -> DataFrame:
    """doc (all columns), the measures, base_failed, char_distance, word_distance, kept.

    docs needs text and lang. A document is kept if no base rule fails and no
    distance is above its limit.

    Defined cases: a null or empty text has no words and fails; a null lang gives
    null distances, and the base rules alone decide; so they do for a language
    without a text that passes them (none of its rows is kept), and for texts below the sizes to be judged. Repeated rows are judged
    alike. No rows give no rows.
    """
    # Measured once: what is counted of a text is far more work than reading it again.
    # Whole texts are stored, so they are packed well.
    measured = stored(measures(docs), "quality-measures", "zstd")
    known = stored(references(measured), "quality-references").withColumnRenamed("lang", "reference_lang")
    rows = _referred(measured, known).withColumn("spaced", spaced())
    without = "octet_length(replace(spaced, concat(' ', c, ' '), ''))"
    common_counts = f"transform(common, c -> cast((octet_length(spaced) - {without}) div (octet_length(c) + 2) as double))"
    rows = rows.withColumn(
        "common_counts", F.expr(f"if(common is null or n_words < {LEAST_WORDS_JUDGED}, null, {common_counts})")
    )
    other = "cast(n_words as double) - aggregate(common_counts, 0D, (a, x) -> a + x)"
    rows = rows.withColumn("own_classes", F.expr("transform(classes, x -> cast(x as double))"))
    rows = rows.withColumn("own_words", F.expr(f"concat(common_counts, array({other}))"))
    rows = rows.withColumn(
        "char_distance",
        F.expr(f"if(reference_classes is null or n < {LEAST_CHARS_JUDGED}, null, {distance('own_classes', 'reference_classes')})"),
    ).withColumn("word_distance", F.expr(f"if(own_words is null, null, {distance('own_words', 'reference_words')})"))
    failed = base_failed()
    far = (F.coalesce("char_distance", F.lit(0.0)) > MOST_CHAR_DISTANCE) | (
        F.coalesce("word_distance", F.lit(0.0)) > MOST_WORD_DISTANCE
    )
    return rows.select(
        "doc",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        failed.alias("base_failed"),
        "char_distance",
        "word_distance",
        (~failed & ~far).alias("kept"),
    )
