"""The KPI queries.

All but the profile drivers are built on ``lodging_sums``: one pass over the
reviews that leaves one row of mergeable sums per lodging. Sums are taken in
every map task before the shuffle, so a lodging with a third of all reviews
costs no more than any other, and the joins and group totals that follow touch
lodging rows only, never the reviews again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.functions.stats import (
    correlation,
    from_hundredths,
    hundredths,
    merged_pair_sums,
    pair_correlation,
    pair_sums,
    rounded_correlation,
    rounded_mean,
    sample_deviation,
    strongest,
)
from guestlens.functions.text import text_key
from guestlens.operators.rows import hot_keys, lookup
from guestlens.schemas import (
    DIMENSIONS,
    MIN_LODGINGS_VOLUME,
    MIN_REVIEWS_GROUP,
    MIN_REVIEWS_SEGMENT,
)

_GROUP = ["star_rating", "type", "city_name"]
_CITY_KEY = text_key("star_rating", "type", "'city'", "city_name")
_MEAN = rounded_mean("overall_sum", "review_count")


def _exprs(texts: list[str]) -> list:
    return [F.expr(t) for t in texts]


def _ratings(reviews: DataFrame, *keep: str) -> DataFrame:
    """Ratings as hundredths; a review without an overall rating has none."""
    dimensions = [
        f"CASE WHEN rating_overall IS NOT NULL THEN {hundredths(f'rating_{d}')} END AS {d}"
        for d in DIMENSIONS
    ]
    return reviews.selectExpr(*keep, f"{hundredths('rating_overall')} AS overall", *dimensions)


_DIMENSION_SUMS = [text for d in DIMENSIONS for text in pair_sums(d, "overall")]
_MERGED_SUMS = [text for d in DIMENSIONS for text in merged_pair_sums(d)]


def lodging_sums(reviews: DataFrame) -> DataFrame:
    """One row per lodging with any review; ``all_reviews`` counts them, while
    ``review_count`` and all sums are over its rated reviews only."""
    overall = [
        "count(*) AS all_reviews",
        "count(overall) AS review_count",
        "sum(overall) AS overall_sum",
        "sum(CAST(overall AS DOUBLE) * overall) AS overall_squares",
    ]
    ratings = _ratings(reviews, "id_hostel")
    return ratings.groupBy("id_hostel").agg(*_exprs(overall + _DIMENSION_SUMS))


def coverage(lodgings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Lodgings in all, lodgings with any review, and their share in percent.

    ``reviews`` may also be ``lodging_sums``, which names the same lodgings. The
    share is null when there are no lodgings.
    """
    total = lodgings.agg(F.count("*")).scalar()
    counted = reviews.agg(
        F.count_distinct("id_hostel").alias("hostels_with_reviews"),
        total.alias("total_hostels"),
    )
    share = from_hundredths(rounded_mean("(hostels_with_reviews * 10000)", "total_hostels"))
    return counted.selectExpr("total_hostels", "hostels_with_reviews", f"{share} AS coverage_pct")


def lodging_ratings(sums: DataFrame) -> DataFrame:
    """Review count, seven averages and the deviation of the overall rating."""
    means = {"overall": _MEAN} | {d: rounded_mean(f"{d}_x", f"{d}_n") for d in DIMENSIONS}
    deviation = sample_deviation("review_count", "overall_sum", "overall_squares")
    return sums.where("review_count > 0").selectExpr(
        "id_hostel",
        "review_count",
        *[f"{from_hundredths(mean)} AS avg_{name}" for name, mean in means.items()],
        f"{deviation} AS stddev_overall",
    )


def _with_lodging(sums: DataFrame, lodgings: DataFrame, *columns: str) -> DataFrame:
    """Rated lodgings. Both sides have one row per lodging, so no key is hot."""
    rated = sums.where("review_count > 0")
    return rated.join(lodgings.select("id_hostel", *columns), "id_hostel")


def equivalent_groups(
    sums: DataFrame,
    lodgings: DataFrame,
    levels: tuple[str, ...] = ("city", "country"),
    min_reviews: int = MIN_REVIEWS_GROUP,
) -> DataFrame:
    """Lodgings of the same stars, type and place; the mean weighs reviews.

    City groups use the city's name only, so same-named cities share a group.
    Both levels come from one pass over the lodging rows.
    """
    place = {"city": "city_name", "country": "city_country"}
    wide = _with_lodging(sums, lodgings, "star_rating", "type", *place.values())
    places = [f"struct('{n}' AS group_level, {place[n]} AS location)" for n in levels]
    levelled = wide.selectExpr(
        "star_rating",
        "type AS hostel_type",
        "review_count",
        "overall_sum",
        f"inline(array({', '.join(places)}))",
    )
    groups = levelled.groupBy("star_rating", "hostel_type", "group_level", "location").agg(
        F.count("*").alias("hostel_count"),
        F.sum("review_count").alias("review_count"),
        F.sum("overall_sum").alias("overall_sum"),
    )
    return groups.selectExpr(
        f"{text_key('star_rating', 'hostel_type', 'group_level', 'location')} AS group_key",
        "group_level",
        "star_rating",
        "hostel_type",
        "location",
        "hostel_count",
        "review_count",
        f"{from_hundredths(_MEAN)} AS avg_overall_group",
        f"review_count >= {min_reviews} AS is_valid",
    )


def ranking(
    sums: DataFrame, lodgings: DataFrame, min_reviews: int = MIN_REVIEWS_GROUP
) -> DataFrame:
    """Rank of each lodging in its city group by average, and its distance from
    the group's mean; only groups with enough reviews.

    A lodging's rank is one more than the number of lodgings with a higher
    average, so it is worked out once per distinct average. The window then
    sees at most as many rows per group as there are two-decimal averages,
    however many lodgings the group has. Ranks go back to the lodgings by group
    and average, a key that very many lodgings may share.
    """
    wide = _with_lodging(sums, lodgings, *_GROUP).selectExpr(
        "id_hostel", *_GROUP, "review_count", "overall_sum", f"{_MEAN} AS mean"
    )
    steps = wide.groupBy(*_GROUP, "mean").agg(
        F.count("*").alias("lodgings"),
        F.sum("review_count").alias("reviews"),
        F.sum("overall_sum").alias("total"),
    )
    group = f"PARTITION BY {', '.join(_GROUP)}"
    higher = f"{group} ORDER BY mean DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    ranked = steps.selectExpr(
        *_GROUP,
        "mean",
        f"coalesce(sum(lodgings) OVER ({higher}), 0) + 1 AS rank_in_group",
        f"sum(reviews) OVER ({group}) AS group_reviews",
        f"sum(total) OVER ({group}) AS group_total",
    ).where(f"group_reviews >= {min_reviews}")
    group_mean = rounded_mean("group_total", "group_reviews")
    placed = ranked.selectExpr(*_GROUP, "mean", "rank_in_group", f"mean - ({group_mean}) AS deviation")
    step = [*_GROUP, "mean"]
    shared = hot_keys(steps, step, count="sum(lodgings)")
    return lookup(wide, placed, step, hot=shared, row_id="id_hostel").selectExpr(
        "id_hostel",
        f"{_CITY_KEY} AS group_key",
        f"{from_hundredths('mean')} AS avg_overall",
        "rank_in_group",
        f"{from_hundredths('deviation')} AS deviation_from_group",
        "review_count",
    )


def volume_vs_rating(
    sums: DataFrame,
    lodgings: DataFrame,
    min_reviews: int = MIN_REVIEWS_GROUP,
    min_lodgings: int = MIN_LODGINGS_VOLUME,
) -> DataFrame:
    """Correlation of review count with average rating over a group's lodgings."""
    wide = _with_lodging(sums, lodgings, *_GROUP).selectExpr(
        f"{_CITY_KEY} AS group_key", "review_count", f"{_MEAN} AS mean"
    )
    groups = wide.groupBy("group_key").agg(
        F.expr(correlation("review_count", "mean")).alias("r"),
        F.count("*").alias("sample_size"),
        F.sum("review_count").alias("reviews"),
    )
    enough = groups.where(f"sample_size >= {min_lodgings} AND reviews >= {min_reviews}")
    return enough.selectExpr("group_key", f"{rounded_correlation('r')} AS pearson_r", "sample_size")


def _with_drivers(groups: DataFrame, default_first: bool) -> DataFrame:
    """Adds the correlations and the top driver. They are named first, so that
    each is computed once."""
    named = groups.selectExpr("*", *[f"{pair_correlation(d)} AS r_{d}" for d in DIMENSIONS])
    top = strongest({d: f"r_{d}" for d in DIMENSIONS}, default_first)
    rounded = [f"{rounded_correlation(f'r_{d}')} AS corr_{d}" for d in DIMENSIONS]
    return named.selectExpr("*", *rounded, f"{top} AS top_driver")


_DRIVER_COLUMNS = [*[f"corr_{d}" for d in DIMENSIONS], "top_driver", "sample_size"]


def group_drivers(
    sums: DataFrame,
    lodgings: DataFrame,
    min_reviews: int = MIN_REVIEWS_GROUP,
    default_first: bool = True,
) -> DataFrame:
    """How each dimension moves with the overall rating, by city group.

    A group is valid exactly when it has enough rated reviews, so the groups
    table is not needed here.
    """
    wide = _with_lodging(sums, lodgings, *_GROUP).withColumn("group_key", F.expr(_CITY_KEY))
    merged = ["sum(review_count) AS sample_size", *_MERGED_SUMS]
    groups = wide.groupBy("group_key").agg(*_exprs(merged))
    valid = groups.where(f"sample_size >= {min_reviews}")
    return _with_drivers(valid, default_first).select("group_key", *_DRIVER_COLUMNS)


def profile_drivers(
    reviews: DataFrame,
    users: DataFrame,
    lodgings: DataFrame,
    min_reviews: int = MIN_REVIEWS_SEGMENT,
    default_first: bool = True,
) -> DataFrame:
    """The same by guest profile and lodging type; small segments are flagged.

    Few segments take in all reviews, so sums per map task shrink them to
    almost nothing before the last shuffle.
    """
    segment = ["trip_code", "gender_code", "age_range", "hostel_type"]
    types = lodgings.selectExpr("id_hostel", "type AS hostel_type")
    profiles = users.select("id_user", *segment[:3]).na.drop("any", subset=segment[:3])
    rated = reviews.where("rating_overall IS NOT NULL")
    # The review's id stays until after both lookups, as it tells equal ratings apart.
    ratings = _ratings(rated, "id_review", "id_hostel", "id_user")
    typed = lookup(ratings, types, "id_hostel", hot=hot_keys(rated, ["id_hostel"]), row_id="id_review")
    wide = lookup(typed, profiles, "id_user", hot=hot_keys(rated, ["id_user"]), row_id="id_review")
    groups = wide.groupBy(*segment).agg(*_exprs(["count(*) AS sample_size", *_DIMENSION_SUMS]))
    return _with_drivers(groups, default_first).selectExpr(
        *segment,
        f"{text_key(*segment)} AS segment_key",
        *_DRIVER_COLUMNS,
        f"sample_size >= {min_reviews} AS is_valid",
    )
