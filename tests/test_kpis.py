import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from guestlens.plans import kpis
from guestlens.schemas import DIMENSIONS

REVIEWS = "id_review bigint, id_hostel int, id_user bigint, " + ", ".join(
    f"rating_{d} decimal(5,2)" for d in ["overall", *DIMENSIONS]
)
LODGINGS = "id_hostel int, type string, star_rating int, city_name string, city_country string"


def dec(v):
    return None if v is None else Decimal(str(v))


def reviews(spark, rows):
    """Rows of (lodging, user, overall, six dimensions or fewer)."""
    full = []
    for i, (lodging, user, overall, *dims) in enumerate(rows):
        dims = [*dims, *[None] * (6 - len(dims))]
        full.append((i, lodging, user, dec(overall), *map(dec, dims)))
    return spark.createDataFrame(full, REVIEWS)


def lodgings(spark, rows):
    return spark.createDataFrame(rows, LODGINGS)


@pytest.fixture(scope="module")
def grouped(spark):
    """Rome in two countries (10 + 3 + 2 reviews), Oslo with 9 reviews."""
    places = lodgings(
        spark,
        [
            (1, "HOSTEL", 3, "Rome", "Italy"), (2, "HOSTEL", 3, "Rome", "Italy"),
            (3, "HOSTEL", 3, "Rome", "USA"), (4, "HOTEL", 3, "Oslo", "Norway"),
            (5, "HOSTEL", 3, "Rome", "Italy"), (6, "HOSTEL", 3, "Rome", "Italy"),
        ],
    )
    rows = [(1, 1, 9)] * 10 + [(2, 1, 9), (2, 2, 9), (2, 2, None), (2, 3, 9)] + [(3, 3, 8), (3, 4, 8)]
    rows += [(4, 1, 7)] * 9 + [(4, 1, None)] + [(5, 9, None)]
    return kpis.lodging_sums(reviews(spark, rows)), places, reviews(spark, rows)


def test_coverage_counts_unrated_reviews(spark, grouped):
    _, places, rows = grouped
    assert tuple(kpis.coverage(places, rows).first()) == (6, 5, Decimal("83.33"))


def test_coverage_of_nothing_is_null(spark, grouped):
    _, places, rows = grouped
    assert tuple(kpis.coverage(places.limit(0), rows.limit(0)).first()) == (0, 0, None)


def test_ratings_leave_out_reviews_without_overall(spark):
    rows = [(1, 1, 8, 1), (1, 1, 9, None), (1, 1, None, 5), (2, 1, None, 3), (3, 1, 7.5, 2)]
    found = {r.id_hostel: r for r in kpis.lodging_ratings(kpis.lodging_sums(reviews(spark, rows))).collect()}
    assert set(found) == {1, 3}
    assert (found[1].review_count, found[1].avg_overall, found[1].avg_safety) == (2, Decimal("8.50"), Decimal("1.00"))
    assert found[1].avg_staff is None
    assert found[1].stddev_overall == Decimal("0.71")
    assert found[3].stddev_overall is None


def test_groups(spark, grouped):
    sums, places, _ = grouped
    found = {r.group_key: r for r in kpis.equivalent_groups(sums, places).collect()}
    assert set(found) == {
        "3|HOSTEL|city|Rome", "3|HOTEL|city|Oslo", "3|HOSTEL|country|Italy",
        "3|HOSTEL|country|USA", "3|HOTEL|country|Norway",
    }
    rome, oslo = found["3|HOSTEL|city|Rome"], found["3|HOTEL|city|Oslo"]
    assert (rome.hostel_count, rome.review_count, rome.avg_overall_group, rome.is_valid) == (3, 15, Decimal("8.87"), True)
    assert (oslo.hostel_count, oslo.review_count, oslo.is_valid) == (1, 9, False)
    assert found["3|HOSTEL|country|Italy"].review_count == 13
    assert found["3|HOSTEL|country|USA"].group_level == "country"


def test_ranking_ties_and_invalid_groups(spark, grouped):
    sums, places, _ = grouped
    found = {r.id_hostel: r for r in kpis.ranking(sums, places).collect()}
    assert {k: r.rank_in_group for k, r in found.items()} == {1: 1, 2: 1, 3: 3}
    assert found[3].deviation_from_group == Decimal("-0.87")
    assert found[1].group_key == "3|HOSTEL|city|Rome"
    assert found[1].review_count == 10


def test_volume_needs_three_lodgings(spark, grouped):
    sums, places, _ = grouped
    found = kpis.volume_vs_rating(sums, places).collect()
    assert [(r.group_key, r.sample_size) for r in found] == [("3|HOSTEL|city|Rome", 3)]
    # counts 10, 3, 2 against averages 9, 9, 8
    assert found[0].pearson_r == Decimal("0.5960")
    assert kpis.volume_vs_rating(sums, places, min_lodgings=4).count() == 0


def test_drivers_by_absolute_size_with_constants(spark):
    rows = [(1, 1, y, 10, 11 - y, y if y % 2 else None, 5 + y % 3) for y in range(1, 11)]
    places = lodgings(spark, [(1, "HOSTEL", 0, "Rome", "Italy")])
    found = kpis.group_drivers(kpis.lodging_sums(reviews(spark, rows)), places).first()
    assert found.corr_safety is None
    assert found.corr_location == Decimal("-1.0000")
    assert found.corr_staff == Decimal("1.0000")
    assert found.corr_facilities is None
    assert (found.top_driver, found.sample_size) == ("location", 10)


def test_profile_segments_are_kept_and_flagged(spark):
    rows = [(1, 1, y, y) for y in range(1, 31)] + [(1, 2, 5, 5)] + [(1, 3, 5, 5)] + [(1, 1, None, 5)]
    users = spark.createDataFrame(
        [(1, "A", "B", "C"), (2, "A", "B", "D"), (3, "A", None, "C")],
        "id_user bigint, trip_code string, gender_code string, age_range string",
    )
    places = lodgings(spark, [(1, "HOSTEL", 0, "Rome", "Italy")])
    found = {r.segment_key: r for r in kpis.profile_drivers(reviews(spark, rows), users, places).collect()}
    assert set(found) == {"A|B|C|HOSTEL", "A|B|D|HOSTEL"}
    big, small = found["A|B|C|HOSTEL"], found["A|B|D|HOSTEL"]
    assert (big.sample_size, big.is_valid, big.corr_safety, big.top_driver) == (30, True, Decimal("1.0000"), "safety")
    assert (small.sample_size, small.is_valid, small.corr_safety, small.top_driver) == (1, False, None, "safety")


@pytest.fixture(scope="module")
def random_data(spark):
    """A third of the reviews on one lodging, a third of the lodgings in one group."""
    random.seed(5)
    rows = []
    for i in range(3_000):
        lodging = 0 if i % 3 == 0 else random.randrange(1, 150)
        dims = [random.choice([None, random.randrange(1, 11)]) for _ in range(6)]
        rows.append((lodging, random.randrange(200), random.choice([None, *range(1, 11)]), *dims))
    places = [
        (i, "HOSTEL" if i % 3 == 0 else random.choice("ABC"), 0 if i % 3 == 0 else i % 4,
         "Rome" if i % 3 == 0 else f"City{i % 5}", f"Land{i % 3}")
        for i in range(150)
    ]
    return reviews(spark, rows), lodgings(spark, places)


def test_rank_equals_the_window_over_all_lodgings(spark, random_data):
    rows, places = random_data
    sums = kpis.lodging_sums(rows)
    ours = {r.id_hostel: (r.rank_in_group, r.avg_overall) for r in kpis.ranking(sums, places).collect()}
    group = ["star_rating", "type", "city_name"]
    window = Window.partitionBy(*group).orderBy(F.desc("avg_overall"))
    wide = kpis.lodging_ratings(sums).join(places, "id_hostel")
    total = F.sum("review_count").over(Window.partitionBy(*group))
    whole = wide.select("id_hostel", "avg_overall", F.rank().over(window).alias("rank"), total.alias("n"))
    expected = {r.id_hostel: (r.rank, r.avg_overall) for r in whole.where("n >= 10").collect()}
    assert ours == expected


@pytest.mark.parametrize("partitions", [1, 7, 50])
def test_results_do_not_depend_on_partitioning(spark, random_data, partitions):
    rows, places = random_data
    moved = rows.repartition(partitions)
    for kpi in (kpis.equivalent_groups, kpis.ranking, kpis.volume_vs_rating, kpis.group_drivers):
        ours = sorted(map(str, kpi(kpis.lodging_sums(moved), places).collect()))
        assert ours == sorted(map(str, kpi(kpis.lodging_sums(rows), places).collect()))


def test_properties(spark, random_data):
    rows, places = random_data
    sums = kpis.lodging_sums(rows)
    groups = kpis.equivalent_groups(sums, places)
    rated = rows.where("rating_overall IS NOT NULL").count()
    for level in ("city", "country"):
        assert groups.where(F.col("group_level") == level).agg(F.sum("review_count")).first()[0] == rated
    firsts = kpis.ranking(sums, places).groupBy("group_key").agg(F.min("rank_in_group").alias("m"))
    assert firsts.where("m <> 1").count() == 0
    for r in kpis.group_drivers(sums, places).collect():
        assert all(v is None or abs(v) <= 1 for v in [r[f"corr_{d}"] for d in DIMENSIONS])


def test_group_correlations_against_brute_force(spark, random_data):
    import numpy as np

    rows, places = random_data
    group = {p.id_hostel: f"{p.star_rating}|{p.type}|city|{p.city_name}" for p in places.collect()}
    pairs = defaultdict(lambda: defaultdict(list))
    for r in rows.where("rating_overall IS NOT NULL").collect():
        for d in DIMENSIONS:
            if r[f"rating_{d}"] is not None:
                pairs[group[r.id_hostel]][d].append((float(r[f"rating_{d}"]), float(r.rating_overall)))
    for r in kpis.group_drivers(kpis.lodging_sums(rows), places).collect():
        for d in DIMENSIONS:
            xy = np.array(pairs[r.group_key][d])
            if len(xy) < 2 or xy[:, 0].std() == 0 or xy[:, 1].std() == 0:
                assert r[f"corr_{d}"] is None
            else:
                assert abs(float(r[f"corr_{d}"]) - np.corrcoef(xy.T)[0, 1]) <= 0.00005001
