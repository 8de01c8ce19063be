import datetime
from decimal import Decimal

from guestlens.plans import staging
from guestlens.sources.delimited import read_delimited

DETAILS = """id_hostel;name;type;starRating;city.name;city.country;totalRatings;freeCancellation.isAvailable;images
1;One;HOSTEL;4.9;Rome;Italy;12;True;x
2;;HOTEL;;Paris;France;;;y
1;Again;HOTEL;1;Oslo;Norway;1;False;z
3;Lost;;2;Rome;Italy;1;True;
;Lost;HOTEL;2;Rome;Italy;1;True;
4;Lost;HOTEL;2;NA;Italy;1;True;
"""

HEADER = (
    "id_review;id_hostel;id_user;review_date;user_gender_code;user_age;user_trip_code;"
    "user_nationality_code;user_nationality_name;user_number_reviews;review_rating_overall;"
    "review_safety_rate;review_location_rate;review_staff_rate;review_atmosphere_rate;"
    "review_cleanliness_rate;review_facilities_rate\n"
)


def review(id_review, id_hostel, id_user, trip, overall="8.565"):
    return (
        f"{id_review};{id_hostel};{id_user};2024-03-01;FEMALE;18-24;{trip};NA;Namibia;3;"
        f"{overall}; 8 ;8,5;abc;inf;10;\n"
    )


REVIEWS = (
    HEADER
    + review(10, 1, 100, "OTHER")
    + review(10, 2, 101, "GAPYEAR")
    + review(11, 9, 102, "OTHER")
    + review(11, 1, 102, "OTHER")
    + review(12, 2, 100, "GAPYEAR", overall="n/a")
    + review("", 1, 103, "OTHER")
)


def load(spark, tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return read_delimited(spark, str(path))


def test_lodgings(spark, tmp_path):
    df = staging.clean_lodgings(load(spark, tmp_path, "d.csv", DETAILS)).orderBy("id_hostel")
    assert [tuple(r) for r in df.collect()] == [
        (1, "One", "HOSTEL", 4, "Rome", "Italy", 12, True),
        (2, "nan", "HOTEL", 0, "Paris", "France", 0, False),
    ]


def test_missing_name_may_stay_null(spark, tmp_path):
    df = staging.clean_lodgings(load(spark, tmp_path, "d.csv", DETAILS), missing_name=None)
    assert df.where("id_hostel = 2").first().name is None


def test_reviews_are_deduplicated_before_orphans_are_set_aside(spark, tmp_path):
    lodgings = staging.clean_lodgings(load(spark, tmp_path, "d.csv", DETAILS))
    reviews = staging.clean_reviews(load(spark, tmp_path, "r.csv", REVIEWS))
    marked = staging.mark_known(reviews, lodgings).orderBy("id_review").collect()
    assert [(r.id_review, r.id_hostel, r.known) for r in marked] == [(10, 1, True), (11, 9, False), (12, 2, True)]


def test_users_keep_their_first_profile(spark, tmp_path):
    reviews = staging.clean_reviews(load(spark, tmp_path, "r.csv", REVIEWS))
    users = staging.clean_users(reviews.where("id_hostel <> 9")).collect()
    assert [(u.id_user, u.trip_code, u.nationality_code, u.number_reviews) for u in users] == [(100, "OTHER", None, 3)]


def test_ratings_and_dates(spark, tmp_path):
    reviews = staging.clean_reviews(load(spark, tmp_path, "r.csv", REVIEWS)).orderBy("id_review").collect()
    first, last = reviews[0], reviews[2]
    assert first.review_date == datetime.date(2024, 3, 1)
    assert first.rating_overall == Decimal("8.57")
    assert first.rating_safety == Decimal("8.00")
    assert [first.rating_location, first.rating_staff, first.rating_atmosphere] == [None] * 3
    assert first.rating_cleanliness == Decimal("10.00")
    assert first.rating_facilities is None
    assert last.rating_overall is None
