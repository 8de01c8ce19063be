"""From raw text to staged lodgings, reviews and users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from guestlens.functions.text import flag, lenient_decimal, literal, odd_flag, whole_number
from guestlens.operators.rows import fits_bits, fits_broadcast, keep_first, lookup, mark_present
from guestlens.schemas import DIMENSIONS
from guestlens.sources.delimited import ROW_ORDER

# --- Fixed values: names in the input files -----------------------------------
DETAIL_NAMES = {
    "starRating": "star_rating",
    "city.name": "city_name",
    "city.country": "city_country",
    "totalRatings": "total_ratings",
    "freeCancellation.isAvailable": "free_cancellation",
}
DETAIL_REQUIRED = ["id_hostel", "type", "city_name", "city_country"]
REVIEW_REQUIRED = ["id_review", "id_hostel", "id_user"]
PROFILE = {
    "user_gender_code": "gender_code",
    "user_age": "age_range",
    "user_trip_code": "trip_code",
    "user_nationality_code": "nationality_code",
    "user_nationality_name": "nationality_name",
}
RATINGS = {
    "review_rating_overall": "rating_overall",
    **{f"review_{d}_rate": f"rating_{d}" for d in DIMENSIONS},
}


class Seen:
    """What is counted of a file while its rows pass: what was read and left out
    by the reader, rows without a key, values changed, and duplicates."""

    def __init__(self) -> None:
        self.read, self.keys, self.values, self.copies = (Observation() for _ in range(4))

    def counts(self) -> dict[str, int]:
        """Counts by cause, or by cause and column; waits for the rows to have passed."""
        return self.read.get | self.keys.get | self.values.get | self.copies.get


def _complete(rows: DataFrame, required: list[str], seen: Seen | None) -> DataFrame:
    """Rows with every required value."""
    if seen is not None:
        missing = " OR ".join(f"`{c}` IS NULL" for c in required)
        rows = rows.observe(seen.keys, F.expr(f"count_if({missing})").alias("null_key"))
    return rows.na.drop("any", subset=required)


def _changed(rows: DataFrame, tests: dict[str, str], seen: Seen | None) -> DataFrame:
    """Counts the rows for which each test holds."""
    if seen is None:
        return rows
    return rows.observe(seen.values, *[F.expr(f"count_if({t})").alias(name) for name, t in tests.items()])


def clean_lodgings(raw: DataFrame, missing_name: str | None = "nan", seen: Seen | None = None) -> DataFrame:
    """Details file to ``stg_hostels`` rows: first row per id in file order.

    A missing name is stored as the text ``nan``; pass ``missing_name=None`` to
    keep it null.
    """
    name = "name" if missing_name is None else f"coalesce(name, {literal(missing_name)}) AS name"
    complete = _complete(raw.withColumnsRenamed(DETAIL_NAMES), DETAIL_REQUIRED, seen)
    filled = {f"filled {c}": f"{c} IS NULL" for c in ("name", "star_rating", "total_ratings", "free_cancellation")}
    complete = _changed(complete, filled | {"unknown free_cancellation": odd_flag("free_cancellation")}, seen)
    typed = complete.selectExpr(
        f"{whole_number('id_hostel', 'INT')} AS id_hostel",
        name,
        "type",
        f"coalesce({whole_number('star_rating', 'INT')}, 0) AS star_rating",
        "city_name",
        "city_country",
        f"coalesce({whole_number('total_ratings', 'INT')}, 0) AS total_ratings",
        f"{flag('free_cancellation')} AS free_cancellation",
        ROW_ORDER,
    )
    return keep_first(typed, ["id_hostel"], ROW_ORDER, keep_order=False, seen=seen and seen.copies)


def clean_reviews(raw: DataFrame, seen: Seen | None = None) -> DataFrame:
    """Reviews file to typed rows, first row per review id in file order.

    Profile columns and the row order stay on, for ``clean_users``.
    """
    typed = _complete(raw, REVIEW_REQUIRED, seen).selectExpr(
        f"{whole_number('id_review')} AS id_review",
        f"{whole_number('id_hostel', 'INT')} AS id_hostel",
        f"{whole_number('id_user')} AS id_user",
        "CAST(review_date AS DATE) AS review_date",
        *[f"{lenient_decimal(c)} AS {n}" for c, n in RATINGS.items()],
        *[f"{c} AS {n}" for c, n in PROFILE.items()],
        f"{whole_number('user_number_reviews', 'INT')} AS number_reviews",
        ROW_ORDER,
        *(RATINGS if seen else []),
    )
    coerced = {f"coerced {n}": f"{c} IS NOT NULL AND {n} IS NULL" for c, n in RATINGS.items()}
    typed = _changed(typed, coerced, seen).drop(*RATINGS)
    return keep_first(typed, ["id_review"], ROW_ORDER, seen=seen and seen.copies)


def known_ids(lodgings: DataFrame) -> DataFrame:
    return lodgings.selectExpr("id_hostel", "true AS known")


def mark_known(reviews: DataFrame, lodgings: DataFrame) -> DataFrame:
    """Add ``known``: whether the review's lodging exists. One join serves both
    the reviews to load and the orphans to set aside."""
    if not fits_broadcast(known_ids(lodgings)) and marked_in_place(lodgings):
        return mark_present(reviews, lodgings, "id_hostel", "known")
    marked = lookup(reviews, known_ids(lodgings), "id_hostel", "left", row_id="id_review")
    return marked.fillna({"known": False})


def marked_in_place(lodgings: DataFrame) -> bool:
    """Whether ``mark_known`` leaves the reviews where they are."""
    return fits_broadcast(known_ids(lodgings)) or fits_bits(lodgings, "id_hostel")


def clean_users(reviews: DataFrame) -> DataFrame:
    """Users named in the surviving reviews; the first profile seen stays."""
    profile = reviews.select("id_user", *PROFILE.values(), "number_reviews", ROW_ORDER)
    return keep_first(profile, ["id_user"], ROW_ORDER, keep_order=False)
