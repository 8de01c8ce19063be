"""Warehouse tables: column types, keys, limits and parent links.

Everything the loader, the quality rules and the cascade need to know about a
table is declared here once, so no other module repeats column lists. Counts
and ranks are ``bigint``, so that one lodging may have more than 2^31 reviews.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: rating dimensions, in the order drivers are listed --------
DIMENSIONS = ["safety", "location", "staff", "atmosphere", "cleanliness", "facilities"]

# --- Fixed values: sample sizes below which a result is flagged or left out --
MIN_REVIEWS_GROUP = 10
MIN_REVIEWS_SEGMENT = 30
MIN_LODGINGS_VOLUME = 3

# --- Fixed values: text that means "missing" in the input files --------------
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- Fixed values: documented domains (reported, never rejected) -------------
LODGING_TYPES = ["HOSTEL", "HOTEL", "GUESTHOUSE", "APARTMENT", "CAMPSITE"]
GENDER_CODES = ["FEMALE", "MALE", "COUPLE", "ALLFEMALEGROUP", "MIXEDGROUP", "ALLMALEGROUP"]
AGE_RANGES = ["18-24", "25-30", "31-40", "41+"]
TRIP_CODES = ["REGULARVACATION", "RTWTRIP", "GAPYEAR", "WEEKENDAWAY", "OTHER", "COLLEGEBREAK"]
LOG_STATUSES = ["success", "failed", "skipped"]


@dataclass(frozen=True)
class Table:
    """One warehouse table.

    ``stamp`` is the load-time column the sink fills in. ``parents`` maps a
    column to the (table, column) it must exist in; refreshing that table
    clears this one.

    ``clustered`` puts the rows in order over all files of the table, ``ordered``
    only inside each file; ``looked_up`` are columns that rows are searched by in
    any order. Readers skip what the files' statistics and filters rule out.
    """

    name: str
    columns: dict[str, str]
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    domains: dict[str, list] = field(default_factory=dict)
    stamp: str | None = None
    clustered: tuple[str, ...] = ()
    ordered: tuple[str, ...] = ()
    looked_up: tuple[str, ...] = ()

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self.columns.items())

    @property
    def data_columns(self) -> list[str]:
        return [c for c in self.columns if c != self.stamp]

    @property
    def decimals(self) -> dict[str, str]:
        return {c: t for c, t in self.columns.items() if t.startswith("decimal")}


def _each(names: list[str], kind: str) -> dict[str, str]:
    return {n: kind for n in names}


_RATING = "decimal(5,2)"
_AVERAGE = "decimal(6,2)"
_CORRELATION = "decimal(5,4)"
_CORRELATIONS = _each([f"corr_{d}" for d in DIMENSIONS], _CORRELATION)

_ALL = [
    Table(
        "stg_hostels",
        {
            "id_hostel": "int", "name": "string", "type": "string", "star_rating": "int",
            "city_name": "string", "city_country": "string", "total_ratings": "int",
            "free_cancellation": "boolean", "loaded_at": "timestamp_ntz",
        },
        key=("id_hostel",),
        required=("id_hostel", "name", "type", "star_rating", "city_name", "city_country", "total_ratings"),
        lengths={"type": 30},
        domains={"type": LODGING_TYPES, "star_rating": [0, 1, 2, 3, 4, 5]},
        stamp="loaded_at",
        ordered=("city_country", "type", "star_rating"),
    ),
    Table(
        "stg_users",
        {
            "id_user": "bigint", "gender_code": "string", "age_range": "string",
            "trip_code": "string", "nationality_code": "string", "nationality_name": "string",
            "number_reviews": "int", "loaded_at": "timestamp_ntz",
        },
        key=("id_user",),
        required=("id_user",),
        lengths={"gender_code": 20, "age_range": 10, "trip_code": 30, "nationality_code": 10},
        domains={"gender_code": GENDER_CODES, "age_range": AGE_RANGES, "trip_code": TRIP_CODES},
        stamp="loaded_at",
    ),
    Table(
        "stg_reviews",
        {
            "id_review": "bigint", "id_hostel": "int", "id_user": "bigint", "review_date": "date",
            **_each([f"rating_{d}" for d in ["overall", *DIMENSIONS]], _RATING),
            "loaded_at": "timestamp_ntz",
        },
        key=("id_review",),
        required=("id_review", "id_hostel", "id_user"),
        parents={"id_hostel": ("stg_hostels", "id_hostel")},
        stamp="loaded_at",
        # The id at the end splits a lodging with very many reviews over files.
        clustered=("id_hostel", "review_date", "id_review"),
        looked_up=("id_user", "id_review"),
    ),
    Table(
        "kpi_coverage",
        {
            "total_hostels": "bigint", "hostels_with_reviews": "bigint", "coverage_pct": _RATING,
            "calculated_at": "timestamp_ntz",
        },
        required=("total_hostels", "hostels_with_reviews", "coverage_pct"),
        stamp="calculated_at",
    ),
    Table(
        "kpi_hostel_ratings",
        {
            "id_hostel": "int", "review_count": "bigint",
            **_each([f"avg_{d}" for d in ["overall", *DIMENSIONS]], _AVERAGE),
            "stddev_overall": _AVERAGE, "calculated_at": "timestamp_ntz",
        },
        key=("id_hostel",),
        required=("id_hostel", "review_count"),
        parents={"id_hostel": ("stg_hostels", "id_hostel")},
        stamp="calculated_at",
    ),
    Table(
        "kpi_equivalent_groups",
        {
            "group_key": "string", "group_level": "string", "star_rating": "int",
            "hostel_type": "string", "location": "string", "hostel_count": "bigint",
            "review_count": "bigint", "avg_overall_group": _AVERAGE, "is_valid": "boolean",
            "calculated_at": "timestamp_ntz",
        },
        key=("group_key",),
        required=("group_key", "group_level", "star_rating", "hostel_type", "location",
                  "hostel_count", "review_count", "avg_overall_group", "is_valid"),
        lengths={"group_level": 10, "hostel_type": 30},
        stamp="calculated_at",
    ),
    Table(
        "kpi_hostel_ranking",
        {
            "id_hostel": "int", "group_key": "string", "avg_overall": _AVERAGE,
            "rank_in_group": "bigint", "deviation_from_group": _AVERAGE, "review_count": "bigint",
            "calculated_at": "timestamp_ntz",
        },
        key=("id_hostel",),
        required=("id_hostel", "group_key", "avg_overall", "rank_in_group",
                  "deviation_from_group", "review_count"),
        parents={"id_hostel": ("stg_hostels", "id_hostel"),
                 "group_key": ("kpi_equivalent_groups", "group_key")},
        stamp="calculated_at",
        ordered=("group_key", "rank_in_group"),
    ),
    Table(
        "kpi_volume_vs_rating",
        {
            "group_key": "string", "pearson_r": _CORRELATION, "sample_size": "bigint",
            "calculated_at": "timestamp_ntz",
        },
        key=("group_key",),
        required=("group_key", "sample_size"),
        parents={"group_key": ("kpi_equivalent_groups", "group_key")},
        stamp="calculated_at",
    ),
    Table(
        "kpi_global_drivers",
        {
            "group_key": "string", **_CORRELATIONS, "top_driver": "string", "sample_size": "bigint",
            "calculated_at": "timestamp_ntz",
        },
        key=("group_key",),
        required=("group_key", "sample_size"),
        lengths={"top_driver": 20},
        parents={"group_key": ("kpi_equivalent_groups", "group_key")},
        stamp="calculated_at",
    ),
    Table(
        "kpi_user_profile_drivers",
        {
            "trip_code": "string", "gender_code": "string", "age_range": "string",
            "hostel_type": "string", "segment_key": "string", **_CORRELATIONS,
            "top_driver": "string", "sample_size": "bigint", "is_valid": "boolean",
            "calculated_at": "timestamp_ntz",
        },
        key=("segment_key",),
        required=("segment_key", "sample_size", "is_valid"),
        lengths={"trip_code": 30, "gender_code": 20, "age_range": 10, "hostel_type": 30, "top_driver": 20},
        stamp="calculated_at",
        ordered=("segment_key",),
    ),
    Table(
        "pipeline_run_log",
        {
            "dag_run_id": "string", "stage": "string", "status": "string",
            "records_processed": "bigint", "records_excluded": "bigint", "exclusion_reason": "string",
            "started_at": "timestamp_ntz", "finished_at": "timestamp_ntz",
        },
        required=("dag_run_id", "stage", "status"),
        lengths={"stage": 50, "status": 20},
        domains={"status": LOG_STATUSES},
    ),
]

TABLES: dict[str, Table] = {t.name: t for t in _ALL}


def dependants(name: str) -> set[str]:
    """Tables that become empty when ``name`` is refreshed, however deep."""
    found: set[str] = set()
    todo = [name]
    while todo:
        parent = todo.pop()
        for table in _ALL:
            linked = any(p == parent for p, _ in table.parents.values())
            if linked and table.name != name and table.name not in found:
                found.add(table.name)
                todo.append(table.name)
    return found
