"""The registered queries restated in SQL, for an independent engine to check.

``WITH`` parts give staging tables under the warehouse's names, either straight
from the given tables (``STAR``) or through the dirty files (``FILES``); the KPI
texts then read those names.
"""

from __future__ import annotations

from guestlens.schemas import DIMENSIONS, TABLES

ALL = ["overall", *DIMENSIONS]


def _rounded(expr: str, digits: int = 2, places: int = 10) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,{places})), {digits}) AS DOUBLE)"


_LINE_RATINGS = """
    l_tax AS rating_location,
    CAST(floor(l_extendedprice / l_quantity / 200) AS DOUBLE) AS rating_staff,
    CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) / 10.0) AS DOUBLE) AS rating_atmosphere,
    CAST(floor(o_totalprice / 1000) AS DOUBLE) AS rating_cleanliness,
    CAST(l_linenumber AS DOUBLE) AS rating_facilities
"""

STAR = f"""
stg_hostels AS (
  SELECT c_custkey AS id_hostel, c_name AS name, c_mktsegment AS type,
         CAST(floor(greatest(c_acctbal, 0.0) / 2000) AS INTEGER) AS star_rating,
         n_name AS city_name, r_name AS city_country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
stg_users AS (
  SELECT p_partkey AS id_user, p_brand AS gender_code,
         CAST(CAST(floor(p_size / 10) AS INTEGER) AS VARCHAR) AS age_range, p_type AS trip_code
  FROM part),
stg_reviews AS (
  SELECT l_orderkey * 10 + l_linenumber AS id_review, o_custkey AS id_hostel, l_partkey AS id_user,
    CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS rating_overall,
    CASE WHEN l_linestatus <> 'O' THEN l_discount END AS rating_safety,
    {_LINE_RATINGS}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

DATED = """dated AS (
  SELECT l_orderkey * 10 + l_linenumber AS id_review, CAST(o_custkey AS INTEGER) AS id_hostel, l_partkey AS id_user,
    CAST(l_shipdate AS DATE) AS review_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_FILE_ORDER = (
    "id_review, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate"
)

FILES = f"""
detail_rows AS (
  SELECT *, unnest(CASE WHEN c_mktsegment = 'BUILDING' THEN [0, 1] ELSE [0] END) AS copy
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_acctbal >= -500),
first_details AS (
  SELECT * FROM detail_rows
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY copy) = 1),
stg_hostels AS (
  SELECT CAST(c_custkey AS INTEGER) AS id_hostel,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'nan' ELSE c_name END AS name,
    c_mktsegment AS type,
    CASE WHEN c_acctbal < 0 THEN 0 ELSE CAST(floor(c_acctbal / 2000) AS INTEGER) END AS star_rating,
    CASE WHEN r_name = 'ASIA' THEN n_name || '; "old" town' ELSE n_name END AS city_name,
    r_name AS city_country,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 0 ELSE c_nationkey END AS total_ratings,
    c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') AS free_cancellation
  FROM first_details),
file_rows AS (
  SELECT *, l_orderkey * 10 + l_linenumber AS id_review, o_custkey AS id_hostel, l_partkey AS id_user,
    CASE WHEN l_returnflag <> 'A' THEN CAST(l_shipdate AS DATE) END AS review_date,
    CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'F') THEN l_quantity END AS rating_overall,
    CASE WHEN l_linestatus <> 'O' THEN l_discount END AS rating_safety,
    {_LINE_RATINGS},
    CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS gender_code,
    l_linestatus AS age_range,
    o_orderpriority AS trip_code,
    CASE WHEN l_linestatus <> 'O' THEN o_orderstatus END AS nationality_code,
    'the "' || o_orderstatus || '"; isles' AS nationality_name,
    l_linenumber AS number_reviews
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE NOT (l_returnflag = 'A' AND l_linestatus = 'O')),
first_rows AS (
  SELECT * FROM file_rows
  QUALIFY row_number() OVER (PARTITION BY id_review ORDER BY {_FILE_ORDER}) = 1),
stg_reviews AS (
  SELECT * FROM first_rows WHERE id_hostel IN (SELECT id_hostel FROM stg_hostels)),
stg_users AS (
  SELECT id_user, gender_code, age_range, trip_code, nationality_code, nationality_name, number_reviews
  FROM stg_reviews
  QUALIFY row_number() OVER (PARTITION BY id_user ORDER BY {_FILE_ORDER}) = 1)
"""

COVERAGE = """
SELECT total_hostels, hostels_with_reviews,
  CAST(ROUND(CAST(hostels_with_reviews * 100.0 / NULLIF(total_hostels, 0) AS DECIMAL(28,10)), 2) AS DOUBLE) AS coverage_pct
FROM (SELECT (SELECT count(*) FROM stg_hostels) AS total_hostels,
             count(DISTINCT id_hostel) AS hostels_with_reviews FROM stg_reviews)
"""

RATINGS = f"""
SELECT id_hostel, count(*) AS review_count,
  {", ".join(f"{_rounded(f'avg(rating_{d})')} AS avg_{d}" for d in ALL)},
  {_rounded("stddev_samp(rating_overall)")} AS stddev_overall
FROM stg_reviews WHERE rating_overall IS NOT NULL GROUP BY id_hostel
"""


# Totals per lodging with a rated review. Means are quotients of sums.
_TOTALS = """
totals AS (
  SELECT star_rating, type, city_name, city_country, id_hostel,
    count(*) AS reviews, sum(CAST(rating_overall AS DECIMAL(18,2))) AS points
  FROM stg_reviews JOIN stg_hostels USING (id_hostel) WHERE rating_overall IS NOT NULL
  GROUP BY ALL),
placed AS (
  SELECT *, concat_ws('|', star_rating, type, 'city', city_name) AS group_key,
    round(CAST(points AS DECIMAL(28,10)) / reviews, 2) AS mean
  FROM totals),
sized AS (
  SELECT group_key, sum(reviews) AS reviews, round(CAST(sum(points) AS DECIMAL(28,10)) / sum(reviews), 2) AS mean
  FROM placed GROUP BY group_key HAVING sum(reviews) >= 10)
"""


def _groups(level: str, place: str) -> str:
    return f"""
SELECT * FROM (WITH {_TOTALS}
SELECT concat_ws('|', star_rating, type, '{level}', {place}) AS group_key, '{level}' AS group_level,
  star_rating, type AS hostel_type, {place} AS location, count(*) AS hostel_count,
  CAST(sum(reviews) AS BIGINT) AS review_count,
  {_rounded("CAST(sum(points) AS DECIMAL(28,10)) / sum(reviews)")} AS avg_overall_group,
  sum(reviews) >= 10 AS is_valid
FROM totals GROUP BY star_rating, type, {place})
"""


GROUPS_CITY = _groups("city", "city_name")
GROUPS_COUNTRY = _groups("country", "city_country")
GROUPS = f"({GROUPS_CITY}) UNION ALL ({GROUPS_COUNTRY})"

# A rank is one more than the lodgings of the group with a higher mean.
RANKING = f"""
SELECT * FROM (WITH {_TOTALS},
steps AS (SELECT group_key, mean, count(*) AS n FROM placed GROUP BY ALL),
higher AS (
  SELECT a.group_key, a.mean, coalesce(sum(b.n), 0) AS n
  FROM steps a LEFT JOIN steps b ON a.group_key = b.group_key AND b.mean > a.mean GROUP BY ALL)
SELECT p.id_hostel, p.group_key, CAST(p.mean AS DOUBLE) AS avg_overall, CAST(h.n + 1 AS BIGINT) AS rank_in_group,
  {_rounded("p.mean - s.mean")} AS deviation_from_group, p.reviews AS review_count
FROM placed p JOIN sized s USING (group_key) JOIN higher h ON h.group_key = p.group_key AND h.mean = p.mean)
"""

# Pearson's r from its definition, over lodgings.
VOLUME = f"""
SELECT * FROM (WITH {_TOTALS},
centred AS (
  SELECT group_key, p.reviews - avg(p.reviews) OVER g AS x,
    CAST(p.mean AS DOUBLE) - avg(CAST(p.mean AS DOUBLE)) OVER g AS y,
    min(p.reviews) OVER g = max(p.reviews) OVER g OR min(p.mean) OVER g = max(p.mean) OVER g AS flat
  FROM placed p JOIN sized USING (group_key) WINDOW g AS (PARTITION BY group_key))
SELECT group_key, CASE WHEN NOT any_value(flat) THEN {_rounded("sum(x * y) / sqrt(sum(x * x) * sum(y * y))", 4, 12)} END AS pearson_r,
  count(*) AS sample_size
FROM centred GROUP BY group_key HAVING count(*) >= 3)
"""


def _drivers(segment: list[str], result: str, least: str) -> str:
    """One row per segment and dimension with its r, from deviations; the name is the
    first of the dimensions ordered by size, then place. ``rated`` names the rows."""
    own = ", ".join(segment)
    pairs = " UNION ALL ".join(
        f"SELECT {own}, {i} AS place, '{d}' AS dimension, CAST(rating_{d} AS DOUBLE) AS x, CAST(rating_overall AS DOUBLE) AS y "
        f"FROM rated WHERE rating_{d} IS NOT NULL"
        for i, d in enumerate(DIMENSIONS)
    )
    listed = ", ".join(f"({i}, '{d}')" for i, d in enumerate(DIMENSIONS))
    shown = ", ".join(f"{_rounded(f'any_value(r) FILTER (place = {i})', 4, 12)} AS corr_{d}" for i, d in enumerate(DIMENSIONS))
    return f"""
pairs AS ({pairs}),
deviations AS (
  SELECT {own}, place, x - avg(x) OVER p AS dx, y - avg(y) OVER p AS dy,
    min(x) OVER p = max(x) OVER p OR min(y) OVER p = max(y) OVER p AS flat
  FROM pairs WINDOW p AS (PARTITION BY {own}, place)),
strengths AS (
  SELECT {own}, place, CASE WHEN NOT any_value(flat) THEN sum(dx * dy) / sqrt(sum(dx * dx) * sum(dy * dy)) END AS r
  FROM deviations GROUP BY ALL),
sizes AS (SELECT {own}, count(*) AS sample_size FROM rated GROUP BY ALL),
every AS (
  SELECT sizes.*, place, dimension, r
  FROM sizes CROSS JOIN (VALUES {listed}) named(place, dimension) LEFT JOIN strengths USING ({own}, place))
SELECT {result}, {shown}, first(dimension ORDER BY round(abs(r), 10) DESC NULLS LAST, place) AS top_driver, sample_size
FROM every WHERE sample_size >= {least} GROUP BY {own}, sample_size)
"""


GROUP_DRIVERS = """
SELECT * FROM (WITH rated AS (
  SELECT concat_ws('|', star_rating, type, 'city', city_name) AS group_key, stg_reviews.*
  FROM stg_reviews JOIN stg_hostels USING (id_hostel) WHERE rating_overall IS NOT NULL),
""" + _drivers(["group_key"], "group_key", "10")

PROFILE_DRIVERS = """
SELECT * FROM (WITH profiles AS (
  SELECT id_user, trip_code, gender_code, age_range FROM stg_users
  WHERE trip_code || gender_code || age_range IS NOT NULL),
rated AS (
  SELECT profiles.*, type AS hostel_type, {ratings}
  FROM profiles JOIN stg_reviews USING (id_user) JOIN stg_hostels USING (id_hostel) WHERE rating_overall IS NOT NULL),
""".format(ratings=", ".join(f"rating_{d}" for d in ALL)) + _drivers(
    ["trip_code", "gender_code", "age_range", "hostel_type"],
    "trip_code, gender_code, age_range, hostel_type, concat_ws('|', trip_code, gender_code, age_range, hostel_type) AS segment_key, "
    "sample_size >= 30 AS is_valid",
    "0",
)


# Rows of each stage: those it loaded, set aside, or found valid.
RUN_LOG = """
SELECT stage, records_processed, records_excluded, 'success' AS status, exclusion_reason
FROM (VALUES
  ('verificar_archivos', 0, 0, NULL),
  ('cargar_staging_hostels', (SELECT count(*) FROM stg_hostels), 0, NULL),
  ('cargar_staging_reviews', (SELECT count(*) FROM stg_reviews),
   (SELECT count(*) FROM first_rows) - (SELECT count(*) FROM stg_reviews), 'hostel_no_encontrado_en_detail'),
  ('calcular_kpi_cobertura', 1, 0, NULL),
  ('calcular_kpi_ratings', (SELECT count(*) FROM kpi_hostel_ratings), 0, NULL),
  ('calcular_kpi_grupos_y_rankings', (SELECT count(*) FROM kpi_equivalent_groups WHERE is_valid), 0, NULL),
  ('calcular_kpi_drivers', (SELECT count(*) FROM kpi_global_drivers), 0, NULL)
) log(stage, records_processed, records_excluded, exclusion_reason)
"""


def tidy(tables: dict[str, str]) -> str:
    """Every measure of every KPI table and of the run log as one row."""
    texts = {
        "kpi_coverage": COVERAGE, "kpi_hostel_ratings": RATINGS,
        "kpi_equivalent_groups": GROUPS, "kpi_hostel_ranking": RANKING,
        "kpi_volume_vs_rating": VOLUME, "kpi_global_drivers": GROUP_DRIVERS,
        "kpi_user_profile_drivers": PROFILE_DRIVERS, "pipeline_run_log": RUN_LOG,
    }
    parts = []
    for name, (key, measures, words) in tables.items():
        for m in [*measures, *words]:
            value = "CAST(NULL AS DOUBLE)" if m in words else f"CAST({m} AS DOUBLE)"
            word = m if m in words else "CAST(NULL AS VARCHAR)"
            parts.append(
                f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS row_key, "
                f"'{m}' AS measure, {value} AS value, {word} AS word FROM {name}"
            )
    ctes = ", ".join(f"{n} AS MATERIALIZED ({texts[n]})" for n in tables)
    return f"WITH {FILES}, {ctes} " + " UNION ALL ".join(parts)


def run_report() -> str:
    """Violations per declared rule, and rows that have a load time."""
    texts = {
        "kpi_coverage": COVERAGE, "kpi_hostel_ratings": RATINGS,
        "kpi_equivalent_groups": GROUPS, "kpi_hostel_ranking": RANKING,
        "kpi_volume_vs_rating": VOLUME, "kpi_global_drivers": GROUP_DRIVERS,
        "kpi_user_profile_drivers": PROFILE_DRIVERS,
    }
    parts = []
    for name, table in TABLES.items():
        if not table.stamp:
            continue
        tests = [("required", c, f"{c} IS NULL") for c in table.required]
        tests += [("length", c, f"length({c}) > {n}") for c, n in table.lengths.items()]
        tests += [("domain", c, f"{c} NOT IN ({', '.join(map(repr, v))})") for c, v in table.domains.items()]
        tests.append(("stamped", table.stamp, "true"))
        parts += [
            f"SELECT '{name}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
            f"count(*) FILTER ({test}) AS violations FROM {name}"
            for rule, column, test in tests
        ]
        broken = [("unique", ",".join(table.key), f"count(*) - count(DISTINCT ({', '.join(table.key)})) FROM {name}")] if table.key else []
        broken += [
            ("parent", column, f"count(*) FROM {name} WHERE {column} NOT IN (SELECT {key} FROM {parent})")
            for column, (parent, key) in table.parents.items()
        ]
        parts += [f"SELECT '{name}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, {count}" for rule, column, count in broken]
    ctes = ", ".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in texts.items())
    return f"WITH {FILES}, {ctes} " + " UNION ALL ".join(parts)


def volume_report() -> str:
    """Rows per table and version; a run publishes all of its tables at once, as the
    fifth publication here. The median of three versions is the middle one."""
    stars = "CAST(floor(greatest(c_acctbal, 0.0) / 2000) AS INTEGER)"
    texts = {
        "kpi_coverage": COVERAGE, "kpi_hostel_ratings": RATINGS,
        "kpi_equivalent_groups": GROUPS, "kpi_hostel_ranking": RANKING,
        "kpi_volume_vs_rating": VOLUME, "kpi_global_drivers": GROUP_DRIVERS,
        "kpi_user_profile_drivers": PROFILE_DRIVERS,
    }
    counted = [
        ("stg_hostels", 1, "FROM customer", "NULL"),
        ("stg_reviews", 2, "FROM lineitem JOIN orders ON l_orderkey = o_orderkey", "NULL"),
        ("stg_hostels", 3, f"FROM customer WHERE {stars} > 0", "SELECT count(*) FROM customer"),
        ("stg_hostels", 4, f"FROM customer WHERE {stars} > 1", f"SELECT count(*) FROM customer WHERE {stars} > 0"),
        ("stg_hostels", 5, "FROM stg_hostels", f"SELECT count(*) FROM customer WHERE {stars} > 0"),
        ("stg_reviews", 5, "FROM stg_reviews", "SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
        *[(name, 5, f"FROM {name}", "NULL") for name in ["stg_users", *texts]],
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST({number} AS BIGINT) AS publication, (SELECT count(*) {source}) AS actual, CAST(({expected}) AS BIGINT) AS expected"
        for name, number, source, expected in counted
    )
    ctes = ", ".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in texts.items())
    return f"WITH {FILES}, {ctes} SELECT *, abs(actual - expected) <= expected * 0.01 AS within_tolerance FROM ({rows})"


def load_ledger() -> str:
    """Rows of the files by what became of them, counted one by one."""
    details = {
        "read": "SELECT count(*) + count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer",
        "surplus": "SELECT 0",
        "null_key": "SELECT count(*) + count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer WHERE c_acctbal < -500",
        "duplicate": "SELECT count(*) FROM detail_rows WHERE copy = 1",
        "loaded": "SELECT count(*) FROM stg_hostels",
        "filled name": "SELECT count(*) FROM detail_rows WHERE c_mktsegment = 'MACHINERY'",
        "filled star_rating": "SELECT count(*) FROM detail_rows WHERE c_acctbal < 0",
        "filled total_ratings": "SELECT count(*) FROM detail_rows WHERE c_mktsegment = 'FURNITURE'",
        "filled free_cancellation": "SELECT count(*) FROM detail_rows WHERE c_mktsegment = 'FURNITURE'",
        "unknown free_cancellation": "SELECT 0",
    }
    reviews = {
        "read": "SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events)",
        "surplus": "SELECT count(*) FROM events",
        "null_key": "SELECT count(*) FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'O'",
        "duplicate": "SELECT count(*) - count(DISTINCT id_review) FROM file_rows",
        "orphan": "SELECT count(*) FROM first_rows WHERE id_hostel NOT IN (SELECT id_hostel FROM stg_hostels)",
        "loaded": "SELECT count(*) FROM stg_reviews",
        **{f"coerced rating_{d}": "SELECT 0" for d in ALL},
        "coerced rating_overall": "SELECT count(*) FROM file_rows WHERE l_returnflag = 'R' AND l_linestatus = 'F'",
    }
    rows = [
        f"SELECT '{table}' AS table_name, '{what.partition(' ')[0]}' AS cause, '{what.partition(' ')[2]}' AS column_name, "
        f"CAST(({count}) AS BIGINT) AS rows"
        for table, counts in (("stg_hostels", details), ("stg_reviews", reviews))
        for what, count in counts.items()
    ]
    return f"WITH {FILES} " + " UNION ALL ".join(rows)


def on_star(sql: str) -> str:
    return f"WITH {STAR}, {DATED} {sql}" if "dated" in sql else f"WITH {STAR} {sql}"


def on_files(sql: str) -> str:
    return f"WITH {FILES} {sql}"
