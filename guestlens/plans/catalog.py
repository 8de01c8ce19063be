"""Every query by name, each over the whole given tables, with its SQL check.

A query that needs an input the tables do not have by themselves (null tokens,
bad numbers, missing keys) derives it from column values of every row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guestlens.functions.stats import from_hundredths, hundredths, rounded_mean, sample_deviation
from guestlens.functions.text import flag, lenient_decimal, null_tokens, text_key, whole_number
from guestlens.operators import quality
from guestlens.operators.rows import insert_if_absent, keep_first, lookup
from guestlens.plans import kpis, oracle, staging, star
from guestlens.plans.full_run import full_run, ledger, report
from guestlens.schemas import DIMENSIONS, NULL_TOKENS, TABLES
from guestlens.sources.delimited import read_delimited
from guestlens.sources.shared import shared_folder
from guestlens.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which is how the SQL check returns them."""
    return df.selectExpr(
        *[f"CAST({c} AS DOUBLE) AS {c}" if t.startswith("decimal") else c for c, t in df.dtypes]
    )


# -- KPI queries ---------------------------------------------------------------


@query(
    "SELECT *, CAST(ROUND(CAST(hostels_with_reviews * 100.0 / NULLIF(total_hostels, 0) AS DECIMAL(28,10)), 2) AS DOUBLE) AS coverage_pct "
    "FROM (SELECT (SELECT count(*) FROM customer) AS total_hostels, "
    "count(DISTINCT user_id) AS hostels_with_reviews FROM events)"
)
def kpi_coverage(spark, folder):
    """Customers that occur in the event stream."""
    visits = star.table(spark, folder, "events").select(F.col("user_id").alias("id_hostel"))
    return plain(kpis.coverage(star.table(spark, folder, "customer"), visits))


def _sums(spark, folder) -> DataFrame:
    return kpis.lodging_sums(star.reviews(spark, folder))


@query(oracle.on_star(oracle.RATINGS))
def kpi_entity_ratings(spark, folder):
    return plain(kpis.lodging_ratings(_sums(spark, folder)))


@query(oracle.on_star(oracle.GROUPS_CITY))
def kpi_groups_city(spark, folder):
    lodgings = star.lodgings(spark, folder)
    return plain(kpis.equivalent_groups(_sums(spark, folder), lodgings, ("city",)))


@query(oracle.on_star(oracle.GROUPS_COUNTRY))
def kpi_groups_country(spark, folder):
    lodgings = star.lodgings(spark, folder)
    return plain(kpis.equivalent_groups(_sums(spark, folder), lodgings, ("country",)))


@query(oracle.on_star(oracle.GROUPS))
def kpi_groups_all(spark, folder):
    return plain(kpis.equivalent_groups(_sums(spark, folder), star.lodgings(spark, folder)))


@query(oracle.on_star(oracle.RANKING))
def kpi_rank_in_group(spark, folder):
    return plain(kpis.ranking(_sums(spark, folder), star.lodgings(spark, folder)))


@query(oracle.on_star(oracle.VOLUME))
def kpi_volume_vs_rating(spark, folder):
    return plain(kpis.volume_vs_rating(_sums(spark, folder), star.lodgings(spark, folder)))


@query(oracle.on_star(oracle.GROUP_DRIVERS))
def kpi_group_drivers(spark, folder):
    return plain(kpis.group_drivers(_sums(spark, folder), star.lodgings(spark, folder)))


@query(oracle.on_star(oracle.PROFILE_DRIVERS))
def kpi_profile_drivers(spark, folder):
    return plain(
        kpis.profile_drivers(
            star.reviews(spark, folder), star.users(spark, folder), star.lodging_types(spark, folder)
        )
    )


# -- row operators -------------------------------------------------------------

_LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(
    "SELECT * FROM lineitem QUALIFY row_number() OVER "
    f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_ORDER)}) = 1"
)
def keep_first_dedupe(spark, folder):
    return keep_first(star.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)


def _active(spark, folder) -> DataFrame:
    """Customers seen in the event stream, as the list of known lodgings."""
    events = star.table(spark, folder, "events")
    return events.select(F.col("user_id").alias("o_custkey")).distinct()


@query("SELECT * FROM orders WHERE o_custkey IN (SELECT user_id FROM events)")
def valid_reviews(spark, folder):
    return lookup(star.table(spark, folder, "orders"), _active(spark, folder), "o_custkey", "left_semi")


@query("SELECT * FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def orphan_reviews(spark, folder):
    return lookup(star.table(spark, folder, "orders"), _active(spark, folder), "o_custkey", "left_anti")


@query(
    "SELECT o_custkey IN (SELECT user_id FROM events) AS known, count(*) AS n FROM orders GROUP BY 1"
)
def orphan_counts(spark, folder):
    known = _active(spark, folder).withColumn("known", F.lit(True))
    marked = lookup(star.table(spark, folder, "orders"), known, "o_custkey", "left")
    return marked.groupBy(F.coalesce("known", F.lit(False)).alias("known")).agg(F.count("*").alias("n"))


@query(
    "SELECT l_orderkey, CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS l_partkey, "
    "CASE WHEN l_linestatus <> 'O' THEN l_quantity END AS l_quantity "
    "FROM lineitem WHERE l_returnflag <> 'R'"
)
def drop_null_keys(spark, folder):
    """Only nulls in the listed columns drop a row; returned lines lose their key."""
    lines = star.table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("l_partkey"),
        F.when(F.col("l_linestatus") != "O", F.col("l_quantity")).alias("l_quantity"),
    )
    return lines.na.drop("any", subset=["l_orderkey", "l_partkey"])


@query(
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE CAST(trunc(c_acctbal) AS BIGINT) END AS balance, "
    "c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD', 'MACHINERY') AS flagged, "
    "CASE WHEN c_mktsegment = 'BUILDING' THEN 'nan' ELSE c_name END AS name FROM customer"
)
def fill_defaults(spark, folder):
    """Missing whole numbers become 0, missing flags false, a missing name ``nan``."""
    segment = F.col("c_mktsegment")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    text = F.create_map(
        *[
            F.lit(v)
            for pair in {
                "AUTOMOBILE": "TRUE", "HOUSEHOLD": "1", "MACHINERY": "yes", "FURNITURE": "False",
            }.items()
            for v in pair
        ]
    )
    texts = star.table(spark, folder, "customer").select(
        "c_custkey",
        balance.alias("balance"),
        F.try_element_at(text, segment).alias("flagged"),
        F.when(segment != "BUILDING", F.col("c_name")).alias("name"),
    )
    return texts.selectExpr(
        "c_custkey",
        f"coalesce({whole_number('balance')}, 0) AS balance",
        f"{flag('flagged')} AS flagged",
        "coalesce(name, 'nan') AS name",
    )


@query(
    "SELECT event_id, CASE WHEN event_type IN ('view', 'click') "
    "THEN CAST(ROUND(CAST(value AS DECIMAL(20,2)), 1) AS DOUBLE) END AS number FROM events"
)
def coerce_numeric(spark, folder):
    """Plain and padded numbers are read and rounded; anything else is null."""
    kind, number = F.col("event_type"), F.col("value").cast("decimal(20,2)").cast("string")
    text = (
        F.when(kind == "view", F.concat(F.lit("  "), number, F.lit(" ")))
        .when(kind == "click", F.concat(F.lit("+"), number))
        .when(kind == "purchase", F.concat(number, F.lit("d")))
        .when(kind == "error", F.lit("NaN"))
        .otherwise(F.col("props"))
    )
    events = star.table(spark, folder, "events").select("event_id", text.alias("text"))
    number = lenient_decimal("text", "DECIMAL(20,1)")
    return plain(events.selectExpr("event_id", f"{number} AS number"))


# The tokens in SQL, written out: the check must not share the list it checks.
_TOKENS_SQL = """['', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
  '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null']"""


@query(
    f"SELECT conv_id, turn, CASE WHEN NOT list_contains({_TOKENS_SQL}, word) THEN word END AS word FROM "
    f"(SELECT conv_id, turn, CASE role WHEN 'system' THEN {_TOKENS_SQL}[(conv_id + turn) % 19 + 1] "
    f"WHEN 'user' THEN text WHEN 'assistant' THEN {_TOKENS_SQL}[conv_id % 19 + 1] || ' ' "
    "ELSE 'NA' || text END AS word FROM conversations)"
)
def null_tokens_in_text(spark, folder):
    """Every token is met; only a whole value counts, not text that holds one."""
    role = F.col("role")
    tokens = F.array(*[F.lit(t) for t in sorted(NULL_TOKENS)])
    word = (
        F.when(role == "system", F.get(tokens, ((F.col("conv_id") + F.col("turn")) % 19).cast("int")))
        .when(role == "user", F.col("text"))
        .when(role == "assistant", F.concat(F.get(tokens, (F.col("conv_id") % 19).cast("int")), F.lit(" ")))
        .otherwise(F.concat(F.lit("NA"), F.col("text")))
    )
    turns = star.table(spark, folder, "conversations").select("conv_id", "turn", word.alias("word"))
    return turns.selectExpr("conv_id", "turn", f"{null_tokens('word')} AS word")


@query(
    "SELECT doc_id, 'label' AS source FROM labels UNION ALL "
    "SELECT doc_id // 3 AS doc_id, min(source) AS source FROM documents "
    "WHERE source <> 'src3' AND doc_id // 3 NOT IN (SELECT doc_id FROM labels) GROUP BY 1"
)
def insert_if_absent_rows(spark, folder):
    """Three incoming rows per key, some without a key, many already there."""
    target = star.table(spark, folder, "labels").select("doc_id", F.lit("label").alias("source"))
    key = F.when(F.col("source") != "src3", F.floor(F.col("doc_id") / 3))
    incoming = star.table(spark, folder, "documents").select(key.alias("doc_id"), "source")
    return target.unionByName(insert_if_absent(incoming, target, ["doc_id"], "source"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    "l_returnflag || '|' || CASE WHEN l_linestatus <> 'O' THEN l_linestatus END || '|city|' || l_linenumber AS group_key "
    "FROM lineitem"
)
def group_key_nulls(spark, folder):
    """A null part makes the whole key null."""
    status = F.when(F.col("l_linestatus") != "O", F.col("l_linestatus"))
    lines = star.table(spark, folder, "lineitem").withColumn("status", status)
    key = text_key("l_returnflag", "status", "'city'", "l_linenumber")
    return lines.selectExpr("l_orderkey", "l_linenumber", "l_partkey", f"{key} AS group_key")


# -- aggregates ----------------------------------------------------------------


@query(
    "SELECT l_returnflag, count(*) AS n, count(CASE WHEN l_linestatus <> 'O' THEN 1 END) AS closed, "
    "count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders "
    "FROM lineitem GROUP BY l_returnflag"
)
def distinct_counts(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    return lines.groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("l_linestatus") != "O", 1)).alias("closed"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_orderkey").alias("orders"),
    )


@query(
    "SELECT o_custkey, count(*) AS n, "
    "CAST(ROUND(CAST(avg(o_totalprice) AS DECIMAL(28,8)), 2) AS DOUBLE) AS mean, "
    "CAST(ROUND(CAST(stddev_samp(o_totalprice) AS DECIMAL(28,10)), 2) AS DOUBLE) AS deviation "
    "FROM orders GROUP BY o_custkey"
)
def sample_stddev(spark, folder):
    prices = star.table(spark, folder, "orders").selectExpr(
        "o_custkey", f"{hundredths('o_totalprice')} AS price"
    )
    sums = prices.groupBy("o_custkey").agg(
        F.count("*").alias("n"),
        F.sum("price").alias("total"),
        F.expr("sum(CAST(price AS DOUBLE) * price)").alias("squares"),
    )
    mean = from_hundredths(rounded_mean("total", "n"))
    deviation = sample_deviation("n", "total", "squares")
    return plain(sums.selectExpr("o_custkey", "n", f"{mean} AS mean", f"{deviation} AS deviation"))


@query("SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 1")
def latest_row(spark, folder):
    events = star.table(spark, folder, "events")
    return events.select("event_id", "user_id", "event_type", "value").orderBy(F.desc("event_id")).limit(1)


# -- quality -------------------------------------------------------------------

# Per table: required, key, text lengths, decimals, domains, parents.
_RULES = {
    "nation": (["n_name", "n_regionkey"], ["n_nationkey"], {"n_name": 8}, {}, {}, {"n_regionkey": ("region", "r_regionkey")}),
    "customer": (["c_name"], ["c_custkey"], {"c_mktsegment": 8}, {"c_acctbal": "decimal(5,2)"},
                 {"c_mktsegment": ["AUTOMOBILE", "BUILDING"]}, {"c_custkey": ("events", "user_id")}),
    "supplier": ([], ["s_suppkey"], {}, {"s_acctbal": "decimal(6,2)"}, {}, {"s_nationkey": ("nation", "n_nationkey")}),
    "part": ([], ["p_name"], {"p_brand": 7}, {}, {"p_size": [0, 1, 2, 3, 4, 5]}, {}),
    "orders": (["o_orderdate"], ["o_orderkey"], {}, {"o_totalprice": "decimal(7,2)"}, {}, {"o_custkey": ("customer", "c_custkey")}),
    "lineitem": (["l_shipdate"], ["l_orderkey", "l_linenumber"], {}, {"l_extendedprice": "decimal(6,2)"},
                 {"l_returnflag": ["A", "N"]}, {"l_orderkey": ("orders", "o_orderkey")}),
    "events": (["ts"], ["user_id"], {"props": 8}, {"value": "decimal(4,2)"}, {}, {"user_id": ("customer", "c_custkey")}),
    "documents": (["text"], ["text"], {"text": 1000}, {}, {"lang": ["en"]}, {"doc_id": ("labels", "doc_id")}),
    "labels": (["quality", "toxic"], ["doc_id"], {}, {}, {"quality": [1]}, {"doc_id": ("documents", "doc_id")}),
}


# Values taken out of the tables first, so that every rule meets nulls.
_HOLES = {
    "orders": {"o_orderdate": "o_orderkey % 7 = 0", "o_custkey": "o_orderkey % 11 = 0"},
    "lineitem": {"l_shipdate": "l_partkey % 13 = 0", "l_linenumber": "l_suppkey % 5 = 0", "l_returnflag": "l_partkey % 3 = 0"},
    "events": {"ts": "event_id % 10 = 0", "user_id": "event_id % 4 = 0", "value": "event_id % 6 = 0"},
    "documents": {"text": "doc_id % 9 = 0", "lang": "doc_id % 2 = 0"},
}


def _rules_sql() -> str:
    def row(rule, table, column, count):
        return (
            f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST(({count}) AS BIGINT) AS violations"
        )

    rows = []
    for t, (required, key, lengths, decimals, domains, parents) in _RULES.items():
        rows += [row("required", t, c, f"SELECT count(*) FROM {t} WHERE {c} IS NULL") for c in required]
        rows += [row("length", t, c, f"SELECT count(*) FROM {t} WHERE length({c}) > {n}") for c, n in lengths.items()]
        rows += [
            row("precision", t, c, f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {k}) IS NULL")
            for c, k in decimals.items()
        ]
        rows += [
            row("domain", t, c, f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({', '.join(map(repr, v))})")
            for c, v in domains.items()
        ]
        keys, full = ", ".join(key), " AND ".join(f"{k} IS NOT NULL" for k in key)
        rows.append(row("unique", t, ",".join(key), f"SELECT (SELECT count(*) FROM {t} WHERE {full}) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {t} WHERE {full}))"))
        rows += [
            row("parent", t, c, f"SELECT count(*) FROM {t} WHERE {c} NOT IN (SELECT {pc} FROM {p} WHERE {pc} IS NOT NULL)")
            for c, (p, pc) in parents.items()
        ]
    holes = ", ".join(
        f"{t} AS (SELECT * REPLACE ({', '.join(f'CASE WHEN {test} THEN NULL ELSE {c} END AS {c}' for c, test in own.items())}) FROM main.{t})"
        for t, own in _HOLES.items()
    )
    return f"WITH {holes} " + " UNION ALL ".join(rows)


def _with_holes(spark, folder, name) -> DataFrame:
    holes = {c: F.expr(f"CASE WHEN NOT ({test}) THEN {c} END") for c, test in _HOLES.get(name, {}).items()}
    return star.table(spark, folder, name).withColumns(holes)


@query(_rules_sql())
def dq_report(spark, folder):
    parts = []
    for name, (required, key, lengths, decimals, domains, parents) in _RULES.items():
        df = _with_holes(spark, folder, name)
        parts.append(quality.row_rules(df, name, required, lengths, decimals, domains))
        parts.append(quality.unique_rule(df, name, key))
        for column, (parent, parent_column) in parents.items():
            known = _with_holes(spark, folder, parent)
            parts.append(quality.parent_rule(df, name, column, known, parent_column))
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS actual, "
        f"(SELECT {k} * count(*) FROM {b}) AS expected, "
        f"(SELECT abs((SELECT count(*) FROM {t}) - {k} * count(*)) <= 0.05 * {k} * count(*) FROM {b}) AS within_tolerance"
        for t, k, b in [("orders", 10, "customer"), ("lineitem", 4, "orders"), ("documents", 2, "labels")]
    )
)
def reconcile_counts(spark, folder):
    """Table volumes against what the size of another table leads to expect."""

    def rows(name) -> Column:
        return star.table(spark, folder, name).agg(F.count("*")).scalar()

    expected = {"orders": rows("customer") * 10, "lineitem": rows("orders") * 4, "documents": rows("labels") * 2}
    reports = [
        quality.reconcile(star.table(spark, folder, n), n, e, tolerance=0.05) for n, e in expected.items()
    ]
    return reduce(DataFrame.unionByName, reports)


# -- files and the full run ----------------------------------------------------


@query(oracle.on_files("SELECT * FROM stg_hostels"))
def ingest_details_file(spark, folder):
    return staging.clean_lodgings(read_delimited(spark, star.write_details_file(spark, folder)))


def _read_reviews(spark, folder) -> tuple[DataFrame, DataFrame]:
    known = ingest_details_file(spark, folder)
    reviews = staging.clean_reviews(read_delimited(spark, star.write_reviews_file(spark, folder)))
    return staging.mark_known(reviews, known), known


_RATING_COLUMNS = [f"rating_{d}" for d in ["overall", *DIMENSIONS]]


@query(
    oracle.on_files(
        "SELECT id_review, CAST(id_hostel AS INTEGER) AS id_hostel, id_user, review_date, "
        + ", ".join(_RATING_COLUMNS)
        + ", id_hostel IN (SELECT id_hostel FROM stg_hostels) AS known FROM first_rows"
    )
)
def ingest_reviews_file(spark, folder):
    marked, _ = _read_reviews(spark, folder)
    return plain(
        marked.select("id_review", "id_hostel", "id_user", "review_date", *_RATING_COLUMNS, "known")
    )


@query(oracle.on_files("SELECT * FROM stg_users"))
def ingest_users_file(spark, folder):
    marked, _ = _read_reviews(spark, folder)
    return staging.clean_users(marked.where("known"))


@query(
    "SELECT CAST(id AS VARCHAR) AS id, CASE kind WHEN 0 THEN 'plain' WHEN 1 THEN 'short' WHEN 2 THEN '5\" bed' "
    "WHEN 3 THEN 'two' || chr(10) || 'lines; ' || part ELSE 'a \"q\"; ' || part END AS name, "
    "CASE WHEN kind <> 1 THEN CAST(part AS VARCHAR) END AS score "
    "FROM (SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS part, l_partkey % 8 AS kind FROM lineitem) WHERE kind < 5"
)
def ingest_bad_rows(spark, folder):
    """Order lines as a folder of files with short and surplus rows, a separator
    at the end, stray quotes, quoted separators, and line breaks in some files."""
    raw = read_delimited(spark, star.write_bad_rows(spark, folder))
    return raw.select("id", "name", "score")


def _measures(name: str, key: str) -> tuple[str, list[str], list[str]]:
    """A table's row key, numeric measures and text measures, from its declaration."""
    table = TABLES[name]
    shown = {c: t for c, t in table.columns.items() if c not in table.key and c not in (key, "dag_run_id") and t != "timestamp_ntz"}
    words = [c for c, t in shown.items() if t == "string"]
    return key, [c for c in shown if c not in words], words


_MEASURES = {
    n: _measures(n, key)
    for n, key in [
        ("kpi_coverage", "'all'"), ("kpi_hostel_ratings", "id_hostel"), ("kpi_equivalent_groups", "group_key"),
        ("kpi_hostel_ranking", "id_hostel"), ("kpi_volume_vs_rating", "group_key"), ("kpi_global_drivers", "group_key"),
        ("kpi_user_profile_drivers", "segment_key"), ("pipeline_run_log", "stage"),
    ]
}


def _tidy(house: Warehouse) -> DataFrame:
    parts = []
    for name, (key, measures, words) in _MEASURES.items():
        cells = [
            f"struct('{m}' AS measure, CAST({'null' if m in words else m} AS DOUBLE) AS value, "
            f"CAST({m if m in words else 'null'} AS STRING) AS word)"
            for m in [*measures, *words]
        ]
        parts.append(
            house.read(name).selectExpr(
                f"'{name}' AS table_name",
                f"CAST({key} AS STRING) AS row_key",
                f"inline(array({', '.join(cells)}))",
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query(oracle.tidy(_MEASURES))
def full_run_from_files(spark, folder):
    """Files to published KPI tables, read back as one row per measure."""
    details = star.write_details_file(spark, folder)
    reviews = star.write_reviews_file(spark, folder)
    house = full_run(spark, details, reviews, shared_folder(spark, "warehouse"), "catalog")
    return _tidy(house)


@query(oracle.run_report())
def full_run_report(spark, folder):
    """What the declared rules counted while the tables were written, and the
    load times that were set."""
    details = star.write_details_file(spark, folder)
    reviews = star.write_reviews_file(spark, folder)
    house = full_run(spark, details, reviews, shared_folder(spark, "warehouse"), "report")
    stamps = [
        house.read(n).agg(
            F.lit(n).alias("table_name"),
            F.lit("stamped").alias("rule"),
            F.lit(t.stamp).alias("column_name"),
            F.count(t.stamp).alias("violations"),
        )
        for n, t in TABLES.items()
        if t.stamp
    ]
    return reduce(DataFrame.unionByName, [report(house), *stamps])


@query(oracle.load_ledger())
def load_ledger(spark, folder):
    """What a run did with every row it read, and with the values of complete rows.
    Every event is a review line with too many fields."""
    details = star.write_details_file(spark, folder)
    reviews = star.write_reviews_file(spark, folder)
    surplus = star.write_surplus_rows(spark, folder, reviews)
    return ledger(full_run(spark, details, [reviews, surplus], shared_folder(spark, "warehouse"), "ledger"))


@query(oracle.volume_report())
def volume_report(spark, folder):
    """Rows that runs and refreshes gave each table against those of its versions
    before: lodgings and reviews as they are, lodgings in part, then a run."""
    house = Warehouse(spark, shared_folder(spark, "warehouse"))
    lodgings = star.lodgings(spark, folder).withColumns({"total_ratings": F.lit(0), "free_cancellation": F.lit(False)})
    house.refresh("stg_hostels", lodgings)
    lines = star.kept_lines(spark, folder)
    house.refresh("stg_reviews", star.reviews(spark, folder, lines))
    house.refresh("stg_hostels", lodgings.where("star_rating > 0"))
    house.refresh("stg_hostels", lodgings.where("star_rating > 1"))
    details = star.write_details_file(spark, folder)
    reviews = star.write_reviews_file(spark, folder, lines)
    lines.unpersist()
    return full_run(spark, details, reviews, house.root, "volumes").volumes()


_FOUND = "id_review, id_hostel, id_user, review_date"


@query(
    oracle.on_star(
        f"SELECT 'lodging' AS looked_up, {_FOUND} FROM dated WHERE id_hostel = 7 UNION ALL "
        f"SELECT 'user', {_FOUND} FROM dated WHERE id_user = 11 UNION ALL "
        f"SELECT 'day', {_FOUND} FROM dated WHERE id_hostel = 8 AND review_date >= DATE '1996-01-01' UNION ALL "
        f"SELECT 'review', {_FOUND} FROM dated WHERE id_review = 11"
    )
)
def review_lookups(spark, folder):
    """Reviews of one lodging, by one user, of one lodging since a day, and by id,
    from a stored table, of which readers skip what its layout rules out."""
    house = Warehouse(spark, shared_folder(spark, "warehouse"))
    staged = house.refresh("stg_reviews", star.reviews(spark, folder))
    tests = {
        "lodging": "id_hostel = 7", "user": "id_user = 11",
        "day": "id_hostel = 8 AND review_date >= DATE '1996-01-01'", "review": "id_review = 11",
    }
    parts = [staged.where(t).selectExpr(f"'{n}' AS looked_up", *_FOUND.split(", ")) for n, t in tests.items()]
    return reduce(DataFrame.unionByName, parts)


_SUMMARY = "count(*) AS rows, CAST(sum({id}) AS BIGINT) AS ids, CAST(sum(length({text})) AS BIGINT) AS letters"


@query(
    f"SELECT 'stg_hostels' AS table_name, {_SUMMARY.format(id='c_custkey', text='c_name')} FROM customer UNION ALL "
    f"SELECT 'stg_users', {_SUMMARY.format(id='p_partkey', text='p_type')} FROM part UNION ALL "
    "SELECT name, 0, NULL, NULL FROM (VALUES ('stg_reviews'), ('kpi_hostel_ratings')) t(name)"
)
def refresh_cascade(spark, folder):
    """Refreshing the lodgings again empties what refers to them, and only that."""
    house = Warehouse(spark, shared_folder(spark, "warehouse"))
    lodgings = star.lodgings(spark, folder).withColumns(
        {"total_ratings": F.lit(0), "free_cancellation": F.lit(False)}
    )
    users = star.users(spark, folder).withColumns(
        {"nationality_code": F.lit(None), "nationality_name": F.lit(None), "number_reviews": F.lit(None)}
    )
    reviews = star.reviews(spark, folder)
    house.refresh("stg_hostels", lodgings.withColumn("name", F.lit("old")))
    house.refresh("stg_users", users)
    staged = house.refresh("stg_reviews", reviews)
    house.refresh("kpi_hostel_ratings", kpis.lodging_ratings(kpis.lodging_sums(staged)))
    house.refresh("stg_hostels", lodgings)
    shown = {
        "stg_hostels": ("id_hostel", "name"), "stg_users": ("id_user", "trip_code"),
        "stg_reviews": ("id_review", "id_hostel"), "kpi_hostel_ratings": ("id_hostel", "review_count"),
    }
    parts = [
        house.read(n).selectExpr(f"'{n}' AS table_name", *_SUMMARY.format(id=i, text=t).split(", "))
        for n, (i, t) in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)
