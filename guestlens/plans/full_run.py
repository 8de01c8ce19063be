"""The whole job: check inputs, stage, compute every KPI, switch over."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from guestlens.operators.quality import observe_unique, parent_rule, row_tests
from guestlens.operators.rows import keep_first
from guestlens.plans import kpis, staging
from guestlens.schemas import TABLES
from guestlens.sources.delimited import read_delimited, require_inputs, whole_files
from guestlens.sources.warehouse import ROWS, Warehouse

# --- Fixed values: stage names and exclusion reason in the run log ------------
STAGE_INPUTS = "verificar_archivos"
STAGE_LODGINGS = "cargar_staging_hostels"
STAGE_REVIEWS = "cargar_staging_reviews"
STAGE_COVERAGE = "calcular_kpi_cobertura"
STAGE_RATINGS = "calcular_kpi_ratings"
STAGE_GROUPS = "calcular_kpi_grupos_y_rankings"
STAGE_DRIVERS = "calcular_kpi_drivers"
ORPHAN_REASON = "hostel_no_encontrado_en_detail"

#: Logged only if it fails: references between the new tables are checked last.
STAGE_PARENTS = "check_parents"

#: Rules that stop a run; unknown values of a domain are only reported.
REJECTED = ("required", "length", "unique", "parent")


class BrokenRule(ValueError):
    """Staged or computed rows break a table's declared rules."""


class _Counts:
    processed = 0
    excluded = 0
    reason: str | None = None


def full_run(
    spark: SparkSession,
    details: str | list[str],
    reviews: str | list[str],
    root: str,
    run_id: str,
    multi_line: bool | None = None,
    keep: int = 2,
) -> Warehouse:
    """Load both files into the warehouse under ``root`` and refresh all KPIs.

    Readers see the new tables only once all of them are written. Every stage
    leaves a row in the run log, a failed one too. Reviews whose lodging is
    unknown are kept in the run's work folder, as is the count of every rule's
    violations. Broken keys, parents, required values and lengths stop the run;
    ``Warehouse.volumes`` sets the rows of its tables beside earlier ones. The latest ``keep`` versions of each table stay; older and failed
    ones are removed when a run has succeeded.

    Needs ANSI mode, Spark's default: without it a number that does not fit its
    column would become null instead of stopping the load.
    """
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled to true")
    house = Warehouse(spark, root)
    records: list[dict] = []
    try:
        _run(house, house.new_version(), details, reviews, run_id, multi_line, records)
    finally:
        house.log(*records)
    house.expire(keep)
    return house


def _run(
    house: Warehouse,
    version: str,
    details: str | list[str],
    reviews: str | list[str],
    run_id: str,
    multi_line: bool | None,
    records: list[dict],
) -> None:
    """Everything but the log, whose rows are left in ``records``."""
    spark = house.spark
    _logged = partial(_stage, records, run_id)

    def save(name: str, df: DataFrame, keys: Observation | None = None) -> DataFrame:
        """Write a table; its rules and its rows are counted in the same pass.
        ``keys`` has counted those of its key where the rows lay together by it."""
        table = TABLES[name]
        tests = row_tests(table.required, table.lengths, domains=table.domains)
        counts = {f"{rule} {column}": f"count_if({test})" for (rule, column), test in tests.items()}
        if table.key and keys is None:
            keys = Observation()
            df = observe_unique(df, list(table.key), keys)
        saved = house.stage(name, df, version, counts)
        house.metrics[name] |= keys.get if keys else {}
        _reject(name, house.metrics[name])
        return saved

    def rows_of(name: str) -> int:
        return house.metrics[name][ROWS]

    def store(name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate result, so that nothing before it runs again."""
        folder = house.work_folder(version, name)
        df.write.option("compression", "zstd").parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    def save_unique(name: str, df: DataFrame) -> DataFrame:
        """Text keys may collide when a part holds a ``|``: keep one row."""
        key = list(TABLES[name].key)
        order = [c for c in df.columns if c not in key]
        return save(name, keep_first(df, key, order))

    with _logged(STAGE_INPUTS):
        require_inputs(spark, [details, reviews])

    with _logged(STAGE_LODGINGS) as stage:
        seen = staging.Seen()
        raw = read_delimited(spark, details, multi_line=multi_line, seen=seen.read)
        lodgings = save("stg_hostels", staging.clean_lodgings(raw, seen=seen))
        stage.processed = rows_of("stg_hostels")
        entries = _ledger("stg_hostels", seen.counts() | {"loaded": rows_of("stg_hostels")})

    with _logged(STAGE_REVIEWS) as stage:
        seen = staging.Seen()
        keys, split = Observation(), Observation()
        # Written once: orphans, reviews and users all start from this table.
        work = house.work_folder(version, "reviews")
        with whole_files(spark, reviews):
            raw = read_delimited(spark, reviews, multi_line=multi_line, seen=seen.read)
            cleaned = observe_unique(staging.clean_reviews(raw, seen), ["id_review"], keys)
            if not staging.marked_in_place(lodgings):
                # Parsed once: the lookup reads its rows twice when it splits keys.
                cleaned = store("cleaned_reviews", cleaned)
            marked = staging.mark_known(cleaned, lodgings)
            lost = F.count_if(~F.col("known")).alias("orphan")
            marked.observe(split, lost).write.option("compression", "zstd").parquet(work)
        checked = spark.read.schema(marked.schema).parquet(work)
        known = checked.where("known")
        users, loaded = _together(
            spark,
            lambda: save("stg_users", staging.clean_users(known)),
            lambda: save("stg_reviews", known, keys),
        )
        stage.processed = rows_of("stg_reviews")
        stage.excluded = split.get["orphan"]
        stage.reason = ORPHAN_REASON
        entries += _ledger("stg_reviews", seen.counts() | split.get | {"loaded": rows_of("stg_reviews")})

    # The only pass over the reviews for all KPIs but the profile drivers.
    with _logged(STAGE_RATINGS) as stage:
        sums = store("lodging_sums", kpis.lodging_sums(loaded))
        save("kpi_hostel_ratings", kpis.lodging_ratings(sums))
        stage.processed = rows_of("kpi_hostel_ratings")

    def coverage() -> None:
        with _logged(STAGE_COVERAGE) as stage:
            save("kpi_coverage", kpis.coverage(lodgings, sums))
            stage.processed = rows_of("kpi_coverage")

    def groups() -> None:
        with _logged(STAGE_GROUPS) as stage:
            found = save_unique("kpi_equivalent_groups", kpis.equivalent_groups(sums, lodgings))
            save("kpi_hostel_ranking", kpis.ranking(sums, lodgings))
            save("kpi_volume_vs_rating", kpis.volume_vs_rating(sums, lodgings))
            stage.processed = found.where("is_valid").count()

    def drivers() -> None:
        with _logged(STAGE_DRIVERS) as stage:
            profiles = kpis.profile_drivers(loaded, users, lodgings)
            save_unique("kpi_user_profile_drivers", profiles)
            save("kpi_global_drivers", kpis.group_drivers(sums, lodgings))
            stage.processed = rows_of("kpi_global_drivers")

    _together(spark, coverage, groups, drivers)
    with _logged(STAGE_PARENTS, only_failed=True):
        _check_parents(house, version, sums)
    found = [(t, *m.partition(" ")[::2], n) for t, counted in house.metrics.items() for m, n in counted.items()]
    _keep(house, version, "report", "rule", "violations", [f for f in found if f[1] != ROWS])
    _keep(house, version, "ledger", "cause", "rows", entries)
    house.publish([n for n, t in TABLES.items() if t.stamp], version)
    # Only the orphans of the run's work are looked at later, and what was counted.
    house.drop_work(version, "cleaned_reviews", "lodging_sums")


def _reject(name: str, counts: dict[str, int]) -> None:
    broken = {m: n for m, n in counts.items() if n and m.split()[0] in REJECTED}
    if broken:
        raise BrokenRule(f"{name}: {broken}")


def _check_parents(house: Warehouse, version: str, sums: DataFrame) -> None:
    """Counts rows without a parent, in one job over tables of lodgings and groups:
    ``sums`` says how many reviews a lodging has, so the reviews are not read."""
    new = {n: house.staged(n, version) for n, t in TABLES.items() if t.stamp}
    reports = []
    for name, table in TABLES.items():
        for column, (parent, key) in table.parents.items():
            rows, count = (sums, "sum(all_reviews)") if name == "stg_reviews" else (new[name], "count(*)")
            reports.append(parent_rule(rows, name, column, new[parent], key, count))
    for r in reduce(DataFrame.unionByName, reports).collect():
        house.metrics[r.table_name][f"parent {r.column_name}"] = r.violations
    for name in new:
        _reject(name, house.metrics[name])


#: Where the rows of a file can go. Each goes to one of them, so they add up.
CAUSES = ("surplus", "null_key", "duplicate", "orphan", "loaded")


def _ledger(name: str, counts: dict[str, int]) -> list[tuple[str, str, str, int]]:
    """What became of the rows of a file, and of their values by column."""
    gone = sum(counts.get(c, 0) for c in CAUSES)
    if counts["read"] != gone:
        raise BrokenRule(f"{name}: {counts['read']} rows were read, {gone} accounted for: {counts}")
    return [(name, *cause.partition(" ")[::2], n) for cause, n in counts.items()]


def _keep(house: Warehouse, version: str, name: str, what: str, count: str, rows: list[tuple]) -> None:
    """Write what a run counted next to its orphans: a row per table, cause and column."""
    schema = f"table_name string, {what} string, column_name string, {count} bigint"
    house.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(house.work_folder(version, name))


def _kept(house: Warehouse, name: str) -> DataFrame:
    return house.spark.read.parquet(house.work_folder(house.version("stg_reviews"), name))


def report(house: Warehouse) -> DataFrame:
    """Rows of the latest run that break a declared rule, per rule and column."""
    return _kept(house, "report")


def ledger(house: Warehouse) -> DataFrame:
    """What the latest run did with the rows it read: ``read`` is the sum of
    ``CAUSES``. Below that, by column, values of complete rows that were changed:
    ratings that are no number and became null (``coerced``), missing values that
    got a default (``filled``), flags that say neither true nor false (``unknown``).
    """
    return _kept(house, "ledger")


def _together(spark: SparkSession, *jobs: Callable) -> list:
    """Run independent jobs at the same time, so that small ones fill the gaps
    of large ones. Waits for all; then the first error, if any, is raised."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(in_session(job)) for job in jobs]
    return [r.result() for r in running]


@contextmanager
def _stage(records: list[dict], run_id: str, name: str, only_failed: bool = False):
    """Leaves a row for the run log, also, or only, when the stage fails."""
    stage = _Counts()
    record = {"dag_run_id": run_id, "stage": name, "started_at": datetime.now(timezone.utc)}
    try:
        yield stage
    except Exception as e:
        records.append(record | _now() | {"status": "failed", "exclusion_reason": str(e)})
        raise
    if only_failed:
        return
    counts = {"records_processed": stage.processed, "records_excluded": stage.excluded}
    records.append(record | _now() | counts | {"status": "success", "exclusion_reason": stage.reason})


def _now() -> dict:
    return {"finished_at": datetime.now(timezone.utc)}


def orphans(house: Warehouse) -> DataFrame:
    """Reviews the latest run set aside because their lodging is unknown."""
    work = house.work_folder(house.version("stg_reviews"), "reviews")
    return house.spark.read.parquet(work).where("NOT known")
