import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import guestlens.plans.full_run as plan
from guestlens.operators.quality import observe_unique, row_tests
from guestlens.operators.rows import keep_first
from guestlens.plans import staging
from guestlens.plans.full_run import CAUSES, STAGE_PARENTS, BrokenRule, full_run, ledger, orphans, report
from guestlens.schemas import TABLES
from guestlens.sources.warehouse import Warehouse
from tests.test_staging import DETAILS, HEADER, REVIEWS, review


def files(tmp_path, details=DETAILS, reviews=REVIEWS):
    (tmp_path / "d.csv").write_text(details)
    (tmp_path / "r.csv").write_text(reviews)
    return str(tmp_path / "d.csv"), str(tmp_path / "r.csv"), str(tmp_path / "house")


def content(house, name):
    table = TABLES[name]
    return sorted(map(str, house.read(name).select(*table.data_columns).collect()))


def test_small_run_and_rerun(spark, tmp_path):
    details, reviews, root = files(tmp_path)
    house = full_run(spark, details, reviews, root, "run 1")
    assert house.read("stg_hostels").count() == 2
    assert sorted(r.id_review for r in house.read("stg_reviews").collect()) == [10, 12]
    assert [r.id_user for r in house.read("stg_users").collect()] == [100]
    assert house.read("kpi_coverage").first().coverage_pct == 100
    assert [r.id_hostel for r in house.read("kpi_hostel_ratings").collect()] == [1]
    assert {r.group_key: r.is_valid for r in house.read("kpi_equivalent_groups").collect()} == {
        "4|HOSTEL|city|Rome": False, "4|HOSTEL|country|Italy": False,
    }
    assert house.read("kpi_hostel_ranking").count() == 0
    segment = house.read("kpi_user_profile_drivers").first()
    assert (segment.segment_key, segment.sample_size, segment.top_driver) == ("OTHER|FEMALE|18-24|HOSTEL", 1, "safety")

    log = {r.stage: r for r in house.read("pipeline_run_log").collect()}
    assert {r.status for r in log.values()} == {"success"} and len(log) == 7
    staged = log["cargar_staging_reviews"]
    assert (staged.records_processed, staged.records_excluded) == (2, 1)
    assert staged.exclusion_reason == "hostel_no_encontrado_en_detail"

    assert [(r.id_review, r.id_hostel) for r in orphans(house).collect()] == [(11, 9)]

    names = [n for n, t in TABLES.items() if t.stamp]
    before = {n: content(house, n) for n in names}
    full_run(spark, details, reviews, root, "run 2")
    assert {n: content(house, n) for n in names} == before
    assert house.read("pipeline_run_log").count() == 14

    house.register_views()
    assert spark.sql("SELECT count(*) FROM kpi_equivalent_groups WHERE NOT is_valid").first()[0] == 2


def test_shuffled_lookups_give_the_same_tables(spark, tmp_path):
    """With broadcasts off, rows are stored before the lookup and keys may be split."""
    details, reviews, root = files(tmp_path)
    house = full_run(spark, details, reviews, root, "broadcast")
    names = [n for n, t in TABLES.items() if t.stamp]
    before = {n: content(house, n) for n in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        full_run(spark, details, reviews, root, "shuffled")
        assert {n: content(house, n) for n in names} == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_lodgings_break_a_rule(spark, tmp_path):
    """The share of nothing is null, and the table does not take a null."""
    details, reviews, root = files(tmp_path, details=DETAILS.splitlines()[0] + "\n")
    with pytest.raises(BrokenRule, match="coverage_pct"):
        full_run(spark, details, reviews, root, "run")


def test_ansi_mode_is_required(spark, tmp_path):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            full_run(spark, *files(tmp_path), "run")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_types_are_the_declared_ones(spark, tmp_path):
    house = full_run(spark, *files(tmp_path), "run")
    for name, table in TABLES.items():
        assert house.read(name).dtypes == list(table.columns.items())


def test_missing_files_fail_and_are_logged(spark, tmp_path):
    root = str(tmp_path / "house")
    with pytest.raises(FileNotFoundError):
        full_run(spark, str(tmp_path / "none.csv"), str(tmp_path / "no.csv"), root, "run")
    rows = Warehouse(spark, root).read("pipeline_run_log").collect()
    assert [(r.stage, r.status) for r in rows] == [("verificar_archivos", "failed")]


def test_a_failed_run_leaves_the_published_tables(spark, tmp_path):
    details, reviews, root = files(tmp_path)
    house = full_run(spark, details, reviews, root, "good")
    (tmp_path / "bad.csv").write_text(HEADER + review(1, 1, 1, "T" * 31))
    with pytest.raises(BrokenRule):
        full_run(spark, details, str(tmp_path / "bad.csv"), root, "bad")
    assert sorted(r.id_review for r in house.read("stg_reviews").collect()) == [10, 12]
    log = house.read("pipeline_run_log").where("dag_run_id = 'bad'").collect()
    assert ("cargar_staging_reviews", "failed") in [(r.stage, r.status) for r in log]


def test_files_may_be_folders_of_many_files(spark, tmp_path):
    folder = tmp_path / "reviews"
    folder.mkdir()
    lines = REVIEWS.removeprefix(HEADER).splitlines(keepends=True)
    for i, line in enumerate(lines):
        (folder / f"part-{i}.csv").write_text(HEADER + line)
    details, _, root = files(tmp_path)
    house = full_run(spark, details, str(folder), root, "run")
    assert sorted((r.id_review, r.id_hostel) for r in house.read("stg_reviews").collect()) == [(10, 1), (12, 2)]
    assert house.read("stg_users").first().trip_code == "OTHER"


def folders(root):
    return {p.relative_to(root).as_posix() for p in root.rglob("*") if p.is_dir() and p.name not in ("known=true", "known=false")}


def test_storage_stays_flat_over_ten_runs(spark, tmp_path):
    details, reviews, root = files(tmp_path)
    house = full_run(spark, details, reviews, root, "run 0")
    reader = house.read("stg_reviews")  # a reader of what is then the current version
    sizes = []
    for i in range(1, 10):
        if i == 5:
            (tmp_path / "bad.csv").write_text(HEADER + review(1, 1, 1, "T" * 31))
            with pytest.raises(BrokenRule):
                full_run(spark, details, str(tmp_path / "bad.csv"), root, "bad")
        full_run(spark, details, reviews, root, f"run {i}")
        if i == 1:
            assert reader.count() == 2
        sizes.append(len(folders(tmp_path / "house")))
    assert sizes[0] == sizes[-1] and max(sizes) == sizes[0]
    assert house.read("kpi_coverage").count() == 1 and orphans(house).count() == 1
    house.expire(keep=1)
    assert len(folders(tmp_path / "house")) < sizes[0]
    assert house.read("stg_reviews").count() == 2


def test_the_report_counts_what_the_rules_found(spark, tmp_path):
    odd = HEADER + review(10, 1, 100, "HOLIDAY") + review(11, 1, 101, "OTHER")
    house = full_run(spark, *files(tmp_path, reviews=odd), "run")
    found = {(r.table_name, r.rule, r.column_name): r.violations for r in report(house).collect()}
    assert found["stg_users", "domain", "trip_code"] == 1
    assert found["stg_hostels", "required", "name"] == found["stg_users", "length", "trip_code"] == 0
    wanted = {(n, r, c) for n, t in TABLES.items() if t.stamp for r, c in row_tests(t.required, t.lengths, domains=t.domains)}
    wanted |= {(n, "unique", ",".join(t.key)) for n, t in TABLES.items() if t.key}
    wanted |= {(n, "parent", c) for n, t in TABLES.items() for c in t.parents}
    assert set(found) == wanted
    assert all(n == 0 for (_, rule, _), n in found.items() if rule in ("unique", "parent"))


def broken_run(spark, tmp_path, match):
    house = full_run(spark, *files(tmp_path), "good")
    return house, pytest.raises(BrokenRule, match=match)


@pytest.mark.parametrize("name, match", [("clean_lodgings", "stg_hostels.*unique id_hostel': 1"), ("clean_reviews", "stg_reviews.*unique id_review': 1")])
def test_a_key_that_occurs_twice_stops_the_run(spark, tmp_path, monkeypatch, name, match):
    house, fails = broken_run(spark, tmp_path, match)
    clean = getattr(staging, name)

    def twice(*args, seen=None, **kwargs):
        rows = clean(*args, **kwargs, **({"seen": seen} if seen else {}))
        first = rows.orderBy(rows.columns[0]).limit(1)
        return rows.unionByName(first)

    monkeypatch.setattr(staging, name, twice)
    monkeypatch.setattr(plan, "_ledger", lambda name, counts: [])
    with fails:
        full_run(spark, *files(tmp_path), "bad")
    assert house.read("stg_hostels").count() == 2


def test_a_parent_that_is_missing_stops_the_run(spark, tmp_path, monkeypatch):
    house, fails = broken_run(spark, tmp_path, "stg_reviews.*parent id_hostel': 1")
    monkeypatch.setattr(staging, "mark_known", lambda reviews, lodgings: reviews.withColumn("known", F.lit(True)))
    with fails:
        full_run(spark, *files(tmp_path), "bad")
    log = house.read("pipeline_run_log").where("dag_run_id = 'bad' AND status = 'failed'").collect()
    assert [r.stage for r in log] == [STAGE_PARENTS]
    assert sorted(r.id_review for r in house.read("stg_reviews").collect()) == [10, 12]


def test_keys_are_checked_where_keep_first_left_them(spark, tmp_path):
    """Neither a second shuffle nor another sort."""
    spark.range(1000).selectExpr("id % 100 AS k", "id", "CAST(id AS STRING) AS word").write.parquet(str(tmp_path / "t"))
    rows = keep_first(spark.read.parquet(str(tmp_path / "t")), ["k"], "id")
    counts = Observation()
    checked = observe_unique(rows, ["k"], counts)
    nodes = lambda df, node: df._jdf.queryExecution().executedPlan().toString().count(f"{node} [")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    assert nodes(checked, "Sort") == nodes(rows, "Sort") and exchanges(checked) == exchanges(rows) == 1
    assert checked.count() == 100
    checked.write.format("noop").mode("overwrite").save()
    assert counts.get == {"unique k": 0}


def test_volumes_of_runs(spark, tmp_path):
    details, reviews, root = files(tmp_path)
    for i in range(3):
        house = full_run(spark, details, reviews, root, f"run {i}")
    (tmp_path / "less.csv").write_text(HEADER + review(10, 1, 100, "OTHER"))
    full_run(spark, details, str(tmp_path / "less.csv"), root, "less")
    found = house.volumes().where("table_name = 'stg_reviews'").orderBy("publication").collect()
    assert [(r.actual, r.expected, r.within_tolerance) for r in found] == [(2, None, None), (2, 2, True), (2, 2, True), (1, 2, False)]
    assert house.volumes(tolerance=0.5).where("table_name = 'stg_reviews' AND NOT within_tolerance").count() == 0


def entries(house):
    return {(r.table_name, r.cause, r.column_name): r.rows for r in ledger(house).collect()}


def test_the_ledger_accounts_for_every_row(spark, tmp_path):
    header = DETAILS.splitlines()[0]
    width = header.count(";") + 1
    line = dict(zip(header.split(";"), [""] * width)) | {"id_hostel": "1", "type": "HOSTEL", "city.name": "Rome", "city.country": "Italy"}
    make = lambda **v: ";".join((line | {k.replace("__", "."): x for k, x in v.items()}).values())
    details = [
        header, make(name="a", starRating="3", totalRatings="1", freeCancellation__isAvailable="yes"),
        make(name="copy"), make(id_hostel="NA"), make(name="long") + ";more", make(id_hostel="2", freeCancellation__isAvailable="True"),
    ]
    odd = review(10, 1, 100, "OTHER") + review(10, 1, 100, "OTHER") + review(11, 9, 101, "OTHER") + review("", 1, 1, "OTHER")
    odd += review(12, 2, 103, "OTHER").replace("\n", ";;;\n") + review(13, 2, 103, "OTHER")
    house = full_run(spark, *files(tmp_path, "\n".join(details) + "\n", HEADER + odd), "run")
    found = entries(house)
    lodgings = {c: n for (t, c, column), n in found.items() if t == "stg_hostels" and not column}
    assert lodgings == {"read": 5, "surplus": 1, "null_key": 1, "duplicate": 1, "loaded": 2}
    reviews = {c: n for (t, c, column), n in found.items() if t == "stg_reviews" and not column}
    assert reviews == {"read": 6, "surplus": 1, "null_key": 1, "duplicate": 1, "orphan": 1, "loaded": 2}
    for counts in (lodgings, reviews):
        assert counts["read"] == sum(counts.get(c, 0) for c in CAUSES)
    changed = {(c, column): n for (t, c, column), n in found.items() if t == "stg_hostels" and column}
    assert changed == {
        ("filled", "name"): 1, ("filled", "star_rating"): 2, ("filled", "total_ratings"): 2,
        ("filled", "free_cancellation"): 1, ("unknown", "free_cancellation"): 1,
    }


def test_ratings_that_are_no_number_are_counted(spark, tmp_path):
    place = HEADER.strip().split(";").index("review_rating_overall")
    cells = review(10, 1, 100, "OTHER").strip().split(";")
    lines = [";".join([*cells[:place], text, *cells[place + 1 :]]).replace("10", str(i), 1) for i, text in enumerate(["8.5d", "9", "n/a", "ten"], 20)]
    house = full_run(spark, *files(tmp_path, reviews=HEADER + "\n".join(lines) + "\n"), "run")
    found = {column: n for (t, c, column), n in entries(house).items() if c == "coerced"}
    assert found["rating_overall"] == 2 and found["rating_safety"] == 0 and len(found) == 7


def test_a_file_without_rows_has_a_ledger(spark, tmp_path):
    house = full_run(spark, *files(tmp_path, reviews=HEADER + review("", 1, 1, "OTHER")), "run")
    found = {c: n for (t, c, column), n in entries(house).items() if t == "stg_reviews" and not column}
    assert found == {"read": 1, "surplus": 0, "null_key": 1, "duplicate": 0, "orphan": 0, "loaded": 0}


def test_a_run_logs_its_stages_in_one_file(spark, tmp_path):
    house = full_run(spark, *files(tmp_path), "run")
    assert len(list((tmp_path / "house" / "pipeline_run_log").glob("*/*.parquet"))) == 1
    assert house.read("pipeline_run_log").where("finished_at >= started_at").count() == 7


@pytest.mark.parametrize("bits", [1 << 26, 0])
def test_reviews_are_not_stored_and_moved_to_be_marked(spark, tmp_path, monkeypatch, bits):
    """Lodgings too many to broadcast by rows: a bit each, or, far apart, a shuffle."""
    monkeypatch.setattr("guestlens.operators.rows.FILTER_BITS", bits)
    details, reviews, root = files(tmp_path)
    asked = []
    folder = Warehouse.work_folder
    monkeypatch.setattr(Warehouse, "work_folder", lambda h, version, name: asked.append(name) or folder(h, version, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        house = full_run(spark, details, reviews, root, "marked")
        with_drop = asked.count("cleaned_reviews")
        assert [(r.id_review, r.id_hostel) for r in orphans(house).collect()] == [(11, 9)]
        assert sorted(r.id_review for r in house.read("stg_reviews").collect()) == [10, 12]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Asked for once to be removed, and before that to be written, if it is.
    assert with_drop == (1 if bits else 2)
