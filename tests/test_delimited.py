import random

import pytest
from pyspark.sql import Observation

from guestlens.sources import delimited
from guestlens.sources.delimited import ROW_ORDER, files_with_open_quotes, read_delimited, require_inputs

EDGE_ROWS = """id;name;type;score
1;A;HOSTEL;8.5
2;B;HOTEL
3;C;HOSTEL;7;extra
4;"D;x";HOTEL;9
5;NA;;N/A
6;E;HOSTEL;7;
8;"q""uote";H;1
;;;

9;"";H;2
10;"a;b";c
11;"a;b";c;1;2
"""


def write(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def rows(df):
    return [tuple(r) for r in df.orderBy(ROW_ORDER).drop(ROW_ORDER).collect()]


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_long_rows_are_dropped_and_short_rows_padded(spark, tmp_path, multi_line):
    path = write(tmp_path, "edge.csv", EDGE_ROWS)
    assert rows(read_delimited(spark, path, multi_line=multi_line)) == [
        ("1", "A", "HOSTEL", "8.5"),
        ("2", "B", "HOTEL", None),
        ("4", "D;x", "HOTEL", "9"),
        ("5", None, None, None),
        ("8", 'q"uote', "H", "1"),
        (None, None, None, None),
        ("9", None, "H", "2"),
        ("10", "a;b", "c", None),
    ]


def test_a_selection_of_columns_still_sees_bad_rows(spark, tmp_path):
    df = read_delimited(spark, write(tmp_path, "edge.csv", EDGE_ROWS))
    assert df.count() == 8
    assert [r.id for r in df.orderBy(ROW_ORDER).select("id").collect()] == ["1", "2", "4", "5", "8", None, "9", "10"]


def test_line_break_in_quotes_is_found_and_read(spark, tmp_path):
    path = write(tmp_path, "broken.csv", 'a;b\n1;"x\ny"\n2;z\n')
    assert [f.rsplit("/", 1)[1] for f in files_with_open_quotes(spark, path)] == ["broken.csv"]
    assert rows(read_delimited(spark, path)) == [("1", "x\ny"), ("2", "z")]
    assert not files_with_open_quotes(spark, write(tmp_path, "whole.csv", 'a;b\n1;"x""y"\n'))


STRAY = """a;b;c
1;5" x;2;6" y
2;5" x;y
3;x";y
4;"a;b";5" z;9
5;"a ""q"" b";;
6;"";"a;b"
7;;"a";"b"
"""


@pytest.mark.parametrize("multi_line", [None, False])
def test_only_a_quote_that_starts_a_field_opens_one(spark, tmp_path, multi_line):
    path = write(tmp_path, "stray.csv", STRAY)
    assert files_with_open_quotes(spark, path) == []
    assert rows(read_delimited(spark, path, multi_line=multi_line)) == [
        ("2", '5" x', "y"), ("3", 'x"', "y"), ("6", None, "a;b"),
    ]


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_stray_quote_leaves_the_file_split(spark, tmp_path, small_splits):
    body = "".join(f"{i};{'x' * 40}\n" for i in range(10_000))
    clean = read_delimited(spark, write(tmp_path, "clean.csv", "n;pad\n" + body)).rdd.getNumPartitions()
    stray = read_delimited(spark, write(tmp_path, "stray.csv", 'n;pad\n0;5" bed\n' + body))
    assert stray.rdd.getNumPartitions() == clean > 3
    assert rows(stray)[0] == ("0", '5" bed')


def test_all_files_are_split_where_one_has_an_open_quote(spark, tmp_path, small_splits):
    folder = tmp_path / "a folder"
    folder.mkdir()
    body = "".join(f"{i};{'x' * 40}\n" for i in range(6_000))
    write(folder, "part 0.csv", "n;pad\n" + body)
    write(folder, "part 1.csv", 'n;pad\n7;"two\nlines"\n' + body)
    write(folder, "part 2.csv", "n;pad\n" + body)
    df = read_delimited(spark, str(folder))
    assert df.rdd.getNumPartitions() > 4
    numbers = [str(i) for i in range(6_000)]
    assert [r[0] for r in rows(df)] == [*numbers, "7", *numbers, *numbers]
    assert rows(df)[6_000] == ("7", "two\nlines")


def test_one_line_break_in_quotes_leaves_the_file_split(spark, tmp_path, small_splits):
    body = "".join(f"{i};{'x' * 40}\n" for i in range(10_000))
    clean = read_delimited(spark, write(tmp_path, "clean.csv", "n;pad\n" + body)).rdd.getNumPartitions()
    broken = read_delimited(spark, write(tmp_path, "broken.csv", "n;pad\n" + body + '7;"two\nlines"\n' + body))
    assert broken.rdd.getNumPartitions() >= 2 * clean - 1 > 5
    numbers = [str(i) for i in range(10_000)]
    assert [r[0] for r in rows(broken)] == [*numbers, "7", *numbers]
    # Only the first split, with the header, and the one with the break are sorted.
    lines = broken.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(lines) == 20_001 and max(lines) < 3_000


def random_file(rng, n):
    """Lines with quoted fields over many lines, stray and doubled quotes, quotes
    that close before the end of a field, blank lines and surplus fields."""
    out = []
    for i in range(n):
        field = lambda: rng.choice([
            "x", "", " ", '5" bed', '""', '"q"', '"a;b"', '"a ""b"" c"', '"two\nlines"', f'"{"l\n" * rng.randrange(1, 9)}"',
            '"\n"', '"""\n"""', '"a\n;""\n;b"', '"stop"ped', '"stop\n"ped', 'é "x"', '"\n\n"', "word " * rng.randrange(30),
            f'"{"long line\n" * rng.randrange(40)}"',
        ])
        out.append(";".join([str(i), *(field() for _ in range(rng.choice([2, 2, 2, 2, 1, 3])))]))
        out += [""] * (rng.random() < 0.05)
    return "a;b;c\n" + "\n".join(out) + "\n" * rng.randrange(2)


@pytest.mark.parametrize("seed", range(8))
def test_split_files_equal_files_read_whole(spark, tmp_path, seed):
    """Against Spark's own reading in one task, with splits of a few lines."""
    rng = random.Random(seed)
    for f in range(1 + seed % 3):
        write(tmp_path, f"part {f}.csv", random_file(rng, 400))
    whole = rows(read_delimited(spark, str(tmp_path), multi_line=True))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, str(rng.choice([64, 300, 2000])))
    try:
        assert rows(read_delimited(spark, str(tmp_path))) == whole
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(whole) > 100


def test_a_quote_that_is_never_closed(spark, tmp_path, small_splits):
    path = write(tmp_path, "open.csv", 'a;b\n1;x\n2;"open\n' + "y\n" * 40_000)
    found = rows(read_delimited(spark, path))
    # The rest of the file is one field, here without the line break at the end.
    whole = rows(read_delimited(spark, path, multi_line=True))
    assert found == [("1", "x"), (whole[1][0], whole[1][1].rstrip("\n"))]


def test_windows_line_ends(spark, tmp_path):
    path = write(tmp_path, "crlf.csv", 'a;b\r\n1;"x\r\ny"\r\n2;z\r\n')
    assert rows(read_delimited(spark, path)) == [("1", "x\ny"), ("2", "z")]


def test_headers_of_files_with_breaks_are_compared(spark, tmp_path):
    write(tmp_path, "part-0.csv", 'a;b\n1;"2\n3"\n')
    write(tmp_path, "part-1.csv", 'b;a\n1;"2\n3"\n')
    with pytest.raises(Exception, match="does not conform"):
        read_delimited(spark, str(tmp_path)).collect()


def test_a_large_number_of_splits_is_not_broadcast(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(delimited, "BROADCAST_SPLITS", 0)
    path = write(tmp_path, "broken.csv", 'a;b\n1;"x\ny"\n' + "2;z\n" * 50_000)
    found = read_delimited(spark, path)
    assert rows(found) == [("1", "x\ny"), *[("2", "z")] * 50_000]


def test_read_and_surplus_rows_are_observed(spark, tmp_path):
    text = EDGE_ROWS + '12;"two\nlines";x;y\n13;"a\nb";x;y;z\n'
    for name, content in (("edge.csv", EDGE_ROWS), ("broken.csv", text)):
        seen = Observation("seen")
        kept = read_delimited(spark, write(tmp_path, name, content), seen=seen).count()
        assert seen.get == {"read": kept + seen.get["surplus"], "surplus": {"edge.csv": 3, "broken.csv": 4}[name]}


def test_order_runs_over_splits_and_files(spark, tmp_path):
    for f in range(3):
        body = "".join(f"{f * 10_000 + i};{'x' * 40}\n" for i in range(10_000))
        write(tmp_path, f"part-{f}.csv", "n;pad\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_delimited(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        assert [int(r[0]) for r in rows(df)] == list(range(30_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_dotted_names_survive(spark, tmp_path):
    path = write(tmp_path, "dots.csv", "id;city.name\n1;Rome\n")
    df = read_delimited(spark, path)
    assert df.columns == ["id", "city.name", ROW_ORDER]
    assert rows(df) == [("1", "Rome")]


def test_all_missing_inputs_are_named(spark, tmp_path):
    present = write(tmp_path, "here.csv", "a\n1\n")
    require_inputs(spark, [present])
    with pytest.raises(FileNotFoundError) as e:
        require_inputs(spark, [str(tmp_path / "no1.csv"), present, str(tmp_path / "no2.csv")])
    assert "no1.csv" in str(e.value) and "no2.csv" in str(e.value) and "here.csv" not in str(e.value)


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_with_other_headers_are_refused(spark, tmp_path, multi_line):
    write(tmp_path, "part-0.csv", "a;b\n1;2\n")
    write(tmp_path, "part-1.csv", "b;a\n1;2\n")
    with pytest.raises(Exception, match="does not conform"):
        read_delimited(spark, str(tmp_path), multi_line=multi_line).collect()


@pytest.mark.parametrize("numbered", [100, 0])
def test_rows_are_in_the_order_of_file_names_however_many_there_are(spark, tmp_path, monkeypatch, numbered):
    monkeypatch.setattr(delimited, "NUMBERED_FILES", numbered)
    names = ["b 1.csv", "a%20.csv", "ü.csv", "c d.csv", "B.csv", "a.csv"]
    for n in names:
        broken = f'"{n}\nx"' if n.startswith("c") else n
        (tmp_path / n).write_text(f"n;i\n{broken};1\n{n};2\n")
    df = read_delimited(spark, str(tmp_path))
    found = [(r.n.split("\n")[0], r.i) for r in df.orderBy(ROW_ORDER).collect()]
    by_path = sorted(names, key=lambda n: (tmp_path / n).as_uri().replace("%C3%BC", "ü"))
    assert found == [(n, i) for n in by_path for i in "12"]
    # A name with every row is some 100 bytes that are sorted and shuffled.
    assert df.where(f"{ROW_ORDER}._file IS NOT NULL").count() == (0 if numbered else 12)


def test_tasks_of_compressed_files_take_fewer_bytes(spark, tmp_path):
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    lines = spark.range(9).selectExpr("CAST(id AS STRING) AS value")
    lines.write.text(plain)
    lines.write.option("compression", "gzip").text(packed)
    with delimited.whole_files(spark, plain):
        assert spark.conf.get(conf) == before
    with pytest.raises(KeyError), delimited.whole_files(spark, [plain, packed]):
        most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        assert most * delimited.PACKED == 128 << 20
        raise KeyError
    assert spark.conf.get(conf) == before
