"""CSV with quotes, commas and line breaks, against Python's csv module."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from adlens.sources import raw as S
from adlens.sources.csv_records import has_line_breaks, raw_lines, read_csv_records, records

SCHEMA = "n int, a string, b string"


def awkward(seed, rows):
    rng = random.Random(seed)
    bits = ['"', '""', ",", "\n", "\r\n", "é", " ", "word", "x" * 40, "\t", "'", "\\", '\\"']
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(1, 9)))
    return [(n, text(), text() if rng.random() < 0.9 else None) for n in range(rows)]


def write(path, rows, **how):
    with open(path, "w", newline="") as f:
        out = csv.writer(f, **how)
        out.writerow(["n", "a", "b"])
        out.writerows(rows)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_files_of_many_splits(spark, tmp_path, small_splits, seed, ends):
    rows = awkward(seed, 300)
    rows[50] = (50, '"\n,' * 400, "one record over several splits")
    write(tmp_path / "x.csv", rows[:200], lineterminator=ends)
    write(tmp_path / "y.csv", rows[200:], lineterminator=ends, quoting=csv.QUOTE_ALL)
    lines = raw_lines(spark, str(tmp_path))
    assert lines.select("f", "b").distinct().count() > 20 and has_line_breaks(lines)
    schema = spark.createDataFrame([], SCHEMA).schema
    got = read_csv_records(spark, str(tmp_path), schema).orderBy("n").collect()
    # a quoted null is the empty text
    want = [(n, a, "" if b is None and n >= 200 else b) for n, a, b in rows]
    assert [tuple(r) for r in got] == want
    assert records(lines).where("first").count() == 2


def test_own_sink_comes_back(spark, tmp_path):
    rows = awkward(3, 200) + [(1000, "", None), (1001, None, ""), (1002, " a ", "b\rc"),
                              (1003, "plain", "x,y")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    S.write_csv(df, str(tmp_path / "out"))
    got = read_csv_records(spark, str(tmp_path / "out"), df.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    # and Python reads it too
    seen = []
    for part in (tmp_path / "out").glob("part-*.csv"):
        with open(part, newline="") as f:
            seen += list(csv.reader(f))[1:]
    assert sorted(seen) == sorted([str(n), a or "", b or ""] for n, a, b in rows)


def test_without_line_breaks_lines_are_parsed_by_spark(spark, tmp_path):
    rows = [(1, 'He said "hi", Inc', "x"), (2, 'The "X"', None), (3, "", "é")]
    write(tmp_path / "x.csv", rows, quoting=csv.QUOTE_NOTNULL)
    schema = spark.createDataFrame([], SCHEMA).schema
    got = read_csv_records(spark, str(tmp_path), schema)
    assert [tuple(r) for r in got.orderBy("n").collect()] == rows
    assert "MapInArrow" not in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("body, fault", [
    ('1,"a\nb",c\n2,"never ends\n', "within quotes"),
    ('1,"a\nb",c\n2,few\n', "(?i)malformed"),
    ('1,"a\nb",c\nx,b,c\n', "(?i)malformed"),
])
def test_faults_fail_the_read(spark, tmp_path, body, fault):
    (tmp_path / "x.csv").write_text("n,a,b\n" + body)
    with pytest.raises(Exception, match=fault):
        read_csv_records(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema).collect()


def test_empty_files(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    (tmp_path / "x.csv").write_text('n,"a\nname",b\n')
    assert read_csv_records(spark, str(tmp_path), schema).count() == 0
    (tmp_path / "x.csv").write_text("")
    assert read_csv_records(spark, str(tmp_path), schema).count() == 0


def test_load_of_quoted_names(spark, tmp_path):
    names = ['He said "hi", Inc', 'The "X"', "two\nlines"]
    with open(tmp_path / "advertisers.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["id", "name", "v", "t", "c"])
        out.writerows([(f"a{n}", name, "Retail", "high", "US") for n, name in enumerate(names)])
    got = S.load_table(spark, str(tmp_path / "advertisers.csv"), "advertisers")
    assert [r.company_name for r in got.orderBy("advertiser_id").collect()] == names


@pytest.mark.parametrize("row, fault", [
    ("c" * 21 + ",10,0.5,0.5", "slot_position: 1 longer than 20"),
    ("pre_roll_1,15,1000.00,0.95", "(?s).*"),
    ("pre_roll_1,99999,0.50,0.95", "(?s).*"),
])
def test_column_limits(spark, tmp_path, row, fault):
    (tmp_path / "s.csv").write_text("a,b,c,d\n" + row + "\n")
    with pytest.raises(Exception, match=fault):
        S.load_table(spark, str(tmp_path / "s.csv"), "ad_slots")


def test_blanks_past_the_limit_are_cut_off(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,b,c,d\n" + "c" * 20 + "   ,10,0.5,0.5\n")
    got = S.load_table(spark, str(tmp_path / "s.csv"), "ad_slots")
    assert got.first().slot_position == "c" * 20
    assert got.select(F.max(F.length("slot_position"))).first()[0] == 20
