import csv
import io
import os
import random
from urllib.parse import unquote

import pytest

from tarmac.sources.csv import file_manifest, read_csv

NAMES = ["reporting_period", "reporting_airport", "airline_name", "note"]


@pytest.fixture()
def small_splits(spark):
    """Splits of 150 bytes, so records and quoted fields are cut everywhere."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _land(root, name, rows, encoding="utf-8", end="\n", names=NAMES, last=True):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(names)
    writer.writerows(rows)
    text = out.getvalue()
    path = f"{root}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text if last else text.rstrip("\r\n"))


def _rows(rng, n):
    notes = ["plain", "two\nlines", "a, b", 'he said "no"', "x\n\ny\n", "\n", '"', 'a"\n"b,', "long " * 60,
             "many\n" * 50, "ünïcode", "back\\slash\n"]
    return [(f"2012{rng.randint(1, 12):02d}", f"AP{i}", rng.choice(["EZ", "Air, Inc", "ß"]), rng.choice(notes))
            for i in range(n)]


def _got(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


def test_spanning_files_are_read_in_splits(spark, scratch, small_splits):
    rng = random.Random(3)
    want = []
    for i, (encoding, end) in enumerate([("utf-8", "\n"), ("latin-1", "\n"), ("utf-8", "\r\n")]):
        rows = _rows(rng, 40)
        _land(f"{scratch}/2012", f"f{i}.csv", rows, encoding, end, last=i != 1)
        want += rows
    plain = [("201201", f"P{i}", "X", "one line") for i in range(30)]
    _land(f"{scratch}/2012", "deep/plain.csv", plain)
    manifest, opens = file_manifest(spark, f"{scratch}/2012")
    kinds = {os.path.basename(r.path): r.kind for r in manifest.collect()}
    assert kinds == {"f0.csv": "spanning", "f1.csv": "spanning", "f2.csv": "spanning", "plain.csv": "plain"}
    by = {}
    for r in opens.collect():
        by.setdefault(os.path.basename(r.path), []).append(r.opens)
    assert min(len(v) for v in by.values()) > 10  # each file is many splits,
    assert all(any(v) and not all(v) for v in by.values())  # some of which begin inside quotes
    df = read_csv(spark, scratch, 2012)
    # line ends inside quotes read as \n, like those of the multi-line reader
    assert _got(df) == sorted(tuple(x.replace("\r\n", "\n") for x in r) for r in want + plain)
    assert df.filter("rejected_record is not null").count() == 0
    assert df.select("source_file").distinct().count() == 4


def test_same_rows_with_one_split_and_many(spark, scratch):
    rng = random.Random(4)
    rows = _rows(rng, 60)
    _land(f"{scratch}/2013", "a.csv", rows)
    once = _got(read_csv(spark, scratch, 2013))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("97", "333", "4000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = read_csv(spark, scratch, 2013)
            assert _got(df) == once == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quotes_that_do_not_pair_up_fall_back_to_whole_files(spark, scratch, small_splits):
    path = f"{scratch}/2014"
    _land(path, "good.csv", [("201401", "A", "X", "two\nlines")])
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/inch.csv", "w") as f:  # a quote inside an unquoted field
        f.write(",".join(NAMES) + '\n201402,B,6" wide,x\n201403,C,Y,z\n' + "201404,D,Y,z\n" * 20)
    with open(f"{path}/mixed.csv", "w") as f:
        f.write(",".join(NAMES) + '\n201405,E,X,"two\nlines"\n201406,F,5" x 7",w\n201407,G,3",w\n')
    with open(f"{path}/two line header.csv", "w") as f:
        f.write('reporting_period,reporting_airport,airline_name,"no\nte"\n201408,H,X,y\n')
    kinds = {os.path.basename(r.path): r.kind for r in file_manifest(spark, path)[0].collect()}
    assert {unquote(k): v for k, v in kinds.items()} == {
        "good.csv": "spanning", "inch.csv": "whole", "mixed.csv": "whole", "two line header.csv": "whole"}
    rows = {r.reporting_airport: r for r in read_csv(spark, scratch, 2014).collect()}
    assert rows["A"].note == "two\nlines" and rows["B"].airline_name == '6" wide'
    assert rows["C"].airline_name == "Y" and rows["D"].note == "z" and rows["E"].note == "two\nlines"
    assert rows["F"].airline_name == '5" x 7"' and rows["G"].reporting_period == "201407"
    assert rows["H"]["no\nte"] == "y"


def test_too_many_fields_in_a_spanning_file(spark, scratch, small_splits):
    path = f"{scratch}/2015"
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write(",".join(NAMES) + '\n201501,A,X,"l\nm"\n201502,B,X,"l\nm",extra,"q\nr"\n201503,C\n\n   \n')
    rows = read_csv(spark, scratch, 2015).collect()
    bad = [r.rejected_record for r in rows if r.rejected_record]
    assert bad == ['201502,B,X,"l\nm",extra,"q\nr"']
    good = {r.reporting_airport: r for r in rows if not r.rejected_record}
    assert set(good) == {"A", "C"} and good["C"].airline_name is None


def test_no_path_list_reaches_the_driver(spark, scratch, monkeypatch):
    """Many files of one layout: the driver gets one row for all of them."""
    from pyspark.sql.classic.dataframe import DataFrame

    for i in range(30):
        _land(f"{scratch}/2016", f"f{i}.csv", [("201601", f"A{i}", "X", "n")])
    seen = []
    real = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(real(self)) or seen[-1])
    df = read_csv(spark, scratch, 2016)
    assert [len(rows) for rows in seen] == [1] and seen[0][0]["whole"] == []
    assert len(real(df)) == 30
    with pytest.raises(Exception):  # noqa: B017  (Spark's or ours: nothing to read)
        read_csv(spark, scratch, 1999)


def test_lines_of_a_file_do_not_meet_in_one_task_and_are_parsed_once(spark, scratch):
    """The manifest is sent to the lines; a filter on a parsed column does not
    repeat the parsing."""
    for i in range(3):
        _land(f"{scratch}/2012", f"f{i}.csv", [("201201", f"A{i}", "X", "n")] * 20)
    df = read_csv(spark, f"{scratch}/2012").filter("reporting_period like '2012%' and reporting_airport is not null")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("from_csv(") == 1
    assert df.count() == 60


def test_many_files_are_joined_without_sending_them_around(spark, scratch, monkeypatch):
    monkeypatch.setattr("tarmac.sources.csv.BROADCAST_BYTES", 0)
    rows = [("201201", f"A{i}", "X", "n") for i in range(9)]
    for i in range(3):
        _land(f"{scratch}/2012", f"f{i}.csv", rows[3 * i:3 * i + 3])
    assert _got(read_csv(spark, f"{scratch}/2012")) == sorted(rows)
