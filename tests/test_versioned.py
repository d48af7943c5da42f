import os
import signal
import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from tarmac.plans.load import DESTINATION, PREFIX, load_union, load_year
from tarmac.sources import files, versioned
from tarmac.sources.tables import load_model, loaded_years, source_tables, write_year, year_table

HEADER = ("reporting_period,reporting_airport,origin_destination_country,origin_destination,"
          "airline_name,scheduled_charter,number_flights_matched,average_delay_mins\n")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def values(df):
    return sorted(r[0] for r in df.collect())


def frame(spark, *xs):
    return spark.createDataFrame([(x, "p") for x in xs], "x long, part string")


def test_replace_and_read(spark, scratch):
    path = f"{scratch}/t"
    assert versioned.current(spark, path) is None and not versioned.exists(spark, path)
    with pytest.raises(ValueError, match="no whole table"):
        versioned.read(spark, path)
    versioned.replace(frame(spark, 1, 2), path)
    old = versioned.read(spark, path)
    versioned.replace(frame(spark, 3), path)
    assert values(versioned.read(spark, path)) == [3]
    assert values(old) == [1, 2]  # a reader keeps the files it began with
    versioned.replace(frame(spark).filter("false"), path)
    assert values(versioned.read(spark, path)) == [] and versioned.read(spark, path).columns == ["x", "part"]
    kept = [f for f in os.listdir(path) if f.startswith("data-")]
    assert len(kept) == versioned.KEPT == len(os.listdir(f"{path}/_versions")) - len(
        [f for f in os.listdir(f"{path}/_versions") if f.endswith(".crc")])


def test_replace_parts_leaves_the_others(spark, scratch):
    path = f"{scratch}/t"
    one = versioned.replace_parts(spark, path, {"a": frame(spark, 1), "b": frame(spark, 2), "none": frame(spark)},
                                  {"a": "s1"})
    assert values(load_model(spark, path)) == [1, 2] and one.parts["a"].source == "s1"
    two = versioned.replace_parts(spark, path, {"b": frame(spark, 20, 21)}, drop=("none",))
    assert values(load_model(spark, path)) == [1, 20, 21]
    assert two.parts["a"] == one.parts["a"] and set(two.parts) == {"a", "b"}
    assert load_model(spark, path).columns == ["x", "part"]
    versioned.replace_parts(spark, path, {}, drop=("a",))
    assert values(load_model(spark, path)) == [20, 21]


def test_second_of_two_writers_keeps_the_first_ones_change(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    versioned.replace_parts(spark, path, {"a": frame(spark, 1), "b": frame(spark, 2)})
    real, raced = files.create_once, []

    def race(session, name, text):
        if not raced:  # another writer commits between this one's read and commit
            raced.append(1)
            versioned.replace_parts(spark, path, {"a": frame(spark, 10)})
        return real(session, name, text)

    monkeypatch.setattr(files, "create_once", race)
    versioned.replace_parts(spark, path, {"b": frame(spark, 20)})
    assert values(load_model(spark, path)) == [10, 20]


def test_failed_write_leaves_the_table(spark, scratch):
    write_year(frame(spark, 1), scratch, "t_", 2010)
    bad = frame(spark, 2).withColumn("x", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_year(bad, scratch, "t_", 2010)
    assert values(load_model(spark, year_table(scratch, "t_", 2010))) == [1]
    with pytest.raises(Exception, match="lost"):
        write_year(bad, scratch, "t_", 2011)  # never whole, so not there
    assert source_tables(spark, scratch, "t_") == ["t_2010"]
    assert [r.year for r in loaded_years(spark, scratch, "t_").collect()] == ["2010"]
    with pytest.raises(ValueError, match="no table"):
        load_model(spark, year_table(scratch, "t_", 2011), "t_2011")
    gone = versioned.vacuum(spark, year_table(scratch, "t_", 2010), older_than_s=-60)
    assert len(gone) <= 1 and values(load_model(spark, year_table(scratch, "t_", 2010))) == [1]


def test_job_killed_in_mid_write_leaves_the_old_table(spark, scratch):
    """A process of its own overwrites a table and is killed while its tasks
    write: the table still reads whole, and a later load replaces it."""
    write_year(frame(spark, 1, 2, 3), scratch, "t_", 2010)
    script = f"{scratch}/writer.py"
    _write(script, textwrap.dedent(f"""
        import sys, time
        sys.path.insert(0, {os.getcwd()!r})
        from pyspark.sql import SparkSession, functions as F
        from pyspark.sql.classic.dataframe import DataFrame
        from tarmac.sources.tables import write_year
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").getOrCreate())
        DataFrame.hint = lambda self, *_: self  # no shuffle: tasks write while they compute
        @F.udf("long")
        def slow(x):
            time.sleep(0.02)
            return x
        print("writing", flush=True)
        write_year(spark.range(100000).select(slow("id").alias("x"), F.lit("p").alias("part")),
                   {scratch!r}, "t_", 2010)
    """))
    job = subprocess.Popen([sys.executable, script], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL,
                           start_new_session=True)
    table = year_table(scratch, "t_", 2010)
    try:
        deadline = time.time() + 120
        while time.time() < deadline and job.poll() is None and \
                sum(f.startswith("data-") for f in os.listdir(table)) < 2:
            time.sleep(0.1)
        assert job.poll() is None and sum(f.startswith("data-") for f in os.listdir(table)) == 2
    finally:
        os.killpg(job.pid, signal.SIGKILL)
        job.wait()
    assert values(load_model(spark, table)) == [1, 2, 3]
    assert len(versioned.vacuum(spark, table, older_than_s=-60)) == 1
    write_year(frame(spark, 9), scratch, "t_", 2010)
    assert values(load_model(spark, table)) == [9]


def test_loading_one_year_rewrites_one_part_of_the_union(spark, scratch):
    landing, tables = f"{scratch}/landing", f"{scratch}/tables"
    for year in (2010, 2011, 2012):
        _write(f"{landing}/{year}/a.csv", HEADER + f"{year}01,A,EU,R,X,S,{year},5\n")
        load_year(spark, landing, tables, year)
    path = load_union(spark, tables)
    assert path.endswith(DESTINATION)
    first = versioned.current(spark, path)
    assert set(first.parts) == {f"{PREFIX}{y}" for y in (2010, 2011, 2012)}
    assert load_union(spark, tables) == path and versioned.current(spark, path) == first  # nothing to do
    _write(f"{landing}/2011/b.csv", HEADER + "201102,B,EU,R,X,S,7,5\n")
    load_year(spark, landing, tables, 2011)
    load_union(spark, tables)
    second = versioned.current(spark, path)
    assert second.number == first.number + 1
    changed = {n for n in first.parts if first.parts[n] != second.parts[n]}
    assert changed == {f"{PREFIX}2011"}
    rows = load_model(spark, path)
    assert sorted((r.year, r.month, r.number_flights_matched) for r in rows.collect()) == [
        (2010, 1, 2010), (2011, 1, 2011), (2011, 2, 7), (2012, 1, 2012)]
    load_union(spark, tables, full=True)
    third = versioned.current(spark, path)
    assert all(third.parts[n] != second.parts[n] for n in third.parts)
    assert load_model(spark, path).count() == 4


def test_union_follows_tables_that_leave(spark, scratch):
    landing, tables = f"{scratch}/landing", f"{scratch}/tables"
    for year in (2010, 2011):
        _write(f"{landing}/{year}/a.csv", HEADER + f"{year}01,A,EU,R,X,S,1,5\n")
        load_year(spark, landing, tables, year)
    path = load_union(spark, tables)
    files.delete(spark, year_table(tables, PREFIX, 2010))
    load_union(spark, tables)
    assert [r.year for r in load_model(spark, path).collect()] == [2011]
