import os

import pytest
from pyspark.errors import StreamingQueryException

from tarmac.plans import load
from tarmac.plans.load import PREFIX, quarantined
from tarmac.sources import versioned
from tarmac.sources.tables import load_model
from tarmac.streaming.landing import start_incremental_load

HEADER = ("reporting_period,reporting_airport,origin_destination_country,origin_destination,"
          "airline_name,scheduled_charter,number_flights_matched,average_delay_mins\n")


def _write(root, year, name, rows):
    os.makedirs(f"{root}/{year}", exist_ok=True)
    with open(f"{root}/{year}/{name}", "w") as f:
        f.write(HEADER + "".join(rows))


def _rows(spark, tables, year):
    return sorted((r.year, r.month, r.number_flights_matched)
                  for r in load_model(spark, f"{tables}/{PREFIX}{year}").collect())


def test_incremental_load_rebuilds_touched_years(spark, scratch):
    landing, tables, ckpt = f"{scratch}/landing", f"{scratch}/tables", f"{scratch}/ckpt"
    _write(landing, 2010, "a.csv", ["201001,A,EU,R,X,S,10,5\n"])
    _write(landing, 2011, "b.csv", ["201101,B,EU,R,X,S,20,6\n", "2011/02,B,EU,R,X,S,1,1\n"])
    _write(landing, "2011/sub/2012", "d.csv", ["201104,B,EU,R,X,S,40,6\n"])
    start_incremental_load(spark, landing, tables, checkpoint=ckpt).awaitTermination()
    assert _rows(spark, tables, 2010) == [(2010, 1, "10")]
    assert _rows(spark, tables, 2011) == [(2011, 1, "20"), (2011, 4, "40")]
    bad = quarantined(spark, tables).collect()
    assert [(r.reporting_period, r.period_problem) for r in bad] == [("2011/02", "format")]

    _write(landing, 2011, "c.csv", ["201103,C,EU,R,X,S,30,7\n"])
    start_incremental_load(spark, landing, tables, checkpoint=ckpt).awaitTermination()
    assert _rows(spark, tables, 2011) == [(2011, 1, "20"), (2011, 3, "30"), (2011, 4, "40")]


def test_file_outside_year_folders_stops_the_load(spark, scratch):
    landing = f"{scratch}/landing"
    _write(landing, "misc", "a.csv", ["201001,A,EU,R,X,S,10,5\n"])
    with pytest.raises(StreamingQueryException, match="outside every year folder"):
        start_incremental_load(spark, landing, f"{scratch}/t", checkpoint=f"{scratch}/c").awaitTermination()


def _part_files(spark, tables, year):
    return {name: part.folder for name, part in versioned.current(spark, f"{tables}/{PREFIX}{year}").parts.items()}


def test_new_files_are_added_and_no_other_is_read(spark, scratch, monkeypatch):
    landing, tables, ckpt = f"{scratch}/landing", f"{scratch}/tables", f"{scratch}/ckpt"
    _write(landing, 2010, "a b.csv", ["201001,A,EU,R,X,S,10,5\n"])
    start_incremental_load(spark, landing, tables, checkpoint=ckpt).awaitTermination()
    before = _part_files(spark, tables, 2010)
    with open(f"{landing}/2010/c+d.csv", "w") as f:  # another layout: one more column
        f.write(HEADER.replace("\n", ",number_flights_cancelled\n") + "201002,B,EU,R,X,S,20,6,3\n")
    read = []
    real = load.read_csv
    monkeypatch.setattr(load, "read_csv", lambda *a: read.append(a[3]) or real(*a))
    start_incremental_load(spark, landing, tables, checkpoint=ckpt).awaitTermination()
    assert [[os.path.basename(p) for p in paths] for paths in read] == [["c+d.csv"]]
    after = _part_files(spark, tables, 2010)
    assert before.items() < after.items() and len(after) == 2
    assert _rows(spark, tables, 2010) == [(2010, 1, "10"), (2010, 2, "20")]
    rows = load_model(spark, f"{tables}/{PREFIX}2010").collect()
    assert sorted((r.reporting_airport, r.number_flights_cancelled) for r in rows) == [("A", None), ("B", "3")]
    # the union follows, and a batch load of the year makes one part of it
    load.load_union(spark, tables)
    assert load_model(spark, f"{tables}/{load.DESTINATION}").count() == 2
    load.load_year(spark, landing, tables, 2010)
    assert set(_part_files(spark, tables, 2010)) == {versioned.WHOLE}
    assert _rows(spark, tables, 2010) == [(2010, 1, "10"), (2010, 2, "20")]


def test_replayed_and_restarted_loads_add_nothing_twice(spark, scratch):
    landing, tables = f"{scratch}/landing", f"{scratch}/tables"
    _write(landing, 2010, "a.csv", ["201001,A,EU,R,X,S,10,5\n", "2010/02,A,EU,R,X,S,1,1\n"])
    _write(landing, 2010, "bad only.csv", ["2010/03,A,EU,R,X,S,1,1\n"])
    paths = sorted(f"file:{landing}/2010/{n}" for n in os.listdir(f"{landing}/2010"))
    assert load.append_files(spark, landing, tables, 2010, paths) == paths
    for _ in range(2):
        assert load.append_files(spark, landing, tables, 2010, paths) == []
    # a stream without memory of what an earlier one did, batch by batch
    start_incremental_load(spark, landing, tables, checkpoint=f"{scratch}/new", max_files=1).awaitTermination()
    assert _rows(spark, tables, 2010) == [(2010, 1, "10")] and quarantined(spark, tables).count() == 2
    # a load that died between quarantine and table is done again, once
    _write(landing, 2010, "late.csv", ["201004,A,EU,R,X,S,40,5\n", "2010/05,A,EU,R,X,S,1,1\n"])
    late, real = [f"file:{landing}/2010/late.csv"], versioned.replace_parts

    def dies(session, path, frames, *rest, **more):
        if "quarantine" not in path:
            raise RuntimeError("lost")
        return real(session, path, frames, *rest, **more)

    versioned.replace_parts = dies
    try:
        with pytest.raises(RuntimeError, match="lost"):
            load.append_files(spark, landing, tables, 2010, late)
    finally:
        versioned.replace_parts = real
    assert load.append_files(spark, landing, tables, 2010, late) == late
    assert _rows(spark, tables, 2010) == [(2010, 1, "10"), (2010, 4, "40")]
    assert quarantined(spark, tables).count() == 3
