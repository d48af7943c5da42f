import os

import pytest
from pyspark.sql import functions as F

from tarmac.operators.normalize import normalize_files
from tarmac.plans.load import (
    DESTINATION, PREFIX, load_union, load_year, parsed_year, quarantined,
)
from tarmac.sources import files
from tarmac.sources.csv import list_csv, read_csv, read_csv_mixed_encoding
from tarmac.sources.tables import (
    is_complete, load_model, loaded_years, mark_complete, source_tables, write_mart,
    write_normalized, write_staging, write_year, year_table,
)

COARSE = ("run_date,reporting_period,reporting_airport,origin_destination_country,"
          "origin_destination,airline_name,scheduled_charter,number_flights_matched,"
          "average_delay_mins,flts_16_to_30_mins_late_percent\n")
FINE = ("reporting_period,reporting_airport,origin_destination_country,origin_destination,"
        "airline_name,scheduled_charter,number_flights_matched,average_delay_mins,"
        "flights_between_16_and_30_minutes_late_percent,number_flights_cancelled\n")


def _land(root):
    os.makedirs(f"{root}/2011", exist_ok=True)
    with open(f"{root}/2011/a.csv", "w", encoding="utf-8") as f:
        f.write(COARSE + "2011-05-01,201104,ZÜRICH,EUROPE,PARIS,\"Air, Inc\",S,10,12.5,3\n")
    with open(f"{root}/2011/b.CSV", "wb") as f:
        f.write((FINE + "2011-05,MÁLAGA,EUROPE,ROME,EZ,C,NA,7,4,1\n").encode("latin-1"))
    with open(f"{root}/2011/notes.txt", "w") as f:
        f.write("not a csv")
    os.makedirs(f"{root}/2012", exist_ok=True)


def test_list_and_read_mixed_encodings(spark, scratch):
    _land(scratch)
    listing = {os.path.basename(r.path): r.is_utf8 for r in list_csv(spark, scratch, 2011).collect()}
    assert listing == {"a.csv": True, "b.CSV": False}
    with pytest.raises(ValueError):
        list_csv(spark, scratch, 2012)
    raw = read_csv_mixed_encoding(spark, scratch, 2011)
    rows = {r.reporting_airport: r for r in raw.collect()}
    assert set(rows) == {"ZÜRICH", "MÁLAGA"}                  # both decoded correctly
    assert rows["ZÜRICH"].airline_name == "Air, Inc"          # quoted field
    assert rows["MÁLAGA"].run_date is None                    # column absent in that layout
    normalized, quarantine = normalize_files([raw.drop("source_file")])
    by_airport = {r.reporting_airport: r for r in normalized.collect()}
    assert by_airport["MÁLAGA"].number_flights_matched is None  # "NA"
    assert by_airport["MÁLAGA"]["16_to_30_mins_late_percent"] == 4.0
    assert by_airport["ZÜRICH"]["16_to_30_mins_late_percent"] == 3.0
    assert quarantine.count() == 0


HEADER = ("reporting_period,reporting_airport,origin_destination_country,origin_destination,"
          "airline_name,scheduled_charter,number_flights_matched,average_delay_mins\n")


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_quotes_backslashes_and_line_ends(spark, scratch):
    _write(f"{scratch}/2012/a.csv", HEADER
           + '201201,A,EU,R,"AIR ""X"" LTD, CO",S,10,5\n'
           + '201202,B,EU,R,"BACK\\",S,11,5\n201203,C,EU,R,plain\\,S,12,5\n')
    _write(f"{scratch}/2012/deep/er/b.csv", HEADER + '201204,D,EU,R,"two\nlines",S,13,5\n201205,E,EU,R,X,S,14,5\n')
    _write(f"{scratch}/2012/c.csv", HEADER.replace("\n", "\r\n") + "201206,F,EU,R,X,S,15,5\r\n")
    rows = {r.reporting_airport: r for r in read_csv_mixed_encoding(spark, scratch, 2012).collect()}
    assert set(rows) == set("ABCDEF")
    assert [rows[x].airline_name for x in "ABCD"] == ['AIR "X" LTD, CO', "BACK\\", "plain\\", "two\nlines"]
    assert rows["F"].average_delay_mins == "5" and rows["D"].source_file.endswith("deep/er/b.csv")
    headers = list_csv(spark, scratch, 2012).select("header").distinct().collect()
    assert max(len(r.header) for r in headers) < 200


def test_too_many_and_too_few_fields(spark, scratch):
    _write(f"{scratch}/2012/a.csv", HEADER + "201201,A,EU,R,X,S,10,5,extra\n201202,B,EU,R,X,S\n201203,C,EU,R,X,S,1,2\n")
    good = {r.reporting_airport: r for r in read_csv(spark, scratch, 2012).collect() if not r.rejected_record}
    assert set(good) == {"B", "C"} and good["B"].number_flights_matched is None
    with pytest.raises(Exception, match="more fields"):
        read_csv_mixed_encoding(spark, scratch, 2012).collect()
    ok, bad = parsed_year(spark, scratch, 2012)
    assert ok.count() == 2
    assert [(r.period_problem, r.rejected_record) for r in bad.collect()] == [("fields", "201201,A,EU,R,X,S,10,5,extra")]


def test_yearly_tables_keep_stray_rows(spark, scratch):
    """A row of another year stays in the table of its folder; loading a year
    again replaces that folder's table only."""
    landing, tables = f"{scratch}/landing", f"{scratch}/tables"
    _write(f"{landing}/2010/a.csv", HEADER + "201001,A,EU,R,X,S,10,5\n201002,A,EU,R,X,S,11,5\n")
    _write(f"{landing}/2011/a.csv", HEADER + "201101,B,EU,R,X,S,20,5\n201012,B,EU,R,X,S,21,5\n")
    with pytest.raises(ValueError, match="no table under"):
        source_tables(spark, tables, PREFIX)
    for year in (2010, 2011):
        assert load_year(spark, landing, tables, year)
    assert not load_year(spark, landing, tables, 2010, overwrite=False)
    assert source_tables(spark, tables, PREFIX) == [f"{PREFIX}2010", f"{PREFIX}2011"]
    load_union(spark, tables)
    assert source_tables(spark, tables, PREFIX, DESTINATION) == [f"{PREFIX}2010", f"{PREFIX}2011"]
    union = load_model(spark, f"{tables}/{DESTINATION}")
    assert sorted((r.year, r.month, r.number_flights_matched) for r in union.collect()) == [
        (2010, 1, 10), (2010, 2, 11), (2010, 12, 21), (2011, 1, 20)]
    assert sorted(r.year for r in loaded_years(spark, tables, PREFIX).collect()) == ["2010", "2011"]
    _write(f"{landing}/2011/a.csv", HEADER + "201103,B,EU,R,X,S,30,5\n")
    load_year(spark, landing, tables, 2011)
    load_union(spark, tables)
    got = load_model(spark, f"{tables}/{DESTINATION}").collect()
    assert sorted((r.year, r.month) for r in got) == [(2010, 1), (2010, 2), (2011, 3)]


def test_bad_rows_are_kept_whole_or_stop_the_load(spark, scratch):
    landing, tables = f"{scratch}/landing", f"{scratch}/tables"
    _write(f"{landing}/2011/a.csv", HEADER + "2011/01,A,EU,R,X,S,10,5\n201113,B,EU,R,X,S,20,5\n"
           "201102,C,EU,R,X,S,12.7,5\n201103,D,EU,R,X,S,12.0,5\n201104,E,EU,R,X,S,NA,5\n")
    load_year(spark, landing, tables, 2011)
    bad = {r.reporting_airport: r for r in quarantined(spark, tables).collect()}
    assert {k: r.period_problem for k, r in bad.items()} == {"A": "format", "B": "month", "C": "count"}
    assert bad["C"].number_flights_matched == "12.7" and bad["A"].source_file.endswith("a.csv")
    load_union(spark, tables)
    counts = {r.reporting_airport: r.number_flights_matched
              for r in load_model(spark, f"{tables}/{DESTINATION}").collect()}
    assert counts == {"D": 12, "E": None}
    with pytest.raises(ValueError, match="2011/01"):
        load_year(spark, landing, tables, 2011, on_bad="fail")


def test_text_and_typed_frames_unite(spark):
    typed = spark.createDataFrame([("201101", 5, 1.5)], "reporting_period string, number_flights_matched long, average_delay_mins double")
    text = spark.createDataFrame([("201102", "NA", "NA")], "reporting_period string, number_flights_matched string, average_delay_mins string")
    out, _ = normalize_files([typed, text])
    assert sorted((r.month, r.number_flights_matched) for r in out.collect()) == [(1, 5), (2, None)]
    with pytest.raises(ValueError, match="201313"):
        normalize_files([spark.createDataFrame([("201313",)], "reporting_period string")], on_bad="fail")


def test_write_year_and_other_sinks(spark, scratch):
    df = spark.createDataFrame([(2010, "a"), (2011, "b")], "year int, v string")
    write_year(df, scratch, "t_", 2010)
    write_year(df.filter("year = 2011"), scratch, "t_", 2011)
    write_year(df.filter("v = 'c'"), scratch, "t_", 2011)
    assert load_model(spark, year_table(scratch, "t_", 2010)).count() == 2
    assert load_model(spark, year_table(scratch, "t_", 2011)).count() == 0
    for sink in (write_normalized, write_mart):
        sink(df, f"{scratch}/{sink.__name__}")
        sink(df.limit(1), f"{scratch}/{sink.__name__}")
        assert load_model(spark, f"{scratch}/{sink.__name__}").count() == 1


def test_staging_rebuild_drops_absent_months(spark, scratch):
    df = spark.createDataFrame([(2001, m, "R", "X") for m in (1, 2)],
                               "year int, month int, origin_destination string, airline_name string")
    write_staging(df, f"{scratch}/stg")
    write_staging(df.filter("month = 2"), f"{scratch}/stg")
    assert [r.month for r in spark.read.parquet(f"{scratch}/stg").collect()] == [2]


def test_fingerprint_follows_the_files(spark, scratch):
    _write(f"{scratch}/t/a.csv", "x")
    one = files.fingerprint(spark, [f"{scratch}/t"])
    assert one == files.fingerprint(spark, [f"{scratch}/t"])
    _write(f"{scratch}/t/a.csv", "xy")
    two = files.fingerprint(spark, [f"{scratch}/t"])
    _write(f"{scratch}/t/b.csv", "x")
    assert len({one, two, files.fingerprint(spark, [f"{scratch}/t"])}) == 3
    assert files.fingerprint(spark, [f"{scratch}/none"]) and files.listing(spark, f"{scratch}/none") == []


def test_fingerprint_sees_changes_below_folders(spark, scratch):
    """A partitioned input: a file two levels down is rewritten, added, renamed."""
    base = f"{scratch}/t/year=2001/month=1"
    _write(f"{base}/a.csv", "x")
    _write(f"{scratch}/one.csv", "x")
    paths = [f"{scratch}/t", f"{scratch}/one.csv", f"{scratch}/none"]
    seen = [files.fingerprint(spark, paths)]
    assert seen == [files.fingerprint(spark, paths)]
    changes = (lambda: _write(f"{base}/a.csv", "xy"),
               lambda: os.utime(f"{base}/a.csv", (1, 1)),
               lambda: _write(f"{scratch}/t/year=2001/month=2/b.csv", "x"),
               lambda: os.rename(f"{base}/a.csv", f"{base}/c.csv"),
               lambda: _write(f"{scratch}/one.csv", "xy"))
    for change in changes:
        change()
        seen.append(files.fingerprint(spark, paths))
    assert len(set(seen)) == len(changes) + 1


def test_staging_is_rebuilt_when_a_nested_file_changes(spark, scratch):
    """The same through the build: tables in folders, one file two levels down."""
    from tarmac.plans.materialize import _bases

    for name in ("lineitem", "orders", "customer", "supplier", "part", "nation", "region"):
        _write(f"{scratch}/in/{name}.parquet/year=1/month=1/f.parquet", "x")
    before = _bases(spark, f"{scratch}/in", "staging")
    assert before == _bases(spark, f"{scratch}/in", "staging")
    _write(f"{scratch}/in/orders.parquet/year=1/month=1/f.parquet", "xyz")
    after = _bases(spark, f"{scratch}/in", "staging")
    assert after[0] == before[0] and after[1] != before[1]


def test_staging_sink_partitions_and_marker(spark, scratch):
    path = f"{scratch}/stg"
    df = spark.createDataFrame([(2001, 1, "R", "X", 1), (2001, 2, "Q", "Y", 2)],
                               "year int, month int, origin_destination string, "
                               "airline_name string, n int")
    assert not is_complete(spark, path)
    write_staging(df, path)
    mark_complete(spark, path)
    assert is_complete(spark, path)
    assert sorted(os.listdir(f"{path}/year=2001")) == ["month=1", "month=2"]
    back = load_model(spark, path, "stg")
    plan = back.filter((F.col("year") == 2001) & (F.col("month") == 2))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan
    with pytest.raises(ValueError, match="no table missing"):
        load_model(spark, f"{scratch}/nope", "missing")
