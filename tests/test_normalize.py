from tarmac.operators.normalize import (
    coalesce_rename, fill_bands, normalize, normalize_files, split_periods, union_layouts,
)
from tarmac.operators.staging import STAGING_NAMES, staging


def test_coalesce_rename_prefers_existing_target(spark):
    df = spark.createDataFrame([(5.0, 7.0), (None, 7.0)],
                               "`16_to_30_mins_late_percent` double, "
                               "flights_between_16_and_30_minutes_late_percent double")
    out = coalesce_rename(df)
    assert out.columns == ["16_to_30_mins_late_percent"]
    assert [r[0] for r in out.collect()] == [5.0, 7.0]


def test_coalesce_rename_map_order_decides(spark):
    df = spark.createDataFrame([(None, 3.0), (1.0, 3.0)],
                               "flts_16_to_30_mins_late_percent double, "
                               "flights_between_16_and_30_minutes_late_percent double")
    assert [r[0] for r in coalesce_rename(df).collect()] == [3.0, 1.0]


def test_fill_bands(spark):
    df = spark.createDataFrame([(None, 3.0, 4.0), (None, 3.0, None), (9.0, 1.0, 1.0)],
                               "`61_to_180_mins_late_percent` double, "
                               "`61_to_120_mins_late_percent` double, "
                               "`121_to_180_mins_late_percent` double")
    got = [r["61_to_180_mins_late_percent"] for r in fill_bands(df).collect()]
    assert got == [7.0, None, 9.0]


def test_fill_bands_adds_missing_columns(spark):
    df = spark.createDataFrame([("A",)], "reporting_airport string")
    out = fill_bands(df)
    assert {"61_to_180_mins_late_percent", "early_to_15_mins_late_percent"} <= set(out.columns)


def _raw(spark):
    coarse = spark.createDataFrame(
        [("2020-01-31", "199805", "LHR", "EUROPE", "PARIS", "BA", "S", "10", "1", "12.0", "NA",
          "50", "10", "5", "5", "20", "10")],
        "run_date string, reporting_period string, reporting_airport string, "
        "origin_destination_country string, origin_destination string, airline_name string, "
        "scheduled_charter string, number_flights_matched string, actual_flights_unmatched string, "
        "average_delay_mins string, planned_flights_unmatched string, "
        "early_to_15_mins_late_percent string, flts_16_to_30_mins_late_percent string, "
        "flts_31_to_60_mins_late_percent string, flts_61_to_180_mins_late_percent string, "
        "flts_181_to_360_mins_late_percent string, more_than_360_mins_late_percent string")
    fine = spark.createDataFrame(
        [("2020-01-31", " 2001-02 ", "LGW", "EUROPE", "ROME", "EZ", "C", "20.0", "0", "nan", "2",
          "10", "20", "30", "5", "5", "3", "4", "10", "13", "1.0", "2", "0")],
        "run_date string, reporting_period string, reporting_airport string, "
        "origin_destination_country string, origin_destination string, airline_name string, "
        "scheduled_charter string, number_flights_matched string, actual_flights_unmatched string, "
        "average_delay_mins string, planned_flights_unmatched string, "
        "flights_more_than_15_minutes_early_percent string, "
        "flights_15_minutes_early_to_1_minute_early_percent string, "
        "flights_0_to_15_minutes_late_percent string, "
        "flights_between_16_and_30_minutes_late_percent string, "
        "flights_between_31_and_60_minutes_late_percent string, "
        "flights_between_61_and_120_minutes_late_percent string, "
        "flights_between_121_and_180_minutes_late_percent string, "
        "flights_between_181_and_360_minutes_late_percent string, "
        "flights_more_than_360_minutes_late_percent string, flights_cancelled_percent string, "
        "number_flights_cancelled string, previous_year_month_flights_matched string")
    bad = spark.createDataFrame([("2011/04", "X")], "reporting_period string, reporting_airport string")
    return coarse, fine, bad


def test_normalize_two_layouts_from_text(spark):
    coarse, fine, bad = _raw(spark)
    normalized, quarantine = normalize_files([coarse, fine, bad])
    rows = {r.reporting_airport: r for r in normalized.collect()}
    assert set(rows) == {"LHR", "LGW"}
    lhr, lgw = rows["LHR"], rows["LGW"]
    assert (lhr.year, lhr.month, lgw.year, lgw.month) == (1998, 5, 2001, 2)
    assert lhr.planned_flights_unmatched is None          # "NA" token
    assert lgw.average_delay_mins is None                 # "nan" token
    assert lgw.number_flights_matched == 20               # "20.0" read as a count
    assert lgw.early_to_15_mins_late_percent == 60.0      # (20 + 30) + 10
    assert lgw["61_to_180_mins_late_percent"] == 7.0      # 3 + 4
    assert lgw["16_to_30_mins_late_percent"] == 5.0
    assert lhr["16_to_30_mins_late_percent"] == 10.0
    assert "61_to_120_mins_late_percent" not in normalized.columns   # dropped, as upstream
    assert not any(c.startswith("previous_year_") for c in normalized.columns)
    assert [(r.reporting_period, r.period_problem) for r in quarantine.collect()] == [("2011/04", "format")]


def test_normalize_is_idempotent(spark):
    coarse, fine, _ = _raw(spark)
    once, _ = normalize_files([coarse, fine])
    twice = normalize(once)
    assert sorted(once.collect()) == sorted(twice.select(*once.columns).collect())


def test_staging_fills_absent_columns(spark):
    coarse, _, _ = _raw(spark)
    normalized, _ = normalize_files([coarse])
    stg = staging(normalized)
    assert tuple(stg.columns) == STAGING_NAMES
    row = stg.first()
    assert row.number_flights_cancelled is None
    assert str(row.reporting_period_date) == "1998-05-01"


def test_union_layouts_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "c string, a long")
    out = union_layouts([a, b])
    assert sorted(out.columns) == ["a", "b", "c"]
    assert out.count() == 2


def test_split_periods_null_is_quarantined(spark):
    df = spark.createDataFrame([(None,), ("201104",)], "reporting_period string")
    good, bad = split_periods(df)
    assert good.count() == 1 and bad.count() == 1
