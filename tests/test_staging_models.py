import pytest
from pyspark.sql import functions as F

from tarmac.operators import models, quality
from tarmac.operators.staging import int_scheduled_flights, unique_row_id


def _stg(spark):
    rows = [
        # year, month, airport, country, route, airline, flag, flights, delay, cancelled, p_unmatched
        (2000, 1, "A", "EU", "R1", "X", "S", 10, 20.0, 1, 5.0),
        (2000, 1, "A", "EU", "R1", "X", "S", 30, None, 2, 5.0),   # duplicate key, more flights
        (2000, 2, "B", "EU", "R2", "Y", "S", 0, 50.0, 0, 5.0),
        (2001, 3, "B", "AS", "R3", "Y", "C", 5, 10.0, -1, 101.0),
        (2001, 3, "C", "AS", "R3", "Z", "S", 5, 40.0, 0, 1.0),
    ]
    df = spark.createDataFrame(rows, "year int, month int, reporting_airport string, "
                                     "origin_destination_country string, origin_destination string, "
                                     "airline_name string, scheduled_charter string, "
                                     "number_flights_matched long, average_delay_mins double, "
                                     "number_flights_cancelled long, flights_unmatched_percent double")
    from tarmac.operators.staging import staging
    return staging(df)


def test_surrogate_key_has_no_delimiter(spark):
    df = spark.createDataFrame([(1, 2001, "AB", "C", None, "S")],
                               "month int, year int, reporting_airport string, "
                               "origin_destination string, airline_name string, scheduled_charter string")
    import hashlib
    assert df.select(unique_row_id()).first()[0] == hashlib.md5(b"12001ABCS").hexdigest()


def test_dedupe_keeps_one_row_per_key_deterministically(spark):
    stg = _stg(spark)
    sch = int_scheduled_flights(stg)
    assert sch.groupBy("unique_row_id").count().filter("count > 1").count() == 0
    a = {r.unique_row_id: r.number_flights_matched for r in sch.collect()}
    b = {r.unique_row_id: r.number_flights_matched
         for r in int_scheduled_flights(stg.repartition(7).orderBy(F.rand(3))).collect()}
    assert a == b and 30 in a.values() and 10 not in a.values()


def test_marts(spark):
    stg = _stg(spark)
    sch = int_scheduled_flights(stg)
    years = {r.year: r.avg_delay_mins for r in models.fct_delay_over_years(sch).collect()}
    # 2000 keeps only the 30-flight row, whose delay is null: null / 30 -> null.
    assert years == {2000: None, 2001: 40.0}
    assert models.fct_recent_number_tracked_flights(stg).first()[0] == 10
    assert models.fct_recent_published_date(stg).first()[0] == "March 2001"
    shares = {r.year: (r.fraction_charter_flights, r.fraction_scheduled_flights)
              for r in models.fct_fraction_charter_scheduled(stg).collect()}
    assert shares[2001] == (0.5, 0.5) and shares[2000] == (0.0, 1.0)
    for r in models.fct_fraction_charter_scheduled(stg).collect():
        assert 0.0 <= r.fraction_charter_flights <= 1.0


def test_quality_checks(spark):
    stg = _stg(spark)
    assert quality.violations_non_negative(stg).count() == 1
    assert quality.violations_percent_bounds(stg).count() == 1
    assert quality.duplicate_keys(stg).first()["n"] == 2
    report = {r.check_name: (r.failing_rows, r.status)
              for r in quality.dq_report(stg, int_scheduled_flights(stg)).collect()}
    assert report["non_negative_counts"] == (1, "fail")
    assert report["percent_bounds"] == (1, "fail")
    assert report["unique_int_unique_row_id"] == (0, "pass")
    bad = spark.createDataFrame([("x",)], "reporting_period string")
    with_bad = {r.check_name: r.failing_rows for r in
                quality.dq_report(stg, int_scheduled_flights(stg), bad).collect()}
    assert with_bad["quarantined_rows"] == 1
    with pytest.raises(quality.DataQualityError, match="non_negative_counts: 1 rows"):
        quality.dq_gate(quality.dq_report(stg, int_scheduled_flights(stg)))
    clean = stg.filter("scheduled_charter = 'S'")
    assert quality.dq_gate(quality.dq_report(clean, int_scheduled_flights(clean))).count() == 13
    nulls = {r.column_name: r.failing_rows for r in quality.check_not_null(stg).collect()}
    assert nulls["airline_name"] == 0 and len(nulls) == 9


def test_extreme_airport_tie_break(spark):
    df = spark.createDataFrame([("B", 2000, 10, 5.0, 1), ("A", 2000, 10, 5.0, 2)],
                               "reporting_airport string, year int, number_flights_matched long, "
                               "average_delay_mins double, number_flights_cancelled long")
    assert models.fct_airport_least_delays_by_year(df).first().reporting_airport == "A"
    assert models.fct_airport_most_delays_by_year(df).first().reporting_airport == "A"
