"""SQL (DuckDB dialect) for every registered query.

The driver runs these against the same parquet tables, registered as views,
and compares results with the Spark queries. The fixture is written here a
second time, directly in SQL with typed values; no constant or expression is
taken from the Spark side, so an error there cannot repeat itself here.
"""

from __future__ import annotations

from tarmac.plans.oracle_manifest import manifest_sql

# ------------------------------------------------------------ flights

_FACTS = """
facts AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS y,
         CAST(month(l.l_shipdate) AS INTEGER) AS m,
         sn.n_name AS ap, cr.r_name AS cty, cn.n_name AS od, p.p_brand AS al,
         CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE 'S' END AS sc,
         l.l_returnflag AS rf,
         CAST(l.l_quantity AS BIGINT) AS qty,
         (l.l_orderkey * 7 + l.l_partkey * 13 + l.l_linenumber * 31 + l.l_suppkey * 3) % 480 - 30 AS delay,
         l.l_orderkey AS ok, l.l_partkey AS pk, l.l_linenumber AS ln
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
cells AS (
  SELECT y, m, ap, cty, od, al, sc, rf,
         sum(qty) AS sq, sum(delay * qty) AS sdq, sum(pk) AS spk, sum(ok) AS sok,
         count(*) AS nr,
         count(*) FILTER (WHERE (ok + ln) % 25 = 0) AS n25,
         count(*) FILTER (WHERE (ok + ln) % 30 = 0) AS n30,
         count(*) FILTER (WHERE (ok + ln) % 40 = 0) AS n40,
         sum(CASE WHEN delay <= -16 THEN qty ELSE 0 END) AS b_early16,
         sum(CASE WHEN delay BETWEEN -15 AND -1 THEN qty ELSE 0 END) AS b_early1,
         sum(CASE WHEN delay BETWEEN 0 AND 15 THEN qty ELSE 0 END) AS b_0_15,
         sum(CASE WHEN delay <= 15 THEN qty ELSE 0 END) AS b_to15,
         sum(CASE WHEN delay BETWEEN 16 AND 30 THEN qty ELSE 0 END) AS b_16_30,
         sum(CASE WHEN delay BETWEEN 31 AND 60 THEN qty ELSE 0 END) AS b_31_60,
         sum(CASE WHEN delay BETWEEN 61 AND 120 THEN qty ELSE 0 END) AS b_61_120,
         sum(CASE WHEN delay BETWEEN 121 AND 180 THEN qty ELSE 0 END) AS b_121_180,
         sum(CASE WHEN delay BETWEEN 61 AND 180 THEN qty ELSE 0 END) AS b_61_180,
         sum(CASE WHEN delay BETWEEN 181 AND 360 THEN qty ELSE 0 END) AS b_181_360,
         sum(CASE WHEN delay >= 361 THEN qty ELSE 0 END) AS b_361
  FROM facts
  GROUP BY y, m, ap, cty, od, al, sc, rf
),
base AS (
  SELECT y, m, ap AS reporting_airport, cty AS origin_destination_country,
         od AS origin_destination, al AS airline_name, sc AS scheduled_charter,
         CAST(CASE WHEN spk % 31 = 0 THEN 0 ELSE sq END AS BIGINT) AS number_flights_matched,
         CAST(n25 AS BIGINT) AS actual_flights_unmatched,
         CASE WHEN sok % 29 = 0 THEN NULL ELSE CAST(floor(sdq / sq) AS DOUBLE) END AS average_delay_mins,
         CAST(n30 AS BIGINT) AS planned_flights_unmatched,
         CAST(floor(100 * n25 / nr) AS DOUBLE) AS flights_unmatched_percent,
         CAST(floor(100 * n40 / nr) AS DOUBLE) AS p_cancelled,
         CAST(n40 AS BIGINT) AS n_cancelled,
         CAST(floor(100 * b_early16 / sq) AS DOUBLE) AS p_early16,
         CAST(floor(100 * b_early1 / sq) AS DOUBLE) AS p_early1,
         CAST(floor(100 * b_0_15 / sq) AS DOUBLE) AS p_0_15,
         CAST(floor(100 * b_to15 / sq) AS DOUBLE) AS p_to15,
         CAST(floor(100 * b_16_30 / sq) AS DOUBLE) AS p_16_30,
         CAST(floor(100 * b_31_60 / sq) AS DOUBLE) AS p_31_60,
         CAST(floor(100 * b_61_120 / sq) AS DOUBLE) AS p_61_120,
         CAST(floor(100 * b_121_180 / sq) AS DOUBLE) AS p_121_180,
         CAST(floor(100 * b_61_180 / sq) AS DOUBLE) AS p_61_180,
         CAST(floor(100 * b_181_360 / sq) AS DOUBLE) AS p_181_360,
         CAST(floor(100 * b_361 / sq) AS DOUBLE) AS p_361
  FROM cells
),
raw_coarse AS (
  SELECT y AS year, m AS month, reporting_airport, origin_destination_country,
         origin_destination, airline_name, scheduled_charter, number_flights_matched,
         actual_flights_unmatched, average_delay_mins, planned_flights_unmatched,
         flights_unmatched_percent,
         p_to15 AS early_to_15_mins_late_percent,
         p_16_30 AS flts_16_to_30_mins_late_percent,
         p_31_60 AS flts_31_to_60_mins_late_percent,
         p_61_180 AS flts_61_to_180_mins_late_percent,
         p_181_360 AS flts_181_to_360_mins_late_percent,
         p_361 AS more_than_360_mins_late_percent
  FROM base WHERE y <= 1998
),
raw_fine AS (
  SELECT y AS year, m AS month, reporting_airport, origin_destination_country,
         origin_destination, airline_name, scheduled_charter, number_flights_matched,
         actual_flights_unmatched, average_delay_mins, planned_flights_unmatched,
         flights_unmatched_percent,
         p_early16 AS flights_more_than_15_minutes_early_percent,
         p_early1 AS flights_15_minutes_early_to_1_minute_early_percent,
         p_0_15 AS flights_0_to_15_minutes_late_percent,
         p_16_30 AS flights_between_16_and_30_minutes_late_percent,
         p_31_60 AS flights_between_31_and_60_minutes_late_percent,
         p_61_120 AS flights_between_61_and_120_minutes_late_percent,
         p_121_180 AS flights_between_121_and_180_minutes_late_percent,
         p_181_360 AS flights_between_181_and_360_minutes_late_percent,
         p_361 AS flights_more_than_360_minutes_late_percent,
         p_cancelled AS flights_cancelled_percent,
         n_cancelled AS number_flights_cancelled
  FROM base WHERE y > 1998
),
raw_all AS (
  SELECT * FROM raw_coarse UNION ALL BY NAME SELECT * FROM raw_fine
),
normalized AS (
  SELECT reporting_airport, origin_destination_country, origin_destination, airline_name,
         scheduled_charter, year, month, number_flights_matched, actual_flights_unmatched,
         flights_more_than_15_minutes_early_percent AS more_than_15_mins_early_percent,
         flights_15_minutes_early_to_1_minute_early_percent AS "15_mins_early_to_1_minute_early_percent",
         flights_0_to_15_minutes_late_percent AS "0_to_15_mins_late_percent",
         coalesce(early_to_15_mins_late_percent,
                  (flights_15_minutes_early_to_1_minute_early_percent
                   + flights_0_to_15_minutes_late_percent)
                  + flights_more_than_15_minutes_early_percent) AS early_to_15_mins_late_percent,
         coalesce(flts_16_to_30_mins_late_percent,
                  flights_between_16_and_30_minutes_late_percent) AS "16_to_30_mins_late_percent",
         coalesce(flts_31_to_60_mins_late_percent,
                  flights_between_31_and_60_minutes_late_percent) AS "31_to_60_mins_late_percent",
         coalesce(flts_61_to_180_mins_late_percent,
                  flights_between_61_and_120_minutes_late_percent
                  + flights_between_121_and_180_minutes_late_percent) AS "61_to_180_mins_late_percent",
         coalesce(flts_181_to_360_mins_late_percent,
                  flights_between_181_and_360_minutes_late_percent) AS "181_to_360_mins_late_percent",
         coalesce(more_than_360_mins_late_percent,
                  flights_more_than_360_minutes_late_percent) AS more_than_360_mins_late_percent,
         flights_unmatched_percent, flights_cancelled_percent, number_flights_cancelled,
         average_delay_mins, planned_flights_unmatched
  FROM raw_all
),
stg AS (
  SELECT md5(coalesce(CAST(month AS VARCHAR), '') || coalesce(CAST(year AS VARCHAR), '')
             || coalesce(reporting_airport, '') || coalesce(origin_destination, '')
             || coalesce(airline_name, '') || coalesce(scheduled_charter, '')) AS unique_row_id,
         year, month, make_date(year, month, 1) AS reporting_period_date,
         reporting_airport, origin_destination_country, origin_destination, airline_name,
         scheduled_charter, number_flights_matched, actual_flights_unmatched,
         early_to_15_mins_late_percent, "16_to_30_mins_late_percent",
         "31_to_60_mins_late_percent", "61_to_180_mins_late_percent",
         "181_to_360_mins_late_percent", more_than_360_mins_late_percent,
         average_delay_mins, planned_flights_unmatched, more_than_15_mins_early_percent,
         "15_mins_early_to_1_minute_early_percent", "0_to_15_mins_late_percent",
         flights_unmatched_percent, flights_cancelled_percent, number_flights_cancelled
  FROM normalized
),
sch AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY year, month, unique_row_id
      ORDER BY __DEDUPE_ORDER__) AS rn
    FROM stg WHERE scheduled_charter = 'S') ranked
  WHERE rn = 1
),
layout_common AS (
  SELECT y, m,
         CAST(y AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-28' AS run_date,
         reporting_airport, origin_destination_country, origin_destination, airline_name,
         scheduled_charter, number_flights_matched, actual_flights_unmatched,
         average_delay_mins, planned_flights_unmatched, flights_unmatched_percent,
         p_early16, p_early1, p_0_15, p_to15, p_16_30, p_31_60, p_61_120, p_121_180,
         p_61_180, p_181_360, p_361, p_cancelled, n_cancelled
  FROM base
),
layout_coarse AS (
  SELECT run_date, CAST(y AS VARCHAR) || lpad(CAST(m AS VARCHAR), 2, '0') AS reporting_period,
         reporting_airport, origin_destination_country, origin_destination, airline_name,
         scheduled_charter, number_flights_matched, actual_flights_unmatched,
         average_delay_mins, planned_flights_unmatched, flights_unmatched_percent,
         p_to15 AS early_to_15_mins_late_percent,
         p_16_30 AS flts_16_to_30_mins_late_percent,
         p_31_60 AS flts_31_to_60_mins_late_percent,
         p_61_180 AS flts_61_to_180_mins_late_percent,
         p_181_360 AS flts_181_to_360_mins_late_percent,
         p_361 AS more_than_360_mins_late_percent
  FROM layout_common WHERE y <= 1998
),
layout_fine AS (
  SELECT run_date, CAST(y AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS reporting_period,
         reporting_airport, origin_destination_country, origin_destination, airline_name,
         scheduled_charter, number_flights_matched, actual_flights_unmatched,
         average_delay_mins, planned_flights_unmatched, flights_unmatched_percent,
         p_early16 AS flights_more_than_15_minutes_early_percent,
         p_early1 AS flights_15_minutes_early_to_1_minute_early_percent,
         p_0_15 AS flights_0_to_15_minutes_late_percent,
         p_16_30 AS flights_between_16_and_30_minutes_late_percent,
         p_31_60 AS flights_between_31_and_60_minutes_late_percent,
         p_61_120 AS flights_between_61_and_120_minutes_late_percent,
         p_121_180 AS flights_between_121_and_180_minutes_late_percent,
         p_181_360 AS flights_between_181_and_360_minutes_late_percent,
         p_361 AS flights_more_than_360_minutes_late_percent,
         p_cancelled AS flights_cancelled_percent,
         n_cancelled AS number_flights_cancelled,
         CAST(0 AS BIGINT) AS previous_year_month_flights_matched
  FROM layout_common WHERE y > 1998
),
layouts AS (
  SELECT * FROM layout_coarse UNION ALL BY NAME SELECT * FROM layout_fine
),
dstg0 AS (
  SELECT * REPLACE (
    CASE WHEN year = 2001 AND month = 3 THEN CAST(-1 AS BIGINT)
         ELSE number_flights_cancelled END AS number_flights_cancelled,
    CASE WHEN year = 2000 AND month = 7 THEN 101.0::DOUBLE
         ELSE flights_unmatched_percent END AS flights_unmatched_percent,
    CASE WHEN year = 1999 AND month = 5 THEN NULL ELSE airline_name END AS airline_name)
  FROM stg
),
dstg AS (
  SELECT * REPLACE (
    md5(coalesce(CAST(month AS VARCHAR), '') || coalesce(CAST(year AS VARCHAR), '')
        || coalesce(reporting_airport, '') || coalesce(origin_destination, '')
        || coalesce(airline_name, '') || coalesce(scheduled_charter, '')) AS unique_row_id)
  FROM dstg0
),
dsch AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY year, month, unique_row_id
      ORDER BY __DEDUPE_ORDER__) AS rn
    FROM dstg WHERE scheduled_charter = 'S') ranked
  WHERE rn = 1
)"""

# Survivor order within a key: flights first, then every other column.
_ORDER = (
    "number_flights_matched", "reporting_airport", "origin_destination_country",
    "origin_destination", "airline_name", "actual_flights_unmatched",
    "early_to_15_mins_late_percent", "16_to_30_mins_late_percent", "31_to_60_mins_late_percent",
    "61_to_180_mins_late_percent", "181_to_360_mins_late_percent",
    "more_than_360_mins_late_percent", "average_delay_mins", "planned_flights_unmatched",
    "more_than_15_mins_early_percent", "15_mins_early_to_1_minute_early_percent",
    "0_to_15_mins_late_percent", "flights_unmatched_percent", "flights_cancelled_percent",
    "number_flights_cancelled",
)
FLIGHTS_CTES = _FACTS.replace(
    "__DEDUPE_ORDER__", ", ".join(f'"{c}" DESC NULLS LAST' for c in _ORDER))


def _flights(select: str, extra: str = "") -> str:
    """Full query: the flights CTE chain, optional extra CTEs, then ``select``."""
    ctes = FLIGHTS_CTES + ((",\n" + extra) if extra else "")
    return f"WITH {ctes}\n{select}"


def _wmean(digits: int) -> str:
    inner = ("sum(number_flights_matched * average_delay_mins) "
             "/ nullif(sum(number_flights_matched), 0)")
    if digits == 0:
        return f"round({inner}, 0)"
    scale = float(10 ** digits)
    return f"round(({inner}) * {scale}::DOUBLE, 0) / {scale}::DOUBLE"


_MONTH_CASE = """CASE month WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March'
  WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July'
  WHEN 8 THEN 'August' WHEN 9 THEN 'September' WHEN 10 THEN 'October'
  WHEN 11 THEN 'November' WHEN 12 THEN 'December' END"""

_LATEST_STG = """year = (SELECT max(year) FROM stg)
  AND month = (SELECT max(month) FROM stg WHERE year = (SELECT max(year) FROM stg))"""
_LATEST_SCH = """year = (SELECT max(year) FROM sch)
  AND month = (SELECT max(month) FROM sch WHERE year = (SELECT max(year) FROM sch))"""

AS_OF = "2001-06-15"


def flights_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["fct_delay_over_years"] = _flights(f"""
SELECT year, {_wmean(0)} AS avg_delay_mins
FROM sch WHERE number_flights_matched > 0
GROUP BY year ORDER BY year""")
    q["fct_delay_vs_month_last_year"] = _flights(f"""
SELECT month, {_MONTH_CASE} AS month_name, {_wmean(2)} AS avg_delay_mins
FROM sch
WHERE year = year(DATE '{AS_OF}') - 1 AND number_flights_matched > 0
GROUP BY month ORDER BY month""")
    q["fct_recent_airport_delays"] = _flights(f"""
SELECT reporting_airport, {_wmean(0)} AS avg_delay_mins
FROM sch WHERE {_LATEST_SCH}
GROUP BY reporting_airport""")
    q["fct_recent_number_tracked_flights"] = _flights(f"""
SELECT CAST(sum(number_flights_matched) AS BIGINT) AS total_tracked_flights
FROM stg WHERE {_LATEST_STG}""")
    q["fct_recent_published_date"] = _flights(f"""
SELECT {_MONTH_CASE} || ' ' || CAST(year AS VARCHAR) AS recent_published_date
FROM stg WHERE {_LATEST_STG}
LIMIT 1""")
    q["dim_recent_reporting_airports"] = _flights("""
SELECT DISTINCT reporting_airport FROM stg
WHERE year = (SELECT max(year) FROM stg)
ORDER BY reporting_airport""")
    for name, direction, nulls in (("fct_airport_least_delays_by_year", "ASC", "FIRST"),
                                   ("fct_airport_most_delays_by_year", "DESC", "LAST")):
        q[name] = _flights(f"""
SELECT reporting_airport, year, total_flights, total_cancelled_flights, avg_delay_mins
FROM (
  SELECT *, row_number() OVER (PARTITION BY year
           ORDER BY avg_delay_mins {direction} NULLS {nulls}, reporting_airport ASC NULLS FIRST) AS rank_in_year
  FROM (
    SELECT reporting_airport, year,
           CAST(sum(number_flights_matched) AS BIGINT) AS total_flights,
           CAST(sum(number_flights_cancelled) AS BIGINT) AS total_cancelled_flights,
           {_wmean(0)} AS avg_delay_mins
    FROM sch
    WHERE number_flights_matched > 0 AND average_delay_mins IS NOT NULL
      AND NOT isnan(average_delay_mins)
    GROUP BY reporting_airport, year) per_airport) ranked
WHERE rank_in_year = 1
ORDER BY year""")
    q["fct_country_delay_by_year"] = _flights(f"""
SELECT origin_destination_country,
       CAST(sum(number_flights_matched) AS BIGINT) AS total_flights_matched,
       {_wmean(0)} AS avg_delay_mins,
       round(avg("0_to_15_mins_late_percent") * 100.0::DOUBLE, 0) / 100.0::DOUBLE
         AS avg_0_to_15_mins_late_percent
FROM stg
WHERE year = (SELECT max(year) FROM sch) AND number_flights_matched > 0
GROUP BY origin_destination_country, year
ORDER BY avg_delay_mins DESC NULLS LAST""")
    q["fct_fraction_charter_scheduled"] = _flights("""
SELECT year,
       round(CAST(c AS DOUBLE) / nullif(t, 0) * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS fraction_charter_flights,
       round(CAST(s AS DOUBLE) / nullif(t, 0) * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS fraction_scheduled_flights,
       CAST(t AS BIGINT) AS total_flights
FROM (
  SELECT year,
         sum(CASE WHEN scheduled_charter = 'C' THEN number_flights_matched ELSE 0 END) AS c,
         sum(CASE WHEN scheduled_charter = 'S' THEN number_flights_matched ELSE 0 END) AS s,
         sum(number_flights_matched) AS t
  FROM stg GROUP BY year) yearly
ORDER BY year DESC""")
    busiest = """busiest AS (
  SELECT airline_name, CAST(sum(number_flights_matched) AS BIGINT) AS total_flights
  FROM sch WHERE year = (SELECT max(year) FROM sch)
  GROUP BY airline_name
  ORDER BY total_flights DESC NULLS LAST, airline_name ASC NULLS FIRST
  LIMIT 20)"""
    q["int_recent_busiest_airlines"] = _flights("SELECT * FROM busiest", busiest)
    q["fct_recent_avg_delay_airlines"] = _flights(f"""
SELECT airline_name, {_wmean(0)} AS avg_delay_mins
FROM stg
WHERE year = (SELECT max(year) FROM sch)
  AND airline_name IN (SELECT airline_name FROM busiest)
GROUP BY airline_name
ORDER BY avg_delay_mins DESC NULLS LAST""", busiest)
    q["int_scheduled_flights"] = _flights("SELECT * FROM sch")
    q["stg_punctuality"] = _flights("SELECT * FROM stg")
    return q


def _q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


_NOT_NULL = ("unique_row_id", "year", "month", "reporting_period_date", "reporting_airport",
             "origin_destination_country", "origin_destination", "airline_name",
             "number_flights_matched")
_NON_NEGATIVE = ("number_flights_matched < 0 OR actual_flights_unmatched < 0 "
                 "OR planned_flights_unmatched < 0 OR number_flights_cancelled < 0")
_PERCENT_BAD = ("flights_cancelled_percent < 0 OR flights_cancelled_percent > 100 "
                "OR flights_unmatched_percent < 0 OR flights_unmatched_percent > 100 "
                "OR more_than_360_mins_late_percent < 0 OR more_than_360_mins_late_percent > 100")


def ingest_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["union_layouts"] = _flights("SELECT * FROM layouts")
    q["parse_period"] = _flights("""
SELECT DISTINCT reporting_period,
       CAST(substr(reporting_period, 1, 4) AS INTEGER) AS year,
       CAST(right(reporting_period, 2) AS INTEGER) AS month
FROM layouts""")
    renamed = """
SELECT reporting_airport, origin_destination_country, origin_destination, airline_name,
       scheduled_charter, number_flights_matched, actual_flights_unmatched,
       average_delay_mins, planned_flights_unmatched, flights_unmatched_percent,
       early_to_15_mins_late_percent,
       coalesce(flts_16_to_30_mins_late_percent, flights_between_16_and_30_minutes_late_percent)
         AS "16_to_30_mins_late_percent",
       coalesce(flts_31_to_60_mins_late_percent, flights_between_31_and_60_minutes_late_percent)
         AS "31_to_60_mins_late_percent",
       flts_61_to_180_mins_late_percent AS "61_to_180_mins_late_percent",
       coalesce(flts_181_to_360_mins_late_percent, flights_between_181_and_360_minutes_late_percent)
         AS "181_to_360_mins_late_percent",
       coalesce(more_than_360_mins_late_percent, flights_more_than_360_minutes_late_percent)
         AS more_than_360_mins_late_percent,
       flights_more_than_15_minutes_early_percent AS more_than_15_mins_early_percent,
       flights_15_minutes_early_to_1_minute_early_percent AS "15_mins_early_to_1_minute_early_percent",
       flights_0_to_15_minutes_late_percent AS "0_to_15_mins_late_percent",
       flights_between_61_and_120_minutes_late_percent AS "61_to_120_mins_late_percent",
       flights_between_121_and_180_minutes_late_percent AS "121_to_180_mins_late_percent",
       flights_cancelled_percent, number_flights_cancelled
FROM layouts"""
    q["coalesce_rename"] = _flights(renamed)
    q["fill_bands"] = _flights(f"""
SELECT reporting_airport, origin_destination_country, origin_destination, airline_name,
       scheduled_charter,
       coalesce(early_to_15_mins_late_percent,
                ("15_mins_early_to_1_minute_early_percent" + "0_to_15_mins_late_percent")
                + more_than_15_mins_early_percent) AS early_to_15_mins_late_percent,
       coalesce("61_to_180_mins_late_percent",
                "61_to_120_mins_late_percent" + "121_to_180_mins_late_percent")
         AS "61_to_180_mins_late_percent"
FROM ({renamed}) renamed""")
    q["normalize"] = _flights("SELECT * FROM normalized")
    cols = ("run_date", "reporting_period", "reporting_airport", "origin_destination_country",
            "origin_destination", "airline_name", "scheduled_charter", "number_flights_matched",
            "actual_flights_unmatched", "average_delay_mins", "planned_flights_unmatched",
            "flights_unmatched_percent", "early_to_15_mins_late_percent",
            "flts_16_to_30_mins_late_percent", "flts_31_to_60_mins_late_percent",
            "flts_61_to_180_mins_late_percent", "flts_181_to_360_mins_late_percent",
            "more_than_360_mins_late_percent", "flights_more_than_15_minutes_early_percent",
            "flights_15_minutes_early_to_1_minute_early_percent",
            "flights_0_to_15_minutes_late_percent",
            "flights_between_16_and_30_minutes_late_percent",
            "flights_between_31_and_60_minutes_late_percent",
            "flights_between_61_and_120_minutes_late_percent",
            "flights_between_121_and_180_minutes_late_percent",
            "flights_between_181_and_360_minutes_late_percent",
            "flights_more_than_360_minutes_late_percent", "flights_cancelled_percent",
            "number_flights_cancelled", "previous_year_month_flights_matched")
    raw_text = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in cols if c != "reporting_period")
    q["period_quarantine"] = _flights(f"""
SELECT {raw_text},
       CASE reporting_period WHEN '199712' THEN '199713' ELSE '1996/05' END AS reporting_period,
       CASE reporting_period WHEN '199712' THEN 'month' ELSE 'format' END AS period_problem
FROM layouts
WHERE scheduled_charter = 'C' AND reporting_period IN ('199712', '199605')""")
    q["null_tokens"] = _flights("\nUNION ALL\n".join(
        f"SELECT {_q(c)} AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count "
        f"FROM layouts" for c in cols))
    return q


_LANDED_AIRLINE = """CASE airline_name WHEN 'Brand#11' THEN 'AIR "11" LTD, CO'
  WHEN 'Brand#12' THEN 'BACK, 12\\' WHEN 'Brand#13' THEN 'MÁLAGA AIR 13' ELSE airline_name END"""
_FOLDER = """CAST(CASE WHEN scheduled_charter = 'C' AND year = 1996 AND month = 12 THEN 1997
  ELSE year END AS VARCHAR)"""


def load_sql() -> dict[str, str]:
    """Queries over the fixture landed as CSV files and loaded again."""
    q: dict[str, str] = {}
    q["csv_load"] = _flights(f"""
SELECT reporting_period, reporting_airport, origin_destination_country, origin_destination,
       {_LANDED_AIRLINE} AS airline_name, scheduled_charter,
       CAST(number_flights_matched AS VARCHAR) AS number_flights_matched,
       CAST(average_delay_mins AS VARCHAR) AS average_delay_mins
FROM layouts""")
    q["parse_file"] = _flights(f"""
SELECT * REPLACE ({_LANDED_AIRLINE} AS airline_name) FROM raw_all""")
    q["yearly_table"] = _flights(f"""
SELECT 'punctuality_data_' || {_FOLDER} AS table_name, year, month, reporting_airport,
       {_LANDED_AIRLINE} AS airline_name, scheduled_charter
FROM raw_all""")
    q["union_table"] = _flights(f"""
SELECT * REPLACE ({_LANDED_AIRLINE} AS airline_name),
       CAST(NULL AS DOUBLE) AS "61_and_120_mins_late_percent",
       CAST(NULL AS DOUBLE) AS "121_and_180_mins_late_percent"
FROM normalized""")
    q["source_years"] = _flights(f"SELECT DISTINCT {_FOLDER} AS year FROM raw_all")
    return q


def staging_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["surrogate_key"] = _flights("""
SELECT unique_row_id, month, year, reporting_airport, origin_destination, airline_name,
       scheduled_charter FROM stg""")
    q["period_date"] = _flights("SELECT DISTINCT year, month, reporting_period_date FROM stg")
    q["stg_roundtrip"] = _flights("SELECT * FROM stg")
    return q


def primitive_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["weighted_mean_all"] = _flights(f"""
SELECT reporting_airport, year, {_wmean(0)} AS avg_delay_mins
FROM sch GROUP BY reporting_airport, year""")
    q["weighted_mean_valid"] = _flights("""
SELECT reporting_airport, year,
       round(sum(CASE WHEN valid THEN number_flights_matched * average_delay_mins END)
             / nullif(sum(CASE WHEN valid THEN number_flights_matched END), 0), 0) AS avg_delay_mins
FROM (SELECT *, coalesce(number_flights_matched > 0 AND average_delay_mins IS NOT NULL
                         AND NOT isnan(average_delay_mins), false) AS valid FROM sch) v
GROUP BY reporting_airport, year""")
    q["latest_period"] = _flights(f"SELECT DISTINCT year, month FROM stg WHERE {_LATEST_STG}")
    q["safe_divide"] = _flights("""
SELECT year, CAST(sum(number_flights_cancelled) AS DOUBLE)
             / nullif(sum(number_flights_matched), 0) AS cancelled_ratio
FROM stg GROUP BY year""")
    q["month_name"] = _flights(f"SELECT DISTINCT month, {_MONTH_CASE} AS month_name FROM stg")
    return q


def quality_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dq_not_null"] = _flights("\nUNION ALL\n".join(
        f"SELECT {_q(c)} AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS failing_rows "
        f"FROM dstg" for c in _NOT_NULL))
    q["dq_unique"] = _flights("""
SELECT unique_row_id, count(*) AS n FROM sch WHERE unique_row_id IS NOT NULL
GROUP BY unique_row_id HAVING count(*) > 1""")
    q["dq_duplicate_keys"] = _flights("""
SELECT unique_row_id, count(*) AS n FROM stg WHERE unique_row_id IS NOT NULL
GROUP BY unique_row_id HAVING count(*) > 1""")
    q["dq_non_negative"] = _flights(f"SELECT * FROM dstg WHERE coalesce({_NON_NEGATIVE}, false)")
    q["dq_percent_bounds"] = _flights(f"SELECT * FROM dstg WHERE coalesce({_PERCENT_BAD}, false)")
    parts = [f"SELECT {_q('not_null_stg_' + c)} AS check_name, "
             f"count(*) FILTER (WHERE \"{c}\" IS NULL) AS failing_rows FROM dstg" for c in _NOT_NULL]
    parts += [
        f"SELECT 'non_negative_counts', count(*) FILTER (WHERE coalesce({_NON_NEGATIVE}, false)) FROM dstg",
        f"SELECT 'percent_bounds', count(*) FILTER (WHERE coalesce({_PERCENT_BAD}, false)) FROM dstg",
        "SELECT 'not_null_int_unique_row_id', count(*) FILTER (WHERE unique_row_id IS NULL) FROM dsch",
        """SELECT 'unique_int_unique_row_id', count(*) FROM (
             SELECT unique_row_id FROM dsch WHERE unique_row_id IS NOT NULL
             GROUP BY unique_row_id HAVING count(*) > 1) d""",
    ]
    report = ("SELECT check_name, failing_rows, CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END "
              "AS status\nFROM (" + "\nUNION ALL\n".join(parts) + ") checks")
    q["dq_report"] = _flights(report)
    q["dq_gate"] = _flights(report.replace("dstg", "stg").replace("dsch", "sch"))
    q["dq_unique_repeated"] = _flights("""
SELECT unique_row_id, count(*) AS n FROM (
  SELECT unique_row_id FROM sch UNION ALL SELECT unique_row_id FROM sch WHERE month = 1) twice
GROUP BY unique_row_id HAVING count(*) > 1""")
    return q


def view_sql(marts: dict[str, str]) -> dict[str, str]:
    q: dict[str, str] = {}
    q["mart_roundtrip"] = marts["fct_recent_airport_delays"]
    bundle = ("fct_delay_over_years", "fct_recent_published_date",
              "fct_recent_number_tracked_flights", "fct_delay_vs_month_last_year",
              "fct_recent_airport_delays")

    def counted(name: str) -> str:
        return f"SELECT {_q(name)} AS table_name, count(*) AS n_rows FROM ({marts[name]}) m"

    keys = dict(zip(bundle, ("CAST(year AS VARCHAR)", "recent_published_date", "''",
                             "CAST(month AS VARCHAR) || ' ' || month_name", "reporting_airport")))
    values = dict(zip(bundle, ("avg_delay_mins", "NULL", "total_tracked_flights", "avg_delay_mins",
                               "avg_delay_mins")))
    q["dashboard_bundle"] = "\nUNION ALL\n".join(
        f"SELECT {_q(n)} AS table_name, {keys[n]} AS key, CAST({values[n]} AS DOUBLE) AS value "
        f"FROM ({marts[n]}) m" for n in bundle)
    q["model_inventory"] = "SELECT *, CAST(NULL AS VARCHAR) AS error FROM (" + "\nUNION ALL\n".join(
        counted(n) for n in bundle) + """) found
UNION ALL SELECT 'no_such_model', NULL,
  'there is no table no_such_model yet; build its model first'"""
    q["view_annual_trend"] = _flights(f"""
SELECT CAST(year AS VARCHAR) AS year, {_wmean(0)} AS avg_delay_mins
FROM sch WHERE number_flights_matched > 0 GROUP BY year""")
    q["view_monthly_bars"] = marts["fct_delay_vs_month_last_year"]
    q["view_airport_treemap"] = marts["fct_recent_airport_delays"]
    q["view_kpis"] = _flights(f"""
SELECT coalesce(lbl.recent_published_date, 'N/A') AS recent_published_date,
       coalesce(format('{{:,}}', tot.total_tracked_flights), 'N/A') AS total_tracked_flights
FROM (SELECT 1 AS k) one
LEFT JOIN (SELECT 1 AS k, sum(number_flights_matched) AS total_tracked_flights
           FROM stg WHERE {_LATEST_STG}) tot ON one.k = tot.k
LEFT JOIN (SELECT 1 AS k, {_MONTH_CASE} || ' ' || CAST(year AS VARCHAR) AS recent_published_date
           FROM stg WHERE {_LATEST_STG} LIMIT 1) lbl ON one.k = lbl.k""")
    return q


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(flights_sql())
    out.update(ingest_sql())
    out.update(load_sql())
    out.update(staging_sql())
    out.update(primitive_sql())
    out.update(quality_sql())
    out.update(view_sql(out))
    out.update(manifest_sql())
    return out
