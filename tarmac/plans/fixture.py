"""Deterministic test inputs derived by Spark from the driver's tables.

The driver ships TPC-H-style tables, not on-time-performance files. This
module turns them into the two raw file layouts the ingest stage expects
(typed like the per-year load tables; :func:`as_text` gives the all-string
form a CSV read yields) and into a catalogue of web pages linking to
monthly files. Every row is computed from the given
tables, so the work grows with them.

Flights fixture: lineitem joined to orders, customer (+ nation, region),
supplier (+ nation) and part; grouped by year, month, airport (supplier
nation), country (customer region), route (customer nation), airline (part
brand), scheduled/charter flag and return flag. The return flag is grouped
but not output, so two rows of one cell become genuine duplicate keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.sources.testdata import table

# Delay bands (column, lowest minute, highest minute; None is
# open-ended) of the two raw layouts.
COARSE_BANDS = (
    ("early_to_15_mins_late_percent", None, 15),
    ("flts_16_to_30_mins_late_percent", 16, 30),
    ("flts_31_to_60_mins_late_percent", 31, 60),
    ("flts_61_to_180_mins_late_percent", 61, 180),
    ("flts_181_to_360_mins_late_percent", 181, 360),
    ("more_than_360_mins_late_percent", 361, None),
)
FINE_BANDS = (
    ("flights_more_than_15_minutes_early_percent", None, -16),
    ("flights_15_minutes_early_to_1_minute_early_percent", -15, -1),
    ("flights_0_to_15_minutes_late_percent", 0, 15),
    ("flights_between_16_and_30_minutes_late_percent", 16, 30),
    ("flights_between_31_and_60_minutes_late_percent", 31, 60),
    ("flights_between_61_and_120_minutes_late_percent", 61, 120),
    ("flights_between_121_and_180_minutes_late_percent", 121, 180),
    ("flights_between_181_and_360_minutes_late_percent", 181, 360),
    ("flights_more_than_360_minutes_late_percent", 361, None),
)
# Last year written in the coarse layout; later years use the fine layout.
LAST_COARSE_YEAR = 1998

DIMENSIONS = (
    "reporting_airport", "origin_destination_country", "origin_destination",
    "airline_name", "scheduled_charter",
)


def _band_key(lo: int | None, hi: int | None) -> str:
    return f"band_{'lo' if lo is None else str(lo).replace('-', 'm')}_{'hi' if hi is None else str(hi).replace('-', 'm')}"


def _places(nation: DataFrame, region: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nation keys with the place they stand for, names by place). A place
    numbers one pair of nation and region names, so grouping by it is grouping
    by the names, in one number. Both tables are tiny dimensions."""
    named = (nation.join(region, nation.n_regionkey == region.r_regionkey)
             .select("n_nationkey", F.col("n_name").alias("od"), F.col("r_name").alias("cty"))
             .withColumn("place", F.expr("dense_rank() OVER (ORDER BY od, cty)")))
    return named.select("n_nationkey", "place"), named.select("place", "od", "cty").distinct()


def _airports(nation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for airports, which are nations by name alone."""
    named = nation.select("n_nationkey", F.col("n_name").alias("ap")).withColumn(
        "airport", F.expr("dense_rank() OVER (ORDER BY ap)"))
    return named.select("n_nationkey", "airport"), named.select("airport", "ap").distinct()


def flight_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the fixture's derived attributes; places and
    airports as numbers.

    Orders meet their customers first, so line items, the largest table, do not
    move by customer. Dimension joins are left to the planner: nation and
    region are tiny files and become broadcast joins by the static size
    threshold; customer, supplier and part grow with the data, so they shuffle
    unless AQE measures them small enough at runtime.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("al"))
    nation = table(spark, sf_dir, "nation")
    places, _ = _places(nation, table(spark, sf_dir, "region"))
    airports, _ = _airports(nation)

    cust_geo = customer.join(places, customer.c_nationkey == places.n_nationkey).select("c_custkey", "place")
    supp_geo = supplier.join(airports, supplier.s_nationkey == airports.n_nationkey).select("s_suppkey", "airport")
    order_geo = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey).select("o_orderkey", "place")

    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return (
        li.join(order_geo, li.l_orderkey == order_geo.o_orderkey)
        .join(supp_geo, li.l_suppkey == supp_geo.s_suppkey)
        .join(part, li.l_partkey == part.p_partkey)
        .select(
            "y", "m", "airport", "place", "al",
            F.col("l_returnflag").alias("rf"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            ((ok * 7 + pk * 13 + ln * 31 + sk * 3) % 480 - 30).alias("delay"),
            ok.alias("ok"), pk.alias("pk"), ln.alias("ln"),
        )
    )


def flight_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly aggregate per cell, typed, with every band of both layouts.

    One hash aggregation with map-side partial aggregation; the group key
    has six columns, so no single key can hold a large share of rows
    unless the input itself is one cell. What a key or another sum tells
    (names, the charter flag, bands that others add up to) is left out of the
    rows that are grouped and added to the cells.
    """
    facts = flight_facts(spark, sf_dir)
    bands = {(lo, hi) for _, lo, hi in COARSE_BANDS + FINE_BANDS}
    fine = {(lo, hi) for _, lo, hi in FINE_BANDS}

    def in_band(lo: int | None, hi: int | None) -> str:
        parts = ([f"delay >= {lo}"] if lo is not None else []) + \
                ([f"delay <= {hi}"] if hi is not None else [])
        return " AND ".join(parts) or "true"

    def inside(band: tuple, outer: tuple) -> bool:
        return ((outer[0] is None or (band[0] is not None and band[0] >= outer[0])) and
                (outer[1] is None or (band[1] is not None and band[1] <= outer[1])))

    def band_sum(band: tuple) -> str:
        """A coarse band is the fine bands in it."""
        return " + ".join(_band_key(*b) for b in ([band] if band in fine else [x for x in fine if inside(x, band)]))

    order = lambda b: (b[0] is not None, b[0] or 0)
    # Aggregates as SQL text (one driver call each). The period is an
    # aggregate output (equal to y*100+m within a group), so predicates on
    # the period text stay above the aggregation instead of being pushed
    # onto every line-item row.
    aggs = [F.expr(text) for text in (
        "max(y * 100 + m) AS ym",
        "sum(qty) AS sum_qty",
        "sum(delay * qty) AS sum_delay_qty",
        "sum(pk) AS sum_pk",
        "sum(ok) AS sum_ok",
        "count(1) AS n_rows",
        "count_if((ok + ln) % 25 = 0) AS n_div25",
        "count_if((ok + ln) % 30 = 0) AS n_div30",
        "count_if((ok + ln) % 40 = 0) AS n_div40",
    )] + [
        F.expr(f"sum(CASE WHEN {in_band(lo, hi)} THEN qty ELSE 0 END) AS {_band_key(lo, hi)}")
        for lo, hi in sorted(fine, key=order)
    ]
    cells = facts.groupBy("y", "m", "airport", "place", "al", "rf").agg(*aggs)
    nation = table(spark, sf_dir, "nation")
    _, places = _places(nation, table(spark, sf_dir, "region"))
    _, airports = _airports(nation)
    return (cells.join(F.broadcast(airports), "airport").join(F.broadcast(places), "place").select(
        "y", "m", "ap", "cty", "od", "al", F.expr("CASE WHEN rf = 'R' THEN 'C' ELSE 'S' END AS sc"), "rf",
        "ym", "sum_qty", "sum_delay_qty", "sum_pk", "sum_ok", "n_rows", "n_div25", "n_div30", "n_div40",
        *[F.expr(f"{band_sum(b)} AS {_band_key(*b)}") for b in sorted(bands, key=order)]))


def _pct(part: Column, whole: Column) -> Column:
    return F.floor(F.lit(100) * part / whole).cast("double")


def _pct_sql(part: str, whole: str) -> str:
    return f"CAST(floor(100 * {part} / {whole}) AS DOUBLE)"


def _period_parts() -> tuple[Column, Column]:
    """Year and zero-padded month text, from the aggregated ``ym``."""
    ym = F.col("ym")
    return ((ym / 100).cast("int").cast("string"),
            F.lpad((ym % 100).cast("string"), 2, "0"))


def _common_columns(period: Column) -> list[Column]:
    sum_qty = F.col("sum_qty")
    y, m = _period_parts()
    return [
        F.concat_ws("-", y, m, F.lit("28")).alias("run_date"),
        period.alias("reporting_period"),
        F.col("ap").alias("reporting_airport"),
        F.col("cty").alias("origin_destination_country"),
        F.col("od").alias("origin_destination"),
        F.col("al").alias("airline_name"),
        F.col("sc").alias("scheduled_charter"),
        F.when(F.col("sum_pk") % 31 == 0, F.lit(0).cast("bigint"))
         .otherwise(sum_qty).alias("number_flights_matched"),
        F.col("n_div25").cast("bigint").alias("actual_flights_unmatched"),
        F.when(F.col("sum_ok") % 29 == 0, F.lit(None).cast("double"))
         .otherwise(F.floor(F.col("sum_delay_qty") / sum_qty).cast("double"))
         .alias("average_delay_mins"),
        F.col("n_div30").cast("bigint").alias("planned_flights_unmatched"),
        _pct(F.col("n_div25"), F.col("n_rows")).alias("flights_unmatched_percent"),
    ]


def _coarse_only() -> list[tuple[str, str]]:
    return [(_pct_sql(_band_key(lo, hi), "sum_qty"), name) for name, lo, hi in COARSE_BANDS]


def _fine_only() -> list[tuple[str, str]]:
    return [
        *[(_pct_sql(_band_key(lo, hi), "sum_qty"), name) for name, lo, hi in FINE_BANDS],
        (_pct_sql("n_div40", "n_rows"), "flights_cancelled_percent"),
        ("CAST(n_div40 AS BIGINT)", "number_flights_cancelled"),
        ("CAST(0 AS BIGINT)", "previous_year_month_flights_matched"),
    ]


def _exprs(pairs: list[tuple[str, str]], guard: str | None = None) -> list[Column]:
    if guard is None:
        return [F.expr(f"{text} AS `{name}`") for text, name in pairs]
    return [F.expr(f"CASE WHEN {guard} THEN {text} END AS `{name}`") for text, name in pairs]


def _periods() -> tuple[Column, Column]:
    y, m = _period_parts()
    return F.concat(y, m), F.concat_ws("-", y, m)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as a string, the way a header-only CSV read yields it."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def raw_layouts(cells: DataFrame) -> dict[str, DataFrame]:
    """The two raw file layouts as separate, typed DataFrames.

    ``coarse``: years up to 1998, period ``YYYYMM``, six coarse bands.
    ``fine``: later years, period ``YYYY-MM``, nine fine bands, cancellation
    columns and a ``previous_year_*`` column that normalisation drops.
    """
    coarse_period, fine_period = _periods()
    coarse = cells.filter(F.col("y") <= LAST_COARSE_YEAR).select(
        *_common_columns(coarse_period), *_exprs(_coarse_only()))
    fine = cells.filter(F.col("y") > LAST_COARSE_YEAR).select(
        *_common_columns(fine_period), *_exprs(_fine_only()))
    return {"coarse": coarse, "fine": fine}


def raw_flights(cells: DataFrame) -> DataFrame:
    """Both layouts in one pass over the cells: the same rows and columns as
    ``unionByName(coarse, fine, allowMissingColumns=True)``."""
    coarse = F.col("y") <= LAST_COARSE_YEAR
    coarse_period, fine_period = _periods()
    common = _common_columns(F.when(coarse, coarse_period).otherwise(fine_period))
    return cells.select(*common,
                        *_exprs(_coarse_only(), f"y <= {LAST_COARSE_YEAR}"),
                        *_exprs(_fine_only(), f"y > {LAST_COARSE_YEAR}"))


# Catalogue link suffixes chosen by order key modulo 4.
CATALOGUE_SUFFIXES = (
    " FullAnalysis (CSV document)",
    " Punctuality Statistics Full Analysis (CSV document)",
    " Arrival Departure Full Analysis (CSV document)",
    " Summary Analysis (PDF)",
)
CATALOGUE_BASE_URL = "https://data.example.org/punctuality/"


def _pages_from_orders(orders: DataFrame) -> DataFrame:
    suffix = F.element_at(F.array(*[F.lit(s) for s in CATALOGUE_SUFFIXES]),
                          (F.col("o_orderkey") % 4 + 1).cast("int"))
    title = F.concat(F.date_format("o_orderdate", "yyyyMM"), suffix)
    year = F.year("o_orderdate")
    # A page table lies in many files; the driver's single row group would put
    # all pages in one task. AQE sizes the pieces.
    return orders.hint("rebalance").select(
        F.col("o_orderkey").alias("page_id"),
        year.alias("year"),
        F.concat(F.lit(CATALOGUE_BASE_URL), year.cast("string"), F.lit("/")).alias("url"),
        F.concat(F.lit('<html><body><h1>Statistics</h1><p><a href="/f/'),
                 F.col("o_orderkey").cast("string"), F.lit('.csv">'), title,
                 F.lit("</a></p></body></html>")).alias("html"),
    )


def catalogue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue page per order: ``(page_id, year, url, html)``.

    The page links one monthly file whose title carries the order month as
    ``YYYYMM`` and one of four suffixes; two of them must be rejected by the
    title filter. ``year`` is the catalogue year the page was listed under.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return _pages_from_orders(orders)


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue pages whose files an earlier run already landed: those of
    fulfilled orders (status ``F``) placed before 2001. Their manifest paths
    form the listing of existing objects."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return _pages_from_orders(orders.filter((F.col("o_orderstatus") == "F")
                                            & (F.col("o_orderdate") < F.lit("2001-01-01"))))


def failed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue pages whose files could not be fetched: those of partly
    filled orders (status ``P``)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return _pages_from_orders(orders.filter(F.col("o_orderstatus") == "P"))


def dirty_staging(stg: DataFrame) -> DataFrame:
    """The staging table with three planted faults, for the data-quality
    checks (the clean fixture has none): cancellations of -1 in 2001-03,
    an unmatched share of 101 % in 2000-07 and a missing airline in
    1999-05. The surrogate key is recomputed after the change."""
    from tarmac.operators.staging import unique_row_id

    y, m = F.col("year"), F.col("month")
    dirty = stg.withColumns({
        "number_flights_cancelled": F.when((y == 2001) & (m == 3), F.lit(-1).cast("bigint"))
                                     .otherwise(F.col("number_flights_cancelled")),
        "flights_unmatched_percent": F.when((y == 2000) & (m == 7), F.lit(101.0))
                                      .otherwise(F.col("flights_unmatched_percent")),
        "airline_name": F.when((y == 1999) & (m == 5), F.lit(None).cast("string"))
                         .otherwise(F.col("airline_name")),
    })
    return dirty.withColumn("unique_row_id", unique_row_id())


def dirty_raw_flights(cells: DataFrame) -> DataFrame:
    """Raw rows with malformed periods planted for the quarantine: charter
    rows of December 1997 carry month 13 and charter rows of May 1996 a
    slash-separated period. All other rows are unchanged."""
    raw = raw_flights(cells)
    period = F.col("reporting_period")
    charter = F.col("scheduled_charter") == "C"
    return raw.withColumn(
        "reporting_period",
        F.when(charter & (period == "199712"), F.lit("199713"))
         .when(charter & (period == "199605"), F.lit("1996/05"))
         .otherwise(period))


# ------------------------------------------------------------- CSV landing

# Airline names that a CSV reader can get wrong (separator and
# doubled quotes, a backslash before the closing quote, a letter whose bytes
# differ between the encodings), by part brand.
LANDED_AIRLINES = (
    ("Brand#11", 'AIR "11" LTD, CO'),
    ("Brand#12", "BACK, 12\\"),
    ("Brand#13", "MÁLAGA AIR 13"),
)


def landed_cells(cells: DataFrame) -> DataFrame:
    """Cells as they are landed: renamed airlines, and the folder year. The
    charter rows of December 1996 lie in the folder of 1997."""
    airline = F.col("al")
    for brand, name in LANDED_AIRLINES:
        airline = F.when(F.col("al") == brand, F.lit(name)).otherwise(airline)
    stray = (F.col("sc") == "C") & (F.col("m") == 12) & (F.col("y") == 1996)
    return cells.withColumns({"al": airline,
                              "folder": F.when(stray, F.lit(1997)).otherwise(F.col("y"))})


def land_csv(cells: DataFrame, root: str) -> None:
    """Write the cells as CSV files under ``root/<year>``: coarse years in
    Latin-1, fine ones in UTF-8, missing values as ``NA``, and the second half
    of each year in a folder below the year's."""
    landed = landed_cells(cells)
    years = [r["folder"] for r in landed.select("folder").distinct().collect()]
    for year in sorted(years):
        # a folder has rows of its year and strays of the one before: other years' files are not read
        of_year = landed.filter(F.col("y").isin(year, year - 1)).filter(F.col("folder") == year)
        name, encoding = ("coarse", "ISO-8859-1") if year <= LAST_COARSE_YEAR else ("fine", "UTF-8")
        for rows, where in ((of_year.filter("m <= 6"), f"{root}/{year}"),
                            (of_year.filter("m > 6"), f"{root}/{year}/second_half")):
            (as_text(raw_layouts(rows)[name]).write.mode("append").option("header", True)
             .option("encoding", encoding).option("quote", '"').option("escape", '"')
             .option("nullValue", "NA").csv(where))


def loaded_years(spark: SparkSession, sf_dir: str, as_of_year: int) -> DataFrame:
    """Years already loaded into the warehouse: every shipment year before
    ``as_of_year`` (only the current year is still open)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.select(F.year("l_shipdate").alias("year"))
            .filter(F.col("year") < as_of_year).distinct())
