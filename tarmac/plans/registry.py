"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables at ``sf_dir`` (through the fixture
derivation in :mod:`tarmac.plans.fixture`) and returns a lazy DataFrame.
Column names match the SQL in :mod:`tarmac.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tarmac.functions import exprs
from tarmac.functions.html import resolve_url
from tarmac.functions.periods import latest_period_filter
from tarmac.functions.text import null_tokens, period_month, period_year, reporting_period_from_text
from tarmac.functions.text import safe_filename as safe_name
from tarmac.operators import manifest, models, normalize, quality, staging, views
from tarmac.plans import fixture, load
from tarmac.plans.build import flights
from tarmac.plans.materialize import (
    landed_csv, loaded_tables, raw_cells, staged_flights, written_marts, written_models,
)
from tarmac.plans.oracle import AS_OF
from tarmac.plans.oracle_manifest import AS_OF_YEAR, PREFIX
from tarmac.sources.csv import read_csv_mixed_encoding
from tarmac.sources.tables import load_model, loaded_years, source_tables
from tarmac.sources.testdata import table

Query = Callable[[SparkSession, str], DataFrame]


def _flight_queries() -> dict[str, Query]:
    def f(build):
        """Models read the written staging table."""
        return lambda spark, sf_dir: build(staged_flights(spark, sf_dir))

    def lazy(build):
        """Staging-level queries run the whole lazy plan from the raw tables."""
        return lambda spark, sf_dir: build(flights(spark, sf_dir))

    return {
        "fct_delay_over_years": f(lambda b: models.fct_delay_over_years(b.sch)),
        "fct_delay_vs_month_last_year": f(
            lambda b: models.fct_delay_vs_month_last_year(b.sch, as_of=AS_OF)),
        "fct_recent_airport_delays": f(
            lambda b: models.fct_recent_airport_delays(b.sch, b.periods)),
        "fct_recent_number_tracked_flights": f(
            lambda b: models.fct_recent_number_tracked_flights(b.stg, b.stg_periods)),
        "fct_recent_published_date": f(
            lambda b: models.fct_recent_published_date(b.stg, b.stg_periods)),
        "dim_recent_reporting_airports": f(
            lambda b: models.dim_recent_reporting_airports(b.stg, b.stg_periods)),
        "fct_airport_least_delays_by_year": f(
            lambda b: models.fct_airport_least_delays_by_year(b.sch)),
        "fct_airport_most_delays_by_year": f(
            lambda b: models.fct_airport_most_delays_by_year(b.sch)),
        "fct_country_delay_by_year": f(
            lambda b: models.fct_country_delay_by_year(b.stg, b.sch, b.periods)),
        "fct_fraction_charter_scheduled": f(
            lambda b: models.fct_fraction_charter_scheduled(b.stg)),
        "int_recent_busiest_airlines": f(
            lambda b: models.int_recent_busiest_airlines(b.sch, b.periods)),
        "fct_recent_avg_delay_airlines": f(
            lambda b: models.fct_recent_avg_delay_airlines(b.stg, b.sch, b.periods)),
        "int_scheduled_flights": f(lambda b: b.sch),
        "stg_punctuality": lazy(lambda b: b.stg),
    }


def _ingest_queries() -> dict[str, Query]:
    def raw(spark, sf_dir):
        return fixture.raw_flights(raw_cells(spark, sf_dir))

    def union_layouts(spark, sf_dir):
        layouts = fixture.raw_layouts(raw_cells(spark, sf_dir))
        return normalize.union_layouts([layouts["coarse"], layouts["fine"]])

    def parse_period(spark, sf_dir):
        return raw(spark, sf_dir).select(
            "reporting_period", period_year("reporting_period").alias("year"),
            period_month("reporting_period").alias("month")).distinct()

    def period_quarantine(spark, sf_dir):
        _, bad = normalize.normalize_files([fixture.dirty_raw_flights(raw_cells(spark, sf_dir))])
        return bad

    def coalesce_rename(spark, sf_dir):
        return normalize.coalesce_rename(normalize.drop_noise(raw(spark, sf_dir)))

    def fill_bands(spark, sf_dir):
        filled = normalize.fill_bands(coalesce_rename(spark, sf_dir))
        return filled.select("reporting_airport", "origin_destination_country",
                             "origin_destination", "airline_name", "scheduled_charter",
                             "early_to_15_mins_late_percent", "61_to_180_mins_late_percent")

    def null_token_counts(spark, sf_dir):
        text = fixture.as_text(raw(spark, sf_dir))
        counts = text.agg(*[F.count_if(null_tokens(F.col(f"`{c}`")).isNull()).alias(c)
                            for c in text.columns])
        return counts.unpivot([], counts.columns, "column_name", "null_count")

    def csv_load(spark, sf_dir):
        return read_csv_mixed_encoding(spark, landed_csv(spark, sf_dir)).select(
            "reporting_period", "reporting_airport", "origin_destination_country",
            "origin_destination", "airline_name", "scheduled_charter",
            null_tokens("number_flights_matched").alias("number_flights_matched"),
            null_tokens("average_delay_mins").alias("average_delay_mins"))

    def parse_file(spark, sf_dir):
        """Every parsed row of every file, each column cast to its type."""
        parsed = normalize.parse_file(read_csv_mixed_encoding(spark, landed_csv(spark, sf_dir)))
        return normalize.typed(normalize.drop_noise(parsed.drop("source_file", "reporting_period")))

    def yearly_table(spark, sf_dir):
        tables = loaded_tables(spark, sf_dir)
        names = source_tables(spark, tables, load.PREFIX, load.DESTINATION)
        frames = [load_model(spark, f"{tables}/{n}").select(
            F.lit(n).alias("table_name"), "year", "month", "reporting_airport", "airline_name",
            "scheduled_charter") for n in names]
        return normalize.union_layouts(frames)

    def union_table(spark, sf_dir):
        return load_model(spark, f"{loaded_tables(spark, sf_dir)}/{load.DESTINATION}")

    def source_years(spark, sf_dir):
        return loaded_years(spark, loaded_tables(spark, sf_dir), load.PREFIX)

    return {
        "csv_load": csv_load,
        "parse_file": parse_file,
        "yearly_table": yearly_table,
        "union_table": union_table,
        "source_years": source_years,
        "union_layouts": union_layouts,
        "parse_period": parse_period,
        "period_quarantine": period_quarantine,
        "coalesce_rename": coalesce_rename,
        "fill_bands": fill_bands,
        "normalize": lambda spark, sf_dir: flights(spark, sf_dir).normalized,
        "null_tokens": null_token_counts,
    }


def _staging_queries() -> dict[str, Query]:
    def st(spark, sf_dir):
        return staged_flights(spark, sf_dir)

    return {
        "surrogate_key": lambda spark, sf_dir: st(spark, sf_dir).stg.select(
            "unique_row_id", "month", "year", "reporting_airport", "origin_destination",
            "airline_name", "scheduled_charter"),
        "period_date": lambda spark, sf_dir: st(spark, sf_dir).stg.select(
            "year", "month", "reporting_period_date").distinct(),
        "stg_roundtrip": lambda spark, sf_dir: st(spark, sf_dir).stg,
    }


def _primitive_queries() -> dict[str, Query]:
    n, d = "number_flights_matched", "average_delay_mins"

    def wm(variant):
        def run(spark, sf_dir):
            sch = staged_flights(spark, sf_dir).sch
            agg = exprs.weighted_mean_all(n, d, 0) if variant == "all" else \
                exprs.weighted_mean_valid(n, d, 0)
            return sch.groupBy("reporting_airport", "year").agg(agg.alias("avg_delay_mins"))
        return run

    def latest(spark, sf_dir):
        f = staged_flights(spark, sf_dir)
        return f.stg.filter(latest_period_filter(f.stg_periods)).select("year", "month").distinct()

    def ratio(spark, sf_dir):
        stg = staged_flights(spark, sf_dir).stg
        return stg.groupBy("year").agg(
            exprs.safe_divide(F.sum("number_flights_cancelled"), F.sum(n)).alias("cancelled_ratio"))

    def names(spark, sf_dir):
        stg = staged_flights(spark, sf_dir).stg
        return stg.select("month", exprs.month_name("month").alias("month_name")).distinct()

    return {
        "weighted_mean_all": wm("all"),
        "weighted_mean_valid": wm("valid"),
        "latest_period": latest,
        "safe_divide": ratio,
        "month_name": names,
    }


def _quality_queries() -> dict[str, Query]:
    def dirty(spark, sf_dir):
        return fixture.dirty_staging(staged_flights(spark, sf_dir).stg)

    def report(spark, sf_dir):
        stg = dirty(spark, sf_dir)
        return quality.dq_report(stg, staging.int_scheduled_flights(stg))

    def duplicates(spark, sf_dir):
        """The clean table holds no duplicate key; staged twice, it holds some."""
        f = staged_flights(spark, sf_dir)
        again = f.sch.filter("month = 1")
        return quality.duplicate_keys(f.sch.unionByName(again))

    def gate(spark, sf_dir):
        f = staged_flights(spark, sf_dir)
        return quality.dq_gate(quality.dq_report_of_build(f.checks, f.sch))

    return {
        "dq_gate": gate,
        "dq_unique_repeated": duplicates,
        "dq_not_null": lambda spark, sf_dir: quality.check_not_null(dirty(spark, sf_dir)),
        "dq_unique": lambda spark, sf_dir: quality.duplicate_keys(staged_flights(spark, sf_dir).sch),
        "dq_duplicate_keys": lambda spark, sf_dir: quality.duplicate_keys(
            staged_flights(spark, sf_dir).stg),
        "dq_non_negative": lambda spark, sf_dir: quality.violations_non_negative(dirty(spark, sf_dir)),
        "dq_percent_bounds": lambda spark, sf_dir: quality.violations_percent_bounds(
            dirty(spark, sf_dir)),
        "dq_report": report,
    }


def _view_queries() -> dict[str, Query]:
    def b(spark, sf_dir):
        return staged_flights(spark, sf_dir)

    def kpis(spark, sf_dir):
        f = b(spark, sf_dir)
        return views.kpis(models.fct_recent_number_tracked_flights(f.stg, f.stg_periods),
                          models.fct_recent_published_date(f.stg, f.stg_periods))

    def marts(spark, sf_dir):
        return written_marts(spark, sf_dir, AS_OF)

    def bundle(spark, sf_dir):
        """Every row of the written marts in one long table."""
        root = marts(spark, sf_dir)
        return views.long_form({name: load_model(spark, f"{root}/{name}", name) for name in views.BUNDLE})

    def inventory(spark, sf_dir):
        """All written models, by listing them, and a missing one, which is an
        error that names it."""
        root, rows = marts(spark, sf_dir), []
        for name in [*written_models(spark, root), "no_such_model"]:
            try:
                rows.append((name, load_model(spark, f"{root}/{name}", name).count(), None))
            except ValueError as error:
                rows.append((name, None, str(error)))
        return spark.createDataFrame(rows, "table_name string, n_rows bigint, error string")

    return {
        "mart_roundtrip": lambda spark, sf_dir: load_model(
            spark, f"{marts(spark, sf_dir)}/fct_recent_airport_delays"),
        "model_inventory": inventory,
        "dashboard_bundle": bundle,
        "view_annual_trend": lambda spark, sf_dir: views.annual_trend(
            models.fct_delay_over_years(b(spark, sf_dir).sch)),
        "view_monthly_bars": lambda spark, sf_dir: views.monthly_bars(
            models.fct_delay_vs_month_last_year(b(spark, sf_dir).sch, as_of=AS_OF)),
        "view_airport_treemap": lambda spark, sf_dir: views.airport_treemap(
            models.fct_recent_airport_delays(b(spark, sf_dir).sch, b(spark, sf_dir).periods)),
        "view_kpis": kpis,
    }


def _manifest_queries() -> dict[str, Query]:
    def supplied_links(spark, sf_dir):
        return manifest.extract_links(table(spark, sf_dir, "pages"), keep=("page_id",))

    def catalogue_links(spark, sf_dir):
        return manifest.extract_links(fixture.catalogue_pages(spark, sf_dir))

    def records(spark, sf_dir):
        return manifest.manifest_records(catalogue_links(spark, sf_dir), AS_OF_YEAR)

    def built(spark, sf_dir):
        return manifest.build_manifest(fixture.catalogue_pages(spark, sf_dir), AS_OF_YEAR)

    def existing(spark, sf_dir):
        landed = manifest.build_manifest(fixture.landed_pages(spark, sf_dir), AS_OF_YEAR)
        return manifest.manifest_paths(landed, PREFIX).select("path")

    def failed(spark, sf_dir):
        lost = manifest.build_manifest(fixture.failed_pages(spark, sf_dir), AS_OF_YEAR)
        return manifest.manifest_paths(lost, PREFIX).select("path")

    return {
        "link_extract": lambda spark, sf_dir: supplied_links(spark, sf_dir).select(
            "page_id", "page_url", "pos", "title", "href"),
        "link_resolve": lambda spark, sf_dir: supplied_links(spark, sf_dir).select(
            "page_id", "pos", resolve_url("page_url", "href").alias("url")),
        "link_filter": lambda spark, sf_dir: manifest.filter_titles(
            catalogue_links(spark, sf_dir)).select("page_id", "pos", "title"),
        "link_period": lambda spark, sf_dir: manifest.filter_titles(
            catalogue_links(spark, sf_dir)).select(
            "page_id", "pos", "title",
            reporting_period_from_text("title", AS_OF_YEAR).alias("reporting_period")),
        "safe_filename": lambda spark, sf_dir: catalogue_links(spark, sf_dir).select(
            "page_id", "pos", safe_name("title").alias("safe_name")),
        "record_filename": lambda spark, sf_dir: records(spark, sf_dir).select(
            "page_id", "pos", "reporting_period", "filename"),
        "manifest_dedupe": lambda spark, sf_dir: built(spark, sf_dir).select(
            "title", "url", "reporting_period", "filename", "year", "page_id", "pos"),
        "manifest_paths": lambda spark, sf_dir: manifest.manifest_paths(
            built(spark, sf_dir), PREFIX).select("filename", "path"),
        "manifest_pending": lambda spark, sf_dir: manifest.pending_files(
            built(spark, sf_dir), existing(spark, sf_dir), PREFIX).select("filename", "path"),
        "manifest_summary": lambda spark, sf_dir: manifest.manifest_summary(
            fixture.catalogue_pages(spark, sf_dir), AS_OF_YEAR, existing(spark, sf_dir), PREFIX,
            failed=failed(spark, sf_dir)),
        "manifest_years": lambda spark, sf_dir: manifest.manifest_years(built(spark, sf_dir)),
        "pending_years": lambda spark, sf_dir: manifest.pending_years(
            built(spark, sf_dir), fixture.loaded_years(spark, sf_dir, AS_OF_YEAR)),
    }


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_flight_queries())
    out.update(_ingest_queries())
    out.update(_staging_queries())
    out.update(_primitive_queries())
    out.update(_quality_queries())
    out.update(_view_queries())
    out.update(_manifest_queries())
    return out
