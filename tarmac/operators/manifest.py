"""File manifest: from catalogue pages to the list of monthly files to land.

pages(page_id, year, url, html)
  -> links (one row per anchor)            extract_links
  -> wanted titles                         filter_titles
  -> records with period, file name, URL   manifest_records
  -> first record per file name            dedupe_manifest
  -> destination paths, pending files, run summary, years.

Pages are exploded into anchors, so the work is spread by page; nothing is
collected. The dedupe is one window with a rank-1 filter (partial
WindowGroupLimit before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.html import anchor_href, anchor_text, raw_anchors, resolve_url, start_tag
from tarmac.functions.text import destination_path, record_filename, reporting_period_from_text

# Titles of monthly full-analysis files, excluding the
# arrival/departure variants, case-insensitive. ``(?dU)``: ``.`` stops only at
# ``\n`` and ``\s`` is Unicode-aware, as in the original pattern's dialect.
TITLE_PATTERN = (
    r"(?idU)^(?!.*(?:Arrival\s*Departure|Arr\s*Dep|ArrDep))(?=.*Full\s*Analysis).*$"
)


def extract_links(pages: DataFrame, html_col: str = "html", url_col: str = "url",
                  keep: tuple[str, ...] = ("page_id", "year")) -> DataFrame:
    """Every anchor of every page with non-empty text and an ``href``:
    ``keep`` columns, ``page_url``, ``pos`` (anchor index in the page),
    ``title`` and ``href``."""
    kept = [c for c in keep if c in pages.columns]
    # One row an anchor first: what follows is plain projections of its text.
    raw = pages.select(*kept, F.col(url_col).alias("page_url"),
                       F.posexplode(raw_anchors(html_col)).alias("pos", "raw"))
    tags = raw.select(*kept, "page_url", "pos", "raw", start_tag("raw").alias("tag"))
    links = tags.select(*kept, "page_url", "pos", anchor_text("raw", "tag").alias("title"),
                        anchor_href("tag").alias("href"))
    return links.filter((F.col("title") != "") & F.col("href").isNotNull())


def title_matches(title: str | Column, pattern: str = TITLE_PATTERN) -> Column:
    t = F.col(title) if isinstance(title, str) else title
    return t.rlike(pattern)


def filter_titles(links: DataFrame, pattern: str = TITLE_PATTERN) -> DataFrame:
    return links.filter(title_matches("title", pattern))


def manifest_records(links: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Wanted links with a valid period: adds ``url`` (resolved),
    ``reporting_period`` and ``filename``."""
    wanted = filter_titles(links)
    # Worked out once per link: a generated row's columns are not written out
    # again into the filters and projections above it.
    found = F.array(F.struct(
        reporting_period_from_text("title", as_of_year).alias("reporting_period")))
    dated = wanted.select(*wanted.columns, F.inline(found)).filter("reporting_period != ''")
    named = F.array(F.struct(resolve_url("page_url", "href").alias("url"),
                             record_filename("title", "reporting_period").alias("filename")))
    return (dated.select(*dated.columns, F.inline(named))
            .drop("href", "page_url").select(
                *[c for c in dated.columns if c not in ("href", "page_url", "reporting_period")],
                "url", "reporting_period", "filename"))


def dedupe_manifest(records: DataFrame, order: tuple[str, ...] = ("year", "page_id", "pos")) -> DataFrame:
    """Keep the first record per file name, in catalogue-year, page and
    document order. A file name repeated across a third of the pages costs
    one row per map task in the shuffle (partial rank-1 limit)."""
    order_cols = [F.col(c).asc_nulls_last() for c in order if c in records.columns]
    w = Window.partitionBy("filename").orderBy(*order_cols)
    return (records.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def build_manifest(pages: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """pages -> deduplicated manifest (title, url, reporting_period, filename
    plus the page position columns)."""
    return dedupe_manifest(manifest_records(extract_links(pages), as_of_year))


def manifest_paths(manifest: DataFrame, prefix: str = "") -> DataFrame:
    """Adds the landing path ``{prefix/}{YYYY}/{filename}``."""
    return manifest.withColumn("path", destination_path("reporting_period", "filename", prefix))


def pending_files(manifest: DataFrame, existing: DataFrame, prefix: str = "",
                  overwrite: bool = False) -> DataFrame:
    """Manifest rows whose path is not in ``existing`` (a one-column listing
    of object names ``path``); with ``overwrite`` every row is pending. The
    listing is joined once (anti join), never probed per file."""
    paths = manifest_paths(manifest, prefix)
    if overwrite:
        return paths
    return paths.join(existing.select("path").distinct(), "path", "left_anti")


def landing_status(manifest: DataFrame, existing: DataFrame, prefix: str = "",
                   overwrite: bool = False, failed: DataFrame | None = None) -> DataFrame:
    """Each manifest row with ``status``: ``skipped`` (already landed),
    ``failed`` (its path is among those of ``failed``) or ``pending``."""
    out = manifest_paths(manifest, prefix)
    status = F.lit("pending")
    marks = [] if failed is None else [("failed", failed)]
    marks += [] if overwrite else [("skipped", existing)]
    for name, paths in marks:  # the last one counts: a landed file is not a failure
        out = out.join(paths.select("path").distinct().withColumn(f"_{name}", F.lit(True)), "path", "left")
        status = F.when(F.col(f"_{name}"), F.lit(name)).otherwise(status)
    return out.withColumn("status", status).drop(*[f"_{n}" for n, _ in marks])


def manifest_summary(pages: DataFrame, as_of_year: int | None, existing: DataFrame, prefix: str = "",
                     overwrite: bool = False, failed: DataFrame | None = None) -> DataFrame:
    """Run summary as (metric, value) rows: pages scanned, links matched and
    one count per landing status. The manifest is worked out once: links
    matched is the sum of the counts by status, and pages are only counted."""
    scanned = pages.agg(F.count(F.lit(1)).alias("value")) \
        .select(F.lit("pages_scanned").alias("metric"), "value")
    status = landing_status(build_manifest(pages, as_of_year), existing, prefix, overwrite, failed)
    statuses = ("skipped", "failed", "pending")
    counts = status.agg(F.count(F.lit(1)).alias("links_matched"),
                        *[F.count_if(F.col("status") == s).alias(f"files_{s}") for s in statuses])
    rows = counts.unpivot([], counts.columns, "metric", "value")
    return scanned.unionByName(rows.filter("value > 0 or metric = 'links_matched'"))


def manifest_years(manifest: DataFrame) -> DataFrame:
    """Distinct years (``YYYY`` text) present in the manifest, sorted."""
    return (manifest.select(F.substring("reporting_period", 1, 4).alias("year"))
            .distinct().orderBy("year"))


def pending_years(manifest: DataFrame, loaded_years: DataFrame, overwrite: bool = False) -> DataFrame:
    """Manifest years still to load: those without a loaded table, or all of
    them when overwriting. ``loaded_years`` has one column ``year``."""
    years = manifest_years(manifest)
    if overwrite:
        return years
    loaded = loaded_years.select(F.col("year").cast("string").alias("year")).distinct()
    return years.join(loaded, "year", "left_anti").orderBy("year")
