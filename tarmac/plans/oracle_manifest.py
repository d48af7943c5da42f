"""Oracle SQL (DuckDB) for the manifest queries.

Written with other means than the Spark column expressions: pages are cut at
fixed strings, not read by tag patterns, and catalogue values are written out.
What the driver tables do not have (character references by number, quoted
``>``, unclosed anchors, dot segments) is covered by unit tests on the Spark
side instead.
"""

from __future__ import annotations

# Fixed values of the catalogue pages.
CATALOGUE_BASE_URL = "https://data.example.org/punctuality/"
CATALOGUE_SUFFIXES = (
    " FullAnalysis (CSV document)",
    " Punctuality Statistics Full Analysis (CSV document)",
    " Arrival Departure Full Analysis (CSV document)",
    " Summary Analysis (PDF)",
)

AS_OF_YEAR = 2001
PREFIX = "raw/"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Unicode white space, as code points (the characters Python's strip removes).
_WS_CODES = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195,
             8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288)
_WS = " || ".join(f"chr({c})" for c in _WS_CODES)


def _decode(x: str) -> str:
    out = x
    for ent, ch in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"),
                    ("&apos;", "''''"), ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
        out = f"replace({out}, {_q(ent)}, {ch})"
    return out


def _links_ctes(src: str, keep: str) -> str:
    """CTEs ``cuts_<src>`` and ``links_<src>`` over a pages relation: what
    follows each ``<a `` is the attributes up to ``>`` and the text up to
    ``</a>``."""
    return f"""
cuts_{src} AS (
  SELECT {keep}, url AS page_url, unnest(cut) AS piece,
         CAST(unnest(range(len(cut))) AS INTEGER) AS pos
  FROM (SELECT *, string_split(html, '<a ')[2:] AS cut FROM {src}) t
),
pieces_{src} AS (
  SELECT {keep}, page_url, pos, split_part(piece, '>', 1) AS attrs,
         split_part(substr(piece, length(split_part(piece, '>', 1)) + 2), '</a>', 1) AS inner_html
  FROM cuts_{src}
),
links_{src} AS (
  SELECT * FROM (
    SELECT {keep}, page_url, pos, trim({_decode('inner_html')}, {_WS}) AS title,
           CASE WHEN contains(attrs, 'href="')
                THEN {_decode("split_part(split_part(attrs, 'href=\"', 2), '\"', 1)")} END AS href
    FROM pieces_{src}) l
  WHERE title <> '' AND href IS NOT NULL
)"""


_RESOLVE = """CASE
  WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href
  WHEN href = '' THEN page_url
  WHEN starts_with(href, '//') THEN regexp_extract(page_url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1) || ':' || href
  WHEN starts_with(href, '#') THEN regexp_extract(page_url, '^([^#]*)', 1) || href
  WHEN starts_with(href, '/') THEN regexp_extract(page_url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || href
  ELSE regexp_extract(page_url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^?#]*/)', 1) || href
END"""

_WANTED = ("regexp_matches(title, '(?i)full\\s*analysis') AND NOT "
           "regexp_matches(title, '(?i)arrival\\s*departure|arr\\s*dep|arrdep')")


def _period(expr: str) -> str:
    return f"""CASE WHEN regexp_extract({expr}, '(20\\d{{4}})', 1) <> ''
  AND CAST(substr(regexp_extract({expr}, '(20\\d{{4}})', 1), 1, 4) AS INTEGER) BETWEEN 2000 AND {AS_OF_YEAR}
  AND CAST(substr(regexp_extract({expr}, '(20\\d{{4}})', 1), 5, 2) AS INTEGER) BETWEEN 1 AND 12
  THEN regexp_extract({expr}, '(20\\d{{4}})', 1) ELSE '' END"""


def _safe(expr: str) -> str:
    return f"trim(regexp_replace(lower(trim({expr}, {_WS})), '[^a-z0-9]+', '_', 'g'), '_')"


def _catalogue(name: str, where: str = "") -> str:
    suffix = "CASE o_orderkey % 4 " + " ".join(
        f"WHEN {i} THEN {_q(s)}" for i, s in enumerate(CATALOGUE_SUFFIXES)) + " END"
    return f"""
{name} AS (
  SELECT o_orderkey AS page_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         {_q(CATALOGUE_BASE_URL)} || CAST(year(o_orderdate) AS VARCHAR) || '/' AS url,
         '<html><body><h1>Statistics</h1><p><a href="/f/' || CAST(o_orderkey AS VARCHAR) || '.csv">'
           || strftime(o_orderdate, '%Y%m') || {suffix} || '</a></p></body></html>' AS html
  FROM orders {where}
)"""


def _manifest_ctes(src: str) -> str:
    """records_<src>, manifest_<src>, paths_<src> over links_<src>."""
    return f"""
records_{src} AS (
  SELECT page_id, year, pos, title, {_RESOLVE} AS url, reporting_period,
         CASE WHEN starts_with(b2, reporting_period) THEN b2
              ELSE reporting_period || '_' || b2 END AS filename
  FROM (
    SELECT *, CASE WHEN suffix(b1, 'csv') THEN b1 ELSE b1 || '.csv' END AS b2
    FROM (
      SELECT *, CASE WHEN suffix(b0, 'csv_document') THEN rtrim(left(b0, length(b0) - 12), '_')
                     ELSE b0 END AS b1
      FROM (
        SELECT *, replace({_safe('title')}, 'fullanalysis', 'full_analysis') AS b0,
               {_period('title')} AS reporting_period
        FROM links_{src} WHERE {_WANTED}) a) b) c
  WHERE reporting_period <> ''
),
manifest_{src} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY filename ORDER BY year, page_id, pos) AS rn
    FROM records_{src}) r WHERE rn = 1
),
paths_{src} AS (
  SELECT *, {_q(PREFIX)} || substr(reporting_period, 1, 4) || '/' || filename AS path
  FROM manifest_{src}
)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def manifest_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    sup = _links_ctes("pages", "page_id")
    q["link_extract"] = _with(sup, select="SELECT page_id, page_url, pos, title, href FROM links_pages")
    q["link_resolve"] = _with(sup, select=f"SELECT page_id, pos, {_RESOLVE} AS url FROM links_pages")

    cat = [_catalogue("catalogue"), _links_ctes("catalogue", "page_id, year")]
    q["link_filter"] = _with(*cat, select=f"SELECT page_id, pos, title FROM links_catalogue WHERE {_WANTED}")
    q["link_period"] = _with(*cat, select=f"""
SELECT page_id, pos, title, {_period('title')} AS reporting_period
FROM links_catalogue WHERE {_WANTED}""")
    q["safe_filename"] = _with(*cat, select=f"""
SELECT page_id, pos, {_safe('title')} AS safe_name FROM links_catalogue""")
    man = cat + [_manifest_ctes("catalogue")]
    q["record_filename"] = _with(*man, select="""
SELECT page_id, pos, reporting_period, filename FROM records_catalogue""")
    q["manifest_dedupe"] = _with(*man, select="""
SELECT title, url, reporting_period, filename, year, page_id, pos FROM manifest_catalogue""")
    q["manifest_paths"] = _with(*man, select="SELECT filename, path FROM paths_catalogue")
    landed = [_catalogue("landed", "WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2001-01-01'"), _links_ctes("landed", "page_id, year"),
              _manifest_ctes("landed")]
    q["manifest_pending"] = _with(*man, *landed, select="""
SELECT filename, path FROM paths_catalogue
WHERE path NOT IN (SELECT path FROM paths_landed)""")
    lost = [_catalogue("lost", "WHERE o_orderstatus = 'P'"), _links_ctes("lost", "page_id, year"),
            _manifest_ctes("lost")]
    q["manifest_summary"] = _with(*man, *landed, *lost, select="""
SELECT 'pages_scanned' AS metric, count(*) AS value FROM catalogue
UNION ALL SELECT 'links_matched', count(*) FROM manifest_catalogue
UNION ALL
SELECT 'files_' || status, count(*) FROM (
  SELECT CASE WHEN path IN (SELECT path FROM paths_landed) THEN 'skipped'
              WHEN path IN (SELECT path FROM paths_lost) THEN 'failed' ELSE 'pending' END AS status
  FROM paths_catalogue) s
GROUP BY status""")
    q["manifest_years"] = _with(*man, select="""
SELECT DISTINCT substr(reporting_period, 1, 4) AS year FROM manifest_catalogue ORDER BY year""")
    q["pending_years"] = _with(*man, select=f"""
SELECT year FROM (SELECT DISTINCT substr(reporting_period, 1, 4) AS year FROM manifest_catalogue) y
WHERE year NOT IN (SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) FROM lineitem
                   WHERE year(l_shipdate) < {AS_OF_YEAR})
ORDER BY year""")
    return q
