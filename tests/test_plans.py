"""The physical plans keep the properties the design relies on."""

import datetime
import itertools
import os
import re
import shutil
from collections import Counter

import pytest

from tarmac.operators import quality, views
from tarmac.operators.staging import int_scheduled_flights
from tarmac.plans.fixture import dirty_staging, flight_cells
from tarmac.plans.materialize import _INPUTS, build_staging, staged_flights
from tarmac.plans.registry import queries
from tarmac.session import ensure_checkpoint_dir
from tarmac.sources import files
from tarmac.sources.tables import periods_of, write_staging

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q():
    return queries()


def test_dedupe_limits_before_the_shuffle(spark):
    stg = staged_flights(spark, SF).stg
    plan = _plan(int_scheduled_flights(stg))
    assert plan.count("WindowGroupLimit") >= 2      # partial (map side) + final


def test_models_read_the_deduplicated_table(spark, q):
    for name in ("fct_delay_over_years", "fct_airport_least_delays_by_year", "int_scheduled_flights"):
        plan = _plan(q[name](spark, SF))
        assert "unique_row_id ASC" not in plan and "WindowGroupLimit [unique_row_id" not in plan
    plan = _plan(q["fct_delay_over_years"](spark, SF))
    assert "Window" not in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan)[1]
    assert len(schema.split(",")) <= 4


def test_layouts_come_from_one_scan_of_written_cells(spark, q):
    assert "lineitem" not in _plan(q["union_layouts"](spark, SF))


def test_summary_reads_pages_once(spark, q):
    plan = _plan(q["manifest_summary"](spark, SF))
    final = plan.split("== Initial Plan ==")[0]
    # pages counted, manifest, landed and failed listings
    assert final.count("FileScan parquet") <= 4


def test_latest_month_prunes_partitions(spark, q):
    plan = _plan(q["fct_recent_airport_delays"](spark, SF))
    assert "PartitionFilters: [isnotnull(year" in plan and "Subquery" in plan


def test_busiest_airlines_broadcast_semi_join(spark, q):
    plan = _plan(q["fct_recent_avg_delay_airlines"](spark, SF))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "TakeOrderedAndProject" in plan


def test_models_read_the_written_staging_table(spark, q):
    plan = _plan(q["fct_delay_over_years"](spark, SF))
    assert "lineitem" not in plan and "staging" in plan


def test_dashboard_bundle_and_kpis(spark):
    f = staged_flights(spark, SF)
    bundle = views.dashboard_bundle(f.stg, f.sch, as_of="2001-06-15")
    assert set(bundle) == {"fct_delay_over_years", "fct_recent_published_date",
                           "fct_recent_number_tracked_flights", "fct_delay_vs_month_last_year",
                           "fct_recent_airport_delays"}
    kpi = views.kpis(bundle["fct_recent_number_tracked_flights"],
                     bundle["fct_recent_published_date"]).first()
    assert kpi.recent_published_date.endswith("2001") and kpi.total_tracked_flights != "N/A"
    empty = f.stg.limit(0)
    from tarmac.operators import models
    none = views.kpis(models.fct_recent_number_tracked_flights(empty),
                      models.fct_recent_published_date(empty)).first()
    assert (none.recent_published_date, none.total_tracked_flights) == ("N/A", "N/A")
    trend = views.annual_trend(bundle["fct_delay_over_years"])
    assert dict(trend.dtypes)["year"] == "string"


def test_newest_build_counts_and_old_ones_go(spark):
    first = build_staging(spark, SF)
    second = build_staging(spark, SF, force=True)
    assert second != first and build_staging(spark, SF) == second
    third = build_staging(spark, SF, force=True)
    assert not files.exists(spark, first) and files.exists(spark, second)
    assert build_staging(spark, SF) == third


def test_changed_input_is_built_anew(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for name in _INPUTS:
        shutil.copy(f"{SF}/{name}.parquet", f"{scratch}/in/{name}.parquet")
    first = build_staging(spark, f"{scratch}/in")
    assert build_staging(spark, f"{scratch}/in") == first
    os.utime(f"{scratch}/in/lineitem.parquet", (1, 1))
    assert build_staging(spark, f"{scratch}/in") != first


def test_checkpoint_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master, folder = "spark://host:7077", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    Session.sparkContext.master = "local[4]"
    folder = ensure_checkpoint_dir(Session())
    assert folder and ensure_checkpoint_dir(Session()) == folder


def test_latest_period_reads_one_month_and_the_index(spark, q):
    """The subqueries scan the table of periods; the flights' own scan is one month."""
    df = q["fct_recent_airport_delays"](spark, SF)
    plan = _plan(df)
    # in the index year and month are columns; in the flights' table they are folders
    assert "ReadSchema: struct<year:int,month:int>" in plan and "ReadSchema: struct<year:int>" in plan
    assert "ReadSchema: struct<>" not in plan
    assert sum("PartitionFilters: [isnotnull(year" in line for line in set(plan.split("\n"))) >= 1
    path = build_staging(spark, SF)
    for name in ("stg", "sch"):
        table = spark.read.parquet(f"{path}/{name}")
        index = spark.read.parquet(periods_of(f"{path}/{name}"))
        assert sorted(map(tuple, index.collect())) == sorted(
            map(tuple, table.select("year", "month").distinct().collect()))
        assert len(index.inputFiles()) == 1


def test_checks_are_counted_while_the_tables_are_written(spark, q, scratch):
    f = staged_flights(spark, SF)
    want = {r.check_name: r.failing_rows for r in quality.dq_report(f.stg, f.sch).collect()}
    got = {r.check_name: r.failing_rows for r in quality.dq_report_of_build(f.checks, f.sch).collect()}
    assert got == want and len(got) == 13
    # the staging table is not read again, and of the other only the key
    plan = quality.dq_report_of_build(f.checks, f.sch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "ReadSchema: struct<unique_row_id:string>" in plan
    # bad rows are counted, once, in every month they are written to
    bad = dirty_staging(f.stg)
    seen = write_staging(bad, f"{scratch}/bad", quality.staging_checks())
    rows = bad.agg(*quality.staging_checks()).first().asDict()
    assert seen == rows and seen["non_negative_counts"] > 0 and seen["percent_bounds"] > 0
    assert write_staging(bad.limit(0), f"{scratch}/none", quality.staging_checks())["percent_bounds"] == 0
    assert write_staging(bad, f"{scratch}/plain") == {}


def _tables(root, spark):
    """Two nations of one name, one key with two names, and keys that repeat."""
    def put(name, ddl, rows):
        spark.createDataFrame(rows, ddl).write.parquet(f"{root}/{name}.parquet")

    put("region", "r_regionkey bigint, r_name string", [(0, "R0"), (1, None), (1, "R1")])
    put("nation", "n_nationkey bigint, n_name string, n_regionkey bigint",
        [(0, "A", 0), (1, "A", 0), (2, "B", 1), (2, "C", 0), (3, None, 1), (0, "A", 0)])
    put("customer", "c_custkey bigint, c_nationkey bigint", [(i, i % 4) for i in range(8)] + [(8, None)])
    put("supplier", "s_suppkey bigint, s_nationkey bigint", [(i, i % 4) for i in range(5)])
    put("part", "p_partkey bigint, p_brand string", [(i, ("X", "Y", None)[i % 3]) for i in range(6)])
    put("orders", "o_orderkey bigint, o_custkey bigint", [(i, i % 9) for i in range(40)])
    put("lineitem", "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_returnflag string, l_shipdate timestamp",
        [(i % 40, i % 6, i % 5, i % 7, float(i % 50), ("R", "A", "N", None)[i % 4],
          datetime.datetime(1996 + i % 3, 1 + i % 2, 3)) for i in range(600)])


def test_cells_are_those_of_the_names(spark, scratch):
    """Grouping by place numbers is grouping by the names of nation and region."""
    _tables(scratch, spark)
    for name in _INPUTS:
        spark.read.parquet(f"{scratch}/{name}.parquet").createOrReplaceTempView(f"t_{name}")
    want = spark.sql("""
        WITH f AS (SELECT year(l_shipdate) y, month(l_shipdate) m, a.n_name ap, r_name cty, c.n_name od,
            p_brand al, CASE WHEN l_returnflag = 'R' THEN 'C' ELSE 'S' END sc, l_returnflag rf,
            cast(l_quantity AS bigint) qty, l_orderkey ok, l_partkey pk,
            (l_orderkey * 7 + l_partkey * 13 + l_linenumber * 31 + l_suppkey * 3) % 480 - 30 delay
          FROM t_lineitem JOIN t_orders ON l_orderkey = o_orderkey JOIN t_customer ON o_custkey = c_custkey
          JOIN t_nation c ON c_nationkey = c.n_nationkey JOIN t_region ON c.n_regionkey = r_regionkey
          JOIN t_supplier ON l_suppkey = s_suppkey JOIN t_nation a ON s_nationkey = a.n_nationkey
          JOIN t_part ON l_partkey = p_partkey)
        SELECT y, m, ap, cty, od, al, sc, rf, max(y * 100 + m), sum(qty), sum(delay * qty), sum(pk), sum(ok), count(1),
          sum(CASE WHEN delay <= 15 THEN qty ELSE 0 END), sum(CASE WHEN delay BETWEEN 61 AND 180 THEN qty ELSE 0 END)
        FROM f GROUP BY ALL""")
    cells = flight_cells(spark, scratch).select(
        "y", "m", "ap", "cty", "od", "al", "sc", "rf", "ym", "sum_qty", "sum_delay_qty", "sum_pk", "sum_ok", "n_rows",
        "band_lo_15", "band_61_180")
    got = Counter(tuple(r) for r in cells.collect())
    assert len(got) > 100 and got == Counter(tuple(r) for r in want.collect())


def test_line_items_do_not_move_by_customer(spark):
    """Orders meet their customers first; cells are grouped by numbers, not names."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        plan = flight_cells(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [line for line in plan.splitlines() if "Join Inner, (o_custkey" in line]
    assert len(joins) == 1
    under = plan.splitlines()[plan.splitlines().index(joins[0]):]
    depth = len(re.match(r"[ :]*", joins[0])[0])
    below = [x for x in itertools.takewhile(lambda x: len(re.match(r"[ :]*", x)[0]) > depth, under[1:])]
    assert below and not any("l_orderkey" in x for x in below)
    keys = re.search(r"Aggregate \[([^\]]*)\]", plan)[1]
    assert "n_name" not in keys and "r_name" not in keys and len(keys.split(",")) == 6


def test_the_staging_key_is_not_shuffled(spark, scratch):
    """It is worked out again by the tasks that write, and is the same."""
    from tarmac.operators.staging import unique_row_id

    stg = staged_flights(spark, SF).stg
    write_staging(stg, f"{scratch}/t", derived={"unique_row_id": unique_row_id()})
    again = spark.read.parquet(f"{scratch}/t").select(stg.columns)
    assert again.exceptAll(stg).isEmpty() and stg.exceptAll(again).isEmpty()


def test_the_gate_runs_its_report_once(spark):
    f = staged_flights(spark, SF)
    plan = quality.dq_gate(quality.dq_report_of_build(f.checks, f.sch))._jdf.queryExecution().toString()
    assert "parquet" not in plan
