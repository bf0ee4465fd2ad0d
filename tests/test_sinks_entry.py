"""K1 partitioned overwrite and the driver entry points."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from visitlens.session import scratch_path
from visitlens.sinks import read_partitioned, write_partitioned


def test_dynamic_partition_overwrite_keeps_untouched_dates(spark):
    path = scratch_path(spark, "k1-test")
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    first = spark.createDataFrame([(1, "a", d1), (2, "b", d2)], "id long, v string, day date")
    second = spark.createDataFrame([(3, "c", d2), (4, "d", d3)], "id long, v string, day date")
    write_partitioned(first, path, by="day", cluster=True)
    write_partitioned(second, path, by="day", cluster=True)
    back = read_partitioned(spark, path)
    assert sorted((r.id, r.v, r.day) for r in back.collect()) == [
        (1, "a", d1), (3, "c", d2), (4, "d", d3)]


def test_entry_and_registry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["date_est", "visit_id", "url", "site"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 27
    assert df.schema == E.entry(spark).schema   # stable schema
    assert df.where(F.col("first_action_date_est").isNull()).count() == 0


def test_daily_chain(spark):
    from visitlens.plans import registry as R
    from visitlens.plans.jobs import run_daily
    from visitlens.sources import TestdataTables

    sf = "/root/testdata/sf0.001"
    t = TestdataTables(spark, sf)
    vp, sp = scratch_path(spark, "daily-vm"), scratch_path(spark, "daily-sm")
    run_daily(t, R.visit_cfg(), R.sku_cfg(), vp, sp)
    sku, want = spark.read.parquet(sp), R.q_daily_chain(spark, sf)
    assert sku.count() > 0
    assert sku.exceptAll(want).count() == 0 and want.exceptAll(sku).count() == 0
    assert read_partitioned(spark, vp).count() == R.q_visit_mart(spark, sf).count()


def test_partitioned_write_runs_its_plan_once(spark):
    """Rows that the plan makes are counted: one pass, no pass to sample ranges."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).selectExpr("id", "date_add(date'2024-01-01', int(id % 3)) as day")
    write_partitioned(df.mapInArrow(counted, df.schema), scratch_path(spark, "once"), by="day",
                      cluster=True)
    assert seen.value == 1000


def test_job_cli_visit_mart(spark):
    """The command line runs the visit job against catalog names."""
    from visitlens.plans import jobs
    from visitlens.plans import registry as R
    from visitlens.sources import TestdataTables

    sf = "/root/testdata/sf0.001"
    t = TestdataTables(spark, sf)
    names = ["visit_events", "visit_actions", "visits", "carts", "goals", "order_items",
             "visit_orders", "profit_loss"]
    for n in names:
        t[n].createOrReplaceTempView(f"cli_{n}")
    out = scratch_path(spark, "cli-visit-mart")
    jobs.main(["visit-mart", "--as-of", "2024-01-31", "--days", "14", "--out", out,
               "--site-host", "www.shop.example", "--site-cutover", "2023-06-30",
               *[a for n in names for a in ("--table", f"{n}=cli_{n}")]])
    back = read_partitioned(spark, out)
    assert back.count() == R.q_visit_mart(spark, sf).count()
    assert {r.site for r in back.select("site").distinct().collect()} >= {"NextGen", "Legacy"}
    with pytest.raises(SystemExit, match="--site-host"):
        jobs.main(["visit-mart", "--as-of", "2024-01-31", "--out", out])


def test_parquet_tables_registry(spark):
    from visitlens.sources import ParquetTables, TestdataTables

    t = TestdataTables(spark, "/root/testdata/sf0.001", store=())
    path = scratch_path(spark, "pq-goals")
    t["goals"].write.parquet(path)
    p = ParquetTables(spark, {"goals": path})
    assert p["goals"] is p["goals"]                       # memoised per name
    assert p["goals"].count() == t["goals"].count()
    assert p.with_table("goals", t["goals"])["goals"] is t["goals"]


def test_columns_added_and_dropped_between_runs_are_kept(spark):
    path = scratch_path(spark, "k1-grows")
    d = [dt.date(2024, 1, i) for i in range(1, 5)]
    write_partitioned(spark.createDataFrame([(1, d[0])], "id long, day date"), path, by="day")
    write_partitioned(spark.createDataFrame([(2, "x", d[1])], "id long, v string, day date"), path, by="day")
    write_partitioned(spark.createDataFrame([("y", d[2])], "v string, day date"), path, by="day")
    back = read_partitioned(spark, path)
    assert back.columns == ["id", "v", "day"]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [(1, None, d[0]), (2, "x", d[1]), (None, "y", d[2])], key=str)
    with pytest.raises(ValueError, match="column id is bigint"):
        write_partitioned(spark.createDataFrame([("s", d[3])], "id string, day date"), path, by="day")
    assert read_partitioned(spark, path).count() == 3      # nothing was written


def test_a_filter_on_the_sorted_column_skips_row_groups(spark):
    """The chain's filter is on a column that is not the partition column."""
    path = scratch_path(spark, "k1-sorted")
    df = spark.range(200_000).selectExpr(
        "id", "date_add(date'2024-01-01', int(id % 97)) as date_est", "date'2024-01-01' as day")
    with_small_groups = spark.sparkContext._jsc.hadoopConfiguration()
    with_small_groups.set("parquet.block.size", str(64 * 1024))
    try:
        write_partitioned(df, path, by="day", cluster=True, sort=("date_est",))
    finally:
        with_small_groups.unset("parquet.block.size")
    late = read_partitioned(spark, path).where("date_est >= date'2024-04-01'")
    assert late.count() > 0
    rows = late._jdf.queryExecution()
    late._jdf.queryExecution().toRdd().count()
    scan = rows.executedPlan().collectLeaves().apply(0)
    read = scan.metrics().apply("numOutputRows").value()
    assert 0 < read < 60_000       # of 200,000


def test_job_reads_paths_and_stores_visits(spark):
    from visitlens.plans import jobs
    from visitlens.plans import registry as R
    from visitlens.sources import TestdataTables

    sf = "/root/testdata/sf0.001"
    t, paths = TestdataTables(spark, sf), []
    for n in ("visit_events", "visit_actions", "visits", "carts", "goals", "order_items",
              "visit_orders", "profit_loss"):
        t[n].write.parquet(path := scratch_path(spark, f"path-{n}"))
        paths += ["--path", f"{n}={path}"]
    out, table = scratch_path(spark, "path-mart"), "visits_stored_for_test"
    jobs.main(["visit-mart", "--as-of", "2024-01-31", "--days", "14", "--out", out,
               "--site-host", "www.shop.example", "--site-cutover", "2023-06-30",
               "--visit-buckets", "4", "--visits-table", table, *paths])
    try:
        assert read_partitioned(spark, out).count() == R.q_visit_mart(spark, sf).count()
    finally:
        spark.sql(f"DROP TABLE {table}")
