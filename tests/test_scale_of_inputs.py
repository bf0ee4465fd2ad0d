"""Input views are dealt out while their rows are narrow."""

from visitlens.session import scratch_path
from visitlens.sources.tables import TestdataTables


def made_events(spark, n=3000):
    """A test-data folder of its own, with one row group for each table."""
    sf = scratch_path(spark, "made-sf")
    spark.range(n).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id % 30), 0, 0, id) as ts",
        "id % 97 as user_id", "element_at(array('view', 'click', 'error', 'purchase'), int(id % 4) + 1) as event_type",
        "double(id) as value", "concat('{\"k\": ', id % 100, '}') as props").coalesce(1).write.parquet(f"{sf}/events.parquet")
    spark.range(n).selectExpr(
        "id as o_orderkey", "id as o_custkey", "element_at(array('F', 'O', 'P'), int(id % 3) + 1) as o_orderstatus",
        "double(id) as o_totalprice", "timestamp_ntz'2024-01-01 00:00:00' as o_orderdate", "'5-LOW' as o_orderpriority") \
        .coalesce(1).write.parquet(f"{sf}/orders.parquet")
    return sf


def exchanged_widths(df):
    """Columns of each exchange of a plan."""
    out, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        p = todo.pop()
        if p.nodeName().startswith(("Repartition", "Aggregate")):
            out.append(p.child().output().size())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return out


def test_views_are_dealt_out_before_they_are_wide(spark):
    sf = made_events(spark)
    t = TestdataTables(spark, sf)
    for name in ("web", "visits", "profit_loss", "visit_events"):
        df = t._derive(name, 4)
        assert max(exchanged_widths(df), default=0) <= 10, name
        stored, want = t[name], TestdataTables(spark, sf, store=())[name]
        assert stored.count() == want.count() > 0
        assert stored.exceptAll(want).count() == 0 and want.exceptAll(stored).count() == 0
    assert len(t["web"].inputFiles()) > 1 and len(t["visits"].columns) > 80
