"""Sides of a join are broadcast by measured sizes, and one small file doesn't become one task."""

import pytest

from martlake import catalog, session
from martlake.sources.retail import from_frames, load_retail


@pytest.mark.parametrize("name, bounded", [
    ("branch_stock_status", 0), ("branch_stock_listing", 1), ("low_stock_alerts", 0), ("stock_ledger_violations", 0)])
def test_no_join_trusts_a_file_size(spark, small_dir, name, bounded):
    """The files here are all far below the threshold; only ``branch`` is broadcast for sure."""
    plan = catalog.queries()[name](spark, small_dir)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == bounded and "BroadcastNestedLoopJoin" not in plan


def test_measured_sides_are_still_broadcast(spark, small_dir):
    df = catalog.queries()["branch_stock_status"](spark, small_dir)
    df.collect()
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("came, left", [("64MB", 2 << 20), ("10485760b", 2 << 20), ("256k", 256 << 10), ("-1", None)])
def test_a_session_cannot_send_large_sides_through_the_driver(spark, came, left):
    s = spark.newSession()
    s.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", came)
    session.measure_joins(s)
    session.measure_joins(s)
    held = s.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    assert s.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert held is None if left is None else session._bytes(held) == left


def test_parts_are_dealt_out_before_they_multiply(spark, small_dir):
    t = load_retail(spark, small_dir)
    for name in ("branch_stock", "promotion_details"):
        assert t[name].rdd.getNumPartitions() >= 8


def test_listing_keeps_every_branch(spark):
    from martlake.operators.inventory import branch_stock_listing
    t = from_frames(spark, {
        "branch": spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "branch_id long, branch_name string"),
        "item": spark.createDataFrame([(7, "i", "k", 1)], "item_id long, item_name string, category string, unit_price int"),
        "branch_stock": spark.createDataFrame([(1, 7, 5), (2, 8, 6), (4, 7, 9)], "branch_id long, item_id long, stock_quantity int")})
    none = (None,) * 5
    assert sorted(map(tuple, branch_stock_listing(t).collect()), key=str) == [
        (1, "a", "OK", 7, "i", "k", 1, 5), (2, "b", "NO STOCK", *none), (3, "c", "NO STOCK", *none)]
    assert [tuple(r) for r in branch_stock_listing(t, 9).collect()] == [(9, None, "UNKNOWN BRANCH", *none)]


@pytest.mark.parametrize("name", ["pickup_lifecycle_stream", "dedupe_redemptions_stream"])
def test_a_micro_batch_reads_no_whole_table(spark, small_dir, name, monkeypatch):
    """What the streams look up in other tables is staged with their rows."""
    from martlake.streaming import jobs
    plans = []
    monkeypatch.setattr(jobs, "run", lambda df, *a: plans.append(df._jdf.queryExecution().logical().toString()))
    catalog.queries()[name](spark, small_dir)
    assert "Join" not in plans[0] and "StreamingRelation" in plans[0]
