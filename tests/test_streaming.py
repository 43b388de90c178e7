"""Batch = stream, however the input is cut: replayed in event-time order, or as files in no time
order; late rows come out as such; a query goes on from its checkpoint when its tables have grown.
(S04 adds timer rows on top of the batch job.)"""

import datetime as dt
import tempfile
import time
import uuid

import pytest
from pyspark.sql import functions as F

from martlake.catalog import retail
from martlake.operators import validations as V
from martlake.plans import jobs
from martlake.session import checkpoint_dir
from martlake.sources import requests as rq
from martlake.sources.replay import TimeOrdered
from martlake.streaming import jobs as S

DELAY = "3650 days"


def _cut(df, n):
    """``df`` as ``n`` parquet files, rows dealt without regard to time."""
    d = tempfile.mkdtemp(prefix="martlake-stream-in-")
    df.repartition(n, F.xxhash64(*df.columns)).write.mode("append").parquet(d)
    return d


def _source(spark, df, time, cut):
    """``cut``: rows a file and files a micro-batch of an ordered replay, or a number of files."""
    if isinstance(cut, tuple):
        return TimeOrdered(spark, df, time, *cut)
    return S.Replay(spark, _cut(df, cut), df.schema, time, DELAY, max_files=max(1, cut // 5))


def _points(t):
    return {r.point_redemption_id: (None if r.code is None else str(r.code), r.balance_after) for r in V.points_ledger(t).collect()}


@pytest.mark.parametrize("cut", [(10**6, 8), (900, 3), 20])
def test_points_stream_equals_batch(spark, cut):
    sf = "/root/testdata/sf0.01"  # the smallest data set has no overdraft
    t = retail(spark, sf)
    src = _source(spark, spark.read.parquet(f"{sf}/events.parquet"), "ts", cut)
    out = S.run(S.points_ledger_stream(t, src.rows, src.delay), "s01", src)
    got = {r.point_redemption_id: (r.code, r.balance_after) for r in out.collect()}
    assert got == _points(t) and any(c == "-20023" for c, _ in got.values())


@pytest.mark.parametrize("cut", [(700, 2), 20])
def test_low_stock_stream_equals_batch(spark, small_dir, cut):
    t = retail(spark, small_dir)
    unknown = spark.createDataFrame([(10**12, 1, 5), (10**12 + 1, 10**9, 5), (1, 10**9, 2)], "order_id long, item_id long, quantity int")
    lines = t["order_item"].select("order_id", F.col("item_id").cast("long").alias("item_id"), F.col("quantity").cast("int").alias("quantity")).unionByName(unknown)
    t2 = {k: t[k] for k in ("orders", "item", "branch_stock")} | {"order_item": lines.withColumn("unit_price", F.lit(1).cast("decimal(8,2)"))}
    src = _source(spark, S.with_order(t, lines), "order_date", cut)
    out = S.run(S.low_stock_stream(t, src.rows, delay=src.delay), "s02", src)
    got = {(r.order_id, r.item_id): (r.code, r.stock_after, r.low_stock) for r in out.collect()}
    exp = {(r.order_id, r.item_id): (None if r.code is None else str(r.code), r.stock_after,
                                     r.code is None and r.stock_after is not None and r.stock_after < 20)
           for r in V.stock_ledger(t2).collect()}
    # a line of an unknown order comes out at once with the reference's code
    assert got == exp and got[10**12, 1][0] == "-20010" and got[1, 10**9][0] == "-20011"


@pytest.mark.parametrize("cut", [(50, 2), 20])
def test_dedupe_stream(spark, small_dir, cut):
    t = retail(spark, small_dir)
    red = t["redemption"]
    dup = red.limit(50).withColumn("redemption_id", F.col("redemption_id") + 10**9) \
             .withColumn("redeemed_date", F.col("redeemed_date") + F.expr("INTERVAL 1 HOUR"))
    allr = red.unionByName(dup)
    src = _source(spark, allr, "redeemed_date", cut)
    out = S.run(S.dedupe_redemptions_stream(t, src.rows, src.delay), "s03", src)
    bad = {int(r.row_key) for r in V.duplicate_redemption({"redemption": allr, "orders": t["orders"]}).collect()}
    exp = {r.redemption_id for r in allr.collect()} - bad
    assert {r.redemption_id for r in out.collect()} == exp and len(bad) == 50


@pytest.mark.parametrize("cut", [(100, 1), 20])
def test_pickup_stream_matches_batch(spark, small_dir, cut):
    t = retail(spark, small_dir)
    src = _source(spark, spark.read.parquet(f"{small_dir}/events.parquet").filter("event_type = 'signup'"), "ts", cut)
    rows = S.run(S.pickup_lifecycle_stream(t, rq.pickup_events_from(src.rows, small_dir), src.delay), "s04", src).collect()
    got = {r.req_id: r.code for r in rows if r.code != "TIMER"}
    exp = {r.req_id: r.code for r in jobs.apply_pickup_updates(t, rq.pickup_events(spark, small_dir))["decisions"].collect()}
    assert got == exp and "-20003" in got.values()


def test_pickup_timers_and_dates(spark):
    """Expiry between two events, at one, and at the end; dates in the past change nothing."""
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    t = {"orders": spark.createDataFrame([(k, "Self Pickup") for k in range(1, 5)], "order_id long, order_type string"),
         "self_pickup": spark.createDataFrame([(k, k, "Preparing") for k in range(1, 5)], "pickup_id long, order_id long, pickup_status string")}
    rows = [(1, at(1), 1, "Ready", None), (2, at(10), 1, "Completed", None),  # expired on the 4th
            (3, at(1), 2, "Ready", None), (4, at(4), 2, "Completed", None),  # on the last moment
            (5, at(2), 3, "Rescheduled", at(1)), (6, at(3), 3, "Rescheduled", at(20)),  # the past; beyond the end
            (7, at(5), 4, "Ready", None), (8, at(6), 4, "Shipped", None), (9, at(12), 4, "Preparing", None)]
    requests = spark.createDataFrame(rows, "req_id long, req_ts timestamp_ntz, order_id long, new_status string, reschedule_date timestamp_ntz")
    for cut in ((2, 1), (100, 1), 3):
        src = _source(spark, requests, "req_ts", cut)
        out = S.run(S.pickup_lifecycle_stream(t, src.rows, src.delay), "s04", src).collect()
        events = {r.req_id: (r.code, r.status_after) for r in out if r.req_id}
        assert events == {1: (None, "Ready"), 2: ("-20640", "Expired"), 3: (None, "Ready"), 4: (None, "Completed"), 5: ("-20003", "Preparing"),
                          6: (None, "Rescheduled"), 7: (None, "Ready"), 8: ("-20638", "Ready"), 9: (None, "Preparing")}
        assert sorted((r.order_id, r.req_ts) for r in out if r.code == "TIMER") == [(1, at(4)), (4, at(8))]


def test_late_rows_come_out(spark, tmp_path):
    """A row behind the watermark is returned with LATE and changes no balance; one without a time
    comes out too."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    at = lambda h: dt.datetime(2024, 1, 5, h)
    folder = str(tmp_path / "in")
    batches = [[(1, at(10), 7, "view", 50.0), (2, at(1), 7, "view", 10.0)], [(3, at(20), 7, "click", 55.0)],
               [(4, at(9), 7, "view", 30.0), (5, None, 7, "view", 5.0), (6, at(22), 8, "click", 1.0)]]
    t = {"member": spark.createDataFrame([(7, 0)], "member_id long, points_balance long")}
    base = str(tmp_path / "run")
    for k, batch in enumerate(batches + [[(None, dt.datetime(2024, 1, 9), None, None, None)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        rows = spark.readStream.schema(schema).parquet(folder)
        out = S.run(S.points_ledger_stream(t, rows, "1 hours"), "late", base=base) if k else None
    got = {r.point_redemption_id: (r.code, r.balance_after) for r in out.collect()}
    # 11 + 51 - 56 points; the late 31 don't count
    assert got == {10003: (None, 11), 10002: (None, 62), 10004: (None, 6), 10005: ("LATE", None), 10006: ("NO_TIME", None), 10007: ("-20022", None)}


def test_restart_with_grown_tables(spark, tmp_path):
    """A query stopped halfway, its member table grown by 2 %, goes on from its checkpoint and
    equals the batch result over everything."""
    sf = "/root/testdata/sf0.01"
    t = retail(spark, sf)
    events = spark.read.parquet(f"{sf}/events.parquet")
    half = events.agg(F.percentile_approx(F.col("ts"), 0.5)).first()[0]
    member = t["member"].select("member_id", "points_balance")
    new = F.pmod(F.xxhash64("member_id"), F.lit(50)) == 0
    paths = {k: str(tmp_path / k) for k in ("events", "member", "run")}
    early, late = events.filter(F.col("ts") <= F.lit(half)), events.filter(F.col("ts") > F.lit(half))
    # members that come later have no early events
    fresh = member.filter(new).select(F.col("member_id").alias("user_id"))
    early = early.join(fresh, "user_id", "left_anti").select(*events.columns)
    late = late.select(*events.columns)
    early.coalesce(2).write.parquet(paths["events"])
    member.filter(~new).coalesce(1).write.parquet(paths["member"])
    t2 = {"member": spark.readStream.schema(member.schema).parquet(paths["member"])}
    stream = spark.readStream.schema(events.schema).parquet(paths["events"])
    S.run(S.points_ledger_stream(t2, stream, "1 days"), "grow", base=paths["run"])
    member.filter(new).write.mode("append").parquet(paths["member"])
    late.coalesce(2).write.mode("append").parquet(paths["events"])
    S.run(S.points_ledger_stream(t2, stream, "1 days"), "grow", base=paths["run"])
    end = events.agg(F.max("ts")).first()[0] + dt.timedelta(days=2)
    spark.createDataFrame([tuple(end if f.name == "ts" else None for f in events.schema.fields)], events.schema).coalesce(1) \
        .write.mode("append").parquet(paths["events"])
    out = S.run(S.points_ledger_stream(t2, stream, "1 days"), "grow", base=paths["run"])
    got = {r.point_redemption_id: (r.code, r.balance_after) for r in out.collect()}
    every = early.unionByName(late)
    from martlake.sources import retail as R
    exp = _points({"member": t["member"], "point_history": R.point_history(lambda _: every)})
    assert got == exp and len(got) == every.count()


def test_ordered_replay_admits_by_time_and_goes_on(spark, small_dir):
    """Micro-batches hold ascending, separate ranges of event time and no more files than asked
    for; stopped halfway, the query goes on from its checkpoint."""
    events = spark.read.parquet(f"{small_dir}/events.parquet").orderBy(F.xxhash64("event_id"))
    src = TimeOrdered(spark, events, "ts", per_file=60, files=2)
    seen = []
    base = f"{checkpoint_dir(spark)}/admit-{uuid.uuid4().hex}"

    def note(df, _):
        seen.append(df.agg(F.min("ts"), F.max("ts"), F.count("event_id")).first())

    def start(s):
        return s.rows.writeStream.foreachBatch(note).option("checkpointLocation", base).start()

    q = start(src)
    while len(seen) < 3:
        time.sleep(0.05)
    q.stop()
    before = len(seen)
    again = TimeOrdered(spark, events, "ts", files=2, path=src.path)
    again.run(start(again))
    spans = {tuple(r) for r in seen if r[0] is not None}
    assert 3 <= before < len(seen) and sum(n for _, _, n in spans) == events.count()
    spans = sorted(spans)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and max(n for _, _, n in spans) < 400
    assert spans[-1][2] == 0  # the closing row


def test_no_input(spark, small_dir):
    t = retail(spark, small_dir)
    ev = spark.read.parquet(f"{small_dir}/events.parquet").limit(0)
    for cut in ((100, 2), 1):
        src = _source(spark, ev, "ts", cut)
        assert S.run(S.points_ledger_stream(t, src.rows, src.delay), "s01", src).count() == 0
