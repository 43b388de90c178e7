"""What a job of many steps leaves on disk while it runs: no shuffles of finished statements, no steps
that nothing reads any more."""

import os
import re

from martlake import catalog
from martlake.functions.ranking import running_sum
from martlake.plans.orders import place_orders, replay_orders
from martlake.session import checkpoint_dir, drop, release_shuffles, stored
from martlake.sources.retail import RETAIL_AS_OF


def _shuffles(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if re.match(r"shuffle_.*\.data", n)}


def _steps(spark) -> set[str]:
    return {d for d in os.listdir(re.sub(r"^file:/+", "/", checkpoint_dir(spark))) if d.startswith("step-")}


def test_shuffles_go_with_their_statement(spark, small_dir):
    catalog.retail(spark, small_dir)
    before = _shuffles(spark)
    df = catalog.queries()["supplier_item_sales_monthly"](spark, small_dir)
    rows = sorted(map(tuple, df.collect()))
    assert _shuffles(spark) <= before
    assert rows and sorted(map(tuple, df.collect())) == rows  # a plan may run once more


def test_orders_keep_only_the_steps_that_outputs_read(spark, small_dir):
    from pyspark.sql import functions as F
    t = catalog.retail(spark, small_dir)
    for name in ("orders", "order_item", "redemption", "member", "branch_stock", "voucher"):
        t[name]
    shuffles, steps = _shuffles(spark), _steps(spark)
    headers, lines = replay_orders(t)
    out = place_orders(t, headers, lines.withColumn("quantity", F.col("quantity") * 9), RETAIL_AS_OF)
    assert len(out["rounds"]) > 1 and _shuffles(spark) <= shuffles
    # the judged headers, the codes, and what each round decided
    assert len(_steps(spark) - steps) == 2 + len(out["rounds"])
    rows = out["decisions"].groupBy("code").count().collect()
    assert {r.code for r in rows} >= {None, "-20001", "-20002"}


def test_a_running_sum_names_what_it_stores(spark):
    release_shuffles(spark)
    df = spark.range(500).selectExpr("id % 3 AS k", "id", "id % 7 AS v")
    steps, before = [], _steps(spark)
    kept = stored(running_sum(df, ["id"], "v", "s", ["k"], steps=steps))
    assert len(_steps(spark) - before) == 2
    drop(*steps)
    assert len(_steps(spark) - before) == 1
    got, total = {r.id: r.s for r in kept.collect()}, [0, 0, 0]
    for i in range(500):
        total[i % 3] += i % 7
        assert got[i] == total[i % 3]


def test_the_sales_view_is_not_dealt_out(spark, small_dir):
    """Names are joined to the repeat counts; the last join makes the view's rows."""
    plan = catalog.queries()["supplier_item_sales_monthly"](spark, small_dir)._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"Join \[(\w+?)#", plan).group(1) == "item_id"
