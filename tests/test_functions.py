"""Column helpers: exact money rounding, Oracle calendar rules, distributed ranking."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from martlake.functions.dates import add_months_oracle, ic_birth_date
from martlake.functions.money import round_ratio
from martlake.functions.ranking import global_rank, running_sum


def test_round_ratio_is_exact_half_up(spark):
    cases = [(14033, 3), (140325, 1000), (-5, 2), (5, 2), (1, 3), (0, 7), (99999995, 1000)]
    df = spark.createDataFrame(cases, "n long, d long")
    got = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"))).collect()]
    for (n, d), g in zip(cases, got):
        exp = (Decimal(n) / Decimal(d) / 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert g == exp, (n, d, g, exp)


def test_add_months_month_end():
    assert add_months_oracle(dt.date(2001, 2, 28), 1) == dt.date(2001, 3, 31)
    assert add_months_oracle(dt.date(2001, 8, 1), -24) == dt.date(1999, 8, 1)
    assert add_months_oracle(dt.date(2000, 1, 31), 1) == dt.date(2000, 2, 29)


def test_ic_birth_date_rr_century(spark):
    df = spark.createDataFrame([("500101-01-1234",), ("490101-01-1234",), ("990230-01-1234",), ("010520-01-1234",)], "ic string")
    got = [r[0] for r in df.select(ic_birth_date(F.col("ic"))).collect()]
    assert got == [dt.date(1950, 1, 1), dt.date(2049, 1, 1), None, dt.date(2001, 5, 20)]


def _random_frame(spark, n=3000, groups=5, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = 0 if rnd.random() < 0.4 else rnd.randint(1, groups)  # group 0 is hot
        rows.append((i, g, rnd.randint(0, 30), rnd.randint(-20, 20)))
    return spark.createDataFrame(rows, "id long, g int, score int, v long")


def test_global_rank_matches_window(spark):
    df = _random_frame(spark)
    order = [F.col("score").desc(), F.col("id")]
    got = global_rank(df, [F.col("score").desc()], name="r", kind="rank").select("id", "r")
    exp = df.select("id", F.rank().over(Window.orderBy(F.col("score").desc())).alias("r"))
    assert sorted(got.collect()) == sorted(exp.collect())
    got2 = global_rank(df, order, name="r", kind="row_number", partition_by=["g"]).select("id", "r")
    exp2 = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy(*order)).alias("r"))
    assert sorted(got2.collect()) == sorted(exp2.collect())


def test_running_sum_matches_window(spark):
    df = _random_frame(spark)
    got = running_sum(df, [F.col("id")], "v", "rs", partition_by=["g"]).select("id", "rs")
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("id", F.sum("v").over(w).alias("rs"))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_add_months_col_keeps_month_end(spark):
    from martlake.functions.dates import add_months_col
    df = spark.createDataFrame([(dt.date(2001, 2, 28),), (dt.date(2001, 1, 15),), (dt.date(2000, 1, 31),)], "d date")
    got = [r[0] for r in df.select(add_months_col(F.col("d"), 1)).collect()]
    assert got == [dt.date(2001, 3, 31), dt.date(2001, 2, 15), dt.date(2000, 2, 29)]


def test_explode_lines_and_deleted_lines(spark):
    from martlake.operators.validations import deleted_lines
    from martlake.plans.orders import explode_lines
    req = spark.createDataFrame([(1, [(7, 2), (8, 1)]), (2, [])],
                                "req_id long, lines array<struct<item_id:long,quantity:int>>")
    rows = sorted(tuple(r) for r in explode_lines(req).collect())
    assert rows == [(1, 0, 7, 2), (1, 1, 8, 1)]
    old = spark.createDataFrame([(1, 7, 2), (1, 8, 1)], "order_id long, item_id long, quantity int")
    new = spark.createDataFrame([(1, 7, 2)], "order_id long, item_id long, quantity int")
    assert [tuple(r) for r in deleted_lines(old, new).collect()] == [(1, 8, 1)]
