"""Request tables for the batch jobs, derived from the ``events`` table.

Every request carries ``req_id`` and ``req_ts``; jobs order requests by (req_ts, req_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: a multiplier without common factors with any key range in use, and how many numbers
#: beyond the last key (unknown ones) requests may name
_SPREAD, _BEYOND = 7919, 50


def _key(spark: SparkSession, sf_dir: str, table: str, column: str, salt: Column | None = None) -> Column:
    """A key for each event over the whole range of the table's keys, some beyond it; every
    third event takes one of the twenty lowest keys, so that some keys are in demand."""
    last = spark.read.parquet(f"{sf_dir}/{table}.parquet").agg(F.max(column)).first()[0] or 0
    n = F.col("event_id") if salt is None else salt
    return F.when(n % 3 == 0, n % 20).otherwise(n * _SPREAD % (last + _BEYOND)).cast("long")


def _item(spark: SparkSession, sf_dir: str, salt: Column | None = None) -> Column:
    return _key(spark, sf_dir, "part", "p_partkey", salt)


def _order(spark: SparkSession, sf_dir: str) -> Column:
    return _key(spark, sf_dir, "orders", "o_orderkey")


def _events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").filter(F.col("event_type") == kind)


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, "click")
    return e.select(
        F.col("event_id").alias("req_id"), F.col("ts").alias("req_ts"),
        (F.lit(1001) + F.col("user_id") % 25).alias("from_branch"),
        (F.lit(1001) + (F.col("user_id") + F.col("event_id")) % 25).alias("to_branch"),
        _item(spark, sf_dir).alias("item_id"),
        (F.floor("value").cast("int") % 40).alias("quantity"))


def price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, "view")
    return e.select(
        F.col("event_id").alias("req_id"), F.col("ts").alias("req_ts"),
        _item(spark, sf_dir).alias("item_id"),
        (F.col("value").cast("decimal(8,2)") - 20).cast("decimal(8,2)").alias("new_price"))


def redemptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, "purchase")
    return e.select(
        F.col("event_id").alias("req_id"), F.col("ts").alias("req_ts"),
        F.concat(F.lit("V"), (F.lit(95) + F.col("event_id") % 32).cast("string")).alias("voucher_id"),
        _order(spark, sf_dir).alias("order_id"),
        F.col("user_id").alias("member_id"))


def pickup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pickup_events_from(spark.read.parquet(f"{sf_dir}/events.parquet"), sf_dir)


def pickup_events_from(events: DataFrame, sf_dir: str) -> DataFrame:
    """Pickup status requests from an events frame (batch or stream, whose closing row has
    a time only). Of five Rescheduled events one names no date, one the day before, the others
    one up to six days on."""
    e = events.filter((F.col("event_type") == "signup") | F.col("event_id").isNull())
    k = F.col("event_id") % 6
    return e.select(
        F.col("event_id").alias("req_id"), F.col("ts").alias("req_ts"),
        _order(events.sparkSession, sf_dir).alias("order_id"),
        F.when(k == 0, "Preparing").when(k == 1, "Ready").when(k == 2, "Completed")
         .when(k == 3, "Expired").when(k == 4, "Rescheduled").otherwise("Shipped").alias("new_status"),
        F.when((k == 4) & (F.col("event_id") % 5 == 1), F.expr("ts - INTERVAL 1 DAY"))
         .when((k == 4) & (F.col("event_id") % 5 > 1), F.expr("ts + make_dt_interval(cast(event_id % 7 as int))")).alias("reschedule_date"))


def receipts_from_procurement(t) -> DataFrame:
    """Procurement rows read as receipt requests for the stock-receiving job."""
    return t["procurement"].select(
        F.col("procurement_id").alias("req_id"), F.col("procurement_date").alias("req_ts"),
        "branch_id", "item_id", "supplier_id", "quantity", "unit_cost")


def delivery_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery create / status-update requests from the ``error`` events.

    Every fourth event creates a delivery (a new id below zero) for an order; the others
    update delivery 50001 + order, which exists for open orders.
    Couriers 2001-2007 (2006 and 2007 unknown), every seventh address missing, and the status
    cycles through the five known values and one unknown.
    """
    e = _events(spark, sf_dir, "error")
    create, order = F.col("event_id") % 4 == 0, _order(spark, sf_dir)
    k = F.col("event_id") % 6
    return e.select(
        F.col("event_id").alias("req_id"), F.col("ts").alias("req_ts"),
        F.when(create, "create").otherwise("update").alias("action"),
        F.when(create, -1 - F.col("event_id")).otherwise(F.lit(50001) + order).alias("delivery_id"),
        order.alias("order_id"),
        (F.lit(2001) + F.col("event_id") % 7).alias("company_id"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Addr "), F.col("user_id").cast("string"))).alias("address"),
        F.when(k == 0, "Delivered").when(k == 1, "Out for Delivery").when(k == 2, "Pending").when(k == 3, "Preparing")
         .when(k == 4, "Cancelled").otherwise("Lost").alias("status"))


def promotion_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Promotion creation requests from the ``view`` events: (headers, detail lines).

    Header: promotion id 7000000 + event, name empty for every ninth event, dates from the
    event day to 5 days before .. 34 days after it (some reversed). Each request has
    event mod 5 detail lines (0 = none), the item by event + 13 (pos mod 3), so the
    fourth line repeats the first item; type and value cycle through valid and invalid ones.
    """
    e = _events(spark, sf_dir, "view")
    day = F.to_date("ts")
    headers = e.select(
        F.col("event_id").alias("req_id"), F.col("ts").alias("req_ts"),
        (F.lit(7000000) + F.col("event_id")).alias("promotion_id"),
        F.when(F.col("event_id") % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("Promo "), F.col("user_id").cast("string")))
         .alias("name"),
        F.lit(None).cast("string").alias("description"),
        day.alias("start_date"), F.date_add(day, (F.col("event_id") % 40 - 5).cast("int")).alias("end_date"))
    pos = F.explode(F.sequence(F.lit(0), (F.col("event_id") % 5 - 1).cast("int")))
    lines = (e.filter(F.col("event_id") % 5 > 0).select("event_id", pos.alias("pos"))
             .select(F.col("event_id").alias("req_id"), "pos",
                     _item(spark, sf_dir, F.col("event_id") + (F.col("pos") % 3) * 13).alias("item_id"),
                     F.when((F.col("event_id") + F.col("pos")) % 7 == 0, "Bogus")
                      .when((F.col("event_id") + F.col("pos")) % 7 < 4, "Percentage").otherwise("Amount").alias("discount_type"),
                     (((F.col("event_id") + F.col("pos") * 17) % 130) - 10).cast("decimal(8,2)").alias("discount_value")))
    return headers, lines


def member_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member registration requests from the ``signup`` events.

    Birth date from the user (1950-01-01 + 3701 user mod 25000 days; every eleventh event a
    date in 2030), so repeated sign-ups of one user repeat the IC; IC = YYMMDD-NN-NNNN from
    the birth date and user (every 13th event a day off, every 19th not a date); e-mail
    of an existing customer for every fifth event, none
    for every seventeenth, else a new address.
    """
    e = _events(spark, sf_dir, "signup")
    dob = F.when(F.col("event_id") % 11 == 0, F.lit("2030-01-01").cast("date")).otherwise(
        F.date_add(F.lit("1950-01-01").cast("date"), ((F.col("user_id") * 3701) % 25000).cast("int")))
    ic_day = (F.when(F.col("event_id") % 19 == 0, F.lit("991340"))
               .when(F.col("event_id") % 13 == 0, F.date_format(F.date_add(dob, 1), "yyMMdd"))
               .otherwise(F.date_format(dob, "yyMMdd")))
    ic = F.concat(ic_day, F.lit("-"), F.lpad((F.col("user_id") % 100).cast("string"), 2, "0"),
                  F.lit("-"), F.lpad((F.col("user_id") % 10000).cast("string"), 4, "0"))
    email = (F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("string"))
              .when(F.col("event_id") % 5 == 0,
                    F.concat(F.lit("customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"), F.lit("@example.com")))
              .otherwise(F.concat(F.lit("new"), F.col("event_id").cast("string"), F.lit("@example.com"))))
    return e.select(F.col("event_id").alias("req_id"), F.col("ts").alias("req_ts"),
                    F.concat(F.lit("New member "), F.col("user_id").cast("string")).alias("name"),
                    ic.alias("ic"), email.alias("email"), dob.alias("date_of_birth"),
                    F.lit(None).cast("string").alias("address"))
