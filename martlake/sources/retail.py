"""Retail tables derived from the driver's TPC-H-like parquet.

``load_retail(spark, sf_dir)`` returns the 17 retail tables of the data model as lazy
DataFrames. Every table is a fixed expression over the source tables, so Catalyst prunes
columns and pushes filters down to the parquet scans of whatever an operator reads.

Scale notes
-----------
* ``order_item`` and ``procurement`` group ``lineitem`` by (order, part). The grouping runs
  before the join with ``part`` so that the big shuffle is keyed on (order, part) -- no hot
  key even if one part carries a third of all lines -- and the part join afterwards is
  skew-split by AQE or broadcast when part is small.
* ``branch_stock`` and ``promotion_details`` pair every part with some of the 25 nations.
  The pairing rule is rewritten as an equi-join on a derived key, with ``nation`` (25 rows
  by the TPC-H definition, independent of scale) broadcast.
"""

from __future__ import annotations

import datetime as _dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the data contract.
RETAIL_AS_OF = _dt.date(2001, 8, 1)
EVENTS_AS_OF = _dt.date(2024, 1, 31)

TABLES = (
    "branch", "member", "item", "supplier", "staff", "orders", "order_item", "procurement",
    "branch_stock", "promotion", "promotion_details", "voucher", "redemption",
    "delivery_company", "delivery", "self_pickup", "point_history",
)


def _src(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item_price_col():
    # item price as stored on the item row
    return F.expr("cast(cast(p_retailprice as decimal(8,2)) - 890 as decimal(8,2))")


def branch(src) -> DataFrame:
    return src("nation").select(
        (F.lit(1001) + F.col("n_nationkey")).alias("branch_id"),
        F.concat(F.lit("Mart "), F.col("n_name")).alias("branch_name"))


def member(src) -> DataFrame:
    return src("customer").select(
        F.col("c_custkey").alias("member_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.abs("c_acctbal").cast("decimal(10,0)").alias("points_balance"),
        F.date_add(F.lit(RETAIL_AS_OF), (F.col("c_custkey") % 120 - 30).cast("int")).alias("expiry_date"))


def item(src) -> DataFrame:
    return src("part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("item_name"),
        F.col("p_type").alias("category"),
        _item_price_col().alias("unit_price"))


def supplier(src) -> DataFrame:
    return src("supplier").select(F.col("s_suppkey").alias("supplier_id"),
                                  F.col("s_name").alias("supplier_name"))


def staff(src) -> DataFrame:
    return src("supplier").select((F.lit(4001) + F.col("s_suppkey")).alias("staff_id"),
                                  (F.lit(1001) + F.col("s_suppkey") % 25).alias("branch_id"))


def orders(src) -> DataFrame:
    o = src("orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 10 == 0), F.lit(None))
         .otherwise(F.col("o_custkey")).alias("member_id"),
        (F.lit(4001) + F.col("o_orderkey") % 100).alias("staff_id"),
        (F.lit(1001) + (F.col("o_orderkey") * 7 + F.col("o_custkey")) % 25).alias("branch_id"),
        F.col("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", "In Store")
         .when(F.col("o_orderstatus") == "O", "Delivery")
         .otherwise("Self Pickup").alias("order_type"))


def order_item(src) -> DataFrame:
    # One row per (order, part). The line price is price*(1-discount) rounded to cents;
    # the row keeps the lowest one. For a fixed price that is monotone in the discount, so
    # the smallest and largest discount of the group decide it exactly.
    lines = (src("lineitem")
             .select("l_orderkey", "l_partkey", "l_quantity",
                     F.col("l_discount").cast("decimal(3,2)").alias("d"))
             .groupBy("l_orderkey", "l_partkey")
             .agg(F.sum(F.floor((F.col("l_quantity") + 9) / 10).cast("int")).cast("int").alias("quantity"),
                  F.min("d").alias("d_lo"), F.max("d").alias("d_hi")))
    price = src("part").select("p_partkey", _item_price_col().alias("p"))
    j = lines.join(price, lines.l_partkey == price.p_partkey)
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("quantity"),
        F.least(F.round(F.col("p") * (1 - F.col("d_lo")), 2),
                F.round(F.col("p") * (1 - F.col("d_hi")), 2)).cast("decimal(8,2)").alias("unit_price"))


def procurement(src) -> DataFrame:
    # Returned lines are read as procurements of (order, part). Cost factor per supplier
    # is 0.55 + 0.01*(suppkey mod 10); the cheapest rounded cost of the group is kept
    # (monotone in the factor, so the extreme factors decide it).
    lines = (src("lineitem")
             .filter(F.col("l_returnflag") == "R")
             .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate",
                     F.expr("cast(0.55 + 0.01*(l_suppkey % 10) as decimal(3,2))").alias("f"))
             .groupBy("l_orderkey", "l_partkey")
             .agg(F.min("l_suppkey").alias("supplier_id"),
                  F.sum("l_quantity").cast("int").alias("quantity"),
                  F.min("f").alias("f_lo"), F.max("f").alias("f_hi"),
                  F.min("l_shipdate").alias("procurement_date")))
    price = src("part").select("p_partkey", F.expr("cast(p_retailprice as decimal(8,2)) - 890").alias("p"))
    j = lines.join(price, lines.l_partkey == price.p_partkey)
    return j.select(
        (F.col("l_orderkey") * 100000000 + F.col("l_partkey")).alias("procurement_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("supplier_id"),
        (F.lit(1001) + (F.col("l_orderkey") + F.col("l_partkey")) % 25).alias("branch_id"),
        F.col("quantity"),
        F.least(F.round(F.col("p") * F.col("f_lo"), 2),
                F.round(F.col("p") * F.col("f_hi"), 2)).cast("decimal(8,2)").alias("unit_cost"),
        F.col("procurement_date"))


def _parts(src) -> DataFrame:
    # a part becomes several rows, and the part keys are a small file: one task would read it
    # all and write all those rows
    part = src("part").select("p_partkey")
    return part.repartition(int(part.sparkSession.conf.get("spark.sql.shuffle.partitions")), "p_partkey")


def _nation_small(src) -> DataFrame:
    # nation has 25 rows at every scale factor (TPC-H definition): a proven size bound.
    return F.broadcast(src("nation").select("n_nationkey", "n_name"))


def branch_stock(src) -> DataFrame:
    # (part + nation) mod 3 == 0  <=>  nation mod 3 == (3 - part mod 3) mod 3
    part = _parts(src).withColumn("k3", (3 - F.col("p_partkey") % 3) % 3)
    nat = _nation_small(src).withColumn("k3", (F.col("n_nationkey") % 3).cast("long"))
    j = part.join(nat, "k3")
    return j.select(
        (F.lit(1001) + F.col("n_nationkey")).alias("branch_id"),
        F.col("p_partkey").alias("item_id"),
        ((F.col("p_partkey") * 7 + F.col("n_nationkey") * 13) % 120).cast("int").alias("stock_quantity"),
        F.date_sub(F.lit(RETAIL_AS_OF), (F.col("p_partkey") % 90).cast("int")).alias("last_restock_date"))


def promotion(src) -> DataFrame:
    n = src("nation")
    return n.select(
        (F.lit(5001) + F.col("n_nationkey")).alias("promotion_id"),
        F.concat(F.lit("Promo "), F.col("n_name")).alias("promotion_name"),
        F.lit("Active").alias("status"),
        F.date_add(F.lit(_dt.date(2001, 1, 1)), (F.col("n_nationkey") * 9).cast("int")).alias("start_date"),
        F.date_add(F.lit(_dt.date(2001, 1, 1)), (F.col("n_nationkey") * 9 + 30).cast("int")).alias("end_date"))


def promotion_details(src) -> DataFrame:
    # part mod 25 == nation, or part mod 25 == (nation+1) mod 25: two disjoint equi-joins.
    part = _parts(src).withColumn("k", (F.col("p_partkey") % 25).cast("long"))
    nat = _nation_small(src)
    a = part.join(nat.withColumn("k", F.col("n_nationkey").cast("long")), "k")
    b = part.join(nat.withColumn("k", ((F.col("n_nationkey") + 1) % 25).cast("long")), "k")
    pairs = a.unionByName(b)
    even = F.col("p_partkey") % 2 == 0
    return pairs.select(
        (F.lit(5001) + F.col("n_nationkey")).alias("promotion_id"),
        F.col("p_partkey").alias("item_id"),
        F.when(even, "Percentage").otherwise("Amount").alias("discount_type"),
        F.when(even, F.lit(10) + F.col("n_nationkey")).otherwise(F.lit(1) + F.col("n_nationkey") % 5)
         .cast("decimal(8,2)").alias("discount_value"))


def voucher(src) -> DataFrame:
    n = src("nation")
    return n.select(
        F.concat(F.lit("V"), (F.lit(100) + F.col("n_nationkey")).cast("string")).alias("voucher_id"),
        F.when(F.col("n_nationkey") % 2 == 0, "Percentage").otherwise("Amount").alias("voucher_type"),
        (F.lit(5) + F.col("n_nationkey")).cast("decimal(8,2)").alias("voucher_value"),
        F.date_add(F.lit(_dt.date(2001, 1, 1)), (F.col("n_nationkey") * 20).cast("int")).alias("exp_date"))


def redemption(src) -> DataFrame:
    o = src("orders").filter(F.col("o_orderkey") % 5 == 1)
    return o.select(
        (F.lit(30001) + F.col("o_orderkey")).alias("redemption_id"),
        F.concat(F.lit("V"), (F.lit(100) + (F.col("o_orderkey") * 3 + F.col("o_custkey")) % 25).cast("string")).alias("voucher_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("redeemed_date"))


def delivery_company(src) -> DataFrame:
    return src("region").select((F.lit(2001) + F.col("r_regionkey")).alias("company_id"),
                                F.concat(F.lit("Courier "), F.col("r_name")).alias("company_name"))


def delivery(src) -> DataFrame:
    o = src("orders").filter(F.col("o_orderstatus") == "O")
    r = (F.col("o_orderkey") * 3 + F.col("o_custkey")) % 20
    return o.select(
        (F.lit(50001) + F.col("o_orderkey")).alias("delivery_id"),
        F.col("o_orderkey").alias("order_id"),
        (F.lit(2001) + (F.col("o_orderkey") + F.col("o_custkey")) % 5).alias("company_id"),
        F.when(r < 14, "Delivered").when(r < 16, "Out for Delivery").when(r < 17, "Pending")
         .when(r < 19, "Preparing").otherwise("Cancelled").alias("delivery_status"))


def self_pickup(src) -> DataFrame:
    o = src("orders").filter(F.col("o_orderstatus") == "P")
    return o.select(
        (F.lit(40001) + F.col("o_orderkey")).alias("pickup_id"),
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 4 == 0, "Ready").otherwise("Completed").alias("pickup_status"))


def point_history(src) -> DataFrame:
    e = src("events")
    return e.select(
        (F.lit(10001) + F.col("event_id")).alias("point_redemption_id"),
        F.col("user_id").alias("member_id"),
        (F.floor("value").cast("int") + 1).alias("amount"),
        F.when(F.col("event_type").isin("click", "error"), "Used").otherwise("Earned").alias("transaction_type"),
        F.col("ts").alias("redemption_date"))


_BUILDERS = {
    "branch": branch, "member": member, "item": item, "supplier": supplier, "staff": staff,
    "orders": orders, "order_item": order_item, "procurement": procurement,
    "branch_stock": branch_stock, "promotion": promotion, "promotion_details": promotion_details,
    "voucher": voucher, "redemption": redemption, "delivery_company": delivery_company,
    "delivery": delivery, "self_pickup": self_pickup, "point_history": point_history,
}


#: one row for each nation or region, whose number TPC-H fixes
_BOUNDED = ("branch", "promotion", "voucher", "delivery_company")


class Retail(dict):
    """Dict of retail DataFrames; tables are built lazily on first access."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark = spark
        self.sf_dir = sf_dir
        self.snapshot_dir = None  # set when the tables were written as a parquet snapshot

    def available(self) -> list[str]:
        """Table names this object can serve (all of them when backed by a source folder)."""
        return list(TABLES) if self.sf_dir else [n for n in TABLES if n in self]

    def derived(self, name: str) -> DataFrame:
        """The table unstored: enough for a look at its columns."""
        return self[name]

    def __missing__(self, name: str) -> DataFrame:
        if name not in _BUILDERS:
            raise KeyError(name)
        df = _BUILDERS[name](lambda n: _src(self.spark, self.sf_dir, n))
        if name in _BOUNDED:
            df = F.broadcast(df)
        self[name] = df
        return df


def load_retail(spark: SparkSession, sf_dir: str) -> Retail:
    return Retail(spark, sf_dir)


def from_frames(spark: SparkSession, frames: dict) -> Retail:
    """Wrap already-built retail DataFrames (fixtures, materialised snapshots)."""
    r = Retail(spark, "")
    r.update(frames)
    return r


class Snapshot(Retail):
    """Retail tables stored as Parquet under a folder: a table is derived and written when it is
    first named, so a query that reads one table doesn't wait for the other sixteen.

    Tables that operators cut by date or by item are written clustered by it, so repeated
    operator runs read pruned, pre-derived data instead of re-deriving it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, out_dir: str):
        super().__init__(spark, sf_dir)
        self.snapshot_dir = out_dir
        self._lazy = Retail(spark, sf_dir)
        self._writing = threading.RLock()

    def derived(self, name: str) -> DataFrame:
        return self._lazy[name]

    def __missing__(self, name: str) -> DataFrame:
        with self._writing:
            if name not in self:
                df = self.derived(name)
                if name in _CLUSTER:
                    # range-clustered files: min/max statistics then prune date and key ranges
                    df = df.repartitionByRange(*_CLUSTER[name]).sortWithinPartitions(*_CLUSTER[name])
                df.write.mode("overwrite").parquet(f"{self.snapshot_dir}/{name}")
                df = self.spark.read.parquet(f"{self.snapshot_dir}/{name}")
                self[name] = F.broadcast(df) if name in _BOUNDED else df
            return self[name]


def materialize(t: Retail, out_dir: str) -> Snapshot:
    """The tables of ``t``'s source folder as a snapshot under ``out_dir``."""
    return Snapshot(t.spark, t.sf_dir, out_dir)


# Write-time clustering: by date where operators cut date ranges, by item where they look one up.
# Each ends with the row key, so one hot date or item is still split over several range
# partitions (equal range keys would otherwise all land in one). ``order_item`` and
# ``procurement`` stay as their join with ``part`` leaves them: no operator cuts a range of
# orders, and dealing all lines out once more takes as long as deriving them.
_CLUSTER = {"orders": ["order_date", "order_id"], "point_history": ["redemption_date", "point_redemption_id"],
            "branch_stock": ["item_id", "branch_id"], "promotion_details": ["item_id", "promotion_id"]}
