"""Structured Streaming versions of four row triggers.

Each stream shares its rule code with the batch form: the static checks are the same column
expressions, and the order-dependent part is the fold's step, run by ``ordered.Ordered`` on the
state store (``transformWithState``): rows wait until the watermark (latest event time minus
``delay``) has passed them and are then applied in (event time, id) order, so the result doesn't
depend on how the input is cut into files or micro-batches, as long as no row is more than
``delay`` behind the newest one. Rows later than that come out with code LATE.

Opening balances and stock are streams too (``table_stream``): every row of those tables enters
the state once, when it appears, and micro-batches touch only the entries of their own rows. A
table that grows while a query is stopped is read on from where the query was.

``run(df, name, source)`` runs a stream to the end of a replay (``sources.replay``), or over the
files that are there, into a parquet table under the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.plans.jobs import PICKUP_STATUSES
from martlake.session import checkpoint_dir
from martlake.sources import retail as R
from martlake.sources.replay import TimeOrdered
from martlake.streaming.ordered import BUCKETS, LATE, Rules, bucket, from_micros, micros, ordered


class Replay:
    """A stream over the files of ``path`` (one file or a folder of part files), in no time order,
    that can be closed: ``rows`` is the streaming DataFrame, ``close()`` adds a row with nothing
    but an event time, ``delay`` behind which the watermark has passed every event."""

    def __init__(self, spark: SparkSession, path: str, schema, time: str, delay: str, max_files: int = 8):
        self.spark, self.schema, self.time, self.delay = spark, schema, time, delay
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/close-{uuid.uuid4().hex}"
        self.path = path
        self._write([])
        files = read_files(spark, path, schema, max_files=max_files)
        self.rows = files.unionByName(spark.readStream.schema(schema).parquet(self.folder))

    def _write(self, rows) -> None:
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def close(self) -> None:
        last = self.spark.read.schema(self.schema).parquet(self.path).agg(F.max(self.time).cast("timestamp_ntz")).first()[0]
        if last is None:
            return
        n, unit = self.delay.split()
        end = last + dt.timedelta(**{unit.rstrip("s") + "s": int(n)}) + dt.timedelta(milliseconds=1)
        self._write([tuple(end if f.name == self.time else None for f in self.schema.fields)])


def run(df: DataFrame, name: str, source: Replay | TimeOrdered | None = None, base: str | None = None) -> DataFrame:
    """Run a streaming DataFrame until its input is exhausted; return what it wrote. ``base`` names
    the folder of its results and checkpoint, to go on with a query stopped before."""
    spark = df.sparkSession
    base = base or f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"
    shuffles = "spark.sql.shuffle.partitions"
    before = spark.conf.get(shuffles)
    # a state store for each partition, all of them written with every micro-batch
    spark.conf.set(shuffles, str(min(int(before), BUCKETS // 4)))
    try:
        _run(df, source, base)
    finally:
        spark.conf.set(shuffles, before)
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def _run(df: DataFrame, source: Replay | TimeOrdered | None, base: str) -> None:
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", f"{base}/out").option("checkpointLocation", f"{base}/state"))
    if isinstance(source, TimeOrdered):
        source.run(writer.trigger(processingTime="0 seconds").start())
    else:
        writer.trigger(availableNow=True).start().awaitTermination()
        if source is not None:
            source.close()
            writer.trigger(availableNow=True).start().awaitTermination()


def read_files(spark: SparkSession, path: str, schema, max_files: int | None = 8) -> DataFrame:
    """A stream over a parquet file or a folder of part files; ``max_files`` bounds a
    micro-batch. The path is given as a pattern, which matches either."""
    at = path.rstrip("/")
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{at[:-1]}[{at[-1]}]")


def table_stream(table: DataFrame) -> DataFrame:
    """A table as a stream: itself where it is one, else the rows it holds now."""
    if table.isStreaming:
        return table
    path = f"{checkpoint_dir(table.sparkSession).rstrip('/')}/opening-{uuid.uuid4().hex}"
    table.write.parquet(path)
    return table.sparkSession.readStream.schema(table.schema).parquet(path)


def _null(kind: str, name: str):
    return F.lit(None).cast(kind).alias(name)


# ------------------------------------------------------------------ S01 points ledger

def _apply_points(get, put, row, due):
    at, pid, member, amount, kind, code, _ = row
    balance = None
    if code is None:
        held = get((member,))
        if held is None:
            code = "-20022"
        else:
            balance = held[0] + (amount if kind == "Earned" else -amount if kind == "Used" else 0)
            if balance < 0:
                code, balance = "-20023", held[0]
            put((member,), (balance,))
    return [(pid, member, amount, kind, at, code, balance)]


_POINTS = Rules(
    row="at long, id long, member_id long, amount long, kind string, code string, opening long",
    key="member_id long", value="balance long",
    out="point_redemption_id long, member_id long, amount long, transaction_type string, at long, code string, balance_after long",
    apply=_apply_points,
    refuse=lambda row, code: [(*row[1:5], row[0], row[5] if code != LATE and row[5] else code, None)],
    opens=lambda row: None if row[6] is None else ((row[2],), (row[6],)))


def points_ledger_stream(t, events: DataFrame, delay: str = "1 hours") -> DataFrame:
    """Per-member balance with overdraft rejects over a stream of ``events``.

    Events become point rows with the batch adapter's expressions; the opening balances come
    from the member table (a table or a stream). Codes as V02 (-20020..-20023), LATE, NO_TIME.
    """
    ph = R.point_history(lambda _: events)
    code = (F.when(F.col("amount").isNull() | (F.col("amount") <= 0), "-20020")
             .when(~F.col("transaction_type").isin("Earned", "Used"), "-20021"))
    rows = ph.select(bucket("member_id"), micros("redemption_date").alias("at"), F.col("point_redemption_id").cast("long").alias("id"),
                     F.col("member_id").cast("long").alias("member_id"), F.col("amount").cast("long").alias("amount"),
                     F.col("transaction_type").alias("kind"), code.alias("code"), _null("long", "opening"))
    openings = table_stream(t["member"].select("member_id", "points_balance")).filter("member_id IS NOT NULL").select(
        bucket("member_id"), _null("long", "at"), _null("long", "id"), F.col("member_id").cast("long").alias("member_id"), _null("long", "amount"),
        _null("string", "kind"), _null("string", "code"), F.coalesce(F.col("points_balance").cast("long"), F.lit(0)).alias("opening"))
    out = ordered(rows, openings, _POINTS, delay)
    return out.select("point_redemption_id", "member_id", "amount", "transaction_type", from_micros("at").alias("redemption_date"), "code", "balance_after")


# ------------------------------------------------------------------ S02 low stock

_ITEM = -1  # the branch of the entry that says an item exists


def _stock_rules(threshold: int) -> Rules:
    def apply(get, put, row, due):
        at, order, item, branch, quantity, code, _ = row
        left, low = None, False
        if code is None:
            held = get((branch, item))
            if held is None:
                code = "-20011" if get((_ITEM, item)) is None else "-20012"
            elif get((_ITEM, item)) is None:
                code = "-20011"
            else:
                left = held[0]
                if left >= quantity:
                    left -= quantity
                    low = left < threshold
                    put((branch, item), (left,))
                else:
                    code = "-20013"
        return [(order, item, branch, at, quantity, code, left, low)]

    return Rules(
        row="at long, id long, item_id long, branch_id long, quantity long, code string, opening long",
        key="branch_id long, item_id long", value="stock long",
        out="order_id long, item_id long, branch_id long, at long, quantity long, code string, stock_after long, low_stock boolean",
        apply=apply,
        refuse=lambda row, code: [(row[1], row[2], row[3], row[0], row[4], row[5] if code != LATE and row[5] else code, None, False)],
        opens=lambda row: None if row[6] is None else ((row[3], row[2]), (row[6],)))


def with_order(t, lines: DataFrame) -> DataFrame:
    """Order lines with the branch and date of their order, as the event carries them."""
    return lines.join(t["orders"].select("order_id", "branch_id", "order_date"), "order_id", "left")


def low_stock_stream(t, lines: DataFrame, threshold: int = 20, delay: str = "1 hours") -> DataFrame:
    """A stream of order lines (order_id, item_id, quantity, branch_id, order_date)
    deducts branch stock (V01 rules); ``low_stock`` marks every accepted deduction leaving
    fewer than ``threshold`` units (V06). A line of an unknown order has no branch and no date
    to be ordered by: it is returned at once with -20010. Items and opening stock come from
    their tables (tables or streams). Also LATE, NO_TIME.
    """
    code = F.when(F.col("quantity").isNull() | (F.col("quantity") <= 0), "-20014").when(F.col("branch_id").isNull() | F.col("order_date").isNull(), "-20010")
    rows = lines.select(bucket("item_id"), micros("order_date").alias("at"), F.col("order_id").cast("long").alias("id"), F.col("item_id").cast("long").alias("item_id"),
                        F.col("branch_id").cast("long").alias("branch_id"), F.col("quantity").cast("long").alias("quantity"),
                        code.alias("code"), _null("long", "opening"))
    stock = table_stream(t["branch_stock"].select("branch_id", "item_id", F.col("stock_quantity").cast("long").alias("opening")))
    items = table_stream(t["item"].select(F.lit(_ITEM).cast("long").alias("branch_id"), "item_id", F.lit(0).cast("long").alias("opening")))
    openings = stock.select("branch_id", "item_id", "opening").unionByName(items).filter("branch_id IS NOT NULL AND item_id IS NOT NULL").select(
        bucket("item_id"), _null("long", "at"), _null("long", "id"), F.col("item_id").cast("long").alias("item_id"),
        F.col("branch_id").cast("long").alias("branch_id"), _null("long", "quantity"), _null("string", "code"),
        F.coalesce("opening", F.lit(0)).alias("opening"))
    out = ordered(rows, openings, _stock_rules(threshold), delay)
    return out.select("order_id", "item_id", "branch_id", from_micros("at").alias("order_date"), "quantity", "code", "stock_after", "low_stock")


# ------------------------------------------------------------------ S03 redemption de-duplication

def _apply_first(get, put, row, due):
    at, rid, voucher, order = row
    if get((voucher, order)) is not None:
        return []
    put((voucher, order), (True,))
    return [(rid, voucher, order, at, None)]


_FIRST = Rules(row="at long, id long, voucher_id string, order_id long", key="voucher_id string, order_id long", value="seen boolean",
               out="redemption_id long, voucher_id string, order_id long, at long, code string",
               apply=_apply_first, refuse=lambda row, code: [(row[1], row[2], row[3], row[0], code)])


def with_known_order(t, redemptions: DataFrame) -> DataFrame:
    """Redemptions with ``_o``, true where the order exists."""
    return redemptions.join(t["orders"].select("order_id", F.lit(True).alias("_o")), "order_id", "left")


def dedupe_redemptions_stream(t, redemptions: DataFrame, delay: str = "1 hours", within: str | None = None) -> DataFrame:
    """Keep the first redemption per (voucher, order) -- earliest (redeemed date, id),
    whenever the others arrive; rows of unknown orders are dropped (V03 -20030). Late rows and
    rows without a time are returned with a code and aren't kept.

    The memory of seen pairs is state, an entry for each. With ``within`` (e.g. '7 days') it is
    bounded by a watermark on ``redeemed_date`` instead (``dropDuplicatesWithinWatermark``: the
    first to arrive stays, duplicates further apart are no longer caught).

    Redemptions that carry ``_o`` (``with_known_order``) aren't looked up; others are, against the
    whole order table in each micro-batch."""
    r = redemptions if "_o" in redemptions.columns else with_known_order(t, redemptions)
    r = r.filter(F.col("_o").isNotNull() | F.col("redemption_id").isNull())
    if within:
        return (r.drop("_o").withColumn("_event_time", F.col("redeemed_date").cast("timestamp"))
                 .withWatermark("_event_time", within)
                 .dropDuplicatesWithinWatermark(["voucher_id", "order_id"]).drop("_event_time"))
    r = r.select(bucket("voucher_id", "order_id"), micros("redeemed_date").alias("at"), F.col("redemption_id").cast("long").alias("id"), "voucher_id",
                 F.col("order_id").cast("long").alias("order_id"))
    return ordered(r, None, _FIRST, delay).select("redemption_id", "voucher_id", "order_id", from_micros("at").alias("redeemed_date"), "code")


# ------------------------------------------------------------------ S04 pickup lifecycle

_THREE_DAYS = 3 * 86_400_000_000
_OPEN = ("Ready", "Rescheduled")


def _expire(get, put, key, at):
    """The Expired row of an order whose expiry ``at`` has passed, if it still stands."""
    status, exp, order = get(key) or (None, None, None)
    if status not in _OPEN or exp != at:
        return []
    put(key, ("Expired", exp, order))
    return [(None, order, exp, "Expired", "TIMER", "Expired", exp)]


def _apply_pickup(get, put, row, due):
    at, rid, order, new, reschedule, code, status0, exp0 = row
    out = []
    key = (-1 if order is None else order,)
    if get(key) is None:
        put(key, (status0, exp0, order))
    status, exp, _ = get(key)
    if status in _OPEN and exp is not None and exp < at:  # it expired before this event
        out = _expire(get, put, key, exp)
        status = "Expired"
    if code is None:
        if new == "Completed" and exp is not None and at > exp:
            status, code = "Expired", "-20640"
        else:
            if new == "Ready":
                exp = at + _THREE_DAYS
            elif new == "Rescheduled":
                exp = reschedule if reschedule is not None else at + _THREE_DAYS
            status = new
        put(key, (status, exp, order))
        if status in _OPEN and exp is not None:
            due.append((exp, *key))
    return out + [(rid, order, at, new, code, status, exp)]


_PICKUPS = Rules(row="at long, id long, order_id long, new_status string, reschedule long, code string, status0 string, exp0 long",
                 key="order_id long", value="status string, exp long, order_id long",
                 out="req_id long, order_id long, at long, new_status string, code string, status_after string, exp long",
                 apply=_apply_pickup, refuse=lambda row, code: [(row[1], row[2], row[0], row[3], row[5] if code != LATE and row[5] else code, None, None)],
                 wake=_expire)


def with_pickup(t, requests: DataFrame) -> DataFrame:
    """Requests with the type of their order and the status and expiry of its pickup, at first."""
    sp = t["self_pickup"]
    if "pickup_exp_date" not in sp.columns:
        sp = sp.withColumn("pickup_exp_date", F.lit(None).cast("timestamp_ntz"))
    return (requests.join(t["orders"].select("order_id", "order_type"), "order_id", "left")
            .join(sp.select("order_id", F.col("pickup_status").alias("status0"), F.col("pickup_exp_date").alias("exp0"),
                            F.lit(True).alias("_p")), "order_id", "left"))


def pickup_lifecycle_stream(t, requests: DataFrame, delay: str = "1 hours") -> DataFrame:
    """Pickup status events (W10 rules) as a per-order state machine; additionally an
    event-time timer emits ``Expired`` (code TIMER) for a Ready / Rescheduled order when its
    expiry passes before its next event -- the batch job only expires on a completion attempt.

    Requests that carry their order and pickup (``with_pickup``) aren't looked up; others are,
    against both whole tables in each micro-batch."""
    if "reschedule_date" not in requests.columns:
        requests = requests.withColumn("reschedule_date", F.lit(None).cast("timestamp_ntz"))
    r = requests if "_p" in requests.columns else with_pickup(t, requests)
    code = (F.when(F.col("order_id").isNull(), "IGNORED").when(~F.col("new_status").isin(*PICKUP_STATUSES), "-20638")
             .when(F.col("order_type").isNull(), "-20641").when(F.lower("order_type") != "self pickup", "-20639")
             .when(F.col("_p").isNull(), "-20641")
             .when((F.col("new_status") == "Rescheduled") & (F.col("reschedule_date") < F.col("req_ts")), "-20003"))
    r = r.select(bucket("order_id"), micros("req_ts").alias("at"), F.col("req_id").cast("long").alias("id"), F.col("order_id").cast("long").alias("order_id"),
                 "new_status", micros("reschedule_date").alias("reschedule"), code.alias("code"), "status0", micros("exp0").alias("exp0"))
    out = ordered(r, None, _PICKUPS, delay)
    return out.select("req_id", "order_id", from_micros("at").alias("req_ts"), "new_status", "code", "status_after", from_micros("exp").alias("exp_after"))
