"""Ranking without a single-task window.

``Window.orderBy(...)`` with no partition key moves every row into one task, and
``Window.partitionBy(g)`` moves a whole group into one task -- a hot group (a branch
holding a third of all members) becomes one huge sort. ``global_rank`` instead
range-partitions on (group keys, sort keys): equal keys always land in the same range
partition, a big group is spread over several partitions, and each partition ranks its
own rows. The rows of earlier partitions of the same group are then added as an offset.
The offsets table has one row per (partition, group) present in it -- at most
groups + partitions rows, since a group's rows occupy consecutive range partitions. No
broadcast hint is given: AQE measures that table at run time and broadcasts it only when
it is small (few groups), otherwise it is a plain shuffle join.

The range-partitioned frame is read twice (rank, counts). Two exchanges would each sample
their own range bounds, so the frame is stored (as Parquet, in the shared
``spark.checkpoint.dir``): both reads see one partitioning, and lineage is cut there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.session import stored


def global_rank(df: DataFrame, order: list[Column], name: str = "rank",
                kind: str = "rank", partitions: int | None = None,
                partition_by: list[str] | None = None, bounded: bool = False) -> DataFrame:
    """Add ``name`` = RANK() / ROW_NUMBER() over ``order`` (within ``partition_by`` groups).

    ``order`` is a list of sort columns (``F.col('x').desc()`` etc.). For ``row_number``
    the caller makes the order total (ending with a unique key) so results are
    deterministic, as the reference's counters are only then.
    """
    spark = df.sparkSession
    keys = list(partition_by or [])
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fn = {"rank": F.rank, "row_number": F.row_number}[kind]
    if bounded:  # a few rows by construction (a top-k result, one row a branch): one small window
        return df.withColumn(name, fn().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    parted = stored(df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
                      .withColumn("_pid", F.spark_partition_id()))
    local = parted.withColumn("_lr", fn().over(Window.partitionBy("_pid", *keys).orderBy(*order)))
    counts = parted.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", *keys,
        F.sum("_n").over(Window.partitionBy(*keys).orderBy("_pid")
                         .rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    out = local.join(offsets, ["_pid", *keys])
    return (out.withColumn(name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_lr")).cast("bigint"))
               .drop("_pid", "_lr", "_off"))


def running_sum(df: DataFrame, order: list[Column], value: str, name: str,
                partition_by: list[str] | None = None, partitions: int | None = None,
                steps: list[DataFrame] | None = None) -> DataFrame:
    """Add ``name`` = SUM(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING).

    Same scheme as ``global_rank``: a hot key is spread over consecutive range partitions,
    each partition computes its local running sum, and the totals of the key's earlier
    partitions are added. ``order`` must be total within a key.
    """
    return running_sums(df, order, {name: value}, partition_by, partitions, steps)


def running_sums(df: DataFrame, order: list[Column], values: dict[str, str],
                 partition_by: list[str] | None = None, partitions: int | None = None,
                 steps: list[DataFrame] | None = None) -> DataFrame:
    """``running_sum`` of several columns in one pass: ``values`` maps new names to columns. What
    it stores is added to ``steps``, for a caller that drops it once the result is stored."""
    spark = df.sparkSession
    keys = list(partition_by or [])
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parted = stored(df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
                      .withColumn("_pid", F.spark_partition_id()))
    if steps is not None:
        steps.append(parted)
    w = Window.partitionBy("_pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = parted.withColumns({f"_ls_{k}": F.sum(v).over(w) for k, v in values.items()})
    totals = parted.groupBy("_pid", *keys).agg(*[F.sum(v).alias(f"_t_{k}") for k, v in values.items()])
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *keys, *[F.sum(f"_t_{k}").over(earlier).alias(f"_off_{k}") for k in values])
    out = local.join(offsets, ["_pid", *keys])
    return (out.withColumns({k: F.coalesce(F.col(f"_off_{k}"), F.lit(0)) + F.col(f"_ls_{k}") for k in values})
               .drop("_pid", *[f"_ls_{k}" for k in values], *[f"_off_{k}" for k in values]))
