"""Ordered conditional fold: apply signed deltas to per-key balances, in event order,
rejecting a debit that would take the balance below zero (a rejected event leaves the
balance unchanged, so every accept changes the next check).

A running-sum window alone is wrong (it lets rejected debits count). The plan:

1. Fast path, set-wise: the running balance assuming every event is accepted
   (opening + running sum of deltas, range-partitioned so a hot key spans many tasks).
   Up to a key's first event whose running balance is negative, that assumption is
   exact: those events are accepted with that balance. Keys that never dip are done.
2. Only the tail of a contended key, from its first dip on, is folded in order: rows are
   hash-partitioned, sorted by order inside the partition and streamed through
   ``mapInPandas`` in Arrow batches; the fold state is one balance.
3. A tail of more than ``SEGMENT`` events is cut into segments. What a segment does to a
   balance is a *transfer*: intervals of opening balances, each with the amount by which it
   ends higher or lower, since openings in one interval accept and reject alike. Transfers
   are found for all segments at once, composed along each key (one look-up a segment) to
   give every segment's opening balance, and then all segments are folded at once. So the
   events of one hot key run in as many tasks as it has segments.

Result columns added: ``accepted`` (bool), ``balance_after`` (balance after the event;
unchanged for a rejected one).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.functions.ranking import global_rank, running_sum
from martlake.session import stored

#: events of one key that a task folds in order
SEGMENT = 100_000


def _fold_batches(keys: list[str], delta: str, start: str):
    def fold(batches):
        cur = None
        bal = 0
        for pdf in batches:
            n = len(pdf)
            acc = np.zeros(n, dtype=bool)
            out = np.zeros(n, dtype=np.int64)
            kv = list(zip(*[pdf[k].tolist() for k in keys])) if keys else [()] * n
            d = pdf[delta].to_numpy(dtype=np.int64)
            s = pdf[start].to_numpy(dtype=np.int64)
            for i in range(n):
                if kv[i] != cur:
                    cur = kv[i]
                    bal = int(s[i])
                nb = bal + int(d[i])
                if nb >= 0:
                    bal = nb
                    acc[i] = True
                out[i] = bal
            yield pdf.assign(accepted=acc, balance_after=out)
    return fold


class Transfer:
    """What a run of events does to an opening balance: openings from ``least[i]`` up to the next
    least one end ``moved[i]`` higher."""

    def __init__(self):
        self.least, self.moved, self.shift = np.zeros(1, np.int64), np.zeros(1, np.int64), 0

    def add(self, delta: int) -> None:
        if delta >= 0:
            self.shift += delta
            return
        # the openings of an interval that can pay: those from its threshold on
        threshold = -delta - self.moved - self.shift
        ends = np.append(self.least[1:], np.iinfo(np.int64).max)
        split = np.flatnonzero((threshold > self.least) & (threshold < ends))
        pays = threshold <= self.least
        self.moved[pays] += delta
        if len(split):
            self.least = np.insert(self.least, split + 1, threshold[split])
            self.moved = np.insert(self.moved, split + 1, self.moved[split] + delta)
            same = np.flatnonzero(np.diff(self.moved) == 0) + 1  # intervals that act alike again
            if len(same):
                self.least, self.moved = np.delete(self.least, same), np.delete(self.moved, same)

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        return self.least, self.moved + self.shift


def _transfers(keys: list[str]):
    """One row for each segment of a partition sorted by (keys, segment, order): its transfer."""
    def run(batches):
        cur, t = None, None

        def row():
            least, moved = t.rows()
            return [*cur, least.tobytes(), moved.tobytes()]

        for pdf in batches:
            out = []
            for *kv, d in zip(*[pdf[k].tolist() for k in keys], pdf["_seg"].tolist(), pdf["_d"].tolist()):
                if kv != cur:
                    if cur is not None:
                        out.append(row())
                    cur, t = kv, Transfer()
                t.add(int(d))
            if out:
                yield pd.DataFrame(out, columns=[*keys, "_seg", "_least", "_moved"])
        if cur is not None:
            yield pd.DataFrame([row()], columns=[*keys, "_seg", "_least", "_moved"])
    return run


def _openings(keys: list[str]):
    """The opening balance of every segment, from transfers sorted by (keys, segment)."""
    def run(batches):
        cur, balance = None, 0
        for pdf in batches:
            out = []
            for *kv, seg, start, least, moved in zip(*[pdf[k].tolist() for k in keys], *[pdf[c].tolist() for c in ("_seg", "_start", "_least", "_moved")]):
                if kv != cur:
                    cur, balance = kv, int(start)
                out.append([*kv, seg, balance])
                at = int(np.searchsorted(np.frombuffer(least, np.int64), balance, "right")) - 1
                balance += int(np.frombuffer(moved, np.int64)[at])
            yield pd.DataFrame(out, columns=[*keys, "_seg", "_open_seg"])
    return run


def _segmented(tail: DataFrame, keys: list[str], order: list[str], segment: int) -> DataFrame:
    """``tail`` with ``_seg`` and, in place of the key's, the segment's ``_start``."""
    # the plain path has one segment a key; this one costs another pass over the tails
    nth = global_rank(tail, [F.col(c) for c in order], "_nth", "row_number", partition_by=keys)
    cut = stored(nth.withColumn("_seg", F.floor((F.col("_nth") - 1) / segment).cast("long")).drop("_nth"))
    long = cut.filter("_seg > 0").select(*keys).distinct()  # keys of more than one segment
    key_fields = [f for f in tail.schema.fields if f.name in keys]
    key_fields = [next(f for f in key_fields if f.name == k) for k in keys]
    seg = T.StructField("_seg", T.LongType())
    moves = (cut.join(long, keys, "left_semi").select(*keys, "_seg", *order, "_d")
             .repartition(*keys, "_seg").sortWithinPartitions(*keys, "_seg", *order).drop(*order)
             .mapInPandas(_transfers(keys), T.StructType([*key_fields, seg, T.StructField("_least", T.BinaryType()), T.StructField("_moved", T.BinaryType())])))
    starts = cut.join(long, keys, "left_semi").filter("_seg = 0").groupBy(*keys).agg(F.min("_start").alias("_start"))
    opened = (moves.join(starts, keys).select(*keys, "_seg", "_start", "_least", "_moved")
              .repartition(*keys).sortWithinPartitions(*keys, "_seg")
              .mapInPandas(_openings(keys), T.StructType([*key_fields, seg, T.StructField("_open_seg", T.LongType())])))
    return (cut.join(opened, [*keys, "_seg"], "left").withColumn("_start", F.coalesce("_open_seg", "_start")).drop("_open_seg"))


def ledger_fold(events: DataFrame, opening: DataFrame, keys: list[str], order: list[str],
                delta: str = "delta", opening_col: str = "opening", segment: int = SEGMENT) -> DataFrame:
    """Fold ``events`` (keys, order columns, signed ``delta``) over ``opening`` balances.

    Events of keys without an opening row start from 0. ``order`` must be total within a key.
    """
    ocols = [F.col(c) for c in order]
    ev = (events.join(opening.select(*keys, F.col(opening_col).cast("bigint").alias("_open")), keys, "left")
                .withColumn("_open", F.coalesce("_open", F.lit(0)).cast("bigint"))
                .withColumn("_d", F.col(delta).cast("bigint")))
    rs = running_sum(ev, ocols, "_d", "_rs", partition_by=keys).withColumn("_bal", F.col("_open") + F.col("_rs"))
    okey = F.struct(*ocols)
    dips = (rs.filter(F.col("_bal") < 0).groupBy(*keys)
              .agg(F.min(okey).alias("_dip"),
                   F.min_by(F.col("_bal") - F.col("_d"), okey).alias("_start")))
    j = rs.join(dips, keys, "left")
    before = F.col("_dip").isNull() | (okey < F.col("_dip"))
    head = (j.filter(before).withColumn("accepted", F.lit(True))
             .withColumn("balance_after", F.col("_bal")))
    tail = j.filter(~before)
    base_cols = [c for c in events.columns]
    tail = tail.select(*base_cols, "_d", "_start")
    most = events.groupBy(*keys).count().agg(F.max("count")).first()[0]
    tail = _segmented(tail, keys, order, segment) if (most or 0) > segment else tail.withColumn("_seg", F.lit(0).cast("long"))
    tail_in = tail.repartition(*keys, "_seg").sortWithinPartitions(*keys, "_seg", *order)
    schema = T.StructType(tail_in.schema.fields + [T.StructField("accepted", T.BooleanType(), False),
                                                   T.StructField("balance_after", T.LongType(), False)])
    folded = tail_in.mapInPandas(_fold_batches([*keys, "_seg"], "_d", "_start"), schema)
    return (head.select(*base_cols, "accepted", "balance_after")
                .unionByName(folded.select(*base_cols, "accepted", "balance_after")))
