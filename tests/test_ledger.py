"""The ordered fold equals a plain sequential loop, including a hot key."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from martlake.plans.ledger import Transfer, ledger_fold


def _loop(events, opening):
    bal = dict(opening)
    out = {}
    for k, ts, i, d in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        b = bal.get(k, 0)
        if b + d >= 0:
            bal[k] = b + d
            out[i] = (True, b + d)
        else:
            out[i] = (False, b)
    return out


def test_fold_equals_loop(spark):
    rnd = random.Random(3)
    events = []
    for i in range(4000):
        k = 1 if rnd.random() < 0.35 else rnd.randint(2, 40)
        events.append((k, rnd.randint(0, 500), i, rnd.choice([-1, 1]) * rnd.randint(1, 30)))
    opening = {k: rnd.randint(0, 60) for k in range(1, 35)}
    ev = spark.createDataFrame(events, "k long, ts long, id long, delta long")
    op = spark.createDataFrame(list(opening.items()), "k long, opening long")
    got = {r["id"]: (r["accepted"], r["balance_after"])
           for r in ledger_fold(ev, op, ["k"], ["ts", "id"]).collect()}
    assert got == _loop(events, opening)
    assert any(not a for a, _ in got.values())


def test_hot_key_in_segments(spark):
    """A key with half of all events, always short of balance, runs in many segments."""
    rnd = random.Random(4)
    events = []
    for i in range(6000):
        k = 1 if rnd.random() < 0.5 else rnd.randint(2, 9)
        # debits outweigh credits, so a third of them is refused
        events.append((k, rnd.randint(0, 900), i, rnd.choice([-1, -1, 1]) * rnd.randint(1, 60)))
    opening = {k: rnd.randint(0, 60) for k in range(1, 8)}
    ev = spark.createDataFrame(events, "k long, ts long, id long, delta long")
    op = spark.createDataFrame(list(opening.items()), "k long, opening long")
    out = ledger_fold(ev, op, ["k"], ["ts", "id"], segment=150)
    got = {r["id"]: (r["accepted"], r["balance_after"]) for r in out.collect()}
    assert got == _loop(events, opening)
    assert out.columns == ["k", "ts", "id", "delta", "accepted", "balance_after"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-40, 25), max_size=60))
def test_transfer_is_the_fold_of_every_opening(deltas):
    t = Transfer()
    for d in deltas:
        t.add(d)
    least, moved = t.rows()
    for opening in [*range(0, 130), 10**9]:
        balance = opening
        for d in deltas:
            if balance + d >= 0:
                balance += d
        at = least.searchsorted(opening, "right") - 1
        assert opening + moved[at] == balance
