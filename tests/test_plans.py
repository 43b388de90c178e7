"""Plan shape of every registered batch query: no Cartesian product or nested-loop join,
and no Python except the ordered folds that are declared as such."""

import contextlib
import io

import pytest

from martlake import catalog

QUERIES = catalog.queries()
STREAMS = {n for n in QUERIES if n.endswith("_stream")}
# queries whose plan holds the ordered fold (mapInPandas over key-partitioned sorted input)
FOLDS = {"validation_violations", "stock_ledger_violations", "low_stock_alerts", "points_ledger_violations", "member_points_balances",
         "transfer_stock", "transfer_stock_snapshot"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "AggregateInPandas")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_plan_shape(spark, small_dir, name):
    plan = _plan(QUERIES[name](spark, small_dir))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    if name not in FOLDS:
        for op in PYTHON:
            assert op not in plan, f"{name}: {op}"
