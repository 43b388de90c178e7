"""The stock report is a list in the reference's order: lowest stock first, then by item."""

from martlake import catalog
from martlake.operators.inventory import branch_stock_status
from martlake.sources.retail import from_frames


def test_lowest_first(spark):
    t = from_frames(spark, {
        "item": spark.createDataFrame([(i, f"i{i}", "k") for i in (7, 8, 9)], "item_id long, item_name string, category string"),
        "branch_stock": spark.createDataFrame(
            [(1, 9, 50, None), (2, 7, 3, None), (1, 7, 49, None), (2, 8, None, None), (1, 8, 3, None), (3, 7, 3, None)],
            "branch_id long, item_id long, stock_quantity int, last_restock_date date")})
    got = [(r.branch_id, r.item_id, r.stock_quantity, r.stock_status) for r in branch_stock_status(t).collect()]
    assert got == [(2, 7, 3, "LOW STOCK"), (3, 7, 3, "LOW STOCK"), (1, 8, 3, "LOW STOCK"), (1, 7, 49, "LOW STOCK"), (1, 9, 50, "OK"),
                   (2, 8, None, "OK")]
    assert [r.item_id for r in branch_stock_status(t, 1).collect()] == [8, 7, 9]


def test_registered_query_is_in_order(spark, small_dir):
    rows = [(r.stock_quantity, r.item_id, r.branch_id) for r in catalog.queries()["branch_stock_status"](spark, small_dir).collect()]
    assert rows and rows == sorted(rows)
