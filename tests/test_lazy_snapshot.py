"""A stored table is written when a query first names it, and tasks are bounded in what they read."""

import os
import tempfile

from martlake import catalog
from martlake.operators import constraints, supplier
from martlake.session import _bytes
from martlake.sources.retail import TABLES, load_retail, materialize


def test_a_query_stores_only_the_tables_it_reads(spark, small_dir):
    out = tempfile.mkdtemp(prefix="martlake-test-")
    t = materialize(load_retail(spark, small_dir), out)
    assert os.listdir(out) == [] and t.available() == list(TABLES)
    supplier.weighted_avg_cost(t).collect()
    assert os.listdir(out) == ["procurement"]
    constraints.constraint_violations(t, checks=("C03",)).collect()
    assert sorted(os.listdir(out)) == ["delivery", "member", "procurement", "self_pickup"]
    lazy = load_retail(spark, small_dir)
    for name in ("order_item", "orders"):
        assert sorted(t[name].collect()) == sorted(lazy[name].collect())


def test_a_session_keeps_smaller_bounds_of_its_own(spark, small_dir):
    files, shuffles = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other = spark.newSession()
    other.conf.set(files, "128MB")
    other.conf.set(shuffles, "8m")
    catalog.retail(other, small_dir)
    assert _bytes(other.conf.get(files)) == 16 * 2**20 and other.conf.get(shuffles) == "8m"
