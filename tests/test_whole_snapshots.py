"""Snapshots over all orders leave out no order and no customer but by the data."""

from pyspark.sql import functions as F

from stratalake.workload import versions
from stratalake.workload.common import table


def test_last_snapshot_takes_all_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    last = versions.DAYS[-1]
    assert orders.where(F.col("o_orderdate") > F.lit(last).cast("date")).count() == 0
    newest = {}
    for r in orders.collect():
        newest[r.o_custkey] = max(newest.get(r.o_custkey, (r.o_orderdate, -1, None)),
                                  (r.o_orderdate, r.o_orderkey, r.o_orderstatus))
    found = versions.snapshot(spark, sf_dir, last).collect()
    assert {r.o_custkey for r in found} == {k for k, x in newest.items() if x[2] != "P"}


def test_old_orders_keep_a_customer(spark, tmp_path):
    rows = [(1, 7, "1995-02-01", "F", "1-URGENT", 10.0), (2, 8, "1995-02-01", "F", "1-URGENT", 10.0),
            (3, 8, "2001-07-01", "P", "5-LOW", 5.0)]
    spark.createDataFrame(rows, "o_orderkey int, o_custkey int, day string, o_orderstatus string, "
                                "o_orderpriority string, o_totalprice double").selectExpr(
        "*", "CAST(day AS timestamp) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    kept = [[r.o_custkey for r in versions.snapshot(spark, str(tmp_path), d).orderBy("o_custkey").collect()]
            for d in versions.DAYS]
    assert kept == [[7, 8], [7, 8], [7]]
