"""Functions and joins over whole tables, without an id filter."""

from sparkfed.plans import registry

SF = "/root/testdata/sf0.001"


def test_no_id_filter(spark):
    count = lambda n: registry.QUERIES[n](spark, SF).count()
    orders, lines = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem"))
    assert count("functions_date") == orders.count()
    assert count("join_local_table") == orders.where("o_orderstatus in ('F', 'O')").count()
    assert count("partition_wise_join") == lines.count()
