from pyspark.sql import functions as F

from quarry.plans.fixtures import mining_orders
from quarry.plans.views import _PATHS, materialized
from quarry.session import right_size

from small_tables import SF_SMALL


def test_view_written_once_and_equal_to_plan(spark):
    a = mining_orders(spark, SF_SMALL)
    b = mining_orders(spark, SF_SMALL)
    key = (spark.sparkContext.applicationId, "mining_orders", SF_SMALL)
    assert key in _PATHS
    assert a.inputFiles() == b.inputFiles()
    from quarry.plans.fixtures import _mining_orders_plan
    from quarry.sources.tables import read_table
    plan = _mining_orders_plan(spark, SF_SMALL, read_table(spark, SF_SMALL, "orders"))
    assert a.exceptAll(plan).count() == 0 and plan.exceptAll(a).count() == 0


def test_materialized_builds_lazily_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5).withColumn("x", F.col("id") * 2)

    first = materialized(spark, "tiny", "/nowhere", build)
    second = materialized(spark, "tiny", "/nowhere", build)
    assert len(calls) == 1 and first.count() == 5 and second.agg(F.sum("x")).first()[0] == 20


def test_right_size_merges_only_down(spark):
    df = spark.range(0, 1000, numPartitions=16)
    # Down to the rows' need, but not below the default parallelism.
    least = max(2, spark.sparkContext.defaultParallelism)
    assert right_size(df, 1000, rows_per_partition=500).rdd.getNumPartitions() == least
    assert right_size(df, 1000, rows_per_partition=10).rdd.getNumPartitions() == 16
