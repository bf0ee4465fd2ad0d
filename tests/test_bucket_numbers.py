"""The buckets of a stored table follow its size."""

from pyspark.sql import functions as F

from visitlens.session import scratch_path
from visitlens.sinks import buckets_for, store_bucketed


def test_buckets_of_a_stored_table_follow_its_size(spark):
    small = spark.range(100).selectExpr("id as visit_id", "repeat('x', 100) as url")
    assert buckets_for(small, 3) == 3
    large = spark.range(20_000).selectExpr("id as visit_id", "repeat('x', 1000) as url",
                                           "array(id) as ids")
    n = buckets_for(large, 3, bucket_bytes=1_000_000)
    assert n % 3 == 0 and 20 <= n <= 30       # 20 MB
    path, table = scratch_path(spark, "buckets-test"), "buckets_follow_size"
    stored = store_bucketed(large, table, "visit_id", 3, path, bucket_bytes=1_000_000)
    try:
        sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) == n and max(sizes) < 2 * 20_000 / n
        assert stored.exceptAll(large).count() == 0 and stored.count() == 20_000
        # a side with fewer buckets than a shuffle has partitions would be exchanged again
        j = stored.join(spark.range(20_000).withColumnRenamed("id", "visit_id"), "visit_id")
        assert j._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_buckets_reach_the_partitions_of_a_shuffle_and_no_more_than_spark_allows(spark):
    df = spark.range(1000)
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "20")
    try:
        assert buckets_for(df, 3, bucket_bytes=6000) == 9       # 24 kB: 4, a shuffle has 8
        assert buckets_for(df, 3, bucket_bytes=1) == 18
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
