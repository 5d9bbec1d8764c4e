import os

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import __spark_entry__ as driver
from rowgate.operators import analytics
from rowgate.operators.merge import insert_or_ignore, insert_or_update, one_per_key
from rowgate.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    df = driver.queries()[name](spark, SF_DIR)
    problem = difference(connect(SF_DIR), ORACLES[name], df.collect(), df.columns)
    assert problem in (None, "no rows") and (problem is None or name == "groupby_having")


def test_percentile_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = spark.range(4000).select(
            F.when(F.col("id") % 3 == 0, "a").when(F.col("id") == 1, "one").otherwise("b").alias("g"),
            F.when(F.col("id") % 5 == 0, 1.5).when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(900)) / 7).alias("v"),
        )
        for fraction in (0.0, 0.25, 0.5, 0.9, 0.999, 1.0):
            found = {r.g: r.percentile for r in analytics.percentile(df, "g", "v", fraction).collect()}
            exact = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", F.lit(fraction)).alias("p")).collect()}
            assert found == pytest.approx(exact)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_list_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "v string")
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    for values in (["a"], listed):
        assert [r.v for r in analytics.filter_by_list(df, "v", values).collect()] == ["a"]
        assert sorted(r.v for r in analytics.filter_by_list(df, "v", values, not_in_list=True).collect()) == ["b", "c"]


def test_pages_follow_each_other(spark):
    df = spark.range(0, 25, 1, 5)
    seen, after, more = [], -1, True
    while more:
        page = analytics.page_records(df, "id", after, 10).orderBy("id").collect()
        seen += [r.id for r in page]
        after, more = seen[-1], page[0].has_more
    assert seen == list(range(25))


def test_pages_over_a_repeated_column_need_the_whole_key(spark):
    df = spark.range(0, 12, 1, 3).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"), F.lit(7).alias("_place"))
    seen, after, more = [], None, True
    while more:
        page = analytics.page_records(df, ["k", "n"], after, 5).orderBy("k", "n").collect()
        seen += [(r.k, r.n) for r in page]
        after, more = seen[-1], page[0].has_more
        assert page[0]._place == 7
    assert seen == sorted((i % 3, i) for i in range(12))


def test_writing_the_same_rows_twice_changes_nothing(spark):
    target = spark.range(50).select("id", F.lit("old").alias("v"))
    incoming = spark.range(25, 75).select("id", F.lit("new").alias("v"))
    for write in (insert_or_ignore, insert_or_update):
        once = write(target, incoming, ["id"])
        assert sorted(once.collect()) == sorted(write(once, incoming, ["id"]).collect())
        assert once.count() == 75


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    chosen = one_per_key(df, ["k"], F.struct("id"), ["k", "id"], "last")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max_by")
    assert chosen.where("k = 0").first().id == 99_999
