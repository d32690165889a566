"""Ranks without a hot task, and joins with hot keys."""
from pyspark.sql import functions as F

from bagwise.operators.joins import hot_keys, join_hot
from bagwise.operators.rank import ranked


def test_ranked_equals_sorting(spark):
    # one value holds most rows, and all keys share a prefix
    rows = [(7 if i % 3 else i, f"http://same/{i:05d}") for i in range(5000)]
    df = spark.createDataFrame(rows, "n long, key string").repartition(7)
    got = ranked(df, [F.desc("n"), F.asc("key")]).collect()
    want = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [(r["n"], r["key"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5001))
    assert got[0].asDict().keys() == {"n", "key", "rank"}


def test_ranked_spreads_a_hot_first_column(spark):
    df = spark.range(20000).select(F.lit(1).alias("n"), F.format_string("http://same/%05d", "id").alias("key"))
    sizes = df.repartitionByRange(8, F.desc("n"), F.asc("key")).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r[1] for r in sizes) < 20000 * 0.5


def test_ranked_empty_and_ties(spark):
    df = spark.createDataFrame([], "n long")
    assert ranked(df, [F.asc("n")]).count() == 0
    same = spark.createDataFrame([(None,), (1,), (1,), (None,)], "n long")
    assert [tuple(r) for r in ranked(same, [F.asc_nulls_last("n")]).orderBy("rank").collect()] == [(1, 1), (1, 2), (None, 3), (None, 4)]


def test_join_hot_equals_join(spark):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)] + [(9999, None)], "id long, key string")
    table = spark.createDataFrame([(f"k{i}", i) for i in range(40)] + [("hot", -1)], "key string, value long")
    assert "hot" in hot_keys(big, "key", 100) and len(hot_keys(big, "key", 20)) <= 20
    for how in ("inner", "left"):
        got = sorted(map(tuple, join_hot(big, table, "key", how, 20).select("id", "key", "value").collect()), key=repr)
        want = sorted(map(tuple, big.join(table, "key", how).select("id", "key", "value").collect()), key=repr)
        assert got == want
    assert join_hot(big.limit(0), table, "key").count() == 0


def test_no_task_reads_a_hot_key(spark):
    """The shuffled rows hold no key above its share, so no partition of the join does."""
    big = spark.range(60000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"))
    table = big.distinct().withColumn("value", F.lit(1))
    rest = big.where(~F.col("key").isin(hot_keys(big, "key", 100)))
    assert rest.groupBy("key").count().agg(F.max("count")).first()[0] <= 600
    assert join_hot(big, table, "key", share=100).count() == 60000
