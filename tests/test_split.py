"""Split and fold properties."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from bagwise.functions.hashing import row_hash
from bagwise.operators import split
from conftest import SF_MID


def _docs(spark):
    return spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")


def _window_form(df, key, by, f, seed):
    """The definition: per class, the round(f*n) smallest (md5, key) rows."""
    w = Window.partitionBy(by).orderBy(row_hash(key, seed), key)
    n = F.count(F.lit(1)).over(Window.partitionBy(by))
    return df.select(key, F.when(F.row_number().over(w) <= F.round(n * f), "test")
                     .otherwise("train").alias("split"))


def test_exact_split_equals_window_definition(spark):
    d = _docs(spark)
    got = {r[0]: r[1] for r in split.with_split(d, "doc_id", 0.2, 7, by="lang")
           .select("doc_id", "split").collect()}
    want = {r[0]: r[1] for r in _window_form(d, "doc_id", "lang", 0.2, 7).collect()}
    assert got == want


def test_exact_split_with_crowded_buckets(spark):
    # one hex digit = 16 buckets: the boundary bucket holds many rows, so the
    # second step really ranks inside it; a skewed class holds most rows
    d = _docs(spark).withColumn("lang", F.when(F.col("doc_id") % 10 < 7, "hot")
                                .otherwise(F.col("lang")))
    for f in (0.2, 0.5, 0.01):
        got = {r[0]: r[1] for r in split.with_split(d, "doc_id", f, 3, by="lang",
                                                    bucket_hex=1)
               .select("doc_id", "split").collect()}
        want = {r[0]: r[1] for r in _window_form(d, "doc_id", "lang", f, 3).collect()}
        assert got == want


def test_split_disjoint_cover_and_quota(spark):
    d = _docs(spark)
    s = split.with_split(d, "doc_id", 0.2, 7, by="lang")
    assert s.count() == d.count()
    assert s.select("doc_id").distinct().count() == d.count()
    sizes = {(r["split"], r["lang"]): r["count"] for r in split.split_sizes(s, "lang").collect()}
    totals = {r["lang"]: r["count"] for r in d.groupBy("lang").count().collect()}
    for c, n in totals.items():
        assert sizes.get(("test", c), 0) == round(0.2 * n + 1e-9)


def test_split_independent_of_partitioning(spark):
    d = _docs(spark)
    a = {tuple(r) for r in split.with_split(d, "doc_id", 0.3, 5, by="lang").collect()}
    b = {tuple(r) for r in split.with_split(d.repartition(7), "doc_id", 0.3, 5,
                                            by="lang").collect()}
    assert a == b


def test_split_null_class_is_a_group(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else "a") for i in range(30)],
                               "id long, c string")
    s = split.with_split(df, "id", 0.5, 1, by="c")
    got = {(r["c"], r["split"]): r["count"] for r in s.groupBy("c", "split").count().collect()}
    assert got[(None, "test")] == 5 and got[("a", "test")] == 10


def test_random_split_exact_global_quota(spark):
    d = _docs(spark)
    train, test = split.random_split_exact(d, "doc_id", 0.25, 11)
    assert test.count() == 250 and train.count() == 750
    assert train.join(test, "doc_id").count() == 0


def test_folds_partition_rows(spark):
    d = _docs(spark)
    f = split.with_folds(d, "doc_id", 3, 7)
    counts = {r["fold"]: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and sum(counts.values()) == 1000
    assert min(counts.values()) > 250


def test_sample_by_split_complement(spark):
    d = _docs(spark)
    train, test = split.sample_by_split(d, "lang", "doc_id", 0.2, 7)
    assert train.count() + test.count() == d.count()
    assert train.join(test, "doc_id").count() == 0


def test_anti_join_keeps_null_keys(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    b = spark.createDataFrame([(1,), (None,)], "k long")
    assert sorted(split.anti_join(a, b, "k").collect(), key=repr) == \
        sorted([(2,), (None,)], key=repr)


def test_hash_threshold_split_is_repeatable(spark):
    d = _docs(spark)
    a = {tuple(r) for r in split.hash_threshold_split(d, "doc_id", 0.2, 7).collect()}
    b = {tuple(r) for r in split.hash_threshold_split(d.repartition(4), "doc_id", 0.2, 7).collect()}
    assert a == b
    n_test = sum(1 for r in a if r[2] == "test")
    assert 120 < n_test < 280      # about 20 % of 1000
