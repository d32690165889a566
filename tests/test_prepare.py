"""Duplicate bags (A10) and class weights."""
import pytest
from pyspark.sql import functions as F

from bagwise.operators import prepare


def _bags(spark):
    rows = [(5, "x", ["b", "a"]), (3, "y", ["a", "b"]), (9, "x", ["a", "b"]),
            (4, "x", ["c"]), (8, "y", ["c"]), (7, "x", ["a", "a", "b"])]
    return spark.createDataFrame(rows, "id long, cls string, tokens array<string>")


def test_dedup_keeps_smallest_key(spark):
    out = prepare.dedup_bags(_bags(spark), "id")
    got = sorted((r["id"], r["cls"], tuple(r["tokens"])) for r in out.collect())
    # multiset {a, b} -> id 3; {c} -> 4; {a, a, b} is a different multiset
    assert got == [(3, "y", ("a", "b")), (4, "x", ("c",)), (7, "x", ("a", "a", "b"))]


def test_dedup_with_class_identity(spark):
    out = prepare.dedup_bags(_bags(spark), "id", class_col="cls")
    assert sorted(r["id"] for r in out.collect()) == [3, 4, 5, 7, 8]


def test_dedup_hot_bag(spark):
    # a third of the rows share one bag
    rows = [(i, "a", ["same"] if i % 3 == 0 else [f"t{i}"]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, cls string, tokens array<string>")
    out = prepare.dedup_bags(df.repartition(8), "id")
    assert out.count() == 201
    assert out.where(F.array_contains("tokens", "same")).first()["id"] == 0


def test_class_weights_sum(spark):
    df = _bags(spark)
    t = prepare.class_weight_table(df, "cls").collect()
    total = sum(r["class_count"] for r in t)
    # sum over rows of the weights = total when n_classes = classes found
    assert abs(sum(r["weight"] * r["class_count"] for r in t) - total) < 1e-9
    w = {r["cls"]: r["weight"] for r in t}
    assert abs(w["x"] - (6 / 4) / 2) < 1e-12 and abs(w["y"] - (6 / 2) / 2) < 1e-12


def test_class_weights_reference_total(spark):
    t = prepare.class_weight_table(_bags(spark), "cls", total=10, n_classes=20).collect()
    w = {r["cls"]: r["weight"] for r in t}
    assert abs(w["x"] - (10 / 4) / 20) < 1e-12


def test_null_class_rejected(spark):
    df = spark.createDataFrame([(1, None, ["a"])], "id long, cls string, tokens array<string>")
    with pytest.raises(ValueError):
        prepare.class_weight_table(df, "cls")


def test_rows_get_weights_by_broadcast(spark):
    out = prepare.with_class_weights(_bags(spark), "cls")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert out.count() == 6


def test_bounded_table_fallback_is_not_broadcast(spark):
    from bagwise.operators.joins import bounded_table, join_small
    small = spark.createDataFrame([(i, f"c{i}") for i in range(5)], "k long, v string")
    assert bounded_table(small, max_rows=5).bounded
    t = bounded_table(small, max_rows=4)
    assert not t.bounded and t.rows is None
    big = spark.range(100).withColumnRenamed("id", "k")
    assert join_small(big, small, "k", max_rows=4).count() == 5


def test_scale_conf_sizes_partitions():
    from bagwise.session import scale_conf
    c = scale_conf(100 * 10 ** 12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == -(-100 * 10 ** 12 // (128 << 20))  # no cap
    small = scale_conf(10 ** 9, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192


def test_materialize_and_release(spark):
    import os
    from bagwise.session import _WRITTEN, materialize, release
    df = materialize(spark.range(10), "t")
    path = _WRITTEN[-1]
    assert df.count() == 10
    local = path.replace("file:", "")
    assert os.path.exists(local)
    assert release(spark) >= 1
    assert not os.path.exists(local)


def test_dedup_same_rows_whichever_keys_are_broadcast(spark):
    rows = [(i if i % 7 else None, "a", [f"t{i % 11}"] if i % 2 else [f"u{i}"]) for i in range(120)] + [(5, "a", ["u2"]), (1, "a", None), (3, "a", None)]
    df = spark.createDataFrame(rows, "id long, cls string, tokens array<string>").repartition(5)
    found = [sorted(map(str, prepare.dedup_bags(df, "id", max_keys=m).collect())) for m in (1 << 20, 64, 0)]
    assert found[0] == found[1] == found[2]
    assert not any("id=None" in r for r in found[0])


def test_dedup_leaves_the_bags_where_they_are(spark, tmp_path):
    spark.createDataFrame([(i, "a", [f"t{i % 20}"]) for i in range(60)], "id long, cls string, tokens array<string>").write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as for tables above it
    try:
        for most in (1 << 20, 45):   # the kept keys (20), or the others (40)
            plan = prepare.dedup_bags(spark.read.parquet(str(tmp_path / "t")), "id", max_keys=most)._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        plan = prepare.dedup_bags(spark.read.parquet(str(tmp_path / "t")), "id", max_keys=19)
        assert sorted(r["id"] for r in plan.collect()) == list(range(20))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
