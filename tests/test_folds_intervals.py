"""Group folds, bootstrap intervals, observed loads, hashed names and hot tokens, against plain versions."""
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as s
from pyspark.sql import functions as F

from bagwise.operators import features as feat
from bagwise.operators import folds as fd
from bagwise.operators import metrics as met
from bagwise.plans import models as mdl
from bagwise.plans import stages as st
from bagwise.plans import tuning
from bagwise.sources import tables


@settings(max_examples=200, deadline=None)
@given(s.lists(s.integers(0, 40), min_size=1, max_size=6), s.integers(1, 9), s.integers(0, 60))
def test_dealt_equals_one_by_one(loads, size, n):
    own, want = list(loads), [0] * len(loads)
    for _ in range(n):
        f = own.index(min(own))
        own[f] += size
        want[f] += 1
    assert fd.dealt(loads, size, n) == want


def test_group_folds(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), "hot" if rng.random() < 0.3 else f"g{rng.randrange(400)}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, g string")
    got = fd.with_group_folds(df, F.col("g"), "lang", 4).collect()
    assert len(got) == 2000 and {r["fold"] for r in got} == {0, 1, 2, 3}
    of = {}
    for r in got:
        assert of.setdefault(r["g"], r["fold"]) == r["fold"]
    seen = {}
    for r in got:
        seen.setdefault(r["g"], Counter())[r["lang"]] += 1
    loads, largest = {}, Counter()
    for g, classes in seen.items():
        c = min(classes, key=lambda k: (-classes[k], k is not None, k or ""))
        loads.setdefault(c, [0] * 4)[of[g]] += sum(classes.values())
        largest[c] = max(largest[c], sum(classes.values()))
    for c, own in loads.items():
        assert max(own) - min(own) <= largest[c]
    again = fd.with_group_folds(df.repartition(7), F.col("g"), "lang", 4).collect()
    assert {r["doc_id"]: r["fold"] for r in again} == {r["doc_id"]: r["fold"] for r in got}
    assert fd.with_group_folds(df.limit(0), F.col("g"), "lang", 4).count() == 0


def test_bags_as_groups(spark):
    df = spark.createDataFrame([(0, ["a", "b"]), (1, ["b", "a"]), (2, ["a", "b", "b"]), (3, None), (4, None), (5, [])], "doc_id long, tokens array<string>")
    got = [r[0] for r in df.orderBy("doc_id").select(fd.bag_group("tokens")).collect()]
    assert got[0] == got[1] != got[2] and got[3] == got[4] == "null" != got[5]


def test_grid_with_group_folds(spark):
    rows = [(i, ["x", f"w{i // 4}"] if i % 2 else ["y", f"w{i // 4}"], "odd" if i % 2 else "even") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, lang string")
    prep = mdl.prepare_training(df, "doc_id", "lang")
    got = tuning.grid_search_lr(prep, (64,), (0.01,), max_iter=5, group_folds=True).collect()
    assert len(got) == 1 and got[0]["mean_accuracy"] > 0.9


def predictions(spark, n=400):
    rng = random.Random(8)
    rows = [(i, float(rng.randrange(3)), 0.0) for i in range(n)]
    rows = [(i, y, y if rng.random() < 0.7 else float(rng.randrange(4))) for i, y, _ in rows]
    return spark.createDataFrame(rows, "doc_id long, label double, prediction double"), rows


def test_bootstrap_equals_plain_replicates(spark):
    import hashlib
    df, rows = predictions(spark)
    got = {r["replicate"]: r for r in met.bootstrap(df.repartition(5), "doc_id", 20).collect()}
    assert sorted(got) == list(range(20))
    for rep in (0, 7, 8, 19):
        cells = Counter()
        for i, y, p in rows:
            digest = hashlib.md5(f"{i}:7:{rep // 8}".encode()).hexdigest()
            bits = int(digest[4 * (rep % 8):4 * (rep % 8) + 4], 16)
            cells[y, p] += sum(bits >= t for t in met.POISSON)
        table = spark.createDataFrame([(y, p, n) for (y, p), n in cells.items() if n], "label double, prediction double, n long")
        want = met.summary(None, cells=table).first()
        for m in ("accuracy", "macro_f1", "weighted_f1"):
            assert abs(got[rep][m] - want[m]) < 1e-12


def test_draws_are_poisson_and_intervals_hold_the_value(spark):
    mean = sum(1 - t / 65536 for t in met.POISSON)
    assert abs(mean - 1) < 1e-3
    df, _ = predictions(spark)
    own = met.summary(df).first()
    for r in met.intervals(met.bootstrap(df, "doc_id", 200)).collect():
        assert r["low"] < own[r["metric"]] < r["high"] and r["high"] - r["low"] < 0.2


def test_the_check_rides_on_one_scan(spark):
    df = spark.createDataFrame([(i, ["a"], "x" if i % 2 else "y") for i in range(50)], "doc_id long, tokens array<string>, lang string")
    prep = mdl.prepare_training(df, "doc_id", "lang")
    assert prep.observed["n_rows"] == 50 and prep.observed["null_keys"] == prep.observed["null_classes"] == 0
    plan = tables.load_facts(df, "doc_id", "lang")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    bad = spark.createDataFrame([(1, None), (1, "x"), (None, "x"), (None, None)], "doc_id long, lang string")
    assert tables.load_facts(bad, "doc_id", "lang").select("n_rows", "null_keys", "duplicate_keys", "null_classes").first() == (4, 2, 1, 2)
    assert tables.load_facts(bad.limit(0), "doc_id", "lang").first() == (0, 0, 0, 0, 0)


def test_bad_tables_fail_plainly(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], None), (2, ["a"], "x")], "doc_id long, tokens array<string>, lang string")
    with pytest.raises(ValueError, match="1 of 2 rows have no 'lang'"):
        mdl.prepare_training(df, "doc_id", "lang")
    with pytest.raises(ValueError, match="null keys"):
        mdl.prepare_training(df.withColumn("doc_id", F.lit(None).cast("long")), "doc_id", "lang")
    spark.createDataFrame([("1", "t")], "doc_id string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    with pytest.raises(ValueError, match="doc_id is string, not bigint, lang is missing"):
        tables.documents(spark, str(tmp_path))


def test_key_hash_sum_ignores_order(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    sums = {tables.load_facts(part, "doc_id").first()["key_hash_sum"] for part in (df, df.repartition(9).orderBy(F.desc("doc_id")))}
    assert len(sums) == 1 and sums != {tables.load_facts(df.where("doc_id > 0"), "doc_id").first()["key_hash_sum"]}


BAGS = [(0, ["a", "b", "a"]), (1, ["b", "c"]), (2, None), (3, []), (4, ["a"] * 5 + ["ü", "日本", ""])]


def test_hashed_names(spark):
    df = spark.createDataFrame(BAGS, "doc_id long, tokens array<string>")
    for size in (3, 1 << 20):
        tf = st.hashing_tf("tokens", "tf", size)
        names = {r["idx"]: r for r in feat.hashed_names(df, "tokens", size).collect()}
        total = Counter()
        for r in tf.transform(df.where("tokens is not null")).collect():
            total.update({int(i): v for i, v in zip(r["tf"].indices, r["tf"].values)})
        assert {i: r["n_all"] for i, r in names.items()} == dict(total)
        assert sum(r["n_tokens"] for r in names.values()) == 6
    assert all(r["n_tokens"] == 1 and r["token_count"] == r["n_all"] for r in names.values())


def test_count_vector_rows_equal_the_vectorizer(spark):
    df = spark.createDataFrame(BAGS, "doc_id long, tokens array<string>")
    model = st.count_vectorizer_from(df, "tokens")
    want = {(r["doc_id"], int(i), int(v)) for r in model.transform(df.where("tokens is not null")).collect() for i, v in zip(r["features"].indices, r["features"].values)}
    assert {tuple(r) for r in feat.count_vector_rows(df, "doc_id").collect()} == want
    assert {tuple(r) for r in feat.count_vector_rows(df, "doc_id", from_idx=2).collect()} == {w for w in want if w[1] >= 2}


def test_a_token_in_every_bag(spark):
    rows = [(i, ["every", f"own{i}", "every"]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    hot = {tuple(r) for r in feat.tfidf_terms(df, "doc_id", share=50).collect()}
    assert hot == {tuple(r) for r in feat.tfidf_terms(df, "doc_id", share=1).collect()} and len(hot) == 800
    # what is left for the shuffle has no token above its share of the rows
    rest = df.select(F.explode(F.array_distinct("tokens")).alias("token")).where("token <> 'every'")
    assert rest.groupBy("token").count().agg(F.max("count")).first()[0] * 50 <= 800
