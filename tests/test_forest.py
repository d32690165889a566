"""Forests as node tables, against MLlib's own importances, votes and predictions."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from bagwise.plans import catalog
from bagwise.plans import forest as fo
from bagwise.plans import models as mdl
from bagwise.plans import tuning
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def prep(spark):
    return mdl.prepare_training(catalog.doc_bags(spark, SF_SMALL), "doc_id", "lang")


@pytest.fixture(scope="module")
def fitted(prep):
    return mdl.fit(mdl.build_pipeline(mdl.FEATURES_COUNTS, mdl.random_forest(7, 9, "weight", seed=3), prep.train, "lang", "tokens"), prep.train)


@pytest.fixture(scope="module")
def nodes(fitted):
    return fo.node_table(fitted)


def test_nodes_are_whole_trees(nodes, fitted):
    rows = {(r["tree"], r["node"]): r for r in nodes.collect()}
    assert len(rows) == fitted.stages[-1].totalNumNodes
    assert len({t for t, _ in rows}) == 7
    for (tree, node), r in rows.items():
        assert (r["left"] is None) == (r["right"] is None) == (r["feature"] is None)
        for child in filter(None, (r["left"], r["right"])):
            assert rows[tree, child]["depth"] == r["depth"] + 1
        if r["left"] is not None:  # the children share out the parent's class weights
            both = np.add(rows[tree, r["left"]]["stats"], rows[tree, r["right"]]["stats"])
            assert np.allclose(both, r["stats"])
    assert max(r["depth"] for r in rows.values()) == max(t.depth for t in fitted.stages[-1].trees)


def test_importances(nodes, fitted):
    want = fitted.stages[-1].featureImportances
    got = {r[0]: r[1] for r in fo.node_importances(nodes).collect()}
    assert set(got) == {int(i) for i in want.indices}
    assert all(abs(got[i] - want[i]) < 1e-12 for i in got)


def votes(fitted, nodes, df, depth=30):
    pred = fitted.transform(df).select("doc_id", "features", vector_to_array("rawPrediction").alias("raw"), F.col("prediction").alias("of_mllib"))
    return (fo.votes_at(nodes, pred, ["doc_id", "raw", "of_mllib"], [depth]).collect(),
            fo.predicted_at(nodes, pred, ["doc_id", "of_mllib"], [depth]).collect())


def test_votes_and_predictions(nodes, fitted, prep):
    raw, found = votes(fitted, nodes, prep.train_all)
    assert len(raw) == len(found) == prep.train_all.count()
    assert all(np.allclose(r["votes"][0], r["raw"], atol=1e-12) for r in raw)
    assert all(r["prediction"] == r["of_mllib"] for r in found)


def test_several_passes_add_up(nodes, fitted, prep, monkeypatch):
    monkeypatch.setattr(fo, "NODES_AT_ONCE", 40)
    monkeypatch.setattr(fo, "CELLS", 500)
    raw, found = votes(fitted, nodes, prep.valid)
    assert len(raw) == prep.valid.count() and all(np.allclose(r["votes"][0], r["raw"], atol=1e-12) for r in raw)


def test_dense_features(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(i % 2), [float(rng.normal(i % 2)), float(rng.normal())]) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, label double, x array<double>").withColumn("features", array_to_vector("x"))
    model = mdl.random_forest(5, 6, None, seed=1).fit(df)
    found = fo.predicted_at(fo.node_table(model), model.transform(df).withColumnRenamed("prediction", "of_mllib"), ["doc_id", "of_mllib"], [30]).collect()
    assert all(r["prediction"] == r["of_mllib"] for r in found)


def test_a_cut_is_a_partition_of_the_rows(nodes):
    by = {}
    for r in fo.level_weights(nodes, [0, 1, 2, 5, 30]).collect():
        by.setdefault((r["tree"], r["class"]), []).append(r["weight"])
    assert all(len(v) == 5 and np.allclose(v, v[0]) for v in by.values())


def test_truncated_predictions_by_a_plain_walk(nodes, fitted, prep):
    table = {(r["tree"], r["node"]): r for r in nodes.collect()}
    trees = sorted({t for t, _ in table})
    pred = fitted.transform(prep.valid).select("doc_id", "features")
    vectors = {r["doc_id"]: r["features"] for r in pred.collect()}
    found = {(r["doc_id"], r["max_depth"]): r["prediction"] for r in fo.predicted_at(nodes, pred, ["doc_id"], [0, 2, 4]).collect()}
    assert len(found) == 3 * len(vectors)
    for (doc, depth), got in found.items():
        total = 0
        for t in trees:
            r = table[t, 0]
            while r["left"] is not None and r["depth"] < depth:
                r = table[t, r["left"] if vectors[doc][r["feature"]] <= r["threshold"] else r["right"]]
            total = total + np.array(r["stats"]) / sum(r["stats"])
        assert got == float(np.argmax(total))


def test_sweep_from_one_fit(prep, fitted):
    got = {r["max_depth"]: r for r in tuning.depth_sweep_truncated(prep, fitted, (1, 3, 9)).collect()}
    own = {r["split"]: r for r in mdl.evaluate_splits(fitted, prep).collect()}
    assert set(got) == {1, 3, 9}
    for split in ("train", "valid"):
        assert abs(got[9][f"{split}_macro_f1"] - own[split]["macro_f1"]) < 1e-12
        assert abs(got[9][f"{split}_weighted_f1"] - own[split]["weighted_f1"]) < 1e-12


def test_categorical_splits_are_refused(spark):
    from pyspark.ml.feature import VectorIndexer
    df = spark.createDataFrame([(float(i % 2), [float(i % 3)]) for i in range(30)], "label double, x array<double>")
    df = df.withColumn("v", array_to_vector("x"))
    df = VectorIndexer(inputCol="v", outputCol="features", maxCategories=4).fit(df).transform(df)
    with pytest.raises(ValueError):
        fo.node_table(mdl.random_forest(2, 2, None, seed=1).fit(df))


def test_presence_tree_is_that_of_mllib(prep):
    """Node by node: MLlib's splits of a few rows come from all of them, as the table's do at any size."""
    from bagwise.plans import stages as st
    indexer = st.label_indexer("lang", "label").fit(prep.train)
    front = mdl.Pipeline(stages=[st.label_indexer("lang", "label"), st.count_vectorizer_from(prep.train, "tokens").setBinary(True),
                                 mdl.random_forest(1, 4).setBootstrap(False)])
    want = {r["node"]: r for r in fo.node_table(mdl.fit(front, prep.train)).collect()}
    got = {r["node"]: r for r in fo.presence_tree(indexer.transform(prep.train), len(indexer.labels), 4).collect()}
    assert got.keys() == want.keys() and len(got) > 3
    for node, r in got.items():
        assert all(r[c] == want[node][c] for c in ("depth", "left", "right", "feature", "threshold", "raw_count"))
        first, second = sorted(r["stats"])[:-3:-1]
        assert r["prediction"] == want[node]["prediction"] or first - second < 1e-9 * first   # classes whose weights differ in their sums' last digits
        assert np.allclose(r["stats"], want[node]["stats"]) and abs(r["impurity"] - want[node]["impurity"]) < 1e-9
        assert (r["gain"] is None) == (want[node]["gain"] is None) and (r["gain"] is None or abs(r["gain"] - want[node]["gain"]) < 1e-9)


def test_presence_tree_sees_all_rows(spark):
    """A token of two rows in 12,000 that alone parts the classes: MLlib's sample of the rows hardly has it, and its vocabulary is bounded."""
    rows = [(float(i < 2), 1.0, ["x"] * (i % 3) + (["rare"] if i < 2 else [])) for i in range(12000)] + [(0.0, 1.0, None), (0.0, 1.0, [])]
    df = spark.createDataFrame(rows, "label double, weight double, tokens array<string>")
    got = fo.presence_tree(df, 2, 3).orderBy("node").collect()
    assert len(got) == 3 and [r["raw_count"] for r in got] == [12002, 12000, 2]
    assert [r["stats"] for r in got] == [[12000.0, 2.0], [12000.0, 0.0], [0.0, 2.0]] and got[0]["feature"] == 1
    alike = spark.createDataFrame([(0.0, 1.0, ["a"]), (1.0, 1.0, ["a"])], df.schema)
    assert len(fo.presence_tree(alike, 2, 3).collect()) == 1   # nothing parts these
