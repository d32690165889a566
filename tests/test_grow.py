"""Forests grown on wide sparse features, against plain computations and MLlib's own fit."""
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors

from bagwise.plans import grow
from bagwise.plans import models as mdl


def wide(spark, n=150, size=5000, seed=0):
    """Rows of a few of many features with counts, one of them in all rows and with more values than bins."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        at = np.unique(np.concatenate([[7], rng.integers(0, 60, 12), rng.integers(60, size, 5)]))
        value = rng.integers(1, 5, len(at)).astype(float)
        value[at == 7] = i + 1
        label = float(value[at < 30].sum() % 7 > 3) + float(rng.random() < 0.2)
        rows.append((i, label, float(1 + rng.random()), Vectors.sparse(size, at.tolist(), value.tolist())))
    rows.append((n, 0.0, 1.5, Vectors.sparse(size, [], [])))
    return spark.createDataFrame(rows, ["doc_id", "label", "weight", "features"]).repartition(3)


def saved(spark, model, path):
    """The nodes (tree, number) of a model as it is saved."""
    model.write().save(str(path))
    return {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in spark.read.parquet(f"{path}/data").collect()}


@pytest.mark.parametrize("n,m", [(4097, 65), (1 << 13, 91), (10000, 100), (70, 70)])
def test_draws_are_distinct_and_known_from_both_sides(n, m):
    draws, nodes = grow.Draws(n, m, 42), np.array([0, 5, 123456])
    got = draws.of(nodes)
    assert got.shape == (3, m) and got.max() < n and all(len(set(x)) == m for x in got.tolist())
    every = draws.has(nodes, np.full(3, n), np.tile(np.arange(n), 3)).reshape(3, n)
    assert all(set(np.flatnonzero(a)) == set(b) for a, b in zip(every, got.tolist()))
    if m < n:
        assert len({tuple(sorted(x)) for x in got.tolist()}) == 3
        often = np.bincount(draws.of(np.arange(3000)).ravel(), minlength=n)   # each feature about equally often
        assert abs(often.std() / np.sqrt(3000 * m / n) - 1) < 0.1


def test_one_tree_is_that_of_mllib(spark, tmp_path):
    df = wide(spark)
    one = mdl.random_forest(1, 5).setBootstrap(False)
    assert grow.is_wide(one, df)
    want, got = saved(spark, one.fit(df), tmp_path / "mllib"), saved(spark, grow.fit(one, df), tmp_path / "own")
    assert got.keys() == want.keys() and len(got) > 15
    for node, r in got.items():
        assert all(r[c] == want[node][c] for c in ("leftChild", "rightChild", "rawCount", "prediction")) and r["split"][0] == want[node]["split"][0]
        assert all(np.allclose(r[c], want[node][c]) for c in ("impurityStats", "gain", "impurity"))
        assert np.allclose(r["split"][1], want[node]["split"][1])


def test_less_depth_is_the_upper_part(spark, tmp_path):
    df = wide(spark, 400)
    of_one = grow.fit_depths(mdl.random_forest(9, 5), df, [2, 5])
    for depth, model in zip((2, 5), of_one):
        assert max(t.depth for t in model.trees) <= depth and model.getNumTrees == 9 and model.getMaxDepth() == depth
    alone = grow.fit(mdl.random_forest(9, 2), df)
    assert of_one[0].toDebugString.partition("\n")[2] == alone.toDebugString.partition("\n")[2]
    roots = [r for (_, n), r in saved(spark, of_one[1], tmp_path / "m").items() if n == 0]
    assert len({tuple(r["impurityStats"]) for r in roots}) > 1 and all(300 < r["rawCount"] < 500 for r in roots)   # other draws of the rows in each
    assert of_one[1].transform(df).where("prediction in (0, 1, 2)").count() == 401


@pytest.mark.parametrize("m", [3, 20, 200])
def test_hits_are_the_drawn_features_of_each_rows_node(monkeypatch, m):
    """Whether by a node's rows (3 rows and many drawn) or by its features' rows, in whatever parts."""
    monkeypatch.setattr(grow, "CELLS", 70)
    rng, size, rows = np.random.default_rng(3), 400, 50
    at = [np.sort(rng.choice(size, 30, replace=False)) for _ in range(rows)] + [np.array([], int)]
    block = {"ptr": np.cumsum([0] + [len(a) for a in at]), "feature": np.concatenate(at), "bin": np.ones(30 * rows, np.uint8), "label": np.zeros(rows + 1, int),
             "weight": np.ones(rows + 1), "row": np.tile(np.arange(rows + 1), 2), "node": np.repeat([0, 1], rows + 1), "times": np.full(2 * rows + 2, 2, np.uint8)}
    f = int(at[0][3])
    nodes = grow.Grown(size, np.array([0, 1, 0, 0]), np.array([0, 0, 1, 1]), np.array([f, -1, -1, -1]), np.array([0, -1, -1, -1]), np.array([2, -1, -1, -1]),
                       np.zeros(4), np.ones((4, 2)), np.ones((4, 2), int), np.arange(size + 1), np.full(size, 0.5))
    draws = grow.Draws(size, m, 1)
    got = [tuple(map(int, x)) for part in grow.Level(0, nodes, np.array([1, 2, 3]), draws).hits(block) for x in zip(*part)]
    drawn = {k: set(x) for k, x in enumerate(draws.of(np.arange(4)).tolist())}
    want = [(k, int(x), 1, r, 2) for r, a in enumerate(at) for k in (1, 3 if f in a else 2) for x in a if x in drawn[k]]
    assert sorted(got) == sorted(want) and want


def test_wide_forests_are_not_fitted_on_long_arrays(spark, monkeypatch):
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: pytest.fail("an array of all features for each row"))
    rows = [(i, "ab"[i % 3 == 0], [f"t{i % 7}", *(f"u{i}x{k}" for k in range(20)), "b" if i % 3 == 0 else "a"]) for i in range(300)]
    prep = mdl.prepare_training(spark.createDataFrame(rows, "doc_id long, lang string, tokens array<string>"), "doc_id", "lang")
    model = mdl.fit(mdl.build_pipeline(mdl.FEATURES_COUNTS, mdl.random_forest(30, 3), prep.train, "lang", "tokens"), prep.train)
    assert model.stages[-1].numFeatures > grow.WIDE and model.stages[-1].numClasses == 2
    assert mdl.evaluate(model, prep.train).first()["n_rows"] == prep.train.count()


def test_negative_values_are_left_to_mllib(spark):
    df = wide(spark, 40).unionByName(spark.createDataFrame([(99, 0.0, 1.0, Vectors.sparse(5000, [3], [-1.0]))], ["doc_id", "label", "weight", "features"]))
    assert grow.fit(mdl.random_forest(2, 3), df).getNumTrees == 2
