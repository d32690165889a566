"""Model smoke tests (L1-L6, B1-B2, I1-I3, M7, G1-G4): properties, not scores."""
import pytest
from pyspark.sql import functions as F

from bagwise.plans import catalog
from bagwise.plans import explain as xp
from bagwise.plans import forest as fo
from bagwise.plans import models as mdl
from bagwise.plans import tuning
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def prep(spark):
    return mdl.prepare_training(catalog.doc_bags(spark, SF_SMALL), "doc_id", "lang")


def _majority_share(prep):
    counts = [r["count"] for r in prep.valid.groupBy("lang").count().collect()]
    return max(counts) / sum(counts)


def test_prepared_tables(prep):
    assert prep.train_all.count() + prep.valid.count() == 200
    assert prep.train.count() <= prep.train_all.count()
    assert prep.train.where(F.col("weight") <= 0).count() == 0


def test_rf_counts_beats_majority(prep):
    rf = mdl.random_forest(10, 5, "weight", seed=1)
    model = mdl.fit(mdl.build_pipeline(mdl.FEATURES_COUNTS, rf, prep.train, "lang",
                                       "tokens", vocab_size=500), prep.train)
    rep = {r["split"]: r for r in mdl.evaluate_splits(model, prep).collect()}
    assert rep["valid"]["accuracy"] > _majority_share(prep)
    s = xp.importance_sum(model).first()
    assert abs(s["importance_sum"] - 1.0) < 1e-9 and s["n_features"] == 500
    top = xp.top_importances(model, 5).collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    assert all(r["feature"] is not None for r in top)


def test_lr_tfidf_and_scoring(spark, prep):
    lr = mdl.logistic_regression(max_iter=10)
    model = mdl.fit(mdl.build_pipeline(mdl.FEATURES_TFIDF, lr, prep.train_all, "lang",
                                       "tokens", num_features=1000), prep.train_all)
    assert 0.0 < mdl.training_accuracy(model) <= 1.0
    unl = catalog.doc_bags(spark, SF_SMALL).drop("lang")
    scored = mdl.score(model, unl, "doc_id")
    assert scored.count() == 200
    labels = set(model.stages[0].labels)
    assert {r[0] for r in scored.select("predicted_class").distinct().collect()} <= labels


def test_word2vec_forest_and_synonyms(prep):
    rf = mdl.random_forest(5, 4, "weight", seed=1)
    pipe = mdl.build_pipeline(mdl.FEATURES_W2V, rf, prep.train, "lang", "tokens",
                              w2v=dict(vector_size=8, min_count=1, window_size=3, max_iter=1))
    model = mdl.fit(pipe, prep.train)
    assert mdl.evaluate(model, prep.valid).first()["n_rows"] == prep.valid.count()
    syn = xp.synonyms(model, "the", 3).collect()
    assert len(syn) == 3 and all(r["word"] != "the" for r in syn)


def test_depth_sweep_and_grid(prep):
    sweep = tuning.depth_sweep(prep, mdl.FEATURES_COUNTS, (2, 3), 5, vocab_size=200).collect()
    assert [r["max_depth"] for r in sweep] == [2, 3]
    g = tuning.grid_search_rf(prep, (2, 3), 5, vocab_size=200, n_folds=2,
                              parallelism=2).collect()
    assert len(g) == 2 and sum(r["is_best"] for r in g) >= 1


def test_depth_limit():
    with pytest.raises(ValueError):
        mdl.random_forest(1, 31)


def test_no_class_that_no_row_has(prep):
    n = len({r[0] for r in prep.train.select("lang").distinct().collect()})
    for kind, classifier in ((mdl.FEATURES_TFIDF, mdl.logistic_regression(max_iter=3)),
                             (mdl.FEATURES_COUNTS, mdl.random_forest(2, 2, "weight", seed=1))):
        model = mdl.fit(mdl.build_pipeline(kind, classifier, prep.train, "lang", "tokens"), prep.train)
        assert model.stages[-1].numClasses == n == len(mdl.indexer_of(model).labels)
    two = prep.train.where(F.col("lang").isin("en", "fr"))
    model = mdl.fit(mdl.build_pipeline(mdl.FEATURES_TFIDF, mdl.logistic_regression(max_iter=3), two, "lang", "tokens"), two)
    assert model.stages[-1].numClasses == 2 and model.stages[-1].coefficientMatrix.numRows == 1
    # classes that the fit hasn't seen count as wrong
    assert mdl.evaluate(model, prep.train).first()["n_rows"] == prep.train.count()


def test_fold_vocabulary_has_no_held_out_token(spark):
    train = spark.createDataFrame([(["a", "b"],), (["b"],)], "tokens array<string>")
    assert set(tuning.fold_vectorizer(train, "tokens").vocabulary) == {"a", "b"}


def test_reference_grids_share_features(prep):
    g = tuning.grid_search_lr(prep, (50, 100), (0.1, 0.01), max_iter=3, n_folds=2).collect()
    assert {(r["num_features"], r["reg_param"]) for r in g} == {(50, 0.1), (50, 0.01), (100, 0.1), (100, 0.01)}
    assert all(0 <= r["mean_accuracy"] <= 1 for r in g)


def test_bounded_fits_score_all_rows(spark, prep, monkeypatch):
    scored, drawn = [], []
    summary, fit_rows = mdl.evaluate, mdl.fit_rows
    monkeypatch.setattr(mdl, "evaluate", lambda model, df: scored.append(df.count()) or summary(model, df))
    monkeypatch.setattr(mdl, "fit_rows", lambda df, rows, *a: drawn.append((df.count(), rows)) or fit_rows(df, rows, *a))
    from bagwise.plans import registry
    monkeypatch.setattr(registry, "prepared", lambda *a: prep)
    monkeypatch.setattr(registry, "FIT_ROWS", 30)
    monkeypatch.setattr(registry, "SWEEP_DEPTHS", (2,))
    monkeypatch.setattr(registry, "GRID_RF_DEPTHS", (2,))
    registry.q_depth_sweep(spark, SF_SMALL)
    assert scored == [prep.train_all.count(), prep.valid.count()]
    registry.q_grid_search_rf(spark, SF_SMALL)
    assert drawn[0] == (prep.train.count(), 30)
    assert sum(n for n, _ in drawn[1:]) == 2 * prep.train.count()  # each row in two of three folds


def test_fit_rows_have_every_class(spark):
    df = spark.createDataFrame([(i, "rare" if i == 7 else "common") for i in range(400)], "doc_id long, lang string")
    got = mdl.fit_rows(df, 20, "lang", "doc_id")
    assert got.columns == df.columns and {r[0]: r[1] for r in got.groupBy("lang").count().collect()} == {"rare": 1, "common": 20}
    assert mdl.fit_rows(df, 1000, "lang", "doc_id").count() == 400


def test_features_of_bounded_fits_are_of_all_rows(spark, prep, monkeypatch):
    from bagwise.plans import registry, stages
    monkeypatch.setattr(registry, "prepared", lambda *a: prep)
    monkeypatch.setattr(registry, "FIT_ROWS", 20)
    monkeypatch.setattr(registry, "_memo", {})
    monkeypatch.setattr(stages, "W2V_LR", dict(vector_size=4, min_count=1, window_size=2, max_iter=1))
    every = {r[0] for r in prep.train.select(F.explode("tokens")).distinct().collect()}
    assert set(registry.rf_counts_model(spark, SF_SMALL).stages[1].vocabulary) == every
    assert registry.rf_tfidf_model(spark, SF_SMALL).stages[2].numDocs == prep.train.count()
    words = {r[0] for r in registry.lr_w2v_model(spark, SF_SMALL).stages[1].getVectors().select("word").collect()}
    assert words == {r[0] for r in prep.train_all.select(F.explode("tokens")).distinct().collect()}


def test_fit_rows_are_drawn_by_their_keys(spark, monkeypatch):
    df = spark.createDataFrame([(i, "ab"[i % 5 == 0], [f"t{i}"]) for i in range(400)], "doc_id long, lang string, tokens array<string>")
    written = []
    materialize = mdl.materialize
    monkeypatch.setattr(mdl, "materialize", lambda df, *a: written.append(df.columns) or materialize(df, *a))
    got = mdl.fit_rows(df, 20, "lang", "doc_id")
    assert written == [["doc_id"], ["doc_id", "lang", "tokens"]]   # the bags of the drawn rows alone
    assert got.columns == df.columns and got.groupBy("lang").count().collect() and got.count() == 20


def test_hashed_counts_are_written_once(spark, prep, monkeypatch):
    written = []
    materialize = mdl.materialize
    monkeypatch.setattr(mdl, "materialize", lambda df, *a: written.append(df.columns) or materialize(df, *a))
    pipe = mdl.build_pipeline(mdl.FEATURES_TFIDF, mdl.logistic_regression(max_iter=5), prep.train_all, "lang", "tokens", num_features=500)
    model = mdl.fit(pipe, prep.train_all)
    assert written == [["doc_id", "lang", "label", "tf"]]
    plain = pipe.fit(prep.train_all)
    assert abs(mdl.training_accuracy(model) - mdl.training_accuracy(plain)) < 1e-9
    assert abs(model.stages[-1].coefficientMatrix.toArray() - plain.stages[-1].coefficientMatrix.toArray()).max() < 1e-6


def test_sweep_makes_the_features_once(spark, prep, monkeypatch):
    args = (mdl.FEATURES_COUNTS, mdl.random_forest(5, 3, "weight", 42), prep.train, "lang", "tokens")
    front = mdl.fit(mdl.Pipeline(stages=mdl.build_pipeline(*args, vocab_size=200).getStages()[:-1]), prep.train)
    feats = tuning.materialize(front.transform(prep.train))
    want = []
    for depth in (3, 4):
        model = mdl.PipelineModel(stages=front.stages + [mdl.random_forest(5, depth, "weight", 42).fit(feats)])
        want.append({r["split"]: r["macro_f1"] for r in mdl.evaluate_splits(model, prep).collect()})
    monkeypatch.setattr(mdl, "evaluate_splits", lambda *a: pytest.fail("features for each depth"))
    got = tuning.depth_sweep(prep, mdl.FEATURES_COUNTS, (3, 4), 5, vocab_size=200).collect()
    assert [r["max_depth"] for r in got] == [3, 4]
    for row, scores in zip(got, want):
        assert abs(row["train_macro_f1"] - scores["train"]) < 1e-12 and abs(row["valid_macro_f1"] - scores["valid"]) < 1e-12


def test_grid_hashes_all_bags_in_one_pass(spark, prep, monkeypatch):
    written = []
    materialize = tuning.materialize
    monkeypatch.setattr(tuning, "materialize", lambda df, name: written.append((name, df.columns)) or materialize(df, name))
    tuning.grid_search_lr(prep, (50, 100), (0.1,), max_iter=2, n_folds=2)
    assert written[1:] == [("hashed", ["label", "fold", "tf_50", "tf_100"])]


def test_forests_see_all_training_rows(spark, monkeypatch):
    """Every registered forest: its trees' roots hold the whole training table, drawn with replacement."""
    from bagwise.plans import registry
    rows = [(i, "ab"[i % 3 == 0], [f"t{i % 7}", f"u{i}", "b" if i % 3 == 0 else "a"]) for i in range(1500)]
    small = mdl.prepare_training(spark.createDataFrame(rows, "doc_id long, lang string, tokens array<string>"), "doc_id", "lang")
    assert small.train.count() == 1200
    fitted, forest = [], mdl.random_forest
    monkeypatch.setattr(mdl, "random_forest", lambda num_trees=3, max_depth=2, *a, **k: forest(3, 2, *a, **k))
    monkeypatch.setattr(registry, "prepared", lambda *a: small)
    monkeypatch.setattr(registry, "prepared_quality", lambda *a: small)
    monkeypatch.setattr(registry, "_memo", {})
    monkeypatch.setattr(registry.st, "W2V_RF", dict(vector_size=4, min_count=1, window_size=2, max_iter=1))
    monkeypatch.setattr(registry.st, "COOC", dict(dims=4, window=2, min_count=2, rounds=2))
    for make in (registry.rf_counts_model, registry.rf_tfidf_model, registry.rf_w2v_model, registry.rf_cooc_model, registry.rf_quality_model):
        fitted.append(make(spark, SF_SMALL).stages[-1])
    for model in fitted:
        roots = fo.node_table(model).where("depth = 0").select("raw_count").collect()
        assert len(roots) == 3 and all(1000 < r[0] < 1400 for r in roots)


def test_sweeps_and_grid_fit_all_training_rows(spark, prep, monkeypatch):
    from bagwise.plans import registry
    drawn, fit_rows = [], mdl.fit_rows
    monkeypatch.setattr(mdl, "fit_rows", lambda df, rows, *a: drawn.append(rows) or fit_rows(df, rows, *a))
    monkeypatch.setattr(registry, "prepared", lambda *a: prep)
    monkeypatch.setattr(registry.st, "W2V_RF", dict(vector_size=4, min_count=1, window_size=2, max_iter=1))
    for depths in ("SWEEP_DEPTHS", "SWEEP_TFIDF_DEPTHS", "SWEEP_W2V_DEPTHS", "GRID_RF_DEPTHS"):
        monkeypatch.setattr(registry, depths, (1,))
    for query in (registry.q_depth_sweep, registry.q_depth_sweep_tfidf, registry.q_depth_sweep_w2v, registry.q_grid_search_rf):
        query(spark, SF_SMALL)
    assert len(drawn) == 6 and not any(drawn)
