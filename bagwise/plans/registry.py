"""Registered model, tuning, explanation and scoring queries.

The task mirrors the reference's job on the documents table: class `lang`,
bag = word tokens of `text`, key `doc_id`, exact stratified 80/20 split,
duplicate bags dropped, class weights.

Forests, their grid and their sweeps have the reference's settings (100 trees,
its depths, the whole vocabulary). Every model is fitted on all training rows:
`FIT_ROWS` is there for trials on fewer, of each class its share by a hash of
the key. Scores and metrics always cover all rows. Facts of the fitted
objects that SQL can state are in `facts.py`.
"""

from __future__ import annotations

from pyspark.ml.feature import Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagwise.operators.nearest import nearest_tokens
from bagwise.operators.profile import top_tokens
from bagwise.plans import catalog
from bagwise.plans import explain as xp
from bagwise.plans import forest as fo
from bagwise.plans import models as mdl
from bagwise.plans import stages as st
from bagwise.plans import tuning
from bagwise.session import forget_on_release
from bagwise.sources import tables

# Fixed parameters of the registered model queries.
FIT_ROWS = None             # labelled rows of a forest's fit; None: all
SWEEP_DEPTHS = (18, 20, 22, 24, 26, 28, 30)
SWEEP_TFIDF_DEPTHS = (28, 30)
SWEEP_W2V_DEPTHS = (10, 12, 14)
W2V_DEPTH = 12
GRID_RF_DEPTHS = (26, 28, 30)
GRID_LR_FEATURES = (7000, 10000, 20000)
GRID_LR_REG = (0.1, 0.05, 0.01, 0.005)
TOP_IMPORTANCES = 10
N_SYNONYMS = 10
TREE_DEPTH = 5

_memo: dict = forget_on_release({})  # fitted models read materialized tables


def _key(spark: SparkSession, sf_dir: str, name: str):
    return (spark.sparkContext.applicationId, sf_dir, name)


def _cached(spark, sf_dir, name, make):
    k = _key(spark, sf_dir, name)
    if k not in _memo:
        _memo[k] = make()
    return _memo[k]


def prepared(spark: SparkSession, sf_dir: str) -> mdl.Prepared:
    return _cached(spark, sf_dir, "prepared", lambda: mdl.prepare_training(
        catalog.doc_bags(spark, sf_dir), "doc_id", "lang", "tokens",
        catalog.TEST_FRACTION, catalog.SPLIT_SEED))


def prepared_quality(spark: SparkSession, sf_dir: str) -> mdl.Prepared:
    """The imbalanced two-class task: documents joined to labels.quality."""
    def make():
        lab = tables.labels(spark, sf_dir).select("doc_id", "quality")
        bags = catalog.doc_bags(spark, sf_dir).join(lab, "doc_id").drop("lang")
        return mdl.prepare_training(bags, "doc_id", "quality", "tokens",
                                    catalog.TEST_FRACTION, catalog.SPLIT_SEED)
    return _cached(spark, sf_dir, "prepared_quality", make)


def _fit(spark, sf_dir, kind, classifier, train_attr="train", task=None, rows=None, **fkw):
    prep = (task or prepared)(spark, sf_dir)
    train = getattr(prep, train_attr)
    pipe = mdl.build_pipeline(kind, classifier, train, prep.class_col, "tokens", **fkw)
    own = mdl.fit_rows(train, rows, prep.class_col, prep.key, catalog.SPLIT_SEED) if rows else None
    return mdl.fit(pipe, train, own)


def lr_tfidf_model(spark, sf_dir):
    # the reference's logistic-regression notebook used neither dedup nor weights
    return _cached(spark, sf_dir, "lr_tfidf", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_TFIDF, mdl.logistic_regression(), "train_all",
        num_features=st.TFIDF_NUM_FEATURES))


def lr_w2v_model(spark, sf_dir):
    return _cached(spark, sf_dir, "lr_w2v", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_W2V, mdl.logistic_regression(), "train_all",
        w2v=st.W2V_LR))


def rf_counts_model(spark, sf_dir):
    return _cached(spark, sf_dir, "rf_counts", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_COUNTS, mdl.random_forest(), rows=FIT_ROWS))


def rf_counts_reference_model(spark, sf_dir):
    # the reference's final model: 100 trees of depth 30 on the whole
    # vocabulary (defaults of plans.stages)
    return _cached(spark, sf_dir, "rf_counts_reference", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_COUNTS,
        mdl.random_forest(st.RF_NUM_TREES, st.RF_MAX_DEPTH)))


def tree_presence(spark, sf_dir):
    """(names, nodes): one tree on token presence, its root can be computed from the table; and the class names."""
    def make():
        prep = prepared(spark, sf_dir)
        indexer = st.label_indexer(prep.class_col, "label").fit(prep.train)
        names = list(indexer.labels)
        return names, fo.presence_tree(indexer.transform(prep.train), len(names), TREE_DEPTH)
    return _cached(spark, sf_dir, "tree_presence", make)


def rf_tfidf_model(spark, sf_dir):
    return _cached(spark, sf_dir, "rf_tfidf", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_TFIDF, mdl.random_forest(), rows=FIT_ROWS,
        num_features=st.TFIDF_RF_NUM_FEATURES))


def rf_w2v_model(spark, sf_dir):
    return _cached(spark, sf_dir, "rf_w2v", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_W2V, mdl.random_forest(max_depth=W2V_DEPTH),
        rows=FIT_ROWS, w2v=st.W2V_RF))


def lr_cooc_model(spark, sf_dir):
    return _cached(spark, sf_dir, "lr_cooc", lambda: _fit(spark, sf_dir, mdl.FEATURES_COOC, mdl.logistic_regression(), "train_all"))


def rf_cooc_model(spark, sf_dir):
    return _cached(spark, sf_dir, "rf_cooc", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_COOC, mdl.random_forest(max_depth=W2V_DEPTH), rows=FIT_ROWS))


def rf_quality_model(spark, sf_dir):
    return _cached(spark, sf_dir, "rf_quality", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_COUNTS, mdl.random_forest(),
        task=prepared_quality, rows=FIT_ROWS))


def _report(spark, sf_dir, make_model, name, task=None) -> DataFrame:
    model = make_model(spark, sf_dir)
    return (mdl.evaluate_splits(model, (task or prepared)(spark, sf_dir))
            .withColumn("model", F.lit(name)))


def lr_quality_model(spark, sf_dir):
    # two classes: family 'auto' fits the binomial model
    return _cached(spark, sf_dir, "lr_quality", lambda: _fit(
        spark, sf_dir, mdl.FEATURES_TFIDF, mdl.logistic_regression(), "train_all",
        task=prepared_quality, num_features=st.TFIDF_NUM_FEATURES))


def q_model_lr_quality(spark, sf_dir):
    return _report(spark, sf_dir, lr_quality_model, "lr_quality", prepared_quality)


def q_model_rf_quality(spark, sf_dir):
    return _report(spark, sf_dir, rf_quality_model, "rf_quality", prepared_quality)


def _valid_predictions(spark, sf_dir):
    model = rf_counts_model(spark, sf_dir)
    return model, model.transform(prepared(spark, sf_dir).valid)


def q_model_per_class(spark, sf_dir):
    """E3 for the forest on the validation rows, with class names."""
    from bagwise.operators import metrics as met
    model, pred = _valid_predictions(spark, sf_dir)
    names = list(mdl.indexer_of(model).labels)
    name_t = spark.createDataFrame([(float(i), n) for i, n in enumerate(names)],
                                   "label double, class string")
    return met.per_class(pred).join(F.broadcast(name_t), "label", "left")


def q_model_confusion(spark, sf_dir):
    """E6 for the forest on the validation rows: every class is a column."""
    from bagwise.operators import metrics as met
    model, pred = _valid_predictions(spark, sf_dir)
    n = len(mdl.indexer_of(model).labels)
    return met.confusion_matrix(pred, classes=[float(i) for i in range(n)])


def q_model_lr_tfidf(spark, sf_dir):
    return _report(spark, sf_dir, lr_tfidf_model, "lr_tfidf")


def q_model_lr_w2v(spark, sf_dir):
    return _report(spark, sf_dir, lr_w2v_model, "lr_w2v")


def q_model_rf_counts(spark, sf_dir):
    return _report(spark, sf_dir, rf_counts_model, "rf_counts")


def q_model_rf_counts_reference(spark, sf_dir):
    return _report(spark, sf_dir, rf_counts_reference_model, "rf_counts_reference")


def q_model_rf_tfidf(spark, sf_dir):
    return _report(spark, sf_dir, rf_tfidf_model, "rf_tfidf")


def q_model_rf_w2v(spark, sf_dir):
    return _report(spark, sf_dir, rf_w2v_model, "rf_w2v")


def q_model_lr_cooc(spark, sf_dir):
    return _report(spark, sf_dir, lr_cooc_model, "lr_cooc")


def q_model_rf_cooc(spark, sf_dir):
    return _report(spark, sf_dir, rf_cooc_model, "rf_cooc")


def q_nearest_tokens(spark, sf_dir):
    """M7 for every token: the nearest by the embeddings of the training bags."""
    model = lr_cooc_model(spark, sf_dir)
    vectors = xp.stage_of(model, Word2VecModel).getVectors().select(F.col("word").alias("token"), vector_to_array("vector").alias("vector"))
    return nearest_tokens(vectors, N_SYNONYMS)


def q_lr_summary_accuracy(spark, sf_dir):
    acc = mdl.training_accuracy(lr_tfidf_model(spark, sf_dir))
    return spark.createDataFrame([(float(acc),)], "summary_accuracy double")


def q_score_unlabeled(spark, sf_dir):
    from bagwise.functions.tokens import word_tokens
    from bagwise.session import spread
    unl = spread(tables.unlabeled_documents(spark, sf_dir), "doc_id")
    bags = unl.select("doc_id", word_tokens("text").alias("tokens"))
    return mdl.score(rf_counts_model(spark, sf_dir), bags, "doc_id")


def q_importances_top(spark, sf_dir):
    return xp.top_importances(rf_counts_model(spark, sf_dir), TOP_IMPORTANCES)


def q_hashed_importances(spark, sf_dir):
    return xp.hashed_importances(rf_tfidf_model(spark, sf_dir), prepared(spark, sf_dir).train, "tokens", TOP_IMPORTANCES)


def q_importances_sum(spark, sf_dir):
    return xp.importance_sum(rf_counts_model(spark, sf_dir))


def q_synonyms(spark, sf_dir):
    model = lr_w2v_model(spark, sf_dir)
    word = top_tokens(prepared(spark, sf_dir).train_all, 1).collect()[0]["token"]
    return xp.synonyms(model, word, N_SYNONYMS).withColumn("query_word", F.lit(word))


def q_grid_search_lr(spark, sf_dir):
    return tuning.grid_search_lr(prepared(spark, sf_dir), GRID_LR_FEATURES, GRID_LR_REG,
                                 n_folds=2, parallelism=8)


def q_grid_search_rf(spark, sf_dir):
    return tuning.grid_search_rf(prepared(spark, sf_dir), GRID_RF_DEPTHS, n_folds=3, rows=FIT_ROWS)


def q_depth_sweep(spark, sf_dir):
    return tuning.depth_sweep(prepared(spark, sf_dir), mdl.FEATURES_COUNTS, SWEEP_DEPTHS, rows=FIT_ROWS)


def q_depth_sweep_tfidf(spark, sf_dir):
    return tuning.depth_sweep(prepared(spark, sf_dir), mdl.FEATURES_TFIDF, SWEEP_TFIDF_DEPTHS, rows=FIT_ROWS,
                              num_features=st.TFIDF_RF_NUM_FEATURES)


def q_depth_sweep_w2v(spark, sf_dir):
    return tuning.depth_sweep(prepared(spark, sf_dir), mdl.FEATURES_W2V, SWEEP_W2V_DEPTHS, rows=FIT_ROWS, w2v=st.W2V_RF)


def forest_nodes(spark, sf_dir):
    """The count forest's nodes as a table, written once."""
    return _cached(spark, sf_dir, "forest_nodes", lambda: fo.node_table(rf_counts_model(spark, sf_dir)))


def q_depth_sweep_truncated(spark, sf_dir):
    return tuning.depth_sweep_truncated(prepared(spark, sf_dir), rf_counts_model(spark, sf_dir), SWEEP_DEPTHS)


MODEL_QUERIES = {
    "model_lr_tfidf": q_model_lr_tfidf,
    "model_lr_w2v": q_model_lr_w2v,
    "model_rf_counts": q_model_rf_counts,
    "model_rf_counts_reference": q_model_rf_counts_reference,
    "model_rf_tfidf": q_model_rf_tfidf,
    "model_rf_w2v": q_model_rf_w2v,
    "model_rf_quality": q_model_rf_quality,
    "model_lr_quality": q_model_lr_quality,
    "model_per_class": q_model_per_class,
    "model_confusion": q_model_confusion,
    "lr_summary_accuracy": q_lr_summary_accuracy,
    "score_unlabeled": q_score_unlabeled,
    "importances_top": q_importances_top,
    "hashed_importances": q_hashed_importances,
    "importances_sum": q_importances_sum,
    "synonyms": q_synonyms,
    "grid_search_lr": q_grid_search_lr,
    "grid_search_rf": q_grid_search_rf,
    "depth_sweep": q_depth_sweep,
    "depth_sweep_tfidf": q_depth_sweep_tfidf,
    "depth_sweep_w2v": q_depth_sweep_w2v,
    "model_lr_cooc": q_model_lr_cooc,
    "model_rf_cooc": q_model_rf_cooc,
    "nearest_tokens": q_nearest_tokens,
    "depth_sweep_truncated": q_depth_sweep_truncated,
}
