"""Pipelines (L1-L6), evaluation and scoring (B1, B2).

A training run is: split (exact, stratified) -> drop duplicate bags ->
class weights -> fit a Pipeline -> evaluate on train and validation with the
DataFrame metrics. The prepared training table is materialized once
(checkpoint into the session's checkpoint folder) because every fit reads it
many times (one pass per tree level for forests, one per iteration for
logistic regression).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bagwise.functions.hashing import row_hash
from bagwise.operators import embeddings, prepare, split
from bagwise.operators import metrics as met
from bagwise.plans import grow
from bagwise.plans import stages as st
from bagwise.session import materialize

FEATURES_COUNTS = "counts"
FEATURES_TFIDF = "tfidf"
FEATURES_W2V = "w2v"
FEATURES_COOC = "cooc"      # embeddings from co-occurrence counts


@dataclass
class Prepared:
    """Train / validation tables of one labeled input."""
    train: DataFrame          # de-duplicated, weighted (column `weight`)
    valid: DataFrame
    train_all: DataFrame      # train before de-duplication
    class_col: str
    bag_col: str
    key: str
    observed: dict | None = None   # what the check of the load saw (`split.check_keys`)


def prepare_training(df: DataFrame, key: str, class_col: str,
                     bag_col: str = "tokens", test_fraction: float = 0.2,
                     seed=7, dedup: bool = True, weights: bool = True,
                     total: str = "pre_dedup") -> Prepared:
    """T2 + A10 + W1 in the reference's order.

    ``total='pre_dedup'`` counts the weight numerator before dropping
    duplicates (the reference), ``'post_dedup'`` after. Null keys, repeated
    keys and null classes fail plainly.
    """
    seen = split.check_keys(df, key, class_col, seed)
    s = split.with_split(df, key, test_fraction, seed, by=class_col, split_col="_split", checked=True)
    s = materialize(s, "split")
    train_all = s.where(F.col("_split") == "train").drop("_split")
    valid = s.where(F.col("_split") == "test").drop("_split")
    train = materialize(prepare.dedup_bags(train_all, key, bag_col), "dedup") \
        if dedup else train_all
    if weights:
        tot = train_all.count() if total == "pre_dedup" else None
        # the class table is counted from the written table, then broadcast
        train = prepare.with_class_weights(train, class_col, total=tot)
    else:
        train = train.withColumn("weight", F.lit(1.0))
    return Prepared(train, valid, train_all, class_col, bag_col, key, seen)


def feature_stages(kind: str, train: DataFrame, bag_col: str, *,
                   num_features: int = st.TFIDF_NUM_FEATURES,
                   vocab_size: int = 1 << 18, w2v: dict | None = None,
                   cooc: dict | None = None, seed: int = 42) -> list:
    """Stages turning the bag into `features` (counts, TF-IDF, word2vec or count-based embeddings)."""
    if kind == FEATURES_COUNTS:
        return [st.count_vectorizer_from(train, bag_col, "features", vocab_size)]
    if kind == FEATURES_TFIDF:
        return [st.hashing_tf(bag_col, "tf", num_features), st.idf("tf", "features")]
    if kind == FEATURES_W2V:
        return [st.word2vec(bag_col, "features", seed=seed, **(w2v or st.W2V_LR))]
    if kind == FEATURES_COOC:
        return [embeddings.embedding_model(embeddings.count_embeddings(train, bag_col, **(cooc or st.COOC)), bag_col, "features")]
    raise ValueError(f"unknown features {kind!r}")


def logistic_regression(max_iter: int = st.LR_MAX_ITER,
                        reg_param: float = st.LR_REG_PARAM,
                        weight_col: str | None = None) -> LogisticRegression:
    """L2 / L3: logistic regression (family 'auto': multinomial for more
    than two classes, as in the reference)."""
    kw = dict(featuresCol="features", labelCol="label", maxIter=max_iter,
              regParam=reg_param)
    if weight_col:
        kw["weightCol"] = weight_col
    return LogisticRegression(**kw)


def random_forest(num_trees: int = st.RF_NUM_TREES, max_depth: int = st.RF_MAX_DEPTH,
                  weight_col: str | None = "weight", seed: int = 42,
                  max_bins: int = 32) -> RandomForestClassifier:
    """Weighted random forest (MLlib caps depth at 30)."""
    if max_depth > 30:
        raise ValueError("random forest depth above 30 is not supported by MLlib")
    kw = dict(featuresCol="features", labelCol="label", numTrees=num_trees,
              maxDepth=max_depth, seed=seed, maxBins=max_bins)
    if weight_col:
        kw["weightCol"] = weight_col
    return RandomForestClassifier(**kw)


def build_pipeline(kind: str, classifier, train: DataFrame, class_col: str,
                   bag_col: str, **feature_kw) -> Pipeline:
    """L1: indexer + feature stages + classifier."""
    stages = [st.label_indexer(class_col, "label")]
    stages += feature_stages(kind, train, bag_col, **feature_kw)
    stages.append(classifier)
    return Pipeline(stages=stages)


def fit(pipeline: Pipeline, train: DataFrame, own: DataFrame | None = None) -> PipelineModel:
    """Fit, the classifier on `own` rows if given and all other stages on `train`;
    the label indexer then lets unseen classes pass (they count as wrong)."""
    *front, classifier = pipeline.getStages()
    if own is not None:
        front = Pipeline(stages=front).fit(train)
        model = PipelineModel(stages=[*front.stages, grow.fit(classifier, front.transform(own))])
    elif any(isinstance(stage, HashingTF) for stage in front):
        model = _fit_hashed(front, classifier, train)
    elif isinstance(classifier, RandomForestClassifier):
        front = Pipeline(stages=front).fit(train)
        model = PipelineModel(stages=[*front.stages, grow.fit(classifier, front.transform(train))])
    else:
        model = pipeline.fit(train)
    indexer_of(model).setHandleInvalid("keep")
    return model


def _fit_hashed(front: list, classifier, train: DataFrame) -> PipelineModel:
    """A pipeline with hashed counts: they are written once, as idf and the classifier pass over them several times."""
    fitted, seen = [], train
    for stage in front:
        fitted.append(stage if isinstance(stage, Transformer) else stage.fit(seen))
        seen = fitted[-1].transform(seen)
        if isinstance(stage, HashingTF):
            seen = materialize(seen.drop(stage.getInputCol()), "hashed")
    return PipelineModel(stages=[*fitted, grow.fit(classifier, seen)])


def fit_rows(df: DataFrame, rows: int | None, class_col: str, key: str, seed=7) -> DataFrame:
    """About `rows` rows, of each class its share and one at least, by the hash
    of their keys: the same whatever the partitioning. None: all rows.

    They are drawn by their keys, so that no more of the bags are shuffled."""
    if rows is None:
        return df
    total = df.count()
    shares = df.groupBy(class_col).agg(F.ceil(F.count("*") * rows / max(rows, total)).alias("_share"))
    order = Window.partitionBy(class_col).orderBy(row_hash(key, seed), key)
    def drawn(table):
        first = table.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= rows)
        return first.join(shares, class_col).where(F.col("_rank") <= F.col("_share"))

    keys = materialize(drawn(df.select(class_col, key)).select(key), "fit_keys")   # `rows` and one for each class at most
    return materialize(drawn(df.join(F.broadcast(keys), key, "left_semi")).select(*df.columns), "fit")


def evaluate(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One row: accuracy, macro F1, weighted F1, rows."""
    return met.summary(model.transform(df), "label", "prediction")


def evaluate_splits(model: PipelineModel, prep: Prepared) -> DataFrame:
    """Metrics on the training rows (all of them, as the reference scored
    `df_train`) and on the validation rows, one row per split."""
    tr = evaluate(model, prep.train_all).withColumn("split", F.lit("train"))
    va = evaluate(model, prep.valid).withColumn("split", F.lit("valid"))
    return tr.unionByName(va).select("split", "accuracy", "macro_f1",
                                     "weighted_f1", "n_rows")


def training_accuracy(model: PipelineModel) -> float | None:
    """Accuracy from the training summary (logistic regression)."""
    last = model.stages[-1]
    if getattr(last, "hasSummary", False):
        return float(last.summary.accuracy)
    return None


def indexer_of(model: PipelineModel):
    return model.stages[0]


def score(model: PipelineModel, unlabeled: DataFrame, key: str) -> DataFrame:
    """B1 + B2: (key, prediction, predicted_class) for rows without a class.

    The label indexer passes through when the class column is absent.
    """
    named = st.label_names(indexer_of(model), "prediction", "predicted_class")
    pred = named.transform(model.transform(unlabeled))
    return pred.select(key, "prediction", "predicted_class")
