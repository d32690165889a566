"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They read the given tables (documents, labels, orders, lineitem, part) in
whole. Computed columns carry explicit names, doubles are rounded to 6
digits and counts are bigint, so the DuckDB oracles in `oracle.py` produce
the same schema and values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagwise.functions.tokens import list_tokens, word_tokens
from bagwise.operators import features as feat
from bagwise.operators import metrics as met
from bagwise.operators import prepare, profile, split
from bagwise.operators.joins import join_small
from bagwise.session import materialize, spread
from bagwise.sources import tables

# Fixed parameters of the registered queries (the reference's values where
# it has them).
TOP_N_PER_CLASS = 10        # top tokens per class
TOP_N_OVERALL = 20          # top tokens overall
LONG_BAG_TOKENS = 30        # "more than 30 items"
TEST_FRACTION = 0.2         # validation share of the split
SPLIT_SEED = 7              # seed of the split
N_FOLDS = 3                 # folds of the library cross-validation
RULE_MIN_CHARS = 1000       # rule-based prediction: n_chars > 1000
ONE_CLASS = "fr"            # class of the single-class top-token report
VOCAB_MIN_DF = 2            # min_df of the filtered vocabulary
ROUND = 6


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, ROUND)


# ---------------------------------------------------------------- inputs

def doc_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> (doc_id, lang, tokens) with the word tokenizer."""
    d = spread(tables.documents(spark, sf_dir, ["doc_id", "text", "lang"]), "doc_id")
    return d.select("doc_id", "lang", word_tokens("text").alias("tokens"))


def basket_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """baskets -> (o_orderkey, o_orderpriority, tokens) with the list parser."""
    b = tables.baskets(spark, sf_dir)
    return b.select("o_orderkey", "o_orderpriority",
                    list_tokens("ingredients").alias("tokens"))


def line_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_orderpriority, tokens): each order line's name as a list text of one item, parsed by X1.

    The items of a basket are those of its lines, so item and size statistics need no gathered basket.
    """
    lines = tables.basket_lines(spark, sf_dir)
    return lines.select("o_orderkey", "o_orderpriority",
                        list_tokens(F.concat(F.lit("['"), "p_name", F.lit("']"))).alias("tokens"))


def basket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_orderpriority, tokens): the size as an array, from counts per order."""
    sizes = (line_bags(spark, sf_dir).groupBy("o_orderkey", "o_orderpriority")
             .agg(F.sum(F.size("tokens")).cast("int").alias("n")))
    return sizes.select("o_orderkey", "o_orderpriority", F.array_repeat(F.lit(True), F.col("n")).alias("tokens"))


def doc_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, tokens, split): exact stratified split of documents."""
    return split.with_split(doc_bags(spark, sf_dir), "doc_id", TEST_FRACTION,
                            SPLIT_SEED, by="lang")


def doc_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_split(spark, sf_dir).where(F.col("split") == "train").drop("split")


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels join documents: label = quality, prediction = n_chars > 1000."""
    lab = tables.labels(spark, sf_dir)
    docs = tables.read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    return (lab.join(docs, "doc_id")
               .select(F.col("quality").cast("double").alias("label"),
                       (F.col("n_chars") > RULE_MIN_CHARS).cast("double")
                       .alias("prediction")))


# ---------------------------------------------------------------- profile

def q_top_tokens_per_class(spark, sf_dir):
    return profile.top_tokens_per_class(doc_bags(spark, sf_dir), "lang", TOP_N_PER_CLASS)


def q_top_tokens_overall(spark, sf_dir):
    return profile.top_tokens(doc_bags(spark, sf_dir), TOP_N_OVERALL)


def q_top_phrases_per_class(spark, sf_dir):
    return profile.top_tokens_per_class(line_bags(spark, sf_dir), "o_orderpriority", TOP_N_PER_CLASS)


def q_top_tokens_one_class(spark, sf_dir):
    return profile.top_tokens_of_class(doc_bags(spark, sf_dir), "lang", ONE_CLASS,
                                       TOP_N_PER_CLASS)


def q_distinct_classes(spark, sf_dir):
    return profile.distinct_classes(tables.documents(spark, sf_dir, ["lang"]), "lang")


def q_bag_sizes(spark, sf_dir):
    return profile.with_bag_size(doc_bags(spark, sf_dir)).select("doc_id", "lang",
                                                                 "n_tokens")


def q_top_phrases_overall(spark, sf_dir):
    return profile.top_tokens(line_bags(spark, sf_dir), TOP_N_OVERALL)


def q_basket_size_min_max(spark, sf_dir):
    return profile.bag_size_min_max(basket_sizes(spark, sf_dir))


def q_basket_size_histogram(spark, sf_dir):
    return profile.bag_size_histogram(basket_sizes(spark, sf_dir))


def q_basket_size_avg_by_class(spark, sf_dir):
    a = profile.bag_size_avg_by_class(basket_sizes(spark, sf_dir), "o_orderpriority")
    return a.select("o_orderpriority", r6("avg_tokens").alias("avg_tokens"))


def q_long_basket_count(spark, sf_dir):
    return profile.long_bag_count(basket_sizes(spark, sf_dir), LONG_BAG_TOKENS)


def q_class_counts(spark, sf_dir):
    return profile.class_counts(tables.documents(spark, sf_dir, ["lang"]), "lang")


def q_basket_class_counts(spark, sf_dir):
    return profile.class_counts(basket_bags(spark, sf_dir), "o_orderpriority")


def q_distinct_token_count(spark, sf_dir):
    return profile.distinct_token_count(doc_bags(spark, sf_dir))


def q_bag_size_min_max(spark, sf_dir):
    return profile.bag_size_min_max(doc_bags(spark, sf_dir))


def q_bag_size_histogram(spark, sf_dir):
    return profile.bag_size_histogram(doc_bags(spark, sf_dir))


def q_bag_size_avg_by_class(spark, sf_dir):
    a = profile.bag_size_avg_by_class(doc_bags(spark, sf_dir), "lang")
    return a.select("lang", r6("avg_tokens").alias("avg_tokens"))


def q_long_bag_count(spark, sf_dir):
    return profile.long_bag_count(doc_bags(spark, sf_dir), LONG_BAG_TOKENS)


def q_single_token_bags(spark, sf_dir):
    b = profile.bags_of_size(basket_bags(spark, sf_dir), 1,
                             keep=["o_orderkey", "o_orderpriority"])
    return b.select("o_orderkey", "o_orderpriority",
                    F.array_join("tokens", "|").alias("items"))


def q_list_parse(spark, sf_dir):
    b = basket_bags(spark, sf_dir)
    return b.select("o_orderkey", F.array_join("tokens", "|").alias("items"),
                    F.size("tokens").cast("bigint").alias("n_items"))


def q_word_tokens(spark, sf_dir):
    d = doc_bags(spark, sf_dir)
    return d.select("doc_id", F.array_join("tokens", " ").alias("tokens_text"),
                    F.size("tokens").cast("bigint").alias("n_tokens"))


# ---------------------------------------------------------------- splits

def q_split_stratified(spark, sf_dir):
    return doc_split(spark, sf_dir).select("doc_id", "lang", "split")


def q_split_random(spark, sf_dir):
    d = tables.documents(spark, sf_dir, ["doc_id"])
    return split.with_split(d, "doc_id", TEST_FRACTION, SPLIT_SEED, by=None)


def q_split_sizes(spark, sf_dir):
    s = split.with_split(tables.documents(spark, sf_dir, ["doc_id", "lang"]),
                         "doc_id", TEST_FRACTION, SPLIT_SEED, by="lang")
    return split.split_sizes(s, "lang")


def q_split_anti(spark, sf_dir):
    d = tables.documents(spark, sf_dir, ["doc_id", "lang"])
    train, _ = split.stratified_split(d, "lang", "doc_id", TEST_FRACTION, SPLIT_SEED)
    return split.anti_join(d, train, "doc_id")


def q_split_sample_by(spark, sf_dir):
    d = tables.documents(spark, sf_dir, ["doc_id", "lang"])
    train, test = split.sample_by_split(d, "lang", "doc_id", TEST_FRACTION, SPLIT_SEED)
    return (train.withColumn("split", F.lit("train"))
                 .unionByName(test.withColumn("split", F.lit("test"))))


def q_split_random_library(spark, sf_dir):
    d = tables.documents(spark, sf_dir, ["doc_id", "lang"])
    train, test = split.random_split(d, TEST_FRACTION, SPLIT_SEED)
    return (train.withColumn("split", F.lit("train"))
                 .unionByName(test.withColumn("split", F.lit("test"))))


def q_folds(spark, sf_dir):
    d = tables.documents(spark, sf_dir, ["doc_id"])
    return split.with_folds(d, "doc_id", N_FOLDS, SPLIT_SEED)


# ---------------------------------------------------------------- prepare

def q_dedup_bags(spark, sf_dir):
    dd = prepare.dedup_bags(doc_train(spark, sf_dir), "doc_id")
    return dd.select("doc_id", "lang", F.size("tokens").cast("bigint").alias("n_tokens"))


def _weights(spark, sf_dir, reuse: bool = False):
    train = doc_train(spark, sf_dir)
    # the reference's total, rows before dedup: the split leaves out round(fraction * n) of each class
    sizes = tables.documents(spark, sf_dir, ["lang"]).groupBy("lang").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum(F.col("n") - F.round(F.col("n") * F.lit(TEST_FRACTION)).cast("bigint"))).first()[0] or 0
    dd = prepare.dedup_bags(train, "doc_id")
    if reuse:
        # read twice (class table, then the rows): write it once
        dd = materialize(dd, "dedup")
    return dd, prepare.class_weight_table(dd, "lang", total=total)


def q_class_weights(spark, sf_dir):
    _, t = _weights(spark, sf_dir)
    return t.select("lang", "class_count", "total", r6("weight").alias("weight"))


def q_class_weights_post_dedup(spark, sf_dir):
    dd = prepare.dedup_bags(doc_train(spark, sf_dir), "doc_id")
    t = prepare.class_weight_table(dd, "lang")
    return t.select("lang", "class_count", "total", r6("weight").alias("weight"))


def q_class_weights_rows(spark, sf_dir):
    dd, t = _weights(spark, sf_dir, reuse=True)
    return (join_small(dd, t.select("lang", "weight"), "lang")
              .select("doc_id", "lang", r6("weight").alias("weight")))


# ---------------------------------------------------------------- features

def q_label_index_desc(spark, sf_dir):
    return feat.label_index(tables.documents(spark, sf_dir, ["lang"]), "lang",
                            feat.FREQUENCY_DESC)


def q_label_index_asc(spark, sf_dir):
    return feat.label_index(tables.documents(spark, sf_dir, ["lang"]), "lang",
                            feat.FREQUENCY_ASC)


def q_vocabulary(spark, sf_dir):
    return feat.vocabulary(doc_bags(spark, sf_dir))


def q_vocabulary_min_df(spark, sf_dir):
    return feat.vocabulary(doc_bags(spark, sf_dir), min_df=VOCAB_MIN_DF, key="doc_id")


def q_tfidf_terms(spark, sf_dir):
    t = feat.tfidf_terms(doc_bags(spark, sf_dir), "doc_id")
    return t.select("doc_id", "token", "tf", "doc_freq", r6("idf").alias("idf"),
                    r6("tfidf").alias("tfidf"))


# ---------------------------------------------------------------- metrics

def q_metric_accuracy(spark, sf_dir):
    a = met.accuracy(rule_predictions(spark, sf_dir))
    return a.select(r6("accuracy").alias("accuracy"), "n_rows")


def q_metric_per_class(spark, sf_dir):
    pc = met.per_class(rule_predictions(spark, sf_dir))
    return pc.select("label", "tp", "fp", "fn", "support",
                     *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


def q_metric_macro_f1(spark, sf_dir):
    return met.macro_f1(rule_predictions(spark, sf_dir)).select(
        r6("macro_f1").alias("macro_f1"))


def q_metric_weighted_f1(spark, sf_dir):
    return met.weighted_f1(rule_predictions(spark, sf_dir)).select(
        r6("weighted_f1").alias("weighted_f1"))


def q_metric_summary(spark, sf_dir):
    s = met.summary(rule_predictions(spark, sf_dir))
    return s.select(*[r6(c).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1")],
                    "n_rows")


def q_confusion(spark, sf_dir):
    return met.confusion_matrix(rule_predictions(spark, sf_dir), classes=[0.0, 1.0])


DETERMINISTIC = {
    "top_tokens_per_class": q_top_tokens_per_class,
    "top_tokens_overall": q_top_tokens_overall,
    "top_phrases_per_class": q_top_phrases_per_class,
    "top_tokens_one_class": q_top_tokens_one_class,
    "top_phrases_overall": q_top_phrases_overall,
    "basket_size_min_max": q_basket_size_min_max,
    "basket_size_histogram": q_basket_size_histogram,
    "basket_size_avg_by_class": q_basket_size_avg_by_class,
    "long_basket_count": q_long_basket_count,
    "distinct_classes": q_distinct_classes,
    "bag_sizes": q_bag_sizes,
    "class_counts": q_class_counts,
    "basket_class_counts": q_basket_class_counts,
    "distinct_token_count": q_distinct_token_count,
    "bag_size_min_max": q_bag_size_min_max,
    "bag_size_histogram": q_bag_size_histogram,
    "bag_size_avg_by_class": q_bag_size_avg_by_class,
    "long_bag_count": q_long_bag_count,
    "single_token_bags": q_single_token_bags,
    "list_parse": q_list_parse,
    "word_tokens": q_word_tokens,
    "split_stratified": q_split_stratified,
    "split_random": q_split_random,
    "split_sizes": q_split_sizes,
    "split_anti": q_split_anti,
    "folds": q_folds,
    "dedup_bags": q_dedup_bags,
    "class_weights": q_class_weights,
    "class_weights_post_dedup": q_class_weights_post_dedup,
    "class_weights_rows": q_class_weights_rows,
    "label_index_desc": q_label_index_desc,
    "label_index_asc": q_label_index_asc,
    "vocabulary": q_vocabulary,
    "vocabulary_min_df": q_vocabulary_min_df,
    "tfidf_terms": q_tfidf_terms,
    "metric_accuracy": q_metric_accuracy,
    "metric_per_class": q_metric_per_class,
    "metric_macro_f1": q_metric_macro_f1,
    "metric_weighted_f1": q_metric_weighted_f1,
    "metric_summary": q_metric_summary,
    "confusion": q_confusion,
}

# Queries whose result depends on Spark's samplers (no SQL equivalent).
SAMPLED = {
    "split_sample_by": q_split_sample_by,
    "split_random_library": q_split_random_library,
}
