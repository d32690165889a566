"""Checkable facts of fitted objects: queries on the given tables that SQL can state as well.

Fitted models are not comparable to SQL, but much about them is: vectors of
counts, document frequencies, sizes, sums. Each query here computes its fact
from the fitted object or its output and has a DuckDB query in `FACT_SQL`.
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bagwise.functions.tokens import token_rows, word_tokens
from bagwise.operators import embeddings, features, folds
from bagwise.operators import metrics as met
from bagwise.operators import sketches, split
from bagwise.operators.nearest import nearest_tokens
from bagwise.plans import catalog, oracle
from bagwise.plans import explain as xp
from bagwise.plans import forest as fo
from bagwise.plans import models as mdl
from bagwise.plans import registry
from bagwise.plans import stages as st
from bagwise.session import materialize
from bagwise.sources import tables

REPLICATES = 200
COOC_WINDOW = 3
COOC_MIN_COUNT = 20
NEAREST_MIN_COUNT = 20
HASHED = 1000   # features of the hashed term frequencies: small, so that a document's sum is cheap


VOCABULARY = 1 << 18   # tokens that MLlib's vectorizer keeps; those beyond it come from the vocabulary table


def entries(vector: str, value: str = "tf"):
    """The non-zero entries (idx, value) of a sparse vector, as rows."""
    v = F.unwrap_udt(vector)
    return F.inline(F.zip_with(v["indices"], v["values"], lambda i, x: F.struct(i.cast("bigint").alias("idx"), x.cast("bigint").alias(value))))


def q_count_vectors(spark, sf_dir):
    """M5 + M8: (doc_id, idx, tf) of the fitted vectorizer's vectors, and of the tokens beyond its vocabulary."""
    bags = catalog.doc_bags(spark, sf_dir)
    words = materialize(features.vocabulary(bags), "words")
    model = st.count_vectorizer_from(bags, "tokens", vocab_size=VOCABULARY, words=words)
    rest = features.count_vector_rows(bags, "doc_id", from_idx=VOCABULARY, words=words)
    return model.transform(bags).select("doc_id", entries("features")).unionByName(rest)


def q_count_idf(spark, sf_dir):
    """M4 on counts: (idx, idf) of the fitted model, and of the tokens beyond its vocabulary."""
    bags = catalog.doc_bags(spark, sf_dir)
    words = materialize(features.vocabulary(bags), "words")
    vectorizer = st.count_vectorizer_from(bags, "tokens", "tf", vocab_size=VOCABULARY, words=words)
    idf = st.idf("tf", "features").fit(vectorizer.transform(bags)).idf.toArray()
    fitted = spark.createDataFrame(pd.DataFrame({"idx": range(len(idf)), "idf": idf}), "idx long, idf double")
    n_docs = bags.select("doc_id").count()
    rest = (features.count_vector_rows(bags, "doc_id", from_idx=VOCABULARY, words=words).groupBy("idx").agg(F.count("*").alias("df"))
            .select("idx", F.log(F.lit(n_docs + 1.0) / (F.col("df") + 1.0)).alias("idf")))
    return fitted.unionByName(rest).select("idx", F.round("idf", 6).alias("idf"))


def q_hashed_tf(spark, sf_dir):
    """M3: (doc_id, idx, tf) of the hashed vectors."""
    tf = st.hashing_tf("tokens", "tf", st.TFIDF_NUM_FEATURES).transform(catalog.doc_bags(spark, sf_dir))
    return tf.select("doc_id", entries("tf"))


def q_hashed_names(spark, sf_dir):
    """The tokens behind each hashed feature."""
    return features.hashed_names(catalog.doc_bags(spark, sf_dir), "tokens", st.TFIDF_RF_NUM_FEATURES)


def q_hashed_tf_totals(spark, sf_dir):
    """M3: (doc_id, n_tokens), the sum of each hashed vector."""
    tf = st.hashing_tf("tokens", "tf", HASHED).transform(catalog.doc_bags(spark, sf_dir))
    total = F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda s, x: s + x)
    return tf.select("doc_id", total.cast("bigint").alias("n_tokens"))


def q_confusion_row_sums(spark, sf_dir):
    """E6 on a fitted model: rows per true class in the validation table."""
    model = registry.lr_tfidf_model(spark, sf_dir)
    names = mdl.indexer_of(model).labels
    pred = model.transform(registry.prepared(spark, sf_dir).valid)
    matrix = met.confusion_matrix(pred, classes=[float(i) for i in range(len(names))])
    name = F.element_at(F.array(*map(F.lit, names)), (F.col("label") + 1).cast("int"))
    return matrix.select(name.alias("lang"), sum(F.col(c) for c in matrix.columns if c != "label").alias("n"))


def q_lr_accuracy_gap(spark, sf_dir):
    """E2 against E1: the training summary's accuracy less that of the model's own predictions."""
    model = registry.lr_tfidf_model(spark, sf_dir)
    own = mdl.evaluate(model, registry.prepared(spark, sf_dir).train_all)
    return own.select(F.round(F.abs(F.col("accuracy") - mdl.training_accuracy(model)), 6).alias("gap"))


def q_lr_classes(spark, sf_dir):
    """The classes that the fitted models have: as many as the training table."""
    rows = [("lr_tfidf", registry.lr_tfidf_model(spark, sf_dir)), ("lr_quality", registry.lr_quality_model(spark, sf_dir)),
            ("rf_counts", registry.rf_counts_model(spark, sf_dir))]
    return spark.createDataFrame([(n, int(m.stages[-1].numClasses)) for n, m in rows], "model string, n_classes long")


def q_importance_facts(spark, sf_dir):
    """The importances' sum and number for the whole vocabulary of the fit's bags; each has its token's name."""
    model = registry.rf_counts_reference_model(spark, sf_dir)
    found = xp.importances(model)
    return found.agg(F.round(F.sum("importance"), 6).alias("importance_sum"), F.count("*").alias("n_features"),
                     F.count_distinct("feature").alias("n_names"))


def q_scored(spark, sf_dir):
    """B1, B2: scored rows per id parity, with a known class each."""
    unl = tables.unlabeled_documents(spark, sf_dir)
    bags = unl.select("doc_id", word_tokens("text").alias("tokens"))
    got = mdl.score(registry.lr_tfidf_model(spark, sf_dir), bags, "doc_id")
    known = F.col("predicted_class").isin(list(mdl.indexer_of(registry.lr_tfidf_model(spark, sf_dir)).labels))
    return got.groupBy((F.col("doc_id") % 2).alias("parity")).agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_ids"),
                                                                F.sum(F.when(known, 0).otherwise(1)).cast("bigint").alias("n_unknown"))


def q_fold_sizes(spark, sf_dir):
    """Rows of the training table in each fold of the grids."""
    folded = split.with_folds(registry.prepared(spark, sf_dir).train_all, "doc_id", catalog.N_FOLDS, catalog.SPLIT_SEED)
    return folded.groupBy(F.col("fold").cast("bigint").alias("fold")).agg(F.count("*").alias("n"))


def q_sample_by_cover(spark, sf_dir):
    """Both sides together have each row once."""
    both = catalog.q_split_sample_by(spark, sf_dir)
    return both.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_ids"))


def q_bag_embedding_norms(spark, sf_dir):
    """M6: bags without a known token have a zero vector, all others a vector of the model's size."""
    model = registry.lr_w2v_model(spark, sf_dir)
    bags = catalog.doc_bags(spark, sf_dir)
    vectors = model.stages[1].transform(bags).select(vector_to_array("features").alias("x"))
    return vectors.agg(F.count("*").alias("n"), F.min(F.size("x")).cast("bigint").alias("n_dimensions"))


def q_forest_importance_gap(spark, sf_dir):
    """(idx, feature, gap) of every feature of the count forest: its token, and how far the importance that
    the node table gives is from MLlib's."""
    model = registry.rf_counts_model(spark, sf_dir)
    own = fo.node_importances(registry.forest_nodes(spark, sf_dir)).withColumnRenamed("importance", "own")
    gap = F.abs(F.col("importance") - F.coalesce("own", F.lit(0.0)))
    return xp.importances(model).join(own, "feature_idx", "left").select(
        F.col("feature_idx").cast("bigint").alias("idx"), "feature", F.round(gap, 9).alias("gap"))


def q_forest_votes(spark, sf_dir):
    """L4: (doc_id, same) of every validation row: whether the walk through the node table and MLlib's model agree."""
    model = registry.rf_counts_model(spark, sf_dir)
    pred = model.transform(registry.prepared(spark, sf_dir).valid)
    own = fo.predicted_at(registry.forest_nodes(spark, sf_dir), pred.withColumnRenamed("prediction", "of_mllib"), ["doc_id", "of_mllib"], [fo.MAX_DEPTH])
    return own.select("doc_id", (F.col("prediction") == F.col("of_mllib")).alias("same"))


def q_tree_level_weights(spark, sf_dir):
    """(max_depth, lang, weight): class weights of the leaves of one tree cut at each depth, those of all its rows."""
    names, nodes = registry.tree_presence(spark, sf_dir)
    found = fo.level_weights(nodes, range(registry.TREE_DEPTH + 1))
    return found.select(F.col("max_depth").cast("bigint").alias("max_depth"), F.element_at(F.array(*map(F.lit, names)), F.col("class") + 1).alias("lang"),
                        F.round("weight", 6).alias("weight"))


def q_tree_root(spark, sf_dir):
    """L4: impurity, gain and rows of the root of one tree on token presence."""
    _, nodes = registry.tree_presence(spark, sf_dir)
    return nodes.where("depth = 0").select(F.round("impurity", 9).alias("impurity"), F.round("gain", 9).alias("gain"),
                                           F.col("raw_count").alias("n_rows"))


def q_cooccurrence(spark, sf_dir):
    """M6: the counts that the embeddings come from."""
    return embeddings.cooccurrence(catalog.doc_bags(spark, sf_dir), "tokens", COOC_WINDOW, COOC_MIN_COUNT)


def q_log_ratios(spark, sf_dir):
    """M6: the positive log ratios of those counts."""
    pairs, words = embeddings.hashed_cooccurrence(catalog.doc_bags(spark, sf_dir), "tokens", COOC_WINDOW, COOC_MIN_COUNT)
    ratios = materialize(embeddings.log_ratios(pairs, once=True), "ratios")
    rows = embeddings.both_ways(embeddings.named(ratios, words, "weight"), "weight", F.col("weight"))
    return rows.select("token", "context", F.round("weight", 6).alias("weight"))


def q_nearest_tokens_by_source(spark, sf_dir):
    """M7: the ten nearest tokens of each token of `NEAREST_MIN_COUNT` occurrences, by their counts in the sources."""
    docs = spark.read.parquet(tables.table_path(sf_dir, "documents")).select("source", word_tokens("text").alias("tokens"))
    counts = token_rows(docs, "tokens", keep=["source"]).groupBy("token", "source").agg(F.count(F.lit(1)).alias("n"))
    names = sorted(r[0] for r in docs.select("source").distinct().collect())   # some twenty sources
    vector = F.array(*(F.coalesce(F.sum(F.when(F.col("source") == s, F.col("n"))), F.lit(0)).cast("double") for s in names))
    table = counts.groupBy("token").agg(F.sum("n").alias("n"), vector.alias("vector")).where(F.col("n") >= NEAREST_MIN_COUNT)
    return nearest_tokens(table.select("token", "vector"), registry.N_SYNONYMS)


def q_group_folds(spark, sf_dir):
    """Per class its rows and bags in the training table, bags found in two folds, and whether the folds of the
    class differ by the rows of its largest bag at most."""
    rows = registry.prepared(spark, sf_dir).train_all.withColumn("bag", folds.bag_group("tokens"))
    found = materialize(folds.with_group_folds(rows.select("doc_id", "lang", "bag"), F.col("bag"), "lang", catalog.N_FOLDS), "folds")
    best = F.min(F.struct((-F.col("n")).alias("n"), "lang")).alias("best")
    bags = (found.groupBy("bag", "lang").agg(F.count("*").alias("n")).groupBy("bag").agg(best, F.sum("n").alias("size"))
            .join(found.groupBy("bag").agg(F.count_distinct("fold").alias("n_folds"), F.min("fold").alias("fold")), "bag"))
    named = F.array(*map(F.lit, range(catalog.N_FOLDS)))
    loads = F.transform(named, lambda f: F.aggregate(F.collect_list(F.struct("fold", "n")), F.lit(0).cast("bigint"),
                                                     lambda s, x: s + F.when(x["fold"] == f, x["n"]).otherwise(0)))
    per = bags.groupBy("best.lang", "fold").agg(F.sum("size").alias("n"), F.count("*").alias("bags"), F.max("size").alias("largest"),
                                                F.sum((F.col("n_folds") > 1).cast("bigint")).alias("split"))
    return per.groupBy("lang").agg(F.sum("n").alias("n_rows"), F.sum("bags").alias("n_bags"), F.sum("split").alias("split_bags"),
                                   (F.array_max(loads) - F.array_min(loads) <= F.max("largest")).alias("even"))


def q_observed_load(spark, sf_dir):
    """S3: what the training preparation saw while it read the documents."""
    seen = registry.prepared(spark, sf_dir).observed
    return spark.createDataFrame([tuple(seen[c] for c in ("n_rows", "null_keys", "duplicate_keys", "null_classes", "key_hash_sum"))],
                                 "n_rows long, null_keys long, duplicate_keys long, null_classes long, key_hash_sum long")


def q_f1_intervals(spark, sf_dir):
    """E1, E4, E5 with intervals: the rule-based prediction's metrics over bootstrap replicates."""
    docs = tables.read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    pred = tables.labels(spark, sf_dir).join(docs, "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("label"), (F.col("n_chars") > catalog.RULE_MIN_CHARS).cast("double").alias("prediction"))
    found = met.intervals(met.bootstrap(pred, "doc_id", REPLICATES, catalog.SPLIT_SEED))
    return found.select("metric", *(F.round(c, 6).alias(c) for c in ("mean", "low", "high")))


def q_class_sketches(spark, sf_dir):
    """Sketches per (lang, source), stored and merged over the sources, beside exact values per lang."""
    docs = tables.documents(spark, sf_dir, ["doc_id", "text", "lang", "source"])
    bags = docs.select("lang", "source", word_tokens("text").alias("tokens"))
    stored = materialize(sketches.bag_sketches(bags, ["lang", "source"]), "sketches")
    found = sketches.estimates(sketches.merged(stored, ["lang"]), ["lang"])
    return sketches.exact_beside(bags.select("lang", "tokens"), found, "lang")


FACT_QUERIES = {
    "class_sketches": q_class_sketches,
    "group_folds": q_group_folds,
    "observed_load": q_observed_load,
    "f1_intervals": q_f1_intervals,
    "hashed_tf": q_hashed_tf,
    "hashed_names": q_hashed_names,
    "cooccurrence": q_cooccurrence,
    "log_ratios": q_log_ratios,
    "nearest_tokens_by_source": q_nearest_tokens_by_source,
    "forest_importance_gap": q_forest_importance_gap,
    "forest_votes": q_forest_votes,
    "tree_level_weights": q_tree_level_weights,
    "tree_root": q_tree_root,
    "count_vectors": q_count_vectors,
    "count_idf": q_count_idf,
    "hashed_tf_totals": q_hashed_tf_totals,
    "confusion_row_sums": q_confusion_row_sums,
    "lr_accuracy_gap": q_lr_accuracy_gap,
    "model_classes": q_lr_classes,
    "importance_facts": q_importance_facts,
    "scored": q_scored,
    "fold_sizes": q_fold_sizes,
    "sample_by_cover": q_sample_by_cover,
    "bag_embedding_size": q_bag_embedding_norms,
}

_VOCABULARY = """c AS (SELECT token, count(*) AS count, count(DISTINCT doc_id) AS doc_freq FROM doc_tokens GROUP BY token),
voc AS (SELECT row_number() OVER (ORDER BY count DESC, token) - 1 AS idx, token, doc_freq FROM c)"""

# weighted class counts of the training rows, and of those that hold each token
_TREE = """w AS (SELECT d.doc_id, d.lang, weight, tokens FROM dedup d JOIN weights USING (lang)),
alls AS (SELECT lang, sum(weight) AS total FROM w GROUP BY lang),
has AS (SELECT token, lang, sum(weight) AS inside FROM (SELECT doc_id, lang, weight, unnest(list_distinct(tokens)) AS token FROM w) GROUP BY token, lang),
root AS (SELECT sum(total) AS n, 1 - sum(total * total) / (sum(total) * sum(total)) AS impurity FROM alls),
sides AS (SELECT token, lang, total, coalesce(inside, 0) AS inside FROM (SELECT DISTINCT token FROM has) CROSS JOIN alls LEFT JOIN has USING (token, lang)),
split AS (SELECT token, sum(inside) AS n_in, sum(total - inside) AS n_out,
  sum(inside * inside) AS sq_in, sum((total - inside) * (total - inside)) AS sq_out FROM sides GROUP BY token),
held AS (SELECT unnest(list_distinct(tokens)) AS token, count(*) AS n_held FROM w GROUP BY 1),
gains AS (SELECT impurity - n_in / n * (1 - sq_in / (n_in * n_in)) - n_out / n * (1 - sq_out / (n_out * n_out)) AS gain
  FROM split JOIN held USING (token), root WHERE n_held < (SELECT count(*) FROM w))"""
_TREE_CTES = (oracle.DOC_BAGS, oracle.DOC_SPLIT, oracle.TRAIN_BAGS, oracle.DEDUP, oracle.WEIGHTS, _TREE)

_PAIRS = f"""o AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS at FROM doc_bags),
known AS (SELECT token FROM o GROUP BY token HAVING count(*) >= {COOC_MIN_COUNT}),
one AS (SELECT a.token AS a, b.token AS b, count(*) AS n
  FROM (SELECT o.*, o.at + d AS to_at FROM o JOIN known USING (token), (SELECT unnest(range(1, {COOC_WINDOW} + 1)) AS d)) a
  JOIN (SELECT o.* FROM o JOIN known USING (token)) b ON a.doc_id = b.doc_id AND a.to_at = b.at GROUP BY 1, 2),
pairs AS (SELECT token, context, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT a AS token, b AS context, n FROM one UNION ALL SELECT b, a, n FROM one) GROUP BY 1, 2)"""

# MurmurHash3 (x86, 32 bits, seed 42) of the UTF-8 bytes of each token; a product of 32 bits by 32 bits is taken in two halves
def _times(a: str, b: int) -> str:
    return f"((({a}) * {b & 0xFFFF} + (((({a}) * {b >> 16}) & 65535) << 16)) & 4294967295)"


def _turn(a: str, n: int) -> str:
    return f"(((({a}) << {n}) | (({a}) >> {32 - n})) & 4294967295)"


def _hashed(num_features: int) -> str:
    k = _times(_turn(_times("k", 0xCC9E2D51), 15), 0x1B873593)
    step = f"(({_turn('xor(h, ' + k + ')', 13)} * 5 + 3864292196) & 4294967295)"
    return f"""d AS (SELECT DISTINCT token FROM doc_tokens),
x AS (SELECT token, octet_length(encode(token)) AS size,
  list_transform(range(0, octet_length(encode(token))), lambda i: CAST('0x' || substr(hex(encode(token)), CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS b FROM d),
words AS (SELECT token, size, list_transform(range(0, size // 4), lambda i: b[4*i+1] + b[4*i+2] * 256 + b[4*i+3] * 65536 + b[4*i+4] * 16777216) AS w,
  coalesce(list_sum(list_transform(range(0, size % 4), lambda i: b[4 * (size // 4) + i + 1] << (8 * i))), 0)::BIGINT AS k FROM x),
body AS (SELECT token, size, k, list_reduce(list_prepend(42::BIGINT, w), lambda h, k: {step}) AS h FROM words),
tail AS (SELECT token, xor(CASE WHEN size % 4 > 0 THEN xor(h, {k}) ELSE h END, size)::BIGINT AS h FROM body),
f1 AS (SELECT token, xor(h, h >> 16) AS h FROM tail),
f2 AS (SELECT token, {_times('h', 0x85EBCA6B)} AS h FROM f1),
f3 AS (SELECT token, xor(h, h >> 13) AS h FROM f2),
f4 AS (SELECT token, {_times('h', 0xC2B2AE35)} AS h FROM f3),
f5 AS (SELECT token, xor(h, h >> 16) AS h FROM f4),
hashed AS (SELECT token, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {num_features} + {num_features}) % {num_features} AS idx FROM f5)"""


_DRAWS = f"""b AS (SELECT doc_id, label, prediction, block,
    md5(CAST(doc_id AS VARCHAR) || ':{catalog.SPLIT_SEED}:' || CAST(block AS VARCHAR)) AS digest
  FROM p, (SELECT unnest(range({-(-REPLICATES // met.PER_HASH)})) AS block)),
e AS (SELECT label, prediction, block * {met.PER_HASH} + i AS replicate, CAST('0x' || substr(digest, CAST(4 * i + 1 AS INT), 4) AS BIGINT) AS bits
  FROM b, (SELECT unnest(range({met.PER_HASH})) AS i)),
c AS (SELECT replicate, label, prediction, sum(len(list_filter({list(met.POISSON)}, lambda t: bits >= t))) AS n FROM e
  WHERE replicate < {REPLICATES} GROUP BY ALL),
k AS (SELECT replicate, label, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp, sum(n) AS support FROM c GROUP BY ALL),
q AS (SELECT replicate, prediction AS label, sum(n) AS predicted FROM c GROUP BY ALL),
f AS (SELECT replicate, tp, support, CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (support + coalesce(predicted, 0)) END AS f1
  FROM k LEFT JOIN q USING (replicate, label) WHERE support > 0),
r AS (SELECT replicate, sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1 FROM f GROUP BY replicate),
m AS (SELECT 'accuracy' AS metric, accuracy AS x FROM r UNION ALL SELECT 'macro_f1', macro_f1 FROM r UNION ALL SELECT 'weighted_f1', weighted_f1 FROM r)"""

FACT_SQL = {
    "class_sketches": oracle._with(oracle.DOC_BAGS) + """
SELECT lang, count(*) AS n_bags, CAST(len(list_distinct(flatten(list(tokens)))) AS BIGINT) AS n_distinct_tokens,
  true AS count_within, true AS sizes_within FROM doc_bags GROUP BY lang""",
    "group_folds": oracle._with(oracle.DOC_BAGS, oracle.DOC_SPLIT, oracle.TRAIN_BAGS,
                                "g AS (SELECT list_sort(tokens) AS bag, lang, count(*) AS n FROM train_bags GROUP BY ALL)",
                                "b AS (SELECT bag, sum(n) AS size, min_by(lang, (-n, lang)) AS lang FROM g GROUP BY bag)") + """
SELECT lang, CAST(sum(size) AS BIGINT) AS n_rows, count(*) AS n_bags, CAST(0 AS BIGINT) AS split_bags, true AS even FROM b GROUP BY lang""",
    "observed_load": f"""
SELECT count(*) AS n_rows, count(*) FILTER (doc_id IS NULL) AS null_keys, count(doc_id) - count(DISTINCT doc_id) AS duplicate_keys, count(*) FILTER (lang IS NULL) AS null_classes,
  CAST(sum(CAST('0x' || substr({oracle.HASH}, 1, 8) AS BIGINT)) AS BIGINT) AS key_hash_sum FROM documents""",
    "f1_intervals": oracle._with(oracle.RULE.split("cells AS")[0].rstrip().rstrip(",").replace("pred AS (\n  SELECT", "p AS (\n  SELECT l.doc_id,"), _DRAWS) + """
SELECT metric, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.025), 6) AS low, round(quantile_cont(x, 0.975), 6) AS high FROM m GROUP BY metric""",
    "hashed_tf": oracle._with(oracle.DOC_BAGS, oracle.DOC_TOKENS, _hashed(st.TFIDF_NUM_FEATURES)) + """
SELECT doc_id, CAST(idx AS BIGINT) AS idx, count(*) AS tf FROM doc_tokens JOIN hashed USING (token) GROUP BY doc_id, idx""",
    "hashed_names": oracle._with(oracle.DOC_BAGS, oracle.DOC_TOKENS, _hashed(st.TFIDF_RF_NUM_FEATURES),
                                 "c AS (SELECT idx, token, count(*) AS n FROM doc_tokens JOIN hashed USING (token) GROUP BY idx, token)",
                                 "r AS (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY n DESC, token) AS place, count(*) OVER (PARTITION BY idx) AS n_tokens, "
                                 "sum(n) OVER (PARTITION BY idx) AS n_all FROM c)") + """
SELECT CAST(idx AS INT) AS idx, token, n AS token_count, n_tokens, CAST(n_all AS BIGINT) AS n_all FROM r WHERE place = 1""",
    "cooccurrence": oracle._with(oracle.DOC_BAGS, _PAIRS) + "SELECT token, context, n FROM pairs",
    "log_ratios": oracle._with(oracle.DOC_BAGS, _PAIRS, "s AS (SELECT token, sum(n) AS n FROM pairs GROUP BY token)") + """
SELECT p.token, p.context, round(ln(p.n * (SELECT CAST(sum(n) AS DOUBLE) FROM s) / (CAST(x.n AS DOUBLE) * y.n)), 6) AS weight
FROM pairs p JOIN s x ON p.token = x.token JOIN s y ON p.context = y.token
WHERE ln(p.n * (SELECT CAST(sum(n) AS DOUBLE) FROM s) / (CAST(x.n AS DOUBLE) * y.n)) > 0""",
    "nearest_tokens_by_source": oracle._with(
        oracle.DOC_BAGS.replace("lang,", "source,"),
        "t AS (SELECT source, unnest(tokens) AS token FROM doc_bags)",
        f"known AS (SELECT token FROM t GROUP BY token HAVING count(*) >= {NEAREST_MIN_COUNT})",
        "c AS (SELECT token, source, CAST(count(*) AS DOUBLE) AS n FROM t JOIN known USING (token) GROUP BY token, source)",
        "u AS (SELECT token, source, n / sqrt(sum(n * n) OVER (PARTITION BY token)) AS x FROM c)",
        "p AS (SELECT a.token, b.token AS neighbour, round(sum(a.x * b.x), 9) AS cosine FROM u a JOIN u b ON a.source = b.source AND a.token <> b.token GROUP BY 1, 2)",
        "r AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY cosine DESC, neighbour) AS rank FROM p)") + f"""
SELECT token, CAST(rank AS INT) AS rank, neighbour, cosine FROM r WHERE rank <= {registry.N_SYNONYMS}""",
    "forest_importance_gap": oracle._with(oracle.DOC_BAGS, oracle.DOC_SPLIT, oracle.TRAIN_BAGS, oracle.DEDUP,
                                          "c AS (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM dedup) GROUP BY token)") + """
SELECT row_number() OVER (ORDER BY n DESC, token) - 1 AS idx, token AS feature, CAST(0 AS DOUBLE) AS gap FROM c""",
    "forest_votes": oracle._with(oracle.DOC_SPLIT) + "SELECT doc_id, true AS same FROM doc_split WHERE split = 'test'",
    "tree_level_weights": oracle._with(*_TREE_CTES) + f"""
SELECT max_depth, lang, round(total, 6) AS weight FROM alls, (SELECT unnest(range({registry.TREE_DEPTH + 1})) AS max_depth)""",
    "tree_root": oracle._with(*_TREE_CTES) + """
SELECT round(impurity, 9) AS impurity, round((SELECT max(gain) FROM gains), 9) AS gain, (SELECT count(*) FROM w) AS n_rows FROM root""",
    "count_vectors": oracle._with(oracle.DOC_BAGS, oracle.DOC_TOKENS, _VOCABULARY) + """
SELECT doc_id, idx, count(*) AS tf FROM doc_tokens JOIN voc USING (token) GROUP BY doc_id, idx""",
    "count_idf": oracle._with(oracle.DOC_BAGS, oracle.DOC_TOKENS, _VOCABULARY) + """
SELECT idx, round(ln(((SELECT count(*) FROM documents) + 1.0) / (doc_freq + 1.0)), 6) AS idf FROM voc""",
    "hashed_tf_totals": oracle._with(oracle.DOC_BAGS) + "SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens FROM doc_bags",
    "confusion_row_sums": oracle._with(oracle.DOC_SPLIT) + """
SELECT lang, count(*) AS n FROM doc_split WHERE split = 'test' GROUP BY lang""",
    "lr_accuracy_gap": "SELECT CAST(0 AS DOUBLE) AS gap",
    "model_classes": """
SELECT 'lr_tfidf' AS model, count(DISTINCT lang) AS n_classes FROM documents
UNION ALL SELECT 'lr_quality', count(DISTINCT quality) FROM labels
UNION ALL SELECT 'rf_counts', count(DISTINCT lang) FROM documents""",
    "importance_facts": oracle._with(oracle.DOC_BAGS, oracle.DOC_SPLIT, oracle.TRAIN_BAGS,
                                     "t AS (SELECT unnest(tokens) AS token FROM train_bags)") + """
SELECT CAST(1 AS DOUBLE) AS importance_sum, count(DISTINCT token) AS n_features, count(DISTINCT token) AS n_names FROM t""",
    "scored": """
SELECT doc_id % 2 AS parity, count(*) AS n, count(DISTINCT doc_id) AS n_ids, CAST(0 AS BIGINT) AS n_unknown
FROM documents GROUP BY doc_id % 2""",
    "fold_sizes": oracle._with(oracle.DOC_SPLIT) + f"""
SELECT CAST('0x' || substr({oracle.HASH}, 1, 8) AS BIGINT) % {catalog.N_FOLDS} AS fold, count(*) AS n
FROM doc_split WHERE split = 'train' GROUP BY 1""",
    "sample_by_cover": "SELECT count(*) AS n, count(DISTINCT doc_id) AS n_ids FROM documents",
    "bag_embedding_size": f"SELECT count(*) AS n, CAST({st.W2V_LR['vector_size']} AS BIGINT) AS n_dimensions FROM documents",
}
