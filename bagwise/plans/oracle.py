"""DuckDB SQL equivalents of the registered deterministic queries.

Written independently of the Spark code, in the plain definitional form
(window ranks, string_agg, list functions); the Spark side must equal them.
Views available: documents, labels, orders, lineitem, part (and the rest of
the test tables).
"""

from __future__ import annotations

from bagwise.plans.catalog import (LONG_BAG_TOKENS, N_FOLDS, ONE_CLASS,
                                   RULE_MIN_CHARS, SPLIT_SEED, TEST_FRACTION,
                                   TOP_N_OVERALL, TOP_N_PER_CLASS, VOCAB_MIN_DF)

DOC_BAGS = """doc_bags AS (
  SELECT doc_id, lang,
         list_filter(string_split(regexp_replace(replace(lower(text), '-', ' '),
                                                 '[^a-zA-Z ]+', '', 'g'), ' '),
                     lambda x: x <> '' AND x <> 'oz') AS tokens
  FROM documents)"""

DOC_TOKENS = """doc_tokens AS (
  SELECT doc_id, lang, unnest(tokens) AS token FROM doc_bags)"""

BASKETS = """baskets AS (
  SELECT o_orderkey, o_orderpriority,
         '[''' || string_agg(p_name, ''', ''' ORDER BY p_name) || ''']' AS ingredients
  FROM orders
  JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = l_partkey
  GROUP BY o_orderkey, o_orderpriority)"""

BASKET_BAGS = """basket_inner AS (
  SELECT o_orderkey, o_orderpriority,
         lower(substring(ingredients, 3, greatest(length(ingredients) - 4, 0))) AS inner_text
  FROM baskets),
basket_items_all AS (
  SELECT o_orderkey, o_orderpriority, string_split(inner_text, ''', ''') AS items FROM basket_inner),
basket_bags AS (
  SELECT o_orderkey, o_orderpriority,
         CASE WHEN items = [''] THEN items
              ELSE list_slice(items, 1, coalesce(list_max(list_filter(range(1, len(items) + 1), lambda i: items[i] <> '')), 0))
         END AS tokens
  FROM basket_items_all)"""

HASH = f"md5(CAST(doc_id AS VARCHAR) || ':{SPLIT_SEED}')"

DOC_SPLIT = f"""doc_split AS (
  SELECT doc_id, lang,
         CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY {HASH}, doc_id)
                   <= round({TEST_FRACTION} * count(*) OVER (PARTITION BY lang))
              THEN 'test' ELSE 'train' END AS split
  FROM documents)"""

TRAIN_BAGS = """train_bags AS (
  SELECT b.doc_id, b.lang, b.tokens FROM doc_bags b
  JOIN doc_split s ON s.doc_id = b.doc_id WHERE s.split = 'train')"""

DEDUP = """dedup AS (
  SELECT t.doc_id, t.lang, t.tokens FROM train_bags t
  JOIN (SELECT min(doc_id) AS doc_id FROM train_bags GROUP BY list_sort(tokens)) k
    ON k.doc_id = t.doc_id)"""

WEIGHTS = """weights AS (
  SELECT lang, count(*) AS class_count,
         (SELECT count(*) FROM train_bags) AS total,
         ((SELECT count(*) FROM train_bags) / count(*))
           / (SELECT count(DISTINCT lang) FROM dedup) AS weight
  FROM dedup GROUP BY lang)"""

RULE = f"""pred AS (
  SELECT CAST(l.quality AS DOUBLE) AS label,
         CASE WHEN d.n_chars > {RULE_MIN_CHARS} THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
cells AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction),
by_label AS (
  SELECT label, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp, sum(n) AS support
  FROM cells GROUP BY label),
by_pred AS (
  SELECT prediction, sum(CASE WHEN label <> prediction THEN n ELSE 0 END) AS fp
  FROM cells GROUP BY prediction),
pc0 AS (
  SELECT b.label, CAST(b.tp AS BIGINT) AS tp, CAST(coalesce(p.fp, 0) AS BIGINT) AS fp,
         CAST(b.support - b.tp AS BIGINT) AS fn, CAST(b.support AS BIGINT) AS support
  FROM by_label b LEFT JOIN by_pred p ON p.prediction = b.label),
pc1 AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CAST(tp AS DOUBLE) / support AS recall FROM pc0),
pc AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                 ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM pc1)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def oracle_queries() -> dict[str, str]:
    q = {}
    q["top_tokens_per_class"] = _with(DOC_BAGS, DOC_TOKENS, """c AS (
  SELECT lang, token, count(*) AS count FROM doc_tokens GROUP BY lang, token)""") + f"""
SELECT lang, token, count, rank FROM (
  SELECT lang, token, count,
         row_number() OVER (PARTITION BY lang ORDER BY count DESC, token) AS rank FROM c)
WHERE rank <= {TOP_N_PER_CLASS}"""

    q["top_tokens_overall"] = _with(DOC_BAGS, DOC_TOKENS, """c AS (
  SELECT token, count(*) AS count FROM doc_tokens GROUP BY token)""") + f"""
SELECT token, count, rank FROM (
  SELECT token, count, row_number() OVER (ORDER BY count DESC, token) AS rank FROM c)
WHERE rank <= {TOP_N_OVERALL}"""

    q["top_phrases_per_class"] = _with(BASKETS, BASKET_BAGS, """t AS (
  SELECT o_orderpriority, unnest(tokens) AS token FROM basket_bags),
c AS (SELECT o_orderpriority, token, count(*) AS count FROM t
      GROUP BY o_orderpriority, token)""") + f"""
SELECT o_orderpriority, token, count, rank FROM (
  SELECT o_orderpriority, token, count,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY count DESC, token) AS rank
  FROM c)
WHERE rank <= {TOP_N_PER_CLASS}"""

    q["top_tokens_one_class"] = _with(DOC_BAGS, DOC_TOKENS, f"""c AS (
  SELECT token, count(*) AS count FROM doc_tokens WHERE lang = '{ONE_CLASS}' GROUP BY token)""") + f"""
SELECT token, count, rank FROM (
  SELECT token, count, row_number() OVER (ORDER BY count DESC, token) AS rank FROM c)
WHERE rank <= {TOP_N_PER_CLASS}"""

    q["distinct_classes"] = "SELECT DISTINCT lang FROM documents"

    q["top_phrases_overall"] = _with(BASKETS, BASKET_BAGS, """t AS (
  SELECT unnest(tokens) AS token FROM basket_bags),
c AS (SELECT token, count(*) AS count FROM t GROUP BY token)""") + f"""
SELECT token, count, rank FROM (
  SELECT token, count, row_number() OVER (ORDER BY count DESC, token) AS rank FROM c)
WHERE rank <= {TOP_N_OVERALL}"""

    q["basket_size_min_max"] = _with(BASKETS, BASKET_BAGS) + """
SELECT min(len(tokens)) AS min_tokens, max(len(tokens)) AS max_tokens FROM basket_bags"""

    q["basket_size_histogram"] = _with(BASKETS, BASKET_BAGS) + """
SELECT len(tokens) AS n_tokens, count(*) AS count FROM basket_bags GROUP BY len(tokens)"""

    q["basket_size_avg_by_class"] = _with(BASKETS, BASKET_BAGS) + """
SELECT o_orderpriority, round(avg(len(tokens)), 6) AS avg_tokens
FROM basket_bags GROUP BY o_orderpriority"""

    q["long_basket_count"] = _with(BASKETS, BASKET_BAGS) + f"""
SELECT count(*) AS n_bags FROM basket_bags WHERE len(tokens) > {LONG_BAG_TOKENS}"""

    q["bag_sizes"] = _with(DOC_BAGS) + "SELECT doc_id, lang, len(tokens) AS n_tokens FROM doc_bags"

    q["class_counts"] = "SELECT lang, count(*) AS count FROM documents GROUP BY lang"

    q["basket_class_counts"] = _with(BASKETS) + """
SELECT o_orderpriority, count(*) AS count FROM baskets GROUP BY o_orderpriority"""

    q["distinct_token_count"] = _with(DOC_BAGS, DOC_TOKENS) + """
SELECT count(DISTINCT token) AS n_distinct_tokens FROM doc_tokens"""

    q["bag_size_min_max"] = _with(DOC_BAGS) + """
SELECT min(len(tokens)) AS min_tokens, max(len(tokens)) AS max_tokens FROM doc_bags"""

    q["bag_size_histogram"] = _with(DOC_BAGS) + """
SELECT len(tokens) AS n_tokens, count(*) AS count FROM doc_bags GROUP BY len(tokens)"""

    q["bag_size_avg_by_class"] = _with(DOC_BAGS) + """
SELECT lang, round(avg(len(tokens)), 6) AS avg_tokens FROM doc_bags GROUP BY lang"""

    q["long_bag_count"] = _with(DOC_BAGS) + f"""
SELECT count(*) AS n_bags FROM doc_bags WHERE len(tokens) > {LONG_BAG_TOKENS}"""

    q["single_token_bags"] = _with(BASKETS, BASKET_BAGS) + """
SELECT o_orderkey, o_orderpriority, array_to_string(tokens, '|') AS items
FROM basket_bags WHERE len(tokens) = 1"""

    q["list_parse"] = _with(BASKETS, BASKET_BAGS) + """
SELECT o_orderkey, array_to_string(tokens, '|') AS items, len(tokens) AS n_items
FROM basket_bags"""

    q["word_tokens"] = _with(DOC_BAGS) + """
SELECT doc_id, array_to_string(tokens, ' ') AS tokens_text, len(tokens) AS n_tokens
FROM doc_bags"""

    q["split_stratified"] = _with(DOC_SPLIT) + "SELECT doc_id, lang, split FROM doc_split"

    q["split_random"] = f"""
SELECT doc_id,
       CASE WHEN row_number() OVER (ORDER BY {HASH}, doc_id)
                 <= round({TEST_FRACTION} * count(*) OVER ())
            THEN 'test' ELSE 'train' END AS split
FROM documents"""

    q["split_sizes"] = _with(DOC_SPLIT) + """
SELECT split, lang, count(*) AS count FROM doc_split GROUP BY split, lang"""

    q["split_anti"] = _with(DOC_SPLIT) + """
SELECT d.doc_id, d.lang FROM documents d
WHERE d.doc_id NOT IN (SELECT doc_id FROM doc_split WHERE split = 'train')"""

    q["folds"] = f"""
SELECT doc_id, CAST(CAST('0x' || substr({HASH}, 1, 8) AS BIGINT) % {N_FOLDS} AS INTEGER) AS fold
FROM documents"""

    q["dedup_bags"] = _with(DOC_BAGS, DOC_SPLIT, TRAIN_BAGS, DEDUP) + """
SELECT doc_id, lang, len(tokens) AS n_tokens FROM dedup"""

    q["class_weights"] = _with(DOC_BAGS, DOC_SPLIT, TRAIN_BAGS, DEDUP, WEIGHTS) + """
SELECT lang, class_count, total, round(weight, 6) AS weight FROM weights"""

    q["class_weights_post_dedup"] = _with(DOC_BAGS, DOC_SPLIT, TRAIN_BAGS, DEDUP) + """
SELECT lang, count(*) AS class_count, (SELECT count(*) FROM dedup) AS total,
       round(((SELECT count(*) FROM dedup) / count(*))
             / (SELECT count(DISTINCT lang) FROM dedup), 6) AS weight
FROM dedup GROUP BY lang"""

    q["class_weights_rows"] = _with(DOC_BAGS, DOC_SPLIT, TRAIN_BAGS, DEDUP, WEIGHTS) + """
SELECT d.doc_id, d.lang, round(w.weight, 6) AS weight
FROM dedup d JOIN weights w ON w.lang = d.lang"""

    q["label_index_desc"] = """
SELECT lang, count, CAST(row_number() OVER (ORDER BY count DESC, lang) - 1 AS DOUBLE) AS idx
FROM (SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang)"""

    q["label_index_asc"] = """
SELECT lang, count, CAST(row_number() OVER (ORDER BY count ASC, lang) - 1 AS DOUBLE) AS idx
FROM (SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang)"""

    q["vocabulary"] = _with(DOC_BAGS, DOC_TOKENS, """c AS (
  SELECT token, count(*) AS count FROM doc_tokens GROUP BY token)""") + """
SELECT idx, token, count FROM (
  SELECT row_number() OVER (ORDER BY count DESC, token) - 1 AS idx, token, count FROM c)"""

    q["vocabulary_min_df"] = _with(DOC_BAGS, DOC_TOKENS, f"""c AS (
  SELECT token, count(*) AS count, count(DISTINCT doc_id) AS doc_freq
  FROM doc_tokens GROUP BY token HAVING count(DISTINCT doc_id) >= {VOCAB_MIN_DF})""") + """
SELECT idx, token, count FROM (
  SELECT row_number() OVER (ORDER BY count DESC, token) - 1 AS idx, token, count FROM c)"""

    q["tfidf_terms"] = _with(DOC_BAGS, DOC_TOKENS, """tf AS (
  SELECT doc_id, token, count(*) AS tf FROM doc_tokens GROUP BY doc_id, token)""",
                             """m AS (SELECT count(*) AS m FROM documents)""",
                             """dfq AS (SELECT token, count(*) AS doc_freq FROM tf GROUP BY token)""") + """
SELECT tf.doc_id, tf.token, tf.tf, dfq.doc_freq,
       round(ln((m.m + 1.0) / (dfq.doc_freq + 1.0)), 6) AS idf,
       round(tf.tf * ln((m.m + 1.0) / (dfq.doc_freq + 1.0)), 6) AS tfidf
FROM tf JOIN dfq ON dfq.token = tf.token CROSS JOIN m"""

    q["metric_accuracy"] = _with(RULE) + """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS n_rows FROM pred"""

    q["metric_per_class"] = _with(RULE) + """
SELECT label, tp, fp, fn, support, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pc"""

    q["metric_macro_f1"] = _with(RULE) + "SELECT round(avg(f1), 6) AS macro_f1 FROM pc"

    q["metric_weighted_f1"] = _with(RULE) + """
SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM pc"""

    q["metric_summary"] = _with(RULE) + """
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
       round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
       CAST(sum(support) AS BIGINT) AS n_rows FROM pc"""

    q["confusion"] = _with(RULE) + """
SELECT label,
       CAST(coalesce(sum(CASE WHEN prediction = 0.0 THEN n END), 0) AS BIGINT) AS p_0,
       CAST(coalesce(sum(CASE WHEN prediction = 1.0 THEN n END), 0) AS BIGINT) AS p_1
FROM cells GROUP BY label"""
    return q
