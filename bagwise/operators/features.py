"""Feature tables as DataFrames (M1, M2, M8, M9).

These are the inspectable, engine-independent forms of MLlib's fitted
state: the label index of a StringIndexer, the vocabulary of a
CountVectorizer (with a total tie-break, which MLlib lacks), and un-hashed
TF-IDF terms with the same IDF formula as MLlib's ``IDF``.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bagwise.functions.tokens import token_rows
from bagwise.operators.joins import HOT_SHARE, MAX_BROADCAST_ROWS, join_hot
from bagwise.operators.rank import ranked
from bagwise.session import materialize

FREQUENCY_DESC = "frequencyDesc"
FREQUENCY_ASC = "frequencyAsc"
ALPHABET_DESC = "alphabetDesc"
ALPHABET_ASC = "alphabetAsc"


def label_index(df: DataFrame, class_col: str,
                order: str = FREQUENCY_DESC) -> DataFrame:
    """M1 / M2: (class, count, idx) as StringIndexer numbers the classes.

    Frequency orders break ties alphabetically, like StringIndexer. The
    class table is bounded (checked) and ranked in one small task.
    """
    counts = df.where(F.col(class_col).isNotNull()).groupBy(class_col).agg(
        F.count(F.lit(1)).alias("count"))
    keys = {
        FREQUENCY_DESC: [F.desc("count"), F.asc(class_col)],
        FREQUENCY_ASC: [F.asc("count"), F.asc(class_col)],
        ALPHABET_DESC: [F.desc(class_col)],
        ALPHABET_ASC: [F.asc(class_col)],
    }[order]
    w = Window.orderBy(*keys)
    return counts.withColumn("idx", (F.row_number().over(w) - 1).cast("double"))


def label_list(df: DataFrame, class_col: str, order: str = FREQUENCY_DESC) -> list:
    """The class names in index order (for IndexToString / pivots)."""
    rows = label_index(df, class_col, order).orderBy("idx").collect()
    return [r[class_col] for r in rows]


def vocabulary(df: DataFrame, bag_col: str = "tokens", vocab_size: int | None = None,
               min_df: float = 1.0, key: str | None = None) -> DataFrame:
    """M8: (idx, token, count): the CountVectorizer vocabulary.

    Tokens ranked by total count, ties by token; all of them, or the first
    `vocab_size` (MLlib keeps a vocabulary on the driver and so bounds it; a
    table needs no bound). ``min_df`` as in CountVectorizer: a count of bags
    when >= 1, a share of bags when < 1; it needs per-bag distinct tokens, so
    it is only computed when it can filter something.

    The rank is distributed (`rank.ranked`): ranges of (count, token) by
    sampled boundaries, numbered each on its own. No task sees the whole
    vocabulary, and tokens that share a count or a prefix spread evenly.
    """
    if min_df > 1.0 or (0.0 < min_df < 1.0):
        if key is None:
            raise ValueError("min_df needs the bag key")
        pairs = (token_rows(df, bag_col, keep=[key])
                 .groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf")))
        counts = pairs.groupBy("token").agg(F.sum("tf").alias("count"),
                                            F.count(F.lit(1)).alias("doc_freq"))
        if min_df >= 1.0:
            counts = counts.where(F.col("doc_freq") >= F.lit(min_df))
        else:
            n_docs = df.count()
            counts = counts.where(F.col("doc_freq") >= F.lit(min_df * n_docs))
        counts = counts.select("token", "count")
    else:
        counts = (token_rows(df, bag_col).groupBy("token")
                  .agg(F.count(F.lit(1)).alias("count")))
    numbered = ranked(counts, [F.desc("count"), F.asc("token")], "_rank")
    table = numbered.select((F.col("_rank") - 1).cast("bigint").alias("idx"), "token", "count")
    return table if vocab_size is None else table.where(F.col("idx") < vocab_size)


def bag_term_counts(df: DataFrame, key: str, bag_col: str = "tokens") -> DataFrame:
    """(key, token, tf): occurrences of every distinct token of each bag.

    All tokens of a bag are in one row, so this needs no shuffle: the bag
    is sorted (`sort_array`), the starts of runs of equal tokens are found,
    and each run becomes one (token, length) pair. An explode followed by
    ``groupBy(key, token)`` would instead shuffle every (bag, token) pair,
    which is about as large as the text itself and hardly shrinks in the
    map-side combine (most tokens occur once or twice in a bag).
    """
    s = df.select(key, F.sort_array(bag_col).alias("_s"))
    n = F.size("_s")
    # position i starts a run when it is the first or differs from i - 1
    # (CASE, so element_at(_s, 0) is never evaluated)
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: F.when(i == 1, F.lit(True))
                      .otherwise(F.element_at("_s", i) != F.element_at("_s", i - 1)))
    # sequence(1, 0) counts down, so empty (and null) bags get no starts
    s = s.withColumn("_st", F.when(n > 0, starts).otherwise(F.array().cast("array<int>")))
    ends = F.concat(F.slice("_st", 2, F.greatest(n, F.lit(1))), F.array(n + 1))
    runs = F.zip_with("_st", ends, lambda a, b: F.struct(
        F.element_at("_s", a).alias("token"), (b - a).cast("bigint").alias("tf")))
    # zip_with pads the shorter array with nulls: an empty bag has no start
    # but one end, and that padded pair is not a run
    runs = F.filter(runs, lambda r: r["tf"].isNotNull())
    return s.select(key, F.inline(runs))


def tfidf_terms(df: DataFrame, key: str, bag_col: str = "tokens",
                min_doc_freq: int = 0, share: int = HOT_SHARE) -> DataFrame:
    """M9: (key, token, tf, doc_freq, idf, tfidf) for every token of a bag.

    tf = occurrences in the bag (computed inside the row, no shuffle);
    doc_freq = bags containing the token, partially aggregated; idf =
    ln((m + 1) / (doc_freq + 1)) with m the number of bags (MLlib's formula;
    tokens below `min_doc_freq` get idf 0, as in MLlib).

    The (key, token, tf) rows are written once, so the text is tokenized once.
    The idf table is joined back on the token, where some tokens are in every
    bag: the most frequent, a bounded number that has all tokens with more than
    one in `share` rows, take a broadcast of their idf rows; the rows of the
    other tokens are shuffled, none of which is above the share.
    """
    terms = materialize(bag_term_counts(df, key, bag_col), "terms")
    n_docs = df.select(key).count()
    dfreq = terms.groupBy("token").agg(F.count(F.lit(1)).alias("doc_freq"))
    idf = F.when(F.col("doc_freq") >= F.lit(min_doc_freq),
                 F.log(F.lit(n_docs + 1.0) / (F.col("doc_freq") + F.lit(1.0)))
                 ).otherwise(F.lit(0.0))
    idf_t = materialize(dfreq.withColumn("idf", idf), "idf")
    # a row for each number of documents: tokens that are in so many or more
    sizes = idf_t.groupBy("doc_freq").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_n", F.sum("_n").over(Window.orderBy(F.desc("doc_freq"))))
    least = sizes.where(F.col("_n") <= max(share, MAX_BROADCAST_ROWS)).agg(F.min("doc_freq")).first()[0]
    if least is None:   # no tokens, or more than that bound in equally many documents each
        found = terms.join(idf_t, "token")
    else:
        known = terms.join(F.broadcast(idf_t.where(F.col("doc_freq") >= F.lit(least))), "token", "left")
        rest = known.where(F.col("idf").isNull()).select(*terms.columns).join(idf_t.where(F.col("doc_freq") < F.lit(least)), "token")
        found = known.where(F.col("idf").isNotNull()).unionByName(rest)
    return (found.select(key, "token", "tf", "doc_freq", "idf",
                         (F.col("tf") * F.col("idf")).alias("tfidf")))


def count_vector_rows(df: DataFrame, key: str, bag_col: str = "tokens", from_idx: int = 0, words: DataFrame | None = None) -> DataFrame:
    """M5 as a table: (key, idx, tf) with the numbers of the `vocabulary`, from `from_idx` on.

    MLlib's vectorizer keeps its vocabulary on the driver and so bounds it;
    this table has no bound. `words`: the written vocabulary, if there is one.
    The hot tokens are known from its counts: they are the first, so that none
    is left beyond the share's number and the terms needn't be written.
    """
    words = materialize(vocabulary(df, bag_col), "words") if words is None else words
    total = words.agg(F.sum("count")).first()[0] or 0
    hot = [r[0] for r in words.where(F.col("count") * HOT_SHARE > total).select("token").collect()]
    terms, wanted = bag_term_counts(df, key, bag_col), words.where(F.col("idx") >= from_idx).select("idx", "token")
    if from_idx >= HOT_SHARE:
        found = terms.where(~F.col("token").isin(hot)).join(wanted, "token") if hot else terms.join(wanted, "token")
    else:
        found = join_hot(materialize(terms, "terms"), wanted, "token", hot=hot)
    return found.select(key, "idx", "tf")


def hashed_index(df: DataFrame, bag_col: str, num_features: int) -> DataFrame:
    """M3, inverted: (token, count, idx), the place that HashingTF gives each token of the table.

    MLlib's own transformer hashes one bag for each distinct token, so the
    numbers are its own whatever the version.
    """
    counts = token_rows(df, bag_col).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    tf = HashingTF(inputCol="_bag", outputCol="_tf", numFeatures=num_features)
    hashed = tf.transform(counts.withColumn("_bag", F.array("token")))
    return hashed.select("token", "count", F.element_at(F.unwrap_udt("_tf")["indices"], 1).alias("idx"))


def hashed_names(df: DataFrame, bag_col: str, num_features: int) -> DataFrame:
    """(idx, token, token_count, n_tokens, n_all) for each place in use: its most frequent token, how often that
    occurs, how many tokens share the place, and how often they occur together. Of equal tokens the first."""
    best = F.min(F.struct((-F.col("count")).alias("less"), "token"))
    return (hashed_index(df, bag_col, num_features).groupBy("idx")
            .agg(best.alias("best"), F.count(F.lit(1)).alias("n_tokens"), F.sum("count").alias("n_all"))
            .select("idx", "best.token", (-F.col("best.less")).alias("token_count"), "n_tokens", "n_all"))
