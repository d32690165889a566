"""Feature tables (M1, M2, M8, M9) against MLlib's fitted state."""
import math

from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, StringIndexer
from pyspark.sql import functions as F

from bagwise.operators import features as feat
from bagwise.plans import catalog
from bagwise.plans import stages as st
from conftest import SF_SMALL


def test_label_index_matches_string_indexer(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for order in (feat.FREQUENCY_DESC, feat.FREQUENCY_ASC):
        ours = [r["lang"] for r in feat.label_index(d, "lang", order).orderBy("idx").collect()]
        theirs = list(StringIndexer(inputCol="lang", outputCol="i",
                                    stringOrderType=order).fit(d).labels)
        assert ours == theirs


def test_label_index_ties_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("c",), ("a",)], "c string")
    for order in (feat.FREQUENCY_DESC, feat.FREQUENCY_ASC):
        got = [r["c"] for r in feat.label_index(df, "c", order).orderBy("idx").collect()]
        assert got == ["a", "b", "c"]


def test_vocabulary_matches_count_vectorizer(spark):
    b = catalog.doc_bags(spark, SF_SMALL)
    voc = feat.vocabulary(b, vocab_size=300).orderBy("idx").collect()
    assert [r["idx"] for r in voc] == list(range(len(voc)))
    counts = [r["count"] for r in voc]
    assert counts == sorted(counts, reverse=True)
    cv = CountVectorizer(inputCol="tokens", outputCol="f").fit(b)
    # same multiset of counts at the top (ties may be ordered differently)
    full = {r["token"]: r["count"] for r in feat.vocabulary(b).collect()}
    assert set(cv.vocabulary) == set(full)


def test_count_vectorizer_from_vocabulary_is_deterministic(spark):
    b = catalog.doc_bags(spark, SF_SMALL)
    m1 = st.count_vectorizer_from(b, "tokens", vocab_size=200)
    m2 = st.count_vectorizer_from(b.repartition(5), "tokens", vocab_size=200)
    assert list(m1.vocabulary) == list(m2.vocabulary)


def test_tfidf_terms_match_mllib_idf(spark):
    b = catalog.doc_bags(spark, SF_SMALL)
    terms = feat.tfidf_terms(b, "doc_id")
    tf = HashingTF(inputCol="tokens", outputCol="h", numFeatures=1 << 20)
    idf = IDF(inputCol="h", outputCol="x").fit(tf.transform(b)).idf.toArray()
    per_token = {r["token"]: r["idf"] for r in terms.select("token", "idf").distinct().collect()}
    # hash index of every token in one job (indexOf is one JVM call a token)
    one = spark.createDataFrame([([t],) for t in per_token], "tokens array<string>")
    by_index = {}
    for r in tf.transform(one).collect():
        by_index.setdefault(int(r["h"].indices[0]), []).append(r["tokens"][0])
    # compare every token that has its hash bucket to itself
    checked = 0
    for i, toks in by_index.items():
        if len(toks) == 1:
            assert abs(idf[i] - per_token[toks[0]]) < 1e-9
            checked += 1
    assert checked > 0.95 * len(per_token)
    n = b.count()
    one = terms.first()
    assert abs(one["idf"] - math.log((n + 1.0) / (one["doc_freq"] + 1.0))) < 1e-12
    assert abs(one["tfidf"] - one["tf"] * one["idf"]) < 1e-12


def test_vocabulary_prefilter_equals_plain_top_k(spark):
    from bagwise.functions.tokens import token_rows
    b = catalog.doc_bags(spark, SF_SMALL)
    counts = token_rows(b).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    ranked = [(r["token"], r["count"]) for r in
              counts.orderBy(F.desc("count"), F.asc("token")).collect()]
    for k in (1, 7, 50, 333, len(ranked), len(ranked) + 10):
        got = [(r["token"], r["count"]) for r in
               feat.vocabulary(b, vocab_size=k).orderBy("idx").collect()]
        assert got == ranked[:k]


def test_label_list_and_literal_table(spark):
    from bagwise.sources.tables import literal_table
    df = literal_table(spark, [("x",), ("y",), ("y",)], "c string")
    assert feat.label_list(df, "c") == ["y", "x"]
    assert feat.label_list(df, "c", feat.FREQUENCY_ASC) == ["x", "y"]


def test_mllib_count_vectorizer_stage(spark):
    b = catalog.doc_bags(spark, SF_SMALL)
    m = st.count_vectorizer("tokens", "f", vocab_size=50).fit(b)
    ours = {r["token"] for r in feat.vocabulary(b, vocab_size=50).collect()}
    # same top-50 except possibly for ties at the boundary count
    assert len(set(m.vocabulary) & ours) >= 45


def test_count_vectors_of_a_written_vocabulary(spark):
    """One vocabulary for the vectorizer and for the tokens beyond it; hot tokens come before the rest."""
    import random
    from collections import Counter

    from bagwise.session import materialize
    rng = random.Random(3)
    rows = [(i, ["hot"] * rng.randrange(3) + [f"t{rng.randrange(1400)}" for _ in range(40)]) for i in range(150)] + [(150, []), (151, None)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    words = materialize(feat.vocabulary(df), "words")
    idx = {r["token"]: r["idx"] for r in words.collect()}
    for low in (0, 5, 1001):
        got = {(r[0], r[1]): r[2] for r in feat.count_vector_rows(df, "doc_id", from_idx=low, words=words).collect()}
        assert got == {(d, idx[t]): n for d, b in rows for t, n in Counter(b or ()).items() if idx[t] >= low}
    assert st.count_vectorizer_from(df, "tokens", vocab_size=7, words=words).vocabulary == [t for t, i in sorted(idx.items(), key=lambda x: x[1]) if i < 7]


def test_tfidf_terms_of_frequent_tokens_are_broadcast(spark, monkeypatch):
    rows = [(i, ["all", f"half{i % 2}", f"tenth{i % 10}", f"own{i}"]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    found = []
    for most in (1000, 13, 2, 0):   # all tokens, those of six documents or more, the first, the first
        monkeypatch.setattr(feat, "MAX_BROADCAST_ROWS", most)
        found.append(sorted(map(tuple, feat.tfidf_terms(df, "doc_id", share=1).collect())))
    assert len(found[0]) == 240 and all(f == found[0] for f in found)
    alike = spark.createDataFrame([(i, [f"own{i}"]) for i in range(9)], "doc_id long, tokens array<string>")
    assert feat.tfidf_terms(alike, "doc_id", share=1).count() == 9   # one frequency, above the bound
    assert feat.tfidf_terms(alike.limit(0), "doc_id").count() == 0
