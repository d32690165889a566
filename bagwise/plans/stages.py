"""MLlib stage builders (M1-M7).

Plain constructors with the reference's defaults; every random stage takes a
seed. The CountVectorizer can be built from a vocabulary table (M8), which
gives a vocabulary with a total order instead of MLlib's tie order that
depends on partitioning.
"""

from __future__ import annotations

from pyspark.ml.feature import (IDF, CountVectorizer, CountVectorizerModel,
                                HashingTF, IndexToString, StringIndexer,
                                Word2Vec)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.operators.features import FREQUENCY_DESC, vocabulary

# The reference's settings (fixed values).
TFIDF_NUM_FEATURES = 20000        # HashingTF for logistic regression
TFIDF_RF_NUM_FEATURES = 10000     # HashingTF for random forest
LR_MAX_ITER = 50
LR_REG_PARAM = 0.01
RF_NUM_TREES = 100
RF_MAX_DEPTH = 30
W2V_LR = dict(vector_size=350, min_count=2, window_size=10, max_iter=20)
W2V_PARTITIONS = 4
COOC = dict(dims=64, window=5, min_count=5)   # this library's own, for embeddings from counts
W2V_RF = dict(vector_size=128, min_count=1, window_size=25, max_iter=15)


def label_indexer(class_col: str, out: str = "label",
                  order: str = FREQUENCY_DESC, handle_invalid: str = "error") -> StringIndexer:
    """M1 / M2. Fit with ``error``: ``keep`` would add a class to the label
    metadata, and with it to every classifier fitted on the labels. Fitted
    models are set to ``keep`` afterwards (`models.fit`), so rows of unseen
    classes count as wrong in an evaluation instead of failing it."""
    return StringIndexer(inputCol=class_col, outputCol=out,
                         stringOrderType=order, handleInvalid=handle_invalid)


def label_names(indexer_model, prediction_col: str = "prediction",
                out: str = "predicted_class") -> IndexToString:
    """B2: class names back from predicted indices."""
    return IndexToString(inputCol=prediction_col, outputCol=out,
                         labels=list(indexer_model.labels))


def hashing_tf(bag_col: str, out: str = "tf", num_features: int = TFIDF_NUM_FEATURES) -> HashingTF:
    """M3."""
    return HashingTF(inputCol=bag_col, outputCol=out, numFeatures=num_features)


def idf(in_col: str = "tf", out: str = "features", min_doc_freq: int = 0) -> IDF:
    """M4: ln((m + 1) / (df + 1))."""
    return IDF(inputCol=in_col, outputCol=out, minDocFreq=min_doc_freq)


def count_vectorizer(bag_col: str, out: str = "features", vocab_size: int = 1 << 18,
                     min_df: float = 1.0) -> CountVectorizer:
    """M5, MLlib's own fit (ties in arbitrary order)."""
    return CountVectorizer(inputCol=bag_col, outputCol=out, vocabSize=vocab_size,
                           minDF=min_df)


def count_vectorizer_from(train: DataFrame, bag_col: str, out: str = "features",
                          vocab_size: int = 1 << 18, words: DataFrame | None = None) -> CountVectorizerModel:
    """M5 + M8: a CountVectorizerModel whose vocabulary is the M8 table (`words`, if it is written already).

    The vocabulary is at most `vocab_size` tokens, the same bound MLlib puts
    on the list it keeps on the driver and ships to the tasks. It is
    collected as a JVM string array and handed to the model constructor
    there: `from_vocabulary` would copy it into the JVM one Py4J call per
    token (about 20 s for 2^18 tokens).
    """
    spark = train.sparkSession
    jvm = spark.sparkContext._jvm
    table = vocabulary(train, bag_col, vocab_size) if words is None else words.where(F.col("idx") < vocab_size)
    jds = table.orderBy("idx").select("token")._jdf
    jarr = getattr(jds, "as")(jvm.org.apache.spark.sql.Encoders.STRING()).collect()
    model = CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", jarr)
    return model.setInputCol(bag_col).setOutputCol(out)


def word2vec(bag_col: str, out: str = "features", vector_size: int = 100,
             min_count: int = 5, window_size: int = 5, max_iter: int = 1,
             seed: int = 42, num_partitions: int = W2V_PARTITIONS) -> Word2Vec:
    """M6: bag embedding = mean of its token vectors.

    MLlib trains on `num_partitions` partitions and averages their vectors, so
    the number is a parameter of the model, not of the cluster."""
    return Word2Vec(inputCol=bag_col, outputCol=out, vectorSize=vector_size, minCount=min_count,
                    windowSize=window_size, maxIter=max_iter, seed=seed, numPartitions=num_partitions)
