"""Scoring a file stream with a fitted pipeline."""
import tempfile

from bagwise.plans import catalog
from bagwise.plans import models as mdl
from bagwise.streaming.scoring import score_stream, write_scores
from conftest import SF_SMALL


def test_stream_scores_every_row(spark):
    prep = mdl.prepare_training(catalog.doc_bags(spark, SF_SMALL), "doc_id", "lang")
    lr = mdl.logistic_regression(max_iter=5)
    model = mdl.fit(mdl.build_pipeline(mdl.FEATURES_TFIDF, lr, prep.train_all, "lang",
                                       "tokens", num_features=500), prep.train_all)
    src = tempfile.mkdtemp(prefix="bagwise-src-")
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text") \
        .repartition(3).write.mode("overwrite").parquet(src)
    out = tempfile.mkdtemp(prefix="bagwise-out-")
    q = write_scores(score_stream(spark, model, src), out, name="test_scores")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 200
    assert set(got.columns) == {"doc_id", "prediction", "predicted_class"}
