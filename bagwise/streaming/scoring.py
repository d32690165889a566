"""Scoring of arriving files with a fitted pipeline (B1 on Structured Streaming).

The reference has no streaming operator; this module only lets the scoring
step (B1/B2) run on a file stream. Every stage used (tokenizer expression,
vectorizer, forest / logistic model, IndexToString) is a stateless
row-wise transform, so the streaming plan is a plain map with no state
store. The sink is parquet with a checkpoint location on shared storage:
exactly-once output that resumes after driver or executor loss.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bagwise.functions.tokens import list_tokens, word_tokens
from bagwise.plans import models as mdl
from bagwise.session import checkpoint_dir

UNLABELED_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
])


def score_stream(spark: SparkSession, model: PipelineModel, source_path: str,
                 key: str = "doc_id", text_col: str = "text",
                 schema: T.StructType = UNLABELED_SCHEMA, tokenizer: str = "word",
                 bag_col: str = "tokens", max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame (key, prediction, predicted_class) over the
    parquet files arriving in `source_path`."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)
    tok = word_tokens(text_col) if tokenizer == "word" else list_tokens(text_col)
    bags = stream.select(key, tok.alias(bag_col))
    return mdl.score(model, bags, key)


def write_scores(scores: DataFrame, output_path: str, name: str = "scores",
                 checkpoint_location: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start the parquet sink. The checkpoint location defaults to a folder
    under the session's checkpoint folder (shared storage on a cluster)."""
    spark = scores.sparkSession
    cp = checkpoint_location
    if cp is None:
        base = checkpoint_dir(spark)
        if base is None:
            raise ValueError("no checkpoint location: set spark.checkpoint.dir "
                             "or pass checkpoint_location")
        cp = f"{base.rstrip('/')}/stream-{name}"
    w = (scores.writeStream.format("parquet").option("path", output_path)
         .option("checkpointLocation", cp).outputMode("append").queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
