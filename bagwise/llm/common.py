"""Helpers shared by the operators of this folder.

`written` cuts lineage with a Parquet table in the folder that the cluster
names in `spark.checkpoint.dir`: such a table outlives a lost executor, is
columnar and can be read by any number of later branches.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_dir(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; local sessions without it get one of their own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="bagwise-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS = 1000         # whole texts in a batch for Python


def written(df: DataFrame, name: str = "cut", records: int | None = None) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again; the shuffle files behind it go at once.

    `records`: rows of a batch for Python in this job, where they hold texts.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    wanted = {CLEANUP: "true"} | ({RECORDS: str(records)} if records else {})
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a `written` table that nothing reads any more."""
    files = table.inputFiles()
    if files:
        jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(conf).delete(path, True)


def to_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed (a shared or local path)."""
    env = spark.sparkContext.environment
    if REPO not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH"), REPO) if x)


def map_rows(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str) -> DataFrame:
    to_workers(df.sparkSession)
    return df.mapInArrow(function, schema)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) under these names alone, so that no other column can clash; null text is empty."""
    as_is = id_col == "doc_id" and dict(docs.dtypes)[id_col] == "bigint"  # an alias would hide equal exchanges from Spark
    return docs.select(F.col(id_col) if as_is else F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], text_col: str = "text",
           chars: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut so that the texts of one slice hold about `chars` characters: bounded memory."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
        start = held = 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= chars:
                yield batch.slice(start, i + 1 - start), texts[start:i + 1]
                start, held = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]
