"""Scans (S1, S2), declared schemas (S3), key checks, basket builder (F2).

Every reader selects only the columns the caller names, so the parquet scan's
`ReadSchema` carries just those columns; filters written on source columns
are pushed into the scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bagwise.functions.hashing import hash_prefix_int, row_hash

DOCUMENTS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

LABELS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("quality", T.IntegerType()),
    T.StructField("toxic", T.IntegerType()),
])


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns=None) -> DataFrame:
    """Scan one parquet table, pruned to `columns` when given."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return df


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType,
                   header: bool = True) -> DataFrame:
    """S1 for CSV exports (the reference's tables came from CSV): declared
    schema, no inference pass over the data."""
    return spark.read.schema(schema).option("header", header).option(
        "multiLine", True).option("escape", '"').csv(path)


def check_schema(df: DataFrame, expected: T.StructType) -> list[str]:
    """S3: names of expected columns that are missing or typed differently."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [f.name for f in expected.fields
            if f.name not in have or have[f.name] != f.dataType]


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """`df`, or a plain failure that names the columns that are missing or of another type."""
    bad = check_schema(df, expected)
    if bad:
        have = dict(df.dtypes)
        raise ValueError("bad table: " + ", ".join(f"{c} is {have.get(c, 'missing')}, not {expected[c].dataType.simpleString()}" for c in bad))
    return df


def load_facts(df: DataFrame, key: str, class_col: str | None = None, seed=7) -> DataFrame:
    """S3, one row and one scan: rows, null keys, keys seen more than once, null classes, and the sum of the rows'
    key hashes (equal for equal keys in any order).

    A split labels each row by its key, so the key must be present and
    unique. Aggregated with partial aggregation, so a hot key is harmless;
    all other facts ride on the same aggregation.
    """
    no_class = F.col(class_col).isNull() if class_col else F.lit(False)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(no_class, 1)).alias("no_class"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), zero).alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull() & (F.col("n") > 1), 1)), zero).cast("bigint").alias("duplicate_keys"),
        F.coalesce(F.sum("no_class"), zero).alias("null_classes"),
        F.coalesce(F.sum(hash_prefix_int(row_hash(key, seed)) * F.col("n")), zero).alias("key_hash_sum"))


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """One row: null keys and keys seen more than once."""
    return load_facts(df, key).select("null_keys", "duplicate_keys")


def documents(spark: SparkSession, sf_dir: str,
              columns=("doc_id", "text", "lang")) -> DataFrame:
    """labeled word bags (class `lang`, text `text`, key `doc_id`); fails plainly on another schema."""
    df = spark.read.parquet(table_path(sf_dir, "documents"))
    wanted = T.StructType([f for f in DOCUMENTS_SCHEMA if f.name in columns])
    return require_schema(df, wanted).select(*columns)


def unlabeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without their class column (the unlabeled table)."""
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"])


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """imbalanced two-class labels keyed by doc_id."""
    return require_schema(read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]), LABELS_SCHEMA)


def basket_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 as rows: (o_orderkey, o_orderpriority, p_name) for every order line.

    No per-order collect: a very large order is just many rows spread over
    tasks.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return (li.join(p, li.l_partkey == p.p_partkey)
              .join(o, li.l_orderkey == o.o_orderkey)
              .select("o_orderkey", "o_orderpriority", "p_name"))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per order with its part names as list text.

    ``ingredients`` = ``['name a', 'name b', ...]``, names sorted (the line
    number is not unique, so the name is the only stable order). This is
    the reference's input format, one bag per row, so the items of an order
    are gathered into that row; use `basket_lines` when only item
    statistics are needed. The part table is joined on its key (Catalyst
    picks broadcast only when its measured size allows).
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    items = (li.join(p, li.l_partkey == p.p_partkey)
               .groupBy("l_orderkey")
               .agg(F.sort_array(F.collect_list("p_name")).alias("names")))
    return (o.join(items, o.o_orderkey == items.l_orderkey)
             .select("o_orderkey", "o_orderpriority",
                     F.concat(F.lit("['"), F.array_join("names", "', '"),
                              F.lit("']")).alias("ingredients")))


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal table (report rows, fixtures)."""
    return spark.createDataFrame(rows, schema)
