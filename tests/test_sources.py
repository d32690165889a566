"""Sources: declared schemas, key checks, basket builder."""
import os
import tempfile

from pyspark.sql import functions as F

from bagwise.sources import tables
from conftest import SF_SMALL


def test_documents_match_declared_schema(spark):
    d = spark.read.parquet(tables.table_path(SF_SMALL, "documents"))
    assert tables.check_schema(d, tables.DOCUMENTS_SCHEMA) == []
    lab = spark.read.parquet(tables.table_path(SF_SMALL, "labels"))
    assert tables.check_schema(lab, tables.LABELS_SCHEMA) == []
    assert tables.check_schema(d.drop("lang"), tables.DOCUMENTS_SCHEMA) == ["lang"]


def test_key_violations(spark):
    d = tables.documents(spark, SF_SMALL, ["doc_id"])
    assert tuple(tables.key_violations(d, "doc_id").first()) == (0, 0)
    bad = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k long")
    assert tuple(tables.key_violations(bad, "k").first()) == (1, 1)


def test_csv_with_declared_schema(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="bagwise-csv-"), "train.csv")
    with open(path, "w") as f:
        f.write('id,cuisine,ingredients\n1,greek,"[\'romaine lettuce\', \'feta\']"\n')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("cuisine", T.StringType()),
                           T.StructField("ingredients", T.StringType())])
    df = tables.read_csv_table(spark, path, schema)
    from bagwise.functions.tokens import list_tokens
    assert df.select(list_tokens("ingredients")).first()[0] == ["romaine lettuce", "feta"]


def test_baskets_and_items_agree(spark):
    from bagwise.functions.tokens import list_tokens
    b = tables.baskets(spark, SF_SMALL).select("o_orderkey", F.explode(list_tokens("ingredients")).alias("item"))
    i = tables.basket_lines(spark, SF_SMALL).select("o_orderkey", F.lower("p_name").alias("item"))
    assert sorted(map(tuple, b.collect())) == sorted(map(tuple, i.collect()))
