"""X1 / X2 edge cases (FIXTURES.md section 3) and tokenizer equivalence."""
from pyspark.sql import functions as F

from bagwise.functions.tokens import (list_tokens, token_rows, word_tokens,
                                      word_tokens_reference_form)
from conftest import SF_MID


def _apply(spark, col_fn, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(col_fn(F.col("text"))).collect()]


def test_list_tokens_edges(spark):
    texts = ["", "[]", "['a']", "[\"it's\", 'B']", None, "['a', 'b', '']",
             "['A b', 'c-d (12 oz.)']", "abc"]
    got = _apply(spark, list_tokens, texts)
    assert got == [[""], [""], ["a"], ["it's\", 'b"], None, ["a", "b"],
                   ["a b", "c-d (12 oz.)"], [""]]


def test_list_tokens_without_parity_keeps_trailing_empty(spark):
    got = _apply(spark, lambda c: list_tokens(c, strip_trailing_empty=False),
                 ["['a', 'b', '']"])
    assert got == [["a", "b", ""]]


def test_list_tokens_all_empty_items(spark):
    # the JVM split drops all trailing empties: ['', ''] gives no item
    assert _apply(spark, list_tokens, ["['', '']"]) == [[]]


def test_word_tokens_edges(spark):
    texts = ["", "[]", "['a']", "[\"it's\", 'B']", None, "['a', 'b', '']",
             "['A b', 'c-d (12 oz.)']", "abc"]
    got = _apply(spark, word_tokens, texts)
    assert got == [[], [], ["a"], ["its", "b"], None, ["a", "b"],
                   ["a", "b", "c", "d"], ["abc"]]


def test_word_tokens_glue_and_special_lowercase(spark):
    got = _apply(spark, word_tokens, ["a\tb\nc", "İSTANBUL Kelvin", "ÀÉÎ x-y"])
    assert got == [["abc"], ["istanbul", "kelvin"], ["x", "y"]]


def test_word_tokens_custom_stops(spark):
    got = _apply(spark, lambda c: word_tokens(c, stop_tokens=("the", "a")),
                 ["The cat and a dog oz"])
    assert got == [["cat", "and", "dog", "oz"]]


def test_fast_tokenizer_equals_definition_on_documents(spark):
    d = spark.read.parquet(f"{SF_MID}/documents.parquet")
    bad = d.where(~F.coalesce(word_tokens("text") == word_tokens_reference_form("text"),
                              F.lit(False))).count()
    assert bad == 0


def test_token_rows_skip_empty_and_null(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)],
                               "id long, tokens array<string>")
    rows = sorted(tuple(r) for r in token_rows(df, keep=["id"]).collect())
    assert rows == [(1, "a"), (1, "b")]


def test_token_rows_tokenizes_once(spark):
    d = spark.read.parquet(f"{SF_MID}/documents.parquet")
    plan = token_rows(d.select(word_tokens("text").alias("tokens")))._jdf \
        .queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
