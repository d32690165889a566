"""The queries of the operators and of the pipeline, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from bagwise.llm import bpe, filter_audit, imatch, language_id, line_dedup, ngram_join, nn_descent, pack, pii, resample, secrets, toxicity, url_filter

WORD_BPE = "word_bpe_49k.json"


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)


def read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def joined(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_columns(found, kinds, *further):
    base = F.filter("spans", lambda s: s["base"])

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(number, kinds),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), *further)


def op1(spark, sf_dir):
    return span_columns(pii.find_personal_data(read(spark, sf_dir, "documents")), pii.KINDS)


def op2(spark, sf_dir):
    found = bpe.bpe_encode_decode(read(spark, sf_dir, "documents"), word_bpe())
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


def op3(spark, sf_dir):
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))
    costs = F.transform("costs", lambda c: F.concat_ws(":", c["start"].cast("string"), c["end"].cast("string"), F.format_number(c["cost"], 3)))
    return span_columns(found, secrets.KINDS, F.size("costs").cast("long").alias("n_costed"), F.array_join(costs, ",").alias("costs"))


def op4(spark, sf_dir):
    scored = toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5(spark, sf_dir):
    return imatch.fingerprints(read(spark, sf_dir, "documents"))


def op6(spark, sf_dir):
    found = language_id.languages(language_id.page_evidence(read(spark, sf_dir, "pages")),
                                  language_id.labelled_documents(read(spark, sf_dir, "documents")))
    return found.withColumnRenamed("doc_id", "page_id").withColumn("posterior", F.round("posterior", 6))


def op7(spark, sf_dir):
    return ngram_join.ngram_jaccard_components(read(spark, sf_dir, "documents"), size=4, percent=85)


def op8(spark, sf_dir):
    found = nn_descent.embedding_links(read(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op9(spark, sf_dir):
    """Per document: its lines, how many go, and which."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    gone = (line_dedup.duplicate_lines(docs).groupBy("doc_id")
            .agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("line")), ",").alias("lines")))
    return (docs.select("doc_id", F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"))
            .join(gone, "doc_id", "left")
            .select("doc_id", "n_lines", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("lines", F.lit("")).alias("removed_lines")))


def op10(spark, sf_dir):
    return pack.harmonic_pack(read(spark, sf_dir, "documents"), word_bpe(), keep_ids=False)


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op11(spark, sf_dir):
    words = url_filter.word_counts(read(spark, sf_dir, "documents"))
    found = url_filter.url_verdicts(read(spark, sf_dir, "pages"), words, URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "odds", F.array_join("words", " ").alias("host_words"))


def op12(spark, sf_dir):
    return resample.importance_resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13(spark, sf_dir):
    return filter_audit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {"op1_skip_chain_crf": op1, "op2_bpe_tree": op2, "op3_guess_cost": op3, "op4_toxicity_subwords": op4, "op5_imatch": op5, "op6_language_evidence": op6, "op7_ngram_jaccard_join": op7, "op8_nn_descent": op8, "op9_line_dedup": op9, "op10_harmonic_packing": op10,
           "op11_url_bayes": op11, "op12_crc_resampling": op12, "op13_filter_audit": op13}
ORACLE_SQL: dict[str, str] = {"op12_crc_resampling": resample.SQL, "op13_filter_audit": filter_audit.SQL}
