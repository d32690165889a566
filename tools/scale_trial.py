"""Scale trial: time core operators on a large copy of the documents table.

Usage: python tools/scale_trial.py <copy_dir> [copies] [cpus]

The copy is made once from /root/testdata/sf0.1/documents.parquet: `copies`
copies with shifted keys, written as many parquet files. To stress the hot
paths, every third copy carries the text of one single document, so one bag
holds about a third of all rows (a hot dedup group and hot tokens), and the
largest class holds ~60 % of the rows. Each operator runs through the noop
sink; times go to stdout as one JSON line.
"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from bagwise import build_session  # noqa: E402
from bagwise.functions.tokens import word_tokens  # noqa: E402
from bagwise.operators import features as feat  # noqa: E402
from bagwise.operators import prepare, profile, split  # noqa: E402

SRC = "/root/testdata/sf0.1/documents.parquet"


def make_copy(spark, out, copies):
    if os.path.exists(os.path.join(out, "_SUCCESS")):
        return
    d = spark.read.parquet(SRC).select("doc_id", "text", "lang")
    hot_text = d.orderBy("doc_id").limit(1).select("text").scalar()
    big = (d.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
             .select((F.col("doc_id") + F.col("k") * 1_000_000).alias("doc_id"),
                     F.when(F.col("k") % 3 == 0, hot_text).otherwise(F.col("text"))
                     .alias("text"), "lang"))
    big.repartition(8 * copies // 4 or 8).write.parquet(out)


def main():
    out = sys.argv[1]
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    spark = build_session(f"local[{cpus}]", app="bagwise-scale", shuffle_partitions=4 * cpus,
                          driver_memory="16g")
    make_copy(spark, out, copies)
    docs = spark.read.parquet(out)
    bags = docs.select("doc_id", "lang", word_tokens("text").alias("tokens"))
    runs = {
        "top_tokens_per_class": lambda: profile.top_tokens_per_class(bags, "lang", 10),
        "split_stratified": lambda: split.with_split(docs.select("doc_id", "lang"), "doc_id",
                                                     0.2, 7, by="lang"),
        "dedup_bags": lambda: prepare.dedup_bags(bags, "doc_id"),
        "class_weights_rows": lambda: prepare.with_class_weights(bags, "lang"),
        "vocabulary": lambda: feat.vocabulary(bags),
        "tfidf_terms": lambda: feat.tfidf_terms(bags, "doc_id"),
    }
    times = {"rows": docs.count()}
    for name, make in runs.items():
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 2)
        print(name, times[name], file=sys.stderr)
    print(json.dumps(times))


if __name__ == "__main__":
    main()
