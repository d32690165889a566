"""Classification metrics as DataFrames.

Everything is derived from the confusion cells, ``groupBy(label,
prediction).count()``: one partially aggregated pass over the predictions,
after which all tables have at most classes^2 rows. Definitions follow
MLlib's ``MulticlassMetrics``:

* classes of the per-class table are the true labels;
* precision = tp / (tp + fp), 0 when nothing was predicted as the class;
* recall = tp / support; F1 = 2 p r / (p + r), 0 when p + r = 0;
* macro F1 = mean F1 over true labels; weighted F1 = support-weighted mean
  (the reference's "micro F1" titles show this number);
* accuracy = micro F1 for single-label data = sum(tp) / rows.

The confusion matrix keeps every row, also predictions of a class that
never occurs as a label (MLlib's matrix silently drops those).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagwise.operators.joins import bounded_table


def confusion_cells(pred: DataFrame, label_col: str = "label",
                    prediction_col: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return (pred.groupBy(F.col(label_col).alias("label"),
                         F.col(prediction_col).alias("prediction"))
                .agg(F.count(F.lit(1)).alias("n")))


def accuracy(pred: DataFrame, label_col: str = "label",
             prediction_col: str = "prediction") -> DataFrame:
    """Share of rows predicted right, with the row count."""
    hit = (F.col(label_col) == F.col(prediction_col)).cast("double")
    return pred.agg(F.avg(hit).alias("accuracy"),
                    F.count(F.lit(1)).alias("n_rows"))


def per_class(pred: DataFrame, label_col: str = "label",
              prediction_col: str = "prediction",
              cells: DataFrame | None = None) -> DataFrame:
    """Tp, fp, fn, support, precision, recall, F1 per true label."""
    c = cells if cells is not None else confusion_cells(pred, label_col, prediction_col)
    right = F.col("label") == F.col("prediction")
    # each cell counts for its label, and if wrong also against the predicted class
    n = F.col("n")
    one = F.struct(F.col("label"), F.when(right, n).otherwise(0).alias("tp"), n.alias("support"), F.lit(0).cast("bigint").alias("fp"))
    other = F.struct(F.col("prediction").alias("label"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("support"),
                     F.when(~right, n).otherwise(0).alias("fp"))
    parts = c.select(F.explode(F.array(one, other)).alias("c")).select("c.*")
    t = (parts.where("support > 0 or label is not null").groupBy("label")
         .agg(*(F.sum(x).cast("bigint").alias(x) for x in ("tp", "support", "fp"))).where("support > 0")
         .withColumn("fn", F.col("support") - F.col("tp")))
    tp = F.col("tp").cast("double")
    p = F.when(F.col("tp") + F.col("fp") == 0, F.lit(0.0)).otherwise(
        tp / (F.col("tp") + F.col("fp")))
    r = tp / F.col("support")
    t = t.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("precision") * F.col("recall")
        / (F.col("precision") + F.col("recall")))
    return t.withColumn("f1", f1).select(
        "label", "tp", "fp", "fn", "support", "precision", "recall", "f1")


def summary(pred: DataFrame, label_col: str = "label",
            prediction_col: str = "prediction",
            cells: DataFrame | None = None) -> DataFrame:
    """E1, E4, E5 in one row: accuracy, macro F1, weighted F1, rows."""
    pc = per_class(pred, label_col, prediction_col, cells)
    return pc.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.sum("support").cast("bigint").alias("n_rows"))


def macro_f1(pred: DataFrame, label_col: str = "label",
             prediction_col: str = "prediction") -> DataFrame:
    """Mean per-class F1 over the true labels."""
    return per_class(pred, label_col, prediction_col).agg(
        F.avg("f1").alias("macro_f1"))


def weighted_f1(pred: DataFrame, label_col: str = "label",
                prediction_col: str = "prediction") -> DataFrame:
    """E5: support-weighted F1 (MLlib's weightedFMeasure)."""
    return per_class(pred, label_col, prediction_col).agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def _class_name(v) -> str:
    if isinstance(v, float) and v.is_integer():
        v = int(v)
    return str(v).replace(".", "_").replace("-", "m").replace(" ", "_")


def confusion_matrix(pred: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction",
                     classes=None, prefix: str = "p_") -> DataFrame:
    """One row per true label, one count column per class.

    ``classes`` (the label indexer's labels, or their indices) fixes the
    columns; by default they are the labels and predictions seen, read from
    the (bounded) confusion cells.
    """
    cells = confusion_cells(pred, label_col, prediction_col)
    if classes is None:
        vals = bounded_table(
            cells.select(F.col("label").alias("v"))
                 .union(cells.select(F.col("prediction").alias("v")))
                 .distinct())
        if not vals.bounded:
            raise ValueError("too many classes for a confusion matrix")
        classes = sorted(r[0] for r in vals.rows if r[0] is not None)
    aggs = [F.coalesce(F.sum(F.when(F.col("prediction") == F.lit(v), F.col("n"))),
                       F.lit(0)).cast("bigint").alias(prefix + _class_name(v))
            for v in classes]
    return cells.groupBy("label").agg(*aggs)


# ------------------------------------------------------------ intervals

#: Sixteen bits of hash below each of these give 0, 1, 2, ... draws of a row: the Poisson law of mean one.
POISSON = tuple(int(65536 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(9))
PER_HASH = 8    # replicates that one hash serves


def bootstrap(pred: DataFrame, key: str, replicates: int = 200, seed=7, label_col: str = "label",
              prediction_col: str = "prediction") -> DataFrame:
    """(replicate, accuracy, macro_f1, weighted_f1) of Poisson bootstrap samples of the predictions.

    A row's number of draws in a replicate comes from a hash of its key, so
    the samples are the same for any partitioning. All replicates are one
    aggregation over (replicate, label, prediction), partially aggregated.
    """
    block = F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // PER_HASH))).alias("_block")
    hashes = pred.select(F.col(label_col).alias("label"), F.col(prediction_col).alias("prediction"), F.col(key).alias("_key"), block)
    digest = F.md5(F.concat_ws(":", F.col("_key").cast("string"), F.lit(str(seed)), F.col("_block").cast("string")))

    def draws(i: int) -> Column:
        bits = F.conv(F.substring("_digest", 4 * i + 1, 4), 16, 10).cast("int")
        return F.struct((F.col("_block") * PER_HASH + i).alias("replicate"), sum((bits >= t).cast("long") for t in POISSON).alias("n"))
    each = (hashes.withColumn("_digest", digest)
            .select("label", "prediction", F.explode(F.array(*map(draws, range(PER_HASH)))).alias("d"))
            .where((F.col("d.n") > 0) & (F.col("d.replicate") < replicates)))
    cells = each.groupBy("d.replicate", "label", "prediction").agg(F.sum("d.n").alias("n"))
    right = F.col("label") == F.col("prediction")
    n, none = F.col("n"), F.lit(0).cast("bigint")
    one = F.struct("label", F.when(right, n).otherwise(none).alias("tp"), n.alias("support"), none.alias("fp"))
    other = F.struct(F.col("prediction").alias("label"), none.alias("tp"), none.alias("support"), F.when(~right, n).otherwise(none).alias("fp"))
    per = (cells.select("replicate", F.explode(F.array(one, other)).alias("c")).groupBy("replicate", "c.label")
           .agg(*(F.sum(f"c.{x}").alias(x) for x in ("tp", "support", "fp"))).where("support > 0"))
    # 2 tp / (support + predicted) is the harmonic mean of precision and recall
    f1 = 2.0 * F.col("tp") / (F.col("support") + F.col("tp") + F.col("fp"))
    return per.groupBy("replicate").agg((F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg(f1).alias("macro_f1"),
                                        (F.sum(f1 * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def intervals(replicated: DataFrame, level: float = 0.95) -> DataFrame:
    """(metric, mean, low, high) over the replicates of `bootstrap`: exact quantiles, interpolated."""
    names = ("accuracy", "macro_f1", "weighted_f1")
    each = replicated.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("x")) for m in names))).alias("m")).select("m.*")
    tail = (1 - level) / 2
    return each.groupBy("metric").agg(F.avg("x").alias("mean"), F.percentile("x", F.lit(tail)).alias("low"), F.percentile("x", F.lit(1 - tail)).alias("high"))
