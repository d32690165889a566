"""A fitted forest as a table of nodes (L4, I1-I3), and what follows from the table.

MLlib's model answers two questions, a row's class and the features'
importances. Its nodes as rows (tree, node, children, split, gain, class weights)
answer these as a grouped aggregation and a walk, and others that the model
can't: the same forest cut at any depth (`predicted_at`), so that a sweep over
depths takes one fit and one pass over the rows.

A cut forest is a truncation: nodes at the cut vote with their own class weights.
It isn't quite the forest that a fit with a smaller depth limit would give: MLlib's
draws other features for its nodes, and leaves of one prediction are merged in a
fit; `tuning.depth_sweep` has the forest of each limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bagwise.functions.tokens import token_rows
from bagwise.operators.features import vocabulary
from bagwise.session import materialize, scratch_path

MAX_DEPTH = 30              # MLlib's own limit
NODES_AT_ONCE = 1 << 20     # nodes that a task holds; larger forests take several passes
EPSILON = 1e-12             # of an impurity: nodes below it are pure
DIGITS = 12                 # gains that are equal in so many are equal
CELLS = 1 << 22             # feature values of a chunk of rows in a task


def node_table(model, name: str = "forest") -> DataFrame:
    """(tree, node, depth, left, right, feature, threshold, gain, impurity, stats, raw_count, prediction).

    `left` and `right` are null for a leaf; `stats` are the class weights of the
    rows that reached the node in the fit.
    """
    forest = model.stages[-1] if isinstance(model, PipelineModel) else model
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, name)
    forest.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    if saved.where("split.numCategories >= 0").limit(1).count():
        raise ValueError("a node table needs continuous features")
    inner = F.col("leftChild") >= 0
    nodes = saved.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"), F.when(inner, F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"),
        F.when(inner, F.col("gain")).alias("gain"), "impurity", F.col("impurityStats").alias("stats"), F.col("rawCount").alias("raw_count"), "prediction")
    return materialize(_with_depth(materialize(nodes, name)), name)


def _with_depth(nodes: DataFrame) -> DataFrame:
    """Each node's depth by doubling: after k joins every node knows its ancestor 2^k levels up."""
    children = nodes.where("left is not null").select("tree", F.col("node").alias("up"), F.explode(F.array("left", "right")).alias("node"))
    known = (nodes.join(children, ["tree", "node"], "left")
             .select("tree", "node", "up", F.when(F.col("up").isNull(), 0).otherwise(1).alias("depth")))
    for _ in range(MAX_DEPTH.bit_length()):
        above = known.select("tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        known = materialize(known.join(above, ["tree", "up"], "left").select(
            "tree", "node", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")), "depths")
    return nodes.join(known.select("tree", "node", "depth"), ["tree", "node"])


def _gini(weights) -> float:
    total = sum(weights)
    return 1.0 - sum((w / total) ** 2 for w in weights) if total > 0 else 0.0


def presence_tree(rows: DataFrame, n_classes: int, max_depth: int, bag_col: str = "tokens", label: str = "label", weight: str = "weight") -> DataFrame:
    """The `node_table` of one tree on token presence: of each node the best split by Gini impurity, over all its rows and tokens.

    MLlib's fit holds every row with a number for each token of its vocabulary,
    and looks for splits in a sample of the rows. Here a level is one grouped
    aggregation of the tokens that the rows have; what lacks a token follows
    from the node's sums. A row's place follows from the splits above it, so
    rows aren't written again. Of equal gains the token first in the vocabulary
    splits. As in MLlib a split has rows on both sides and a gain, and leaves
    of one parent with one prediction are merged. At most 2 ** max_depth nodes
    reach the driver.
    """
    spark = rows.sparkSession
    words = materialize(vocabulary(rows, bag_col).select("idx", "token"), "words")
    base = materialize(rows.select(F.col(label).cast("int").alias("label"), F.col(weight).cast("double").alias("weight"), F.array_distinct(bag_col).alias("bag")), "bags")
    per_class = [F.sum(F.when(F.col("label") == c, F.col("weight")).otherwise(0.0)).alias(f"in_{c}") for c in range(n_classes)]
    first = base.agg(F.count(F.lit(1)), *per_class).first()
    stats, count, splits = {1: list(first[1:])}, {1: first[0]}, {}     # children of node k: 2k has no token, 2k + 1 has it

    def place(node: int) -> Column:
        if node not in splits:
            return F.lit(node)
        return F.when(F.array_contains("bag", splits[node]["token"]), place(2 * node + 1)).otherwise(place(2 * node))
    for depth in range(max_depth):
        still = [k for k in stats if k.bit_length() == depth + 1 and _gini(stats[k]) > EPSILON]
        if not still:
            break
        nodes = spark.createDataFrame([(k, count[k], [float(w) for w in stats[k]]) for k in still], "node int, n long, of array<double>")
        inside = (token_rows(base.withColumn("node", place(1)).where(F.col("node").isin(still)), "bag", keep=["node", "label", "weight"])
                  .groupBy("node", "token").agg(*per_class, F.count(F.lit(1)).alias("held")))
        own, other = [F.col(f"in_{c}") for c in range(n_classes)], [F.col("of")[c] - F.col(f"in_{c}") for c in range(n_classes)]
        total_in, total_out, total = sum(own), sum(other), sum(F.col("of")[c] for c in range(n_classes))

        def impurity(weights, of):
            return 1.0 - sum((w / of) * (w / of) for w in weights)
        gain = impurity([F.col("of")[c] for c in range(n_classes)], total) - total_in / total * impurity(own, total_in) - total_out / total * impurity(other, total_out)
        scored = (inside.join(F.broadcast(nodes), "node").where((F.col("held") < F.col("n")) & (total_in > 0) & (total_out > 0))
                  .select("node", "token", "held", F.array(*own).alias("inside"), gain.alias("gain")).where(F.round("gain", DIGITS) > 0))
        best = (scored.join(words, "token").groupBy("node")
                .agg(F.max(F.struct(F.round("gain", DIGITS).alias("rounded"), (-F.col("idx")).alias("less"), "token", "gain", "held", "inside")).alias("best")))
        for row in best.select("node", "best.*").collect():
            k = row["node"]
            splits[k] = {"token": row["token"], "feature": -row["less"], "gain": row["gain"]}
            stats[2 * k], stats[2 * k + 1] = [a - b for a, b in zip(stats[k], row["inside"])], list(row["inside"])
            count[2 * k], count[2 * k + 1] = count[k] - row["held"], row["held"]

    def predicted(node: int) -> int:
        return max(range(n_classes), key=lambda c: round(stats[node][c] / (sum(stats[node]) or 1.0), DIGITS))  # of equal ones the first
    for k in sorted(splits, reverse=True):  # children have larger numbers
        if 2 * k not in splits and 2 * k + 1 not in splits and predicted(2 * k) == predicted(2 * k + 1):
            del splits[k]
    order, out = {}, []

    def number(k: int) -> None:
        order[k] = len(order)
        if k in splits:
            number(2 * k)
            number(2 * k + 1)
    number(1)
    for k, node in order.items():
        split = splits.get(k)
        out.append((0, node, k.bit_length() - 1, order[2 * k] if split else None, order[2 * k + 1] if split else None, split and split["feature"],
                    0.5 if split else None, split and split["gain"], _gini(stats[k]), [float(w) for w in stats[k]], count[k], float(predicted(k))))
    return spark.createDataFrame(out, "tree int, node int, depth int, left int, right int, feature int, threshold double, gain double, "
                                      "impurity double, stats array<double>, raw_count long, prediction double")


def node_importances(nodes: DataFrame) -> DataFrame:
    """(feature_idx, importance) of the features that split a node.

    A split weighs its gain times the class weights that reached it; a tree's
    weights are scaled to one, then the trees' sums are.
    """
    weight = F.col("gain") * F.aggregate("stats", F.lit(0.0), lambda s, x: s + x)
    own = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.sum(weight).alias("w"))
    trees = own.groupBy("tree").agg(F.sum("w").alias("of_tree")).where("of_tree > 0")
    share = own.join(trees, "tree").groupBy("feature").agg(F.sum(F.col("w") / F.col("of_tree")).alias("w"))
    total = share.agg(F.sum("w")).first()[0] or 1.0
    return share.select(F.col("feature").cast("int").alias("feature_idx"), (F.col("w") / F.lit(total)).alias("importance"))


def level_weights(nodes: DataFrame, depths) -> DataFrame:
    """(tree, max_depth, class, weight): the class weights of the leaves of each tree when it is cut at each depth.

    The leaves of a cut share out the rows of the fit, so the weights are the
    same at all depths.
    """
    cut = F.explode(F.array(*map(F.lit, depths))).alias("max_depth")
    leaves = (nodes.select("tree", "depth", "left", "stats", cut)
              .where((F.col("depth") == F.col("max_depth")) | (F.col("left").isNull() & (F.col("depth") < F.col("max_depth")))))
    return (leaves.select("tree", "max_depth", F.posexplode("stats").alias("class", "weight"))
            .groupBy("tree", "max_depth", "class").agg(F.sum("weight").alias("weight")))


class _Trees:
    """Nodes of some trees in one numbering, tree after tree."""

    def __init__(self, pdf):
        pdf = pdf.sort_values(["tree", "node"], ignore_index=True)
        first = pdf.groupby("tree").cumcount().eq(0).to_numpy().nonzero()[0]
        offset = np.repeat(first, np.diff([*first, len(pdf)]))
        leaf = pdf["left"].isna().to_numpy()
        own = np.arange(len(pdf))
        self.roots = first
        self.used = np.unique(pdf["feature"].dropna().to_numpy(np.int64))
        self.feature = np.searchsorted(self.used, pdf["feature"].fillna(-1).to_numpy(np.int64))
        self.threshold = pdf["threshold"].fillna(np.inf).to_numpy()
        self.left = np.where(leaf, own, pdf["left"].fillna(0).to_numpy(np.int64) + offset)
        self.right = np.where(leaf, own, pdf["right"].fillna(0).to_numpy(np.int64) + offset)
        stats = np.stack(pdf["stats"].to_numpy())
        total = stats.sum(1, keepdims=True)
        self.share = np.divide(stats, total, out=np.zeros_like(stats), where=total > 0)
        self.depth = int(pdf["depth"].max())

    def votes(self, x: np.ndarray, depths: list[int]) -> np.ndarray:
        """(row, depth, class): sums of the trees' class shares, of the values `x` of the used features."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        out = np.zeros((len(x), len(depths), self.share.shape[1]))
        for depth in range(max(depths) + 1):
            for k, d in enumerate(depths):
                if d == depth:
                    for tree in range(at.shape[1]):  # in the trees' order, as MLlib adds them
                        out[:, k] += self.share[at[:, tree]]
            if depth >= self.depth:
                for k, d in enumerate(depths):
                    if d > depth:
                        for tree in range(at.shape[1]):
                            out[:, k] += self.share[at[:, tree]]
                break
            if len(self.used):
                below = x[rows, np.minimum(self.feature[at], len(self.used) - 1)] <= self.threshold[at]
                at = np.where(below, self.left[at], self.right[at])
        return out


def _dense(indices: list, values: list, used: np.ndarray) -> np.ndarray:
    """The used features' values of each row; dense vectors have no indices."""
    x = np.zeros((len(values), len(used)))
    for row, (i, v) in enumerate(zip(indices, values)):
        i = np.arange(len(v)) if i is None else np.asarray(i, np.int64)
        place = np.searchsorted(used, i)
        hit = (place < len(used)) & (used[np.minimum(place, len(used) - 1)] == i) if len(used) else np.zeros(len(i), bool)
        x[row, place[hit]] = np.asarray(v, float)[hit]
    return x


def _vote_rows(trees: _Trees, depths: list[int], n_keep: int):
    def run(batches: Iterator[pa.RecordBatch]):
        step = max(1, CELLS // max(1, len(trees.used), len(trees.roots)))
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                x = _dense(part.column(n_keep).to_pylist(), part.column(n_keep + 1).to_pylist(), trees.used)
                votes = trees.votes(x, depths)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n_keep)), pa.array(votes.tolist(), pa.list_(pa.list_(pa.float64())))],
                                                 names=[*part.schema.names[:n_keep], "votes"])
    return run


def votes_at(nodes: DataFrame, rows: DataFrame, keep: list[str], depths: list[int], features: str = "features") -> DataFrame:
    """`rows` with the columns `keep` (a key among them) and `votes`: for each depth the class votes of the trees cut there.

    The nodes go to the tasks, as MLlib's model would, but never more than
    `NODES_AT_ONCE` of them: a larger forest is walked some trees at a time and
    the votes are added by row.
    """
    vector = F.unwrap_udt(features)
    flat = rows.select(*keep, vector["indices"].alias("_i"), vector["values"].alias("_v"))
    sizes = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).orderBy("tree").collect()  # a row for each tree
    passes, held = [[]], 0
    for tree, n in sizes:
        if held and held + n > NODES_AT_ONCE:
            passes.append([])
            held = 0
        passes[-1].append(tree)
        held += n
    kept = flat.select(*keep).schema
    schema = T.StructType([*kept.fields, T.StructField("votes", T.ArrayType(T.ArrayType(T.DoubleType())))])
    parts = [flat.mapInArrow(_vote_rows(_Trees(nodes.where(F.col("tree").isin(trees)).select(
        "tree", "node", "depth", "left", "right", "feature", "threshold", "stats").toPandas()), list(depths), len(keep)), schema) for trees in passes]
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    added = F.reduce(F.collect_list("votes"), F.lit(None).cast("array<array<double>>"), lambda s, v: F.when(s.isNull(), v).otherwise(
        F.zip_with(s, v, lambda a, b: F.zip_with(a, b, lambda x, y: x + y))))
    return every.groupBy(*keep).agg(added.alias("votes"))


def predicted_at(nodes: DataFrame, rows: DataFrame, keep: list[str], depths: list[int], features: str = "features") -> DataFrame:
    """(keep, max_depth, prediction): the class with the most votes at each depth; of equal classes the first, as in MLlib."""
    votes = votes_at(nodes, rows, keep, depths, features)
    best = F.transform("votes", lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("double"))
    names = F.array(*map(F.lit, depths))
    return votes.select(*keep, F.explode(F.arrays_zip(names.alias("max_depth"), best.alias("prediction"))).alias("at")).select(
        *keep, F.col("at.max_depth").alias("max_depth"), F.col("at.prediction").alias("prediction"))
