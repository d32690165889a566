"""Induction of forests on wide sparse features (L4), one level of all trees at a time.

MLlib's fit turns each row into an array with a number for every feature, 2^18 of
them for a row of a few hundred tokens, and passes over these arrays for every
group of nodes. Here a row stays as its non-zero entries. The rows lie in blocks;
a level of all trees is one pass over the blocks that counts class weights by
(node, feature, bin) for the features that each node draws, a grouped choice of
the best split of each node, and a row for each open node to the driver, as in
MLlib. What has a zero follows from the node's sums.

The rules are MLlib's: bootstrap by Poisson counts, as many features drawn for a
node as the square root of their number, bins between the values (by weight where
there are more than bins), Gini impurity, leaves of one parent with one prediction
merged. MLlib takes its bins from a sample of the rows; these come from all.
The draws are other random numbers than MLlib's and depend on the node alone, so
a forest of less depth is the deeper one's upper part: `fit_depths` grows once.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagwise.session import discard, materialize, scratch_path

WIDE = 1 << 12        # features beyond which a row's array is too long
ROWS = 2048           # rows of a block
CELLS = 1 << 19       # entries looked at together in a task
RENEW = 4             # levels after which the rows' places are written anew
EPSILON = 1e-12       # of an impurity: nodes below it are pure
DIGITS = 12           # gains that are equal in so many are equal

_PARTS = (("ptr", np.int32), ("feature", np.int32), ("bin", np.uint8), ("label", np.int32), ("weight", np.float64),
          ("row", np.int32), ("node", np.int32), ("times", np.uint8))
_BLOCKS = "block long, " + ", ".join(f"{name} binary" for name, _ in _PARTS)
_HITS = "node int, feature int, bin int, label int, weight double, n long"
_BEST = "node int, rounded double, feature int, bin int, gain double, weights array<double>, counts array<long>"
_NO_TREE = {"bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate"}


def fit(classifier, table: DataFrame):
    """`classifier` fitted on `table`: forests on wide sparse features here, all else by MLlib."""
    if isinstance(classifier, RandomForestClassifier):
        return fit_depths(classifier, table, [classifier.getMaxDepth()])[0]
    return classifier.fit(table)


def fit_depths(classifier: RandomForestClassifier, table: DataFrame, depths) -> list:
    """The forests of `classifier` with each of the depths as its limit."""
    grown = _grown(classifier, table, max(depths))
    if grown is None:
        return [classifier.fit(table, {classifier.maxDepth: d}) for d in depths]
    return [_model(classifier, grown, d) for d in depths]


def is_wide(classifier: RandomForestClassifier, table: DataFrame) -> bool:
    """Whether the features are many and sparse, and the settings those that are known here."""
    get = classifier.getOrDefault
    if (get("impurity") != "gini" or get("featureSubsetStrategy") not in ("auto", "sqrt", "all") or get("subsamplingRate") != 1.0
            or get("minInfoGain") or get("minWeightFractionPerNode") or get("maxBins") > 256):
        return False
    first = table.select(F.unwrap_udt(get("featuresCol"))["size"].alias("size")).first()
    return first is not None and first[0] is not None and first[0] > WIDE


@dataclass
class Grown:
    """The nodes of all trees, a level after the other; the roots come first, a tree's number each."""
    n_features: int
    tree: np.ndarray
    depth: np.ndarray
    feature: np.ndarray     # -1: not split
    bin: np.ndarray
    left: np.ndarray        # the right child is the next
    gain: np.ndarray
    weights: np.ndarray     # of each class
    counts: np.ndarray
    starts: np.ndarray      # of each feature's thresholds
    thresholds: np.ndarray


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Draws:
    """For each node a permutation of the features: the first `m` places are the features that it draws."""

    def __init__(self, n_features: int, m: int, seed: int):
        self.n, self.m, self.seed = n_features, m, seed
        bits = max(1, (n_features - 1).bit_length())
        self.mask, self.shift = np.uint32((1 << bits) - 1), np.uint32((bits + 1) // 2)

    def _keys(self, nodes: np.ndarray):
        start = _mixed(np.array([self.seed & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]
        for k in range(3):
            x = _mixed(nodes.astype(np.uint64) * np.uint64(3) + np.uint64(k) + start)
            yield (x & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1), (x >> np.uint64(32)).astype(np.uint32)

    def _walked(self, step, x: np.ndarray, keys) -> np.ndarray:
        x = step(x, keys)
        while len(out := np.flatnonzero(x >= self.n)):   # places beyond the features go on to the next of their cycle
            x[out] = step(x[out], [(a[out], b[out]) for a, b in keys])
        return x

    def _forward(self, x, keys):
        for a, b in keys:
            x = (x * a + b) & self.mask
            x = x ^ (x >> self.shift)
        return x

    def _back(self, x, keys):
        for a, b in reversed(keys):
            x = x ^ (x >> self.shift)
            x = ((x - b) * a) & self.mask
        return x

    def of(self, nodes: np.ndarray) -> np.ndarray:
        """(node, m): the features of each node."""
        keys = [(np.repeat(a, self.m), np.repeat(b, self.m)) for a, b in self._keys(nodes)]
        return self._walked(self._forward, np.tile(np.arange(self.m, dtype=np.uint32), len(nodes)), keys).reshape(len(nodes), self.m)

    def has(self, nodes: np.ndarray, repeats: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Whether each node, repeated so often, draws the features beside it."""
        keys = []
        for a, b in self._keys(nodes):
            back = a.copy()
            for _ in range(5):   # the inverse modulo 2^32
                back = back * (np.uint32(2) - a * back)
            keys.append((np.repeat(back, repeats), np.repeat(b, repeats)))
        return self._walked(self._back, features.astype(np.uint32), keys) < self.m


def _threshold_rows(total: float, most: int):
    """A feature's values and their weights to thresholds, as MLlib sets them."""
    def thresholds(pairs: list[dict]) -> list[float]:
        values = [(p["value"], p["weight"]) for p in pairs]
        zero = total - sum(w for _, w in values)
        if zero > 1e-9 * total:
            values.insert(0, (0.0, zero))
        if len(values) - 1 <= most:
            return [(a + b) / 2 for (a, _), (b, _) in zip(values, values[1:])]
        stride = total / (most + 1)
        found, held, wanted = [], values[0][1], stride
        for (before, _), (value, weight) in zip(values, values[1:]):
            if abs(held - wanted) < abs(held + weight - wanted):
                found.append((before + value) / 2)
                wanted += stride
            held += weight
        return found

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [thresholds(pairs) for pairs in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["feature", "thresholds"])
    return run


def _thresholds(rows: DataFrame, n_features: int, bins: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(starts, thresholds) of all features, from all rows; None if a value is negative."""
    entries = rows.select("weight", F.explode(F.arrays_zip("i", "v")).alias("e")).select("weight", F.col("e.i").alias("feature"), F.col("e.v").alias("value"))
    values = materialize(entries.where("value != 0").groupBy("feature", "value").agg(F.sum("weight").alias("weight")), "values")
    if values.where("value < 0").limit(1).count():
        discard(values)
        return None
    total = rows.agg(F.sum("weight")).first()[0]
    pairs = values.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("value", "weight"))).alias("pairs"))
    found = pairs.mapInArrow(_threshold_rows(total, bins - 1), "feature int, thresholds array<double>").toArrow().combine_chunks()
    discard(values)
    feature = found.column("feature").to_numpy()
    lists = found.column("thresholds").to_pylist()
    of = dict(zip(feature.tolist(), lists))
    starts = np.zeros(n_features + 1, np.int64)
    starts[feature + 1] = [len(x) for x in lists]
    return np.cumsum(starts), np.array([t for f in sorted(of) for t in of[f]], float)


def _binned(feature: np.ndarray, value: np.ndarray, starts: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """How many of its feature's thresholds are below each value."""
    out, left, at = np.zeros(len(feature), np.uint8), np.arange(len(feature)), starts[feature]
    while len(left):
        more = at[left] < starts[feature[left] + 1]
        left = left[more]
        left = left[thresholds[at[left]] < value[left]]
        out[left] += 1
        at[left] += 1
    return out


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _block_rows(starts: np.ndarray, thresholds: np.ndarray, trees: int, bootstrap: bool, seed: int):
    """Blocks of `ROWS` rows: entries above their feature's first bin, and for each tree the rows that it draws, at its root."""
    def made(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        size = np.concatenate([np.diff(c.offsets.to_numpy()) for c in table.column("i").chunks])
        feature, value = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("i", "v"))
        bins = _binned(feature, value, starts, thresholds)
        row = np.repeat(np.arange(len(size)), size)[bins > 0]
        found = {"ptr": np.searchsorted(row, np.arange(len(size) + 1)), "feature": feature[bins > 0], "bin": bins[bins > 0],
                 "label": table.column("label").to_numpy(), "weight": table.column("weight").to_numpy()}
        times = (np.random.default_rng([seed & 0x7FFFFFFF, number]).poisson(1.0, (trees, len(size))) if bootstrap
                 else np.ones((trees, len(size)), np.int64)).astype(np.uint8)
        found["node"], found["row"] = np.nonzero(times)
        found["times"] = times[found["node"], found["row"]]
        return _written(number, found)

    def run(batches: Iterator[pa.RecordBatch]):
        number, held = TaskContext.get().partitionId() << 20, []
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, ROWS - sum(x.num_rows for x in held))
                held.append(part)
                batch = batch.slice(part.num_rows)
                if sum(x.num_rows for x in held) == ROWS:
                    yield made(number, held)
                    number, held = number + 1, []
        if held:
            yield made(number, held)
    return run


def _written(number: int, parts: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([np.ascontiguousarray(parts[name], kind).tobytes()], pa.binary()) for name, kind in _PARTS)],
                                      names=["block", *(name for name, _ in _PARTS)])


def _read(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.column(0)[k].as_py(), {name: np.frombuffer(batch.column(i)[k].as_buffer(), kind) for i, (name, kind) in enumerate(_PARTS, 1)}


class Level:
    """The nodes from `low` on, which the blocks' rows pass or stand in; `open`: those to be split."""

    def __init__(self, low: int, nodes: Grown, open_nodes: np.ndarray, draws: Draws):
        self.low, self.draws, self.trees = low, draws, int(nodes.tree.max()) + 1
        self.n_features, self.n_classes = nodes.n_features, nodes.weights.shape[1]
        self.tree, self.feature, self.bin, self.left = (x[low:] for x in (nodes.tree, nodes.feature, nodes.bin, nodes.left))
        self.open = np.zeros(len(self.tree), bool)
        self.open[open_nodes - low] = True

    def moved(self, block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, node, times) of the rows that stand in an open node, by node."""
        row, node, times = block["row"], block["node"] - self.low, block["times"]
        entry = np.repeat(np.arange(len(block["label"])), np.diff(block["ptr"])) * self.n_features + block["feature"]
        while True:
            keep = self.open[node] | (self.feature[node] >= 0)
            row, node, times = row[keep], node[keep], times[keep]
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                break
            at = node[inner]
            wanted = row[inner].astype(np.int64) * self.n_features + self.feature[at]
            place = np.minimum(np.searchsorted(entry, wanted), max(len(entry) - 1, 0))
            value = np.where(entry[place] == wanted, block["bin"][place], 0) if len(entry) else np.zeros(len(wanted), int)
            node = node.copy()
            node[inner] = self.left[at] - self.low + (value > self.bin[at])
        order = np.argsort(node, kind="stable")
        return row[order], node[order], times[order]

    def hits(self, block: dict):
        """(node, feature, bin, row, times) of the entries whose feature is drawn by the open node of their row, in parts."""
        row, node, times = self.moved(block)
        if not len(row):
            return
        ptr, n_rows, m = block["ptr"], len(block["label"]), self.draws.m
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        size = np.diff(np.append(first, len(node)))
        every = len(block["feature"])
        # a node of few rows looks at their entries, one of many at its features' rows
        few = size * (every / n_rows) <= m * (1 + every / self.n_features) if m < self.n_features else np.ones(len(first), bool)
        at = np.flatnonzero(np.repeat(few, size))
        length = (ptr[1:] - ptr[:-1])[row[at]].astype(np.int64)
        cuts = np.searchsorted(np.cumsum(length), np.arange(CELLS, length.sum() + CELLS, CELLS)) + 1
        for some in np.split(np.arange(len(at)), np.unique(cuts[cuts < len(at)])):
            pair, long = at[some], length[some]
            if not long.sum():
                continue
            entry = _ranges(ptr[row[pair]].astype(np.int64), long)
            feature = block["feature"][entry]
            which = np.repeat(np.arange(len(pair)), long)
            if m < self.n_features:
                own = np.flatnonzero(self.draws.has(node[pair] + self.low, long, feature))
                entry, feature, which = entry[own], feature[own], which[own]
            yield node[pair][which] + self.low, feature, block["bin"][entry], row[pair][which], times[pair][which]
        many = node[first[~few]]
        if not len(many):
            return
        order = np.argsort(block["feature"], kind="stable")
        start = np.concatenate([[0], np.cumsum(np.bincount(block["feature"], minlength=self.n_features))])
        row_of = np.repeat(np.arange(n_rows), np.diff(ptr))[order]
        bin_of = block["bin"][order]
        place = np.full((self.trees, n_rows), -1, np.int32)
        place[self.tree[node], row] = np.arange(len(node))
        for some in np.split(many, np.arange(max(1, CELLS // m), len(many), max(1, CELLS // m))):
            feature = self.draws.of(some + self.low).ravel()
            long = start[feature + 1] - start[feature]
            held = np.flatnonzero(long)
            entry = _ranges(start[feature[held]], long[held])
            which = np.repeat(held, long[held])
            own = some[which // m]
            pair = place[self.tree[own], row_of[entry]]
            ok = np.flatnonzero((pair >= 0) & (node[pair] == own))
            yield own[ok] + self.low, feature[which[ok]].astype(np.int64), bin_of[entry[ok]], row_of[entry[ok]], times[pair[ok]]

    def hit_rows(self, batches: Iterator[pa.RecordBatch]):
        """Class weights and row counts by (node, feature, bin, class), block by block."""
        for _, block in _read(batches):
            for node, feature, bins, row, times in self.hits(block):
                key = ((node.astype(np.int64) * self.n_features + feature) * 256 + bins) * self.n_classes + block["label"][row]
                order = np.argsort(key)
                key, row, times = key[order], row[order], times[order].astype(np.int64)
                at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
                if not len(at):
                    continue
                key, label = np.divmod(key[at], self.n_classes)
                key, bins = np.divmod(key, 256)
                node, feature = np.divmod(key, self.n_features)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int32()), pa.array(feature, pa.int32()), pa.array(bins, pa.int32()), pa.array(label, pa.int32()),
                     pa.array(np.add.reduceat(block["weight"][row] * times, at)), pa.array(np.add.reduceat(times, at))],
                    names=["node", "feature", "bin", "label", "weight", "n"])

    def renewed_rows(self, batches: Iterator[pa.RecordBatch]):
        """The blocks with their rows where they stand now."""
        for number, block in _read(batches):
            row, node, times = self.moved(block)
            yield _written(number, block | {"row": row, "node": node + self.low, "times": times})


def _root_rows(n_classes: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for _, block in _read(batches):
            key = block["node"].astype(np.int64) * n_classes + block["label"][block["row"]]
            size = int(key.max()) + 1 if len(key) else 0
            n, weight = np.bincount(key, block["times"], size), np.bincount(key, block["weight"][block["row"]] * block["times"], size)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at // n_classes, pa.int32()), pa.array(at % n_classes, pa.int32()), pa.array(weight[at]),
                                              pa.array(n[at].astype(np.int64))], names=["node", "label", "weight", "n"])
    return run


def _gini(weights: np.ndarray) -> np.ndarray:
    total = weights.sum(1, keepdims=True)
    return 1.0 - (np.divide(weights, total, out=np.zeros_like(weights), where=total > 0) ** 2).sum(1)


def _less(weights: np.ndarray, counts: np.ndarray, other: np.ndarray, other_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = counts - other_counts
    return np.where(left > 0, weights - other, 0.0), left


def _best_rows(low: int, weights: np.ndarray, counts: np.ndarray, least: int):
    """The best split of each node that the rows (by node, feature and bin) allow; of equal gains the first feature's."""
    n_classes = weights.shape[1]

    def best(node, feature, bins, label, weight, n) -> pa.RecordBatch:
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (feature[1:] != feature[:-1])])
        cell = np.cumsum(new | np.concatenate([[True], bins[1:] != bins[:-1]])) - 1
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        right = np.bincount(cell * n_classes + label, weight, len(first) * n_classes).reshape(-1, n_classes)
        held = np.bincount(cell * n_classes + label, n, len(first) * n_classes).reshape(-1, n_classes).astype(np.int64)
        new, node, feature, bins = new[first], node[first], feature[first], bins[first]
        ends = np.append(np.flatnonzero(new)[1:], len(new))
        from_end = np.repeat(ends, np.diff(np.append(np.flatnonzero(new), len(new)))) - 1 - np.arange(len(new))
        for k in range(1, int(from_end.max()) + 1):   # bins: a value's side has all bins from it on
            at = np.flatnonzero(from_end == k)
            right[at] += right[at + 1]
            held[at] += held[at + 1]
        cut = np.where(new, 0, np.concatenate([[0], bins[:-1]]))
        of, of_n = weights[node - low], counts[node - low]
        left, left_n = _less(of, of_n, right, held)
        total = of.sum(1)
        gain = _gini(of) - right.sum(1) / total * _gini(right) - left.sum(1) / total * _gini(left)
        rounded = np.round(gain, DIGITS)
        ok = np.flatnonzero((rounded > 0) & (held.sum(1) >= least) & (left_n.sum(1) >= least))
        order = ok[np.lexsort((cut[ok], feature[ok], -rounded[ok], node[ok]))]
        order = order[np.concatenate([[True], node[order][1:] != node[order][:-1]])] if len(order) else order
        return pa.RecordBatch.from_arrays(
            [pa.array(node[order], pa.int32()), pa.array(rounded[order]), pa.array(feature[order], pa.int32()), pa.array(cut[order], pa.int32()), pa.array(gain[order]),
             pa.array(list(right[order]), pa.list_(pa.float64())), pa.array(list(held[order]), pa.list_(pa.int64()))],
            names=["node", "rounded", "feature", "bin", "gain", "weights", "counts"])

    def run(batches: Iterator[pa.RecordBatch]):
        rest = None
        for batch in batches:
            own = [c.to_numpy() for c in batch.columns]
            rest = own if rest is None else [np.concatenate(x) for x in zip(rest, own)]
            if not len(rest[0]):
                continue
            last = np.flatnonzero((rest[0] == rest[0][-1]) & (rest[1] == rest[1][-1]))[0]   # the last feature may go on in the next batch
            if last >= CELLS:
                yield best(*(x[:last] for x in rest))
                rest = [x[last:] for x in rest]
        if rest is not None and len(rest[0]):
            yield best(*rest)
    return run


def _grown(classifier: RandomForestClassifier, table: DataFrame, max_depth: int) -> Grown | None:
    """The nodes of all trees down to `max_depth`, none merged; None where MLlib is to fit."""
    if not is_wide(classifier, table):
        return None
    get = classifier.getOrDefault
    label, vector = get("labelCol"), F.unwrap_udt(get("featuresCol"))
    weight = F.col(get("weightCol")).cast("double") if classifier.isDefined("weightCol") and get("weightCol") else F.lit(1.0)
    rows = materialize(table.select(F.col(label).cast("int").alias("label"), weight.alias("weight"), vector["size"].alias("size"),
                                    F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1)).alias("i"), vector["values"].alias("v")), "rows")
    n_features, most = rows.agg(F.max("size"), F.max("label")).first()
    n_classes = max(most + 1, len(table.schema[label].metadata.get("ml_attr", {}).get("vals", [])))
    found = _thresholds(rows, n_features, get("maxBins"))
    if found is None:
        discard(rows)
        return None
    starts, thresholds = found
    trees, seed = get("numTrees"), get("seed")
    every = get("featureSubsetStrategy") == "all" or get("featureSubsetStrategy") == "auto" and trees == 1
    draws = Draws(n_features, n_features if every else math.ceil(math.sqrt(n_features)), seed)
    blocks = materialize(rows.select("label", "weight", "i", "v").mapInArrow(
        _block_rows(starts, thresholds, trees, get("bootstrap") and trees > 1, seed), _BLOCKS), "blocks", ROWS)
    discard(rows)
    weights, counts = np.zeros((trees, n_classes)), np.zeros((trees, n_classes), np.int64)
    sums = materialize(blocks.mapInArrow(_root_rows(n_classes), "node int, label int, weight double, n long"), "roots", 1)
    for node, c, w, n in sums.groupBy("node", "label").agg(F.sum("weight"), F.sum("n")).collect():
        weights[node, c], counts[node, c] = w, n
    discard(sums)
    none = np.full(trees, -1, np.int32)
    nodes = Grown(n_features, np.arange(trees, dtype=np.int32), np.zeros(trees, np.int8), none, none.copy(), none.copy(), np.full(trees, -1.0), weights, counts, starts, thresholds)
    low, least = 0, get("minInstancesPerNode")
    here = np.arange(trees)
    for depth in range(max_depth):
        still = here[(_gini(nodes.weights[here]) > EPSILON) & (nodes.counts[here].sum(1) >= 2 * least)]
        if not len(still):
            break
        level = Level(low, nodes, still, draws)
        if depth and depth % RENEW == 0:
            before, blocks = blocks, materialize(blocks.mapInArrow(level.renewed_rows, _BLOCKS), "blocks", 1)
            discard(before)
            low = int(here[0])
            level = Level(low, nodes, still, draws)
        hits = materialize(blocks.mapInArrow(level.hit_rows, _HITS), "hits", 1)
        choice = (hits.repartition("node", "feature").sortWithinPartitions("node", "feature", "bin")
                  .mapInArrow(_best_rows(int(here[0]), nodes.weights[here], nodes.counts[here], least), _BEST))
        rank = F.struct("rounded", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gain", "weights", "counts")
        best = choice.groupBy("node").agg(F.max(rank).alias("best")).select("node", "best.*").toArrow().combine_chunks()
        discard(hits)
        if not best.num_rows:
            break
        here = _split(nodes, best, depth + 1)
    discard(blocks)
    return nodes


def _split(nodes: Grown, best: pa.Table, depth: int) -> np.ndarray:
    """Adds the children of the nodes that have a split; their numbers."""
    best = best.sort_by("node")
    at, first, n = best.column("node").to_numpy(), len(nodes.tree), best.num_rows
    nodes.feature[at], nodes.bin[at], nodes.gain[at] = -best.column("f").to_numpy(), -best.column("b").to_numpy(), best.column("gain").to_numpy()
    nodes.left[at] = first + 2 * np.arange(n)
    right, right_n = (np.stack(best.column(c).to_pandas().to_numpy()) for c in ("weights", "counts"))
    left, left_n = _less(nodes.weights[at], nodes.counts[at], right, right_n)
    none = np.full(2 * n, -1, np.int32)
    nodes.tree = np.concatenate([nodes.tree, np.repeat(nodes.tree[at], 2)])
    nodes.depth = np.concatenate([nodes.depth, np.full(2 * n, depth, np.int8)])
    nodes.feature, nodes.bin, nodes.left = (np.concatenate([x, none]) for x in (nodes.feature, nodes.bin, nodes.left))
    nodes.gain = np.concatenate([nodes.gain, np.full(2 * n, -1.0)])
    nodes.weights = np.concatenate([nodes.weights, np.stack([left, right], 1).reshape(2 * n, -1)])
    nodes.counts = np.concatenate([nodes.counts, np.stack([left_n, right_n], 1).reshape(2 * n, -1)])
    return np.arange(first, first + 2 * n)


def _cut(nodes: Grown, max_depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kept, inner, number): the forest with this depth limit, equal leaves of one parent merged, its trees numbered in preorder."""
    inner = (nodes.feature >= 0) & (nodes.depth < max_depth)
    predicted, size = nodes.weights.argmax(1), np.ones(len(nodes.tree), np.int64)
    for depth in range(min(max_depth, int(nodes.depth.max())) - 1, -1, -1):
        at = np.flatnonzero(inner & (nodes.depth == depth))
        left = nodes.left[at]
        same = ~inner[left] & ~inner[left + 1] & (predicted[left] == predicted[left + 1])
        inner[at[same]] = False
        at, left = at[~same], left[~same]
        size[at] = 1 + size[left] + size[left + 1]
    kept, number = nodes.depth == 0, np.zeros(len(nodes.tree), np.int64)
    for depth in range(int(nodes.depth.max())):
        at = np.flatnonzero(kept & inner & (nodes.depth == depth))
        left = nodes.left[at]
        kept[left] = kept[left + 1] = True
        number[left], number[left + 1] = number[at] + 1, number[at] + 1 + size[left]
    return kept, inner, number


def _model(classifier: RandomForestClassifier, nodes: Grown, max_depth: int) -> RandomForestClassificationModel:
    """The grown forest, cut at `max_depth`, as MLlib's model: written in its own format and loaded."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    kept, inner, number = _cut(nodes, max_depth)
    at = np.flatnonzero(kept)
    split = inner[at]
    left = np.where(split, nodes.left[at], 0)
    threshold = np.zeros(len(at))
    threshold[split] = nodes.thresholds[nodes.starts[nodes.feature[at[split]]] + nodes.bin[at[split]]]
    flat = spark.createDataFrame(pa.table({
        "tree": nodes.tree[at], "id": number[at].astype(np.int32), "prediction": nodes.weights[at].argmax(1).astype(float), "impurity": _gini(nodes.weights[at]),
        "stats": pa.array(list(nodes.weights[at]), pa.list_(pa.float64())), "raw": nodes.counts[at].sum(1), "gain": np.where(split, nodes.gain[at], -1.0),
        "left": np.where(split, number[left], -1).astype(np.int32), "right": np.where(split, number[left + split], -1).astype(np.int32),
        "feature": np.where(split, nodes.feature[at], -1).astype(np.int32), "threshold": threshold}))
    threshold = F.when(F.col("left") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>"))
    data = flat.select(F.col("tree").alias("treeID"), F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("raw").alias("rawCount"), "gain", F.col("left").alias("leftChild"),
        F.col("right").alias("rightChild"), F.struct(F.col("feature").alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"),
                                                     F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    path = scratch_path(spark, "forest")
    data.write.parquet(f"{path}/data")
    own = {p.name: v for p, v in classifier._paramMap.items()} | {"maxDepth": int(max_depth)}
    default = {p.name: v for p, v in classifier._defaultParamMap.items()}
    trees = int(nodes.tree.max()) + 1

    def meta(kind: str, uid: str, skip=()) -> dict:
        return {"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                "paramMap": {k: v for k, v in own.items() if k not in skip}, "defaultParamMap": {k: v for k, v in default.items() if k not in skip}}
    of_all = meta("RandomForestClassificationModel", classifier.uid) | {"numFeatures": nodes.n_features, "numClasses": nodes.weights.shape[1], "numTrees": trees}
    of_tree = [(t, json.dumps(meta("DecisionTreeClassificationModel", f"{classifier.uid}_{t}", _NO_TREE)), 1.0) for t in range(trees)]
    spark.createDataFrame(of_tree, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(json.dumps(of_all),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)
