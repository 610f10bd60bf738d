"""Spark ML's forests and boosted trees of two classes, grown on cells of binned rows.

A tree sees of a row only the bins of its features, its label and its weight. Rows that share these are one
cell with a count, and a bootstrap of a cell's rows is one Poisson draw of its count. Spark's own learner makes
a full table of bins for every node and every task, however few rows the node holds, and merges them at every
level; here the cells go to the tasks once, each grows its share of the trees by itself, and reads its cells
from a file in pieces. Boosting, whose trees need one another, grows in one task.

Bins, candidates for splits, stop rules, pruning and predictions are Spark's, and the result is Spark's model.
Boosted trees equal Spark's up to the order in which sums are taken; forests draw other rows and features.
"""

from __future__ import annotations

import json
import math
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.session import scratch_path, stored

#: Boosting reads all cells for every level of every round in one task; beyond this many, Spark's own learner deals them out.
BOOSTED_CELLS = 1 << 22
#: Cells that are looked at together, and bins of all nodes that are counted together.
CELLS_AT_ONCE, BINS_AT_ONCE = 1 << 19, 1 << 21
#: Arrays of more bytes than this lie in files.
IN_MEMORY = 32 << 20
#: Spark takes nodes of less impurity than this for pure.
EPSILON = 2.0 ** -52

_CELLS = "codes binary, label boolean, weight double"
_NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
    "gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def _array(rows: int, kind: type) -> np.ndarray:
    if rows * np.dtype(kind).itemsize <= IN_MEMORY:
        return np.zeros(rows, kind)
    with tempfile.TemporaryFile() as file:
        return np.memmap(file, kind, "w+", shape=(rows,))


@dataclass
class Cells:
    """Bins of every feature, label, weight and number of rows of each cell."""

    codes: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    count: np.ndarray

    @classmethod
    def read(cls, batches: Iterator[pa.RecordBatch], features: int) -> Cells:
        """The batches (codes, label, weight, count), by way of files where there are many."""
        kinds = {"codes": np.uint8, "label": np.bool_, "weight": np.float64, "count": np.int64}
        files = {name: tempfile.SpooledTemporaryFile(IN_MEMORY) for name in kinds}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            codes = batch.column("codes")
            start = codes.offset * features
            files["codes"].write(memoryview(codes.buffers()[2])[start:start + batch.num_rows * features] if batch.num_rows else b"")
            for name in ("label", "weight", "count"):
                files[name].write(batch.column(name).to_numpy(zero_copy_only=False).astype(kinds[name]).tobytes())
        held = {}
        for name, file in files.items():
            with file:
                shape = (rows, features) if name == "codes" else (rows,)
                if file._rolled:
                    file.flush()
                    held[name] = np.memmap(file._file, kinds[name], "r", shape=shape)
                else:
                    file.seek(0)
                    held[name] = np.frombuffer(file.read(), kinds[name]).reshape(shape)
        return cls(**held)

    def __len__(self) -> int:
        return len(self.count)


@dataclass
class Rules:
    """What Spark's metadata say of a tree."""

    bins: int
    depth: int
    per_node: int
    least_rows: int
    least_weight: float
    least_gain: float
    variance: bool

    def impurity(self, s: Sequence[np.ndarray]) -> np.ndarray:
        if self.variance:
            return np.where(s[0] == 0, 0.0, (s[2] - s[1] * s[1] / s[0]) / s[0])
        total = s[0] + s[1]
        return np.where(total == 0, 0.0, 1.0 - (s[0] / total) ** 2 - (s[1] / total) ** 2)

    def weight(self, s: Sequence[np.ndarray]) -> np.ndarray:
        return s[0] if self.variance else s[0] + s[1]

    def prediction(self, s: Sequence[np.ndarray]) -> np.ndarray:
        return np.where(s[0] == 0, 0.0, s[1] / s[0]) if self.variance else (s[1] > s[0]).astype(float)


@dataclass
class Tree:
    """Nodes in the order of their levels: children follow their parent, right ones follow left ones."""

    stats: np.ndarray
    raw: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    prediction: np.ndarray

    def pruned(self) -> Tree:
        """Leaves of one parent that predict the same become one; nodes below it go."""
        left, gain, prediction = self.left.copy(), self.gain.copy(), self.prediction.copy()
        while True:
            inner = np.flatnonzero(left >= 0)
            a, b = left[inner], left[inner] + 1
            same = (left[a] < 0) & (left[b] < 0) & (prediction[a] == prediction[b])
            if not same.any():
                break
            left[inner[same]], gain[inner[same]], prediction[inner[same]] = -1, -1.0, prediction[a[same]]
        kept, level = np.zeros(len(left), bool), np.array([0])
        while len(level):
            kept[level] = True
            level = left[level[left[level] >= 0]]
            level = np.concatenate([level, level + 1])
        number = np.cumsum(kept) - 1
        left = np.where(left >= 0, number[left], -1)[kept]
        return Tree(self.stats[:, kept], self.raw[kept], np.where(left >= 0, self.feature[kept], -1), self.cut[kept], left, gain[kept], prediction[kept])

    def rows(self, tree: int, thresholds: Sequence[np.ndarray], rules: Rules) -> pa.RecordBatch:
        """The nodes as Spark saves them."""
        inner = self.left >= 0
        ends = np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)
        cuts = np.zeros(inner.sum())
        for feature, values in enumerate(thresholds):
            own = self.feature[inner] == feature
            cuts[own] = values[self.cut[inner][own]]
        stats = np.ascontiguousarray(self.stats.T)
        with np.errstate(all="ignore"):
            impurity = rules.impurity(list(self.stats))
        split = pa.StructArray.from_arrays(
            [pa.array(self.feature, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(cuts)), pa.array(np.full(len(inner), -1), pa.int32())],
            ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
        )
        places = np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32)
        fields = {
            "id": pa.array(np.arange(len(inner)), pa.int32()), "prediction": pa.array(self.prediction), "impurity": pa.array(impurity),
            "impurityStats": pa.ListArray.from_arrays(pa.array(places), pa.array(stats.ravel())), "rawCount": pa.array(self.raw.astype(np.int64)),
            "gain": pa.array(self.gain), "leftChild": pa.array(self.left, pa.int32()),
            "rightChild": pa.array(np.where(inner, self.left + 1, -1), pa.int32()), "split": split,
        }
        nodes = pa.StructArray.from_arrays(list(fields.values()), list(fields))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(inner), tree), pa.int32()), nodes], ["treeID", "nodeData"])


def grow(
    cells: Cells, at: np.ndarray, drawn: Callable[[slice, np.ndarray], tuple[np.ndarray, list[np.ndarray]]], rules: Rules,
    rng: np.random.Generator | None = None,
) -> Tree:
    """A tree, level by level; ``at`` holds every cell's node, -1 for cells left out, and in the end its leaf.

    ``drawn`` gives the rows drawn from some cells of a piece, and the sums that impurity is made of.
    """
    features = cells.codes.shape[1]
    pieces = [slice(lo, min(lo + CELLS_AT_ONCE, len(cells))) for lo in range(0, len(cells), CELLS_AT_ONCE)]
    sums = 3 if rules.variance else 2
    raw, stats = 0.0, np.zeros(sums)
    for piece in pieces:
        rows = np.flatnonzero(at[piece] >= 0)
        counts, parts = drawn(piece, rows)
        raw, stats = raw + counts.sum(), stats + [p.sum() for p in parts]
    # One entry per node; the spare one at the end is where cells with node -1 look.
    node = {"raw": np.array([raw]), "feature": np.array([-1]), "cut": np.array([0]), "left": np.array([-1]), "gain": np.array([-1.0])}
    totals, open_nodes = stats.reshape(sums, 1), np.array([0])
    with np.errstate(all="ignore"):
        for depth in range(rules.depth):
            if not len(open_nodes):
                break
            wanted = None
            if rules.per_node < features:
                wanted = np.sort(np.argsort(rng.random((len(open_nodes), features)), axis=1)[:, :rules.per_node], axis=1)
            fresh, found, size = len(node["raw"]), [], max(1, BINS_AT_ONCE // (rules.per_node * rules.bins))
            for first in range(0, len(open_nodes), size):
                group = open_nodes[first:first + size]
                local = np.full(fresh + 1, -1)
                local[group] = np.arange(len(group))
                asked = None if wanted is None else wanted[first:first + size]
                found.append(_best(_counted(cells, at, drawn, pieces, local, asked, len(group), rules, sums), asked, rules))
            best = [np.concatenate(x, axis=-1) for x in zip(*found)]
            feature, cut, gain, left_raw, left_stats, right_raw, right_stats = best
            split = gain > 0
            parents, count = open_nodes[split], int(split.sum())
            if not count:
                break
            node["feature"][parents], node["cut"][parents], node["gain"][parents] = feature[split], cut[split], gain[split]
            node["left"][parents] = fresh + 2 * np.arange(count)
            children = np.empty((sums, 2 * count))
            children[:, ::2], children[:, 1::2] = left_stats[:, split], right_stats[:, split]
            child_raw = np.empty(2 * count)
            child_raw[::2], child_raw[1::2] = left_raw[split], right_raw[split]
            totals = np.concatenate([totals, children], axis=1)
            for name, value in (("raw", child_raw), ("feature", -1), ("cut", 0), ("left", -1), ("gain", -1.0)):
                node[name] = np.concatenate([node[name], np.broadcast_to(np.asarray(value, node[name].dtype), 2 * count)])
            _moved(cells, at, pieces, node)
            mixed = np.abs(rules.impurity(list(children))) >= EPSILON
            open_nodes = fresh + np.flatnonzero(mixed) if depth + 1 < rules.depth else np.array([], int)
        prediction = rules.prediction(list(totals))
    return Tree(totals, node["raw"], node["feature"], node["cut"], node["left"], node["gain"], prediction)


def _counted(cells, at, drawn, pieces, local, asked, nodes: int, rules: Rules, sums: int) -> np.ndarray:
    """Rows and sums by node, feature asked for and bin."""
    slots = rules.per_node
    table = np.zeros((sums + 1, nodes * slots * rules.bins))
    for piece in pieces:
        places = local[at[piece]]
        rows = np.flatnonzero(places >= 0)
        if not len(rows):
            continue
        places, codes = places[rows], cells.codes[piece]
        counts, parts = drawn(piece, rows)
        for slot in range(slots):
            feature = slot if asked is None else asked[places, slot]
            bins = (places * slots + slot) * rules.bins + codes[rows, feature]
            for k, values in enumerate((counts, *parts)):
                table[k] += np.bincount(bins, values, table.shape[1])
    return table.reshape(sums + 1, nodes, slots, rules.bins)


def _best(table: np.ndarray, asked: np.ndarray | None, rules: Rules) -> tuple[np.ndarray, ...]:
    """The first of the best splits of every node, its gain (none: minus infinity), and rows and sums on both sides."""
    below = np.cumsum(table, axis=-1)
    whole = below[..., -1:]
    below = below[..., :-1]
    above = whole - below
    total, low, high = (rules.weight(x[1:]) for x in (whole, below, above))
    gain = rules.impurity(whole[1:]) - low / total * rules.impurity(below[1:]) - high / total * rules.impurity(above[1:])
    fits = (below[0] >= rules.least_rows) & (above[0] >= rules.least_rows) & (low >= rules.least_weight) & (high >= rules.least_weight)
    gain = np.where(fits & (gain >= rules.least_gain), gain, -np.inf)
    nodes, slots, cuts = gain.shape
    flat, row = gain.reshape(nodes, -1), np.arange(nodes)
    place = flat.argmax(axis=1)
    slot, cut = place // cuts, place % cuts
    feature = slot if asked is None else asked[row, slot]
    sides = [x[:, row, slot, cut] for x in (below, above)]
    return feature, cut, flat[row, place], sides[0][0], sides[0][1:], sides[1][0], sides[1][1:]


def _moved(cells, at, pieces, node) -> None:
    """Cells of nodes that were split go to the children."""
    feature, cut, left = (np.append(node[name], -1) for name in ("feature", "cut", "left"))
    for piece in pieces:
        now = at[piece]
        rows = np.flatnonzero(left[now] >= 0)
        old, codes = now[rows], cells.codes[piece]
        now[rows] = left[old] + (codes[rows, feature[old]] > cut[old])


def forest_rows(cells: Cells, trees: Sequence[int], seed: int, rate: float, thresholds, rules: Rules) -> Iterator[pa.RecordBatch]:
    at, draws = _array(len(cells), np.int32), _array(len(cells), np.int32)
    for tree in trees:
        rng = np.random.default_rng([seed & (1 << 64) - 1, tree])
        for lo in range(0, len(cells), CELLS_AT_ONCE):
            piece = slice(lo, lo + CELLS_AT_ONCE)
            draws[piece] = rng.poisson(cells.count[piece] * rate)
            at[piece] = np.where(draws[piece] > 0, 0, -1)

        def drawn(piece, rows):
            counts = draws[piece][rows].astype(float)
            weighed, ones = counts * cells.weight[piece][rows], cells.label[piece][rows]
            return counts, [np.where(ones, 0.0, weighed), np.where(ones, weighed, 0.0)]

        yield grow(cells, at, drawn, rules, rng).pruned().rows(tree, thresholds, rules)


def boosted_rows(cells: Cells, rounds: int, step: float, thresholds, rules: Rules) -> Iterator[pa.RecordBatch]:
    """The rounds of boosting by logistic loss; every tree after the first counts ``step`` times."""
    at, margin = _array(len(cells), np.int32), _array(len(cells), np.float64)
    for tree in range(rounds):

        def drawn(piece, rows):
            counts = cells.count[piece][rows].astype(float)
            sign = np.where(cells.label[piece][rows], 1.0, -1.0)
            aim = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin[piece][rows])) if tree else sign
            weighed = counts * cells.weight[piece][rows]
            return counts, [weighed, weighed * aim, weighed * aim * aim]

        at[:] = 0
        grown = grow(cells, at, drawn, rules)
        for lo in range(0, len(cells), CELLS_AT_ONCE):
            piece = slice(lo, lo + CELLS_AT_ONCE)
            margin[piece] += (step if tree else 1.0) * grown.prediction[at[piece]]
        yield grown.pruned().rows(tree, thresholds, rules)


# --- from a DataFrame to Spark's model ---


def _row_columns(estimator, dataset: DataFrame) -> DataFrame:
    """Vector, label and weight as Spark's learner takes them, in its order."""
    named = estimator.isDefined("weightCol") and estimator.getWeightCol()
    weight = F.col(f"`{estimator.getWeightCol()}`").cast("double") if named else F.lit(1.0)
    return dataset.select(
        F.col(f"`{estimator.getFeaturesCol()}`").alias("features"), F.col(f"`{estimator.getLabelCol()}`").cast("double").alias("label"), weight.alias("weight")
    )


def _cuts(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Spark's thresholds of one feature of a sample: midpoints of all values, or of those nearest to equal shares."""
    seen, place = np.unique(values[values != 0], return_inverse=True)
    counts = np.bincount(place, weights[values != 0], len(seen)).tolist()
    seen = seen.tolist()
    if not seen:
        return np.array([])
    zeros = expected - sum(counts)
    if zeros > 2.0 ** -52 * np.count_nonzero(values) * 100:
        k = int(np.searchsorted(seen, 0.0))
        seen.insert(k, 0.0)
        counts.insert(k, zeros)
    if len(seen) - 1 <= most:
        return np.array([(a + b) / 2 for a, b in zip(seen, seen[1:])])
    stride = expected / (most + 1)
    found, current, target = [], counts[0], stride
    for k in range(1, len(seen)):
        before, current = current, current + counts[k]
        if abs(before - target) < abs(current - target):
            found.append((seen[k - 1] + seen[k]) / 2)
            target += stride
    return np.array(found)


def thresholds_of(rows: DataFrame, count: int, weight: float, bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of every feature, from the very rows that Spark's learner looks at for them."""
    spark, fraction = rows.sparkSession, min(1.0, max(bins * bins, 10_000) / count)
    if fraction < 1:
        jvm = spark.sparkContext._jvm
        draw = jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        drawn = rows._jdf.rdd().sample(False, fraction, draw)
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    seen = rows.select(vector_to_array("features").alias("x"), "weight").toArrow()
    values = seen["x"].combine_chunks().flatten().to_numpy()
    values, weights = values.reshape(seen.num_rows, -1), seen["weight"].to_numpy()
    return [_cuts(column, weights, fraction * weight, min(bins, count) - 1) for column in values.T]


def cells_of(rows: DataFrame, thresholds: Sequence[np.ndarray]) -> DataFrame:
    """One row (codes, label, weight, count) for all rows that a tree cannot tell apart."""
    features = len(thresholds)

    def binned(batches):
        for batch in batches:
            values = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, features)
            if not np.isfinite(values).all():
                raise ValueError("features must be neither NaN nor infinite")
            codes = np.empty(values.shape, np.uint8)
            for k, cuts in enumerate(thresholds):
                codes[:, k] = np.searchsorted(cuts, values[:, k])
            ends = pa.array(np.arange(0, codes.size + 1, features, dtype=np.int32))
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends.buffers()[1], pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([packed, batch.column("label"), batch.column("weight")], ["codes", "label", "weight"])

    read = rows.select(vector_to_array("features").alias("x"), (F.col("label") > 0.5).alias("label"), "weight")
    return read.mapInArrow(binned, _CELLS).groupBy("codes", "label", "weight").agg(F.count(F.lit(1)).alias("count"))


def _per_node(asked: str, features: int, trees: int, forest: bool) -> int | None:
    if asked == "auto":
        asked = "sqrt" if forest and trees > 1 else "all" if forest else "onethird" if trees > 1 else "all"
    shares = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}
    return shares.get(asked)


def _loaded(estimator, spark, nodes: DataFrame, features: int, weights: Sequence[float], forest: bool):
    """Spark's own model, read from its own format; the tasks that grow the trees write their nodes."""
    path = scratch_path(spark, "trees")
    nodes.write.parquet(f"{path}/data")
    kind, tree, mark = ("RandomForest", "classification.DecisionTreeClassificationModel", "dtc") if forest else ("GBT", "regression.DecisionTreeRegressionModel", "dtr")
    base = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    impurity = estimator.getImpurity()
    maps = {"paramMap": {p.name: v for p, v in estimator._paramMap.items()}, "defaultParamMap": {p.name: v for p, v in estimator._defaultParamMap.items()}}
    whole = base | {"class": f"org.apache.spark.ml.classification.{kind}ClassificationModel", "uid": estimator.uid} | maps | {"numFeatures": features, "numTrees": len(weights)}
    if forest:
        whole["numClasses"] = 2
    own = base | {"class": f"org.apache.spark.ml.{tree}", "paramMap": {"impurity": impurity}, "defaultParamMap": {}}
    before, after = json.dumps(own | {"uid": f"{mark}_{uuid.uuid4().hex[-12:]}_#"}).split("#")
    place = F.col("id").cast("int")
    trees = spark.range(0, len(weights), 1, 1).select(
        place.alias("_1"), F.concat(F.lit(before), place.cast("string"), F.lit(after)).alias("_2"), F.when(place == 0, weights[0]).otherwise(weights[-1]).alias("_3")
    )
    trees.write.parquet(f"{path}/treesMetadata")
    spark.range(0, 1, 1, 1).select(F.lit(json.dumps(whole)).alias("value")).write.text(f"{path}/metadata")
    return getattr(spark.sparkContext._jvm.org.apache.spark.ml.classification, f"{kind}ClassificationModel").load(path)


@dataclass
class Binned:
    """Rows as trees see them: their number and weight, the thresholds, and the cells."""

    rows: int
    weight: float
    thresholds: list[np.ndarray]
    cells: DataFrame


def share_cells(dataset: DataFrame) -> DataFrame:
    """``dataset``, whose cells are made once and stored for all fits on this very object."""
    dataset._binned, dataset._binning = {}, Lock()
    return dataset


def _binned(estimator, dataset: DataFrame) -> Binned | None:
    """None where Spark's own learner has to say what is wrong with the rows."""
    rows, bins, seed = _row_columns(estimator, dataset), estimator.getMaxBins(), estimator.getSeed()
    odd = "features IS NULL OR label IS NULL OR label NOT IN (0D, 1D) OR weight IS NULL OR NOT weight >= 0 OR isnan(weight)"
    facts = rows.selectExpr("count(1) AS n", "sum(weight) AS weight", f"count_if({odd}) AS odd", "max(label) AS most").first()
    if facts["odd"] or not facts["n"] or facts["most"] != 1:
        return None
    thresholds = thresholds_of(rows, facts["n"], facts["weight"], bins, seed)
    return Binned(facts["n"], facts["weight"], thresholds, cells_of(rows, thresholds))


def _shared(estimator, dataset: DataFrame) -> Binned | None:
    if not hasattr(dataset, "_binned"):
        return _binned(estimator, dataset)
    weight = estimator.getWeightCol() if estimator.isDefined("weightCol") else ""
    key = (estimator.getFeaturesCol(), estimator.getLabelCol(), weight, estimator.getMaxBins(), estimator.getSeed())
    with dataset._binning:
        if key not in dataset._binned:
            found = _binned(estimator, dataset)
            dataset._binned[key] = found and replace(found, cells=stored(found.cells, "cells"))
        return dataset._binned[key]


def _fitted(estimator, dataset: DataFrame, forest: bool):
    """The fitted JVM model, or None where Spark's own learner is asked for what is not built here."""
    about = dataset.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    if "nominal" in about or "binary" in about or dataset.schema[estimator.getLabelCol()].metadata.get("ml_attr") or estimator.getMaxBins() > 256:
        return None
    if forest:
        unlike = estimator.getImpurity() != "gini" or not estimator.getBootstrap()
    else:
        unlike = estimator.getSubsamplingRate() != 1 or estimator.isDefined("validationIndicatorCol")
    binned = None if unlike else _shared(estimator, dataset)
    if binned is None:
        return None
    thresholds, spark = binned.thresholds, dataset.sparkSession
    features = len(thresholds)
    length = estimator.getNumTrees() if forest else estimator.getMaxIter()
    per_node = _per_node(estimator.getFeatureSubsetStrategy(), features, length, forest)
    if per_node is None or (not forest and per_node < features):
        return None
    rules = Rules(
        max([len(t) for t in thresholds], default=0) + 1, estimator.getMaxDepth(), per_node, estimator.getMinInstancesPerNode(),
        estimator.getMinWeightFractionPerNode() * binned.weight, estimator.getMinInfoGain(), not forest,
    )
    if forest:
        tasks = max(1, min(length, spark.sparkContext.defaultParallelism))
        copies = binned.cells.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartitionById(tasks, F.col("task"))
        seed, rate = estimator.getSeed(), estimator.getSubsamplingRate()

        def grown(batches):
            first = next(batches, None)
            if first is not None and first.num_rows:
                task = first.column("task")[0].as_py()
                held = Cells.read((b for part in ([first], batches) for b in part), features)
                yield from forest_rows(held, range(task, length, tasks), seed, rate, thresholds, rules)

        weights = [1.0] * length
    else:
        cells = binned.cells if hasattr(dataset, "_binned") else stored(binned.cells, "cells")
        if cells.count() > BOOSTED_CELLS:
            return None
        copies, step = cells.coalesce(1), estimator.getStepSize()

        def grown(batches):
            yield from boosted_rows(Cells.read(batches, features), length, step, thresholds, rules)

        weights = [1.0] + [step] * (length - 1)
    nodes = copies.sortWithinPartitions("codes", "label", "weight").mapInArrow(grown, _NODES)
    return _loaded(estimator, spark, nodes, features, weights, forest)


class ForestModel(RandomForestClassificationModel):
    """PySpark looks for parameters in all attributes but properties: as one, trees are wrapped only when asked for."""

    trees = property(lambda self: [DecisionTreeClassificationModel(t) for t in self._call_java("trees")])


class BoostedModel(GBTClassificationModel):
    """The same for boosted trees."""

    trees = property(lambda self: [DecisionTreeRegressionModel(t) for t in self._call_java("trees")])


class Forest(RandomForestClassifier):
    """Spark ML's forest, grown on cells."""

    def _fit_java(self, dataset):
        return _fitted(self, dataset, True) or super()._fit_java(dataset)

    def _create_model(self, java_model):
        return ForestModel(java_model)


class Boosting(GBTClassifier):
    """Spark ML's boosted trees, grown on cells."""

    def _fit_java(self, dataset):
        return _fitted(self, dataset, False) or super()._fit_java(dataset)

    def _create_model(self, java_model):
        return BoostedModel(java_model)
