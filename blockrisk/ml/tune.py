"""Grid search and learning curves on stratified folds.

A search fits what it must and no more. The stages before the classifier (scaler, selection) are
fitted once a fold, and their output is stored for all candidates. Candidates that differ in the
number of trees alone share one fit of the largest: a forest is a list of trees, and boosting adds
trees one after the other, so the smaller ones are its beginnings. The trees between two sizes are
scored as a model of their own, and their sums give every size in one pass over the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from threading import Event

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockrisk.ml.split import stratified_folds
from blockrisk.ml.trees import share_cells
from blockrisk.operators.ranking import running_totals
from blockrisk.session import materialize, stored

#: Fits that run side by side; each keeps its rows in memory, or on disk beyond it.
PARALLELISM = 8
#: Fits of small tables need no more tasks than this many rows ask for.
ROWS_PER_TASK = 1 << 16
#: Rows that a single fit reads are dealt over the cores, unless a task would get fewer than this.
LEAST_PER_TASK = 1 << 12
#: Parameters that only lengthen the list of trees.
LENGTHS = ("numTrees", "maxIter")


def area_evaluator(score: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Area under the ROC curve; ``numBins=0`` makes it exact."""
    return BinaryClassificationEvaluator(rawPredictionCol=score, metricName="areaUnderROC", numBins=0)


def _pairs_in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each side of one range of scores: its least score, labels 1 and 0, and twice the pairs that are in order."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not parts:
        return
    sides, scores, labels = (np.concatenate(x) for x in zip(*parts))
    for side in np.unique(sides):
        values, place = np.unique(scores[sides == side], return_inverse=True)
        label = labels[sides == side]
        ones, zeros = (np.bincount(place[label == k], minlength=len(values)) for k in (True, False))
        below = np.cumsum(zeros) - zeros
        row = [int(side), float(values[0]), int(ones.sum()), int(zeros.sum()), int((ones * (2 * below + zeros)).sum())]
        yield pa.RecordBatch.from_pylist([dict(zip(("side", "least", "ones", "zeros", "pairs"), row))])


def side_areas(scored: DataFrame, rows: int) -> dict[int, float]:
    """Exact area under the ROC curve for every ``side`` of about so many rows (side long, score double, label boolean).

    Rows are dealt once by ranges of side and score. Each range counts the pairs within it; what comes back is a row
    for each range, and ranges of lower scores lie below as a whole. Equal scores share a range and count half.
    """
    ranges = max(1, math.ceil(rows / ROWS_PER_TASK))
    dealt_rows = scored.repartitionByRange(ranges, "side", "score").select("side", "score", "label")
    found = dealt_rows.mapInArrow(_pairs_in_range, "side long, least double, ones long, zeros long, pairs long").collect()
    areas = {}
    for side in {r["side"] for r in found}:
        ones = zeros = pairs = 0
        for r in sorted((r for r in found if r["side"] == side), key=lambda r: r["least"]):
            pairs += r["pairs"] + 2 * zeros * r["ones"]
            ones, zeros = ones + r["ones"], zeros + r["zeros"]
        # with a single label the curve runs along an axis, as the evaluator has it
        areas[side] = pairs / (2 * ones * zeros) if ones and zeros else float(ones > 0)
    return areas


@dataclass
class Family:
    """Candidates that one fit answers for: their places in the grid by number of trees."""

    params: dict
    length: object | None = None
    members: dict[int | None, list[int]] = field(default_factory=dict)


def families(pipeline: Pipeline, grid: Sequence[dict]) -> list[Family]:
    """The grid's candidates grouped by all parameters but the number of trees."""
    classifier = pipeline.getStages()[-1]
    found: dict[tuple, Family] = {}
    for place, candidate in enumerate(grid):
        lengths = [p for p in candidate if p.name in LENGTHS and p.parent == classifier.uid and _has_trees(classifier)]
        length = lengths[0] if lengths else None
        rest = {p: v for p, v in candidate.items() if p is not length}
        family = found.setdefault(tuple(sorted((p.parent, p.name, str(v)) for p, v in rest.items())), Family(rest, length))
        family.members.setdefault(candidate[length] if lengths else None, []).append(place)
    return list(found.values())


def _has_trees(classifier) -> bool:
    return hasattr(classifier, "getNumTrees") or hasattr(classifier, "getStepSize")


def _part_of(model, first: int, last: int):
    """Trees ``first`` to ``last`` as a JVM model, made by the JVM class's own constructor."""
    sc = SparkContext.getOrCreate()
    jvm, ml, uid = sc._jvm, sc._jvm.org.apache.spark.ml.classification, f"{model.uid}_{first}_{last}"

    def part_of(whole, kind):
        part = sc._gateway.new_array(kind, last - first)
        jvm.java.lang.System.arraycopy(whole, first, part, 0, last - first)
        return part

    if isinstance(model, GBTClassificationModel):
        trees = part_of(model._java_obj.trees(), jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
        return ml.GBTClassificationModel(uid, trees, part_of(model._java_obj.treeWeights(), jvm.double))
    trees = part_of(model._java_obj.trees(), ml.DecisionTreeClassificationModel)
    return ml.RandomForestClassificationModel(uid, trees, model.numFeatures, model.numClasses)


def prefix_scores(model, sizes: Iterable[int], rows: DataFrame) -> DataFrame:
    """``rows`` with a column ``score_<n>`` for each number of trees: what the model's first n trees say.

    Forests give the probability of label 1, boosted trees the margin.
    """
    sizes, scored, terms = sorted(sizes), rows, []
    for first, last in zip([0, *sizes], sizes):
        # The driver's threads share one interpreter: a wrapper, and its hundreds of calls to the JVM, is not made.
        part = _part_of(model, first, last)
        part.setFeaturesCol(model.getFeaturesCol())
        part.setRawPredictionCol(f"_raw{last}")
        part.setProbabilityCol("")
        part.setPredictionCol("")
        scored = DataFrame(part.transform(scored._jdf), rows.sparkSession)
        # a forest's trees share out one vote each; boosted trees give (-margin, margin)
        terms.append(vector_to_array(f"_raw{last}")[1])
        total: Column = sum(terms[1:], terms[0])
        share = total / last if isinstance(model, RandomForestClassificationModel) else total
        scored = scored.withColumn(f"score_{last}", share)
    return scored.drop(*(f"_raw{n}" for n in sizes))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """No more partitions than the rows fill."""
    return df.coalesce(max(1, math.ceil(rows / ROWS_PER_TASK)))


def dealt(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df``, of about so many rows, dealt by key over the tasks of a fit and ordered in each.

    Joins and aggregates leave small tables in one task, which then fits alone. The order makes a seed
    draw the same rows every time.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil(rows / ROWS_PER_TASK), min(cores, math.ceil(rows / LEAST_PER_TASK)), 1)
    return df.repartition(tasks, key).sortWithinPartitions(key)


def side_by_side(spark, work: Callable, items: Sequence, parallelism: int) -> list:
    """Results in order, from a pool of threads that hand their Spark properties on."""
    pool = ThreadPool(max(1, min(parallelism, len(items))))
    try:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)
    finally:
        pool.close()


def overlapped(spark, work: Callable, items: Sequence) -> list:
    """Results in order of ``work`` on all items at once; it is called in their order."""
    turns = [Event() for _ in range(len(items) + 1)]
    turns[0].set()

    def begin(place: int):
        turns[place].wait()
        turns[place + 1].set()
        return work(items[place])

    return side_by_side(spark, begin, range(len(items)), len(items))


def _areas(classifier, family: Family, train: DataFrame, held: DataFrame, rows: int) -> dict[int, float]:
    """Area on the held-out rows, about so many, for every candidate of a family, after one fit."""
    lengths = [n for n in family.members if n is not None]
    params = family.params | ({family.length: max(lengths)} if lengths else {})
    model = classifier.fit(train, params)
    if lengths:
        sides = F.inline(F.array(*(F.struct(F.lit(n).cast("long").alias("side"), F.col(f"score_{n}").alias("score")) for n in lengths)))
        scored = prefix_scores(model, lengths, held).select((F.col("label") > 0.5).alias("label"), sides).persist()
        areas = side_areas(scored, rows * len(lengths))
        scored.unpersist()
        # a fold without rows has the curve of chance
        found = {n: areas.get(n, 0.5) for n in lengths}
    else:
        found = {None: area_evaluator().evaluate(model.transform(held))}
    return {place: float(found[n]) for n, places in family.members.items() for place in places}


def encoded_fold(pipeline: Pipeline, folded: DataFrame, fold: int, keep: Sequence[str]) -> DataFrame:
    """All rows as the classifier sees them, by stages fitted on the other folds alone; stored."""
    *before, classifier = pipeline.getStages()
    if before:
        folded = Pipeline(stages=before).fit(folded.filter(F.col("fold") != fold)).transform(folded)
    return materialize(folded.select("label", "fold", *keep, classifier.getFeaturesCol()))


def search_areas(
    pipeline: Pipeline, grid: Sequence[dict], train: DataFrame, key: str, folds: int = 5, parallelism: int = PARALLELISM,
) -> list[list[float]]:
    """For each candidate its area on every fold."""
    classifier = pipeline.getStages()[-1]
    rows = train.count()
    folded = materialize(_sized(stratified_folds(train, key, folds=folds), rows))
    weights = {v for c in grid for p, v in c.items() if p.name == "weightCol"}
    if classifier.isDefined("weightCol") and classifier.getWeightCol():
        weights.add(classifier.getWeightCol())
    encoded = side_by_side(train.sparkSession, lambda f: encoded_fold(pipeline, folded, f, sorted(weights)), range(folds), parallelism)
    others = [share_cells(table.filter(F.col("fold") != fold)) for fold, table in enumerate(encoded)]

    def fit(job: tuple[int, Family]) -> dict[int, float]:
        fold, family = job
        return _areas(classifier, family, others[fold], encoded[fold].filter(F.col("fold") == fold), rows // folds)

    # the longest fits go first, so that none of them is left over at the end
    jobs = [(fold, family) for family in families(pipeline, grid) for fold in range(folds)]
    jobs.sort(key=lambda job: [-float(v) for p, v in job[1].params.items() if p.name == "maxDepth"])
    areas: list[list[float]] = [[0.0] * folds for _ in grid]
    for (fold, _), found in zip(jobs, side_by_side(train.sparkSession, fit, jobs, parallelism)):
        for place, area in found.items():
            areas[place][fold] = area
    return areas


def grid_search(
    pipeline: Pipeline, grid: list[dict], train: DataFrame, key: str,
    folds: int = 5, parallelism: int = PARALLELISM,
) -> tuple[PipelineModel, DataFrame]:
    """Model refitted with the best parameters, and the mean area per candidate."""
    areas = search_areas(pipeline, grid, train, key, folds, parallelism)
    means = [sum(a) / len(a) for a in areas]
    rows = [
        (", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), mean, math.sqrt(sum((x - mean) ** 2 for x in a) / len(a)))
        for params, mean, a in zip(grid, means, areas)
    ]
    table = train.sparkSession.createDataFrame(
        rows, "parameters string, mean_auc double, std_auc double"
    )
    best = max(range(len(grid)), key=lambda k: means[k])
    return pipeline.fit(train, grid[best]), table


def ranked_folds(train: DataFrame, key: str, folds: int) -> DataFrame:
    """``train`` with its fold and, for each fold, ``_row<fold>``: the row's place, in key order, among those of other folds."""
    folded = stratified_folds(train, key, folds=folds)
    ranked = running_totals(folded, [key], {f"_f{k}": (F.col("fold") == k).cast("long") for k in range(folds)})
    others = lambda k: sum((F.col(f"_f{j}_before") for j in range(folds) if j != k), F.lit(1))
    return ranked.select(*folded.columns, *(others(k).alias(f"_row{k}") for k in range(folds)))


def training_sizes(ranked: DataFrame, fractions: Sequence[float], folds: int) -> dict[tuple[int, float], tuple[int, bool]]:
    """(rows, whether both labels are among them) of every fold and fraction, in one pass."""
    sizes = ranked.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()
    own = {r["fold"]: r["n"] for r in sizes}
    rest = {k: sum(own.values()) - own.get(k, 0) for k in range(folds)}
    firsts = ranked.agg(*(
        F.min(F.when((F.col("fold") != k) & (F.col("label") == label), F.col(f"_row{k}"))).alias(f"_{k}_{label}")
        for k in range(folds) for label in (0, 1)
    )).first()
    found = {}
    for k in range(folds):
        for fraction in fractions:
            size = max(1, int(rest[k] * fraction))
            starts = [firsts[f"_{k}_{label}"] for label in (0, 1)]
            found[k, fraction] = size, all(s is not None and s <= size for s in starts)
    return found


def learning_curve(
    pipeline: Pipeline, train: DataFrame, key: str,
    fractions: Sequence[float] = (0.01, 0.12, 0.23, 0.34, 0.45, 0.56, 0.67, 0.78, 0.89, 1.0),
    folds: int = 5, parallelism: int = PARALLELISM,
) -> DataFrame:
    """Mean and deviation of the training and validation area at growing train sizes.

    The sizes are nested: each takes the first rows, in key order, of the fold's
    training part. Rows are ranked once for all folds and stored; a size is a range of
    their places, and the fits run side by side. Both areas of a fit come from one pass
    over its rows. Parts that have a single label give no
    model: ``fits`` says how many folds the figures of a size rest on, which are null
    where none does.
    """
    spark = train.sparkSession
    whole = train.count()
    ranked = stored(_sized(ranked_folds(train, key, folds), whole), "curve")
    sizes = training_sizes(ranked, fractions, folds)

    def point(job: tuple[int, float]) -> tuple:
        fold, fraction = job
        size, both = sizes[job]
        if not both:
            return float(fraction), size, None, None
        part = ranked.filter((F.col("fold") != fold) & (F.col(f"_row{fold}") <= size))
        model = pipeline.fit(part)
        held = F.col("fold") == fold
        scored = model.transform(ranked.filter(held | ((F.col("fold") != fold) & (F.col(f"_row{fold}") <= size))))
        areas = side_areas(scored.select(
            held.cast("long").alias("side"), vector_to_array("rawPrediction")[1].alias("score"), (F.col("label") > 0.5).alias("label"),
        ), size + whole // folds)
        # a fold without rows has the curve of chance
        return float(fraction), size, areas[0], areas.get(1, 0.5)

    points = side_by_side(spark, point, [(k, f) for f in sorted(fractions, reverse=True) for k in range(folds)], parallelism)
    # One row per fold and size.
    table = spark.createDataFrame(
        points, "fraction double, rows long, train double, validation double"
    )
    return table.groupBy("fraction").agg(
        F.round(F.avg("rows")).cast("long").alias("rows"), F.count("train").alias("fits"),
        *[
            f(side).alias(f"{side}_{name}")
            for side in ("train", "validation")
            for name, f in (("mean", F.avg), ("std", F.stddev_pop))
        ],
    )
