"""Model fitting on a customer-by-year panel; results depend on the solver, so no SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.ml import pipelines as ML
from blockrisk.ml import split as M
from blockrisk.ml import tune
from blockrisk.operators import panel as P
from blockrisk.plans import evaluation, features, risk
from blockrisk.session import materialize, scratch_path
from blockrisk.workload import geography as GEO
from blockrisk.workload import panels
from blockrisk.workload import tables as T
from blockrisk.workload.registry import query

HOLDOUT_YEAR = 2000
FEATURES = ["yr", "n", "urgent", "closed", "price", "c_acctbal", "c_nationkey"]
SEED = 7

# The largest models among those that the source project searches for its final scores.
FOREST = {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 10}
BOOSTED = {"maxIter": 30, "maxDepth": 10, "minInstancesPerNode": 5}


def model_rows(spark, d) -> DataFrame:
    """Key, features, split, label and balanced weight per customer and year."""
    people = T.read(spark, d, "customer").select(
        F.col("c_custkey").alias("block"), "c_acctbal", "c_nationkey"
    )
    counts = panels.orders(spark, d).groupBy("block", "yr").agg(
        F.count(F.lit(1)).alias("n"), F.sum("urgent").alias("urgent"),
        F.sum("closed").alias("closed"), F.sum("o_totalprice").alias("price"),
    )
    spine = P.year_spine(people, T.FIRST_YEAR, T.LAST_YEAR, "yr")
    panel = P.join_counts_and_targets(
        spine, counts, {"closed": "target"}, T.LAST_YEAR, ["block", "yr"]
    )
    split = M.year_split(panel, "target", HOLDOUT_YEAR, "yr")
    keyed = split.withColumn("key", C.block_year_key("block", "yr")).na.fill(0.0, ["price"])
    # Fitting reads the rows many times; the panel behind them is planned once.
    size = people.count() * (T.LAST_YEAR - T.FIRST_YEAR)
    return materialize(tune.dealt(keyed.select("key", "split", "label", *FEATURES), "key", size))


def _train(rows: DataFrame) -> DataFrame:
    return M.with_class_weights(rows.filter(F.col("split") == "train"))


def _holdout_scores(pipeline_of):
    def build(spark, d):
        rows = model_rows(spark, d)
        train = _train(rows)
        model = pipeline_of(train).fit(train)
        return ML.scored(model, rows.filter(F.col("split") == "holdout"), ["key", "label"])

    return build


_SCORED = "key s, label i, prediction i, score f"

query("logreg_scores", _SCORED)(_holdout_scores(
    lambda train: ML.logistic_pipeline(FEATURES, weight="weight", rows=train.count())
))
query("rf_scores", _SCORED)(_holdout_scores(
    lambda train: ML.forest_pipeline(FEATURES, weight="weight", seed=SEED, **FOREST)
))
query("gbt_scores", _SCORED)(_holdout_scores(
    lambda train: ML.boosted_pipeline(FEATURES, weight="weight", seed=SEED, **BOOSTED)
))


@query("holdout_auc", "model s, auc f")
def _(spark, d):
    """Area on the held-out year of the three kinds of model."""
    rows = model_rows(spark, d)
    train, held = _train(rows), rows.filter(F.col("split") == "holdout")
    pipelines = {
        "logistic": ML.logistic_pipeline(FEATURES, weight="weight", rows=train.count()),
        "forest": ML.forest_pipeline(FEATURES, weight="weight", seed=SEED, **FOREST),
        "boosted": ML.boosted_pipeline(FEATURES, weight="weight", seed=SEED, on_cells=True, **BOOSTED),
    }

    def area(name: str) -> DataFrame:
        scores = ML.scored(pipelines[name].fit(train), held, ["label"])
        return evaluation.roc_auc(scores).select(F.lit(name).alias("model"), "auc")

    return reduce(DataFrame.unionByName, tune.side_by_side(spark, area, list(pipelines), len(pipelines)))


@query("grid_search_results", "parameters s, mean_auc f, std_auc f")
def _(spark, d):
    """The forest, final forest and boosted grids behind selection, each over five folds; their parameters tell them apart."""
    train = _train(model_rows(spark, d))
    forest = ML.forest_pipeline(FEATURES, weight="weight", seed=SEED)
    boosted = ML.boosted_pipeline(FEATURES, weight="weight", seed=SEED, on_cells=True)
    # A fit is mostly short jobs that wait for the driver in turn; many side by side fill the cores.
    cores = max(tune.PARALLELISM, spark.sparkContext.defaultParallelism)
    searches = [
        (forest, ML.grid_of(forest, ML.FOREST_GRID), cores),
        (forest, ML.grid_of(forest, ML.FINAL_FOREST_GRID), cores),
        (boosted, ML.grid_of(boosted, ML.BOOSTED_GRID), cores),
    ]
    tables = tune.overlapped(spark, lambda s: tune.grid_search(s[0], s[1], train, "key", parallelism=s[2])[1], searches)
    return reduce(DataFrame.unionByName, tables)


@query("selected_features", "feature s")
def _(spark, d):
    train = _train(model_rows(spark, d))
    pipeline = ML.forest_pipeline(FEATURES, weight="weight", seed=SEED, **FOREST)
    kept = ML.kept_features(pipeline.fit(train), FEATURES)
    return spark.createDataFrame([(f,) for f in kept], "feature string")


@query("feature_importances", "feature s, importance f")
def _(spark, d):
    train = _train(model_rows(spark, d))
    pipeline = ML.forest_pipeline(FEATURES, select=False, weight="weight", seed=SEED, **FOREST)
    return ML.top_importances(pipeline.fit(train), FEATURES, 49)


@query("learning_curve", "fraction f, rows i, fits i, train_mean f, train_std f, validation_mean f, validation_std f")
def _(spark, d):
    train = model_rows(spark, d).filter(F.col("split") == "train")
    pipeline = ML.logistic_pipeline(FEATURES, select=False, rows=train.count())
    return tune.learning_curve(pipeline, train, "key")


# --- a label that one feature decides: facts that any right model must give ---

DECIDED = ["nation", "balance", "name_length"]
_DECIDED_SQL = "SELECT c_custkey AS key, c_nationkey AS nation, CASE WHEN c_nationkey >= 12 THEN 1 ELSE 0 END AS label FROM customer"


def decided_rows(spark, d) -> DataFrame:
    return T.read(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_nationkey").cast("double").alias("nation"),
        F.col("c_acctbal").cast("double").alias("balance"), F.length("c_name").cast("double").alias("name_length"),
        (F.col("c_nationkey") >= 12).cast("int").alias("label"),
    )


def _decided_pipelines(rows: DataFrame, select: bool):
    return {
        "boosted": ML.boosted_pipeline(DECIDED, select=select, seed=SEED, maxIter=3, maxDepth=2),
        "forest": ML.forest_pipeline(DECIDED, select=select, seed=SEED, numTrees=20, maxDepth=4, featureSubsetStrategy="all"),
        "logistic": ML.logistic_pipeline(DECIDED, select=select, rows=rows.count()),
    }


@query("decided_areas", "model s, auc f", """
    SELECT unnest(['boosted', 'forest', 'logistic']) AS model, 1.0 AS auc""")
def _(spark, d):
    """Area of each kind of model behind the selection of features."""
    rows, result = decided_rows(spark, d), None
    for name, pipeline in _decided_pipelines(rows, select=True).items():
        area = evaluation.roc_auc(ML.scored(pipeline.fit(rows), rows, ["label"])).select(F.lit(name).alias("model"), "auc")
        result = area if result is None else result.unionByName(area)
    return result


@query("model_compare_fitted", "model s, auc f, corner f, points_ok i", """
    SELECT unnest(['boosted', 'forest', 'logistic']) AS model, 1.0 AS auc, 1.0 AS corner, 1 AS points_ok""")
def _(spark, d):
    """Curves of three fitted models side by side: all reach every positive before any negative, and end at (1, 1)."""
    rows = decided_rows(spark, d)
    scores = {name: ML.scored(p.fit(rows), rows, ["label"]) for name, p in _decided_pipelines(rows, select=False).items()}
    curves = evaluation.compare_models(scores)
    ends = (F.max("fpr") == 1) & (F.max("tpr") == 1) & (F.min("fpr") == 0) & (F.min("tpr") == 0)
    return curves.groupBy("model").agg(F.max("auc").alias("auc"), F.max(F.when(F.col("fpr") == 0, F.col("tpr"))).alias("corner"), ends.cast("int").alias("points_ok"))


_CHOSEN = 50


@query("fitted_rates", "kind s, model f, previous f, random f", f"""
    WITH q AS (SELECT CAST(key AS VARCHAR) AS key, label, CASE WHEN nation >= 18 OR nation < 4 THEN 1 ELSE 0 END AS previous FROM ({_DECIDED_SQL}) d),
      top AS (SELECT label FROM q ORDER BY previous DESC, key LIMIT {_CHOSEN})
    SELECT 'hit' AS kind, 1.0 AS model, (SELECT sum(label) FROM top) / {_CHOSEN}.0 AS previous, avg(label) AS random FROM q
    UNION ALL SELECT 'capture', {_CHOSEN}.0 / sum(label), (SELECT sum(label) FROM top) * 1.0 / sum(label), {_CHOSEN}.0 / count(*) FROM q""")
def _(spark, d):
    """Hit and capture rate of the blocks that a fitted forest ranks first, beside a previous count and chance."""
    rows = decided_rows(spark, d).withColumn("previous", ((F.col("nation") >= 18) | (F.col("nation") < 4)).cast("int"))
    outcomes = ML.scored(_decided_pipelines(rows, select=True)["forest"].fit(rows), rows, ["key", "label", "previous"])
    parts = {"hit": risk.hit_rate_at_n, "capture": risk.capture_rate_at_n}
    tables = [rate(outcomes, _CHOSEN, "label", "previous", key="key").select(F.lit(kind).alias("kind"), "model", "previous", "random") for kind, rate in parts.items()]
    return reduce(DataFrame.unionByName, tables)


@query("decided_features", "model s, feature s", """
    SELECT unnest(['boosted', 'forest', 'logistic']) AS model, 'nation' AS feature""")
def _(spark, d):
    """Features that the selection keeps."""
    rows = decided_rows(spark, d)
    kept = [(n, f) for n, p in _decided_pipelines(rows, select=True).items() for f in ML.kept_features(p.fit(rows), DECIDED)]
    return spark.createDataFrame(kept, "model string, feature string").select("model", "feature")


@query("decided_importance", "model s, feature s", """
    SELECT unnest(['boosted', 'forest', 'logistic']) AS model, 'nation' AS feature""")
def _(spark, d):
    """The most important feature without selection."""
    rows, result = decided_rows(spark, d), None
    for name, pipeline in _decided_pipelines(rows, select=False).items():
        top = ML.top_importances(pipeline.fit(rows), DECIDED, 1).select(F.lit(name).alias("model"), "feature")
        result = top if result is None else result.unionByName(top)
    return result


@query("decided_scores", "label i, prediction i, n i, off i", f"""
    SELECT label, label AS prediction, count(*) AS n, 0 AS off FROM ({_DECIDED_SQL}) q GROUP BY 1""")
def _(spark, d):
    """Class per label; ``off`` counts rows whose score is not ten times the probability or disagrees with the class."""
    rows = decided_rows(spark, d)
    scores = ML.scored(_decided_pipelines(rows, select=False)["forest"].fit(rows), rows, ["label"])
    wrong = (F.abs(F.col("score") - 10 * F.col("probability")) > 1e-9) | ((F.col("score") > 5).cast("int") != F.col("prediction"))
    return scores.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"), F.sum(wrong.cast("int")).alias("off"))


@query("grid_search_weights", "candidates i, balanced i, found i", "SELECT 12 AS candidates, 6 AS balanced, 12 AS found")
def _(spark, d):
    """The whole logistic grid, class weight among its candidates; each tells these labels apart."""
    rows = M.with_class_weights(decided_rows(spark, d))
    pipeline = ML.logistic_pipeline(DECIDED, select=False, rows=rows.count())
    grid = ML.grid_of(pipeline, ML.LOGISTIC_SEARCH_GRID, rows=rows.count())
    table = tune.grid_search(pipeline, grid, rows, "key")[1]
    return table.agg(
        F.count(F.lit(1)).alias("candidates"), F.sum(F.col("parameters").contains("weightCol=weight").cast("int")).alias("balanced"),
        F.sum((F.col("mean_auc") > 0.99).cast("int")).alias("found"),
    )


@query("learning_curve_sizes", "fraction f, rows i, fits i", f"""
    WITH q AS ({_DECIDED_SQL}), k AS (SELECT CAST(key AS VARCHAR) AS key, label FROM q),
      placed AS (SELECT key, label, row_number() OVER (PARTITION BY label ORDER BY key) - 1 AS r, count(*) OVER (PARTITION BY label) AS n FROM k),
      folded AS (
        SELECT key, label, CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1) ELSE n % 5 + (r - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM placed),
      ranked AS (
        SELECT f.fold AS held, t.label, row_number() OVER (PARTITION BY f.fold ORDER BY t.key) AS row
        FROM (SELECT DISTINCT fold FROM folded) f JOIN folded t ON t.fold <> f.fold),
      sizes AS (SELECT held, x.fraction, greatest(1, CAST(floor(count(*) * x.fraction) AS BIGINT)) AS size FROM ranked, (SELECT unnest([0.01, 0.12, 0.23, 0.34, 0.45, 0.56, 0.67, 0.78, 0.89, 1.0])::DOUBLE AS fraction) x GROUP BY 1, 2),
      parts AS (SELECT s.held, s.fraction, s.size, count(DISTINCT r.label) AS labels FROM sizes s JOIN ranked r ON r.held = s.held AND r.row <= s.size GROUP BY 1, 2, 3)
    SELECT fraction, CAST(round(avg(size)) AS BIGINT) AS rows, sum(CASE WHEN labels = 2 THEN 1 ELSE 0 END) AS fits FROM parts GROUP BY 1""")
def _(spark, d):
    """Rows and fits behind every point of the learning curve of labels that one feature decides."""
    rows = decided_rows(spark, d)
    pipeline = ML.logistic_pipeline(DECIDED, select=False, rows=rows.count())
    return tune.learning_curve(pipeline, rows, "key").select("fraction", "rows", "fits")


@query("reloaded_model", "n i, off i", "SELECT count(*) AS n, 0 AS off FROM customer")
def _(spark, d):
    """Rows that a saved and reloaded model scores otherwise than before."""
    rows = decided_rows(spark, d)
    model, path = _decided_pipelines(rows, select=True)["forest"].fit(rows), scratch_path(spark, "model")
    ML.save(model, path)
    before, after = (ML.scored(m, rows, ["key"]).select("key", F.col("score").alias(f"score{k}")) for k, m in enumerate((model, ML.load(path))))
    return before.join(after, "key").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("score0") != F.col("score1")).cast("int")).alias("off"))


@query("grid_search_best", "parameters s, best i", "SELECT 'maxDepth=0' AS parameters, 0 AS best UNION ALL SELECT 'maxDepth=3', 1")
def _(spark, d):
    """Five folds over a grid of which one entry can tell the labels apart."""
    rows = decided_rows(spark, d)
    pipeline = ML.forest_pipeline(DECIDED, select=False, seed=SEED, numTrees=5, featureSubsetStrategy="all")
    table = tune.grid_search(pipeline, ML.grid_of(pipeline, {"maxDepth": [0, 3]}), rows, "key")[1]
    return table.select("parameters", (F.col("mean_auc") > 0.999).cast("int").alias("best"))


# Nations from which a block burns, by fire type and year of the model's training.
_BURNS = {("structure", 2017): 5, ("structure", 2018): 8, ("vehicle", 2017): 11, ("vehicle", 2018): 14, ("external", 2017): 17, ("external", 2018): 20}
_TYPE_SQL = "CASE s.event_id % 3 WHEN 0 THEN 'structure' WHEN 1 THEN 'vehicle' ELSE 'external' END"
_YEAR_SQL = "2017 + CAST(floor(s.event_id / 3) AS BIGINT) % 3"
_LEAST_SQL = " ".join(f"WHEN fire_type = '{t}' AND least(year, 2018) = {y} THEN {least}" for (t, y), least in _BURNS.items())


@query("risk_requests", "event_id i, fire_type s, year i, GISJOIN s, high i", f"""
    WITH edges AS ({T.edges_sql()}), sites_p AS (SELECT event_id, lon AS px, lat AS py FROM ({T.table_sql('sites')}) z),
      hits AS ({T.contains_sql('sites_p', 'sites_p.event_id')}),
      asked AS (SELECT s.event_id, {_TYPE_SQL} AS fire_type, {_YEAR_SQL} AS year FROM sites_p s WHERE s.px > -122.53 AND s.px < -122.35 AND s.py > 37.7 AND s.py < 37.84),
      nations AS (SELECT b."GISJOIN", c.c_nationkey AS nation FROM ({T.table_sql('census_blocks')}) b JOIN customer c ON b."GISJOIN" = 'G06' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0'))
    SELECT a.event_id, a.fire_type, a.year, h."GISJOIN",
           CASE WHEN n.nation IS NULL THEN NULL WHEN (n.nation + a.year) % 25 >= CASE {_LEAST_SQL} END THEN 1 ELSE 0 END AS high
    FROM asked a LEFT JOIN hits h ON h.event_id = a.event_id LEFT JOIN nations n ON n."GISJOIN" = h."GISJOIN" """)
def _(spark, d):
    """Requests of three fire types and years, answered by six saved models and three scoring sets."""
    people = T.read(spark, d, "customer").select(F.concat(F.lit("G06"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("GISJOIN"), "c_nationkey", "c_acctbal")
    years = people.withColumn("target_year", F.explode(F.array(*map(F.lit, (2017, 2018, 2019)))))
    rows = years.withColumn("nation", ((F.col("c_nationkey") + F.col("target_year")) % 25).cast("double")).withColumn("balance", F.col("c_acctbal").cast("double"))
    registry = risk.ModelRegistry(scratch_path(spark, "registry"))
    registry.add_scoring_set(rows.select("GISJOIN", "nation", "balance", "target_year"))
    rows = materialize(tune.dealt(rows.select("GISJOIN", "nation", "balance"), "GISJOIN", 3 * people.count()).select("nation", "balance"))
    for (fire_type, year), least in _BURNS.items():
        pipeline = ML.forest_pipeline(["nation", "balance"], select=False, seed=SEED, numTrees=5, maxDepth=2, featureSubsetStrategy="all")
        registry.add_model(fire_type, year, pipeline.fit(rows.withColumn("label", (F.col("nation") >= least).cast("int"))))
    sites = T.logical(spark, d, "sites").alias("s").selectExpr("event_id", f"{_TYPE_SQL} AS fire_type", f"cast({_YEAR_SQL} AS int) AS year", "lon", "lat")
    answered = risk.risk_of_requests(sites, registry, T.blocks(spark, d))
    return answered.select("event_id", "fire_type", "year", "GISJOIN", (F.col("score") > 5).cast("int").alias("high"))


@query("risk_pipeline", "split s, n i, flagged_ok i", f"""
    SELECT CASE WHEN y.y = {GEO.LAST} THEN 'future' WHEN y.y = {GEO.LAST} - 1 THEN 'holdout' ELSE 'train' END AS split, count(*) AS n, 1 AS flagged_ok
    FROM ({T.table_sql('census_blocks')}) b, range({GEO.FIRST}, {GEO.LAST} + 1) y(y) GROUP BY 1""")
def _(spark, d):
    """The whole way: feature table of all blocks, null policy, split, forest, scores, flags; as facts that hold for any model."""
    table = features.yearly_feature_table(GEO.raw_tables(spark, d), GEO.FIRST, GEO.LAST, GEO.SINCE, last_complete_year=GEO.LAST)
    rows, flagged = risk.risk_lifecycle(
        table, "external", GEO.LAST, lambda names: ML.forest_pipeline(names, seed=SEED, numTrees=20, maxDepth=5)
    )
    blocks = rows.filter(F.col("split") == "future").agg(F.count(F.lit(1)).alias("blocks"))
    facts = flagged.agg(F.sum("highrisk").alias("flags"), F.count_distinct("GISJOIN").alias("keys")).withColumn("blocks", blocks.scalar())
    limit = risk.HIGH_RISK_BLOCKS["external"]
    held = facts.select(((F.col("keys") == F.col("blocks")) & ((F.col("flags") <= limit) | (F.col("blocks") <= limit))).cast("int").alias("flagged_ok"))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).withColumn("flagged_ok", held.scalar())
