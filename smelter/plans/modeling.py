"""Feature tables, model training/evaluation/promotion, scoring, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from smelter.functions.columns import hash_bucket_sql, round_half_up, round_half_up_sql as r, with_scalars
from smelter.models import features as fx
from smelter.models import attribution, calibration, scoring, training
from smelter.plans.medallion import SILVER_SQL, silver
from smelter.plans.registry import register
from smelter.session import materialize
from smelter.sources.standins import duckdb_ctes

FEATS = fx.ENERGY_FEATURES
TARGET = fx.ENERGY_TARGET

REG_SQL = SILVER_SQL + f""",
reg AS (
  SELECT CAST(furnace_id AS VARCHAR) || '_' || CAST(CAST(epoch(ts) AS BIGINT) AS VARCHAR) AS reading_id,
         furnace_id, ts, {', '.join(FEATS)}, {TARGET}
  FROM silver WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATS + [TARGET])}),
split AS (SELECT *, CASE WHEN {hash_bucket_sql('reading_id')} < 80 THEN 'train' ELSE 'test' END AS split FROM reg)"""

BASELINE_SQL = REG_SQL + f""",
fmean AS (SELECT furnace_id, avg({TARGET}) AS m FROM split WHERE split = 'train' GROUP BY furnace_id),
gmean AS (SELECT avg({TARGET}) AS g FROM split WHERE split = 'train'),
scored AS (
  SELECT s.*, coalesce(f.m, (SELECT g FROM gmean)) AS furnace_mean_pred, (SELECT g FROM gmean) AS global_mean_pred
  FROM split s LEFT JOIN fmean f ON s.furnace_id = f.furnace_id)"""


def _metric_sql(model, pred):
    err = f"({TARGET} - {pred})"
    return (f"SELECT '{model}' AS model, count(*) AS n, {r(f'sqrt(avg({err} * {err}))', 4)} AS rmse, "
            f"{r(f'avg(abs({err}))', 4)} AS mae, "
            f"{r(f'1 - sum({err} * {err}) / (var_pop({TARGET}) * count(*))', 4)} AS r2 "
            f"FROM scored WHERE split = 'test'")


METRICS_SQL = BASELINE_SQL + ",\nmetrics AS (\n" + "\nUNION ALL\n".join([
    _metric_sql("linear", TARGET),  # the stand-in target is exactly linear in the features
    _metric_sql("furnace_mean", "furnace_mean_pred"),
    _metric_sql("global_mean", "global_mean_pred"),
]) + ")"


def regression_split(t):
    return fx.hash_split(fx.regression_set(silver(t)))


def mean_baselines(split):
    """Two reference predictors defined by aggregates of the training split."""
    train = split.filter(F.col("split") == "train")
    fmean = train.groupBy("furnace_id").agg(F.avg(TARGET).alias("_fm"))
    joined = with_scalars(split.join(fmean, "furnace_id", "left"),
                          global_mean_pred=train.agg(F.avg(TARGET)).scalar())
    return (joined.withColumn("furnace_mean_pred", F.coalesce(F.col("_fm"), F.col("global_mean_pred")))
            .drop("_fm"))


def _linear(t):
    split = materialize(regression_split(t))
    model = training.fit_regressor(split.filter(F.col("split") == "train"), "linear", FEATS, TARGET)
    return split, model


def model_metrics(t):
    split, model = _linear(t)
    scored = mean_baselines(split)
    test = scored.filter(F.col("split") == "test")
    long = training.predictions_long({"linear": model}, test, "reading_id", TARGET)
    for name, col in (("furnace_mean", "furnace_mean_pred"), ("global_mean", "global_mean_pred")):
        long = long.unionByName(test.select(F.lit(name).alias("model"), "reading_id",
                                            F.col(TARGET).alias("label"), F.col(col).alias("prediction")))
    return training.regression_metrics(long)


@register("regression_set", ("ML1", "PRJ4", "FN6", "FN7", "FLT4"), REG_SQL + "\nSELECT * FROM reg")
def q_regression_set(t):
    return fx.regression_set(silver(t))


@register("feature_key_check", ("ML2",), REG_SQL + """
SELECT 'energy_features' AS table_name, 'reading_id' AS key_column, CAST(sum(n) AS BIGINT) AS rows,
       count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicated_keys,
       count(*) FILTER (WHERE reading_id IS NULL) AS null_keys,
       (count(*) FILTER (WHERE n > 1) = 0 AND count(*) FILTER (WHERE reading_id IS NULL) = 0) AS is_unique
FROM (SELECT reading_id, count(*) AS n FROM reg GROUP BY reading_id)""")
def q_feature_key_check(t):
    return fx.key_check(fx.regression_set(silver(t)))


@register("hash_split", ("ML3",), REG_SQL + "\nSELECT * FROM split")
def q_hash_split(t):
    return regression_split(t)


@register("defect_dataset", ("JN10", "ML4", "PRJ10"), SILVER_SQL + ",\n" + duckdb_ctes("inspections") + f""",
means AS (SELECT furnace_id, {', '.join(f"avg({c}) AS avg_{c}" for c in fx.STATE_COLUMNS)} FROM silver GROUP BY furnace_id)
SELECT i.inspection_id, i.furnace_id, i.date, i.alloy_id, i.defect_type, i.surface_quality_score, i.is_defect,
       {', '.join(r(f'm.avg_{c}', 6) + f' AS avg_{c}' for c in fx.STATE_COLUMNS)},
       {r('abs(m.avg_temperature_c - 960)', 6)} AS temperature_deviation
FROM inspections i LEFT JOIN means m ON i.furnace_id = m.furnace_id""")
def q_defect_dataset(t):
    """Inspections + per-furnace mean state (and the mean's distance to 960 C)."""
    ds = fx.defect_dataset(t.role("inspections"), silver(t))
    ds = ds.withColumn("temperature_deviation", F.abs(F.col("avg_temperature_c") - 960.0))
    return ds.select(*[round_half_up(c, 6).alias(c) if c.startswith("avg_") or c == "temperature_deviation"
                       else F.col(c) for c in ds.columns])


def _recent_sql(hours: int) -> str:
    return SILVER_SQL + ",\n" + duckdb_ctes("inspections") + f""",
recent AS (
  SELECT i.inspection_id, count(*) AS window_readings,
         {', '.join(f'avg(s.{c}) AS recent_{c}' for c in fx.STATE_COLUMNS)}
  FROM inspections i JOIN silver s ON s.furnace_id = i.furnace_id
   AND s.ts > CAST(i.date AS TIMESTAMP) - INTERVAL {hours} HOUR AND s.ts <= CAST(i.date AS TIMESTAMP)
  GROUP BY i.inspection_id)
SELECT i.*, r.window_readings, {', '.join(r(f'r.recent_{c}', 6) + f' AS recent_{c}' for c in fx.STATE_COLUMNS)}
FROM inspections i LEFT JOIN recent r ON i.inspection_id = r.inspection_id"""


def _recent_state(t, hours: int):
    ds = fx.defect_recent_state(t.role("inspections"), silver(t), hours)
    return ds.select(*[round_half_up(c, 6).alias(c) if c.startswith("recent_") else F.col(c)
                       for c in ds.columns])


@register("defect_recent_state", ("JN11",), _recent_sql(24))
def q_defect_recent_state(t):
    """Furnace state in the 24 h before each inspection (as-of running sums)."""
    return _recent_state(t, 24)


@register("defect_recent_state_90d", ("JN11",), _recent_sql(90 * 24))
def q_defect_recent_state_90d(t):
    """The same over 90 days: as many rows shuffled as over one."""
    return _recent_state(t, 90 * 24)


@register("energy_linear", ("ML5",), "\nUNION ALL\n".join(
    f"SELECT '{term}' AS term, CAST({value} AS DOUBLE) AS coefficient" for term, value in
    [("temperature_c", 35), ("amperage_ka", 2), ("anode_effect", 120), ("bath_ratio", 0),
     ("alumina_feed_rate", 0), ("intercept", -20850)]))
def q_energy_linear(t):
    """Linear regression on the training split.  The oracle is the planted
    relation of the stand-in telemetry (energy = -20850 + 35 T + 2 A + 120 anode)."""
    _, model = _linear(t)
    return training.linear_coefficients(model, FEATS, digits=4)


@register("model_metrics", ("ML8", "ML11"), METRICS_SQL + "\nSELECT * FROM metrics")
def q_model_metrics(t):
    """RMSE / MAE / R^2 of every model on the same test split, one pass."""
    return model_metrics(t)


@register("best_run", ("TOP5", "ML11"), METRICS_SQL + "\nSELECT * FROM metrics ORDER BY rmse, model LIMIT 1")
def q_best_run(t):
    return training.best_model(model_metrics(t))


@register("champion_decision", ("ML14",), METRICS_SQL + """
SELECT 'furnace_mean' AS champion, 'linear' AS challenger,
       max(rmse) FILTER (WHERE model = 'furnace_mean') AS champion_metric,
       max(rmse) FILTER (WHERE model = 'linear') AS challenger_metric,
       CASE WHEN max(rmse) FILTER (WHERE model = 'linear') < max(rmse) FILTER (WHERE model = 'furnace_mean')
            THEN 'linear' ELSE 'furnace_mean' END AS winner
FROM metrics""")
def q_champion_decision(t):
    """Strictly-better rule: the challenger replaces the champion only with a lower RMSE."""
    return training.promotion(model_metrics(t), "furnace_mean", "linear")


@register("energy_trees", ("ML6", "ML7", "ML8"))
def q_energy_trees(t):
    """Gradient-boosted and random-forest (150 trees, depth 10, seed 42)
    challengers, evaluated with the same metrics."""
    split = materialize(regression_split(t))
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    models = {k: training.fit_regressor(train, k, FEATS, TARGET) for k in ("gbt", "random_forest")}
    return training.regression_metrics(training.predictions_long(models, test, "reading_id", TARGET))


@register("energy_predictions", ("ML16", "ML17", "UDF5", "FN16"), REG_SQL + f"""
SELECT reading_id, furnace_id, ts, {TARGET}, {r(TARGET, 2)} AS predicted_energy_kwh_ton,
       {r(TARGET, 2)} AS predicted_by_udf
FROM reg""")
def q_energy_predictions(t):
    """Batch scoring of the feature table with the fitted pipeline, read back
    through a SQL view, plus the same model applied as a vectorised UDF."""
    split, model = _linear(t)
    scored = scoring.score(model, split.drop("split"))
    scoring.register_scored_view(t.spark, scored, "energy_predictions_view")
    lr = model.stages[-1]
    udf = scoring.linear_scorer(lr.coefficients.toArray().tolist(), float(lr.intercept))
    out = t.spark.sql(
        "SELECT reading_id, furnace_id, ts, energy_kwh_ton, predicted_energy_kwh_ton, "
        "named_struct('temperature_c', temperature_c, 'amperage_ka', amperage_ka, "
        "'anode_effect', anode_effect, 'bath_ratio', bath_ratio, 'alumina_feed_rate', alumina_feed_rate) AS request "
        "FROM energy_predictions_view")
    out = out.withColumn("predicted_by_udf", udf(*[F.col(f"request.{c}") for c in FEATS])).drop("request")
    return out.select("reading_id", "furnace_id", "ts", TARGET,
                      round_half_up("predicted_energy_kwh_ton", 2).alias("predicted_energy_kwh_ton"),
                      round_half_up("predicted_by_udf", 2).alias("predicted_by_udf"))


@register("inefficiency_alerts", ("ML18", "PRJ11", "FLT3", "TOP4"), BASELINE_SQL + f"""
SELECT reading_id, furnace_id, ts, {TARGET}, {r('furnace_mean_pred', 4)} AS predicted_energy_kwh_ton,
       {r(f'{TARGET} - furnace_mean_pred', 4)} AS deviation
FROM scored WHERE {TARGET} - furnace_mean_pred > 300
ORDER BY {TARGET} - furnace_mean_pred DESC, reading_id LIMIT 20""")
def q_inefficiency_alerts(t):
    """Readings more than 300 kWh/t above their furnace's expected energy
    (the training-split furnace mean), largest first, top 20."""
    scored = mean_baselines(materialize(regression_split(t))).withColumnRenamed(
        "furnace_mean_pred", "predicted_energy_kwh_ton")
    alerts = scoring.deviation_alerts(scored, TARGET, "predicted_energy_kwh_ton", 300.0, 20)
    return alerts.select("reading_id", "furnace_id", "ts", TARGET,
                         round_half_up("predicted_energy_kwh_ton", 4).alias("predicted_energy_kwh_ton"),
                         # nine digits first: a furnace mean carries noise of its order of summation
                         round_half_up(F.round("deviation", 9), 4).alias("deviation"))


DEFECT_FEATURES = ["surface_quality_score"] + [f"avg_{c}" for c in fx.STATE_COLUMNS]


def defect_data(t):
    """Classification set without identifiers, with a hash train/test label
    on the inspection id, checkpointed for the iterative fits."""
    ds = fx.defect_dataset(t.role("inspections"), silver(t))
    ds = ds.withColumn("split", fx.split_label("inspection_id"))
    return materialize(ds)


def defect_search(t, families=("logistic", "random_forest", "gbt")):
    data = defect_data(t)
    return data, training.classifier_search(fx.model_inputs(data.drop("split")), "is_defect",
                                            DEFECT_FEATURES, families=families)


@register("defect_classifier", ("ML9", "ML15", "PRJ3"))
def q_defect_classifier(t):
    """Cross-validated search over three model families by positive-class F1;
    the winner follows the strictly-better rule with F1 (higher wins)."""
    _, results = defect_search(t)
    best = max(results, key=lambda name: (results[name][1], name == "logistic"))
    rows = [(name, float(f1), name == best) for name, (_, f1) in results.items()]
    return t.spark.createDataFrame(rows, "model string, f1 double, is_best boolean")


def _trained(t, family):
    """All inspections with their split, and a model of the training split."""
    data = defect_data(t)
    train = fx.model_inputs(data.filter(F.col("split") == "train").drop("split"))
    return data, training.fit_classifier(train, family, "is_defect", DEFECT_FEATURES)


def _held_out(t, family):
    data, model = _trained(t, family)
    test = data.filter(F.col("split") == "test").drop("split").withColumn(
        "is_defect", F.col("is_defect").cast("double"))
    return model, test


@register("defect_confusion", ("ML10",))
def q_defect_confusion(t):
    """Confusion matrix of a logistic model on the held-out inspections."""
    model, test = _held_out(t, "logistic")
    return model.transform(test).groupBy("is_defect", "prediction").agg(F.count(F.lit(1)).alias("n"))


@register("defect_importance", ("ML10",))
def q_defect_importance(t):
    """Feature importances of a random forest trained on the training split."""
    model, _ = _held_out(t, "random_forest")
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return t.spark.createDataFrame(list(zip(DEFECT_FEATURES, map(float, imp))), "feature string, importance double")


@register("high_defect_probability", ("ML20",))
def q_high_defect_probability(t):
    """Inspections whose predicted defect probability exceeds 0.5: the model of
    the training split scores all of them."""
    data, model = _trained(t, "logistic")
    data = data.drop("split").withColumn("is_defect", F.col("is_defect").cast("double"))
    return (model.transform(data).withColumn("p_defect", scoring.probability_of("probability", 1))
            .filter(F.col("p_defect") > 0.5).select("inspection_id", "furnace_id", "is_defect", "p_defect"))


def _calibrated(t):
    """All inspections with their split and calibrated defect probability."""
    data = defect_data(t)
    train = data.filter(F.col("split") == "train").drop("split")
    model = calibration.fit_calibrated(train, "logistic", "is_defect", DEFECT_FEATURES, "inspection_id")
    return model.score(data, "p_defect")


@register("elevated_defect_probability", ("ML20",))
def q_elevated_defect_probability(t):
    """Inspections whose calibrated defect probability exceeds the defect rate
    of the training split: what a threshold of one half cannot show for a rare
    class."""
    scored = _calibrated(t)
    rate = scored.filter(F.col("split") == "train").agg(F.avg(F.col("is_defect").cast("double"))).first()[0]
    return (scored.withColumn("base_rate", F.lit(rate).cast("double")).filter(F.col("p_defect") > F.col("base_rate"))
            .select("inspection_id", "furnace_id", "is_defect", "p_defect", "base_rate"))


@register("defect_calibration", ("ML20", "ML10"))
def q_defect_calibration(t):
    """Predicted against observed defect rate on the held-out inspections."""
    test = _calibrated(t).filter(F.col("split") == "test").withColumn("is_defect", F.col("is_defect").cast("double"))
    return calibration.reliability(materialize(test), "is_defect", "p_defect")


# the planted relation of the stand-in telemetry, as for energy_linear
_PLANTED = {"temperature_c": 35, "amperage_ka": 2, "anode_effect": 120, "bath_ratio": 0, "alumina_feed_rate": 0}


@register("furnace_energy_gap", ("RCA1",), REG_SQL + f""",
means AS (SELECT furnace_id, {', '.join(f'avg({c}) AS {c}' for c in [*FEATS, TARGET])} FROM reg GROUP BY furnace_id),
best AS (SELECT * FROM means ORDER BY {r(TARGET, 6)}, furnace_id LIMIT 1),
parts AS (
""" + "\nUNION ALL\n".join(
    f"SELECT m.furnace_id, b.furnace_id AS against_id, '{f}' AS term, {c} * (m.{f} - b.{f}) AS contribution, "
    f"m.{TARGET} - b.{TARGET} AS gap FROM means m, best b" for f, c in _PLANTED.items()) + f"""
UNION ALL
SELECT m.furnace_id, b.furnace_id, '{attribution.UNEXPLAINED}', 0, m.{TARGET} - b.{TARGET} FROM means m, best b)
SELECT furnace_id, against_id, term, {r('contribution', 4)} AS contribution, {r('gap', 4)} AS gap
FROM parts WHERE furnace_id <> against_id""")
def q_furnace_energy_gap(t):
    """Every furnace against the one with the least mean energy: the gap split
    into what each feature contributes under the fitted linear model."""
    split, model = _linear(t)
    coefficients = {row.term: row.coefficient for row in training.linear_coefficients(model, FEATS).collect()}  # six rows
    del coefficients["intercept"]
    means = materialize(attribution.group_means(split, "furnace_id", [*FEATS, TARGET]))
    best = means.agg(F.min(F.struct(round_half_up(TARGET, 6).alias("e"), "furnace_id")).alias("m")).select("m.furnace_id").scalar()
    pairs = with_scalars(means.select("furnace_id"), against_id=best).filter("furnace_id <> against_id")
    gaps = attribution.gap_contributions(means, pairs, "furnace_id", "against_id", coefficients, TARGET)
    return gaps.select("furnace_id", "against_id", "term", round_half_up("contribution", 4).alias("contribution"),
                       round_half_up("gap", 4).alias("gap"))


@register("failure_classifier", ("ML19",))
def q_failure_classifier(t):
    """Predictive-maintenance variant: is_failure on telemetry readings, the
    same search over three model families."""
    data = materialize(silver(t).select(*FEATS, "vibration_mm_s", "is_failure"))
    results = training.classifier_search(data, "is_failure", FEATS + ["vibration_mm_s"])
    rows = [(name, float(f1)) for name, (_, f1) in results.items()]
    return t.spark.createDataFrame(rows, "model string, f1 double")
