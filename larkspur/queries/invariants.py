"""What must hold for fitted models, whatever numbers were fitted.

Every query runs one of the model queries over its whole tables and reduces the result to facts that SQL can
state: which rows are there and how they split, what adds up, what stays in order or within bounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.operators import encode
from larkspur.plans import customer as cust
from larkspur.plans import models
from larkspur.queries import frames, modelling
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import with_parts

_BUCKET = "('0x' || substr(md5(consumer_id::VARCHAR), 1, 8))::BIGINT % 100"
#: Validated consumers with their label and whether their newest order was an activation.
_HELD = f"SELECT consumer_id, deactivated, coalesce(is_activation, 0) AS segment FROM features JOIN target USING (consumer_id) WHERE {_BUCKET} >= 60"


def _sizes(keys: str) -> str:
    """Rows per class and in all, by keys."""
    return f"""
, held AS ({_HELD}), sizes AS (
  SELECT {keys}, '0' AS class, count(*) FILTER (deactivated = 0) AS n FROM held GROUP BY ALL
  UNION ALL SELECT {keys}, '1', count(*) FILTER (deactivated = 1) FROM held GROUP BY ALL
  UNION ALL SELECT {keys}, 'weighted', count(*) FROM held GROUP BY ALL)
"""


def _within(df: DataFrame, high: dict[str, float | None]) -> Column:
    """1 if every measure is missing or between 0 and its upper bound."""
    tests = [F.col(c).isNull() | ((F.col(c) >= 0) & (F.lit(True) if h is None else F.col(c) <= h + 1e-9)) for c, h in high.items() if c in df.columns]
    return reduce(lambda a, b: a & b, tests, F.lit(True)).cast("int").alias("within")


_MEASURES = {
    **{c: 1.0 for c in ("precision", "recall", "f1", "area_under_pr", "area_under_roc", "accuracy", "hard_roc_area", "hard_avg_precision")},
    **{c: None for c in ("avg_log_loss", "pred_over_actual")},
}


def _reported(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "class", F.col("n").cast("long").alias("n"), _within(df, _MEASURES))


@query(
    with_parts(
        ["features", "target"],
        _sizes("1 AS k")
        + "SELECT model, class, n, 1 AS within FROM sizes, (VALUES ('gradient_boosted_trees'), ('random_forest'), ('gbt_1_feature')) m(model)",
    )
)
def trained_models_hold(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees, forest and one-feature baseline judge the same held-out rows."""
    made, rows = [modelling.boosted, modelling.random_forest, modelling.one_feature], modelling._frame(spark, sf)
    return reduce(DataFrame.unionByName, [_reported(f(rows), "model") for f in made])


@query(with_parts(["features", "target"], _sizes("segment") + "SELECT segment::DOUBLE AS segment, class, n, 1 AS within FROM sizes"))
def segments_hold(spark: SparkSession, sf: str) -> DataFrame:
    return _reported(modelling.train_per_segment(spark, sf), "segment")


@query(
    with_parts(["features", "target"], _sizes("1 AS k") + "SELECT model, class, n, 1 AS within FROM sizes, (VALUES ('raw'), ('platt'), ('isotonic')) m(model)")
)
def calibration_study_holds(spark: SparkSession, sf: str) -> DataFrame:
    return _reported(modelling.calibration_study(spark, sf), "model")


@query("SELECT model, 1 AS within FROM (VALUES ('gradient_boosted_trees'), ('random_forest'), ('gbt_1_feature')) m(model)")
def compared_models_hold(spark: SparkSession, sf: str) -> DataFrame:
    out = modelling.model_compare(spark, sf)
    return out.select("model", _within(out, _MEASURES))


@query(
    with_parts(
        ["features", "target"],
        f", held AS ({_HELD}) SELECT method, count(*) AS n, CAST(sum(deactivated) AS BIGINT) AS deactivated, 1 AS within, 0 AS inversions FROM held, (VALUES ('isotonic'), ('platt')) m(method) GROUP BY method",
    )
)
def calibrations_hold(spark: SparkSession, sf: str) -> DataFrame:
    """Both calibrations keep every row, stay between 0 and 1, and never turn the order of scores
    around (looked at per ten-thousandth of the score)."""
    out = None
    for method, f in (("isotonic", modelling.calibrate_isotonic), ("platt", modelling.calibrate_platt)):
        df = f(spark, sf)
        steps = df.groupBy(F.floor(F.col("prob_deact") * 10_000).alias("b")).agg(F.min("prob_deact_cal").alias("lo"), F.max("prob_deact_cal").alias("hi"))
        turned = F.max("hi").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)) > F.col("lo") + 1e-12  # at most 10,001 rows
        inversions = steps.select(turned.alias("t")).agg(F.sum(F.when(F.col("t"), 1).otherwise(0)).cast("int").alias("inversions"))
        inside = F.min(F.when(F.col("prob_deact_cal").between(0, 1), 1).otherwise(0))
        one = df.agg(F.count("*").alias("n"), F.sum(models.LABEL).cast("long").alias("deactivated"), inside.alias("within"))
        one = one.select(F.lit(method).alias("method"), "*", inversions.scalar().alias("inversions"))
        out = one if out is None else out.unionByName(one)
    return out


@query(with_parts(["features", "target"], "SELECT consumer_id, least(features.recency, 365)::DOUBLE AS recency, 1 AS holds FROM features JOIN target USING (consumer_id)"))
def scores_hold(spark: SparkSession, sf: str) -> DataFrame:
    """Every consumer is scored once, with 1 near a year without order and the model's probability before."""
    out = modelling.score_batch(spark, sf)
    want = F.when(F.col("recency_x") >= 362, 1.0).otherwise(F.col("prob_deact"))
    fine = (F.col("masked_prob") == want) & F.col("masked_prob").between(0, 1)
    return out.select("consumer_id", F.col("recency_x").alias("recency"), fine.cast("int").alias("holds"))


@query(with_parts(["features", "target"], f", held AS ({_HELD}) SELECT consumer_id, 0.0::DOUBLE AS difference FROM held"))
def loaded_model_holds(spark: SparkSession, sf: str) -> DataFrame:
    return modelling.model_roundtrip(spark, sf).select("consumer_id", (F.col("loaded") - F.col("fitted")).alias("difference"))


@query("SELECT 1 AS named_once, 1 AS above_least, 1 AS within_one, 1 AS ranked")
def importances_hold(spark: SparkSession, sf: str) -> DataFrame:
    out = modelling.feature_importance(spark, sf)
    value = F.col("importance")
    # a row per feature of the model
    falls = F.coalesce(F.lag("importance").over(Window.orderBy(F.desc("importance"), "feature")) >= value, F.lit(True))
    return out.select("*", falls.alias("falls")).agg(
        (F.count_distinct("feature") == F.count("*")).cast("int").alias("named_once"),
        (F.min(value) >= 0.001).cast("int").alias("above_least"),
        (F.sum(value) <= 1 + 1e-9).cast("int").alias("within_one"),
        F.min(F.col("falls").cast("int")).alias("ranked"),
    )


@query("SELECT round, dropped, 1 AS within FROM (VALUES (1, 0), (2, 20), (3, 30)) r(round, dropped)")
def elimination_holds(spark: SparkSession, sf: str) -> DataFrame:
    """Each round has lost the stated number of features, and importances add up to 1 or, without a split, to 0."""
    out = modelling.backward_elimination(spark, sf).groupBy("round").agg(F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total"))
    first = F.max("features").over(Window.orderBy(F.lit(1)))  # three rows
    return out.select("round", (first - F.col("features")).cast("int").alias("dropped"), F.col("total").isin(0.0, 1.0).cast("int").alias("within"))


@query("SELECT max_depth, 1 AS within FROM (VALUES (6), (10), (20), (30)) d(max_depth)")
def forest_grid_holds(spark: SparkSession, sf: str) -> DataFrame:
    return modelling.grid_forest(spark, sf).select("max_depth", F.col("auc").between(0, 1).cast("int").alias("within"))


@query("SELECT feature, 1 AS holds FROM (VALUES ('neighborhood'), ('garage_type'), ('style'), ('lot_frontage'), ('year_remod'), ('lot_frontage_na')) f(feature)")
def lasso_holds(spark: SparkSession, sf: str) -> DataFrame:
    out = modelling.lasso_select(spark, sf)
    return out.select("feature", ((F.col("coefficient") != 0).cast("int") == F.col("selected")).cast("int").alias("holds"))


@query(
    """
WITH t AS (SELECT CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS survived FROM customer
  WHERE ('0x' || substr(md5(c_custkey::VARCHAR), 1, 8))::BIGINT % 100 >= 80)
SELECT 'total' AS actual, count(*) AS total, 1 AS holds FROM t UNION ALL SELECT 'actual_' || survived, count(*), 1 FROM t GROUP BY survived
"""
)
def logistic_holds(spark: SparkSession, sf: str) -> DataFrame:
    """The confusion matrix holds every held-out row, and its diagonal is the accuracy."""
    out = modelling.train_logistic(spark, sf)
    right = out.where("actual <> 'total'").agg(F.sum(F.when(F.col("actual") == "actual_1", F.col("predicted_1")).otherwise(F.col("predicted_0")))).scalar()
    every = out.where("actual = 'total'").agg(F.max("total")).scalar()
    adds = F.col("predicted_0") + F.col("predicted_1") == F.col("total")
    fine = adds & (F.abs(F.col("accuracy") - right / every) < 1e-9)
    return out.select("actual", "total", fine.cast("int").alias("holds"))


@query(with_parts(["features"], "SELECT consumer_id, least(recency, 365)::DOUBLE AS recency, least(coalesce(frequency_t24m, 0), 46)::DOUBLE AS frequency, 6::DOUBLE AS labels FROM features"))
def assembled_features_hold(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers lie in their slots of the vector, and each of the six text columns sets one slot."""
    names = encode.numeric_columns(models.model_frame(cust.transformed(frames.features(spark, sf))))
    from larkspur.queries.encoding import features_assemble

    v = F.col("features")
    labels = F.aggregate(F.slice(v, len(names) + 1, F.size(v)), F.lit(0.0), lambda s, x: s + x)
    at = lambda c: F.get(v, F.lit(names.index(c)))
    return features_assemble(spark, sf).select("consumer_id", at("recency_x").alias("recency"), at("frequency_t24m_x").alias("frequency"), labels.alias("labels"))
