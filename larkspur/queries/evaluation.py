"""Evaluation reports on exact scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.numeric import log_loss as loss_of
from larkspur.operators import evaluate
from larkspur.operators.joins import full_compare
from larkspur.queries import frames
from larkspur.queries.frames import round_all, text_dates
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import ASOF, with_parts
from larkspur.sources.star import ORDERS_ASOF


def _loss(y: str, p: str) -> str:
    return f"CASE WHEN {y} = 1 THEN CASE WHEN {p} > 0 THEN -ln({p}) END ELSE CASE WHEN 1 - {p} > 0 THEN -ln(1 - {p}) END END"


@query(
    with_parts(
        ["scores"],
        """
SELECT consumer_id, recency, masked_prob FROM scores
""",
    )
)
def mask_probability(spark: SparkSession, sf: str) -> DataFrame:
    return frames.scores(spark, sf).select("consumer_id", "recency", "masked_prob")


@query(
    with_parts(
        ["scores"],
        """
SELECT CASE WHEN grouping(deactivated) = 1 THEN 'total' ELSE 'actual_' || deactivated::VARCHAR END AS actual,
  count(*) FILTER (round(prob_v3, 0) = 0) AS predicted_0, count(*) FILTER (round(prob_v3, 0) = 1) AS predicted_1,
  count(*) AS total FROM scores GROUP BY ROLLUP (deactivated)
""",
    )
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion_matrix(frames.scores(spark, sf), "deactivated", "prob_v3")


@query(
    with_parts(
        ["scores"],
        f"""
, c AS (SELECT deactivated AS y, round(prob_v3, 0) AS d, {_loss('deactivated', 'prob_v3')} AS l FROM scores),
m AS (SELECT k AS class, count(*) FILTER (y = k) AS n, coalesce(count(*) FILTER (y = k AND d = k) / nullif(count(*) FILTER (d = k), 0), 0) AS precision,
  coalesce(count(*) FILTER (y = k AND d = k) / nullif(count(*) FILTER (y = k), 0), 0) AS recall,
  avg(l) FILTER (y = k) AS avg_log_loss, coalesce(count(*) FILTER (d = k) / nullif(count(*) FILTER (y = k), 0), 0) AS pred_over_actual
  FROM c, (VALUES (0), (1)) v(k) GROUP BY k),
f AS (SELECT class::VARCHAR AS class, n, precision, recall,
  coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1, avg_log_loss, pred_over_actual FROM m)
SELECT class, n, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  round(avg_log_loss, 6) AS avg_log_loss, round(pred_over_actual, 6) AS pred_over_actual FROM f
UNION ALL SELECT 'weighted', CAST(sum(n) AS BIGINT), round(sum(n * precision) / sum(n), 6), round(sum(n * recall) / sum(n), 6),
  round(sum(n * f1) / sum(n), 6), round(sum(n * avg_log_loss) / sum(n), 6), round(sum(n * pred_over_actual) / sum(n), 6) FROM f
""",
    )
)
def class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.class_metrics(frames.scores(spark, sf), "deactivated", "prob_v3"))


@query(
    with_parts(
        ["scores"],
        "SELECT round(prob_v3, 2) AS prob_bucket, round(avg(deactivated), 6) AS pct_deactivated FROM scores GROUP BY 1",
    )
)
def calibration_table(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.calibration_table(frames.scores(spark, sf), "deactivated", "prob_v3"))


_CURVE = """
SELECT min(cutoff) AS cutoff, tp, fp, any_value(tpr) AS tpr, any_value(fpr) AS fpr, any_value(precision) AS precision FROM (
  SELECT c / 100.0 AS cutoff, tp, fp, tp / nullif(p, 0) AS tpr, fp / nullif(n, 0) AS fpr, coalesce(tp / nullif(tp + fp, 0), 1) AS precision
  FROM (SELECT c, count(*) FILTER (deactivated = 1 AND prob_v3 >= c / 100.0) AS tp, count(*) FILTER (deactivated = 0 AND prob_v3 >= c / 100.0) AS fp,
      count(*) FILTER (deactivated = 1) AS p, count(*) FILTER (deactivated = 0) AS n
    FROM scores CROSS JOIN range(101) g(c) GROUP BY c)) GROUP BY tp, fp
"""


@query(
    with_parts(
        ["scores"],
        f"SELECT CAST(cutoff AS DOUBLE) AS cutoff, tp, fp, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(precision, 6) AS precision FROM ({_CURVE})",
    )
)
def cutoff_curve(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.cutoff_curve(frames.scores(spark, sf), "deactivated", "prob_v3"))


@query(
    with_parts(
        ["scores"],
        f"""
SELECT round(coalesce(sum((pt - tpr) * (pp + precision) / 2), 0), 6) AS area_under_pr,
  round(coalesce(sum((pf - fpr) * (pt + tpr) / 2), 0), 6) AS area_under_roc
FROM (SELECT *, lag(tpr) OVER (ORDER BY cutoff) AS pt, lag(fpr) OVER (ORDER BY cutoff) AS pf, lag(precision) OVER (ORDER BY cutoff) AS pp
  FROM ({_CURVE}))
""",
    )
)
def auc_trapezoid(spark: SparkSession, sf: str) -> DataFrame:
    curve = evaluate.cutoff_curve(frames.scores(spark, sf), "deactivated", "prob_v3")
    return round_all(evaluate.trapezoid_areas(curve))


@query(
    with_parts(
        ["scores"],
        f"""
SELECT days_until_deact, count_users, deacts_actual, deacts_pred, round(avg_log_loss, 6) AS avg_log_loss,
  round(avg_prob_deact, 6) AS avg_prob_deact, round(accuracy, 6) AS accuracy, round(deacts_actual / count_users, 6) AS pct_deact_actual,
  round(deacts_pred / count_users, 6) AS pct_deact_pred, round(deacts_pred / nullif(deacts_actual, 0), 6) AS pred_over_actual_deacts,
  round(deacts_pred / count_users - deacts_actual / count_users, 6) AS diff_pct_deact
FROM (SELECT CAST(365 - recency AS INTEGER) AS days_until_deact, count(*) AS count_users, CAST(sum(deactivated) AS BIGINT) AS deacts_actual,
    CAST(trunc(round(sum(prob_v3), 9)) AS INTEGER) AS deacts_pred, avg({_loss('deactivated', 'prob_v3')}) AS avg_log_loss, avg(prob_v3) AS avg_prob_deact,
    avg(CASE WHEN deactivated = round(prob_v3, 0) THEN 1 ELSE 0 END) AS accuracy
  FROM scores WHERE recency >= 0 AND recency <= 365 GROUP BY recency)
""",
    )
)
def recency_aggregation(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.recency_aggregation(frames.scores(spark, sf), "deactivated", "prob_v3", "recency", "consumer_id"))


@query(
    with_parts(
        ["scores"],
        f"""
SELECT CAST({ASOF} + CAST(365 - recency AS INTEGER) AS VARCHAR) AS deact_date, CAST(trunc(round(sum(prob_v3), 9)) AS INTEGER) AS total_deacts
FROM scores GROUP BY recency
""",
    )
)
def total_deacts(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(evaluate.total_deacts(frames.scores(spark, sf), "prob_v3", "recency", ORDERS_ASOF))


@query(
    with_parts(
        ["scores"],
        f"""
SELECT deactivated, round(avg({_loss('deactivated', 'prob_v3')}), 6) AS log_loss_prob_v3, round(avg({_loss('deactivated', 'prob_v2')}), 6) AS log_loss_prob_v2,
  round(avg({_loss('deactivated', 'masked_prob')}), 6) AS log_loss_masked_prob
FROM scores GROUP BY deactivated
""",
    )
)
def log_loss(spark: SparkSession, sf: str) -> DataFrame:
    probs = ["prob_v3", "prob_v2", "masked_prob"]
    return round_all(evaluate.losses(frames.scores(spark, sf), "deactivated", probs, ["deactivated"]))


def _check_sql(prob: str) -> str:
    return f"""
SELECT prediction, deactivated, count(*) AS cnt, round(avg(loss), 6) AS avg_log_loss FROM (
  SELECT CAST(round(p, 0) AS INTEGER) AS prediction, deactivated, {_loss('deactivated', 'p')} AS loss
  FROM (SELECT v.*, {prob} AS p, t.deactivated FROM v2 v LEFT JOIN (SELECT * FROM target WHERE recency <= 330) t ON v.consumer_id = t.consumer_id))
GROUP BY prediction, deactivated
"""


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions with the known outcomes; the oldest ones are not known yet."""
    known = frames.target(spark, sf).where(F.col("recency") <= 330).select("consumer_id", "deactivated")
    return frames.predictions_v2(spark, sf).join(known, "consumer_id", "left")


@query(with_parts(["v2", "target"], _check_sql("prob_deact")))
def result_check(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.result_check(_checked(spark, sf), "deactivated", "prob_deact"))


@query(with_parts(["v2", "target"], _check_sql("CASE WHEN v.recency >= 362 THEN 1.0::DOUBLE ELSE prob_deact END")))
def result_check_masked(spark: SparkSession, sf: str) -> DataFrame:
    masked = evaluate.mask_probability(_checked(spark, sf), "prob_deact", "recency", 3)
    return round_all(evaluate.result_check(masked, "deactivated", "masked_prob"))


@query(
    with_parts(
        ["compared"],
        """
SELECT consumer_id_v2, consumer_id_v3, deact_date_v2::VARCHAR AS deact_date_v2, deact_date_v3::VARCHAR AS deact_date_v3, recency_v2, recency_v3,
  round(prob_deact_v2, 6) AS prob_deact_v2, round(prob_deact_v3, 6) AS prob_deact_v3, round(err, 6) AS err, round(abs_err, 6) AS abs_err,
  round(sq_err, 6) AS sq_err FROM compared
""",
    )
)
def compare_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.model_errors(frames.compared(spark, sf), "prob_deact_v2", "prob_deact_v3")
    return text_dates(round_all(out))


@query(
    with_parts(
        ["accuracy"],
        "SELECT consumer_id, deact_date::VARCHAR AS deact_date, recency, round(prob_v2, 6) AS prob_v2, round(prob_v3, 6) AS prob_v3, deactivated FROM accuracy",
    )
)
def compare_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(round_all(frames.accuracy(spark, sf)))


@query(
    with_parts(
        ["accuracy"],
        f"""
SELECT days_until_deact, CAST(sum(deactivated) AS BIGINT) AS deacts_actual, round(sum(prob_v2), 6) AS deacts_prob_v2, round(sum(prob_v3), 6) AS deacts_prob_v3,
  round(avg({_loss('deactivated', 'prob_v2')}), 6) AS log_loss_prob_v2, round(avg({_loss('deactivated', 'prob_v3')}), 6) AS log_loss_prob_v3,
  round(sum(prob_v2) / nullif(sum(deactivated), 0) - 1, 6) AS over_prob_v2, round(sum(prob_v3) / nullif(sum(deactivated), 0) - 1, 6) AS over_prob_v3
FROM (SELECT *, CASE WHEN recency >= 335 THEN '1. 1-30 days' WHEN recency >= 305 THEN '2. 31-60 days' WHEN recency >= 275 THEN '3. 61-90 days'
    WHEN recency >= 245 THEN '4. 91-120 days' WHEN recency >= 185 THEN '5. 121-180 days' ELSE '6. 181-365 days' END AS days_until_deact FROM accuracy)
GROUP BY days_until_deact
""",
    )
)
def loss_by_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.loss_by_bucket(frames.accuracy(spark, sf), "deactivated", ["prob_v2", "prob_v3"], "recency"))


@query(
    with_parts(
        ["accuracy"],
        f"""
SELECT recency, round(avg(deactivated), 6) AS pct_deact_actual, round(avg(prob_v2), 6) AS avg_prob_v2, round(avg(prob_v3), 6) AS avg_prob_v3,
  round(avg({_loss('deactivated', 'prob_v2')}), 6) AS log_loss_prob_v2, round(avg({_loss('deactivated', 'prob_v3')}), 6) AS log_loss_prob_v3
FROM accuracy GROUP BY recency
""",
    )
)
def loss_by_recency(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.loss_by_recency(frames.accuracy(spark, sf), "deactivated", ["prob_v2", "prob_v3"], "recency"))


_ROC = """
SELECT CAST(cutoff AS DOUBLE) AS cutoff, round(tp_v2 / nullif(p, 0), 6) AS tpr_prob_v2, round(tp_v3 / nullif(p, 0), 6) AS tpr_prob_v3,
  round(fp_v2 / nullif(n, 0), 6) AS fpr_prob_v2, round(fp_v3 / nullif(n, 0), 6) AS fpr_prob_v3
FROM (SELECT cutoff, p, n, sum(CASE WHEN deactivated = 1 AND prob_v2 >= cutoff THEN 1 ELSE 0 END) AS tp_v2,
    sum(CASE WHEN deactivated = 1 AND prob_v3 >= cutoff THEN 1 ELSE 0 END) AS tp_v3,
    sum(CASE WHEN deactivated = 0 AND prob_v2 >= cutoff THEN 1 ELSE 0 END) AS fp_v2,
    sum(CASE WHEN deactivated = 0 AND prob_v3 >= cutoff THEN 1 ELSE 0 END) AS fp_v3
  FROM {table} CROSS JOIN (SELECT sum(deactivated) AS p, count(deactivated) - sum(deactivated) AS n FROM {table}) x
  CROSS JOIN (SELECT c / 100.0 AS cutoff FROM range(101) g(c)) y GROUP BY cutoff, p, n)
"""


@query(with_parts(["accuracy"], _ROC.format(table="accuracy")))
def roc_two_models(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.roc_two_models(frames.accuracy(spark, sf), "deactivated", "prob_v2", "prob_v3"))


@query(with_parts(["scores"], _ROC.format(table="scores")))
def roc_cross_join(spark: SparkSession, sf: str) -> DataFrame:
    """Rows against all thresholds, without the product of rows and thresholds."""
    return round_all(evaluate.roc_two_models(frames.scores(spark, sf), "deactivated", "prob_v2", "prob_v3"))


@query(
    with_parts(
        ["accuracy"],
        """
SELECT CAST(sum(deactivated) AS BIGINT) AS deacts_actual, round(sum(prob_v2) / sum(deactivated) - 1, 6) AS over_prob_v2,
  round(sum(prob_v3) / sum(deactivated) - 1, 6) AS over_prob_v3 FROM accuracy
""",
    )
)
def pred_over_actual(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.pred_over_actual(frames.accuracy(spark, sf), "deactivated", ["prob_v2", "prob_v3"]))


@query(
    with_parts(
        ["scores"],
        """
SELECT round(avg(CASE WHEN deactivated = round(prob_v3, 0) THEN 1 ELSE 0 END), 6) AS accuracy_prob_v3,
  round(avg(CASE WHEN deactivated = round(masked_prob, 0) THEN 1 ELSE 0 END), 6) AS accuracy_masked_prob FROM scores
""",
    )
)
def accuracy_pair(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.accuracy(frames.scores(spark, sf), "deactivated", ["prob_v3", "masked_prob"]))


@query(
    with_parts(
        ["scores"],
        """
, c AS (SELECT count(*) FILTER (deactivated = 1 AND d = 1) AS tp, count(*) FILTER (deactivated = 0 AND d = 1) AS fp,
  count(*) FILTER (deactivated = 1 AND d = 0) AS fn, count(*) FILTER (deactivated = 0 AND d = 0) AS tn
  FROM (SELECT deactivated, round(prob_v3, 0) AS d FROM scores))
SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round((tp / (tp + fn) + 1 - fp / (fp + tn)) / 2, 6) AS hard_roc_area,
  round(tp / (tp + fn) * coalesce(tp / nullif(tp + fp, 0), 1) + (1 - tp / (tp + fn)) * (tp + fn) / (tp + fp + fn + tn), 6) AS hard_avg_precision
FROM c
""",
    )
)
def hard_label_areas(spark: SparkSession, sf: str) -> DataFrame:
    return round_all(evaluate.hard_label_areas(frames.scores(spark, sf), "deactivated", "prob_v3"))


@query(
    with_parts(
        ["v2", "v3"],
        """
SELECT round(a.r, 9) AS rate, round(b.r, 9) AS prev_rate, round(abs(a.r / b.r - 1), 9) AS change, CAST(abs(a.r / b.r - 1) < 0.05 AS INTEGER) AS stable
FROM (SELECT sum(prob_deact) / count(consumer_id) AS r FROM v3) a, (SELECT sum(prob_deact) / count(consumer_id) AS r FROM v2) b
""",
    )
)
def drift_gate(spark: SparkSession, sf: str) -> DataFrame:
    row = evaluate.drift(
        spark, frames.predictions_v3(spark, sf), frames.predictions_v2(spark, sf), "prob_deact", "consumer_id", 0.05
    )
    return round_all(row, 9)


@query(
    with_parts(
        ["v2", "v3", "target"],
        f"""
SELECT count(*) AS n, count(c.prob_deact) AS challenged, round(avg({_loss('t.deactivated', 'a.prob_deact')}), 6) AS log_loss_champion,
  round(avg({_loss('t.deactivated', 'c.prob_deact')}), 6) AS log_loss_challenger
FROM v3 a LEFT JOIN v2 c ON a.consumer_id = c.consumer_id JOIN target t ON a.consumer_id = t.consumer_id
""",
    )
)
def champion_challenger(spark: SparkSession, sf: str) -> DataFrame:
    champion = frames.predictions_v3(spark, sf).select("consumer_id", F.col("prob_deact").alias("champion"))
    challenger = frames.predictions_v2(spark, sf).select("consumer_id", F.col("prob_deact").alias("challenger"))
    truth = frames.target(spark, sf).select("consumer_id", "deactivated")
    joined = champion.join(challenger, "consumer_id", "left").join(truth, "consumer_id")
    counts = joined.agg(F.count("*").alias("n"), F.count("challenger").alias("challenged"), *[
        F.avg(loss_of(F.col("deactivated"), F.col(c))).alias(f"log_loss_{c}") for c in ("champion", "challenger")
    ])
    return round_all(counts)


@query(
    """
SELECT l_returnflag, count(*) AS n, round(avg(e * e), 4) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1 - sum(e * e) / sum((y - m) * (y - m)), 6) AS r2
FROM (SELECT l_returnflag, y, y - exp(ln(l_quantity * 2000)) AS e, avg(y) OVER (PARTITION BY l_returnflag) AS m
  FROM (SELECT l_returnflag, l_quantity, l_extendedprice AS y FROM lineitem)) GROUP BY l_returnflag
"""
)
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Errors on the price scale of predictions made on the log scale."""
    from larkspur.sources.star import load

    rows = load(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("y"), F.exp(F.log(F.col("l_quantity") * 2000)).alias("pred")
    )
    out = evaluate.regression_metrics(rows, "y", "pred", ["l_returnflag"])
    return out.withColumn("mse", F.round("mse", 4)).withColumn("rmse", F.round("rmse", 6)).withColumn("r2", F.round("r2", 6))


@query(
    with_parts(
        ["v3", "scores"],
        """
SELECT coalesce(a.consumer_id, b.consumer_id) AS consumer_id, round(a.prob_deact, 6) AS published, round(b.prob_v3, 6) AS fresh
FROM v3 a FULL JOIN scores b ON a.consumer_id = b.consumer_id
""",
    )
)
def compare_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Published against fresh predictions of one model, one row per consumer."""
    old = frames.predictions_v3(spark, sf).select("consumer_id", F.col("prob_deact").alias("p"))
    new = frames.scores(spark, sf).select("consumer_id", F.col("prob_v3").alias("p"))
    both = full_compare(old, new, ["consumer_id"], "_old", "_new")
    return round_all(
        both.select(F.coalesce("consumer_id_old", "consumer_id_new").alias("consumer_id"), F.col("p_old").alias("published"), F.col("p_new").alias("fresh"))
    )
