"""Training, calibration, selection and the daily job on the customer features.

Fitted models have no SQL twin; these results are checked by invariants.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.hashing import split_label
from larkspur.operators import evaluate
from larkspur.plans import customer as cust
from larkspur.plans import funnel, models, passengers, publish
from larkspur.queries import frames
from larkspur.queries.encoding import _houses, fit_houses
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import with_parts
from larkspur.session import materialise, saved, work_path
from larkspur.sources import star
from larkspur.sources.catalog import clustered
from larkspur.sources.star import ORDERS_ASOF, TRAFFIC_ASOF, load

SPLIT = (("train", 40), ("calibrate", 20), ("validate", 40))


def _frame(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled model rows, written once: several models read them."""
    table = cust.transformed(frames.features(spark, sf))
    labelled = models.model_frame(table, frames.target(spark, sf))
    return _laid_out(models.split_frame(labelled, SPLIT))


def _laid_out(df: DataFrame) -> DataFrame:
    """Rows written by consumer, so that the learners' row sampling repeats from run to run, and
    laid anew where they come in more partitions than learners should have."""
    out = materialise(clustered(df, "consumer_id"))
    most = models.learner_partitions(df.sparkSession, out.count())
    return out if out.rdd.getNumPartitions() <= most else materialise(clustered(out, "consumer_id", partitions=most))


def _part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("part") == name).drop("part")


def _gbt(train: DataFrame) -> models.Fitted:
    return models.fit(train, models.gbt())


def _report(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Class metrics per model with its areas under the curves; each row is scored once."""
    scored = saved(scored.select(*keys, models.LABEL, "prob_deact"), "scored")
    metrics = evaluate.class_metrics(scored, models.LABEL, "prob_deact", keys)
    areas = evaluate.trapezoid_areas(evaluate.cutoff_curve(scored, models.LABEL, "prob_deact", keys), keys)
    return metrics.join(areas, keys)


def _named(scored: DataFrame, name: str) -> DataFrame:
    return scored.select("consumer_id", "recency_x", models.LABEL, "prob_deact").withColumn("model", F.lit(name))


@query()
def train_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return boosted(_frame(spark, sf))


def boosted(df: DataFrame) -> DataFrame:
    scored = _gbt(_part(df, "train")).score(_part(df, "validate"))
    return _report(_named(scored, "gradient_boosted_trees"), ["model"])


@query()
def train_rf(spark: SparkSession, sf: str) -> DataFrame:
    return random_forest(_frame(spark, sf))


def random_forest(df: DataFrame) -> DataFrame:
    train = _part(df, "train")
    fitted = models.fit(train, models.forest())
    return _report(_named(fitted.score(_part(df, "validate")), "random_forest"), ["model"])


@query()
def train_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return one_feature(_frame(spark, sf))


def one_feature(df: DataFrame) -> DataFrame:
    train = _part(df, "train")
    fitted = models.fit(train, models.gbt(), numeric=["recency_x"], text=[])
    return _report(_named(fitted.score(_part(df, "validate")), "gbt_1_feature"), ["model"])


@query()
def train_per_segment(spark: SparkSession, sf: str) -> DataFrame:
    df = _frame(spark, sf)
    scored = models.train_per_segment(
        _part(df, "train"), _part(df, "validate"), "is_activation_x", (0.0, 1.0), lambda rows: models.gbt(rows)
    )
    return _report(scored, ["segment"])


@query()
def model_compare(spark: SparkSession, sf: str) -> DataFrame:
    df = _frame(spark, sf)
    train, test = _part(df, "train"), _part(df, "validate")
    fitted = {
        "gradient_boosted_trees": models.fit(train, models.gbt()),
        "random_forest": models.fit(train, models.forest()),
        "gbt_1_feature": models.fit(train, models.gbt(), numeric=["recency_x"], text=[]),
    }
    return models.holdout_report(models.compare_models(test, fitted))


def _calibrated(spark: SparkSession, sf: str, fit) -> DataFrame:
    df = _frame(spark, sf)
    gbt = _gbt(_part(df, "train"))
    calibration = fit(gbt.score(_part(df, "calibrate")))
    return models.calibrate(calibration, gbt.score(_part(df, "validate")))


@query()
def calibrate_isotonic(spark: SparkSession, sf: str) -> DataFrame:
    out = _calibrated(spark, sf, models.fit_isotonic)
    return out.select("consumer_id", models.LABEL, "prob_deact", "prob_deact_cal")


@query()
def calibrate_platt(spark: SparkSession, sf: str) -> DataFrame:
    """Calibrated scores with the curve's slope and intercept."""
    df = _frame(spark, sf)
    gbt = _gbt(_part(df, "train"))
    curve = models.fit_platt(gbt.score(_part(df, "calibrate")))
    slope, intercept = models.platt_coefficients(curve).first()
    out = models.calibrate(curve, gbt.score(_part(df, "validate"))).select("consumer_id", models.LABEL, "prob_deact", "prob_deact_cal")
    return out.withColumns({"slope": F.lit(slope), "intercept": F.lit(intercept)})


@query()
def calibration_study(spark: SparkSession, sf: str) -> DataFrame:
    """Raw, logistic and isotonic probabilities side by side: log loss, accuracy
    and predicted over actual."""
    df = _frame(spark, sf)
    gbt = _gbt(_part(df, "train"))
    base, test = saved(gbt.score(_part(df, "calibrate")).select(models.LABEL, "prob_deact"), "base"), gbt.score(_part(df, "validate"))
    both = models.calibrate(models.fit_isotonic(base), test, out="isotonic")
    both = models.calibrate(models.fit_platt(base), both, out="platt").withColumnRenamed("prob_deact", "raw")
    probs = ["raw", "platt", "isotonic"]
    cells = F.array(*[F.struct(F.lit(p).alias("model"), F.col(p).alias("prob_deact")) for p in probs])
    rows = both.select("consumer_id", models.LABEL, F.explode(cells).alias("c")).select("consumer_id", models.LABEL, "c.*")
    return _report(rows, ["model"])


@query()
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    df = _frame(spark, sf)
    scored = _gbt(_part(df, "train")).score(df.drop("part"))
    return evaluate.mask_probability(scored, "prob_deact", "recency_x", 3).select(
        "consumer_id", "recency_x", "prob_deact", "masked_prob"
    )


@query()
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Encoders and model written to the shared folder as one pipeline and loaded again, where the raw rows
    get the same scores in a new session."""
    df = _frame(spark, sf)
    fitted = _gbt(_part(df, "train"))
    path, rows, scores = (work_path(spark, name) for name in ("model", "validate", "loaded"))
    fitted.pipeline().write().overwrite().save(path)
    test = _part(df, "validate")
    test.write.parquet(rows)
    raw = spark.newSession().read.schema(test.schema).parquet(rows)
    models.load(path).score(raw).select("consumer_id", F.col("prob_deact").alias("loaded")).write.parquet(scores)
    first = fitted.score(test).select("consumer_id", F.col("prob_deact").alias("fitted"))
    return first.join(spark.read.parquet(scores), "consumer_id")


@query()
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Features of a model of all labelled rows, from the least importance up that counts."""
    fitted = models.fit(_frame(spark, sf).drop("part"), models.gbt(rows_per_node=20))
    return models.important(fitted.importances(spark))


@query()
def backward_elimination(spark: SparkSession, sf: str) -> DataFrame:
    """All labelled rows: two parts are fitted on, the third ends the boosting."""
    train = _frame(spark, sf).withColumn(models.HELD_OUT, F.col("part") == "validate").drop("part")
    features = [c for c in train.columns if c.endswith("_x") and not c.endswith("_cat_x")]
    return models.backward_elimination(train, features, (20, 10))[1]


@query()
def grid_forest(spark: SparkSession, sf: str) -> DataFrame:
    df = _frame(spark, sf)
    return models.grid_forest(df.where("part <> 'validate'").drop("part"), _part(df, "validate"))[1]


@query()
def lasso_select(spark: SparkSession, sf: str) -> DataFrame:
    df = _houses(spark, sf)
    fitted = fit_houses(df.where(F.col("part") == "train"))
    features = [*fitted.text, *fitted.numeric, *fitted.years, "lot_frontage_na"]
    train = fitted.transform(df.where(F.col("part") == "train"))
    return models.lasso(train, features, "sale_price")[1]


@query("SELECT p_partkey AS id, 0.0::DOUBLE AS difference FROM part")
def pipeline_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Encoders and price model saved as one pipeline and loaded in a new session, where the raw rows
    get the same prices."""
    df = _houses(spark, sf)
    train = df.where("part = 'train'")
    fitted = fit_houses(train)
    features = [*fitted.text, *fitted.numeric, *fitted.years, "lot_frontage_na"]
    model, _ = models.lasso(fitted.transform(train), features, "sale_price")
    vector = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    made = PipelineModel([*fitted.stages(), vector, model])
    path, scores = work_path(spark, "pipeline"), work_path(spark, "prices")
    made.write().overwrite().save(path)
    other = spark.newSession()
    PipelineModel.load(path).transform(_houses(other, sf)).select("id", F.col("prediction").alias("loaded")).write.parquet(scores)
    both = made.transform(df).select("id", "prediction").join(spark.read.parquet(scores), "id")
    # a label that train never had has no rank, and its rows have no price either way
    alike = F.isnan("loaded") & F.isnan("prediction")
    return both.select("id", F.when(alike, 0.0).otherwise(F.col("loaded") - F.col("prediction")).alias("difference"))


@query()
def train_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Survival model: confusion matrix of the held-out rows, with the accuracy."""
    df = passengers.cleaned(passengers.passengers(load(spark, sf, "customer")))
    df = df.withColumn("part", split_label(F.col("id"), (("train", 80), ("test", 20))))
    train, test = (df.where(F.col("part") == p).drop("part") for p in ("train", "test"))
    apply = passengers.fit_survival(train)
    ready = apply(train)
    # The label is cut from the balance, so the balance-made columns stay out.
    columns = [c for c in ready.columns if c not in ("id", "survived", "fare", "age")]
    v = VectorAssembler(inputCols=columns, outputCol="features")
    model = LogisticRegression(labelCol="survived", tol=0.0005).fit(v.transform(ready))
    scored = model.transform(v.transform(apply(test))).withColumn("p", F.col("prediction"))
    right = scored.agg(F.avg(F.when(F.col("survived") == F.col("p"), 1.0).otherwise(0.0))).first()[0]
    return evaluate.confusion_matrix(scored, "survived", "p").withColumn("accuracy", F.lit(right).cast("double"))


@query(
    with_parts(
        ["shoppers"],
        """
, w AS (SELECT sum(marketing_cost) / 1e6 AS x, sum(revenue) / 1e6 AS y FROM shoppers GROUP BY week_number),
c AS (SELECT x, x * x AS z, y, avg(x) OVER () AS mx, avg(x * x) OVER () AS mz, avg(y) OVER () AS my FROM w),
s AS (SELECT count(*) AS n, any_value(mx) AS mx, any_value(mz) AS mz, any_value(my) AS my, sum((x - mx) * (x - mx)) AS xx, sum((z - mz) * (z - mz)) AS zz,
  sum((x - mx) * (z - mz)) AS xz, sum((x - mx) * (y - my)) AS xy, sum((z - mz) * (y - my)) AS zy, sum((y - my) * (y - my)) AS yy FROM c),
b AS (SELECT *, xx * zz - xz * xz AS d, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b2 FROM s),
e AS (SELECT *, (yy - b1 * xy - b2 * zy) / (n - 3) AS s2, 1 - (yy - b1 * xy - b2 * zy) / yy AS r2, my - b1 * mx - b2 * mz AS b0 FROM b)
SELECT 'x' AS term, round(b1, 4) AS coef, round(sqrt(s2 * zz / d), 4) AS std_err, round(b1 / sqrt(s2 * zz / d), 4) AS t, round(r2, 6) AS r2 FROM e
UNION ALL SELECT 'x2', round(b2, 4), round(sqrt(s2 * xx / d), 4), round(b2 / sqrt(s2 * xx / d), 4), round(r2, 6) FROM e
UNION ALL SELECT 'intercept', round(b0, 4), round(sqrt(s2 * (1.0 / n + (mx * mx * zz - 2 * mx * mz * xz + mz * mz * xx) / d)), 4),
  round(b0 / sqrt(s2 * (1.0 / n + (mx * mx * zz - 2 * mx * mz * xz + mz * mz * xx) / d)), 4), round(r2, 6) FROM e
""",
    )
)
def poly_regression(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly revenue on marketing cost and its square, in millions."""
    weeks = funnel.weekly(star.funnel(spark, sf))
    rows = weeks.select((F.col("marketing_cost") / 1e6).alias("cost"), (F.col("revenue") / 1e6).alias("revenue"))
    out = models.quadratic_fit(rows, "cost", "revenue").drop("p")
    return out.select("term", *[F.round(c, 4).alias(c) for c in ("coef", "std_err", "t")], F.round("r2", 6).alias("r2"))


def _day_rows(day: str) -> str:
    """Scores of a day by SQL: masked near a year without order."""
    rec = f"date_diff('day', max(order_date), DATE '{day}')"
    return f"""SELECT consumer_id, {rec} AS recency, ({rec} + 1) / ({rec} + 121.0) AS p, if({rec} >= 362, 1.0::DOUBLE, ({rec} + 1) / ({rec} + 121.0)) AS masked
  FROM ords WHERE order_date <= DATE '{day}' AND action IN ('F', 'P') GROUP BY consumer_id HAVING {rec} <= 365"""


_DAYS = (frames.day_after(ORDERS_ASOF, -1), ORDERS_ASOF)


@query(
    with_parts(
        ["ords"],
        f"""
, a AS ({_day_rows(_DAYS[0])}), b AS ({_day_rows(_DAYS[1])}),
d AS (SELECT '{_DAYS[0]}' AS record_date, * FROM a UNION ALL SELECT '{_DAYS[1]}', * FROM b),
t AS (SELECT record_date, sum(CAST(trunc(round(s, 9)) AS BIGINT)) AS expected FROM (SELECT record_date, recency, sum(p) AS s FROM d GROUP BY ALL) GROUP BY 1),
m AS (SELECT record_date, count(*) AS consumers, avg(masked) AS rate FROM d GROUP BY 1)
SELECT record_date, consumers, CAST(expected AS BIGINT) AS expected, round(rate, 9) AS rate,
  round(lag(rate) OVER (ORDER BY record_date), 9) AS prev_rate, round(abs(rate / lag(rate) OVER (ORDER BY record_date) - 1), 9) AS change
FROM m JOIN t USING (record_date)
""",
    )
)
def daily_fixed_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job with a score that SQL can state: two days written, audited, and published."""
    name = f"fixed_{uuid.uuid4().hex[:8]}"
    job, gates = publish.DailyJob(spark, f"{name}_predictions", f"{name}_totals"), []
    for day in _DAYS:
        rows = frames.predictions(spark, sf, ("F", "P"), frames.prob_v3, day).withColumnRenamed("recency", "recency_x")
        gates.append(job.run(rows, day, first=day == _DAYS[0]).withColumn("record_date", F.lit(day)))
    live = spark.table(job.predictions).groupBy("record_date").agg(F.count("*").alias("consumers"))
    expected = spark.table(job.totals).groupBy("record_date").agg(F.sum("total_deacts").alias("expected"))
    gate = frames.round_all(gates[0].unionByName(gates[1]), 9).select("record_date", "rate", "prev_rate", "change")
    return live.join(expected, "record_date").join(gate, "record_date")


@query()
def daily_publish(spark: SparkSession, sf: str) -> DataFrame:
    """One model is fitted and calibrated and scores two days in turn. Each is published
    if it passes the audit and has not drifted from the day before; else the job raises."""
    df = _frame(spark, sf)
    gbt = _gbt(_part(df, "train"))
    calibration = models.fit_isotonic(gbt.score(_part(df, "calibrate")))
    name = f"daily_{uuid.uuid4().hex[:8]}"
    job = publish.DailyJob(spark, f"{name}_predictions", f"{name}_totals")
    gate = None
    for day in _DAYS:
        back = (dt.date.fromisoformat(ORDERS_ASOF) - dt.date.fromisoformat(day)).days
        rows = models.model_frame(cust.transformed(frames.features(spark, sf, day, frames.day_after(TRAFFIC_ASOF, -back))))
        scored = saved(models.calibrate(calibration, gbt.score(rows)).select("consumer_id", "recency_x", "prob_deact_cal"), "scored")
        gate = job.run(scored, day, prob="prob_deact_cal", first=day == _DAYS[0])
    counts = spark.table(job.predictions).groupBy("record_date").agg(F.count("*").alias("consumers"), F.avg("prob_deact").alias("mean_prob"))
    current = gate.select(F.lit(ORDERS_ASOF).alias("record_date"), "rate", "prev_rate", "change", "stable")
    return counts.join(current, "record_date", "left")
