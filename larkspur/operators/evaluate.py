"""Evaluation of scored rows. Each report is one pass over the scores; what the
reports then sort or cumulate has at most 101 rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.functions.dates import days_until_bucket
from larkspur.functions.numeric import hard_class, log_loss, ratio, ratio_or

CUTOFFS = 100
YEAR = 365


def mask_probability(df: DataFrame, prob: str, recency: str, days: int, out: str = "masked_prob") -> DataFrame:
    """Consumers who reach a year of inactivity within ``days`` get probability 1."""
    return df.withColumn(out, F.when(F.col(recency) >= YEAR - days, F.lit(1.0)).otherwise(F.col(prob)))


def confusion_matrix(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Actual class by predicted class with a total row and a total column."""
    pred, actual = hard_class(F.col(prob)), F.col(label)
    hit = lambda c: F.sum(F.when(pred == c, 1).otherwise(0))
    return (
        df.where(actual.isin(0, 1) & pred.isin(0, 1))
        .rollup(actual.alias("actual"))
        .agg(hit(0).alias("predicted_0"), hit(1).alias("predicted_1"), F.count("*").alias("total"))
        .select(
            F.when(F.col("actual").isNull(), "total").otherwise(F.concat(F.lit("actual_"), "actual")).alias("actual"),
            "predicted_0",
            "predicted_1",
            "total",
        )
    )


def class_metrics(df: DataFrame, label: str, prob: str, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1, mean log loss and predicted over actual per class,
    and their mean weighted by class size; 0 where a ratio has no denominator."""
    pred, actual, p = hard_class(F.col(prob)), F.col(label), F.col(prob)
    cell = lambda a, b: F.sum(F.when((actual == a) & (pred == b), 1).otherwise(0))
    one = df.groupBy(*keys).agg(
        *[cell(a, b).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)],
        *[F.avg(F.when(actual == c, log_loss(actual, p))).alias(f"loss{c}") for c in (0, 1)],
    )

    def of_class(c: int) -> Column:
        size = F.col(f"n{c}0") + F.col(f"n{c}1")
        said = F.col(f"n0{c}") + F.col(f"n1{c}")
        precision, recall = ratio_or(F.col(f"n{c}{c}"), said, 0), ratio_or(F.col(f"n{c}{c}"), size, 0)
        return F.struct(
            F.lit(str(c)).alias("class"),
            size.alias("n"),
            precision.alias("precision"),
            recall.alias("recall"),
            ratio_or(2 * precision * recall, precision + recall, 0).alias("f1"),
            F.col(f"loss{c}").alias("avg_log_loss"),
            ratio_or(said, size, 0).alias("pred_over_actual"),
        )

    both = one.select(*keys, of_class(0).alias("a"), of_class(1).alias("b"))
    names = ("precision", "recall", "f1", "avg_log_loss", "pred_over_actual")
    size = F.col("a.n") + F.col("b.n")
    mean = F.struct(
        F.lit("weighted").alias("class"),
        size.alias("n"),
        *[ratio(F.col(f"a.{m}") * F.col("a.n") + F.col(f"b.{m}") * F.col("b.n"), size).alias(m) for m in names],
    )
    return both.select(*keys, F.explode(F.array("a", "b", mean)).alias("m")).select(*keys, "m.*")


def calibration_table(df: DataFrame, label: str, prob: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, F.round(prob, 2).alias("prob_bucket")).agg(F.avg(label).alias("pct_deactivated"))


def cutoff_bucket(prob: Column) -> Column:
    """Highest cutoff c of 0..100 with prob >= c / 100. The product may miss a
    step by one float, so it is checked against the cutoffs beside it. A score above 1
    reaches all cutoffs; a null, NaN or negative one reaches none."""
    b = F.floor(prob * CUTOFFS)
    none = prob.isNull() | F.isnan(prob) | (prob < 0)
    return (
        F.when(none, F.lit(None))
        .when(prob >= 1, CUTOFFS)
        .when(prob >= (b + 1) / F.lit(float(CUTOFFS)), b + 1)
        .when(prob < b / F.lit(float(CUTOFFS)), b - 1)
        .otherwise(b)
        .cast("int")
    )


def _points(df: DataFrame, label: str, probs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, score, p, n, points): the (cutoff, tp, fp) of all 101 cutoffs in one row per score column.

    Rows are counted per highest cutoff they reach. That leaves at most 102 counts, from which every
    cutoff's sum is taken at once, instead of one count per cutoff, a cross join of rows and cutoffs, or a window.
    """
    cells = F.array(*[F.struct(F.lit(m).alias("score"), F.col(m).alias("prob")) for m in probs])
    group = [*keys, "score"]
    per_bucket = (
        df.select(*keys, F.col(label).alias("y"), F.explode(cells).alias("c"))
        .select(*keys, "y", "c.*")
        .groupBy(*group, cutoff_bucket(F.col("prob")).alias("cutoff"))
        .agg(
            F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("pos"),
            F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).alias("neg"),
        )
    )
    # A null score reaches no cutoff but still counts in the class totals.
    counts = F.collect_list(F.struct(F.coalesce("cutoff", F.lit(-1)).alias("c"), "pos", "neg"))
    total = per_bucket.groupBy(*group).agg(counts.alias("m"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    zero = F.lit(0).cast("long")
    reached = lambda c, of: F.aggregate("m", zero, lambda s, e: s + F.when(e["c"] >= c, e[of]).otherwise(zero))
    point = lambda c: F.struct(c.alias("cutoff"), reached(c, "pos").alias("tp"), reached(c, "neg").alias("fp"))
    return total.select(*group, "p", "n", F.transform(F.sequence(F.lit(0), F.lit(CUTOFFS)), point).alias("points"))


def cutoff_counts(df: DataFrame, label: str, probs: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, score, cutoff, tp, fp, p, n) for all 101 cutoffs of each score column."""
    out = _points(df, label, probs, keys).withColumn("c", F.explode("points"))
    return out.select(*keys, "score", "c.cutoff", "c.tp", "c.fp", "p", "n")


def cutoff_curve(df: DataFrame, label: str, prob: str, keys: Sequence[str] = ()) -> DataFrame:
    """Points of the precision-recall and ROC curves; of cutoffs with equal
    counts the lowest stays. Precision is 1 when nothing is predicted.

    Counts never rise with the cutoff, so equal ones are neighbours: a point stays
    when the next lower cutoff has other counts.
    """
    lower = lambda i: F.get(F.col("points"), i - 1)
    new = lambda x, i: (i == 0) | (lower(i)["tp"] != x["tp"]) | (lower(i)["fp"] != x["fp"])
    out = _points(df, label, [prob], keys).withColumn("c", F.explode(F.filter("points", new)))
    tp, fp = F.col("c.tp"), F.col("c.fp")
    return out.select(
        *keys,
        (F.col("c.cutoff") / F.lit(float(CUTOFFS))).alias("cutoff"),
        tp.alias("tp"),
        fp.alias("fp"),
        ratio(tp, F.col("p")).alias("tpr"),
        ratio(fp, F.col("n")).alias("fpr"),
        ratio_or(tp, tp + fp, 1).alias("precision"),
    )


def trapezoid_areas(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the precision-recall and the ROC curve by trapezoids between
    neighbouring cutoffs. The piece beyond the last cutoff is not added."""
    w = Window.partitionBy(*(keys or [F.lit(1)])).orderBy("cutoff")
    prev = lambda c: F.lag(c).over(w)
    steps = curve.select(
        *keys,
        ((prev("tpr") - F.col("tpr")) * (prev("precision") + F.col("precision")) / 2).alias("pr"),
        ((prev("fpr") - F.col("fpr")) * (prev("tpr") + F.col("tpr")) / 2).alias("roc"),
    )
    return steps.groupBy(*keys).agg(
        F.coalesce(F.sum("pr"), F.lit(0.0)).alias("area_under_pr"),
        F.coalesce(F.sum("roc"), F.lit(0.0)).alias("area_under_roc"),
    )


def whole_sum(prob: Column) -> Column:
    """Sum cut to a whole number. Float noise is rounded off first: without that
    a sum of exactly 18 could come out as 17, depending on the order of addition."""
    return F.round(F.sum(prob), 9).cast("int")


def hard_label_areas(df: DataFrame, label: str, prob: str, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, ROC area and average precision of the 0/1 decision itself. A hard
    label has one cutoff between its two values, so both areas follow from the
    four counts."""
    y, d = F.col(label), hard_class(F.col(prob))
    n = lambda a, b: F.sum(F.when((y == a) & (d == b), 1).otherwise(0))
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    tpr, fpr = ratio(tp, tp + fn), ratio(fp, fp + tn)
    return (
        df.groupBy(*keys)
        .agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn"))
        .select(
            *keys,
            ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
            ((tpr + 1 - fpr) / 2).alias("hard_roc_area"),
            (tpr * ratio_or(tp, tp + fp, 1) + (1 - tpr) * ratio(tp + fn, tp + fp + fn + tn)).alias("hard_avg_precision"),
        )
    )


def recency_aggregation(df: DataFrame, label: str, prob: str, recency: str, key: str) -> DataFrame:
    """Eleven measures per days until deactivation."""
    y, p, r = F.col(label), F.col(prob), F.col(recency)
    return (
        df.where((r >= 0) & (r <= YEAR))
        .groupBy((F.lit(YEAR) - r).cast("int").alias("days_until_deact"))
        .agg(
            F.count(key).alias("count_users"),
            F.sum(y).cast("long").alias("deacts_actual"),
            whole_sum(p).alias("deacts_pred"),
            F.avg(log_loss(y, p)).alias("avg_log_loss"),
            F.avg(p).alias("avg_prob_deact"),
            F.avg((y == hard_class(p)).cast("int")).alias("accuracy"),
        )
        .withColumn("pct_deact_actual", ratio(F.col("deacts_actual"), F.col("count_users")))
        .withColumn("pct_deact_pred", ratio(F.col("deacts_pred"), F.col("count_users")))
        .withColumn("pred_over_actual_deacts", ratio(F.col("deacts_pred"), F.col("deacts_actual")))
        .withColumn("diff_pct_deact", F.col("pct_deact_pred") - F.col("pct_deact_actual"))
    )


def total_deacts(df: DataFrame, prob: str, recency: str, asof: str) -> DataFrame:
    """Expected deactivations per future day, cut to whole numbers."""
    r = F.col(recency)
    return (
        df.where((r >= 0) & (r <= YEAR))
        .groupBy(F.date_add(F.lit(asof).cast("date"), (F.lit(YEAR) - r).cast("int")).alias("deact_date"))
        .agg(whole_sum(F.col(prob)).alias("total_deacts"))
    )


def losses(df: DataFrame, label: str, probs: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean log loss of several models side by side."""
    return df.groupBy(*keys).agg(*[F.avg(log_loss(F.col(label), F.col(p))).alias(f"log_loss_{p}") for p in probs])


def result_check(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Rows and mean log loss per prediction and outcome; unknown outcomes stay."""
    y, p = F.col(label), F.col(prob)
    return df.groupBy(hard_class(p).alias("prediction"), y.alias("deactivated")).agg(
        F.count("*").alias("cnt"), F.avg(log_loss(y, p)).alias("avg_log_loss")
    )


def loss_by_bucket(df: DataFrame, label: str, probs: Sequence[str], recency: str) -> DataFrame:
    """Totals, log loss and predicted over actual - 1 per days-until class."""
    y = F.col(label)
    bucket = days_until_bucket(F.lit(YEAR) - F.col(recency))
    out = (
        df.where(F.col(recency).between(0, YEAR - 1))
        .groupBy(bucket.alias("days_until_deact"))
        .agg(
            F.sum(y).cast("long").alias("deacts_actual"),
            *[F.sum(p).alias(f"deacts_{p}") for p in probs],
            *[F.avg(log_loss(y, F.col(p))).alias(f"log_loss_{p}") for p in probs],
        )
    )
    return out.withColumns({f"over_{p}": ratio(F.col(f"deacts_{p}"), F.col("deacts_actual")) - 1 for p in probs})


def loss_by_recency(df: DataFrame, label: str, probs: Sequence[str], recency: str) -> DataFrame:
    y = F.col(label)
    return df.groupBy(recency).agg(
        F.avg(y).alias("pct_deact_actual"),
        *[F.avg(p).alias(f"avg_{p}") for p in probs],
        *[F.avg(log_loss(y, F.col(p))).alias(f"log_loss_{p}") for p in probs],
    )


def pred_over_actual(df: DataFrame, label: str, probs: Sequence[str]) -> DataFrame:
    total = F.sum(label)
    return df.agg(
        total.cast("long").alias("deacts_actual"), *[(F.try_divide(F.sum(p), total) - 1).alias(f"over_{p}") for p in probs]
    )


def accuracy(df: DataFrame, label: str, probs: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.avg((F.col(label) == hard_class(F.col(p))).cast("int")).alias(f"accuracy_{p}") for p in probs]
    )


def roc_two_models(df: DataFrame, label: str, first: str, second: str) -> DataFrame:
    """True and false positive rates of two models at each of the 101 cutoffs."""
    c = cutoff_counts(df, label, [first, second])
    pick = lambda m, x: F.max(F.when(F.col("score") == m, F.try_divide(F.col(x[0]), F.col(x[1]))))
    return c.groupBy((F.col("cutoff") / F.lit(float(CUTOFFS))).alias("cutoff")).agg(
        pick(first, ("tp", "p")).alias(f"tpr_{first}"),
        pick(second, ("tp", "p")).alias(f"tpr_{second}"),
        pick(first, ("fp", "n")).alias(f"fpr_{first}"),
        pick(second, ("fp", "n")).alias(f"fpr_{second}"),
    )


def model_errors(both: DataFrame, a: str, b: str) -> DataFrame:
    """Signed, absolute and squared difference of two models' probabilities."""
    err = F.col(a) - F.col(b)
    return both.withColumn("err", err).withColumn("abs_err", F.abs(err)).withColumn("sq_err", err * err)


class DriftError(ValueError):
    """The mean prediction moved more than allowed since the day before."""


def mean_rate(df: DataFrame, prob: str, key: str) -> Column:
    return df.agg(F.try_divide(F.sum(prob), F.count(key))).scalar()


def drift(spark: SparkSession, today: DataFrame, before: DataFrame, prob: str, key: str, max_change: float) -> DataFrame:
    """One row: both mean predictions, their relative change, and the verdict."""
    return (
        spark.range(1)
        .select(mean_rate(today, prob, key).alias("rate"), mean_rate(before, prob, key).alias("prev_rate"))
        .withColumn("change", F.abs(F.try_divide(F.col("rate"), F.col("prev_rate")) - 1))
        .withColumn("stable", (F.col("change") < max_change).cast("int"))
    )


def require_stable(drift_row: DataFrame, max_change: float) -> float:
    """Raise when the gate fails. The frame has one row."""
    row = drift_row.first()
    if row["change"] is None or not row["change"] < max_change:
        raise DriftError(f"mean prediction changed by {row['change']}, allowed below {max_change}")
    return row["change"]


def regression_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """mse, rmse and r2; the variance pass is the same single aggregate."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"), F.avg(e * e).alias("mse"), F.var_pop(y).alias("__var"))
        .select(
            *keys,
            "n",
            "mse",
            F.sqrt("mse").alias("rmse"),
            (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("__var"))).alias("r2"),
        )
    )
