"""Daily job: score, mask, publish one partition, totals, drift gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import evaluate
from larkspur.session import work_path
from larkspur.sources import catalog
from larkspur.sources.catalog import scan_partition, write_snapshot

MAX_CHANGE = 0.05


class AuditError(RuntimeError):
    """A staged day is not fit to be published."""


def publish_predictions(scored: DataFrame, path: str, asof: str, prob: str, extra: tuple[str, ...] = ()) -> None:
    """One row per consumer under the day's partition; other days stay."""
    out = scored.select(
        "consumer_id",
        F.col("recency_x").cast("int").alias("recency_x"),
        F.col(prob).alias("prob_deact"),
        *extra,
        F.lit(asof).alias("record_date"),
    )
    write_snapshot(out, path, sort_by=["consumer_id"])


def publish_totals(scored: DataFrame, path: str, asof: str, prob: str) -> None:
    totals = evaluate.total_deacts(scored, prob, "recency_x", asof)
    write_snapshot(
        totals.select(F.col("deact_date").cast("string").alias("deact_date"), "total_deacts", F.lit(asof).alias("record_date")),
        path,
    )


def publish_forecast(totals: DataFrame, load_date: str) -> DataFrame:
    """Rows from yesterday on, stamped with the load date and sorted by day."""
    since = F.date_sub(F.lit(load_date).cast("date"), 1)
    return (
        totals.where(F.col("deact_date") >= since).withColumn("ds", F.lit(load_date)).sortWithinPartitions("deact_date")
    )


def drift_against_previous(spark: SparkSession, path: str, asof: str, max_change: float = MAX_CHANGE) -> DataFrame:
    """Gate row for a published day and the day before."""
    previous = str(dt.date.fromisoformat(asof) - dt.timedelta(days=1))
    table = spark.read.orc(path)
    return evaluate.drift(
        spark, scan_partition(table, asof), scan_partition(table, previous), "prob_deact", "consumer_id", max_change
    )


def daily_publish(scored: DataFrame, path: str, totals_path: str, asof: str, mask_days: int = 3, prob: str = "prob_deact") -> DataFrame:
    """Publish a day and return its gate row; raising is up to the caller, who may
    have no previous day yet. Totals use the unmasked probability."""
    spark = scored.sparkSession
    masked = evaluate.mask_probability(scored, prob, "recency_x", mask_days)
    publish_predictions(masked, path, asof, "masked_prob")
    publish_totals(scored, totals_path, asof, prob)
    return drift_against_previous(spark, path, asof)


PREDICTIONS = "consumer_id BIGINT, recency_x INT, prob_deact DOUBLE"
TOTALS = "deact_date STRING, total_deacts BIGINT"


class DailyJob:
    """Write, audit, publish: a day is written aside, checked, and only then shown.

    Both tables are external and partitioned by day. A run writes its predictions and totals to
    folders of their own and compares them with the day before as readers see it. If a check fails it raises,
    and whoever reads the tables still sees what was there. If all hold, the day's partitions are pointed at the new
    folders, totals first, so that a day whose predictions are live has its totals. A run that dies
    before that leaves nothing visible, and running a day again replaces it.
    """

    def __init__(self, spark: SparkSession, predictions: str, totals: str, path: str | None = None):
        self.spark, self.predictions, self.totals = spark, predictions, totals
        self.path = path or work_path(spark, predictions)
        catalog.create_partitioned(spark, predictions, PREDICTIONS, f"{self.path}/predictions")
        catalog.create_partitioned(spark, totals, TOTALS, f"{self.path}/totals")

    def _staged(self, rows: DataFrame, columns: str) -> tuple[str, DataFrame]:
        where = work_path(self.spark, "staged")
        rows.write.option("compression", "snappy").orc(where)
        return where, self.spark.read.schema(columns).orc(where)

    def audit(self, staged: DataFrame) -> None:
        """One pass: rows there, one per consumer, probabilities present and from 0 to 1."""
        p = F.col("prob_deact")
        row = staged.groupBy("consumer_id").agg(F.count("*").alias("n"), F.sum(F.when(p.between(0, 1) & ~F.isnan(p), 0).otherwise(1)).alias("bad"))
        row = row.agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("twice")).first()
        if not row["n"] or row["bad"] or row["twice"]:
            raise AuditError(f"{row['n']} consumers, {row['bad']} without a probability, {row['twice']} more than once")

    def run(
        self, scored: DataFrame, asof: str, mask_days: int = 3, prob: str = "prob_deact", max_change: float = MAX_CHANGE, first: bool = False
    ) -> DataFrame:
        """Publish a day's scores (consumer_id, recency_x, ``prob``) and return the gate's row. The first day of a table
        has no day before to compare with, which has to be said by ``first``. Totals use the unmasked probability."""
        masked = evaluate.mask_probability(scored, prob, "recency_x", mask_days)
        rows = masked.select("consumer_id", F.col("recency_x").cast("int").alias("recency_x"), F.col("masked_prob").alias("prob_deact"))
        where, staged = self._staged(rows, PREDICTIONS)
        self.audit(staged)
        before = str(dt.date.fromisoformat(asof) - dt.timedelta(days=1))
        live = catalog.partitions(self.spark, self.predictions)
        if before not in live and not (first and not live):
            raise catalog.MissingPartition(f"{self.predictions} has no {before} to compare {asof} with")
        yesterday = scan_partition(self.spark.table(self.predictions), before)
        gate = evaluate.drift(self.spark, staged, yesterday, "prob_deact", "consumer_id", max_change)
        if before in live:
            evaluate.require_stable(gate, max_change)
        totals = evaluate.total_deacts(scored, prob, "recency_x", asof)
        totals = totals.select(F.col("deact_date").cast("string").alias("deact_date"), F.col("total_deacts").cast("long").alias("total_deacts"))
        catalog.swap_partition(self.spark, self.totals, asof, self._staged(totals, TOTALS)[0])
        catalog.swap_partition(self.spark, self.predictions, asof, where)
        return gate
