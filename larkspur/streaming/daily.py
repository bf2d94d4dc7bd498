"""Daily engagement counts from newly arrived event files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.session import saved

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _counts():
    return [
        F.count("*").alias("events"),
        F.sum(F.when(F.col("event_type") == "view", 1).otherwise(0)).alias("deal_views"),
        F.max("ts").cast("timestamp_ntz").alias("last_seen"),
    ]


def daily_counts(events: DataFrame) -> DataFrame:
    """Batch form: one row per user and day."""
    return events.groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(*_counts())


def event_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """New event files below a folder, with a stated schema."""
    reader = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


LEDGER = "-ledger"


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """What each batch brought: its last event day, rows, late rows and the days it changed."""
    columns = "max_day date, events long, late_events long, days array<date>, batch int"
    try:
        return spark.read.schema(columns).parquet(path)
    except AnalysisException:  # nothing has been written yet
        return spark.createDataFrame([], columns)


def _replace(rows: DataFrame, path: str, *by: str) -> None:
    """Overwrites the partitions that the rows are in, so a replayed batch is not counted twice."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def run_daily(events: DataFrame, log_path: str, checkpoint: str, late: str = "2 days") -> None:
    """Process what has arrived and stop.

    A micro-batch is reduced to counts per user and day and added to a log of such counts, in
    folders of its event day and batch number. Counts add up, so no state is kept between batches and no event
    is too late to be counted: one that lies more than ``late`` before the last day that earlier batches saw goes to
    the part ``late=true`` of the log, and the ledger beside the log tells how many there were. A replay finds the
    same earlier batches in the ledger and overwrites the same folders.
    """
    ledger = f"{log_path}{LEDGER}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _ledger(spark, ledger).where(F.col("batch") < batch_id).agg(F.max("max_day")).first()[0]
        closed = F.lit(False) if seen is None else F.col("day") < F.lit(seen) - F.expr(f"INTERVAL {late}")
        counts = saved(daily_counts(batch).select("*", closed.alias("late"), F.lit(batch_id).alias("batch")), "batch")
        told = counts.groupBy("batch").agg(
            F.max("day").alias("max_day"),
            F.sum("events").alias("events"),
            F.sum(F.when(F.col("late"), F.col("events")).otherwise(0)).alias("late_events"),
            F.sort_array(F.collect_set("day")).alias("days"),  # calendar days
        )
        _replace(counts, log_path, "late", "day", "batch")
        _replace(told, ledger, "batch")

    query = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _merged(log: DataFrame) -> DataFrame:
    return log.groupBy("day", "user_id").agg(
        F.sum("events").alias("events"), F.sum("deal_views").alias("deal_views"), F.max("last_seen").alias("last_seen")
    )


def current_counts(spark: SparkSession, log_path: str) -> DataFrame:
    """Counts per user and day over all batches, late events included."""
    return _merged(spark.read.parquet(log_path))


def late_events(spark: SparkSession, log_path: str) -> DataFrame:
    """(batch, events, late_events) of every batch."""
    return _ledger(spark, f"{log_path}{LEDGER}").select("batch", "events", "late_events")


def publish_days(spark: SparkSession, log_path: str, path: str) -> list[str]:
    """One partition per day, with the last batch in it as ``version``; returns the days written.

    Only days that a batch changed since the last publication are merged again, each from all its
    counts in the log, so a run that died can be repeated. Which batches are in is kept in a ledger
    below ``path``, written last. A second run finds nothing to do.
    """
    applied = f"{path}/_ledger"
    batches = _ledger(spark, f"{log_path}{LEDGER}")
    try:
        batches = batches.join(spark.read.schema("batch int").parquet(applied), "batch", "left_anti")
    except AnalysisException:  # first publication
        pass
    fresh = batches.select("batch", "days").collect()  # a row per new batch
    days = sorted({d for r in fresh for d in r["days"]})
    if not days:
        return []
    log = spark.read.parquet(log_path).where(F.col("day").isin(days))
    version = log.groupBy("day").agg(F.max("batch").alias("version"))
    rows = _merged(log).join(F.broadcast(version), "day").withColumn("record_date", F.col("day").cast("string"))  # a row per day
    _replace(rows.drop("day"), path, "record_date")
    spark.createDataFrame([(r["batch"],) for r in fresh], "batch int").write.mode("append").parquet(applied)
    return [str(d) for d in days]
