"""The stream equals the batch, over several arrivals and after a replay."""

from pyspark.sql import functions as F

from larkspur.sources.star import load
from larkspur.streaming import daily


def rows(df):
    return sorted((str(r["day"]), r["user_id"], r["events"], r["deal_views"], str(r["last_seen"])) for r in df.collect())


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = load(spark, sf_dir, "events")
    landing, log, state, days = (str(tmp_path / n) for n in ("in", "log", "state", "days"))
    early = F.col("ts") < F.lit("2024-01-12 13:00:00").cast("timestamp_ntz")
    events.where(early).repartition(3).write.parquet(landing)
    run = lambda: daily.run_daily(daily.event_stream(spark, landing, files_per_batch=1), log, state, late="40 days")
    run()
    assert rows(daily.current_counts(spark, log)) == rows(daily.daily_counts(events.where(early)))
    events.where(~early).repartition(2).write.mode("append").parquet(landing)
    run()
    run()  # nothing new arrived
    want = rows(daily.daily_counts(events))
    assert rows(daily.current_counts(spark, log)) == want
    for _ in range(2):
        daily.publish_days(spark, log, days)
    published = spark.read.parquet(days).withColumnRenamed("record_date", "day")
    assert rows(published) == want


def test_replayed_batch_is_not_counted_twice(spark, sf_dir, tmp_path):
    log = str(tmp_path / "log")
    counts = daily.daily_counts(load(spark, sf_dir, "events"))
    for _ in range(2):
        counts.withColumn("batch", F.lit(0)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(log)
    assert rows(daily.current_counts(spark, log)) == rows(counts)


def test_events_forty_days_late_are_counted(spark, sf_dir, tmp_path):
    """The newest events come first and the oldest last, under an allowance of two days; nothing is lost, only
    touched days are published again, and a run from the same checkpoint changes nothing."""
    events = load(spark, sf_dir, "events")
    landing, log, state, days = (str(tmp_path / n) for n in ("in", "log", "state", "days"))
    run = lambda: daily.run_daily(daily.event_stream(spark, landing), log, state, late="2 days")
    last = F.lit(events.agg(F.max("ts")).first()[0])
    age = F.datediff(last, "ts")
    events.where(age < 5).coalesce(1).write.parquet(landing)
    run()
    first = set(daily.publish_days(spark, log, days))
    middle = events.where((age >= 5) & (age < 20)).withColumn("ts", F.col("ts") - F.expr("INTERVAL 40 DAYS"))
    for late in (middle, events.where(age >= 20)):
        late.coalesce(1).write.mode("append").parquet(landing)
        run()
        run()
    arrived = spark.read.parquet(landing)
    assert arrived.select(F.datediff(last, F.min("ts"))).first()[0] >= 40
    want = rows(daily.daily_counts(arrived))
    assert rows(daily.current_counts(spark, log)) == want
    told = {r["batch"]: (r["events"], r["late_events"]) for r in daily.late_events(spark, log).collect()}
    assert [told[b][0] == told[b][1] for b in sorted(told)] == [False, True, True] and told[0][1] == 0
    again = daily.publish_days(spark, log, days)
    assert not set(again) & first and again
    published = spark.read.parquet(days)
    assert rows(published.withColumnRenamed("record_date", "day")) == want
    assert daily.publish_days(spark, log, days) == []
    assert {r["version"] for r in published.where(F.col("record_date").isin(*first)).collect()} == {0}


def test_a_batch_that_died_after_its_log_is_replayed(spark, sf_dir, tmp_path):
    """The same batch is handed over again by a new query, as after a failure before the commit."""
    events = load(spark, sf_dir, "events")
    landing, log = str(tmp_path / "in"), str(tmp_path / "log")
    events.repartition(2).write.parquet(landing)
    for attempt in ("a", "b"):  # a new checkpoint starts at batch 0 again
        daily.run_daily(daily.event_stream(spark, landing), log, str(tmp_path / attempt))
    assert rows(daily.current_counts(spark, log)) == rows(daily.daily_counts(events))
