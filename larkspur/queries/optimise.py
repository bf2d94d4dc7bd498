"""Many-instance optimisation and the incremental daily job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import hashing
from larkspur.plans import dispatch as plan
from larkspur.plans import knapsack
from larkspur.queries.registry import query
from larkspur.session import work_path
from larkspur.sources import files
from larkspur.sources.star import load
from larkspur.streaming import daily

CAPACITY = 50


def _items(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as knapsack items: weight is the quantity, value the price in
    cents, the order is line number, part, supplier (then price and quantity)."""
    li = load(spark, sf, "lineitem")
    value = F.round(F.col("l_extendedprice") * 100).cast("long")
    weight = F.col("l_quantity").cast("long")
    return li.select(
        F.col("l_orderkey").alias("instance"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", value.alias("v"), weight.alias("w")).alias("item"),
        value.alias("value"),
        weight.alias("weight"),
        F.lit(CAPACITY).cast("long").alias("capacity"),
    )


@query(
    f"""
WITH RECURSIVE it AS (SELECT l_orderkey AS instance, CAST(round(l_extendedprice * 100) AS BIGINT) AS v, CAST(l_quantity AS BIGINT) AS w,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS i FROM lineitem),
g AS (SELECT instance, 0::BIGINT AS i, 0::BIGINT AS value, 0::BIGINT AS weight, 0::BIGINT AS taken FROM it WHERE i = 1
  UNION ALL SELECT g.instance, it.i, CASE WHEN weight + w <= {CAPACITY} THEN value + v ELSE value END,
    CASE WHEN weight + w <= {CAPACITY} THEN weight + w ELSE weight END, CASE WHEN weight + w <= {CAPACITY} THEN taken + 1 ELSE taken END
  FROM g JOIN it ON it.instance = g.instance AND it.i = g.i + 1)
SELECT instance, {CAPACITY}::BIGINT AS capacity, value, weight, taken FROM (
  SELECT *, row_number() OVER (PARTITION BY instance ORDER BY i DESC) AS last FROM g) WHERE last = 1
"""
)
def knapsack_greedy(spark: SparkSession, sf: str) -> DataFrame:
    return knapsack.greedy(_items(spark, sf))


LINES_PER_FILE = 20_000
_KEY = "l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_partkey::VARCHAR || '-' || l_suppkey::VARCHAR"


@query(
    f"""
SELECT CAST(('0x' || substr(md5({_KEY}), 1, 8))::BIGINT % (SELECT count(*) // {LINES_PER_FILE} + 1 FROM lineitem) AS INTEGER) AS instance,
  count(*) AS items, CAST(sum(round(l_extendedprice, 0)) AS BIGINT) AS value, CAST(sum(l_quantity) AS BIGINT) AS weight, 5000::BIGINT AS capacity,
  count(*) - 1 AS last_item
FROM lineitem GROUP BY 1
"""
)
def knapsack_load(spark: SparkSession, sf: str) -> DataFrame:
    """Instance files written from the order lines and read back with totals. The
    lines are dealt evenly over as many files as their number calls for."""
    path = work_path(spark, "instances")
    li = load(spark, sf, "lineitem")
    files_needed = li.count() // LINES_PER_FILE + 1
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    number = lambda c: c.cast("long").cast("string")
    body = li.select(
        hashing.bucket(key, files_needed).alias("instance"),
        F.lit(1).alias("place"),
        F.concat_ws(" ", number(F.round("l_extendedprice")), number(F.col("l_quantity"))).alias("line"),
    )
    head = body.groupBy("instance").agg(F.count("*").alias("n"))
    head = head.select("instance", F.lit(0).alias("place"), F.concat_ws(" ", number(F.col("n")), F.lit("5000")).alias("line"))
    rows = head.unionByName(body).repartition("instance").sortWithinPartitions("instance", "place")
    rows.select("instance", "line").write.partitionBy("instance").text(path)
    items = files.read_instances(spark, path)
    return (
        items.groupBy(F.regexp_extract("instance", r"instance=(\d+)", 1).cast("int").alias("instance"))
        .agg(
            F.count("*").alias("items"),
            F.sum("value").alias("value"),
            F.sum("weight").alias("weight"),
            F.max("capacity").alias("capacity"),
            F.max("item").alias("last_item"),
        )
    )


def _plants(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Months as periods, flag and status pairs as plants; whole-number costs."""
    li = load(spark, sf, "lineitem")
    per = li.groupBy(
        F.date_format("l_shipdate", "yyyy-MM").alias("period"), F.concat("l_returnflag", "l_linestatus").alias("plant")
    ).agg(
        F.sum("l_quantity").cast("long").alias("max_output"),
        F.count("*").alias("lines"),
        F.round(F.sum("l_extendedprice"), 0).cast("long").alias("money"),
    )
    plants = per.select(
        "period",
        "plant",
        "max_output",
        F.floor(F.col("max_output") / 5).alias("min_output"),
        F.floor(F.col("money") / F.col("max_output")).alias("unit_cost"),
        (F.col("lines") * 1000).alias("fixed_cost"),
    )
    demand = per.groupBy("period").agg(F.floor(F.sum("max_output") * 3 / 5).alias("demand"))
    return plants, demand


@query(
    """
WITH per AS (SELECT strftime(l_shipdate, '%Y-%m') AS period, l_returnflag || l_linestatus AS plant, CAST(sum(l_quantity) AS BIGINT) AS hi,
    count(*) AS n, CAST(round(sum(l_extendedprice), 0) AS BIGINT) AS money FROM lineitem GROUP BY 1, 2),
p AS (SELECT period, plant, hi, hi // 5 AS lo, money // hi AS c, n * 1000 AS f,
  row_number() OVER (PARTITION BY period ORDER BY money // hi, plant) - 1 AS i, count(*) OVER (PARTITION BY period) AS k FROM per),
d AS (SELECT period, CAST(sum(hi) * 3 // 5 AS BIGINT) AS demand FROM per GROUP BY 1),
s AS (SELECT p.*, g.sub, d.demand, (g.sub // CAST(pow(2, i) AS BIGINT)) % 2 = 1 AS active FROM p JOIN range(64) g(sub) ON g.sub < pow(2, p.k) JOIN d ON d.period = p.period),
b AS (SELECT *, sum(CASE WHEN active THEN lo ELSE 0 END) OVER (PARTITION BY period, sub) AS tlo, sum(CASE WHEN active THEN hi ELSE 0 END) OVER (PARTITION BY period, sub) AS thi,
  coalesce(sum(CASE WHEN active THEN hi - lo ELSE 0 END) OVER (PARTITION BY period, sub ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s),
o AS (SELECT *, CASE WHEN active THEN lo + greatest(0, least(hi - lo, demand - tlo - before)) ELSE 0 END AS output FROM b WHERE tlo <= demand AND thi >= demand),
t AS (SELECT *, sum(output * c + CASE WHEN active THEN f ELSE 0 END) OVER (PARTITION BY period, sub) AS cost FROM o),
w AS (SELECT *, dense_rank() OVER (PARTITION BY period ORDER BY cost, sub) AS rk FROM t)
SELECT period, plant, CAST(output AS BIGINT) AS output, CAST(active AS INTEGER) AS running, CAST(c AS BIGINT) AS unit_cost, CAST(f AS BIGINT) AS fixed_cost, CAST(cost AS BIGINT) AS period_cost
FROM w WHERE rk = 1
"""
)
def dispatch_min_cost(spark: SparkSession, sf: str) -> DataFrame:
    return plan.dispatch(*_plants(spark, sf))


@query(
    """
SELECT strftime(l_shipdate, '%Y-%m') AS period, CASE WHEN month(any_value(l_shipdate)) % 3 = 0 THEN 'infeasible' ELSE 'optimal' END AS status
FROM lineitem GROUP BY 1
"""
)
def dispatch_status(spark: SparkSession, sf: str) -> DataFrame:
    """Every third month asks for half a unit more than all plants can give."""
    plants, _ = _plants(spark, sf)
    much, some = F.sum("max_output") + 0.5, F.floor(F.sum("max_output") * 3 / 5)
    demand = plants.groupBy("period").agg(F.when(F.substring("period", 6, 2).cast("int") % 3 == 0, much).otherwise(some).cast("double").alias("demand"))
    return plan.status(plants, demand).select("period", "status")


@query(
    """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS record_date, user_id, count(*) AS events, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS deal_views,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY 1, 2
"""
)
def stream_daily_engagement(spark: SparkSession, sf: str) -> DataFrame:
    """Event files arrive in a folder, run through the stream, and end in one
    partition per day; the result must equal the batch counts."""
    landing, log, days = (work_path(spark, n) for n in ("events-in", "events-log", "events-days"))
    load(spark, sf, "events").write.parquet(landing)
    daily.run_daily(daily.event_stream(spark, landing, files_per_batch=1000), log, work_path(spark, "events-state"))
    daily.publish_days(spark, log, days)
    out = spark.read.parquet(days)
    return out.select(
        F.col("record_date").cast("string").alias("record_date"),
        "user_id",
        "events",
        "deal_views",
        F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"),
    )
