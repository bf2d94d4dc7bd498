"""Sources, sinks and table upkeep. Results go to the shared work folder and are
read back, so the check covers writing and reading."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.plans import publish
from larkspur.queries import frames
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import ASOF, with_parts
from larkspur.session import work_path
from larkspur.sources import catalog, files, star
from larkspur.sources.star import ORDERS_ASOF, load


def _name(prefix: str) -> str:
    return f"larkspur_{prefix}_{uuid.uuid4().hex[:10]}"


_CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("joined", T.DateType()),
    ]
)


@query("SELECT c_custkey, c_name, c_acctbal, CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS VARCHAR) AS joined FROM customer")
def src_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-separated report with header, written and read with a stated schema."""
    path = work_path(spark, "customers-tsv")
    joined = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int"))
    files.write_report(load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", joined.alias("joined")), path, "\t")
    return frames.text_dates(files.read_csv(spark, path, _CUSTOMER, ("joined",), "\t"))


@query(
    """
SELECT lpad(n_nationkey::VARCHAR, 3, '0') || lpad(s_suppkey::VARCHAR, 9, '0') AS geo_id, n_name AS state, s_name AS county
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""
)
def geo_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Code list with a preamble, as text, read back into the region dimension:
    nations as states, suppliers as counties."""
    path = work_path(spark, "codes")
    pad = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    row = lambda *c: F.concat_ws(",", *c).alias("v")
    blank = [F.lit("0")] * 3
    supplier, nation = load(spark, sf, "supplier"), load(spark, sf, "nation")
    county = supplier.select(row(F.lit("050"), pad("s_nationkey", 3), pad("s_suppkey", 9), *blank, F.col("s_name")))
    state = nation.select(row(F.lit("040"), pad("n_nationkey", 3), F.lit("000"), *blank, F.col("n_name")))
    preamble = load(spark, sf, "region").select(F.concat(F.lit("Codes of "), "r_name").alias("v"))
    preamble.unionByName(state).unionByName(county).write.text(path)
    return files.region_codes(files.read_codes(spark, path))


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Order counts per customer, one partition per order-status day."""
    return (
        star.order_headers(spark, sf)
        .groupBy("consumer_id", "action")
        .agg(F.count("*").alias("orders"), F.max("order_date").cast("string").alias("last_order"))
        .withColumn("record_date", F.when(F.col("action") == "F", "2000-07-27").when(F.col("action") == "O", "2000-07-28").otherwise("2000-07-29"))
        .drop("action")
    )


@query(
    """
SELECT o_custkey AS consumer_id, count(*) AS orders, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order
FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey
"""
)
def scan_partition(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "snapshots")
    catalog.write_snapshot(_snapshots(spark, sf), path)
    return catalog.scan_partition(spark.read.orc(path), "2000-07-28")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_orc_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "suppliers")
    load(spark, sf, "supplier").write.option("compression", "snappy").orc(path)
    return spark.read.orc(path)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def strip_qualifier(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "supplier")
    qualified = s.select(*[F.col(c).alias(f"supplier.{c}") for c in ("s_suppkey", "s_name", "s_acctbal")])
    return catalog.strip_qualifier(qualified)


@query(
    """
SELECT o_custkey AS consumer_id, count(*) + CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS orders,
  CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order,
  CASE o_orderstatus WHEN 'F' THEN '2000-07-27' WHEN 'O' THEN '2000-07-28' ELSE '2000-07-29' END AS record_date
FROM orders GROUP BY o_custkey, o_orderstatus
"""
)
def sink_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Write three days, then one of them again: only that day changes."""
    path = work_path(spark, "snapshots")
    days = _snapshots(spark, sf)
    catalog.write_snapshot(days, path, sort_by=["consumer_id"])
    again = days.where(F.col("record_date") == "2000-07-28").withColumn("orders", F.col("orders") + 1)
    catalog.write_snapshot(again, path, sort_by=["consumer_id"])
    return spark.read.orc(path).withColumn("record_date", F.col("record_date").cast("string"))


@query(
    with_parts(
        ["scores"],
        f"""
SELECT deact_date, total_deacts, '2000-09-01' AS ds FROM (
  SELECT CAST({ASOF} + CAST(365 - recency AS INTEGER) AS VARCHAR) AS deact_date, CAST(trunc(round(sum(prob_v3), 9)) AS INTEGER) AS total_deacts
  FROM scores GROUP BY recency) WHERE deact_date >= '2000-08-31'
""",
    )
)
def publish_forecast(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.operators.evaluate import total_deacts

    path = work_path(spark, "forecast")
    totals = total_deacts(frames.scores(spark, sf), "prob_v3", "recency", ORDERS_ASOF)
    out = frames.text_dates(publish.publish_forecast(totals, "2000-09-01"))
    catalog.write_snapshot(out, path, partition="ds")
    return spark.read.orc(path).withColumn("ds", F.col("ds").cast("string"))


@query(
    with_parts(
        ["compared"],
        "SELECT consumer_id_v2, consumer_id_v3, recency_v2, recency_v3, round(err, 6) AS err FROM compared",
    )
)
def ctas_compare(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.operators.evaluate import model_errors

    both = model_errors(frames.compared(spark, sf), "prob_deact_v2", "prob_deact_v3")
    table = catalog.create_as(frames.text_dates(both), _name("comparison"), work_path(spark, "comparison"))
    return frames.round_all(table.select("consumer_id_v2", "consumer_id_v3", "recency_v2", "recency_v3", "err"))


@query(
    """
SELECT c_custkey AS consumer_id, c_mktsegment, count(o_orderkey) AS orders, round(sum(o_totalprice), 2) AS total
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2
"""
)
def bucketed_join(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides bucketed on the consumer: join and aggregate without a shuffle."""
    left = load(spark, sf, "customer").select(F.col("c_custkey").alias("consumer_id"), "c_mktsegment")
    right = (
        load(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("consumer_id"))
        .agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("total"))
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a = catalog.save_bucketed(left, _name("consumers"), work_path(spark, "consumers"), "consumer_id", buckets)
    b = catalog.save_bucketed(right, _name("orders"), work_path(spark, "orders"), "consumer_id", buckets)
    return a.hint("merge").join(b, "consumer_id").withColumn("total", F.round("total", 2))


@query(
    """
SELECT * FROM (VALUES ('2000-07-28', 'kept'), ('2000-07-29', 'kept'), ('2000-07-30', 'kept'), ('2000-07-27', 'dropped')) v(record_date, state)
JOIN (SELECT CASE o_orderstatus WHEN 'F' THEN '2000-07-27' WHEN 'O' THEN '2000-07-28' ELSE '2000-07-29' END AS d, count(DISTINCT o_custkey) AS written
  FROM orders GROUP BY 1) w ON w.d = v.record_date
"""
    .replace("SELECT * FROM", "SELECT record_date, state, written FROM")
)
def partition_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """Create, recover, add, analyse and drop partitions; one row per day written."""
    table, path = _name("lifecycle"), work_path(spark, "lifecycle")
    days = _snapshots(spark, sf)
    catalog.write_snapshot(days, path)
    catalog.create_partitioned(spark, table, "consumer_id BIGINT, orders BIGINT, last_order STRING", path)
    catalog.recover_partitions(spark, table)
    catalog.add_partition(spark, table, "2000-07-30")
    catalog.analyse(spark, table, "2000-07-28")
    catalog.retain(spark, table, "2000-07-30", 3)
    kept = catalog.partitions(spark, table)
    written = days.groupBy("record_date").agg(F.count("*").alias("written"))
    return written.select("record_date", F.when(F.col("record_date").isin(kept), "kept").otherwise("dropped").alias("state"), "written")


@query(
    """
SELECT '2000-07-29' AS record_date, count(DISTINCT o_custkey) AS consumers FROM orders WHERE o_orderstatus = 'P'
"""
)
def partition_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Read a day only after its partition was seen; a missing day raises."""
    table, path = _name("gate"), work_path(spark, "gate")
    catalog.write_snapshot(_snapshots(spark, sf), path)
    catalog.create_partitioned(spark, table, "consumer_id BIGINT, orders BIGINT, last_order STRING", path)
    catalog.recover_partitions(spark, table)
    day = catalog.require_partition(spark, table, "2000-07-29")
    return catalog.scan_partition(spark.table(table), day).agg(F.lit(day).alias("record_date"), F.count("*").alias("consumers"))


@query(
    """
SELECT o_custkey AS consumer_id, count(*) AS orders, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order,
  CASE o_orderstatus WHEN 'F' THEN '2000-07-27' WHEN 'O' THEN '2000-07-28' ELSE '2000-07-29' END AS record_date
FROM orders WHERE o_orderstatus <> 'O' OR o_custkey % 2 = 0 GROUP BY o_custkey, o_orderstatus
"""
)
def insert_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Days inserted into a catalog table, then one of them again with fewer rows: it is replaced, the others stay."""
    table = _name("inserted")
    catalog.create_partitioned(spark, table, "consumer_id BIGINT, orders BIGINT, last_order STRING", work_path(spark, "inserted"))
    days = _snapshots(spark, sf)
    catalog.insert_snapshot(days, table)
    catalog.insert_snapshot(days.where("record_date = '2000-07-28' AND consumer_id % 2 = 0"), table)
    return spark.table(table)


@query("SELECT c_custkey, c_name, c_acctbal, CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS VARCHAR) AS joined FROM customer WHERE c_acctbal >= 0")
def load_replacing(spark: SparkSession, sf: str) -> DataFrame:
    """A headered file loaded into a table in place of what it held."""
    path, table = work_path(spark, "customers-csv"), _name("loaded")
    joined = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")).alias("joined")
    rows = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", joined)
    held = catalog.create_as(rows, table, work_path(spark, "loaded"), fmt="parquet")
    files.write_report(held.where("c_acctbal >= 0"), path)
    catalog.replace_contents(files.read_csv(spark, path, _CUSTOMER, ("joined",)), table)
    return frames.text_dates(spark.table(table))
