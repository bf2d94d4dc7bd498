"""Projection, filters, cleaning, joins, sorting, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import dates, hashing, numeric, text
from larkspur.operators import joins, profile, series
from larkspur.plans import customer as cust
from larkspur.queries import frames
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import ASOF, with_parts
from larkspur.sources import star
from larkspur.sources.catalog import clustered
from larkspur.sources.star import ORDERS_ASOF, load


@query("SELECT c_name AS name, c_custkey AS consumer_id, c_mktsegment AS segment FROM customer")
def proj_rename(spark: SparkSession, sf: str) -> DataFrame:
    df = load(spark, sf, "customer").drop("c_acctbal", "c_nationkey")
    df = df.withColumnRenamed("c_custkey", "consumer_id").withColumnRenamed("c_mktsegment", "segment")
    return df.withColumnRenamed("c_name", "name").select("name", "consumer_id", "segment")


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * (1 - l_discount), 4) AS revenue,
  round(l_extendedprice * l_discount - l_extendedprice * l_tax, 4) AS gap,
  round((l_discount - l_tax) * (l_discount - l_tax), 6) AS sq_err
FROM lineitem
"""
)
def proj_arith(spark: SparkSession, sf: str) -> DataFrame:
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(price * (1 - disc), 4).alias("revenue"),
        F.round(price * disc - price * tax, 4).alias("gap"),
        F.round((disc - tax) * (disc - tax), 6).alias("sq_err"),
    )


@query(
    """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice <> 0 AND o_totalprice > 100000 AND o_orderpriority < '3'
  AND CAST(o_orderdate AS DATE) >= DATE '1998-07-28'
"""
)
def filter_compound(spark: SparkSession, sf: str) -> DataFrame:
    return (
        load(spark, sf, "orders")
        .where(
            (F.col("o_orderstatus") == "F")
            & (F.col("o_totalprice") != 0)
            & (F.col("o_totalprice") > 100000)
            & (F.col("o_orderpriority") < "3")
            & (F.col("o_orderdate").cast("date") >= dates.as_date("1998-07-28"))
        )
        .select("o_orderkey", "o_totalprice")
    )


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_in(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        "c_custkey", "c_mktsegment"
    )


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('purchase', 'error') AND event_type <> 'signup'")
def filter_not_in(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return load(spark, sf, "events").where(~kind.isin("purchase", "error") & (kind != "signup")).select(
        "event_id", "event_type"
    )


@query(
    """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-07-28' - 365 AND DATE '2000-07-28'
  AND o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2000-07-01'
"""
)
def filter_between(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    half_open = (day >= dates.as_date("2000-01-01")) & (day < dates.as_date("2000-07-01"))
    return (
        load(spark, sf, "orders")
        .where(day.between(dates.days_before(ORDERS_ASOF, 365), dates.as_date(ORDERS_ASOF)) & half_open)
        .select("o_orderkey", day.cast("string").alias("order_date"))
    )


@query(
    with_parts(
        ["ords"],
        f"""
SELECT consumer_id, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, orders
FROM (SELECT consumer_id, order_date AS valid_from, n AS orders,
    coalesce(lead(order_date) OVER (PARTITION BY consumer_id ORDER BY order_date) - 1, DATE '9999-12-31') AS valid_to
  FROM (SELECT consumer_id, order_date, count(*) AS n FROM ords GROUP BY 1, 2))
WHERE {ASOF} BETWEEN valid_from AND valid_to
""",
    )
)
def scd2_as_of(spark: SparkSession, sf: str) -> DataFrame:
    days = star.order_headers(spark, sf).groupBy("consumer_id", "order_date").agg(F.count("*").alias("orders"))
    spans = series.validity_intervals(days, "consumer_id", "order_date")
    held = series.valid_at(spans, ORDERS_ASOF, "valid_from", "valid_to")
    return frames.text_dates(held.select("consumer_id", "valid_from", "valid_to", "orders"))


@query(with_parts(["shoppers"], "SELECT shopper_id, calls, long_calls FROM shoppers WHERE calls >= long_calls"))
def filter_colcol(spark: SparkSession, sf: str) -> DataFrame:
    return star.funnel(spark, sf).where(F.col("calls") >= F.col("long_calls")).select("shopper_id", "calls", "long_calls")


@query(
    with_parts(
        ["scores", "ords"],
        """
SELECT t.consumer_id, CASE WHEN 365 - t.recency <= 30 THEN '1. 1-30 days' WHEN 365 - t.recency <= 60 THEN '2. 31-60 days'
    WHEN 365 - t.recency <= 90 THEN '3. 61-90 days' WHEN 365 - t.recency <= 120 THEN '4. 91-120 days'
    WHEN 365 - t.recency <= 180 THEN '5. 121-180 days' ELSE '6. 181-365 days' END AS days_until,
  CASE WHEN month(d) IN (1,2,3) THEN 'Q1' WHEN month(d) IN (4,5,6) THEN 'Q2' WHEN month(d) IN (7,8,9) THEN 'Q3'
    ELSE 'Q4' END || year(d)::VARCHAR AS last_quarter
FROM (SELECT *, DATE '2000-07-28' - CAST(recency AS INTEGER) AS d FROM scores) t
""",
    )
)
def bucket_ladder(spark: SparkSession, sf: str) -> DataFrame:
    return frames.target(spark, sf).select(
        "consumer_id",
        dates.days_until_bucket(F.lit(365) - F.col("recency")).alias("days_until"),
        dates.quarter_year(F.col("last_train_order_date")).alias("last_quarter"),
    )


@query(
    """
SELECT o_orderkey, round(o_totalprice / 250000 - 1, 6) AS change,
  CASE WHEN c > -1 AND c <= -0.5 THEN '-100% to -50%' WHEN c > -0.5 AND c <= -0.05 THEN '-50% to -5%'
    WHEN c > -0.05 AND c <= 0.05 THEN 'no change' WHEN c > 0.05 AND c <= 0.5 THEN '5% to 50%'
    WHEN c > 0.5 AND c <= 1 THEN '50% to 100%' WHEN c > 1 AND c <= 99999 THEN '100%+' END AS change_class
FROM (SELECT *, round(o_totalprice / 250000 - 1, 6) AS c FROM orders)
"""
)
def cut_right_closed(spark: SparkSession, sf: str) -> DataFrame:
    change = F.round(F.col("o_totalprice") / 250000 - 1, 6)
    return (
        load(spark, sf, "orders")
        .select("o_orderkey", change.alias("change"))
        .withColumn("change_class", numeric.change_class(F.col("change")))
    )


@query(
    """
SELECT event_id, CASE WHEN value > 100 THEN 100.0 WHEN value < 5 THEN 5.0 ELSE value END AS value,
  coalesce(nullif(event_type, 'error'), 'missing') AS event_type,
  coalesce(CASE WHEN event_type = 'click' THEN CAST(ts AS DATE)::VARCHAR END,
    (CAST(ts AS DATE) - 90)::VARCHAR) AS click_date
FROM events
"""
)
def fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("ts").cast("date")
    kind = F.col("event_type")
    raw = load(spark, sf, "events").select(
        "event_id",
        numeric.cap(F.col("value"), 5.0, 100.0).alias("value"),
        F.nullif(kind, F.lit("error")).alias("event_type"),
        F.coalesce(F.when(kind == "click", day), F.date_sub(day, 90)).cast("string").alias("click_date"),
    )
    return raw.na.fill({"event_type": "missing"})


@query(
    with_parts(
        ["fact"],
        """
SELECT order_id, CASE l1 WHEN 'unknown' THEN 'Local' WHEN 'multi' THEN 'Local' ELSE l1 END AS l1,
  CASE WHEN l2 IN ('L2 - Charity', 'multi', 'unknown') THEN 'other' ELSE l2 END AS l2,
  CASE WHEN promo_type IN ('OD & WOW', 'ILS+OD') THEN 'OD' WHEN promo_type IS NULL THEN 'organic' ELSE promo_type
    END AS promo_type
FROM fact
""",
    )
)
def relabel(spark: SparkSession, sf: str) -> DataFrame:
    df = star.orders_fact(spark, sf).select("order_id", "l1", "l2", "promo_type")
    df = cust.relabel(cust.relabel(df, "l1", cust.L1_MERGE), "l2", cust.L2_MERGE)
    return cust.relabel(df, "promo_type", cust.PROMO_MERGE, cust.PROMO_MISSING)


_PASSENGERS = """
  SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN '?' ELSE CAST(CAST(floor(c_acctbal / 150) AS BIGINT) AS VARCHAR) END AS age,
    CASE WHEN c_nationkey < 12 THEN '?' ELSE substr(c_mktsegment, 1, 1) || c_nationkey || ' B' || c_nationkey END AS cabin,
    CASE WHEN c_nationkey % 7 = 0 THEN '?' ELSE substr(reverse(c_mktsegment), 1, 1) END AS embarked
  FROM customer
"""


@query(f"SELECT id, nullif(age, '?') AS age, nullif(cabin, '?') AS cabin, nullif(embarked, '?') AS embarked FROM ({_PASSENGERS})")
def sentinel_null(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.plans.passengers import SENTINEL, passengers

    raw = passengers(load(spark, sf, "customer")).select("id", "age", "cabin", "embarked")
    return raw.withColumns({c: text.blank_out(F.col(c), SENTINEL) for c in ("age", "cabin", "embarked")})


@query(
    f"""
SELECT id, nullif(age, '?') AS age, nullif(cabin, '?') AS cabin, nullif(embarked, '?') AS embarked FROM ({_PASSENGERS})
WHERE (CASE WHEN age <> '?' THEN 1 ELSE 0 END) + (CASE WHEN cabin <> '?' THEN 1 ELSE 0 END)
  + (CASE WHEN embarked <> '?' THEN 1 ELSE 0 END) + 1 >= 3 AND age <> '?'
"""
)
def dropna_thresh(spark: SparkSession, sf: str) -> DataFrame:
    return sentinel_null(spark, sf).dropna(thresh=3).dropna(subset=["age"])


@query(
    """
SELECT c_custkey, try_cast(c_name AS BIGINT) AS name_number,
  CAST(try_cast('20' || lpad(CAST(c_custkey % 40 AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey % 15 AS VARCHAR), 2, '0')
    || '-' || lpad(CAST(c_custkey % 32 AS VARCHAR), 2, '0') AS DATE) AS VARCHAR) AS parsed_date
FROM customer
"""
)
def try_parse(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    two = lambda n: F.lpad((key % n).cast("string"), 2, "0")
    raw = F.concat(F.lit("20"), two(40), F.lit("-"), two(15), F.lit("-"), two(32))
    return load(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").try_cast("bigint").alias("name_number"), raw.try_cast("date").cast("string").alias("parsed_date")
    )


_BUCKET = "('0x' || substr(md5({k}::VARCHAR), 1, 8))::BIGINT % 100"


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_BUCKET.format(k='o_orderkey')} < 50")
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").where(hashing.bucket(F.col("o_orderkey")) < 50).select("o_orderkey", "o_totalprice")


@query(
    f"SELECT c_custkey, CASE WHEN {_BUCKET.format(k='c_custkey')} < 66 THEN 'training' ELSE 'validation' END AS data_set FROM customer"
)
def hash_split_label(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select(
        "c_custkey", hashing.split_label(F.col("c_custkey"), cust.SPLIT).alias("data_set")
    )


FOUR_WAY = (("train", 10), ("calibrate", 10), ("validate", 10), ("unused", 70))


@query(
    f"""
SELECT part, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM (
  SELECT o_orderkey, CASE WHEN b < 10 THEN 'train' WHEN b < 20 THEN 'calibrate' WHEN b < 30 THEN 'validate' ELSE 'unused' END AS part
  FROM (SELECT o_orderkey, {_BUCKET.format(k='o_orderkey')} AS b FROM orders)) GROUP BY part
"""
)
def hash_split_4way(spark: SparkSession, sf: str) -> DataFrame:
    parted = load(spark, sf, "orders").select("o_orderkey", hashing.split_label(F.col("o_orderkey"), FOUR_WAY).alias("part"))
    return parted.groupBy("part").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    with_parts(
        ["segments", "target"],
        """
SELECT s.consumer_id, s.recency_9block, t.deactivated AS label_left, coalesce(t.deactivated, 1) AS label_filled
FROM segments s LEFT JOIN target t ON s.consumer_id = t.consumer_id
""",
    )
)
def join_left_label(spark: SparkSession, sf: str) -> DataFrame:
    labels = frames.target(spark, sf).select("consumer_id", F.col("deactivated").alias("label_left"))
    out = star.user_segments(spark, sf).select("consumer_id", "recency_9block").join(labels, "consumer_id", "left")
    return out.withColumn("label_filled", F.coalesce("label_left", F.lit(1)))


@query(
    """
SELECT s_suppkey, lpad(r_regionkey::VARCHAR, 2, '0') || lpad(n_nationkey::VARCHAR, 3, '0') AS geo_id, n_name AS county,
  r_name AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
)
def join_inner_geo(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    geo = nation.withColumnRenamed("n_regionkey", "r_regionkey").join(region, "r_regionkey")
    return (
        load(spark, sf, "supplier")
        .withColumnRenamed("s_nationkey", "n_nationkey")
        .join(geo, "n_nationkey")
        .select(
            "s_suppkey",
            F.concat(F.lpad(F.col("r_regionkey").cast("string"), 2, "0"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias(
                "geo_id"
            ),
            F.col("n_name").alias("county"),
            F.col("r_name").alias("state"),
        )
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE::VARCHAR AS ship_date, l_quantity
FROM lineitem ORDER BY l_shipdate DESC, l_orderkey, l_linenumber
"""
)
def sort_multi(spark: SparkSession, sf: str) -> DataFrame:
    return (
        load(spark, sf, "lineitem")
        .orderBy(F.desc("l_shipdate"), "l_orderkey", "l_linenumber")
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_shipdate").cast("date").cast("string").alias("ship_date"),
            "l_quantity",
        )
    )


@query(
    with_parts(
        ["shoppers"],
        """
SELECT * FROM (SELECT 'calls' AS review, shopper_id, CAST(calls AS DOUBLE) AS measure FROM shoppers ORDER BY calls DESC, shopper_id LIMIT 3)
UNION ALL SELECT * FROM (SELECT 'cost' AS review, shopper_id, marketing_cost FROM shoppers ORDER BY marketing_cost DESC, shopper_id LIMIT 13)
UNION ALL SELECT * FROM (SELECT 'loss' AS review, shopper_id, partner_revenue FROM shoppers ORDER BY partner_revenue, shopper_id LIMIT 10)
""",
    )
)
def topk_outliers(spark: SparkSession, sf: str) -> DataFrame:
    shoppers = star.funnel(spark, sf)
    pick = lambda name, c, k, asc: profile.top_rows(shoppers, c, k, "shopper_id", asc).select(
        F.lit(name).alias("review"), "shopper_id", F.col(c).cast("double").alias("measure")
    )
    return (
        pick("calls", "calls", 3, False)
        .unionByName(pick("cost", "marketing_cost", 13, False))
        .unionByName(pick("loss", "partner_revenue", 10, True))
    )


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 40")
def topk_values(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_values(load(spark, sf, "lineitem"), "l_partkey", 40)


@query(
    with_parts(
        ["target"],
        """
SELECT consumer_id, recency, last_train_order_date::VARCHAR AS last_train_order_date,
  first_target_order_date::VARCHAR AS first_target_order_date, deactivated FROM target
""",
    )
)
def distribute_sort(spark: SparkSession, sf: str) -> DataFrame:
    return frames.text_dates(clustered(frames.target(spark, sf), "consumer_id"))


@query(
    with_parts(
        ["v2"],
        """
SELECT consumer_id, CAST(deact_date AS VARCHAR) AS deact_date, round(prob_deact, 6) AS prob_deact,
  CAST(NULL AS DOUBLE) AS tenure_days, CAST(NULL AS VARCHAR) AS most_recent_open_date FROM v2
""",
    )
)
def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    expected = [
        ("consumer_id", "bigint"),
        ("deact_date", "string"),
        ("prob_deact", "double"),
        ("tenure_days", "double"),
        ("most_recent_open_date", "string"),
    ]
    return frames.round_all(joins.align_schema(frames.predictions_v2(spark, sf), expected))


@query(
    """
SELECT o_orderkey, day(d) AS deact_dayofmonth, dayofyear(d) AS deact_dayofyear, isodow(d) - 1 AS deact_dayofweek,
  week(d) AS deact_weekofyear, month(d) AS deact_month, CASE WHEN isodow(d) >= 6 THEN 1.0::DOUBLE ELSE 0.0 END AS deact_is_weekend,
  day(e) AS last_dayofmonth, dayofyear(e) AS last_dayofyear, isodow(e) - 1 AS last_dayofweek, week(e) AS last_weekofyear,
  month(e) AS last_month, CASE WHEN isodow(e) >= 6 THEN 1.0::DOUBLE ELSE 0.0 END AS last_is_weekend
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) + 365 AS d, CAST(o_orderdate AS DATE) AS e FROM orders)
"""
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    last = F.col("o_orderdate").cast("date")
    return load(spark, sf, "orders").select(
        "o_orderkey", *dates.date_features(F.date_add(last, 365), "deact"), *dates.date_features(last, "last")
    )


@query(
    """
SELECT o_orderkey, CAST(d + 365 AS VARCHAR) AS plus_year, CAST(d - 90 AS VARCHAR) AS minus_90,
  CAST(CAST(date_trunc('month', d) - INTERVAL 12 MONTH AS DATE) AS VARCHAR) AS month_last_year,
  date_diff('day', d, DATE '2001-07-29') AS age_days, year(d) AS y, month(d) AS m
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
"""
)
def date_arith(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.date_add(d, 365).cast("string").alias("plus_year"),
        F.date_sub(d, 90).cast("string").alias("minus_90"),
        F.add_months(F.trunc(d, "month"), -12).cast("string").alias("month_last_year"),
        F.datediff(dates.as_date(star.ORDERS_TODAY), d).alias("age_days"),
        F.year(d).alias("y"),
        F.month(d).alias("m"),
    )


@query(
    """
SELECT p_partkey, nullif(regexp_extract(trim(p_name), '^[^\\s]+', 0), '') AS first_token, substr(p_type, 1, 1) AS letter,
  regexp_replace(trim(p_brand || ' & ' || p_type), '[^A-Za-z0-9_]+', '_', 'g') AS slug,
  lpad(p_size::VARCHAR, 3, '0') || lpad(p_partkey::VARCHAR, 7, '0') AS padded, replace(p_brand, 'Brand#', 'b_') AS short_brand
FROM part
"""
)
def string_clean(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select(
        "p_partkey",
        text.first_token(F.col("p_name")).alias("first_token"),
        text.first_letter(F.col("p_type")).alias("letter"),
        text.slug(F.concat_ws(" & ", "p_brand", "p_type")).alias("slug"),
        F.concat(F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("padded"),
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("b_")).alias("short_brand"),
    )


@query(
    """
SELECT c_custkey, substr(nullif(regexp_extract(cabin, '^[^ ]+', 0), ''), 1, 1) AS deck,
  CASE WHEN name LIKE '%Mrs%' THEN 'Mrs' WHEN name LIKE '%Mr%' THEN 'Mr' WHEN name LIKE '%Miss%' THEN 'Miss'
    WHEN name LIKE '%Master%' THEN 'Master' ELSE 'Other' END AS title
FROM (SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN NULL ELSE substr(c_mktsegment, 1, 1) || c_nationkey || ' B' || c_nationkey END AS cabin,
  c_name || ' ' || CASE c_mktsegment WHEN 'BUILDING' THEN 'Mr.' WHEN 'FURNITURE' THEN 'Mrs.' WHEN 'HOUSEHOLD' THEN 'Miss.'
    WHEN 'MACHINERY' THEN 'Master.' ELSE 'Dr.' END AS name FROM customer)
"""
)
def title_ladder(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.plans.passengers import cleaned, passengers

    return cleaned(passengers(load(spark, sf, "customer"))).select(
        F.col("id").alias("c_custkey"), F.col("cabin").alias("deck"), "title"
    )


@query(
    """
SELECT lang, source, CASE WHEN text LIKE '%Mrs%' THEN 'Mrs' WHEN text LIKE '%Mr%' THEN 'Mr' WHEN text LIKE '%Miss%' THEN 'Miss'
    WHEN text LIKE '%Master%' THEN 'Master' ELSE 'Other' END AS title, count(*) AS n,
  count(DISTINCT nullif(regexp_extract(trim(text), '^[^ \\t\\n\\r]+', 0), '')) AS first_words
FROM documents GROUP BY 1, 2, 3
"""
)
def title_ladder_documents(spark: SparkSession, sf: str) -> DataFrame:
    body = F.col("text")
    return (
        load(spark, sf, "documents")
        .select("lang", "source", text.title(body).alias("title"), text.first_token(body).alias("word"))
        .groupBy("lang", "source", "title")
        .agg(F.count("*").alias("n"), F.count_distinct("word").alias("first_words"))
    )


@query(
    """
SELECT event_id, abs(value - 50) AS dist, round(value, 0) AS whole, round(value, 1) AS tenth, CASE WHEN value > 0 THEN round(ln(value), 6) END AS ln_v,
  round(exp(-value / 100), 6) AS decay, round(sqrt(value), 6) AS root, round(value * value, 4) AS square,
  CASE WHEN value - 0.01 > 0 THEN round(ln(value - 0.01), 6) END AS ln_shift
FROM events
"""
)
def math_scalar(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    return load(spark, sf, "events").select(
        "event_id",
        F.abs(v - 50).alias("dist"),
        F.round(v, 0).alias("whole"),
        F.round(v, 1).alias("tenth"),
        F.round(F.log(v), 6).alias("ln_v"),
        F.round(F.exp(-v / 100), 6).alias("decay"),
        F.round(F.sqrt(v), 6).alias("root"),
        F.round(v * v, 4).alias("square"),
        F.round(F.log(v - 0.01), 6).alias("ln_shift"),
    )


@query(
    with_parts(
        ["shoppers"],
        """
SELECT create_date::VARCHAR AS create_date, CAST(sum(policy_conversion) AS BIGINT) AS policy_conversions,
  CAST(sum(partner_conversion) AS BIGINT) AS partner_conversions, CAST(sum(has_call) AS BIGINT) AS with_call, count(*) AS n
FROM shoppers GROUP BY create_date
""",
    )
)
def conversion_flags(spark: SparkSession, sf: str) -> DataFrame:
    return frames.text_dates(
        star.funnel(spark, sf)
        .groupBy("create_date")
        .agg(
            F.sum("policy_conversion").alias("policy_conversions"),
            F.sum("partner_conversion").alias("partner_conversions"),
            F.sum("has_call").alias("with_call"),
            F.count("*").alias("n"),
        )
    )


@query(
    """
SELECT o_custkey AS consumer_id, o_orderkey AS order_id, n_lines, promo_type, coalesce(wow, 0) AS wow
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, max(l_shipdate)::DATE::VARCHAR AS promo_type,
    round(sum(l_extendedprice * l_discount), 4) AS wow
  FROM lineitem WHERE l_discount > 0 GROUP BY l_orderkey) i ON i.l_orderkey = o_orderkey
"""
)
def join_left_incentives(spark: SparkSession, sf: str) -> DataFrame:
    deals = (
        load(spark, sf, "lineitem")
        .where(F.col("l_discount") > 0)
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.count("*").alias("n_lines"),
            F.max("l_shipdate").cast("date").cast("string").alias("promo_type"),
            F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 4).alias("wow"),
        )
    )
    orders = load(spark, sf, "orders").select(F.col("o_custkey").alias("consumer_id"), F.col("o_orderkey").alias("order_id"))
    return joins.left_flagged(orders, deals, "order_id", {"wow": 0.0})

