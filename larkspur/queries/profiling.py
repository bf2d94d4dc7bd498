"""Aggregations and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import numeric
from larkspur.operators import profile, quantiles
from larkspur.queries import frames
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import with_parts
from larkspur.sources import star
from larkspur.sources.star import load


@query(
    """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, min(l_extendedprice) AS min_price,
  max(l_extendedprice) AS max_price, round(avg(l_discount), 6) AS avg_disc,
  round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""
)
def agg_basic(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return (
        load(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("n"),
            F.sum("l_quantity").cast("long").alias("sum_qty"),
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_disc"),
            F.round(F.sum(price * (1 - F.col("l_discount"))), 4).alias("revenue"),
        )
    )


@query(
    """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(DISTINCT CAST(o_orderdate AS DATE)) AS days
FROM orders GROUP BY o_orderpriority
"""
)
def agg_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return (
        load(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count_distinct("o_custkey").alias("customers"),
            F.count_distinct(F.col("o_orderdate").cast("date")).alias("days"),
        )
    )


@query(
    """
SELECT count(*) AS n, round(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / count(*), 9) AS return_rate,
  round(sum(l_extendedprice * l_discount) / sum(l_extendedprice), 9) AS discount_rate,
  round(sum(l_quantity) / count(DISTINCT l_orderkey), 6) AS units_per_order
FROM lineitem
"""
)
def agg_global_ratio(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return load(spark, sf, "lineitem").agg(
        F.count("*").alias("n"),
        F.round(numeric.ratio(F.count_if(F.col("l_returnflag") == "R"), F.count("*")), 9).alias("return_rate"),
        F.round(numeric.ratio(F.sum(price * F.col("l_discount")), F.sum(price)), 9).alias("discount_rate"),
        F.round(numeric.ratio(F.sum("l_quantity"), F.count_distinct("l_orderkey")), 6).alias("units_per_order"),
    )


def _describe_sql(table: str, columns: tuple[str, ...], where: str = "") -> str:
    one = (
        "SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        "round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS p25, "
        "round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS p50, round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS p75, "
        "round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {t} {w}"
    )
    return "\nUNION ALL ".join(one.format(c=c, t=table, w=where) for c in columns)


NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(_describe_sql("lineitem", NUMBERS))
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return frames.round_all(quantiles.describe(load(spark, sf, "lineitem"), NUMBERS))


@query(with_parts(["scores"], _describe_sql("scores", ("prob_v2", "prob_v3"))))
def describe_scores(spark: SparkSession, sf: str) -> DataFrame:
    return frames.round_all(quantiles.describe(frames.scores(spark, sf), ("prob_v2", "prob_v3")))


TAIL = (0.95, 0.99, 0.995, 0.999)


@query(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS prob, round(CAST(quantile_cont({c}, {p}) AS DOUBLE), 6) AS value FROM lineitem"
        for c in ("l_extendedprice", "l_quantity")
        for p in TAIL
    )
)
def quantile_tail(spark: SparkSession, sf: str) -> DataFrame:
    out = quantiles.exact_quantiles(load(spark, sf, "lineitem"), ("l_extendedprice", "l_quantity"), TAIL)
    return frames.round_all(out)


query(
    "\nUNION ALL ".join(
        f"SELECT event_type, {p}::DOUBLE AS prob, round(quantile_cont(value, {p}), 6) AS value FROM events GROUP BY event_type"
        for p in TAIL
    ),
    name="quantiles",
)(
    lambda spark, sf: frames.round_all(
        quantiles.exact_quantiles(load(spark, sf, "events"), ("value",), TAIL, ["event_type"]).drop("column")
    )
)


@query(
    """
SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS median, round(avg(l_extendedprice), 6) AS mean
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""
)
def median_by_group(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus"]
    li = load(spark, sf, "lineitem")
    means = li.groupBy(*keys).agg(F.avg("l_extendedprice").alias("mean"))
    return frames.round_all(quantiles.median_by(li, "l_extendedprice", keys).join(means, keys))


@query(
    """
SELECT p_brand, "column", mode, n FROM (
  SELECT p_brand, 'p_size' AS "column", CAST(p_size AS DOUBLE) AS mode, n,
    row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) AS rk
  FROM (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2)) WHERE rk = 1
"""
)
def mode_smallest(spark: SparkSession, sf: str) -> DataFrame:
    return profile.mode_smallest(load(spark, sf, "part"), ["p_size"], ["p_brand"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(load(spark, sf, "events"), "event_type")


@query(
    """
SELECT 'c_mktsegment' AS "column", count(DISTINCT c_mktsegment) AS distinct_values FROM customer
UNION ALL SELECT 'c_name', count(DISTINCT c_name) FROM customer
"""
)
def cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return profile.cardinality(load(spark, sf, "customer"), ["c_mktsegment", "c_name"])


_GAPPY = "SELECT p_partkey, nullif(p_size, 50) AS p_size, nullif(p_type, 'PROMO') AS p_type, p_brand, p_retailprice FROM part"


def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select(
        "p_partkey",
        F.nullif("p_size", F.lit(50)).alias("p_size"),
        F.nullif("p_type", F.lit("PROMO")).alias("p_type"),
        "p_brand",
        "p_retailprice",
    )


_GAP_COLUMNS = ("p_partkey", "p_size", "p_type", "p_brand", "p_retailprice")


@query(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls, "
        f"round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 9) AS null_share FROM ({_GAPPY})"
        for c in _GAP_COLUMNS
    )
)
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return frames.round_all(profile.null_profile(_gappy(spark, sf)), 9)


def _dtype(c: str) -> str:
    """Spark's name of a column's type."""
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double"}
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in kinds.items())
    return f"CASE typeof(any_value({c})) {cases} END AS dtype"


@query(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_dtype(c)}, count(*) AS \"rows\", count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values, "
        f"CAST(count(DISTINCT {c}) = count(*) AS INTEGER) AS is_key FROM ({_GAPPY})"
        for c in _GAP_COLUMNS
    )
)
def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_columns(_gappy(spark, sf))


def _histogram_sql(body: str, bins: int) -> str:
    return f"""
WITH v AS ({body}), b AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM v)
SELECT bin, round(lo + bin * w, 6) AS left_edge, count(*) AS n
FROM (SELECT CAST(least(floor((x - lo) / w), {bins - 1}) AS INTEGER) AS bin, lo, w FROM v, b) GROUP BY bin, lo, w
"""


@query(_histogram_sql("SELECT value AS x FROM events WHERE value > 0 AND value < 200", 30))
def histogram_bins(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    return frames.round_all(profile.histogram(load(spark, sf, "events").where((v > 0) & (v < 200)), "value", 30))


@query(
    """
WITH f AS (SELECT CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS bulk, l_returnflag AS flag FROM lineitem)
SELECT bulk::VARCHAR AS bulk, round(sum(CASE WHEN flag = 'A' THEN 1 ELSE 0 END) / count(*), 9) AS "flag_A",
  round(sum(CASE WHEN flag = 'N' THEN 1 ELSE 0 END) / count(*), 9) AS "flag_N",
  round(sum(CASE WHEN flag = 'R' THEN 1 ELSE 0 END) / count(*), 9) AS "flag_R" FROM f GROUP BY bulk
UNION ALL SELECT 'Total', round(sum(CASE WHEN flag = 'A' THEN 1 ELSE 0 END) / count(*), 9),
  round(sum(CASE WHEN flag = 'N' THEN 1 ELSE 0 END) / count(*), 9),
  round(sum(CASE WHEN flag = 'R' THEN 1 ELSE 0 END) / count(*), 9) FROM f
"""
)
def crosstab_margins(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "lineitem").select(
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("bulk"), F.col("l_returnflag").alias("flag")
    )
    return frames.round_all(profile.crosstab_share(rows, "bulk", "flag", ["A", "N", "R"]), 9)


@query(
    """
SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 4) AS "F",
  round(avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 4) AS "O",
  round(avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 4) AS "P" FROM orders GROUP BY o_orderpriority
"""
)
def crosstab_mean(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.crosstab_mean(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], "o_totalprice")
    return frames.round_all(out, 4)


@query(
    """
SELECT user_id, count(*) FILTER (event_type = 'click') AS event_type_click, count(*) FILTER (event_type = 'error') AS event_type_error,
  count(*) FILTER (event_type = 'purchase') AS event_type_purchase, count(*) FILTER (event_type = 'signup') AS event_type_signup,
  count(*) FILTER (event_type = 'view') AS event_type_view FROM events GROUP BY user_id
"""
)
def pivot_counts(spark: SparkSession, sf: str) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    return profile.pivot_counts(load(spark, sf, "events"), "user_id", "event_type", kinds)


@query(
    """
SELECT "column", label, n, round(share, 9) AS share FROM (
  SELECT 'p_name' AS "column", p_name AS label, count(*) AS n, count(*) / (SELECT count(*) FROM part) AS share FROM part GROUP BY p_name
  UNION ALL SELECT 'p_brand', p_brand, count(*), count(*) / (SELECT count(*) FROM part) FROM part GROUP BY p_brand)
WHERE share < 0.02
"""
)
def rare_labels(spark: SparkSession, sf: str) -> DataFrame:
    return frames.round_all(profile.rare_labels(load(spark, sf, "part"), ["p_name", "p_brand"], 0.02), 9)


@query(
    f"""
SELECT CASE WHEN p_size IS NULL THEN 1 ELSE 0 END AS missing, round(median(p_retailprice), 6) AS median, count(*) AS n
FROM ({_GAPPY}) GROUP BY 1
"""
)
def target_by_missing(spark: SparkSession, sf: str) -> DataFrame:
    df = _gappy(spark, sf).withColumn("missing", F.col("p_size").isNull().cast("int"))
    sizes = df.groupBy("missing").agg(F.count("*").alias("n"))
    return frames.round_all(quantiles.median_by(df, "p_retailprice", ["missing"]).join(sizes, "missing"))


@query(
    with_parts(
        ["shoppers"],
        """
SELECT shopper_id, create_date::VARCHAR AS create_date,
  CASE WHEN calls = top THEN med ELSE CAST(calls AS DOUBLE) END AS calls
FROM (SELECT s.*, (SELECT max(calls) FROM shoppers) AS top,
  (SELECT median(calls) FROM shoppers WHERE create_date = DATE '2000-07-28' AND calls > 0) AS med FROM shoppers s)
""",
    )
)
def impute_point(spark: SparkSession, sf: str) -> DataFrame:
    shoppers = star.funnel(spark, sf)
    usual = quantiles.exact_quantiles(
        shoppers.where((F.col("create_date") == F.lit("2000-07-28").cast("date")) & (F.col("calls") > 0)), ["calls"], [0.5]
    )
    top = shoppers.agg(F.max("calls")).scalar()
    value = usual.agg(F.max("value")).scalar()
    fixed = F.when(F.col("calls") == top, value).otherwise(F.col("calls").cast("double"))
    return shoppers.select("shopper_id", F.col("create_date").cast("string").alias("create_date"), fixed.alias("calls"))


_FEW = "if(count(DISTINCT {c}) < 20, 'discrete', 'continuous')"
_ROLES = {
    "p_partkey": ("p_partkey", "'continuous'"),
    "p_size": ("p_size", _FEW.format(c="p_size")),
    "p_half": ("(p_size // 10)", _FEW.format(c="p_size // 10")),
    "p_type": ("p_type", "'categorical'"),
    "YearSold": ("(p_partkey % 5)", "'temporal'"),
}


@query(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {_dtype(c)}, {role} AS role, count(DISTINCT {c}) AS distinct_values FROM part" for name, (c, role) in _ROLES.items()
    )
)
def variable_types(spark: SparkSession, sf: str) -> DataFrame:
    df = load(spark, sf, "part").select(
        "p_partkey",
        "p_size",
        F.floor(F.col("p_size") / 10).cast("int").alias("p_half"),
        "p_type",
        (F.col("p_partkey") % 5).alias("YearSold"),
    )
    return profile.variable_types(df)
