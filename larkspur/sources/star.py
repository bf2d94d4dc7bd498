"""The driver's star schema seen as the tables the analytics jobs expect.

Every builder pre-aggregates its fact rows on the key before it joins, so one
order, customer or user holding a large share of the rows is reduced map-side
and never becomes one large join partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larkspur.sources import files

ORDERS_ASOF = "2000-07-28"
ORDERS_TODAY = "2001-07-29"
TRAFFIC_ASOF = "2024-01-28"


_SCHEMAS: dict[str, tuple[tuple, StructType]] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the star schema, with the schema its files have now. Looking into a file takes a
    job, so the schema is remembered for as long as the folder's files stay the same."""
    path = f"{sf_dir}/{name}.parquet"
    state = files.state(spark, path)
    held = _SCHEMAS.get(path)
    if held is None or held[0] != state:
        held = _SCHEMAS[path] = (state, spark.read.parquet(path).schema)
    return spark.read.schema(held[1]).parquet(path)


@dataclass(frozen=True)
class RegionConfig:
    """What differs between regions: country ids and the order-status scope."""

    name: str
    countries: tuple[int, ...] | None = None  # None keeps every country
    actions: tuple[str, ...] | None = None


EVERYWHERE = RegionConfig("everywhere")


def _flag(col: Column, value: str) -> Column:
    return F.when(col == value, 1).otherwise(0)


# Category labels by line flag and line status.
L1_OF_FLAG = {"A": "L1 - Local", "N": "L1 - Shopping", "R": "L1 - Travel"}
L2_OF_STATUS = {"F": "L2 - Charity", "O": "L2 - Home"}


def perhaps_among(rows: DataFrame, column: str, keys: DataFrame, bits: int = 26) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not among ``keys`` (one column). Keys set bits by their hash, in at
    most 2^bits / 64 numbers, a bound at any size of the table; so these may be broadcast and rows go out before they move. Hashes
    meet, so a join on the key must follow (not a semi join right away: that is pushed below this one)."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    word, bit = F.shiftright("__place", 6), F.expr("shiftleft(1L, cast(__place & 63 AS int))")
    marks = keys.select(place(F.col(keys.columns[0])).alias("__place")).groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__marks"))
    placed = rows.withColumn("__place", place(F.col(column))).withColumn("__word", word)
    return placed.join(F.broadcast(marks), "__word").where(F.col("__marks").bitwiseAND(bit) != 0).drop("__place", "__word", "__marks")


def line_totals(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """One row per order: money, units, category and incentive of its lines. The
    categories are kept as one number with a bit per flag and status: unlike text minima, it stays in the
    hash aggregate. Most lines of orders that are not in ``of`` go out where they lie; a join with ``of`` drops the rest."""
    kinds = {**{f"flag_{f}": F.col("l_returnflag") == f for f in L1_OF_FLAG}, **{f"status_{f}": F.col("l_linestatus") == f for f in L2_OF_STATUS}}
    seen = sum((F.when(is_kind, 1 << i).otherwise(0) for i, is_kind in enumerate(kinds.values())), F.lit(0))
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", seen.alias("kinds")
    )
    if of is not None:
        li = perhaps_among(li, "l_orderkey", of.select("order_id"))
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return (
        li.groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.sum("l_quantity").cast("long").alias("units"),
            F.sum("l_extendedprice").alias("nob"),
            F.sum(price * (1 - disc)).alias("nor"),
            F.sum(price * (1 - disc) - price * tax).alias("gp"),
            F.sum(price * disc).alias("discount_amount"),
            F.sum(F.when(disc >= 0.05, price * disc).otherwise(0.0)).alias("ils_discount"),
            F.sum(F.when(disc >= 0.08, price * disc).otherwise(0.0)).alias("wow_discount"),
            F.bit_or("kinds").alias("kinds"),
            F.max("l_discount").alias("top_discount"),
        )
        .withColumns({k: F.col("kinds").bitwiseAND(F.lit(1 << i)) for i, k in enumerate(kinds)})
        .select(
            "order_id",
            "units",
            *[F.round(c, 4).alias(c) for c in ("nob", "nor", "gp", "discount_amount", "ils_discount", "wow_discount")],
            only_label({f"flag_{f}": label for f, label in L1_OF_FLAG.items()}).alias("l1"),
            only_label({f"status_{f}": label for f, label in L2_OF_STATUS.items()}).alias("l2"),
            F.when(F.col("top_discount") >= 0.08, "OD & WOW")
            .when(F.col("top_discount") >= 0.05, "ILS+OD")
            .when(F.col("top_discount") > 0, "OD")
            .alias("promo_type"),
        )
    )


def only_label(labels: dict[str, str]) -> Column:
    """Label of the one counter above zero, ``multi`` when there are several."""
    kinds = sum((F.when(F.col(c) > 0, 1).otherwise(0) for c in labels), F.lit(0))
    out = F.lit("unknown")
    for counter, label in labels.items():
        out = F.when(F.col(counter) > 0, label).otherwise(out)
    return F.when(kinds > 1, "multi").otherwise(out)


def platform_of(priority: Column) -> Column:
    return F.when(priority.isin("1-URGENT", "2-HIGH"), "app").when(priority == "3-MEDIUM", "touch").otherwise("web")


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without their lines: all that counts, dates and flags need."""
    o = load(spark, sf_dir, "orders")
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return o.select(
        F.col("o_custkey").alias("consumer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("txn_amount"),
        status.alias("action"),
        prio.alias("traffic_source"),
        F.when(status == "F", "Free").when(status == "O", "Paid").otherwise("Managed").alias("traffic_type"),
        platform_of(prio).alias("platform"),
        _flag(prio, "1-URGENT").alias("is_activation"),
        _flag(prio, "5-LOW").alias("is_reactivation"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), platform_of(prio)).alias("cookie"),
    )


def orders_fact(spark: SparkSession, sf_dir: str, days: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per order with its money; both sides are unique on the order id. ``days``
    keeps the orders from the first to the last day, and hardly any line of others is summed."""
    heads = order_headers(spark, sf_dir)
    if days is not None:
        heads = heads.where(F.col("order_date").between(*days))
    lines = line_totals(spark, sf_dir, None if days is None else heads)
    out = heads.join(lines, "order_id", "left")
    return out.withColumn("l1", F.coalesce("l1", F.lit("unknown"))).withColumn("l2", F.coalesce("l2", F.lit("unknown")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("consumer_id"),
        F.col("c_name").alias("user_key"),
        F.col("c_mktsegment").alias("brand"),
        F.col("c_nationkey").alias("country_id"),
    )


def device_of(event_type: Column) -> Column:
    return (
        F.when(event_type.isin("view", "signup"), "web").when(event_type == "purchase", "app").otherwise("touch")
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events as cookie traffic: a user has one cookie per device."""
    e = load(spark, sf_dir, "events")
    device = device_of(F.col("event_type"))
    return e.select(
        F.col("user_id").alias("user_uuid"),
        F.concat_ws("-", F.col("user_id").cast("string"), device).alias("cookie"),
        F.col("ts").cast("date").alias("event_date"),
        F.initcap(device).alias("platform"),
        F.when(F.col("event_type") == "view", 1).otherwise(0).alias("deal_views"),
    )


def email_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events as an e-mail send log, one row per send."""
    e = load(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        F.col("user_id").alias("user_uuid"),
        F.col("event_id").alias("send_id"),
        F.col("ts").cast("date").alias("send_date"),
        F.when(F.col("value") >= 50, 1).otherwise(0).alias("opens"),
        F.when(kind == "click", 1).otherwise(0).alias("clicks"),
        F.when(kind == "error", 1).otherwise(0).alias("unsubs"),
        F.when(kind == "purchase", "transactional").otherwise("marketing").alias("business_group"),
    )


def order_activity(spark: SparkSession, sf_dir: str, asof: str = ORDERS_ASOF) -> DataFrame:
    """Last order and orders of a year per customer."""
    day = F.lit(asof).cast("date")
    recent = F.sum(F.when(F.col("order_date") > F.date_sub(day, 365), 1).otherwise(0))
    heads = order_headers(spark, sf_dir).where(F.col("order_date") <= day)
    return heads.groupBy("consumer_id").agg(F.max("order_date").alias("last_order"), recent.alias("orders_365d"))


def user_segments(spark: SparkSession, sf_dir: str, asof: str = ORDERS_ASOF, activity: DataFrame | None = None) -> DataFrame:
    """Recency and frequency segments of every customer with an order so far; further columns of ``activity`` stay."""
    day = F.lit(asof).cast("date")
    activity = order_activity(spark, sf_dir, asof) if activity is None else activity
    more = [c for c in activity.columns if c not in ("consumer_id", "last_order", "orders_365d")]
    rec = F.datediff(day, F.col("last_order"))
    freq = F.col("orders_365d")
    return customers(spark, sf_dir).join(activity, "consumer_id").select(
        "consumer_id",
        "user_key",
        "brand",
        "country_id",
        rec.alias("recency"),
        F.when(rec <= 30, "1-High Rec (0-30 Days)")
        .when(rec <= 120, "2-Med Rec (31-120 Days)")
        .when(rec <= 365, "3-Low Rec (121-365 Days)")
        .otherwise("4-Inactive (366+ Days)")
        .alias("recency_9block"),
        F.when(freq <= 1, "1-Low Freq (1 Order)")
        .when(freq <= 4, "2-Med Freq (2-4 Orders)")
        .otherwise("3-High Freq (5+ Orders)")
        .alias("frequency_9block"),
        F.when(rec <= 30, "active").when(rec <= 365, "lapsing").otherwise("inactive").alias("recency_segment"),
        F.when(freq <= 1, "single").otherwise("repeat").alias("frequency_segment"),
        *more,
    )


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shopper per order: traffic source, calls, cost and revenue."""
    li = load(spark, sf_dir, "lineitem")
    price, disc, flag = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_returnflag")
    lines = li.groupBy(F.col("l_orderkey").alias("shopper_id")).agg(
        F.sum(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("calls"),
        F.sum(F.when(F.col("l_quantity") >= 30, 1).otherwise(0)).alias("long_calls"),
        F.sum(F.when(flag == "A", 1).otherwise(0)).alias("policies"),
        F.round(F.sum(F.when(flag == "A", price).otherwise(0.0)), 2).alias("policy_value"),
        F.round(
            F.sum(F.when(flag == "R", -price * disc).when(flag == "N", price * disc).otherwise(0.0)), 4
        ).alias("partner_revenue"),
        F.round(F.sum(price * F.col("l_tax")), 4).alias("raw_cost"),
    )
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("shopper_id"),
        F.col("o_orderdate").cast("date").alias("create_date"),
        F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("marketing_source"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_free"),
    )
    zero = F.lit(0)
    return (
        o.join(lines, "shopper_id", "left")
        .select(
            "shopper_id",
            "create_date",
            F.weekofyear("create_date").alias("week_number"),
            "marketing_source",
            F.when(F.col("is_free"), 0.0).otherwise(F.coalesce("raw_cost", F.lit(0.0))).alias("marketing_cost"),
            F.coalesce("calls", zero).alias("calls"),
            F.coalesce("long_calls", zero).alias("long_calls"),
            F.coalesce("policies", zero).alias("policies"),
            F.coalesce("policy_value", F.lit(0.0)).alias("policy_value"),
            F.coalesce("partner_revenue", F.lit(0.0)).alias("partner_revenue"),
        )
        .withColumn("revenue", F.col("partner_revenue") + F.col("policy_value"))
        .withColumn("policy_conversion", (F.col("policies") > 0).cast("int"))
        .withColumn("partner_conversion", (F.col("partner_revenue") != 0).cast("int"))
        .withColumn("has_call", (F.col("calls") > 0).cast("int"))
    )


# Leading days without a report, and the gap rule of the panel.
PANEL_LEAD_DAYS = 10


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per nation and day, by status. Orders are first counted per customer
    and day, so the join to customers carries no hot key."""
    o = load(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    per_cust = o.groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count("*").alias("cases"),
        F.sum(F.when(status == "F", 1).otherwise(0)).alias("deaths"),
        F.sum(F.when(status == "O", 1).otherwise(0)).alias("hospitalized"),
        F.sum(F.when(status == "P", 1).otherwise(0)).alias("tested"),
    )
    cust = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("geo"))
    names = ("cases", "deaths", "hospitalized", "tested")
    return per_cust.join(cust, "c_custkey").groupBy("geo", "date").agg(*[F.sum(c).alias(c) for c in names])


def cumulative_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative daily counts per nation with gaps and repeated entries.

    Days without orders repeat the sum of the day before: each row is carried up to
    the next one, so no calendar is joined. Rows per nation are bounded by the
    calendar, and so is their window. Reports are missing on the first days and on
    every day of the month d with d % 7 = 3; the first day of a month is entered
    twice.
    """
    names = ("cases", "deaths", "hospitalized", "tested")
    w = Window.partitionBy("geo").orderBy("date")
    until = F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.col("date"))
    run = daily_counts(spark, sf_dir).select(
        "geo",
        F.first("date").over(w).alias("first"),
        F.col("date").alias("from"),
        until.alias("until"),
        *[F.sum(c).over(w).alias(c) for c in names],
    )
    days = run.select("geo", "first", F.explode(F.sequence("from", "until")).alias("date"), *names)
    missing = (F.dayofmonth("date") % 7 == 3) | (F.datediff("date", "first") < PANEL_LEAD_DAYS)
    twice = F.when(F.dayofmonth("date") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    base = days.select(
        F.lpad(F.col("geo").cast("string"), 5, "0").alias("geo_id"),
        "date",
        F.explode(twice).alias("entry"),
        *[F.when(~missing, F.col(c)).alias(c) for c in names],
    )
    again = F.col("entry") - 1
    return base.select("geo_id", "date", "entry", *[(F.col(c) + again).cast("double").alias(c) for c in names])
