"""Frames shared by several queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.dates import as_date, months_before
from larkspur.operators.evaluate import mask_probability
from larkspur.operators.joins import full_compare
from larkspur.plans import customer as cust
from larkspur.plans.feature_store import FeatureStore
from larkspur.session import saved
from larkspur.sources import star
from larkspur.sources.star import ORDERS_ASOF, ORDERS_TODAY, TRAFFIC_ASOF


def day_after(day: str, days: int = 1) -> str:
    return str(dt.date.fromisoformat(day) + dt.timedelta(days=days))


NEXT_DAY = day_after(ORDERS_ASOF)


def text_dates(df: DataFrame) -> DataFrame:
    """Dates as yyyy-MM-dd text, the form the result tables keep."""
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"})


def r(col: Column | str, places: int = 6) -> Column:
    return F.round((F.col(col) if isinstance(col, str) else col).cast("double"), places)


def round_all(df: DataFrame, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c, t in df.dtypes if t == "double"})


def pop(spark: SparkSession, sf: str, asof: str = ORDERS_ASOF) -> DataFrame:
    return cust.population(star.user_segments(spark, sf, asof))


def active(spark: SparkSession, sf: str) -> DataFrame:
    """Active consumers with their recency."""
    return star.user_segments(spark, sf).where(F.col("recency_9block").isin(*cust.ACTIVE_CLASSES))


def target(spark: SparkSession, sf: str) -> DataFrame:
    orders = cust.in_scope(star.order_headers(spark, sf))
    base = active(spark, sf).select("consumer_id", "recency")
    return cust.target_label(base, orders, ORDERS_ASOF, ORDERS_TODAY).withColumn(
        "recency", F.datediff(F.lit(ORDERS_ASOF).cast("date"), "last_train_order_date")
    )


def prob_v3(recency: Column) -> Column:
    return (recency + 1) / (recency + F.lit(121.0))


def prob_v2(recency: Column) -> Column:
    return (recency + 1) / F.lit(367.0)


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Exact scores of two models on the labelled population, and the first one masked."""
    rec = F.col("recency")
    out = target(spark, sf).select(
        "consumer_id", "recency", "deactivated", prob_v3(rec).alias("prob_v3"), prob_v2(rec).alias("prob_v2")
    )
    return mask_probability(out, "prob_v3", "recency", 3)


def predictions(spark: SparkSession, sf: str, actions: tuple[str, ...], prob, asof: str = ORDERS_ASOF) -> DataFrame:
    """A model's prediction table; the models see different order scopes."""
    day = F.lit(asof).cast("date")
    last = (
        star.order_headers(spark, sf)
        .where((F.col("order_date") <= day) & F.col("action").isin(*actions))
        .groupBy("consumer_id")
        .agg(F.max("order_date").alias("last"))
    )
    rec = F.datediff(day, F.col("last"))
    return last.where(rec <= 365).select(
        "consumer_id",
        F.date_add("last", 365).alias("deact_date"),
        rec.alias("recency"),
        prob(rec).alias("prob_deact"),
    )


def predictions_v3(spark: SparkSession, sf: str) -> DataFrame:
    return predictions(spark, sf, ("F", "P"), prob_v3)


def predictions_v2(spark: SparkSession, sf: str) -> DataFrame:
    return predictions(spark, sf, ("F", "O"), prob_v2)


def compared(spark: SparkSession, sf: str) -> DataFrame:
    return full_compare(predictions_v2(spark, sf), predictions_v3(spark, sf), ["consumer_id"], "_v2", "_v3")


def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Truth joined to the comparison of the two models."""
    c = compared(spark, sf).where(F.col("recency_v3").between(0, 364))
    return target(spark, sf).select("consumer_id", "deactivated").join(
        c.select(
            F.col("consumer_id_v3").alias("consumer_id"),
            F.col("deact_date_v3").alias("deact_date"),
            F.col("recency_v3").alias("recency"),
            F.col("prob_deact_v2").alias("prob_v2"),
            F.col("prob_deact_v3").alias("prob_v3"),
        ),
        "consumer_id",
    )


_STORES: dict[tuple[str, str], FeatureStore] = {}


def store(spark: SparkSession, sf: str) -> FeatureStore:
    """The feature tables made from a folder by this application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORES:
        _STORES[key] = FeatureStore(spark)
    return _STORES[key]


def forget_features() -> None:
    """Features are made anew after this."""
    _STORES.clear()


def features(spark: SparkSession, sf: str, asof: str = ORDERS_ASOF, traffic_asof: str = TRAFFIC_ASOF) -> DataFrame:
    """All-feature table as of a day, made and written when a day is asked for the first time; the
    outcome year starts the day after."""
    tables = store(spark, sf)
    if not tables.has("features", asof):
        heads, visits = star.order_headers(spark, sf), star.visits(spark, sf)

        def orders() -> DataFrame:
            fact = star.orders_fact(spark, sf, (months_before(asof, 24), as_date(asof)))
            return cust.order_features(saved(fact, "orders-fact"), asof)

        def engagement() -> DataFrame:
            maps = [cust.cookie_map_visits(None, visits, traffic_asof), cust.cookie_map_orders(None, heads, asof)]
            return cust.engagement_by_consumer(cust.cookie_map(maps), cust.engagement_by_cookie(visits, traffic_asof), traffic_asof)

        def people() -> DataFrame:
            history = cust.order_history(heads, asof, ORDERS_TODAY)
            return cust.people(star.user_segments(spark, sf, asof, history.where("last_order IS NOT NULL")), asof)

        steps = {
            "orders": orders,
            "engagement": engagement,
            "population": people,
            "email": lambda: cust.email_metrics(None, star.email_log(spark, sf), traffic_asof),
        }
        tables.write_all(steps, asof)
        tables.write("features", cust.all_features(tables.star("population", list(cust.STEPS), asof)), asof)
    return tables.read("features", asof)
