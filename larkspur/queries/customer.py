"""Customer feature steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.dates import as_date, months_before
from larkspur.plans import customer as cust
from larkspur.queries import frames
from larkspur.queries.frames import text_dates
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import ASOF, KEPT, ZERO, with_parts
from larkspur.session import saved
from larkspur.sources import star
from larkspur.sources.star import ORDERS_ASOF, ORDERS_TODAY, TRAFFIC_ASOF, RegionConfig, load


@query(with_parts(["pop"], "SELECT * FROM pop"))
def population(spark: SparkSession, sf: str) -> DataFrame:
    return frames.pop(spark, sf)


@query(
    with_parts(
        ["target"],
        """
SELECT consumer_id, last_train_order_date::VARCHAR AS last_train_order_date,
  first_target_order_date::VARCHAR AS first_target_order_date, deactivated FROM target
""",
    )
)
def target_label(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(frames.target(spark, sf).drop("recency"))


_DATES = ("most_recent_order_date", "deact_date")


@query(with_parts(["order_feats"], f"SELECT * REPLACE ({', '.join(f'{c}::VARCHAR AS {c}' for c in _DATES)}) FROM order_feats"))
def order_features(spark: SparkSession, sf: str) -> DataFrame:
    fact = star.orders_fact(spark, sf, (months_before(ORDERS_ASOF, 24), as_date(ORDERS_ASOF)))
    return text_dates(cust.order_features(saved(fact, "orders-fact"), ORDERS_ASOF))


@query(
    with_parts(
        ["fact"],
        f"""
SELECT consumer_id, count(*) AS frequency_t24m, CAST(sum(units) AS BIGINT) AS units_t24m, round(sum(nor), 4) AS nor_t24m
FROM fact WHERE txn_amount <> 0 AND action IN ('F', 'O') AND order_date >= CAST({ASOF} - INTERVAL 24 MONTH AS DATE)
  AND order_date <= {ASOF} GROUP BY consumer_id
""",
    )
)
def order_features_region(spark: SparkSession, sf: str) -> DataFrame:
    region = RegionConfig("abroad", actions=("F", "O"))
    fact = star.orders_fact(spark, sf, (months_before(ORDERS_ASOF, 24), as_date(ORDERS_ASOF)))
    out = cust.order_features(saved(fact, "orders-fact"), ORDERS_ASOF, region)
    return out.select("consumer_id", "frequency_t24m", "units_t24m", "nor_t24m")


@query(
    with_parts(
        ["fact"],
        """
SELECT consumer_id, order_id AS most_recent_order_id, platform AS most_recent_platform, l1 AS most_recent_l1,
  promo_type AS most_recent_promo_type
FROM (SELECT *, row_number() OVER (PARTITION BY consumer_id ORDER BY order_timestamp DESC, order_id DESC) AS rnk FROM fact) WHERE rnk = 1
""",
    )
)
def order_latest_attrs(spark: SparkSession, sf: str) -> DataFrame:
    """Only headers are ranked; lines, summed per order where they lie, join the newest orders alone."""
    heads = star.order_headers(spark, sf)
    newest = cust.latest_attributes(heads, "consumer_id", ("order_id", "platform"), ("order_timestamp", "order_id"))
    lines = star.line_totals(spark, sf).select(F.col("order_id").alias("most_recent_order_id"), "l1", F.col("promo_type").alias("most_recent_promo_type"))
    return newest.join(lines, "most_recent_order_id", "left").select(
        "consumer_id",
        "most_recent_order_id",
        "most_recent_platform",
        F.coalesce("l1", F.lit("unknown")).alias("most_recent_l1"),
        "most_recent_promo_type",
    )


@query(with_parts(["next_orders"], "SELECT consumer_id, min_order_date::VARCHAR AS min_order_date, retained FROM next_orders"))
def response(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(cust.response(star.order_headers(spark, sf), frames.NEXT_DAY, ORDERS_TODAY))


def _dated(names: tuple[str, ...], table: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{c}::VARCHAR AS {c}' for c in names)}) FROM {table}"


@query(with_parts(["lifetime"], _dated(("first_purchase_date", "last_purchase_date"), "lifetime")))
def lifetime_orders(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(cust.lifetime_orders(star.order_headers(spark, sf), ORDERS_ASOF))


@query(with_parts(["cookie_visits"], _dated(("last_cookie_date",), "cookie_visits")))
def cookie_map_visits(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(cust.cookie_map_visits(frames.pop(spark, sf), star.visits(spark, sf), TRAFFIC_ASOF))


@query(with_parts(["cookie_orders"], _dated(("last_cookie_date",), "cookie_orders")))
def cookie_map_orders(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(cust.cookie_map_orders(frames.pop(spark, sf), star.order_headers(spark, sf), ORDERS_ASOF))


def _cookies(spark: SparkSession, sf: str) -> DataFrame:
    people = frames.pop(spark, sf)
    return cust.cookie_map(
        [
            cust.cookie_map_visits(people, star.visits(spark, sf), TRAFFIC_ASOF),
            cust.cookie_map_orders(people, star.order_headers(spark, sf), ORDERS_ASOF),
        ]
    )


@query(with_parts(["cookies"], _dated(("last_cookie_date",), "cookies")))
def cookie_map_union(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(_cookies(spark, sf))


@query(with_parts(["engaged"], _dated(("event_date",), "engaged")))
def engagement_by_cookie(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(cust.engagement_by_cookie(star.visits(spark, sf), TRAFFIC_ASOF))


@query(with_parts(["engagement"], _dated(("last_visit_date",), "engagement")))
def engagement_by_consumer(spark: SparkSession, sf: str) -> DataFrame:
    days = cust.engagement_by_cookie(star.visits(spark, sf), TRAFFIC_ASOF)
    return text_dates(cust.engagement_by_consumer(_cookies(spark, sf), days, TRAFFIC_ASOF))


@query(with_parts(["email"], _dated(("most_recent_open_date", "last_send_date"), "email")))
def email_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(cust.email_metrics(frames.pop(spark, sf), star.email_log(spark, sf), TRAFFIC_ASOF))


_IDS = ("brand", "consumer_id", *cust.SEGMENT_LABELS, "data_set")
_ALL = [*_IDS, *ZERO, *KEPT, "next_order_date", "deact_flag"]
_DATED = [c for c in _ALL if c.endswith("_date")]


def _feature_select(columns: list[str], table: str = "features") -> str:
    return f"SELECT {', '.join(f'{c}::VARCHAR AS {c}' if c in _DATED else c for c in columns)} FROM {table}"


@query(with_parts(["features"], _feature_select(_ALL)))
def features_all(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(frames.features(spark, sf).select(*_ALL))


@query(
    with_parts(
        ["features"],
        f"""
SELECT data_set, count(*) AS n, CAST(sum(deact_flag) AS BIGINT) AS deactivated, CAST(sum(frequency_t24m) AS BIGINT) AS orders,
  round(sum(gp_t24m), 4) AS gp FROM features WHERE data_set IN ('training', 'validation') GROUP BY data_set
""",
    )
)
def extract_split(spark: SparkSession, sf: str) -> DataFrame:
    both = cust.extract(frames.features(spark, sf), "training", "validation")
    return both.groupBy("data_set").agg(
        F.count("*").alias("n"),
        F.sum("deact_flag").cast("long").alias("deactivated"),
        F.sum("frequency_t24m").alias("orders"),
        F.round(F.sum("gp_t24m"), 4).alias("gp"),
    )


def _between(c: str, high: float, low: float | None = None) -> str:
    """``c`` within bounds; a null stays null."""
    inside = f"least({c}, {high})" if low is None else f"greatest(least({c}, {high}), {low})"
    return f"if({c} IS NULL, NULL, {inside})"


def _merged(c: str, to: str, *names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"if(list_contains([{listed}], {c}), '{to}', {c})"


_CAPPED = {
    **{c: _between(c, high) for c, high in cust.UPPER_CAPS.items()},
    **{c: _between(c, 400, -10.0) for c in ("gp_t12m", "gp_t24m")},
    **{f"{c}_recency": f"CAST({c}_recency > 0 IS TRUE AS INTEGER)" for c in ("click", "open", "send")},
    "unsubscription_30d": "CAST(unsubscription_30d > 0 IS TRUE AS INTEGER)",
    "cookies": "least(coalesce(cookies, 0), 15)",
    "visit_recency": f"coalesce({_between('visit_recency', 92)}, 100)",
    "tenure_days": "least(coalesce(round(tenure_days / 30, 0), 26), 26)",
    "most_recent_l1": _merged("most_recent_l1", "Local", "multi", "unknown"),
    "most_recent_l2": _merged("most_recent_l2", "other", "multi", "unknown", "L2 - Charity"),
    "most_recent_promo_type": f"coalesce({_merged('most_recent_promo_type', 'OD', 'ILS+OD', 'OD & WOW')}, 'organic')",
}


@query(
    with_parts(
        ["features"],
        "SELECT "
        + ", ".join(f"{_CAPPED[c]} AS {c}" if c in _CAPPED else (f"{c}::VARCHAR AS {c}" if c in _DATED else c) for c in _ALL)
        + " FROM features",
    )
)
def winsorize(spark: SparkSession, sf: str) -> DataFrame:
    return text_dates(cust.transformed(frames.features(spark, sf)).select(*_ALL))


@query(
    with_parts(
        ["features"],
        f"""
SELECT consumer_id, CASE WHEN date_diff('day', most_recent_order_date, last_visit_date) > 0
    THEN date_diff('day', most_recent_order_date, last_visit_date) ELSE 0 END AS gap_purchase_last_visit,
  date_diff('day', {ASOF}, deact_date) AS days_till_deactivation,
  coalesce(last_visit_date, most_recent_order_date - 90)::VARCHAR AS last_visit_date,
  coalesce(visit_recency, 90) AS visit_recency, coalesce(cookies, 1) AS cookies, coalesce(send_recency, 30) AS send_recency,
  coalesce(open_recency, 30) AS open_recency, coalesce(click_recency, 30) AS click_recency
FROM features WHERE deact_date IS NOT NULL AND tenure_days IS NOT NULL
""",
    )
)
def gap_features(spark: SparkSession, sf: str) -> DataFrame:
    out = cust.gap_features(frames.features(spark, sf), ORDERS_ASOF)
    return text_dates(
        out.select(
            "consumer_id",
            "gap_purchase_last_visit",
            "days_till_deactivation",
            "last_visit_date",
            "visit_recency",
            "cookies",
            "send_recency",
            "open_recency",
            "click_recency",
        )
    )


@query(
    with_parts(
        ["segments"],
        """
SELECT brand, consumer_id, user_key, recency_9block FROM segments
WHERE recency <= 365 AND country_id IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'EUROPE'))
""",
    )
)
def population_region(spark: SparkSession, sf: str) -> DataFrame:
    """The population of some regions; their country ids are configuration."""
    wanted = (
        load(spark, sf, "nation")
        .join(load(spark, sf, "region").where(F.col("r_name").isin("AMERICA", "EUROPE")), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey")
    )
    countries = tuple(row[0] for row in wanted.collect())  # the nation table is a fixed list
    region = RegionConfig("west", countries=countries)
    return cust.population(star.user_segments(spark, sf), region).select("brand", "consumer_id", "user_key", "recency_9block")

