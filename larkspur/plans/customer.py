"""Customer features as of a day: population, orders, identity map, engagement,
e-mail, and the joined feature table.

Every step ends in one row per consumer (or per consumer and cookie), reached by
map-side reducible aggregates. The final star join therefore joins tables that are
unique on the same key.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.dates import as_date, days_before, months_before, quarter_bit
from larkspur.functions.hashing import split_label
from larkspur.functions.numeric import cap, presence_flag
from larkspur.operators.joins import sliced_join, union_latest
from larkspur.session import saved
from larkspur.sources.star import EVERYWHERE, RegionConfig

# The segment labels, and among them the recency classes of a consumer who is still active.
ACTIVE_CLASSES = ("1-High Rec (0-30 Days)", "2-Med Rec (31-120 Days)", "3-Low Rec (121-365 Days)")
SEGMENT_LABELS = {
    "recency_segment": ("active", "inactive", "lapsing"),
    "frequency_segment": ("repeat", "single"),
    "recency_9block": (*ACTIVE_CLASSES, "4-Inactive (366+ Days)"),
    "frequency_9block": ("1-Low Freq (1 Order)", "2-Med Freq (2-4 Orders)", "3-High Freq (5+ Orders)"),
}
SPLIT = (("training", 66), ("validation", 34))


def population(segments: DataFrame, region: RegionConfig = EVERYWHERE, carried: Sequence[str] = ()) -> DataFrame:
    """Active consumers, one row per brand, consumer and user key. ``carried`` columns are
    numbers or dates that are the same on all rows of a consumer."""
    pop = segments.where(F.col("recency_9block").isin(*ACTIVE_CLASSES))
    if region.countries is not None:
        pop = pop.where(F.col("country_id").isin(*region.countries))
    keys = ("brand", "consumer_id", "user_key")
    low = pop.groupBy(*keys).agg(
        *[F.min(label_place(c, v)).alias(c) for c, v in SEGMENT_LABELS.items()], *[F.max(c).alias(c) for c in carried]
    )
    names = {c: F.array(*map(F.lit, sorted(v)))[F.col(c)] for c, v in SEGMENT_LABELS.items()}
    return low.select(*keys, *[v.alias(c) for c, v in names.items()], *carried)


HISTORY = ("first_purchase_date", "last_purchase_date", "lt_orders", "min_order_date")


def people(segments: DataFrame, asof: str) -> DataFrame:
    """Population with the lifetime orders and the first order of the outcome period that ``order_history`` found."""
    out = population(segments, carried=HISTORY)
    out = out.withColumn("tenure_days", F.datediff(as_date(asof), "first_purchase_date"))
    return out.withColumn("lt_orders", F.when(F.col("lt_orders") > 0, F.col("lt_orders")))


def label_place(column: str, labels: Sequence[str]) -> Column:
    """Place of a label among its sorted kind: a number keeps a minimum in the hash
    aggregate, where text would be sorted. Null stays null; an unknown label raises."""
    known = {v: i for i, v in enumerate(sorted(labels))}
    place = F.lit(None).cast("int")
    for v, i in known.items():
        place = F.when(F.col(column) == v, i).otherwise(place)
    strange = F.raise_error(F.concat(F.lit(f"unknown {column}: "), F.col(column))).cast("int")
    return F.when(F.col(column).isNull() | F.col(column).isin(*known), place).otherwise(strange)


def in_scope(orders: DataFrame, region: RegionConfig = EVERYWHERE) -> DataFrame:
    out = orders.where(F.col("txn_amount") != 0)
    return out.where(F.col("action").isin(*region.actions)) if region.actions is not None else out


def target_label(recency: DataFrame, orders: DataFrame, asof: str, today: str) -> DataFrame:
    """Did the consumer order again within a year of the last order? No later
    order counts as deactivated."""
    future = (
        orders.where((F.col("order_date") > as_date(asof)) & (F.col("order_date") < as_date(today)))
        .groupBy("consumer_id")
        .agg(F.min("order_date").alias("first_target_order_date"))
    )
    last = recency.select("consumer_id", F.date_sub(as_date(asof), F.col("recency")).alias("last_train_order_date"))
    again = F.col("first_target_order_date") <= F.date_add("last_train_order_date", 365)
    return last.join(future, "consumer_id", "left").withColumn("deactivated", F.when(again, 0).otherwise(1))


LATEST = ("is_activation", "is_reactivation", "order_id", "nob", "l1", "l2", "traffic_type", "traffic_source", "platform", "promo_type")


#: Orders counted per value of an attribute, with the name of the count.
ORDER_KINDS = {
    "l1": {f"L1 - {name.title()}": name for name in ("local", "shopping", "travel")},
    "platform": {name: name for name in ("app", "touch", "web")},
    "traffic_type": {name.title(): name for name in ("paid", "free", "managed")},
}
NEWEST = "__newest"


def arrival(orders: DataFrame, time: str, id: str) -> Column:
    """(time, id) as one number of fixed width that sorts like the pair: microseconds
    since 1970, then the id in 64 bits. Its maximum stays in the hash aggregate, while a
    maximum of pairs or of text sorts its input. Missing times and ids come first."""
    at = F.col(time).cast("timestamp_ntz")
    if orders.schema[time].dataType.typeName() == "timestamp":
        micros = F.unix_micros(time)
    else:  # without a time zone, so that no zone can fold two hours into one
        seconds = F.hour(at) * 3600 + F.minute(at) * 60 + F.extract(F.lit("SECOND"), at)
        micros = F.unix_date(at.cast("date")) * F.lit(86_400_000_000) + (seconds * 1_000_000).cast("long")
    micros = F.coalesce(micros, F.lit(-(10**17))).cast("decimal(18,0)")
    place = F.coalesce(F.col(id).cast("long"), F.lit(-(1 << 63))).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))
    return (micros * F.lit(Decimal(1 << 64)) + place).cast("decimal(38,0)")


def latest_attributes(orders: DataFrame, key: str, columns: Sequence[str], order: tuple[str, str], details: DataFrame | None = None) -> DataFrame:
    """Attributes of the newest row per key, by (time, id): the maximum of one number
    per key in a hash aggregate, then a join back to the one row that has it. A key with a
    large share of the rows is reduced before the shuffle, and the join's key is unique.

    ``details`` may hold the columns apart from the rows that are ranked, under the same key, time and id; then
    ``orders`` can be a slim table. (time, id) should name one row of a key; equal rows are one.
    """
    stamped = orders.select(key, arrival(orders, *order).alias(NEWEST))
    newest = stamped.groupBy(key).agg(F.max(NEWEST).alias(NEWEST))
    details = orders if details is None else details
    rows = details.select(key, arrival(details, *order).alias(NEWEST), *[F.col(c).alias(f"most_recent_{c}") for c in columns])
    return newest.join(rows, [key, NEWEST]).drop(NEWEST).distinct()


def order_features(orders: DataFrame, asof: str, region: RegionConfig = EVERYWHERE, incentives: DataFrame | None = None) -> DataFrame:
    """Counts, money and the newest order over the last 24 and 12 months. ``orders`` is
    read three times, for the sums, the newest times and the newest rows; a joined table is best written first."""
    scoped = in_scope(orders, region).where(
        (F.col("order_date") >= months_before(asof, 24)) & (F.col("order_date") <= as_date(asof))
    )
    if incentives is not None:
        scoped = scoped.drop("promo_type", "wow_discount").join(incentives, "order_id", "left")
    scoped = scoped.withColumn(NEWEST, arrival(scoped, "order_timestamp", "order_id"))
    year = F.when(F.col("order_date") >= months_before(asof, 12), 1).otherwise(0)
    count_if = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    money = ("nob", "nor", "gp", "discount_amount", "ils_discount", "wow_discount")
    signed = {"discount_amount": -F.coalesce("discount_amount", F.lit(0.0)), "wow_discount": F.coalesce("wow_discount", F.lit(0.0))}
    value = lambda c: signed.get(c, F.col(c))
    out = scoped.groupBy("consumer_id").agg(
        F.max("order_date").alias("most_recent_order_date"),
        F.count("*").alias("frequency_t24m"),
        F.sum("units").alias("units_t24m"),
        *[F.round(F.sum(value(c)), 4).alias(f"{c}_t24m") for c in money],
        F.sum(year).alias("frequency_t12m"),
        F.coalesce(F.sum(year * F.col("units")), F.lit(0)).alias("units_t12m"),
        *[F.round(F.coalesce(F.sum(year * value(c)), F.lit(0.0)), 4).alias(f"{c}_t12m") for c in money],
        *[count_if(F.col(c) == v).alias(f"{name}_orders_t24m") for c, names in ORDER_KINDS.items() for v, name in names.items()],
        F.bit_or(quarter_bit(F.col("order_date"), asof)).alias("quarters"),
    )
    out = out.withColumn("unique_purchase_quarters", F.bit_count("quarters").cast("long")).drop("quarters")
    named = lambda c: c if c.startswith("is_") else "most_recent_order_price" if c == "nob" else f"most_recent_{c}"
    # slim rows look for the newest orders, and the wide ones stay with their consumer, where the writer wants them
    last = scoped.groupBy("consumer_id").agg(F.max(NEWEST).alias(NEWEST))
    newest = last.join(scoped.select("consumer_id", NEWEST, *[F.col(c).alias(named(c)) for c in LATEST]), ["consumer_id", NEWEST]).distinct()
    return (
        out.join(newest.drop(NEWEST), "consumer_id")
        .withColumn("recency", F.datediff(as_date(asof), "most_recent_order_date"))
        .withColumn("deact_date", F.date_add("most_recent_order_date", 365))
    )


def response(orders: DataFrame, start: str, end: str, region: RegionConfig = EVERYWHERE) -> DataFrame:
    """First order of the outcome period."""
    return (
        in_scope(orders, region)
        .where((F.col("order_date") >= as_date(start)) & (F.col("order_date") < as_date(end)))
        .groupBy("consumer_id")
        .agg(F.min("order_date").alias("min_order_date"), F.lit(1).alias("retained"))
    )


def lifetime_orders(orders: DataFrame, asof: str, region: RegionConfig = EVERYWHERE) -> DataFrame:
    return (
        in_scope(orders, region)
        .where(F.col("order_date") <= as_date(asof))
        .groupBy("consumer_id")
        .agg(
            F.min("order_date").alias("first_purchase_date"),
            F.max("order_date").alias("last_purchase_date"),
            F.count_distinct("order_id").alias("lt_orders"),
        )
        .withColumn("tenure_days", F.datediff(as_date(asof), "first_purchase_date"))
    )


def order_history(orders: DataFrame, asof: str, today: str, region: RegionConfig = EVERYWHERE) -> DataFrame:
    """What segments, lifetime orders and the outcome need, from one pass over the orders: they are
    reduced per order, which counts repeated rows once, and then per consumer."""
    day, past = F.col("order_date"), F.col("order_date") <= as_date(asof)
    scoped = F.col("txn_amount") != 0
    if region.actions is not None:
        scoped &= F.col("action").isin(*region.actions)
    future = (day > as_date(asof)) & (day < as_date(today))
    per_order = orders.where(day < as_date(today)).groupBy("consumer_id", "order_id").agg(
        F.max(F.when(past, day)).alias("last_order"),
        F.sum(F.when(past & (day > days_before(asof, 365)), 1).otherwise(0)).alias("orders_365d"),
        F.min(F.when(past & scoped, day)).alias("first_purchase_date"),
        F.max(F.when(past & scoped, day)).alias("last_purchase_date"),
        F.min(F.when(future & scoped, day)).alias("min_order_date"),
    )
    return per_order.groupBy("consumer_id").agg(
        F.max("last_order").alias("last_order"),
        F.sum("orders_365d").alias("orders_365d"),
        F.min("first_purchase_date").alias("first_purchase_date"),
        F.max("last_purchase_date").alias("last_purchase_date"),
        F.count("first_purchase_date").alias("lt_orders"),
        F.min("min_order_date").alias("min_order_date"),
    )


def _of_population(rows: DataFrame, pop: DataFrame | None) -> DataFrame:
    """Keep the population's consumers. Steps that end in a left join from the
    population pass None: the join would only repeat that work."""
    return rows if pop is None else rows.join(pop.select("consumer_id").distinct(), "consumer_id")


def cookie_map_visits(pop: DataFrame | None, visits: DataFrame, asof: str) -> DataFrame:
    """Cookies seen in three months of visits, reduced per pair before the join."""
    pairs = (
        visits.where(F.col("event_date").between(months_before(asof, 3), as_date(asof)))
        .groupBy(F.col("user_uuid").alias("consumer_id"), "cookie")
        .agg(F.max("event_date").alias("last_cookie_date"))
    )
    return _of_population(pairs, pop)


def cookie_map_orders(
    pop: DataFrame | None, orders: DataFrame, asof: str, region: RegionConfig = EVERYWHERE
) -> DataFrame:
    """Cookies seen in 24 months of orders."""
    scoped = orders if region.actions is None else orders.where(F.col("action").isin(*region.actions))
    pairs = (
        scoped.where(F.col("order_date").between(months_before(asof, 24), as_date(asof)))
        .groupBy("consumer_id", "cookie")
        .agg(F.max("order_date").alias("last_cookie_date"))
    )
    return _of_population(pairs, pop)


def cookie_map(maps: Sequence[DataFrame]) -> DataFrame:
    return union_latest(maps, ["consumer_id", "cookie"], "last_cookie_date")


PLATFORMS = ("App", "Web", "Touch")
WINDOWS = (7, 14, 28)


def engagement_by_cookie(visits: DataFrame, asof: str) -> DataFrame:
    """Days with a visit per cookie, over 90 days and shorter spans.

    Rows are first reduced to one per cookie, day and platform, which replaces
    seven distinct counts (and their row expansion) by plain sums.
    """
    day = (
        visits.where(F.col("event_date").between(months_before(asof, 3), as_date(asof)))
        .groupBy("cookie", "event_date")
        .agg(
            F.sum("deal_views").alias("views"),
            *[F.max(F.when(F.col("platform") == p, 1).otherwise(0)).alias(f"on_{p}") for p in PLATFORMS],
        )
    )
    recent = lambda n: F.when(F.col("event_date") >= days_before(asof, n), 1).otherwise(0)
    return day.groupBy("cookie").agg(
        F.max("event_date").alias("event_date"),
        F.count("*").alias("visit_freq_90d"),
        *[F.sum(recent(n)).alias(f"visit_freq_{n}d") for n in WINDOWS],
        F.sum("views").alias("deal_views_90d"),
        *[F.sum(f"on_{p}").alias(f"{p.lower()}_frequency") for p in PLATFORMS],
    )


ENGAGEMENT_SUMS = (
    "deal_views_90d",
    *(f"{p.lower()}_frequency" for p in PLATFORMS),
    *(f"visit_freq_{n}d" for n in (*WINDOWS, 90)),
)


def engagement_by_consumer(cookies: DataFrame, engagement: DataFrame, asof: str) -> DataFrame:
    """Cookie engagement summed per consumer. A cookie shared by very many
    consumers makes its join key hot, so the map side is cut into slices. Finding
    the hot keys reads the map twice, hence it is written first. The map is unique
    per pair, so counting its rows counts distinct cookies."""
    joined = sliced_join(saved(cookies, "cookies"), engagement, ["cookie"], F.col("consumer_id"))
    return (
        joined.groupBy("consumer_id")
        .agg(
            F.max("event_date").alias("last_visit_date"),
            *[F.sum(c).alias(c) for c in ENGAGEMENT_SUMS],
            F.count("*").alias("cookies"),
        )
        .withColumn("visit_recency", F.datediff(as_date(asof), "last_visit_date"))
    )


def email_metrics(pop: DataFrame | None, log: DataFrame, asof: str) -> DataFrame:
    """Sends, opens and clicks over 7 and 30 days. The log is reduced per consumer
    and send, then per consumer, before it meets the population."""
    scoped = log.where(
        F.col("send_date").between(days_before(asof, 30), as_date(asof)) & (F.col("business_group") != "transactional")
    )
    week = F.col("send_date") >= days_before(asof, 7)
    count_if = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    per_send = scoped.groupBy(F.col("user_uuid").alias("consumer_id"), "send_id").agg(
        F.max("send_date").alias("last_send"),
        F.max(F.when(F.col("opens") >= 1, F.col("send_date"))).alias("last_open"),
        F.max(F.when(F.col("clicks") >= 1, F.col("send_date"))).alias("last_click"),
        F.max(F.when(week, 1).otherwise(0)).alias("in_week"),
        count_if(week & (F.col("opens") >= 1)).alias("opens_7d"),
        count_if(F.col("opens") >= 1).alias("opens_30d"),
        count_if(week & (F.col("clicks") >= 1)).alias("clicks_7d"),
        count_if(F.col("clicks") >= 1).alias("clicks_30d"),
        count_if(F.col("unsubs") >= 1).alias("unsubs"),
    )
    since = lambda c: F.datediff(as_date(asof), F.max(c))
    per_consumer = per_send.groupBy("consumer_id").agg(
        since("last_send").alias("send_recency"),
        F.sum("in_week").alias("sends_7d"),
        F.count("*").alias("sends_30d"),
        since("last_open").alias("open_recency"),
        F.max("last_open").alias("most_recent_open_date"),
        F.sum("opens_7d").alias("uniq_opens_7d"),
        F.sum("opens_30d").alias("uniq_opens_30d"),
        since("last_click").alias("click_recency"),
        F.sum("clicks_7d").alias("uniq_clicks_7d"),
        F.sum("clicks_30d").alias("uniq_clicks_30d"),
        F.sum("unsubs").alias("unsubscription_30d"),
        F.max("last_send").alias("last_send_date"),
    )
    return _of_population(per_consumer, pop)


#: Sums that are 0 for a consumer without a row in their step: measures by their windows and kinds.
ZERO_FILLED = (
    *(f"{measure}_t{months}m" for months in (12, 24) for measure in ("frequency", "gp", "nob")),
    *(f"{kind}_orders_t24m" for column in ("l1", "platform") for kind in ORDER_KINDS[column].values()),
    *ENGAGEMENT_SUMS,
    *(f"{mail}_{days}d" for days in (7, 30) for mail in ("sends", "uniq_clicks", "uniq_opens")),
    "unsubscription_30d",
)


STEPS = ("orders", "engagement", "email")


def all_features(joined: DataFrame, labelled: bool = True) -> DataFrame:
    """Population with every feature table; sums that miss become 0, dates and
    recencies that miss stay null. ``labelled`` adds the label from the outcome period."""
    out = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO_FILLED})
    out = out.withColumn("data_set", split_label(F.col("consumer_id"), SPLIT))
    if labelled:
        out = out.withColumnRenamed("min_order_date", "next_order_date")
        out = out.withColumn("deact_flag", 1 - F.when(F.col("next_order_date") <= F.col("deact_date"), 1).otherwise(0))
    return out


# Upper caps of the transformed scoring table.
UPPER_CAPS = {
    "recency": 365,
    "frequency_t24m": 46,
    "nob_t24m": 2000,
    "frequency_t12m": 30,
    "nob_t12m": 1100,
    "local_orders_t24m": 31,
    "shopping_orders_t24m": 31,
    "travel_orders_t24m": 31,
    "app_orders_t24m": 31,
    "touch_orders_t24m": 31,
    "web_orders_t24m": 31,
    "visit_freq_90d": 90,
    "visit_freq_7d": 8,
    "visit_freq_14d": 14,
    "visit_freq_28d": 28,
    "deal_views_90d": 220,
    "app_frequency": 90,
    "web_frequency": 90,
    "touch_frequency": 90,
    "sends_7d": 45,
    "sends_30d": 175,
    "uniq_opens_7d": 36,
    "uniq_opens_30d": 120,
    "uniq_clicks_7d": 7,
    "uniq_clicks_30d": 30,
}
# Two-sided caps, tenure in months, replacements for missing values.
GP_CAPS = (-10.0, 400.0)
MAX_TENURE_MONTHS = 26
VISIT_RECENCY_CAP, VISIT_RECENCY_MISSING = 92, 100
MAX_COOKIES = 15
# Labels merged into another label.
L1_MERGE = {"unknown": "Local", "multi": "Local"}
L2_MERGE = {"L2 - Charity": "other", "multi": "other", "unknown": "other"}
PROMO_MERGE = {"OD & WOW": "OD", "ILS+OD": "OD"}
PROMO_MISSING = "organic"


def relabel(df: DataFrame, column: str, merge: dict[str, str], missing: str | None = None) -> DataFrame:
    out = F.col(column)
    for old, new in merge.items():
        out = F.when(F.col(column) == old, new).otherwise(out)
    return df.withColumn(column, F.coalesce(out, F.lit(missing)) if missing is not None else out)


def transformed(features: DataFrame) -> DataFrame:
    """Capped, relabelled and flagged scoring table."""
    months = F.round(F.col("tenure_days") / 30)
    out = features.withColumns({c: cap(F.col(c), high=v) for c, v in UPPER_CAPS.items()})
    out = out.withColumns(
        {
            "tenure_days": F.when(months <= MAX_TENURE_MONTHS, months).otherwise(float(MAX_TENURE_MONTHS)),
            "gp_t24m": cap(F.col("gp_t24m"), *GP_CAPS),
            "gp_t12m": cap(F.col("gp_t12m"), *GP_CAPS),
            "visit_recency": F.coalesce(cap(F.col("visit_recency"), high=VISIT_RECENCY_CAP), F.lit(VISIT_RECENCY_MISSING)),
            "cookies": F.coalesce(cap(F.col("cookies"), high=MAX_COOKIES), F.lit(0)),
            **{c: presence_flag(F.col(c)) for c in ("send_recency", "open_recency", "click_recency", "unsubscription_30d")},
        }
    )
    out = relabel(out, "most_recent_l1", L1_MERGE)
    out = relabel(out, "most_recent_l2", L2_MERGE)
    return relabel(out, "most_recent_promo_type", PROMO_MERGE, PROMO_MISSING)


def extract(features: DataFrame, *data_sets: str) -> DataFrame:
    """Rows of the named data sets."""
    return features.where(F.col("data_set").isin(*data_sets))


# Replacements for missing recencies in the second model's features.
MODEL_FILL = {"visit_recency": 90, "cookies": 1, "send_recency": 30, "open_recency": 30, "click_recency": 30}


def gap_features(features: DataFrame, asof: str) -> DataFrame:
    """Gap between the last visit and the last purchase (not below 0) and days
    until deactivation; rows without either date are left out."""
    last = F.col("most_recent_order_date")
    out = features.dropna(subset=["deact_date", "tenure_days"])
    gap = F.datediff("last_visit_date", last)
    return out.withColumns(
        {
            "gap_purchase_last_visit": F.when(gap > 0, gap).otherwise(0),
            "days_till_deactivation": F.datediff("deact_date", as_date(asof)),
            "last_visit_date": F.coalesce("last_visit_date", F.date_sub(last, 90)),
        }
    ).na.fill(MODEL_FILL)
