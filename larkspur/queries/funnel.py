"""Funnel reports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from larkspur.plans import funnel
from larkspur.queries import frames
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import with_parts
from larkspur.sources import star

#: Measures of a shopper by subject; those of money are rounded.
_MEASURES = {
    "policy": ("policies", "policy_conversion", "policy_value"),
    "partner": ("partner_conversion", "partner_revenue"),
    "call": ("has_call", "long_calls", "calls"),
    "all": ("revenue", "marketing_cost"),
}
_MONEY = re.compile("value|revenue|cost")
_SUMS = ", ".join(
    f"round(sum({c}), 4) AS {c}" if _MONEY.search(c) else f"CAST(sum({c}) AS BIGINT) AS {c}" for names in _MEASURES.values() for c in names
)


def _out(df: DataFrame) -> DataFrame:
    return frames.text_dates(frames.round_all(df))


@query(
    with_parts(
        ["shoppers"],
        f"SELECT week_number, count(*) AS traffic, count(DISTINCT create_date) AS days, max(create_date)::VARCHAR AS period_ending, {_SUMS} FROM shoppers GROUP BY week_number",
    )
)
def weekly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _out(funnel.weekly(star.funnel(spark, sf)))


@query(
    with_parts(
        ["shoppers"], f"SELECT create_date::VARCHAR AS create_date, count(*) AS traffic, {_SUMS} FROM shoppers GROUP BY create_date"
    )
)
def daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _out(funnel.by_day(star.funnel(spark, sf)))


@query(
    with_parts(
        ["shoppers"],
        f"""
SELECT a.*, w.days, w.week_ending, k.marketing_category
FROM (SELECT marketing_source, week_number, count(*) AS traffic, {_SUMS} FROM shoppers GROUP BY 1, 2) a
JOIN (SELECT week_number, count(DISTINCT create_date) AS days, max(create_date)::VARCHAR AS week_ending FROM shoppers GROUP BY 1) w ON a.week_number = w.week_number
JOIN (SELECT marketing_source, CASE WHEN round(sum(marketing_cost), 4) = 0 THEN 'free' ELSE 'paid' END AS marketing_category FROM shoppers GROUP BY 1) k
  ON a.marketing_source = k.marketing_source
""",
    )
)
def channel_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return _out(funnel.channel_weekly(star.funnel(spark, sf)))


@query(
    with_parts(
        ["shoppers"],
        """
SELECT marketing_source, round(sum(marketing_cost), 4) AS marketing_cost,
  CASE WHEN round(sum(marketing_cost), 4) = 0 THEN 'free' ELSE 'paid' END AS marketing_category FROM shoppers GROUP BY 1
""",
    )
)
def channel_class(spark: SparkSession, sf: str) -> DataFrame:
    return _out(funnel.channel_class(star.funnel(spark, sf)))


# The steps of the report's time periods as (last day, label).
PERIODS = (("1996-05-26", "early"), ("1998-07-19", "salad"), ("2000-08-02", "july"))


@query(
    with_parts(
        ["shoppers"],
        f"""
SELECT CASE WHEN create_date <= DATE '1996-05-26' THEN 'early' WHEN create_date <= DATE '1998-07-19' THEN 'salad'
    WHEN create_date <= DATE '2000-08-02' THEN 'july' ELSE 'late' END AS time_period,
  count(*) AS traffic, count(DISTINCT create_date) AS days, max(create_date)::VARCHAR AS period_ending, {_SUMS} FROM shoppers GROUP BY 1
""",
    )
)
def period_rollup(spark: SparkSession, sf: str) -> DataFrame:
    daily = funnel.by_day(star.funnel(spark, sf))
    return _out(funnel.roll_up(funnel.time_period(daily, PERIODS, "late"), ["time_period"]))


@query(
    with_parts(
        ["shoppers"],
        """
SELECT calls, long_calls, count(*) AS shoppers, CAST(sum(policy_conversion) AS BIGINT) AS policy_conversion,
  CAST(sum(policies) AS BIGINT) AS policies, round(sum(policy_value), 4) AS policy_value
FROM (SELECT least(calls, 6) AS calls, least(long_calls, 6) AS long_calls, policy_conversion, policies, policy_value FROM shoppers WHERE calls > 0)
WHERE calls >= long_calls GROUP BY 1, 2
""",
    )
)
def call_table(spark: SparkSession, sf: str) -> DataFrame:
    return _out(funnel.call_table(star.funnel(spark, sf)))


_KPI = """
  round(conversion, 6)::BIGINT AS conversion, round((revenue - marketing_cost) / nullif(marketing_cost, 0), 6) AS roi,
  round(marketing_cost / nullif(conversion, 0), 6) AS aq_cost, round(revenue / nullif(conversion, 0), 6) AS revenue_aq
"""


@query(
    with_parts(
        ["shoppers"],
        f"""
SELECT marketing_source, traffic, {_KPI}, round(has_call / traffic, 6) AS call_rate
FROM (SELECT marketing_source, count(*) AS traffic, {_SUMS}, sum(policy_conversion) + sum(partner_conversion) AS conversion FROM shoppers GROUP BY 1)
""",
    )
)
def kpi_ratios(spark: SparkSession, sf: str) -> DataFrame:
    daily = funnel.by_day(star.funnel(spark, sf), ["marketing_source"])
    out = funnel.kpis(funnel.roll_up(daily, ["marketing_source"]))
    return _out(out.select("marketing_source", "traffic", "conversion", "roi", "aq_cost", "revenue_aq", "call_rate"))


_W7 = "ORDER BY create_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"


@query(
    with_parts(
        ["shoppers"],
        f"""
SELECT create_date::VARCHAR AS create_date, {', '.join(f'round(CASE WHEN count({c}) OVER ({_W7}) = 7 THEN avg({c}) OVER ({_W7}) END, 6) AS {c}_ma' for c in ('roi', 'aq_cost', 'revenue_aq'))}
FROM (SELECT create_date, (revenue - marketing_cost) / nullif(marketing_cost, 0) AS roi, marketing_cost / nullif(conversion, 0) AS aq_cost,
    revenue / nullif(conversion, 0) AS revenue_aq
  FROM (SELECT create_date, {_SUMS}, sum(policy_conversion) + sum(partner_conversion) AS conversion FROM shoppers GROUP BY 1))
""",
    )
)
def kpi_moving_average(spark: SparkSession, sf: str) -> DataFrame:
    out = funnel.smoothed_kpis(funnel.by_day(star.funnel(spark, sf)))
    return _out(out.select("create_date", "roi_ma", "aq_cost_ma", "revenue_aq_ma"))
