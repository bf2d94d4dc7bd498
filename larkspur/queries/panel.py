"""Weekly trend panel and its steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.operators import series
from larkspur.plans import panel
from larkspur.queries import frames
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import SPAN, with_parts
from larkspur.sources import star

M = panel.MEASURES


def _out(df: DataFrame) -> DataFrame:
    return frames.text_dates(frames.round_all(df))


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    return panel.weekly_panel(star.cumulative_panel(spark, sf), *SPAN)


@query(with_parts(["panel"], "SELECT geo_id, date::VARCHAR AS date, cases, deaths, hospitalized, tested FROM panel WHERE entry = 1"))
def dedupe_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    raw = star.cumulative_panel(spark, sf)
    return _out(series.dedupe_first(raw, ["geo_id", "date"], "entry").drop("entry"))


@query(with_parts(["panel"], "SELECT geo_id, date::VARCHAR AS date, count(*) AS n FROM panel GROUP BY geo_id, date HAVING count(*) > 1"))
def repeated_entries(spark: SparkSession, sf: str) -> DataFrame:
    return _out(series.repeated(star.cumulative_panel(spark, sf), ["geo_id", "date"]))


@query(with_parts(["filled"], "SELECT geo_id, date::VARCHAR AS date, cases, deaths, hospitalized, tested FROM filled"))
def forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    return _out(panel.clean_panel(star.cumulative_panel(spark, sf)).drop("entry"))


@query(
    with_parts(
        ["filled"],
        f"""
SELECT geo_id, date::VARCHAR AS date, cases, deaths, hospitalized, tested FROM filled
WHERE isodow(date) = 6 AND date BETWEEN DATE '{SPAN[0]}' AND DATE '{SPAN[1]}'
""",
    )
)
def saturday_sample(spark: SparkSession, sf: str) -> DataFrame:
    clean = panel.clean_panel(star.cumulative_panel(spark, sf)).drop("entry")
    return _out(series.weekday_rows(clean, "date", panel.SATURDAY, *SPAN))


@query(with_parts(["weekly"], "SELECT geo_id, date::VARCHAR AS date, cases, new_cases, new_deaths, new_hospitalized, new_tested FROM weekly"))
def cumulative_to_new(spark: SparkSession, sf: str) -> DataFrame:
    return _out(_weekly(spark, sf).select("geo_id", "date", "cases", *[f"new_{m}" for m in M]))


def _change_sql(c: str, from_zero: str) -> str:
    return (
        f"coalesce({c} - p_{c}, 0) AS {c}_wow, round(CASE WHEN p_{c} IS NULL THEN 0 WHEN p_{c} = 0 AND {c} = 0 THEN 0 "
        f"WHEN p_{c} = 0 THEN {from_zero} ELSE ({c} - p_{c}) / p_{c} END, 6)::DOUBLE AS {c}_wow_pct"
    )


@query(
    with_parts(
        ["weekly"],
        f"""
SELECT geo_id, date::VARCHAR AS date, {_change_sql('new_cases', '1.0')}, {_change_sql('new_deaths', '1.0')}
FROM (SELECT *, lag(new_cases) OVER (PARTITION BY geo_id ORDER BY date) AS p_new_cases,
  lag(new_deaths) OVER (PARTITION BY geo_id ORDER BY date) AS p_new_deaths FROM weekly)
""",
    )
)
def wow_change(spark: SparkSession, sf: str) -> DataFrame:
    out = series.change(_weekly(spark, sf), ["new_cases", "new_deaths"], "geo_id", "date")
    return _out(out.select("geo_id", "date", *[c for c in out.columns if "_wow" in c]))


@query(
    with_parts(
        ["weekly"],
        """
SELECT geo_id, date, change, CASE WHEN change > -1 AND change <= -0.5 THEN '-100% to -50%' WHEN change > -0.5 AND change <= -0.05 THEN '-50% to -5%'
  WHEN change > -0.05 AND change <= 0.05 THEN 'no change' WHEN change > 0.05 AND change <= 0.5 THEN '5% to 50%'
  WHEN change > 0.5 AND change <= 1 THEN '50% to 100%' WHEN change > 1 THEN '100%+' END AS change_class
FROM (SELECT geo_id, date::VARCHAR AS date, round(CASE WHEN p IS NULL THEN 0 WHEN p = 0 AND new_deaths = 0 THEN 0 WHEN p = 0 THEN 110
    ELSE (new_deaths - p) / p END, 6)::DOUBLE AS change
  FROM (SELECT *, lag(new_deaths) OVER (PARTITION BY geo_id ORDER BY date) AS p FROM weekly))
""",
    )
)
def wow_change_param(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.simple_change(_weekly(spark, sf), "new_deaths", "geo_id", "date", 110.0, "change")
    return _out(out.select("geo_id", "date", "change", "change_class"))


@query(
    with_parts(
        ["weekly"],
        """
SELECT geo_id, date::VARCHAR AS date, round(if(p IS NULL OR (p = 0 AND new_cases = 0), 0, if(p = 0, 100, (new_cases - p) / p)), 6)::DOUBLE AS change
FROM (SELECT *, lag(new_cases) OVER (PARTITION BY geo_id ORDER BY date) AS p FROM weekly)
""",
    )
)
def wow_change_cases(spark: SparkSession, sf: str) -> DataFrame:
    """The same rule for cases, where a rise from zero counts as 100."""
    return _out(panel.simple_change(_weekly(spark, sf), "new_cases", "geo_id", "date", 100.0, "change").select("geo_id", "date", "change"))


_ROLL = "PARTITION BY geo_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW"


def _mean_sql(c: str) -> str:
    return f"CASE WHEN count({c}) OVER ({_ROLL}) = 4 THEN avg({c}) OVER ({_ROLL}) END"


def _slope_sql(c: str) -> str:
    return f"CASE WHEN count({c}) OVER ({_ROLL}) = 4 THEN regr_slope({c}, rn) OVER ({_ROLL}) END"


@query(
    with_parts(["weekly"], f"SELECT geo_id, date::VARCHAR AS date, round({_mean_sql('new_cases')}, 6) AS new_cases_4w_ma FROM weekly")
)
def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    out = series.rolling_mean(_weekly(spark, sf), ["new_cases"], "geo_id", "date", 4, "_4w_ma")
    return _out(out.select("geo_id", "date", "new_cases_4w_ma"))


@query(
    with_parts(
        ["weekly"],
        f"""
SELECT geo_id, date::VARCHAR AS date, round({_slope_sql('new_cases')}, 6) AS new_cases_4w_linear
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY geo_id ORDER BY date) AS DOUBLE) AS rn FROM weekly)
""",
    )
)
def rolling_slope(spark: SparkSession, sf: str) -> DataFrame:
    out = series.rolling_slope(_weekly(spark, sf), ["new_cases"], "geo_id", "date", 4, "_4w_linear")
    return _out(out.select("geo_id", "date", "new_cases_4w_linear"))


@query(
    with_parts(
        ["weekly"],
        f"""
SELECT geo_id, date::VARCHAR AS date, round(new_cases - lag(ma) OVER (PARTITION BY geo_id ORDER BY date), 6) AS new_cases_anomaly
FROM (SELECT *, {_mean_sql('new_cases')} AS ma FROM weekly)
""",
    )
)
def rolling_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    out = series.rolling_anomaly(_weekly(spark, sf), ["new_cases"], "geo_id", "date", 4, "_4w_ma", "_anomaly")
    return _out(out.select("geo_id", "date", "new_cases_anomaly"))


_NEW = [f"new_{m}" for m in M]


@query(
    with_parts(
        ["weekly"],
        f"""
SELECT geo_id, date::VARCHAR AS date, {', '.join(M)}, {', '.join(_NEW)}, {', '.join(_change_sql(c, '1.0') for c in _NEW)},
  {', '.join(f'round({c}_sl, 6) AS {c}_4w_linear' for c in _NEW)}, {', '.join(f'round({c}_ma, 6) AS {c}_4w_ma' for c in _NEW)},
  {', '.join(f'round({c} - lag({c}_ma) OVER (PARTITION BY geo_id ORDER BY date), 6) AS {c}_anomaly' for c in _NEW)}
FROM (SELECT *, {', '.join(f'{_mean_sql(c)} AS {c}_ma, {_slope_sql(c)} AS {c}_sl, lag({c}) OVER (PARTITION BY geo_id ORDER BY date) AS p_{c}' for c in _NEW)}
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY geo_id ORDER BY date) AS DOUBLE) AS rn FROM weekly))
""",
    )
)
def trend_panel(spark: SparkSession, sf: str) -> DataFrame:
    return _out(panel.trend_panel(star.cumulative_panel(spark, sf), *SPAN).drop("entry"))
