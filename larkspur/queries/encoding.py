"""Feature encoders: fitted on the training rows, applied to all rows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.hashing import split_label
from larkspur.operators import encode
from larkspur.plans import housing, passengers
from larkspur.queries import frames
from larkspur.queries.registry import query
from larkspur.queries.sqlparts import with_parts
from larkspur.sources.star import load

SHARES = (("train", 90), ("test", 10))


def _houses(spark: SparkSession, sf: str) -> DataFrame:
    df = housing.houses(load(spark, sf, "part"))
    return df.withColumn("part", split_label(F.col("id"), SHARES))


def _train(df: DataFrame) -> DataFrame:
    return df.where(F.col("part") == "train")


@query(
    """
SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS idx
FROM (SELECT p_brand AS label, count(*) AS n FROM part GROUP BY p_brand)
"""
)
def string_index(spark: SparkSession, sf: str) -> DataFrame:
    return encode.string_index(load(spark, sf, "part"), "p_brand")


@query(
    """
SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS "c_mktsegment_AUTOMOBILE", CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS "c_mktsegment_BUILDING",
  CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS "c_mktsegment_FURNITURE", CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS "c_mktsegment_HOUSEHOLD",
  CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS "c_mktsegment_MACHINERY" FROM customer
"""
)
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """One column per label through the fitted index and one-hot vector."""
    df = load(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("c_mktsegment_cat_x"))
    model = encode.fit_one_hot(df)
    names = encode.feature_names(model, [])
    slots = vector_to_array(F.col("c_mktsegment_vec_x"))
    known = [(i, n) for i, n in enumerate(names) if not n.endswith(("_unknown", "_invalid"))]
    out = model.transform(df)
    return out.select("c_custkey", *[slots[i].cast("int").alias(n.replace("_cat_x", "")) for i, n in sorted(known, key=lambda x: x[1])])


@query(
    with_parts(
        ["houses"],
        """
SELECT id, coalesce(garage_type, 'Missing') AS garage_type, coalesce(lot_frontage, (SELECT lot_frontage FROM houses
    WHERE part = 'train' AND lot_frontage IS NOT NULL GROUP BY lot_frontage ORDER BY count(*) DESC, lot_frontage LIMIT 1)) AS lot_frontage,
  CASE WHEN lot_frontage IS NULL THEN 1 ELSE 0 END AS lot_frontage_na FROM houses
""",
    )
)
def impute_missing(spark: SparkSession, sf: str) -> DataFrame:
    df = _houses(spark, sf)
    fitted = encode.Imputer.fit(_train(df), ["garage_type"], ["lot_frontage"])
    return fitted.transform(df).select("id", "garage_type", "lot_frontage", "lot_frontage_na")


_RARE = """
CASE WHEN {c} IN (SELECT {c} FROM houses WHERE part = 'train' GROUP BY {c} HAVING count(*) / (SELECT count(*) FROM houses WHERE part = 'train') > {s})
  THEN {c} ELSE 'Rare' END
"""


@query(with_parts(["houses"], f"SELECT id, {_RARE.format(c='style', s=0.018)} AS style, {_RARE.format(c='neighborhood', s=0.04)} AS neighborhood FROM houses"))
def rare_group(spark: SparkSession, sf: str) -> DataFrame:
    df = _houses(spark, sf)
    out = encode.RareGrouper.fit(_train(df), ["style"], 0.018).transform(df)
    return encode.RareGrouper.fit(_train(df), ["neighborhood"], 0.04).transform(out).select("id", "style", "neighborhood")


_GROUPED = ("neighborhood", "style")


@query(
    with_parts(
        ["houses"],
        f"""
, g AS (SELECT id, part, sale_price, {', '.join(f'{_RARE.format(c=c, s=0.01)} AS {c}' for c in _GROUPED)} FROM houses),
{', '.join(f"r_{c} AS (SELECT {c} AS k, CAST(row_number() OVER (ORDER BY round(avg(sale_price), 9), {c}) - 1 AS INTEGER) AS rk FROM g WHERE part = 'train' GROUP BY 1)" for c in _GROUPED)}
SELECT g.id, r_neighborhood.rk AS neighborhood, r_style.rk AS style FROM g
LEFT JOIN r_neighborhood ON g.neighborhood = r_neighborhood.k LEFT JOIN r_style ON g.style = r_style.k
""",
    )
)
def target_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    """Rare labels are grouped first, which bounds the number of ranks."""
    df = _houses(spark, sf)
    df = encode.RareGrouper.fit(_train(df), _GROUPED, 0.01).transform(df)
    fitted = encode.TargetOrder.fit(_train(df), _GROUPED, "sale_price")
    return fitted.transform(df).select("id", *_GROUPED)


@query(
    with_parts(
        ["houses"],
        """
SELECT id, round((sale_price - lo) / (hi - lo), 6) AS sale_price, round((yr_sold - ylo) / (yhi - ylo), 6) AS yr_sold FROM houses,
  (SELECT min(sale_price) AS lo, max(sale_price) AS hi, min(yr_sold) AS ylo, max(yr_sold) AS yhi FROM houses WHERE part = 'train') b
""",
    )
)
def minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    df = _houses(spark, sf)
    fitted = encode.MinMax.fit(_train(df), ["sale_price", "yr_sold"])
    return frames.round_all(fitted.transform(df).select("id", "sale_price", "yr_sold"))


@query(
    """
SELECT event_id, CASE WHEN lo > 0 THEN round(ln(nullif(value, 0)), 6) ELSE round(value, 6) END AS value, shifted FROM (SELECT event_id, value, round(value - 20, 2) AS shifted, (SELECT min(value) FROM events) AS lo FROM events)
"""
)
def log_transform(spark: SparkSession, sf: str) -> DataFrame:
    """``shifted`` holds values at or below zero and is left as it is."""
    df = load(spark, sf, "events").select("event_id", "value", F.round(F.col("value") - 20, 2).alias("shifted"))
    return frames.round_all(encode.LogColumns.fit(df, ["value", "shifted"]).transform(df))


@query(with_parts(["houses"], "SELECT id, yr_sold - year_remod AS year_remod FROM houses"))
def elapsed_years(spark: SparkSession, sf: str) -> DataFrame:
    return encode.elapsed_years(_houses(spark, sf), ["year_remod"], "yr_sold").select("id", "year_remod")


_TEXT = ("neighborhood", "garage_type", "style")
_LABEL = {"neighborhood": "neighborhood", "garage_type": "coalesce(garage_type, 'Missing')", "style": "style"}

_FREQ = {
    c: f"""(SELECT {_LABEL[c]} AS k FROM houses WHERE part = 'train' GROUP BY 1
  HAVING count(*) / (SELECT count(*) FROM houses WHERE part = 'train') > 0.01)"""
    for c in _TEXT
}


@query(
    with_parts(
        ["houses"],
        f"""
, g AS (SELECT id, part, ln(sale_price) AS sale_price, yr_sold - year_remod AS year_remod,
  CASE WHEN lot_frontage IS NULL THEN 1 ELSE 0 END AS lot_frontage_na,
  ln(coalesce(lot_frontage, (SELECT lot_frontage FROM houses WHERE part = 'train' AND lot_frontage IS NOT NULL
    GROUP BY lot_frontage ORDER BY count(*) DESC, lot_frontage LIMIT 1))) AS lot_frontage,
  {', '.join(f"CASE WHEN {_LABEL[c]} IN (SELECT k FROM {_FREQ[c]}) THEN {_LABEL[c]} ELSE 'Rare' END AS {c}" for c in _TEXT)}
  FROM houses),
{', '.join(f'r_{c} AS (SELECT {c} AS k, row_number() OVER (ORDER BY round(avg(sale_price), 9), {c}) - 1 AS rk FROM g WHERE part = {chr(39)}train{chr(39)} GROUP BY {c})' for c in _TEXT)},
n AS (SELECT id, part, sale_price, year_remod, lot_frontage_na, lot_frontage, {', '.join(f'r_{c}.rk AS {c}' for c in _TEXT)} FROM g
  {' '.join(f'LEFT JOIN r_{c} ON g.{c} = r_{c}.k' for c in _TEXT)}),
b AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) - min({c}) AS w_{c}' for c in (*_TEXT, 'lot_frontage', 'year_remod'))} FROM n WHERE part = 'train')
SELECT id, part, round(sale_price, 6) AS sale_price, lot_frontage_na,
  {', '.join(f'round(({c} - lo_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END, 6) AS {c}' for c in (*_TEXT, 'lot_frontage', 'year_remod'))} FROM n, b
""",
    )
)
def house_features(spark: SparkSession, sf: str) -> DataFrame:
    df = _houses(spark, sf)
    fitted = fit_houses(_train(df))
    return frames.round_all(
        fitted.transform(df).select("id", "part", "sale_price", "lot_frontage_na", *_TEXT, "lot_frontage", "year_remod")
    )


def fit_houses(train: DataFrame) -> housing.PriceFeatures:
    return housing.PriceFeatures.fit(
        train, "sale_price", _TEXT, ("lot_frontage",), ("year_remod",), "yr_sold", ("lot_frontage",)
    )


_DUMMIES = {
    "sex": ("male",),
    "cabin": ("B", "F", "H", "M", "Missing"),
    "embarked": ("E", "G", "Missing", "Y"),
    "title": ("Miss", "Mr", "Mrs", "Other"),
}


@query(
    f"""
WITH raw AS (SELECT c_custkey AS id, CAST(c_acctbal > 5000 AS INTEGER) AS survived, CASE WHEN c_nationkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
  CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 150) END AS age, CASE WHEN c_acctbal >= -900 THEN round(c_acctbal / 10, 3) END AS fare,
  CASE WHEN c_nationkey < 12 THEN 'Missing' ELSE substr(c_mktsegment, 1, 1) END AS cabin,
  CASE WHEN c_nationkey % 7 = 0 THEN 'Missing' ELSE right(c_mktsegment, 1) END AS embarked,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Mr' WHEN 'FURNITURE' THEN 'Mrs' WHEN 'HOUSEHOLD' THEN 'Miss' WHEN 'MACHINERY' THEN 'Master' ELSE 'Other' END AS title,
  CASE WHEN ('0x' || substr(md5(c_custkey::VARCHAR), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS part FROM customer),
filled AS (SELECT * REPLACE (coalesce(age, (SELECT median(age) FROM raw WHERE part = 'train')) AS age,
    coalesce(fare, (SELECT median(fare) FROM raw WHERE part = 'train')) AS fare), CASE WHEN age IS NULL THEN 1.0::DOUBLE ELSE 0.0 END AS age_na FROM raw),
b AS (SELECT min(age) AS alo, max(age) - min(age) AS aw, min(fare) AS flo, max(fare) - min(fare) AS fw FROM filled WHERE part = 'train')
SELECT id, survived, part, round((age - alo) / aw, 6) AS age, round((fare - flo) / fw, 6) AS fare, age_na,
  {', '.join(f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0 END AS {c}_{v}" for c, vs in _DUMMIES.items() for v in vs)}
FROM filled, b
"""
)
def survival_features(spark: SparkSession, sf: str) -> DataFrame:
    df = passengers.cleaned(passengers.passengers(load(spark, sf, "customer")))
    df = df.withColumn("part", split_label(F.col("id"), (("train", 80), ("test", 20))))
    apply = passengers.fit_survival(df.where(F.col("part") == "train").drop("part"))
    return frames.round_all(apply(df))


@query()
def features_assemble(spark: SparkSession, sf: str) -> DataFrame:
    from larkspur.plans.customer import transformed
    from larkspur.plans.models import model_frame

    df = model_frame(transformed(frames.features(spark, sf)))
    model = encode.fit_one_hot(df)
    out = encode.assemble(df, model, encode.numeric_columns(df))
    return out.select("consumer_id", F.size(vector_to_array("features")).alias("slots"), vector_to_array("features").alias("features"))
