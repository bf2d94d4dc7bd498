"""Survival-model features from raw passenger text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import blank_out, first_letter, first_token, title
from larkspur.operators import encode

SENTINEL = "?"
RARE_SHARE = 0.05


def passengers(customers: DataFrame) -> DataFrame:
    """Customers read as raw passenger rows: text columns with '?' for missing."""
    seg, nation, bal = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")
    salutation = (
        F.when(seg == "BUILDING", "Mr.")
        .when(seg == "FURNITURE", "Mrs.")
        .when(seg == "HOUSEHOLD", "Miss.")
        .when(seg == "MACHINERY", "Master.")
        .otherwise("Dr.")
    )
    return customers.select(
        F.col("c_custkey").alias("id"),
        (bal > 5000).cast("int").alias("survived"),
        F.concat_ws(" ", "c_name", salutation).alias("name"),
        F.when(nation % 2 == 0, "male").otherwise("female").alias("sex"),
        F.when(bal < 0, "?").otherwise((F.floor(bal / 150)).cast("string")).alias("age"),
        F.when(bal < -900, "?").otherwise(F.round(bal / 10, 3).cast("string")).alias("fare"),
        F.when(nation < 12, "?")
        .otherwise(F.concat(first_letter(seg), nation.cast("string"), F.lit(" B"), nation.cast("string")))
        .alias("cabin"),
        F.when(nation % 7 == 0, "?").otherwise(first_letter(F.reverse(seg))).alias("embarked"),
    )


def cleaned(raw: DataFrame) -> DataFrame:
    """Sentinels to null, numbers cast, first cabin's deck letter, title."""
    texts = [c for c, t in raw.dtypes if t == "string"]
    df = raw.withColumns({c: blank_out(F.col(c), SENTINEL) for c in texts})
    return df.withColumns(
        {
            "age": F.col("age").try_cast("double"),
            "fare": F.col("fare").try_cast("double"),
            "cabin": first_letter(first_token(F.col("cabin"))),
            "title": title(F.col("name")),
        }
    ).drop("name")


TEXT = ("sex", "cabin", "embarked", "title")
NUMERIC = ("age", "fare")


def fit_survival(train: DataFrame):
    """Returns a function that applies the fitted steps to any cleaned rows."""
    imputer = encode.Imputer.fit(train, TEXT, NUMERIC, how="median")
    filled = imputer.transform(train).drop("fare_na")
    rare = encode.RareGrouper.fit(filled, TEXT, RARE_SHARE)
    grouped = rare.transform(filled)
    # At most 1/share labels per column are frequent, plus Rare.
    seen = encode.label_ranks(grouped, TEXT, "survived").select("column", "label").collect()
    labels = {c: sorted(r["label"] for r in seen if r["column"] == c) for c in TEXT}

    def encoded(df: DataFrame) -> DataFrame:
        df = rare.transform(imputer.transform(df).drop("fare_na"))
        for c in TEXT:
            df = encode.one_hot_columns(df, c, labels[c], drop_first=True)
        return df.drop(*TEXT)

    features = [c for c in encoded(train).columns if c not in ("id", "survived")]
    scale = encode.MinMax.fit(encoded(train), features)
    return lambda df: scale.transform(encoded(df))
