"""Price-model features: fitted on train rows, applied to any rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import encode, stages


@dataclass(frozen=True)
class PriceFeatures:
    """The fitted steps in the order they apply."""

    target: str
    text: tuple[str, ...]
    numeric: tuple[str, ...]
    years: tuple[str, ...]
    sold: str
    imputer: encode.Imputer
    logs: encode.LogColumns
    rare: encode.RareGrouper
    order: encode.TargetOrder
    scale: encode.MinMax

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        target: str,
        text: tuple[str, ...],
        numeric: tuple[str, ...],
        years: tuple[str, ...],
        sold: str,
        log_columns: tuple[str, ...],
        rare_share: float = 0.01,
    ) -> PriceFeatures:
        imputer = encode.Imputer.fit(train, text, numeric)
        df = encode.elapsed_years(imputer.transform(train), years, sold)
        logs = encode.LogColumns.fit(df, (*log_columns, target))
        df = logs.transform(df)
        rare = encode.RareGrouper.fit(df, text, rare_share)
        df = rare.transform(df)
        order = encode.TargetOrder.fit(df, text, target)
        df = order.transform(df)
        scale = encode.MinMax.fit(df, (*text, *numeric, *years))
        return cls(target, text, numeric, years, sold, imputer, logs, rare, order, scale)

    def stages(self) -> list[stages.FittedStage]:
        """The same steps as stages of a pipeline that can be saved with a model."""
        years = stages.ElapsedYearsStage({"columns": list(self.years), "reference": self.sold})
        return [stages.stage(self.imputer), years, *(stages.stage(e) for e in (self.logs, self.rare, self.order, self.scale))]

    def transform(self, df: DataFrame) -> DataFrame:
        df = encode.elapsed_years(self.imputer.transform(df), self.years, self.sold)
        for step in (self.logs, self.rare, self.order, self.scale):
            df = step.transform(df)
        return df


def houses(parts: DataFrame) -> DataFrame:
    """Catalogue parts read as houses; some sizes and types count as missing."""
    sold = F.lit(2006) + (F.col("p_partkey") % 5).cast("int")
    return parts.select(
        F.col("p_partkey").alias("id"),
        F.col("p_retailprice").alias("sale_price"),
        F.col("p_brand").alias("neighborhood"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("garage_type"),
        F.col("p_name").alias("style"),
        F.nullif(F.col("p_size"), F.lit(50)).cast("double").alias("lot_frontage"),
        sold.alias("yr_sold"),
        (sold - F.col("p_size")).alias("year_remod"),
    )
