"""Fitted encoders as stages of a saved pipeline.

Each stage keeps what its encoder learned as a parameter, which is written as text with the stage; so one
``PipelineModel`` holds encoders and model, and loads wherever this package can be imported.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession

from larkspur.operators import encode


class FittedStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Applies an encoder that ``encoder`` rebuilds from the parameter ``fitted``."""

    fitted = Param(Params._dummy(), "fitted", "what the encoder learned from its training rows")

    def __init__(self, fitted: dict | None = None):
        super().__init__()
        if fitted is not None:
            self._set(fitted=fitted)

    def learned(self) -> dict:
        return self.getOrDefault(self.fitted)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.encoder(dataset.sparkSession).transform(dataset)


class ImputerStage(FittedStage):
    @classmethod
    def of(cls, e: encode.Imputer) -> ImputerStage:
        return cls({"text": list(e.text), "numeric": e.numeric})

    def encoder(self, spark: SparkSession) -> encode.Imputer:
        return encode.Imputer(tuple(self.learned()["text"]), self.learned()["numeric"])


class RareGrouperStage(FittedStage):
    @classmethod
    def of(cls, e: encode.RareGrouper) -> RareGrouperStage:
        return cls({c: list(v) for c, v in e.labels.items()})

    def encoder(self, spark: SparkSession) -> encode.RareGrouper:
        return encode.RareGrouper({c: tuple(v) for c, v in self.learned().items()})


class TargetOrderStage(FittedStage):
    """Up to the encoder's bound, ranks are part of the stage. A longer table of ranks
    stays where it was written, and the stage keeps its path."""

    RANKS = "column string, label string, rank int"

    @classmethod
    def of(cls, e: encode.TargetOrder) -> TargetOrderStage:
        rows = e.table.select("column", "label", "rank").limit(e.most + 1).collect()
        if len(rows) <= e.most:
            return cls({"columns": list(e.columns), "most": e.most, "ranks": [list(r) for r in rows]})
        return cls({"columns": list(e.columns), "most": e.most, "path": e.table.inputFiles()[0].rsplit("/", 1)[0]})

    def encoder(self, spark: SparkSession) -> encode.TargetOrder:
        told = self.learned()
        if "path" in told:
            table = spark.read.parquet(told["path"])
        else:
            table = spark.createDataFrame([tuple(r) for r in told["ranks"]], self.RANKS)
        return encode.TargetOrder(tuple(told["columns"]), table, told["most"])


class MinMaxStage(FittedStage):
    @classmethod
    def of(cls, e: encode.MinMax) -> MinMaxStage:
        return cls({c: list(b) for c, b in e.bounds.items()})

    def encoder(self, spark: SparkSession) -> encode.MinMax:
        return encode.MinMax({c: tuple(b) for c, b in self.learned().items()})


class LogColumnsStage(FittedStage):
    @classmethod
    def of(cls, e: encode.LogColumns) -> LogColumnsStage:
        return cls({"columns": list(e.columns)})

    def encoder(self, spark: SparkSession) -> encode.LogColumns:
        return encode.LogColumns(tuple(self.learned()["columns"]))


class ElapsedYearsStage(FittedStage):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return encode.elapsed_years(dataset, self.learned()["columns"], self.learned()["reference"])


def stage(encoder) -> FittedStage:
    """The stage of a fitted encoder."""
    kinds = {
        encode.Imputer: ImputerStage,
        encode.RareGrouper: RareGrouperStage,
        encode.TargetOrder: TargetOrderStage,
        encode.MinMax: MinMaxStage,
        encode.LogColumns: LogColumnsStage,
    }
    return kinds[type(encoder)].of(encoder)
