"""Feature encoders fitted on a training frame and applied to any frame.

Fitting takes one aggregate whose result is a row per column, or a table of labels
whose size has a proven bound; nothing that grows with the data is collected.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.profile import label_shares, mode_smallest
from larkspur.operators.quantiles import exact_quantiles
from larkspur.operators.ranks import global_rank
from larkspur.session import saved

MISSING = "Missing"
RARE = "Rare"


@dataclass(frozen=True)
class Imputer:
    """Constants for nulls: 'Missing' for text, train mode or median for numbers,
    the latter with a 0/1 column telling where the gaps were."""

    text: tuple[str, ...]
    numeric: dict[str, float]

    @classmethod
    def fit(cls, train: DataFrame, text: Sequence[str], numeric: Sequence[str], how: str = "mode") -> Imputer:
        if not numeric:
            return cls(tuple(text), {})
        if how == "mode":
            rows = mode_smallest(train, numeric).select("column", F.col("mode").alias("value"))
        else:
            rows = exact_quantiles(train, numeric, [0.5]).select("column", "value")
        return cls(tuple(text), {r["column"]: r["value"] for r in rows.collect()})  # a row per column

    def transform(self, df: DataFrame) -> DataFrame:
        df = df.withColumns({f"{c}_na": F.col(c).isNull().cast("int") for c in self.numeric})
        return df.na.fill(self.numeric).na.fill({c: MISSING for c in self.text})


@dataclass(frozen=True)
class RareGrouper:
    """Labels with a train share above the threshold stay, the others become
    'Rare'. Fewer than 1/threshold labels per column can be that frequent."""

    labels: dict[str, tuple[str, ...]]

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str], share: float = 0.01) -> RareGrouper:
        kept = label_shares(train, columns).where(F.col("share") > share).select("column", "label").collect()
        return cls({c: tuple(sorted(r["label"] for r in kept if r["column"] == c)) for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: F.when(F.col(c).isin(list(v)), F.col(c)).otherwise(RARE) for c, v in self.labels.items()}
        )


@dataclass(frozen=True)
class TargetOrder:
    """Labels replaced by their rank by mean target in train, from 0; a label not
    seen in train becomes null. The ranks are a table (column, label, rank). Up to ``most`` of them
    are looked up in the plan; a longer table is joined per column."""

    columns: tuple[str, ...]
    table: DataFrame
    most: int = 10_000

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str], target: str, most: int = 10_000) -> TargetOrder:
        return cls(tuple(columns), saved(label_ranks(train, columns, target).select("column", "label", "rank"), "ranks"), most)

    def transform(self, df: DataFrame) -> DataFrame:
        few = self.table.limit(self.most + 1).collect()
        if len(few) <= self.most:
            out = {}
            for c in self.columns:
                pairs = [F.lit(x) for r in few if r["column"] == c for x in (r["label"], r["rank"])]
                out[c] = F.create_map(*pairs)[F.col(c)] if pairs else F.lit(None).cast("int")
            return df.withColumns(out)
        names = df.columns
        for c in self.columns:
            ranks = self.table.where(F.col("column") == c).select(F.col("label").alias(c), F.col("rank").alias("__rank"))
            df = df.join(ranks, c, "left").drop(c).withColumnRenamed("__rank", c)
        return df.select(*names)


def label_ranks(train: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, label, mean, rank) with ties by label. Ranks come from ranges of labels, so
    no task orders the labels of a column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in columns])
    means = (
        train.select(F.col(target).alias("t"), F.explode(cells).alias("c"))
        .select("t", "c.*")
        .where(F.col("label").isNotNull())
        .groupBy("column", "label")
        .agg(F.avg("t").alias("mean"))
    )
    return global_rank(means, [F.round("mean", 9), F.col("label")], ["column"])


@dataclass(frozen=True)
class MinMax:
    """Scale by train bounds; other frames may leave [0, 1]. A constant column
    scales to 0."""

    bounds: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str]) -> MinMax:
        row = train.agg(
            *[f(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
        ).first()
        return cls({c: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, c in enumerate(columns)})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c) - F.lit(lo)) / F.lit((hi - lo) or 1.0) for c, (lo, hi) in self.bounds.items()}
        )


@dataclass(frozen=True)
class LogColumns:
    """Natural log of the columns that hold only positive values in train."""

    columns: tuple[str, ...]

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str]) -> LogColumns:
        row = train.agg(*[F.min(c).alias(c) for c in columns]).first()
        return cls(tuple(c for c in columns if row[c] is not None and row[c] > 0))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.log(F.col(c)) for c in self.columns})


def elapsed_years(df: DataFrame, columns: Sequence[str], reference: str) -> DataFrame:
    return df.withColumns({c: F.col(reference) - F.col(c) for c in columns})


# --- suffix contract: *_x numeric feature, *_cat_x text feature -----------------

CAT = "_cat_x"


def categorical_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith(CAT)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_x") and not c.endswith(CAT) and not c.endswith("_vec_x")]


def fit_one_hot(train: DataFrame, columns: Sequence[str] | None = None, drop_last: bool = False) -> PipelineModel:
    """Frequency-ordered index and one-hot vector per text feature; unknown labels
    get a slot of their own."""
    columns = list(columns or categorical_columns(train))
    index = [c.replace(CAT, "") + "_index" for c in columns]
    vec = [c.replace(CAT, "") + "_vec_x" for c in columns]
    stages = [
        StringIndexer(inputCols=columns, outputCols=index, handleInvalid="keep", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=index, outputCols=vec, handleInvalid="keep", dropLast=drop_last),
    ]
    return Pipeline(stages=stages).fit(train)


def feature_names(model: PipelineModel, numeric: Sequence[str]) -> list[str]:
    """One name per vector slot, in the order ``assemble`` lays them out."""
    indexer, encoder = model.stages[0], model.stages[1]
    names = list(numeric)
    for column, labels, size in zip(indexer.getInputCols(), indexer.labelsArray, encoder.categorySizes):
        slots = [f"{column}_{_slug_text(str(v))}" for v in labels]
        # Unknown labels have a slot after the known ones; the encoder keeps one
        # more for invalid indices unless it drops the last.
        width = size + (0 if encoder.getDropLast() else 1)
        extra = [f"{column}_unknown", f"{column}_invalid"]
        names.extend((slots + extra)[:width])
    return names


def _slug_text(text: str) -> str:
    return re.sub(r"\W+", "_", text.strip())


def assembler(model: PipelineModel, numeric: Sequence[str], out: str = "features") -> VectorAssembler:
    """The stage after the encoders: numeric features, then the one-hot blocks, as one vector; nulls are kept."""
    return VectorAssembler(inputCols=[*numeric, *model.stages[1].getOutputCols()], outputCol=out, handleInvalid="keep")


def assemble(df: DataFrame, model: PipelineModel, numeric: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric features, then the one-hot blocks, as one vector; nulls are kept."""
    assembled = assembler(model, numeric, out).transform(model.transform(df))
    return assembled.drop(*model.stages[1].getOutputCols(), *model.stages[0].getOutputCols())


def string_index(df: DataFrame, column: str) -> DataFrame:
    """(label, index): most frequent first, ties by label. The labels stay a table."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"))
    return global_rank(counts, [F.desc("n"), F.col("label")], name="idx").select("label", "idx")


def one_hot_columns(df: DataFrame, column: str, labels: Sequence[str], drop_first: bool = False) -> DataFrame:
    """0/1 columns named after the labels (dummy columns)."""
    kept = list(labels)[1:] if drop_first else list(labels)
    return df.withColumns({f"{column}_{_slug_text(v)}": (F.col(column) == v).cast("int") for v in kept})


def probability_of_one(column: str = "probability"):
    return vector_to_array(F.col(column))[1]
