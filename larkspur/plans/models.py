"""Training, calibration, scoring and selection with Spark ML."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import IsotonicRegression, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.hashing import split_label
from larkspur.operators import encode, evaluate
from larkspur.session import prepare_checkpoints, saved, work_path

LABEL = "deactivated"
SEED = 7
MIN_ROWS = 500  # of a tree node, as in production; an argument everywhere, the same at every table size
GRID_MIN_ROWS = 1000
FIRST_ROUNDS, LAST_ROUNDS = 1000, 5000
MOST_ROWS = 500_000  # of a partition that a learner reads


def learner_partitions(spark: SparkSession, rows: int) -> int:
    """Most partitions for the rows of a tree learner. At each pass every partition sends a table of sums for every open
    node of every tree, whatever its rows; so there are no more than two for each task that can run
    at once, and beyond that only where one would hold over ``MOST_ROWS``. Their number decides what is sampled."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // MOST_ROWS))


def model_frame(transformed: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Scoring table under the suffix contract: *_x numbers, *_cat_x text. Tree
    learners take no missing numbers; what the transforms left empty becomes 0."""
    text = (
        "recency_9block",
        "frequency_9block",
        "most_recent_l1",
        "most_recent_l2",
        "most_recent_platform",
        "most_recent_promo_type",
    )
    skip = {"consumer_id", "data_set", "brand", "user_key", "recency_segment", "frequency_segment", "deact_flag", *text}
    numbers = [c for c, t in transformed.dtypes if c not in skip and t in ("int", "bigint", "double")]
    numbers = [c for c in numbers if not c.endswith("order_id")]
    out = transformed.select(
        "consumer_id",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"{c}_x") for c in numbers],
        *[F.coalesce(c, F.lit("none")).alias(f"{c}_cat_x") for c in text],
    )
    return out.join(labels.select("consumer_id", LABEL), "consumer_id") if labels is not None else out


def split_frame(df: DataFrame, shares: Sequence[tuple[str, int]], key: str = "consumer_id") -> DataFrame:
    return df.withColumn("part", split_label(F.col(key), shares))


@dataclass
class Fitted:
    """Encoders and model fitted on the same train rows."""

    encoders: PipelineModel
    numeric: list[str]
    model: object
    names: list[str] = field(default_factory=list)

    def score(self, df: DataFrame, out: str = "prob_deact") -> DataFrame:
        """Probability of class 1; helper columns are dropped."""
        scored = self.model.transform(encode.assemble(df, self.encoders, self.numeric))
        return scored.withColumn(out, encode.probability_of_one()).drop(
            "rawPrediction", "probability", "prediction", "features"
        )

    def pipeline(self) -> PipelineModel:
        """Encoders, assembler and model in one pipeline; saved, it scores raw rows wherever it is loaded."""
        return PipelineModel([*self.encoders.stages, encode.assembler(self.encoders, self.numeric), self.model])

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance), one row per vector slot of the model."""
        values = [float(v) for v in self.model.featureImportances.toArray()]
        if len(values) != len(self.names):
            raise ValueError("feature names and vector slots differ")
        return spark.createDataFrame(list(zip(self.names, values)), "feature string, importance double")


def fit(train: DataFrame, estimator, numeric: Sequence[str] | None = None, text: Sequence[str] | None = None) -> Fitted:
    numeric = list(numeric if numeric is not None else encode.numeric_columns(train))
    text = list(text if text is not None else encode.categorical_columns(train))
    if not text:
        return _fit_numeric(train, estimator, numeric)
    encoders = encode.fit_one_hot(train, text)
    rows = encode.assemble(train, encoders, numeric).select(LABEL, "features", *_marks(train)).persist()
    try:
        model = estimator.fit(rows)
    finally:
        rows.unpersist()
    return Fitted(encoders, numeric, model, encode.feature_names(encoders, numeric))


def _marks(train: DataFrame) -> list[str]:
    return [HELD_OUT] if HELD_OUT in train.columns else []


class _NumericOnly(Fitted):
    def score(self, df: DataFrame, out: str = "prob_deact") -> DataFrame:
        scored = self.pipeline().transform(df)
        return scored.withColumn(out, encode.probability_of_one()).drop(
            "rawPrediction", "probability", "prediction", "features"
        )

    def pipeline(self) -> PipelineModel:
        return PipelineModel([VectorAssembler(inputCols=self.numeric, outputCol="features", handleInvalid="keep"), self.model])


def load(path: str) -> Fitted:
    """Encoders and model as ``Fitted.pipeline`` saved them; nothing comes from the session that fitted them."""
    *encoders, assembler, model = PipelineModel.load(path).stages
    inputs = assembler.getInputCols()
    if not encoders:
        return _NumericOnly(None, inputs, model, inputs)
    made = PipelineModel(encoders)
    numeric = inputs[: len(inputs) - len(made.stages[1].getOutputCols())]
    return Fitted(made, numeric, model, encode.feature_names(made, numeric))


def _fit_numeric(train: DataFrame, estimator, numeric: list[str]) -> Fitted:
    v = VectorAssembler(inputCols=numeric, outputCol="features", handleInvalid="keep")
    return _NumericOnly(None, numeric, estimator.fit(v.transform(train).select(LABEL, "features", *_marks(train))), list(numeric))


def gbt(rows_per_node: int = MIN_ROWS, iterations: int = 20, depth: int = 6, sample: float = 0.5, **more) -> GBTClassifier:
    return GBTClassifier(
        labelCol=LABEL,
        featuresCol="features",
        maxDepth=depth,
        minInstancesPerNode=rows_per_node,
        subsamplingRate=sample,
        maxIter=iterations,
        seed=SEED,
        **more,
    )


HELD_OUT = "held_out"


def long_gbt(rows_per_node: int = 5, iterations: int = FIRST_ROUNDS, depth: int = 6, rate: float = 0.1, share: float = 0.8, least: float = 1e-4) -> GBTClassifier:
    """Boosting of up to ``iterations`` rounds, which ends when the loss of the rows marked
    ``held_out`` falls by less than ``least`` of itself. Every tenth round is checkpointed, so the
    lineage of a long run stays short."""
    return gbt(
        rows_per_node, iterations, depth, share, stepSize=rate, featureSubsetStrategy=str(share),
        validationIndicatorCol=HELD_OUT, validationTol=least, checkpointInterval=10,
    )


def forest(rows_per_node: int = MIN_ROWS, trees: int = 1000, depth: int = 6, columns: str = "auto", keep_nodes: bool = True) -> RandomForestClassifier:
    """With ``keep_nodes`` each row keeps its node in every tree from one level to the next, else it goes down all trees from their
    roots at each level. The trees are the same."""
    return RandomForestClassifier(
        labelCol=LABEL,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=rows_per_node,
        subsamplingRate=0.5,
        featureSubsetStrategy=columns,
        cacheNodeIds=keep_nodes,
        seed=SEED,
    )


def train_per_segment(train: DataFrame, test: DataFrame, segment: str, values: Sequence, make, rows_per_node: int = MIN_ROWS) -> DataFrame:
    """One model per segment value, scored on that segment's test rows. Where a
    segment's train rows are of one class, that class is the score of its test rows
    (null without train rows)."""
    out = None
    for value in values:
        part, rows = train.where(F.col(segment) == value), test.where(F.col(segment) == value)
        classes = part.agg(F.min(LABEL).alias("lo"), F.max(LABEL).alias("hi")).first()
        if classes["lo"] == classes["hi"]:
            scored = rows.withColumn("prob_deact", F.lit(classes["lo"]).cast("double"))
        else:
            scored = fit(part, make(rows_per_node)).score(rows)
        scored = scored.select("consumer_id", "recency_x", LABEL, "prob_deact").withColumn("segment", F.lit(value))
        out = scored if out is None else out.unionByName(scored)
    if out is None:
        raise ValueError("no segment values given")
    return out


def _counted(scored: DataFrame, prob: str, *more: Column) -> DataFrame:
    """Score rows reduced to distinct scores with their row count as weight."""
    rows = scored.groupBy(prob, *more).agg(F.avg(LABEL).alias("y"), F.count("*").cast("double").alias("w"))
    return VectorAssembler(inputCols=[prob], outputCol="prob_feature", handleInvalid="keep").transform(rows)


def fit_isotonic(scored: DataFrame, prob: str = "prob_deact"):
    """Isotonic steps. Equal scores are pooled to their mean in any case, so the fit
    on weighted distinct scores is the same as on all rows."""
    return IsotonicRegression(
        labelCol="y", weightCol="w", predictionCol="prob_deact_cal", featuresCol="prob_feature"
    ).fit(_counted(scored, prob))


def fit_platt(scored: DataFrame, prob: str = "prob_deact"):
    """Logistic curve on the score, from weighted distinct (score, label) pairs."""
    rows = _counted(scored, prob, F.col(LABEL))
    return LogisticRegression(labelCol="y", weightCol="w", featuresCol="prob_feature").fit(rows)


def platt_coefficients(model) -> DataFrame:
    """(slope, intercept) of a fitted logistic curve."""
    row = (float(model.coefficients[0]), float(model.intercept))
    return SparkSession.active().createDataFrame([row], "slope double, intercept double")


def calibrate(model, scored: DataFrame, prob: str = "prob_deact", out: str = "prob_deact_cal") -> DataFrame:
    """Apply either calibration; the result is in column ``out``."""
    rows = VectorAssembler(inputCols=[prob], outputCol="prob_feature", handleInvalid="keep").transform(scored)
    done = model.transform(rows)
    if "probability" in done.columns:
        done = done.withColumn(out, encode.probability_of_one()).drop("probability", "rawPrediction", "prediction")
    elif out != "prob_deact_cal":
        done = done.withColumnRenamed("prob_deact_cal", out)
    return done.drop("prob_feature")


def compare_models(test: DataFrame, fitted: dict[str, Fitted]) -> DataFrame:
    """Scores of every model on the same rows, one block of rows per model."""
    out = None
    for name, f in fitted.items():
        s = f.score(test).select("consumer_id", "recency_x", LABEL, "prob_deact").withColumn("model", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out


def holdout_report(scored: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy and areas of the hard labels, and areas of the probability; each row is scored once."""
    scored = saved(scored.select(*keys, LABEL, "prob_deact"), "scored")
    areas = evaluate.trapezoid_areas(evaluate.cutoff_curve(scored, LABEL, "prob_deact", keys), keys)
    return evaluate.hard_label_areas(scored, LABEL, "prob_deact", keys).join(areas, list(keys))


def backward_elimination(
    train: DataFrame, features: Sequence[str], drops: Sequence[int], make=None, final=None, rows_per_node: int | None = None
) -> tuple[Fitted, DataFrame]:
    """Fit, drop the least important features, refit, and so on; then the final
    fit. Returns the model and (round, feature, importance) of every round.

    By default a thousand rounds of depth 6 each and at last five thousand of depth 10, ended early on the
    rows that ``train`` marks in ``held_out``."""
    spark = train.sparkSession
    prepare_checkpoints(spark)
    make = make or (lambda n: long_gbt(n))
    final = final or (lambda n: long_gbt(n - 1, LAST_ROUNDS, depth=10, rate=0.01, share=1.0))
    kept, logs = list(features), None
    for i, n in enumerate([*drops, 0]):
        fitted = fit(train, (make if i < len(drops) else final)(rows_per_node or 5), numeric=kept, text=[])
        imp = fitted.importances(spark).withColumn("round", F.lit(i + 1))
        logs = imp if logs is None else logs.unionByName(imp)
        if n:
            worst = imp.orderBy(F.asc("importance"), F.asc("feature")).limit(min(n, len(kept) - 1))
            gone = {r["feature"] for r in worst.select("feature").collect()}
            kept = [f for f in kept if f not in gone]
    return fitted, logs


def important(importances: DataFrame, least: float = 0.001) -> DataFrame:
    """Ranked features, without those below the least importance."""
    return importances.where(F.col("importance") >= least).orderBy(F.desc("importance"), "feature")


def grid_forest(
    train: DataFrame, validate: DataFrame, depths: Sequence[int] = (6, 10, 20, 30), trees: int = 300, rows_per_node: int = GRID_MIN_ROWS
) -> tuple[object, DataFrame]:
    """Forest depth chosen by area under ROC on the validation rows; all other rows are fitted on. The forest
    is grown once, to the greatest depth, and the others are its trees up to their depth."""
    encoders = encode.fit_one_hot(train)
    numeric = encode.numeric_columns(train)
    ready = lambda df: encode.assemble(df, encoders, numeric).select(F.col(LABEL).cast("double").alias(LABEL), "features")
    rows, held = ready(train).persist(), ready(validate).persist()
    measure = BinaryClassificationEvaluator(labelCol=LABEL)
    result, best = [], None
    try:
        grown = forest(rows_per_node, trees=trees, depth=max(depths), columns="0.66", keep_nodes=False).fit(rows)
        for depth, model in zip(depths, limited_forests(grown, depths)):
            area = float(measure.evaluate(model.transform(held)))
            if best is None or area > best[0]:
                best = (area, model)
            result.append((int(depth), area))
    finally:
        rows.unpersist()
        held.unpersist()
    return best[1], train.sparkSession.createDataFrame(result, "max_depth int, auc double")


def limited_forests(grown: RandomForestClassificationModel, depths: Sequence[int]) -> list[RandomForestClassificationModel]:
    """The forests of lesser depths in a grown one. Whether and how a node is split never depends on what
    is below it, so a tree of a lesser depth is the grown one up to there.

    The learner draws the columns of nodes in the order of its passes. While a level's open nodes fit into the memory of one pass
    (``maxMemoryInMB``), these are the very trees that a fit of each depth gives; beyond that such a fit draws other columns."""
    spark, deepest = SparkSession.active(), max(t.depth for t in grown.trees)
    whole = lambda depth: depth == grown.getMaxDepth() or depth > deepest
    if all(map(whole, depths)):
        return [grown.copy({grown.maxDepth: depth}) for depth in depths]
    path = work_path(spark, "forest")
    grown.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    trees: dict[int, dict[int, dict]] = {}
    for r in data.collect():  # the model's nodes, which the driver holds in any case
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"].asDict(recursive=True)
    told, per_tree = spark.read.text(f"{path}/metadata").first()["value"], spark.read.parquet(f"{path}/treesMetadata")
    out = []
    for depth in depths:
        if whole(depth):
            out.append(grown.copy({grown.maxDepth: depth}))
            continue
        at = work_path(spark, f"forest-{depth}")
        nodes = [(t, n) for t, tree in trees.items() for n in _limited_tree(tree, depth)]
        spark.createDataFrame(nodes, data.schema).coalesce(1).write.parquet(f"{at}/data")
        spark.createDataFrame([(_with_depth(told, depth),)], "value string").coalesce(1).write.text(f"{at}/metadata")
        texts = [tuple(_with_depth(v, depth) if isinstance(v, str) else v for v in r) for r in per_tree.collect()]  # a row per tree
        spark.createDataFrame(texts, per_tree.schema).coalesce(1).write.parquet(f"{at}/treesMetadata")
        out.append(RandomForestClassificationModel.load(at))
    return out


def _with_depth(metadata: str, depth: int) -> str:
    told = json.loads(metadata)
    told["paramMap"]["maxDepth"] = int(depth)
    return json.dumps(told)


def _limited_tree(nodes: dict[int, dict], depth: int) -> list[dict]:
    """Nodes of a saved tree up to a depth, numbered in preorder. Sister leaves of equal
    prediction become one, as the learner merges them."""
    out: list[dict] = []

    def leaf(n: dict) -> dict:
        return n | {"gain": -1.0, "leftChild": -1, "rightChild": -1, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}

    def walk(n: dict, level: int) -> None:
        me = len(out)
        out.append(n)
        if level == depth:  # never looked at for a split, so with its impurity
            n = n | {"impurity": _gini(n["impurityStats"])}
        if n["leftChild"] < 0 or level == depth:
            out[me] = leaf(n) | {"id": me}
            return
        walk(nodes[n["leftChild"]], level + 1)
        right = len(out)
        walk(nodes[n["rightChild"]], level + 1)
        a, b = out[me + 1], out[right]
        if a["leftChild"] < 0 and b["leftChild"] < 0 and a["prediction"] == b["prediction"]:
            del out[me + 1 :]
            out[me] = leaf(n) | {"id": me}
        else:
            out[me] = n | {"id": me, "leftChild": me + 1, "rightChild": right}

    walk(nodes[0], 0)
    return out


def _gini(counts: Sequence[float]) -> float:
    impurity, total = 1.0, sum(counts)
    for c in counts:
        impurity -= (c / total) * (c / total)
    return impurity


def lasso(train: DataFrame, features: Sequence[str], target: str, alpha: float = 0.005) -> tuple[object, DataFrame]:
    """L1 regression; returns the model and its coefficients, largest first."""
    rows = VectorAssembler(inputCols=list(features), outputCol="features").transform(train)
    model = LinearRegression(
        featuresCol="features", labelCol=target, regParam=alpha, elasticNetParam=1.0, standardization=False
    ).fit(rows)
    pairs = [(f, float(c), int(c != 0.0)) for f, c in zip(features, model.coefficients.toArray())]
    coefficients = train.sparkSession.createDataFrame(pairs, "feature string, coefficient double, selected int")
    return model, coefficients.orderBy(F.desc(F.abs("coefficient")), "feature")


def quadratic_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares on x and x^2: coefficient, error, t and p per term, and R2."""
    rows = VectorAssembler(inputCols=[x], outputCol="x1").transform(df.select(F.col(x), F.col(y).alias("label")))
    rows = PolynomialExpansion(degree=2, inputCol="x1", outputCol="features").transform(rows)
    model = LinearRegression(solver="normal", regParam=0.0).fit(rows)
    s = model.summary
    terms = ["x", "x2", "intercept"]
    coef = [*model.coefficients.toArray(), model.intercept]
    table = [
        (t, float(c), float(se), float(tv), float(p), float(s.r2))
        for t, c, se, tv, p in zip(terms, coef, s.coefficientStandardErrors, s.tValues, s.pValues)
    ]
    return df.sparkSession.createDataFrame(table, "term string, coef double, std_err double, t double, p double, r2 double")
