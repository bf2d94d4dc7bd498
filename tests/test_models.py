"""Invariants of fitted models."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from larkspur.operators import encode
from larkspur.plans import models
from larkspur.queries import modelling

Q = contract.queries()


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(600).select(
        F.col("id").alias("consumer_id"),
        (F.col("id") % 365).cast("double").alias("recency_x"),
        ((F.col("id") * 7919) % 11).cast("double").alias("noise_x"),
        F.when(F.col("id") % 3 == 0, "L1 - Local").when(F.col("id") % 3 == 1, "a b").otherwise("c").alias("kind_cat_x"),
    )
    flip = (F.col("consumer_id") * 31 % 10 == 0).cast("int")
    return base.withColumn("deactivated", F.when(F.col("recency_x") > 180, 1 - flip).otherwise(flip))


def test_names_follow_the_vector(spark, rows):
    model = encode.fit_one_hot(rows)
    numeric = encode.numeric_columns(rows)
    names = encode.feature_names(model, numeric)
    out = encode.assemble(rows, model, numeric)
    from pyspark.ml.functions import vector_to_array

    first = out.select("kind_cat_x", "recency_x", vector_to_array("features").alias("v")).limit(50).collect()
    assert all(len(r["v"]) == len(names) for r in first)
    slot = {n: i for i, n in enumerate(names)}
    for r in first:
        hot = {"L1 - Local": "kind_cat_x_L1_Local", "a b": "kind_cat_x_a_b", "c": "kind_cat_x_c"}[r["kind_cat_x"]]
        assert r["v"][slot[hot]] == 1.0 and r["v"][slot["recency_x"]] == r["recency_x"]
        assert sum(r["v"][len(numeric):]) == 1.0


def test_unknown_label_has_its_own_slot(spark, rows):
    model = encode.fit_one_hot(rows)
    new = rows.limit(1).withColumn("kind_cat_x", F.lit("never seen"))
    from pyspark.ml.functions import vector_to_array

    v = encode.assemble(new, model, []).select(vector_to_array("features").alias("v")).first()["v"]
    assert v[encode.feature_names(model, []).index("kind_cat_x_unknown")] == 1.0


def test_gbt_and_calibrations(spark, rows):
    fitted = models.fit(rows, models.gbt(5, iterations=5, depth=3))
    imp = fitted.importances(spark).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    assert max(imp, key=lambda r: r["importance"])["feature"] == "recency_x"
    scored = fitted.score(rows)
    assert scored.where((F.col("prob_deact") < 0) | (F.col("prob_deact") > 1)).count() == 0
    iso = models.calibrate(models.fit_isotonic(scored), scored).select("prob_deact", "prob_deact_cal", "deactivated")
    values = sorted((r["prob_deact"], r["prob_deact_cal"]) for r in iso.collect())
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(values, values[1:]))
    means = iso.agg(F.avg("prob_deact_cal").alias("p"), F.avg("deactivated").alias("y")).first()
    assert means["p"] == pytest.approx(means["y"], abs=1e-6)
    platt = models.calibrate(models.fit_platt(scored), scored)
    assert platt.where(~F.col("prob_deact_cal").between(0, 1)).count() == 0


def test_weighted_calibration_equals_all_rows(spark, rows):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import IsotonicRegression

    scored = rows.withColumn("prob_deact", F.round(F.col("recency_x") / 400, 2))
    raw = VectorAssembler(inputCols=["prob_deact"], outputCol="f").transform(scored)
    plain = IsotonicRegression(labelCol="deactivated", featuresCol="f", predictionCol="q").fit(raw)
    ours = models.calibrate(models.fit_isotonic(scored), scored)
    want = {r["consumer_id"]: r["q"] for r in plain.transform(raw).select("consumer_id", "q").collect()}
    got = {r["consumer_id"]: r["prob_deact_cal"] for r in ours.select("consumer_id", "prob_deact_cal").collect()}
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}


def test_backward_elimination_shrinks(spark, rows):
    wide = rows
    for i in range(5):
        wide = wide.withColumn(f"n{i}_x", ((F.col("consumer_id") * (i + 3)) % 7).cast("double"))
    small = lambda n: models.gbt(n, iterations=2, depth=2)
    fitted, log = models.backward_elimination(wide, encode.numeric_columns(wide), (3, 2), small, small)
    sizes = {r["round"]: r["count"] for r in log.groupBy("round").count().collect()}
    assert sizes == {1: 7, 2: 4, 3: 2}
    assert "recency_x" in fitted.numeric


def test_per_segment_covers_every_row(spark, rows):
    seg = rows.withColumn("seg_x", (F.col("consumer_id") % 2).cast("double"))
    out = models.train_per_segment(seg, seg, "seg_x", (0.0, 1.0), lambda n: models.gbt(n, iterations=2, depth=2))
    assert out.count() == rows.count() and out.select("consumer_id").distinct().count() == rows.count()


def test_a_segment_of_one_class_keeps_its_rows(spark, rows):
    seg = rows.withColumn("seg_x", (F.col("consumer_id") % 2).cast("double"))
    seg = seg.withColumn(models.LABEL, F.when(F.col("seg_x") == 1, F.lit(1)).otherwise(F.col(models.LABEL)))
    out = models.train_per_segment(seg, seg, "seg_x", (0.0, 1.0), lambda n: models.gbt(n, iterations=2, depth=2))
    assert out.count() == seg.count()
    assert {r["prob_deact"] for r in out.where("segment = 1.0").collect()} == {1.0}


def test_quadratic_fit(spark):
    df = spark.range(40).select(F.col("id").cast("double").alias("x"))
    wave = F.sin(F.col("x") * 12.9)
    df = df.withColumn("y", 2 + 3 * F.col("x") - 0.5 * F.col("x") * F.col("x") + wave * 1e-3)
    out = {r["term"]: r for r in models.quadratic_fit(df, "x", "y").collect()}
    assert out["x"]["coef"] == pytest.approx(3, abs=1e-3)
    assert out["x2"]["coef"] == pytest.approx(-0.5, abs=1e-4)
    assert out["x"]["r2"] > 0.999999 and out["x2"]["p"] < 1e-6


@pytest.mark.parametrize("name", ["train_logistic", "lasso_select", "survival_features", "features_assemble", "distribute_sort"])
def test_cheap_model_queries(spark, sf_dir, name):
    assert Q[name](spark, sf_dir).count() > 0


def test_daily_publish(spark, sf_dir):
    out = Q["daily_publish"](spark, sf_dir).orderBy("record_date").collect()
    assert [r["record_date"] for r in out] == ["2000-07-27", "2000-07-28"]
    assert out[1]["rate"] > 0 and out[1]["stable"] in (0, 1) and out[0]["rate"] is None
    assert all(0 <= r["mean_prob"] <= 1 and r["consumers"] > 0 for r in out)


def test_model_roundtrip(spark, sf_dir):
    out = Q["model_roundtrip"](spark, sf_dir)
    assert out.count() > 0 and out.where(F.col("fitted") != F.col("loaded")).count() == 0


def test_roundtrip_saves_the_encoders_with_the_model(spark, monkeypatch):
    """What was written scores raw rows by itself: labels are ranked, and numbers ordered, as in the session that fitted."""
    from pyspark.ml import PipelineModel

    label = F.when(F.col("id") % 4 == 0, "b").when(F.col("id") % 4 == 1, "a b").otherwise("c")
    rows = spark.range(6000).select(
        F.col("id").alias("consumer_id"), (F.col("id") % 365).cast("double").alias("recency_x"),
        F.when(F.col("id") % 97 == 1, F.lit("only held out")).otherwise(label).alias("kind_cat_x"),
        (F.col("id") % 4 == 0).cast("int").alias(models.LABEL),
        F.when(F.col("id") % 97 == 1, "validate").when(F.col("id") % 2 == 0, "train").when(F.col("id") % 3 == 0, "train").otherwise("validate").alias("part"),
    ).withColumn(models.LABEL, F.when(F.col("recency_x") > 300, 1).otherwise(F.col(models.LABEL)))
    paths = {}
    keep = lambda s, name, make=modelling.work_path: paths.setdefault(name, make(s, name))
    monkeypatch.setattr(modelling, "work_path", keep)
    monkeypatch.setattr(modelling, "_frame", lambda *_: rows)
    out = Q["model_roundtrip"](spark, "")
    assert out.columns == ["consumer_id", "fitted", "loaded"]
    got = {r["consumer_id"]: (r["fitted"], r["loaded"]) for r in out.collect()}
    held = rows.where("part = 'validate'")
    assert got.keys() == {r["consumer_id"] for r in held.collect()} and all(a == b for a, b in got.values())
    assert len({a for a, _ in got.values()}) > 1

    made = PipelineModel.load(paths["model"])
    alone = made.transform(held.select("consumer_id", "recency_x", "kind_cat_x")).select("consumer_id", encode.probability_of_one().alias("p"))
    assert {r["consumer_id"]: r["p"] for r in alone.collect()} == {k: a for k, (a, _) in got.items()}
    loaded = models.load(paths["model"])
    assert loaded.numeric == ["recency_x"] and "kind_cat_x_a_b" in loaded.names
    assert sum(r["importance"] for r in loaded.importances(spark).collect()) == pytest.approx(1.0)


def test_a_model_of_numbers_only_is_saved_whole(spark, rows):
    path = modelling.work_path(spark, "numbers")
    fitted = models.fit(rows, models.gbt(5, iterations=2, depth=2), text=[])
    fitted.pipeline().write().save(path)
    loaded = models.load(path)
    assert loaded.numeric == fitted.numeric and loaded.names == fitted.names
    score = lambda f: {r["consumer_id"]: r["prob_deact"] for r in f.score(rows).select("consumer_id", "prob_deact").collect()}
    assert score(loaded) == score(fitted)


def test_a_grid_grows_one_forest_and_has_the_trees_of_each_depth(spark, monkeypatch):
    """Each depth's forest is, node by node, the one that a fit of that depth gives."""
    noise = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)).cast("double")
    x = [noise(k, 40) for k in range(5)]
    rows = spark.range(8000).select(
        F.col("id").alias("consumer_id"), *[c.alias(f"f{k}_x") for k, c in enumerate(x)],
        F.when(noise(8, 3) == 0, "a").otherwise("b").alias("kind_cat_x"),
        (x[0] * x[1] + x[2] * 9 + noise(9, 500) > 900).cast("int").alias(models.LABEL),
    )
    train, held = (modelling._laid_out(rows.where(c)) for c in ("consumer_id % 4 <> 0", "consumer_id % 4 = 0"))
    depths, made, fits, kept = (3, 1, 5, 30), models.forest, [], []
    cut = models.limited_forests
    monkeypatch.setattr(models, "forest", lambda *a, **k: fits.append(k["depth"]) or made(*a, **k))
    monkeypatch.setattr(models, "limited_forests", lambda *a: kept.extend(cut(*a)) or kept)
    best, result = models.grid_forest(train, held, depths, trees=8, rows_per_node=20)
    areas = [(r["max_depth"], r["auc"]) for r in result.collect()]
    assert fits == [30] and [d for d, _ in areas] == list(depths) and len(set(areas)) == 4

    def nodes(model, name):
        model.write().save(path := modelling.work_path(spark, name))
        return sorted(map(repr, spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()))

    encoders, numeric = encode.fit_one_hot(train), encode.numeric_columns(train)
    ready = lambda df: encode.assemble(df, encoders, numeric).select(F.col(models.LABEL).cast("double").alias(models.LABEL), "features")
    measure, sizes = models.BinaryClassificationEvaluator(labelCol=models.LABEL), []
    for (depth, area), model in zip(areas, kept):
        alone = made(20, trees=8, depth=depth, columns="0.66", keep_nodes=False).fit(ready(train))
        assert nodes(model, "cut") == nodes(alone, "alone")
        assert area == pytest.approx(measure.evaluate(alone.transform(ready(held))), abs=5e-3)  # its curve has 1000 bins, laid anew each time
        assert model.getMaxDepth() == depth and model.featureImportances == alone.featureImportances
        sizes.append(model.totalNumNodes)
    assert sizes[1] < sizes[0] < sizes[2] < sizes[3]
    assert best.getMaxDepth() == max(areas, key=lambda a: a[1])[0]


def test_model_rows_have_at_most_two_partitions_per_task(spark):
    """However many partitions the features have: each costs a table of sums per node and pass."""
    from larkspur.queries import modelling

    most = 2 * spark.sparkContext.defaultParallelism
    shuffles, merged = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {k: spark.conf.get(k) for k in (shuffles, merged)}
    spark.conf.set(merged, "false")
    try:
        for given, want in ((4 * most, most), (2, 2)):
            spark.conf.set(shuffles, str(given))
            rows = modelling._laid_out(spark.range(5000).withColumnRenamed("id", "consumer_id"))
            laid = rows.rdd.glom().map(lambda part: [r["consumer_id"] for r in part]).collect()
            assert len(laid) == want
            assert all(ids == sorted(ids) for ids in laid) and sorted(i for ids in laid for i in ids) == list(range(5000))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert models.learner_partitions(spark, most * models.MOST_ROWS + 1) == most + 1


def test_forest_keeps_nodes_and_rows_are_scored_once(spark):
    """Rows keep their nodes between levels, with the same trees; a report runs the scoring of a row once."""
    rows = spark.range(3000).select(
        (F.xxhash64("id") % 2 == 0).cast("int").alias(models.LABEL), F.col("id").alias("consumer_id"),
        *[((F.xxhash64("id", F.lit(k)) % 100) / 10 + (F.xxhash64("id") % 2)).alias(f"f{k}_x") for k in range(4)],
    )
    trees = []
    for keep in (True, False):
        made = models.forest(rows_per_node=50, trees=12, keep_nodes=keep)
        assert made.getCacheNodeIds() == keep
        trees.append([t.toDebugString.split("\n", 1)[1] for t in models.fit(rows, made, text=[]).model.trees])
    assert models.forest().getCacheNodeIds() and trees[0] == trees[1] and any("If" in t for t in trees[0])

    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def slow(x):
        calls.add(1)
        return (x % 10) / 10

    scored = rows.select("consumer_id", models.LABEL, slow("consumer_id").alias("prob_deact"), F.lit("m").alias("model"))
    for report in (models.holdout_report, lambda df: modelling._report(df, ["model"])):
        before = calls.value
        assert report(scored).count() in (1, 3)
        assert calls.value - before == 3000
