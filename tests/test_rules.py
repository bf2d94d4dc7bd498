"""Hand-checked cases of the edge rules."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from larkspur.functions import dates, numeric, text
from larkspur.operators import encode, evaluate, profile, quantiles, series
from larkspur.plans import customer as cust
from larkspur.plans import panel

D = dt.date


def column(df, name, order):
    return [r[name] for r in df.orderBy(order).collect()]


def days(spark, values, name="v"):
    rows = [("g", D(2020, 1, 1) + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"geo_id string, date date, {name} double")


def test_label(spark):
    base = spark.createDataFrame([(1, 10), (2, 10), (3, 10)], "consumer_id long, recency int")
    # last order 2000-01-01 when seen on 2000-01-11
    orders = spark.createDataFrame(
        [(1, D(2000, 12, 31)), (2, D(2001, 1, 1)), (3, D(1999, 5, 1))], "consumer_id long, order_date date"
    )
    out = cust.target_label(base, orders, "2000-01-11", "2001-07-29")
    assert column(out, "deactivated", "consumer_id") == [0, 1, 1]
    assert column(out, "last_train_order_date", "consumer_id")[0] == D(2000, 1, 1)


def test_forward_fill(spark):
    out = series.forward_fill(days(spark, [None, None, 3, None, 5]), ["v"], "geo_id", "date")
    assert column(out, "v", "date") == [0, 0, 3, 3, 5]


def test_fill_stays_inside_its_entity(spark):
    df = spark.createDataFrame(
        [("a", D(2020, 1, 1), 9.0), ("b", D(2020, 1, 1), None), ("b", D(2020, 1, 2), 4.0)], "geo_id string, date date, v double"
    )
    out = series.forward_fill(df, ["v"], "geo_id", "date").orderBy("geo_id", "date").collect()
    assert [r["v"] for r in out] == [9.0, 0.0, 4.0]


def test_cumulative_to_new(spark):
    out = series.cumulative_to_new(days(spark, [2, 2, 7, 6]), ["v"], "geo_id", "date")
    assert column(out, "new_v", "date") == [0, 0, 5, -1]


def test_change_rules(spark):
    out = series.change(days(spark, [0, 0, 4]), ["v"], "geo_id", "date")
    assert column(out, "v_wow_pct", "date") == [0, 0, 1.0]
    out = series.change(days(spark, [5, 2]), ["v"], "geo_id", "date")
    assert column(out, "v_wow_pct", "date") == [0, pytest.approx(-0.6)]
    assert column(out, "v_wow", "date") == [0, -3]
    old = panel.simple_change(days(spark, [0, 2]), "v", "geo_id", "date", 110.0, "c")
    assert column(old, "c", "date") == [0, 110.0]
    assert column(old, "c_class", "date") == ["no change", "100%+"]


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([-1.0, -0.5, -0.6, 1.0, 110.0])], "i int, v double")
    out = df.withColumn("c", numeric.change_class(F.col("v")))
    assert column(out, "c", "i") == [None, "-100% to -50%", "-100% to -50%", "50% to 100%", "100%+"]


def test_rolling_slope(spark):
    out = series.rolling_slope(days(spark, [1, 4, 2, 9]), ["v"], "geo_id", "date", 4, "_s")
    assert column(out, "v_s", "date") == [None, None, None, pytest.approx(2.2)]
    gap = series.rolling_slope(days(spark, [4, 2, 9, None]), ["v"], "geo_id", "date", 4, "_s")
    assert column(gap, "v_s", "date") == [None] * 4


def test_anomaly_uses_the_weeks_before(spark):
    out = series.rolling_anomaly(days(spark, [1, 2, 3, 6, 10]), ["v"], "geo_id", "date", 4, "_ma", "_an")
    assert column(out, "v_an", "date") == [None, None, None, None, 7.0]


def test_dedupe_keeps_the_first_entry(spark):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 1, None), ("b", 1, 3.0)], "k string, entry int, v double")
    out = series.dedupe_first(df, ["k"], "entry")
    assert [(r["k"], r["entry"], r["v"]) for r in out.orderBy("k").collect()] == [("a", 1, None), ("b", 1, 3.0)]


def test_mode_tie_and_quantile(spark):
    df = spark.createDataFrame([(float(v),) for v in (3, 3, 1, 1, 7)], "v double")
    assert profile.mode_smallest(df, ["v"]).first()["mode"] == 1.0
    assert quantiles.exact_quantiles(df, ["v"], [0.95]).first()["value"] == pytest.approx(6.2)


def test_iso_week_and_weekend(spark):
    row = spark.range(1).select(
        F.weekofyear(dates.as_date("2018-12-31")).alias("w"),
        dates.is_weekend(dates.as_date("2020-06-27")).alias("sat"),
        dates.is_weekend(dates.as_date("2020-06-26")).alias("fri"),
    ).first()
    assert (row["w"], row["sat"], row["fri"]) == (1, 1.0, 0.0)


def test_distinct_quarters_by_bits(spark):
    df = spark.createDataFrame(
        [(D(1999, 1, 1),), (D(1999, 3, 31),), (D(1999, 4, 1),), (D(2000, 4, 2),), (D(1998, 7, 28),)], "d date"
    )
    got = df.agg(F.bit_count(F.bit_or(dates.quarter_bit(F.col("d"), "2000-07-28"))).alias("n")).first()["n"]
    assert got == df.select(dates.quarter_year(F.col("d"))).distinct().count() == 4


def test_caps_and_flags(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([-50.0, 12.0, 900.0, None])], "i int, v double")
    assert column(df.withColumn("c", numeric.cap(F.col("v"), *cust.GP_CAPS)), "c", "i") == [-10, 12, 400, None]
    flags = spark.createDataFrame([(0, None), (1, 0), (2, 3)], "i int, v int")
    assert column(flags.withColumn("f", numeric.presence_flag(F.col("v"))), "f", "i") == [0, 0, 1]


def test_rare_label_is_strictly_greater(spark):
    df = spark.createDataFrame([("a",)] * 90 + [("b",)] * 5 + [("c",)] * 5, "k string")
    out = encode.RareGrouper.fit(df, ["k"], 0.05).transform(df)
    assert {r["k"]: r["count"] for r in out.groupBy("k").count().collect()} == {"a": 90, "Rare": 10}


def test_target_order(spark):
    train = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 2.0)], "k string, y double")
    test = spark.createDataFrame([(x,) for x in "abcd"], "k string").withColumn("raw", F.col("k"))
    out = encode.TargetOrder.fit(train, ["k"], "y").transform(test)
    assert {r["raw"]: r["k"] for r in out.collect()} == {"b": 0, "c": 1, "a": 2, "d": None}


def test_minmax_may_leave_the_unit_interval(spark):
    train = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "a double, b double")
    out = encode.MinMax.fit(train, ["a", "b"]).transform(spark.createDataFrame([(20.0, 5.0)], "a double, b double")).first()
    assert (out["a"], out["b"]) == (2.0, 0.0)


def test_titles(spark):
    df = spark.createDataFrame(list(enumerate(["Mrs. X", "Mr. Y", "Miss Z", "Master Q", "Dr. Q"])), "i int, n string")
    assert column(df.withColumn("t", text.title(F.col("n"))), "t", "i") == ["Mrs", "Mr", "Miss", "Master", "Other"]


def scored(spark, rows):
    return spark.createDataFrame(rows, "consumer_id long, recency int, y int, p double")


def test_mask(spark):
    out = evaluate.mask_probability(scored(spark, [(1, 361, 1, 0.4), (2, 362, 1, 0.4)]), "p", "recency", 3)
    assert column(out, "masked_prob", "consumer_id") == [0.4, 1.0]


def test_log_loss_at_certainty_drops_out(spark):
    df = scored(spark, [(1, 1, 0, 1.0), (2, 1, 0, 0.5)])
    assert evaluate.losses(df, "y", ["p"]).first()["log_loss_p"] == pytest.approx(math.log(2))


def test_half_is_predicted_one(spark):
    out = {r["actual"]: r for r in evaluate.confusion_matrix(scored(spark, [(1, 1, 1, 0.5)]), "y", "p").collect()}
    assert out["actual_1"]["predicted_1"] == 1 and out["total"]["total"] == 1


def test_class_metrics_from_known_counts(spark):
    counts = {(0, 0): 609798, (0, 1): 453914, (1, 0): 252274, (1, 1): 1648345}
    parts = [
        spark.range(n).select(F.col("id").alias("consumer_id"), F.lit(y).alias("y"), F.lit(0.9 if d else 0.1).alias("p"))
        for (y, d), n in counts.items()
    ]
    df = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    out = {r["class"]: r for r in evaluate.class_metrics(df, "y", "p").collect()}
    assert out["1"]["precision"] == pytest.approx(0.784083, abs=1e-6)
    assert out["1"]["recall"] == pytest.approx(0.867267, abs=1e-6)
    assert out["1"]["f1"] == pytest.approx(0.823580, abs=1e-6)
    assert out["weighted"]["f1"] == pytest.approx(0.755300, abs=1e-6)
    assert out["0"]["pred_over_actual"] == pytest.approx(0.810437, abs=1e-6)


def test_no_prediction_precision(spark):
    df = scored(spark, [(1, 1, 1, 0.2), (2, 1, 0, 0.1)])
    metrics = {r["class"]: r for r in evaluate.class_metrics(df, "y", "p").collect()}
    assert metrics["1"]["precision"] == 0.0
    curve = evaluate.cutoff_curve(df, "y", "p").orderBy("cutoff").collect()
    assert curve[-1]["precision"] == 1.0
    assert [(r["cutoff"], r["tp"], r["fp"]) for r in curve] == [(0.0, 1, 1), (0.11, 1, 0), (0.21, 0, 0)]


def test_cutoff_bucket_on_every_step(spark):
    df = spark.createDataFrame([(c, c / 100.0) for c in range(101)], "c int, p double")
    assert df.where(evaluate.cutoff_bucket(F.col("p")) != F.col("c")).count() == 0
    just_below = spark.createDataFrame([(c, math.nextafter(c / 100.0, 0)) for c in range(1, 101)], "c int, p double")
    assert just_below.where(evaluate.cutoff_bucket(F.col("p")) != F.col("c") - 1).count() == 0


def test_curve_equals_counting(spark):
    rows = [(i, 1, int((i * 37) % 100 < 40), ((i * 7919) % 1000) / 999.0) for i in range(500)]
    got = {r["cutoff"]: (r["tp"], r["fp"]) for r in evaluate.cutoff_counts(scored(spark, rows), "y", ["p"]).collect()}
    for c in range(101):
        want = tuple(sum(1 for r in rows if r[2] == y and r[3] >= c / 100.0) for y in (1, 0))
        assert got[c] == want


def test_drift_gate(spark):
    frame = lambda p: scored(spark, [(1, 1, 1, p)])
    bad = evaluate.drift(spark, frame(0.64), frame(0.602353), "p", "consumer_id", 0.05)
    with pytest.raises(evaluate.DriftError):
        evaluate.require_stable(bad, 0.05)
    good = evaluate.drift(spark, frame(0.61), frame(0.60), "p", "consumer_id", 0.05)
    assert evaluate.require_stable(good, 0.05) == pytest.approx(0.016667, abs=1e-6)


def test_split_is_a_partition_and_repeats(spark):
    from larkspur.functions.hashing import split_label

    keys = spark.range(1000)
    label = split_label(F.col("id"), (("a", 10), ("b", 10), ("c", 10), ("d", 70)))
    one = {r["id"]: r["s"] for r in keys.withColumn("s", label).collect()}
    two = {r["id"]: r["s"] for r in keys.repartition(7).withColumn("s", label).collect()}
    assert one == two and set(one.values()) == {"a", "b", "c", "d"}


def test_latest_attributes_equal_the_rank_form(spark):
    from pyspark.sql import Window

    rows = [(i % 5, D(2000, 1, 1 + i % 9), i, f"l{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "consumer_id long, order_timestamp date, order_id long, l1 string")
    got = cust.latest_attributes(df, "consumer_id", ("order_id", "l1"), ("order_timestamp", "order_id"))
    w = Window.partitionBy("consumer_id").orderBy(F.desc("order_timestamp"), F.desc("order_id"))
    want = df.withColumn("r", F.row_number().over(w)).where("r = 1")
    assert {(r[0], r[1], r[2]) for r in got.collect()} == {
        (r["consumer_id"], r["order_id"], r["l1"]) for r in want.collect()
    }


def test_scoring_schema_is_completed(spark):
    from larkspur.operators import joins

    df = spark.createDataFrame([(1, 2)], "b int, extra int")
    assert joins.missing_columns(df, ["a", "b"]) == ["a"]
    out = joins.align_schema(df, [("a", "double"), ("b", "bigint")])
    assert out.dtypes == [("a", "double"), ("b", "bigint")] and out.first() == (None, 1)


def test_scores_beyond_the_unit_interval(spark):
    probs = (1.5, 1.0, 0.0, -0.2, float("nan"), None)
    got = spark.createDataFrame([(p,) for p in probs], "p double").select(evaluate.cutoff_bucket(F.col("p")).alias("c")).collect()
    assert [r["c"] for r in got] == [100, 100, 0, None, None, None]
    df = spark.createDataFrame([(1, p) for p in probs], "y int, p double")
    curve = {r["cutoff"]: r["tp"] for r in evaluate.cutoff_counts(df, "y", ["p"]).collect()}
    assert (curve[0], curve[1], curve[100]) == (3, 2, 2)


def test_newest_orders_move_with_their_consumer(spark):
    """Wide rows take one shuffle, by consumer; ties of (time, id) that differ stay rows of their own."""
    import datetime as dt

    from larkspur.plans import customer as cust
    from larkspur.sources import star

    at = dt.datetime(2000, 7, 1, 12)
    row = lambda c, o, t, platform, nob: (c, o, t, t.date(), 5.0, "F", "1-URGENT", "Free", platform, 1, 0, 2, nob, 1.0, 1.0, 0.5, 0.0, 0.0, "L1 - Local", "L2 - Home", "OD")
    rows = [row(1, 7, at, "web", 10.0), row(1, 7, at, "web", 10.0), row(1, 6, at, "app", 3.0), row(2, 9, at, "web", 1.0), row(2, 9, at, "app", 1.0), row(None, 5, at, "web", 1.0)]
    fields = "consumer_id long, order_id long, order_timestamp timestamp, order_date date, txn_amount double, action string, traffic_source string, traffic_type string, platform string, is_activation int, is_reactivation int, units long, nob double, nor double, gp double, discount_amount double, ils_discount double, wow_discount double, l1 string, l2 string, promo_type string"
    out = cust.order_features(spark.createDataFrame(rows, fields), star.ORDERS_ASOF)
    got = sorted((r["consumer_id"], r["most_recent_platform"], r["frequency_t24m"], r["nob_t24m"]) for r in out.collect())
    assert got == [(1, "web", 3, 23.0), (2, "app", 2, 2.0), (2, "web", 2, 2.0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.splitlines()[1].strip(" +-").startswith("Join Inner") and "Aggregate" not in plan.splitlines()[0]


def test_rows_of_absent_keys_go_out_before_they_move(spark):
    from larkspur.sources import star

    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).union(spark.sql("SELECT CAST(NULL AS LONG), 1L"))
    keys = spark.range(0, 5000, 50).select(F.col("id").alias("key"))
    for bits, most in ((26, 100), (6, 5001)):  # a full set of bits lets rows pass, and loses none
        out = star.perhaps_among(rows, "k", keys, bits)
        assert out.columns == ["k", "v"] and 100 <= out.count() <= most
        assert out.join(keys, F.col("k") == F.col("key"), "left_semi").count() == 100
