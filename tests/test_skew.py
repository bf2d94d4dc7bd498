"""Hot keys and large groups: the special paths give the plain result."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import joins, quantiles
from larkspur.plans import knapsack
from larkspur.sources.files import read_instances


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_equals_join(spark, how):
    left = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    left = left.union(spark.createDataFrame([(None, 1), (999, 2)], "k long, v long"))
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).union(
        spark.createDataFrame([(-1, 7)], "k long, w long")
    )
    assert joins.hot_keys(left, ["k"], 0.05).count() == 1
    got = joins.sliced_join(left, right, ["k"], F.col("v"), how=how, share=0.05)
    want = left.join(right, "k", how)
    assert sorted(map(str, got.select("k", "v", "w").collect())) == sorted(map(str, want.select("k", "v", "w").collect()))


def test_quantiles_with_hot_value_and_hot_group(spark):
    rng = random.Random(5)
    values = [("hot", 1.0)] * 3000 + [("hot", rng.gauss(0, 1e6)) for _ in range(3000)] + [("cold", float(i)) for i in range(7)]
    values += [("cold", None)]
    df = spark.createDataFrame(values, "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.75, 0.999, 1.0]
    for bins in (4, 64):
        got = {(r["g"], r["prob"]): r["value"] for r in quantiles.exact_quantiles(df, ["v"], probs, ["g"], bins).collect()}
        for g in ("hot", "cold"):
            data = [v for k, v in values if k == g and v is not None]
            for p in probs:
                assert got[(g, p)] == pytest.approx(float(np.quantile(data, p)), rel=1e-12, abs=1e-9)
        whole = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["v"], probs, bins=bins).collect()}
        data = [v for _, v in values if v is not None]
        assert whole == {p: pytest.approx(float(np.quantile(data, p)), rel=1e-12, abs=1e-9) for p in probs}


def test_quantiles_split_cells_until_one_task_can_order_them(spark):
    """A million and more distinct values that share their leading 16 bits are cut again; so is a hot value."""
    near = spark.range(1_200_000).select((1.0 + F.col("id") * 2.0**-40).alias("v"))
    df = near.union(spark.range(300_000).select(F.lit(1.0 + 2.0**-41).alias("v")))
    data = np.concatenate([1.0 + np.arange(1_200_000) * 2.0**-40, np.full(300_000, 1.0 + 2.0**-41)])
    probs = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    got = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(df, ["v"], probs).collect()}
    assert got == {p: float(np.quantile(data, p)) for p in probs}
    keyed = df.withColumn("g", F.lit(None).cast("string"))
    for most in (1_000_000, 5_000):
        got = {r["prob"]: r["value"] for r in quantiles.exact_quantiles(keyed, ["v"], probs, ["g"], most=most).collect()}
        assert got == {p: float(np.quantile(data, p)) for p in probs}


def test_sortable_numbers_are_the_bits(spark):
    from larkspur.functions.numeric import from_sortable, with_sortable

    rng = random.Random(3)
    bits = [rng.getrandbits(63) for _ in range(20_000)] + [e << 52 | m for e in range(2047) for m in (0, 1, (1 << 52) - 1)]
    data = np.array(bits, np.int64).view(np.float64)
    data = data[np.isfinite(data)]
    data = np.concatenate([data, -data, [0.0, -0.0, np.inf, -np.inf]])
    df = with_sortable(spark.createDataFrame([(float(v),) for v in data], "v double"), "v", "s")
    for v, s in df.collect():
        image = int(np.float64(abs(v)).view(np.int64))
        assert s == (-image if v < 0 else image) and from_sortable(s) == v


def test_mode_in_a_hash_aggregate(spark):
    from larkspur.operators.profile import mode_smallest

    rows = [(2.0,), (2.0,), (-1.5,), (-1.5,), (9.0,), (None,), (float("nan"),), (float("nan"),)]
    out = mode_smallest(spark.createDataFrame(rows, "v double"), ["v"])
    assert out.collect()[0][:3] == ("v", -1.5, 2)
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_quantiles_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    out = {r["g"]: r["median"] for r in quantiles.median_by(df, "v", ["g"]).collect()}
    assert out == {None: 2.0, "a": 5.0}


def plain_greedy(items, capacity):
    value = weight = taken = 0
    for v, w in items:
        if weight + w <= capacity:
            value, weight, taken = value + v, weight + w, taken + 1
    return value, weight, taken


def knapsack_frame(spark, instances):
    rows = [(name, i, v, w, cap) for name, (items, cap) in instances.items() for i, (v, w) in enumerate(items)]
    return spark.createDataFrame(rows, "instance string, item long, value long, weight long, capacity long")


def test_greedy_known_cases(spark):
    known = {"a": ([(16, 2), (19, 3), (23, 4), (28, 5)], 7), "b": ([(8, 4), (10, 5), (15, 8), (4, 3)], 11)}
    out = {r["instance"]: (r["value"], r["weight"], r["taken"]) for r in knapsack.greedy(knapsack_frame(spark, known)).collect()}
    assert out == {"a": (35, 5, 2), "b": (18, 9, 2)}


def test_greedy_in_blocks_equals_greedy(spark):
    rng = random.Random(11)
    some = {}
    for n in range(6):
        items = [(rng.randint(1, 99), rng.randint(1, 60)) for _ in range(rng.choice([3, 40, 150]))]
        some[f"i{n}"] = (items, rng.choice([5, 70, 900, 10_000]))
    some["falling"] = ([(1, w) for w in range(80, 0, -1)], 100)
    some["nothing fits"] = ([(5, 50)] * 30, 10)
    df = knapsack_frame(spark, some)
    want = {k: plain_greedy(items, cap) for k, (items, cap) in some.items()}
    for array_items, block in ((20, 7), (20, 1000), (1000, 7)):
        out = knapsack.greedy(df, array_items, block).collect()
        got = {r["instance"]: (r["value"], r["weight"], r["taken"]) for r in out}
        assert got == want


def test_instances_keep_line_order_over_file_splits(spark, tmp_path):
    lines = [f"{i * 3} {i + 1}" for i in range(3000)]
    (tmp_path / "one.txt").write_text("3000 77\n" + "\n".join(lines) + "\n")
    (tmp_path / "two.txt").write_text("2 9\n5 4\n6 3\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        df = read_instances(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 0
        rows = df.orderBy("instance", "item").collect()
    finally:
        spark.conf.set(key, before)
    one = [r for r in rows if r["instance"].endswith("one.txt")]
    assert [(r["item"], r["value"], r["weight"], r["capacity"]) for r in one] == [(i, i * 3, i + 1, 77) for i in range(3000)]
    two = [r for r in rows if r["instance"].endswith("two.txt")]
    assert [(r["item"], r["value"], r["weight"], r["capacity"]) for r in two] == [(0, 5, 4, 9), (1, 6, 3, 9)]


def test_greedy_keeps_fractions(spark):
    """Fractional weights are not cut, and both ways through give what fits."""
    rows = [("a", i, v, w, 5.0) for i, (v, w) in enumerate([(1.9, 2.9), (3.9, 2.9), (0.5, 2.1), (9.0, 0.01)])]
    rows += [("b", i, 1.25, 0.1, 0.3) for i in range(5)]
    frame = spark.createDataFrame(rows, "instance string, item int, value double, weight double, capacity double")
    for array_items in (50, 1):
        got = {r["instance"]: tuple(r)[1:] for r in knapsack.greedy(frame, array_items=array_items, block=2).collect()}
        assert got == {"a": (5.0, 2.4, 5.0, 2), "b": (0.3, 3.75, 0.3, 3)}
