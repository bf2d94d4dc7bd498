"""Bounds of the fitted encoders and schemas of replaced files."""

from pyspark.sql import functions as F

from larkspur.operators import ranks
from larkspur.operators.encode import TargetOrder
from larkspur.sources.star import load

TRAIN = "label string, t double"


def test_target_order_without_labels_gives_nulls(spark):
    order = TargetOrder.fit(spark.createDataFrame([], TRAIN), ["label"], "t")
    out = order.transform(spark.createDataFrame([("a", 1.0)], TRAIN))
    assert [r["label"] for r in out.collect()] == [None]


def test_target_order_of_any_number_of_labels(spark):
    """A long list of ranks is joined and gives what a short one, looked up in the plan, gives."""
    train = spark.createDataFrame([(str(i), float((i * 7) % 50)) for i in range(50)], TRAIN)
    rows = spark.createDataFrame([(str(i % 60), float(i)) for i in range(200)] + [(None, 0.5)], TRAIN)
    got = {most: sorted(map(str, TargetOrder.fit(train, ["label"], "t", most=most).transform(rows).collect())) for most in (50, 49, 0)}
    assert got[50] == got[49] == got[0]
    seen = {r["t"]: r["label"] for r in TargetOrder.fit(train, ["label"], "t", most=0).transform(rows).collect()}
    assert seen[3.0] == 21 and seen[55.0] is None and seen[0.5] is None


def test_ranks_come_from_ranges(spark):
    """No window spans a column: every order is inside a range, and a hot key has many ranges."""
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"), (F.col("id") * 7919 % 5003).alias("v"))
    out = ranks.global_rank(df, [F.desc("v")], ["k"], partitions=16)
    want = {}
    for r in sorted(df.collect(), key=lambda r: -r["v"]):
        want.setdefault(r["k"], []).append(r["v"])
    got = {(r["k"], r["v"]): r["rank"] for r in out.collect()}
    assert got == {(k, v): i for k, vs in want.items() for i, v in enumerate(vs)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert all("__range" in line for line in plan.splitlines() if "Window" in line)
    assert ranks.global_rank(df.where("false"), [F.col("v")]).count() == 0


def test_replaced_table_is_read_with_its_new_schema(spark, tmp_path):
    for value in ("1 AS a", "2 AS a, 3 AS b"):
        spark.sql(f"SELECT {value}").write.mode("overwrite").parquet(f"{tmp_path}/region.parquet")
        rows = load(spark, str(tmp_path), "region").collect()
    assert rows[0].asDict() == {"a": 2, "b": 3}
