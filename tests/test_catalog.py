import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur import session
from larkspur.operators import evaluate
from larkspur.plans import publish
from larkspur.sources import catalog, files


@pytest.fixture()
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    catalog.create_partitioned(spark, name, "consumer_id BIGINT, p DOUBLE", str(tmp_path / "t"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def day(spark, value, n, p=0.5):
    return spark.range(n).select(F.col("id").alias("consumer_id"), F.lit(p).alias("p"), F.lit(value).alias("record_date"))


def test_insert_replaces_one_day(spark, table):
    catalog.insert_snapshot(day(spark, "2020-01-01", 3), table)
    catalog.insert_snapshot(day(spark, "2020-01-02", 4), table)
    catalog.insert_snapshot(day(spark, "2020-01-01", 1), table)
    got = {r["record_date"]: r["count"] for r in spark.table(table).groupBy("record_date").count().collect()}
    assert got == {"2020-01-01": 1, "2020-01-02": 4}


def test_loaded_file_replaces_the_table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    path = str(tmp_path / "t")
    catalog.create_as(spark.createDataFrame([(1, "old"), (2, "old")], "id long, v string"), name, path, fmt="parquet")
    (tmp_path / "new.csv").write_text("v,id\nfresh,7\n")
    schema = T.StructType([T.StructField("v", T.StringType()), T.StructField("id", T.LongType())])
    catalog.replace_contents(files.read_csv(spark, str(tmp_path / "new.csv"), schema), name)
    assert [(r["id"], r["v"]) for r in spark.table(name).collect()] == [(7, "fresh")]
    spark.sql(f"DROP TABLE {name}")


def test_retention_gate_and_statistics(spark, table):
    for d in range(1, 10):
        catalog.insert_snapshot(day(spark, f"2020-01-0{d}", d), table)
    gone = catalog.retain(spark, table, "2020-01-09", 7)
    assert gone == ["2020-01-01", "2020-01-02"]
    catalog.analyse(spark, table, "2020-01-05")
    assert catalog.require_partition(spark, table, "2020-01-03") == "2020-01-03"
    with pytest.raises(catalog.MissingPartition):
        catalog.require_partition(spark, table, "2020-01-02")
    catalog.add_partition(spark, table, "2020-01-10")
    catalog.add_partition(spark, table, "2020-01-10")
    assert catalog.partitions(spark, table)[-1] == "2020-01-10"


def test_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "s")
    catalog.write_snapshot(day(spark, "2020-01-01", 3).union(day(spark, "2020-01-02", 5)), path)
    one = catalog.scan_partition(spark.read.orc(path), "2020-01-02")
    assert one.count() == 5
    assert "PartitionFilters: [isnotnull(record_date" in one._jdf.queryExecution().executedPlan().toString()


def test_bad_dates_become_null_and_codes_keep_zeros(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day\n1,2020-02-30\n2,2020-02-28\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType())])
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), schema, ("day",)).orderBy("id").collect()
    assert rows[0]["day"] is None and str(rows[1]["day"]) == "2020-02-28"
    (tmp_path / "codes.csv").write_text(
        "Estimates,,,,,,\n,,,,,,\nnotes\n\nSummary Level,State,County,,,,Name\n040,02,000,0,0,0,Alaska\n050,02,170,0,0,0,Some County\n"
    )
    got = files.region_codes(files.read_codes(spark, str(tmp_path / "codes.csv"))).collect()
    assert [(r["geo_id"], r["state"], r["county"]) for r in got] == [("02170", "Alaska", "Some County")]


def test_published_day_and_gate(spark, tmp_path):
    scored = spark.range(50).select(
        F.col("id").alias("consumer_id"), (F.col("id") * 7).cast("double").alias("recency_x"), F.lit(0.4).alias("prob_deact")
    )
    path, totals = str(tmp_path / "p"), str(tmp_path / "t")
    first = publish.daily_publish(scored, path, totals, "2020-01-01").first()
    assert first["prev_rate"] is None and first["stable"] is None
    second = publish.daily_publish(scored.withColumn("prob_deact", F.lit(0.9)), path, totals, "2020-01-02").first()
    assert second["stable"] == 0 and second["change"] > 1
    assert spark.read.orc(path).count() == 100
    assert spark.read.orc(totals).select("record_date").distinct().count() == 2


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    base = session.shared_dir(spark)
    assert session.work_path(spark, "x").startswith(base)
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


def test_replacing_a_partitioned_table_leaves_no_old_partition(spark, table):
    catalog.insert_snapshot(day(spark, "2020-01-01", 3), table)
    catalog.insert_snapshot(day(spark, "2020-01-02", 4), table)
    catalog.replace_contents(day(spark, "2020-01-01", 2), table)
    assert {r["record_date"]: r["count"] for r in spark.table(table).groupBy("record_date").count().collect()} == {"2020-01-01": 2}


def scores(spark, prob, n=50):
    recency = (F.col("id") * 7 % 366).cast("double")
    return spark.range(n).select(F.col("id").alias("consumer_id"), recency.alias("recency_x"), F.lit(prob).cast("double").alias("prob_deact"))


@pytest.fixture
def job(spark):
    name = f"job_{uuid.uuid4().hex[:8]}"
    yield publish.DailyJob(spark, f"{name}_p", f"{name}_t")
    for t in ("p", "t"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{t}")


def live(spark, job):
    return {r["record_date"]: (r["n"], round(r["p"], 6)) for r in spark.table(job.predictions).groupBy("record_date").agg(F.count("*").alias("n"), F.min("prob_deact").alias("p")).collect()}


def test_a_failed_gate_leaves_the_old_day(spark, job):
    with pytest.raises(catalog.MissingPartition):
        job.run(scores(spark, 0.4), "2020-01-01")
    assert live(spark, job) == {}
    gate = job.run(scores(spark, 0.4), "2020-01-01", first=True).first()
    assert gate["prev_rate"] is None
    job.run(scores(spark, 0.405), "2020-01-02")
    seen = live(spark, job)
    totals = sorted(map(str, spark.table(job.totals).collect()))
    for again in ("2020-01-02", "2020-01-03"):  # a shifted day, as a rerun and as a new one
        with pytest.raises(evaluate.DriftError):
            job.run(scores(spark, 0.9), again)
        assert live(spark, job) == seen and sorted(map(str, spark.table(job.totals).collect())) == totals
    job.run(scores(spark, 0.41, 60), "2020-01-02")  # a rerun that holds replaces the day
    assert live(spark, job) == {"2020-01-01": (50, 0.4), "2020-01-02": (60, 0.41)}
    with pytest.raises(catalog.MissingPartition):
        job.run(scores(spark, 0.4), "2020-01-09")


def test_audit_refuses_bad_rows(spark, job):
    twice = scores(spark, 0.4).union(scores(spark, 0.4, 1))
    for bad in (scores(spark, 0.4, 0), scores(spark, 1.2), scores(spark, None), scores(spark, float("nan")), twice):
        with pytest.raises(publish.AuditError):
            job.run(bad, "2020-01-01", mask_days=0, first=True)
    assert live(spark, job) == {}


def test_dropped_days_stay_away(spark, table):
    for d in range(1, 6):
        catalog.insert_snapshot(day(spark, f"2020-01-0{d}", d), table)
    assert catalog.retain(spark, table, "2020-01-05", 3) == ["2020-01-01", "2020-01-02"]
    catalog.recover_partitions(spark, table)
    assert catalog.partitions(spark, table) == ["2020-01-03", "2020-01-04", "2020-01-05"]
    catalog.retain(spark, table, "2020-01-06", 3, purge=False)
    catalog.recover_partitions(spark, table)
    assert "2020-01-03" in catalog.partitions(spark, table)
