import __spark_entry__ as contract


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 120


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert "days_until_deact" in df.columns and df.count() > 0


SAMPLE = (
    "features_all",
    "trend_panel",
    "cutoff_curve",
    "roc_cross_join",
    "channel_weekly",
    "knapsack_greedy",
    "dispatch_min_cost",
    "quantile_tail",
    "recency_aggregation",
    "compare_full_outer",
)


def test_no_python_and_no_products_in_plans(spark, sf_dir):
    for name in SAMPLE:
        plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, f"{word} in {name}"


def test_filter_and_columns_reach_the_scan(spark, sf_dir, capsys):
    contract.queries()["filter_compound"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "o_custkey" not in plan
    assert "GreaterThan(o_totalprice,100000.0)" in plan


def test_bucketed_join_has_no_shuffle(spark, sf_dir):
    plan = contract.queries()["bucketed_join"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
