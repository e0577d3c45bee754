"""What the queries' physical plans must not contain."""

import re

import pytest

import __spark_entry__
from loyalscope.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LEARNED = {"m3_random_forest", "m4_gradient_boosting", "m5_logistic_regression", "m10_feature_importance", "m11_batch_scores",
           "m13_profile_scores", "m15_training_run", "r4_profile_offers", "s12_model_reload", "t7_top_features", "r5_full_run"}
NAMES = [n for n in QUERIES if n not in LEARNED]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan(spark, name):
    plan = plan_of(__spark_entry__.queries()[name](spark, SF_DIR))
    for word in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    # a window always has a partition: "Window [...], [keys], [order]" and never "], [], ["
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"windowspecdefinition\((specified|\w+#\d+L? (ASC|DESC))", line)


def test_report_reads_only_its_columns(spark):
    plan = plan_of(__spark_entry__.queries()["a2a_churn_by_contract"](spark, SF_DIR))
    columns = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert [re.sub(r"#\d+", "", c) for c in columns] == ["Contract,Churn"]
    assert plan.count("Exchange ") == 1


def test_filters_reach_the_files(spark):
    plan = plan_of(__spark_entry__.queries()["p2_equality_filter"](spark, SF_DIR))
    assert "EqualTo(Contract,One year)" in plan


def test_share_of_total_scans_once(spark):
    df = __spark_entry__.queries()["a5_price_share"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan_of(df)
