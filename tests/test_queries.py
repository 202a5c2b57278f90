"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_cross_joins_and_partial_limits(spark):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    for name, fn in QUERIES.items():
        if name == "incremental_ingest":
            continue
        plan = fn(spark, SF)._jdf.queryExecution().explainString(mode)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        if name in ("dedupe_batch", "top_items_per_topic"):
            assert "WindowGroupLimit" in plan, name
        if name in ("seeded_sample", "disagreements", "run_history"):
            assert "TakeOrderedAndProject" in plan, name
        if name in ("sentiment_by_topic", "category_distribution", "distinct_topics", "class_metrics"):
            assert "text" not in plan.split("ReadSchema")[1], name


def test_rejects_are_assessed_once(spark, tmp_path):
    rows = [(i, "web", "en", f"<p>text {i} &amp; more", 20 + i) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = QUERIES["quarantine_upsert"](spark, str(tmp_path))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() > 0
    assert "doc_id" not in plan
