"""Plan-shape checks over every registered query (the scale rules, enforced by test)."""
import pytest

SF001 = "/root/testdata/sf0.001"
MODEL = {"rf_importance", "score_customers", "predicted_by_segment", "model_metrics", "permutation_importance",
         "customer_clusters", "grid_search", "boosted_trees", "top_features", "analysis_summary", "yeo_johnson_fit", "tree_attributions"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "percentile(", "collect_list("]


def _plan(df) -> str:
    # Formatted physical plan including subqueries, as explain("formatted") prints it.
    mode = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution, "FormattedMode$"), "MODULE$")
    return df._jdf.queryExecution().explainString(mode)


def test_no_cross_joins_or_single_task_percentiles(spark):
    from clientele.plans import catalog
    bad = {}
    for name, fn in catalog.QUERIES.items():
        if name in MODEL:
            continue
        text = _plan(fn(spark, SF001))
        hits = [f for f in FORBIDDEN if f in text]
        if hits:
            bad[name] = hits
    assert not bad, bad


@pytest.mark.parametrize("table,cols", [("lineitem", {"l_orderkey", "l_partkey", "l_quantity"}),
                                        ("orders", {"o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                                    "o_orderpriority"})])
def test_customer_table_scans_only_needed_columns(spark, table, cols):
    import re
    from clientele.sources.customer_base import customer_base
    text = _plan(customer_base(spark, SF001))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    prefix = table[0] + "_"
    for s in schemas:
        names = {f.split(":")[0] for f in s.split(",")}
        if all(n.startswith(prefix) for n in names) and names & cols:
            assert names == cols
            return
    raise AssertionError(f"no scan of {table} found")


def test_detector_sees_forbidden_operators(spark):
    from pyspark.sql import functions as F
    a = spark.range(10)
    assert "percentile(" in _plan(a.agg(F.percentile("id", 0.5)))
    b = spark.range(3).withColumnRenamed("id", "j")
    assert "BroadcastNestedLoopJoin" in _plan(a.join(b, a.id < b.j))
