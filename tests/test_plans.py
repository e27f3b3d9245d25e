"""Physical-plan checks: push-down, pruning, partial aggregation, no Python in plans."""

import re

import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
# queries whose callables write intermediate data before returning a frame
SIDE_EFFECTS = {"stream_landing", "stream_dedupe", "stream_batch_convergence", "stream_alarm", "incremental_ingest",
                "medallion_customer_360", "medallion_incremental", "medallion_compacted", "medallion_counts", "stream_landing_progress", "csv_text_scan",
                "medallion_full_then_incremental", "stream_landing_bounded",
                "stream_late_rows", "stream_alarm_kept",
                "zone_sql", "dq_results_retry"}


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() if mode == "exec" else \
        df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", [k for k in registry.QUERIES if k not in SIDE_EFFECTS])
def test_no_python_evaluation(spark, name):
    p = plan(registry.QUERIES[name](spark, SF))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", p)


def test_profile_pushes_status_and_prunes(spark):
    p = plan(registry.q_customer_profile(spark, SF))
    assert "EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in p
    assert p.count("partial_count") >= 1


def test_category_aggregates_before_product_join(spark):
    p = plan(registry.q_category_performance(spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in p
    assert "EqualTo(o_orderstatus,F)" in p
    # the per-product aggregate sits under the join with the product table:
    # in the plan tree, a HashAggregate appears below (after) the LeftOuter join
    tree = p.split("\n\n")[0]
    join_at = re.search(r"(HashJoin|SortMergeJoin) LeftOuter", tree)
    assert join_at and "HashAggregate" in tree[join_at.end():]


def test_dedupe_is_partial_aggregation_not_window(spark):
    p = plan(registry.q_dedupe_first(spark, SF))
    assert "partial_min" in p and "Window" not in p


def test_funnel_dropoff_has_no_join_or_keyed_shuffle(spark):
    p = plan(registry.q_funnel_dropoff(spark, SF))
    assert "Join" not in p and "hashpartitioning" not in p


def test_dq_suite_scans_each_table_once_per_pass(spark):
    p = plan(registry.q_dq_suite(spark, SF))
    orders_scans = len(re.findall(r"Scan parquet .*?orders\.parquet", p, re.S)) or \
        p.count("orders.parquet]")
    assert orders_scans <= 2, orders_scans
    assert "Expand" not in p


def scans(p, table):
    """Scans of a table in the plan tree (a reused exchange is read once)."""
    return len(re.findall(rf"Location: InMemoryFileIndex [^\n]*/{table}\.parquet\]", p))


def test_rejects_come_from_one_pass(spark):
    """One scan of lines and orders, one outer join to the customer keys, no union of branches."""
    p = plan(registry.q_stage_transactions_rejects(spark, SF))
    assert scans(p, "lineitem") == 1 and scans(p, "orders") == 1 and "Union" not in p
    assert "LeftAnti" not in p and "LeftSemi" not in p and "LeftOuter" in p


@pytest.mark.parametrize("name", ["json_decode", "json_dead_letter", "union_sources", "json_decode_faulty"])
def test_records_are_parsed_once(spark, name):
    """One from_json in the whole executed plan: filters and projections do not repeat it."""
    df = registry.QUERIES[name](spark, SF)
    tree = df._jdf.queryExecution().executedPlan().toString()
    assert tree.count("from_json(") == 1, tree


def test_incremental_reads_history_as_keys_only(spark, tmp_dir):
    """The anti join against everything staged reads the key column and no other."""
    from tidemark.operators.joins import new_keys
    staged = registry.q_stage_clickstream(spark, SF)
    staged.write.parquet(f"{tmp_dir}/staged")
    p = plan(new_keys(staged, spark.read.parquet(f"{tmp_dir}/staged"), ["event_id"]))
    assert "ReadSchema: struct<event_id:bigint>" in p and "LeftAnti" in p
