"""Plan shapes that matter at scale, read from the executed plans."""

import __spark_entry__ as E
from ledgerlake.plans.bank_queries import QUERIES
from tests.conftest import SF001


def plan(spark, name):
    df = E.queries()[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_limits_rows_before_the_shuffle(spark):
    p = plan(spark, "latest_balance")
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    # only the four needed columns are read
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p


def test_latest_agg_is_partial(spark):
    p = plan(spark, "latest_balance_agg")
    assert "partial_max_by" in p


def test_month_slice_filters_reach_the_scan(spark):
    p = plan(spark, "scan_month_range")
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_constant_lookups_are_broadcast(spark):
    p = plan(spark, "conform_transactions")
    assert p.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in p


def test_flat_children_have_no_left_outer_join(spark):
    p = plan(spark, "customer360_tx")
    assert "LeftOuter" not in p and "LeftAnti" in p


def test_running_balance_reads_only_keys_for_the_offsets(spark):
    p = plan(spark, "running_balance_ranges")
    assert "partial_max_by" in p and "BroadcastHashJoin" in p


def test_cashflow_aggregates_are_partial(spark):
    p = plan(spark, "customer_analytics")
    assert "partial_count" in p or "partial_sum" in p


def test_sql_text_form_plans_like_the_dataframe_form(spark):
    p = plan(spark, "latest_balance_sql")
    assert "partial_max_by" in p and "Window" not in p


def test_sql_functions_run_without_python(spark):
    p = plan(spark, "sql_functions")
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_star_fact_slices_push_date_filters(spark):
    for name in ("star_fact_transactions", "star_fact_loan_payments", "transactions_12m", "payments_6m"):
        p = plan(spark, name)
        assert "PushedFilters: [IsNotNull(" in p and "GreaterThanOrEqual(" in p and "LessThan(" in p, name


def test_partitioned_scan_prunes_directories(spark):
    p = plan(spark, "partitioned_month_scan")
    assert "PartitionFilters: [(((year" in p


def test_landing_plans_join_constants_without_shuffle(spark):
    for name in ("landing_transactions", "landing_cards", "conform_cards", "conform_loans"):
        p = plan(spark, name)
        assert "SortMergeJoin" not in p and "Exchange hashpartitioning" not in p, name


def test_no_python_in_any_registered_plan(spark):
    for name in QUERIES:
        if name.startswith("stream_") or name in ("running_balance_ranges", "sequence_id",
                                                   "customer360_tx_chunks"):
            continue   # streams and checkpointed results are planned over their written output
        p = plan(spark, name)
        assert "EvalPython" not in p and "MapInPandas" not in p, name


def test_latest_aggregates_are_hashed_and_sort_nothing(spark):
    """Fixed-width buffers: no sort of all rows before the partial aggregate."""
    for name in ("latest_balance_agg", "latest_balance_sql", "customer360_summary"):
        p = plan(spark, name)
        assert "SortAggregate" not in p and "partial_max_by" in p, name
    assert "WindowGroupLimit" in plan(spark, "latest_child")
    assert plan(spark, "customer360_summary").count("events.parquet") == 1
