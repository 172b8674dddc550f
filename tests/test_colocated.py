"""Customer 360 from bucketed tables, calendar-pruned scans: results and plans."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import colocated, nest, slices
from ledgerlake.plans.catalog import live_queries as L
from ledgerlake.plans.star import dim_date
from ledgerlake.sinks.writers import write_partitioned


@pytest.fixture
def tables(spark):
    made = [f"default.t{i}_{uuid.uuid4().hex[:8]}" for i in range(3)]
    yield made
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def events(spark, n=400):
    rows = [(None if i % 50 == 9 else 1 if i % 3 == 0 else i % 17, dt.datetime(2025, 1, 1) + dt.timedelta(minutes=i * 7 % 90), i, float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, ts timestamp, event_id long, value double")


@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_chunks_equal_the_shuffled_form(spark, tables, tmp_path, hot_rows):
    df = events(spark)
    kids = colocated.ColocatedChildren(spark, tables[0], str(tmp_path / "hot"), "user_id", ["ts", "event_id"], 4)
    kids.write(df, hot_rows=hot_rows)
    assert (kids.hot().count() > 0) == (hot_rows == 20)
    assert kids.hot().count() + spark.table(tables[0]).count() == 400
    show = lambda chunks: sorted(((r.user_id, r.chunk, r.n, [x.event_id for x in r["items"]]) for r in chunks.collect()), key=str)
    assert show(kids.chunks(7)) == show(nest.nest_children_chunked(df, "user_id", ["ts", "event_id"], 7))


def test_no_shuffle_for_all_customers(spark, tables, tmp_path):
    customers, loans, table = tables
    colocated.write_bucketed(spark.range(25).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name")), customers, "c_custkey", 4)
    colocated.write_bucketed(spark.range(60).select((F.col("id") % 20).alias("o_custkey"), F.lit(5).cast("long").alias("cents")), loans, "o_custkey", 4)
    kids = colocated.ColocatedChildren(spark, table, str(tmp_path / "hot"), "user_id", ["ts", "event_id"], 4)
    kids.write(events(spark))
    docs = L.colocated_documents(spark, customers, loans, kids)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 3
    rows = docs.collect()
    assert {r.c_custkey for r in rows} == set(range(25)) and {r.n_loans for r in rows if r.c_custkey < 20} == {3}
    assert next(r for r in rows if r.c_custkey == 24).n == 0
    assert sum(r.n for r in rows) == events(spark).where("user_id IS NOT NULL").count()


def test_calendar_prunes_months_at_run_time(spark, tmp_path):
    root = str(tmp_path / "fact")
    days = [(i, dt.datetime(2024, 1, 1, 13) + dt.timedelta(days=i)) for i in range(0, 700, 3)] + [(-1, None)]
    df = spark.createDataFrame(days, "id long, o_orderdate timestamp")
    write_partitioned(df.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}), root, ("year", "month"))
    got = L.calendar_plan(spark, root)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression(year" in plan and plan.count("SubqueryAdaptiveBroadcast") == 2
    want = sorted(i for i, d in days if d and d.weekday() >= 5 and (d.month - 1) // 3 in (1, 3))
    assert sorted(r.id for r in got.collect()) == want and want
    march = slices.scan_calendar(spark.read.parquet(root), dim_date(spark, "2024-01-01", "2025-12-31").where("month = 3 AND day < 9"), "o_orderdate")
    assert sorted(r.id for r in march.collect()) == sorted(i for i, d in days if d and d.month == 3 and d.day < 9)
