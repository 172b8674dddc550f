"""Analytics: A1, A4-A8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators import analytics, quality
from ledgerlake.sources.tables import Tables
from ledgerlake.plans.catalog.common import events_in_period


def customer_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: per customer, trailing 12 months: count, inflow, outflow, net,
    average per month (in cents)."""
    e = events_in_period(spark, sf_dir)
    s = analytics.cashflow_summary(e, "user_id", "amount_cents", months=12, places=0)
    return s.select("user_id", "total_transactions",
                    F.col("total_inflow").cast("bigint").alias("total_inflow"),
                    F.col("total_outflow").cast("bigint").alias("total_outflow"),
                    F.col("net_cashflow").cast("bigint").alias("net_cashflow"),
                    "avg_monthly_transactions")


def spending_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and type: count, amount, share of the amount (%)."""
    e = events_in_period(spark, sf_dir)
    g = e.groupBy("user_id", "transaction_type").agg(
        F.count(F.lit(1)).cast("int").alias("count"),
        F.sum(F.abs("amount_cents")).alias("amount_cents"))
    total = F.sum("amount_cents").over(Window.partitionBy("user_id"))
    return g.select("user_id", F.col("transaction_type").alias("type"), "count", "amount_cents",
                    (F.col("amount_cents") / total * 100).alias("percentage"))


def spending_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer, share of the amount by channel (branch/atm/online)."""
    e = events_in_period(spark, sf_dir).withColumn("abs_cents", F.abs("amount_cents"))
    return analytics.spending_by_channel(e, "user_id", "channel", "abs_cents",
                                         pct_places=None)


def max_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + F13: largest numeric id behind a text prefix, per table."""
    t = Tables(spark, sf_dir)
    c = analytics.max_id(t.customer, "c_name", "Customer#").select(
        F.lit("customer").alias("table_name"), "max_id")
    s = analytics.max_id(t.supplier, "s_name", "Supplier#").select(
        F.lit("supplier").alias("table_name"), "max_id")
    return c.unionByName(s)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: rows per table."""
    t = Tables(spark, sf_dir)
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
             "events", "documents", "embeddings", "pages", "benchmark", "labels",
             "conversations"]
    return analytics.table_counts({n: t.read(n) for n in names})


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + F24: (customer, day) pairs with more than one order, read
    through nested field paths."""
    o = Tables(spark, sf_dir).orders.select(
        F.struct(F.col("o_custkey").alias("customer_id"),
                 F.col("o_orderdate").alias("date")).alias("tx"))
    d = quality.duplicate_keys(o, ["tx.customer_id", "tx.date"])
    return d.select(F.col("customer_id"), F.col("date"), F.col("n"))
