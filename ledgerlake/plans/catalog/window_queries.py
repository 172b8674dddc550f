"""Windows: W3, W4 (both running-balance methods)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import scalars as FX
from ledgerlake.operators import analytics
from ledgerlake.plans import roles as R
from ledgerlake.sources.tables import Tables


def sequence_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 + F12: sequential branch ids over filtered suppliers."""
    t = Tables(spark, sf_dir)
    nat = t.nation.where(F.col("n_regionkey").isin(1, 2)).select("n_nationkey")
    s = t.supplier.join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    s = s.select("s_suppkey", "s_name")
    numbered = analytics.sequence_ids(s, ["s_suppkey"], "seq")
    return numbered.select("s_suppkey", "s_name",
                           FX.format_id(S.ID_PREFIXES["branch"], "seq", S.ID_WIDTH).alias("branch_id"))


def running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening balance + cumulative signed amount per customer (cents)."""
    t = Tables(spark, sf_dir)
    e = R.signed_events(spark, t).select("event_id", "user_id", "ts", "amount_cents")
    acc = t.customer.select("c_custkey", R.cents("c_acctbal").alias("open_cents"))
    out = analytics.running_balance(e, "user_id", ["ts", "event_id"], "amount_cents",
                                    opening=acc, opening_key="c_custkey",
                                    opening_balance="open_cents", out_col="running_balance")
    return out.select("event_id", "user_id", F.col("running_balance").cast("bigint")
                      .alias("running_balance"))


def running_balance_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4's prefix sum itself, on events whose every third key, every fifth
    time and every seventh amount is NULL: NULL keys are one key, NULL times
    come first, NULL amounts count as 0."""
    e = R.signed_events(spark, Tables(spark, sf_dir))
    e = e.select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id"),
                 F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("ts"),
                 F.when(F.col("event_id") % 7 != 0, F.col("amount_cents")).alias("amount_cents"))
    out = analytics.running_balance_ranges(e, "user_id", ["ts", "event_id"], "amount_cents")
    return out.select("event_id", "user_id", F.col("running_balance").cast("bigint")
                      .alias("running_balance"))


def next_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + W3 + F12: transaction ids for the live events that continue after
    the largest id of the batch transactions (orders), in event order."""
    t = Tables(spark, sf_dir)
    existing = t.orders.select(FX.format_id("TXN", "o_orderkey", S.TRANSACTION_ID_WIDTH).alias("tid"))
    ev = t.events.select("event_id", "ts")
    out = analytics.next_ids(ev, existing, "tid", "TXN", ["ts", "event_id"], "transaction_id",
                             S.TRANSACTION_ID_WIDTH)
    return out.select("event_id", "transaction_id")
