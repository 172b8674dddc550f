"""Helpers shared by the query modules (role-mapped frames and small shapes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import conform, slices
from ledgerlake.plans import roles as R
from ledgerlake.sources.lookups import lookup, rows_frame
from ledgerlake.sources.tables import Tables


def orders_as_balances(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("account_id"),
                           F.col("o_orderkey").alias("transaction_id"),
                           F.col("o_orderdate").alias("timestamp"),
                           F.col("o_totalprice").alias("balance_after"))


def as_ntz(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ (the driver tables' type) for comparison."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def orders_as_loans(spark: SparkSession, t: Tables) -> DataFrame:
    lk = {"loan_types": lookup(spark, "loan_types"),
          "loan_status_types": lookup(spark, "loan_status_types"),
          "prio": rows_frame(spark, R.ORDER_PRIORITY_ROLES, "code string, id int"),
          "status": rows_frame(spark, R.ORDER_STATUS_ROLES, "code string, id int")}
    o = conform.resolve_codes(t.orders, [
        ("o_orderpriority", "prio", "code", "id", "loan_type_id"),
        ("o_orderstatus", "status", "code", "id", "loan_status_id"),
        ("loan_type_id", "loan_types", "loan_type_id", "type_name", "loan_type"),
        ("loan_status_id", "loan_status_types", "status_id", "status_name", "loan_status"),
    ], lk)
    return o


def events_in_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = R.signed_events(spark, Tables(spark, sf_dir))
    lo, hi = slices.trailing_months(R.EVENTS_AS_OF, 12)
    return slices.between_dates(e, "ts", lo, hi)


def loan_terms(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return lines.select("l_orderkey", (F.col("n_lines") * R.TERM_MONTHS_PER_LINE).cast("int")
                        .alias("term"))
