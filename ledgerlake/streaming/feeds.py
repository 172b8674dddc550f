"""Keyed JSON records in and out.

A record is ``(key, value)`` with ``value`` the JSON text of the row, the
shape a key-value stream (Kafka, Kinesis) carries.  ``parse_feed`` reads
such records back with an explicit schema.  Both work on batch and
streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas as S

FEEDS = {"transaction": S.FEED_TRANSACTION, "loan_payment": S.FEED_LOAN_PAYMENT,
         "loan": S.FEED_LOAN}

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "ignoreNullFields": "true"}


def envelope(df: DataFrame, key_col: str, num_partitions: int | None = None) -> DataFrame:
    """K9: ``key`` = the partition key as text, ``value`` = JSON of the row.
    ``num_partitions`` hash-partitions by key (R6: records of a key stay in
    order on one shard)."""
    out = df.select(F.col(key_col).cast("string").alias("key"),
                    F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("value"))
    if num_partitions:
        out = out.repartition(num_partitions, "key")
    return out


def parse_feed(records: DataFrame, feed: str, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON records -> typed columns by the feed's schema, and the
    columns of the envelope named in ``keep`` (a send time).
    A number where text is declared (a loan status sent as 3) reads as '3'."""
    schema = FEEDS[feed]
    return records.select(F.from_json(F.col(value_col).cast("string"), schema).alias("r"), *keep
                          ).select("r.*", *keep)


# Dates in feed records are text; a malformed one reads as NULL (the
# quality checks report it) instead of failing the stream under ANSI mode.
def _ts(c: str):
    return F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss"))


def _date(c: str):
    return F.try_to_date(F.col(c), "yyyy-MM-dd")


def typed_transactions(parsed: DataFrame) -> DataFrame:
    """The transaction feed with its text date read as a timestamp."""
    return parsed.withColumn("timestamp", _ts("date"))


def typed_loans(parsed: DataFrame) -> DataFrame:
    """The loan feed with dates read and the status normalised."""
    from ledgerlake.operators.conform import normalize_status
    return parsed.withColumns({
        "start_date": _date("start_date"), "end_date": _date("end_date"),
        "status": normalize_status(F.col("status"))})


def typed_payments(parsed: DataFrame) -> DataFrame:
    cols = ["scheduled_payment_date", "payment_date", "paid_date"]
    return parsed.withColumns({c: _date(c) for c in cols})


def transactions_to_fact(typed: DataFrame) -> DataFrame:
    """Transaction feed -> ``fact_transactions`` columns (+ year, month).
    The feed carries no ``balance_after``; it stays NULL here (see W4/R2)."""
    from ledgerlake.functions.scalars import date_key
    ts = F.col("timestamp")
    return typed.select("transaction_id", "account_id", "employee_id",
                        date_key(ts).alias("date_id"), ts.alias("timestamp"), "currency",
                        "type", "amount", F.lit(None).cast("long").alias("balance_after"),
                        F.year(ts).alias("year"), F.month(ts).alias("month"))


def payments_to_fact(typed: DataFrame) -> DataFrame:
    """Loan-payment feed -> ``fact_loan_payments`` columns (+ year, month of paid date)."""
    from ledgerlake.functions.scalars import date_key
    return typed.select(
        "payment_id", "loan_id", "transaction_id",
        date_key("scheduled_payment_date").alias("scheduled_payment_date_id"),
        date_key("payment_date").alias("payment_date_id"),
        date_key("paid_date").alias("paid_date_id"),
        "payment_amount", "principal_amount", "paid_amount", "scheduled_payment_date",
        "payment_date", "paid_date",
        F.year("paid_date").alias("year"), F.month("paid_date").alias("month"))


def loans_to_dim(typed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Loan feed -> ``dim_loans`` columns (+ year, month of the start date, + ``keep``)."""
    return typed.select("loan_id", "customer_id", "amount",
                        F.col("interest_rate").cast("float").alias("interest_rate"), "term",
                        "start_date", "end_date", "type", "status",
                        F.year("start_date").alias("year"), F.month("start_date").alias("month"), *keep)


TO_TABLE = {"transaction": (typed_transactions, transactions_to_fact),
            "loan_payment": (typed_payments, payments_to_fact),
            "loan": (typed_loans, loans_to_dim)}
