"""Landing job (B1-B7): CSV exports -> Parquet landing zone.

Codes are resolved by inner lookups against the constant tables (J1-J8),
numbers are masked with native expressions (F8-F10), and the two event
tables gain ``year``/``month``/``day`` for partitioned writes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import scalars as FX
from ledgerlake.operators import conform
from ledgerlake.sinks import writers
from ledgerlake.sources import files
from ledgerlake.sources.lookups import lookups_from


def land_accounts(accounts: DataFrame, lk: Mapping[str, DataFrame]) -> DataFrame:
    """B1: J1 + J2 + P1 + F8."""
    a = conform.resolve_codes(accounts, [
        ("type", "account_types", "account_type_id", "type_name", "__type"),
        ("status", "account_status_types", "status_id", "status_name", "__status")], lk)
    return a.select("account_id", "customer_id", "branch_id", F.col("__type").alias("type"),
                    F.col("__status").alias("status"), FX.mask_account("number").alias("number"),
                    "balance", "min_balance", "date_opened", "date_closed")


def land_customers(customers: DataFrame, lk: Mapping[str, DataFrame]) -> DataFrame:
    """B2: J3 + J4 + P2 + P3 + P4 + F9."""
    c = conform.resolve_codes(customers, [
        ("customer_type_id", "customer_types", "customer_type_id", "type_name", "c_type"),
        ("status", "customer_status_types", "status_id", "status_name", "c_status")], lk)
    c = c.drop("customer_type_id", "status").withColumnsRenamed(
        {"c_type": "customer_type", "c_status": "status"})
    return c.withColumn("phone_number", FX.mask_phone("phone_number"))


def land_cards(cards: DataFrame, lk: Mapping[str, DataFrame]) -> DataFrame:
    """J5 + P3 + F10 (repeatable masked number from the card id, D9)."""
    ct = lk["card_types"].select("card_type_id", F.col("type_name").alias("card_type"))
    c = cards.join(ct, "card_type_id", "inner").drop("card_type_id")
    return c.withColumn("number", FX.mask_card("card_id"))


def land_loans(loans: DataFrame, lk: Mapping[str, DataFrame]) -> DataFrame:
    """J6 + J7 + P3."""
    l2 = conform.resolve_codes(loans, [
        ("loan_type_id", "loan_types", "loan_type_id", "type_name", "loan_type"),
        ("loan_status_id", "loan_status_types", "status_id", "status_name", "loan_status")], lk)
    return l2.drop("loan_type_id", "loan_status_id")


def land_transactions(tx: DataFrame, lk: Mapping[str, DataFrame]) -> DataFrame:
    """J8 + P3 + F1."""
    t = conform.resolve_code(tx, "type", lk["transaction_types"], "transaction_type_id",
                             "type_name", "transaction_type")
    t = t.drop("type", "receiver_account_id")
    return t.select("*", *FX.date_parts("date"))


def land_loan_payments(payments: DataFrame) -> DataFrame:
    """F1 on the paid date."""
    return payments.select("*", *FX.date_parts("paid_date"))


def run_landing(spark: SparkSession, csv_folder: str, out_folder: str, quarantine: str | None = None) -> dict[str, str]:
    """B1-B7 end to end: read the eight CSVs (and any lookup CSVs the export
    carries, e.g. ``account_types.csv``; missing ones use the constant
    tables), shape, write Parquet.

    Unpartitioned tables are rebalanced to ~128 MB files (not one file);
    transactions and loan payments are written by year/month/day.  With
    ``quarantine``, lines that don't read as their schema says are kept there
    and not landed as NULLs.
    """
    src = files.read_landing_csvs(spark, csv_folder, quarantine=quarantine)
    lk = lookups_from(spark, csv_folder)   # the export's lookup CSVs, else the constants
    out = out_folder.rstrip("/")
    plan = {
        "accounts": (land_accounts(src["accounts"], lk), None),
        "customers": (land_customers(src["customers"], lk), None),
        "cards": (land_cards(src["cards"], lk), None),
        "loans": (land_loans(src["loans"], lk), None),
        "transactions": (land_transactions(src["transactions"], lk), ("year", "month", "day")),
        "branches": (src["branches"], None),
        "employees": (src["employees"], None),
        "loan_payments": (land_loan_payments(src["loan_payments"]), ("year", "month", "day")),
    }
    paths = {}
    for name, (df, parts) in plan.items():
        path = f"{out}/{name}"
        if parts:
            # the export is complete each time: replace the whole table
            writers.write_partitioned(df, path, parts, dynamic=False)
        else:
            writers.write_parquet(df, path)
        paths[name] = path
    return paths
