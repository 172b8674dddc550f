"""Modeling job (B8-B16): landing zone -> star schema.

Each dimension is a projection of its landing table (plus audit columns
for branches, customers, employees).  The two facts are built in one job
each: a single month-filtered scan replaces the per-slice loop, and the
write is partitioned by derived ``year``/``month``.  ``fact_transactions``
is rebuilt whole on each run (the trailing twelve months only, as a drop
and rebuild, K5); ``fact_loan_payments`` replaces the months of its
windows and keeps older ones, so reruns are idempotent (D13).  A window
with no rows leaves a table without data files; read the folders with
``star_schema(name)``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import scalars as FX
from ledgerlake.operators import conform, slices


def dim_date_between(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """B8 core: one row per day from ``lo`` to ``hi`` of a one-row frame
    (bounds may come from data).  F2-F6 give the attributes."""
    days = bounds.select(FX.date_series(F.col(lo), F.col(hi)).alias("full_date"))
    d = F.col("full_date")
    return days.select(FX.date_key(d).alias("date_id"), d,
                       F.dayofmonth(d).alias("day"), F.month(d).alias("month"),
                       F.year(d).alias("year"), FX.quarter(d).alias("quarter"),
                       FX.day_of_week(d).alias("day_of_week"), FX.is_weekend(d).alias("is_weekend"))


def dim_date(spark: SparkSession, start: str = "2000-01-01", end: str = "2050-12-31") -> DataFrame:
    """The calendar 2000-01-01 .. 2050-12-31 (18,628 days)."""
    b = spark.range(1).select(F.lit(start).cast("date").alias("lo"),
                              F.lit(end).cast("date").alias("hi"))
    return dim_date_between(b, "lo", "hi")


def star_schema(name: str):
    """Schema of a star table as stored (facts carry year/month partitions)."""
    from pyspark.sql import types as T
    schema = S.STAR[name]
    if name.startswith("fact_"):
        schema = T.StructType(schema.fields + [T.StructField("year", T.IntegerType()),
                                               T.StructField("month", T.IntegerType())])
    return schema


def _conform_to(df: DataFrame, schema) -> DataFrame:
    """Select the target columns by name and cast to the target types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def dim_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts without balance."""
    return _conform_to(accounts.drop("balance"), S.DIM_ACCOUNTS)


def dim_branches(branches: DataFrame, as_of=None) -> DataFrame:
    """Branches + audit columns."""
    return _conform_to(conform.add_audit_columns(branches, as_of), S.DIM_BRANCHES)


def dim_cards(cards: DataFrame) -> DataFrame:
    """Cards without customer_id."""
    return _conform_to(cards.drop("customer_id"), S.DIM_CARDS)


def dim_customers(customers: DataFrame, as_of=None) -> DataFrame:
    """Customers + audit columns."""
    return _conform_to(conform.add_audit_columns(customers, as_of), S.DIM_CUSTOMERS)


def dim_employees(employees: DataFrame, as_of=None) -> DataFrame:
    """Employees + audit columns."""
    return _conform_to(conform.add_audit_columns(employees, as_of), S.DIM_EMPLOYEES)


def dim_loans(loans: DataFrame) -> DataFrame:
    """loan_type -> type, loan_status -> status; currency not carried."""
    return _conform_to(loans.withColumnsRenamed({"loan_type": "type", "loan_status": "status"}),
                       S.DIM_LOANS)


def payments_start(as_of) -> _dt.date:
    """Start of the two windows that end in the month of ``as_of``."""
    return slices.add_months(slices.month_start(as_of), -12)


def fact_loan_payments(payments: DataFrame, start, windows: int = 2) -> DataFrame:
    """Payments of ``windows`` six-month windows from the month of
    ``start``, the month that ends the last window included: 13 calendar
    months for two windows, each loaded once (D6).  Started at
    ``payments_start(as_of)`` the last is the month of ``as_of``.  With the
    three date keys (payment_date_id from payment_date, D5) and year/month
    of the paid date."""
    n = windows * 6 + 1
    lo = slices.month_start(start)
    hi = slices.add_months(lo, n)
    months = slices.months_of(lo, n)
    p = payments
    if "year" in p.columns and "month" in p.columns:
        p = p.where(slices.partition_predicate(months))
    p = p.where((F.col("paid_date") >= F.lit(lo)) & (F.col("paid_date") < F.lit(hi)))
    p = p.withColumns({
        "scheduled_payment_date_id": FX.date_key("scheduled_payment_date"),
        "payment_date_id": FX.date_key("payment_date"),
        "paid_date_id": FX.date_key("paid_date")})
    out = _conform_to(p, S.FACT_LOAN_PAYMENTS)
    return out.withColumns({"year": F.year("paid_date"), "month": F.month("paid_date")})


def fact_transactions(transactions: DataFrame, as_of, months: int = 12) -> DataFrame:
    """The trailing ``months`` calendar months up to the month of
    ``as_of`` (O5), date key, ``date -> timestamp``,
    ``transaction_type -> type``, plus year/month of the timestamp."""
    lo, hi = slices.trailing_months(as_of, months)
    t = transactions
    if "year" in t.columns and "month" in t.columns:
        t = t.where(slices.partition_predicate(slices.months_of(lo, months)))
    t = t.where((F.col("date") >= F.lit(lo).cast("timestamp"))
                & (F.col("date") < F.lit(hi).cast("timestamp")))
    t = t.withColumn("date_id", FX.date_key("date")).withColumnsRenamed(
        {"date": "timestamp", "transaction_type": "type"})
    out = _conform_to(t, S.FACT_TRANSACTIONS)
    return out.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})


def run_star(spark: SparkSession, landing: str, warehouse: str, as_of: str,
             audit_ts: str | None = None, catalog_db: str | None = None) -> dict[str, str]:
    """B8-B16 end to end over a landing folder.

    Without ``catalog_db`` each table is a Parquet folder under
    ``warehouse``.  With it, each table is created in the catalog if it
    does not exist (fixed columns, location under ``warehouse``, facts
    partitioned by year/month; K3) and filled by name with an overwrite
    (dynamic for the facts, so only the months present are replaced; K4,
    K5, D13)."""
    from ledgerlake.sinks import writers
    from ledgerlake.sources.files import read_parquet
    root = landing.rstrip("/")
    rd = {n: read_parquet(spark, f"{root}/{n}") for n in
          ("accounts", "branches", "cards", "customers", "employees", "loans",
           "loan_payments", "transactions")}
    as_of_d = _dt.date.fromisoformat(as_of[:10])
    tables = {
        "dim_date": dim_date(spark),
        "dim_accounts": dim_accounts(rd["accounts"]),
        "dim_branches": dim_branches(rd["branches"], audit_ts),
        "dim_cards": dim_cards(rd["cards"]),
        "dim_customers": dim_customers(rd["customers"], audit_ts),
        "dim_employees": dim_employees(rd["employees"], audit_ts),
        "dim_loans": dim_loans(rd["loans"]),
        "fact_loan_payments": fact_loan_payments(rd["loan_payments"], payments_start(as_of_d)),
        "fact_transactions": fact_transactions(rd["transactions"], as_of_d),
    }
    out = warehouse.rstrip("/")
    paths = {}
    for name, df in tables.items():
        path = f"{out}/{name}"
        parts = ("year", "month") if name.startswith("fact_") else ()
        # fact_transactions is rebuilt whole (the trailing window only, K5);
        # loan-payment windows replace just their own months
        dynamic = name != "fact_transactions"
        if catalog_db:
            table = f"{catalog_db}.{name}"
            writers.create_table(spark, table, S.STAR[name], location=path, partition_cols=parts)
            writers.insert_by_name(df, table, overwrite=True, dynamic=dynamic)
            paths[name] = table
        elif parts:
            writers.write_partitioned(df, path, parts, dynamic=dynamic)
            paths[name] = path
        else:
            writers.write_parquet(df, path)
            paths[name] = path
    return paths
