"""Latest row per key: W1, P8, A3, J11, and the SQL-API forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import latest
from ledgerlake.sources.tables import Tables
from ledgerlake.plans.catalog.common import orders_as_balances


def latest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + P8 (flagship): newest order per customer, its total as balance."""
    o = orders_as_balances(Tables(spark, sf_dir))
    ranked = latest.latest_by_rank(o, ["account_id"], ["timestamp", "transaction_id"])
    return ranked.select("account_id", "balance_after")


def latest_balance_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the same answer as a partial aggregate (max_by)."""
    o = orders_as_balances(Tables(spark, sf_dir))
    return latest.latest_by_agg(o, ["account_id"], ["timestamp", "transaction_id"],
                                ["balance_after"])


#: B18 as text: per account, the balance of the greatest (time, id), which
#: are one whole number, so that the aggregate is hashed and needs no sort.
LATEST_BALANCE_SQL = """
SELECT account_id, max_by(balance_after, CAST(unix_micros(CAST(`timestamp` AS TIMESTAMP)) AS DECIMAL(18, 0)) * 10000000000000000000BD + transaction_id) AS balance_after
FROM {facts} GROUP BY account_id
"""


def latest_balance_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B18 through the SQL API: one aggregate over the fact table, which is
    bound as a parameter."""
    facts = orders_as_balances(Tables(spark, sf_dir))
    return spark.sql(LATEST_BALANCE_SQL, facts=facts)


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masking and date-key functions called by name from SQL."""
    from ledgerlake.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    t = Tables(spark, sf_dir)
    return spark.sql("""
        SELECT o.o_orderkey, hide_account_number(c.c_name) AS number,
               hide_phone_number(c.c_name) AS phone_number,
               add_number(CAST(o.o_orderkey AS STRING)) AS card_number,
               date_to_int(CAST(o.o_orderdate AS DATE)) AS date_id
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",
                     orders=t.orders, customer=t.customer)


def latest_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer with its newest event (NULLs if none)."""
    t = Tables(spark, sf_dir)
    cust = t.customer.select("c_custkey", "c_name")
    ev = t.events.select("user_id", "event_id", "ts", "event_type", "value")
    return latest.attach_latest(cust, "c_custkey", ev, "user_id", ["ts", "event_id"])
