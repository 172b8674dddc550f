"""How the driver's tables play the bank's roles.

Fixed values: the mappings below are this project's choice of roles for
the driver's codes (they are not part of the source system).  Each maps a
driver code to a code of the bank's lookup tables in ``schemas``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.sources.lookups import lookup, rows_frame
from ledgerlake.sources.tables import Tables

# event_type -> (transaction type id, sign, channel)
EVENT_ROLES = [("signup", 1, 1, "branch"), ("purchase", 2, -1, "atm"),
               ("click", 3, 0, "online"), ("error", 4, -1, "online"),
               ("view", 5, 1, "branch")]
# o_orderstatus -> loan status id
ORDER_STATUS_ROLES = [("O", 1), ("P", 2), ("F", 3)]
# o_orderpriority -> loan type id ('5-LOW' has no loan type and drops)
ORDER_PRIORITY_ROLES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4)]
# p_type -> card type id (SMALL and MEDIUM have no card type and drop)
PART_TYPE_ROLES = [("ECONOMY", 1), ("STANDARD", 2), ("PROMO", 3), ("LARGE", 4)]
# c_mktsegment -> account type id ('MACHINERY' has no account type and drops)
SEGMENT_ACCOUNT_TYPES = [("HOUSEHOLD", 1), ("AUTOMOBILE", 2), ("BUILDING", 3), ("FURNITURE", 4)]
# amount magnitude range per transaction type id for the driver's event values
EVENT_AMOUNT_RULES = [(1, 10.0, 100.0), (2, 5.0, 150.0), (3, 1.0, 50.0),
                      (4, 20.0, 200.0), (5, 0.5, 80.0)]
# fee taken from an event's value before its sign is checked
EVENT_FEE_CENTS = 2000
# c_mktsegment -> (lowest balance, highest balance, minimum balance);
# MACHINERY has no rule
SEGMENT_BALANCE_RULES = [("AUTOMOBILE", -500.0, 9000.0, 100.0),
                         ("BUILDING", -900.0, 8000.0, 0.0),
                         ("FURNITURE", 0.0, 9500.0, 500.0),
                         ("HOUSEHOLD", -200.0, 9900.0, 50.0)]
# loan type id -> amount range for order totals
ORDER_AMOUNT_RULES = [(1, 20000.0, 300000.0), (2, 5000.0, 200000.0),
                      (3, 10000.0, 250000.0), (4, 2000.0, 150000.0)]
# which parents count in the referential checks (SQL that Spark and DuckDB read alike)
PARENT_FILTERS = {"customer": "c_acctbal >= 0", "orders": "o_orderstatus <> 'P'", "part": "p_size > 5",
                  "supplier": "s_acctbal >= 0", "nation": "n_regionkey <> 1", "region": "r_regionkey <> 2"}
# values without a role in the bank, read as missing
MISSING = {"customer": {"c_mktsegment": "nullif(c_mktsegment, 'MACHINERY')",
                        "c_acctbal": "CASE WHEN c_acctbal >= 0 THEN c_acctbal END"},
           "orders": {"o_orderpriority": "nullif(o_orderpriority, '5-LOW')", "o_orderstatus": "nullif(o_orderstatus, 'P')",
                      "o_custkey": "nullif(o_custkey % 10, 0)"},
           "events": {"event_type": "nullif(event_type, 'error')", "value": "CASE WHEN value >= 1 THEN value END"}}
# allowed values, each set without one of the codes that occur
ALLOWED = {"orders": {"o_orderstatus": ["F", "O"]},
           "customer": {"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]},
           "lineitem": {"l_returnflag": ["A", "N"], "l_linestatus": ["F"]},
           "events": {"event_type": ["signup", "purchase", "click", "view"]}}
TERM_MONTHS_PER_LINE = 12
# as-of days of the driver data
ORDERS_AS_OF = "1998-08-02"
EVENTS_AS_OF = "2024-01-20"
LINEITEM_AS_OF = "2001-11-01"
TENURE_AS_OF = "2002-06-15"
AUDIT_TS = "2025-06-05 00:33:00"


def event_roles(spark: SparkSession) -> DataFrame:
    return rows_frame(spark, EVENT_ROLES,
                      "event_type string, transaction_type_id int, sign int, channel string")


def cents(c) -> F.Column:
    """Money as whole cents (exact integer sums)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * 100).cast("bigint")


def signed_events(spark: SparkSession, t: Tables) -> DataFrame:
    """Events as bank transactions: type resolved (J8), amount signed (V5),
    money in cents.  Both lookups have a fixed size and are broadcast."""
    roles = F.broadcast(event_roles(spark))
    types = F.broadcast(lookup(spark, "transaction_types"))
    e = t.events.join(roles, "event_type", "inner")
    e = e.join(types, "transaction_type_id", "inner")
    amt = cents("value")
    signed = F.when(F.col("sign") < 0, -amt).otherwise(amt)
    return e.select("event_id", "user_id", "ts", "event_type", "transaction_type_id",
                    F.col("type_name").alias("transaction_type"), "sign", "channel",
                    signed.alias("amount_cents"), "props")


def raw_landing(t: Tables) -> dict[str, DataFrame]:
    """The driver's tables in the raw landing shape, with types, limits,
    dates and ids that break each of the bank's rules for some rows.  The
    expressions are SQL that Spark and DuckDB read alike."""
    return {name: t.read(table).selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])
            for name, (table, cols) in RAW_LANDING.items()}


# landing table -> (driver table, column -> expression)
RAW_LANDING = {
    "accounts": ("customer", {
        "account_id": "concat('ACC', CAST(c_custkey * 10000 AS STRING))", "type": "CAST(c_nationkey % 6 AS INT)",
        "balance": "CAST(round(c_acctbal * 100) AS BIGINT) * 1000", "min_balance": "500000",
        "date_opened": "DATE '2020-01-01' + CAST(c_custkey % 300 AS INT)",
        "date_closed": "DATE '2020-06-01' + CAST(c_custkey % 100 AS INT)",
        "currency": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'USD' ELSE 'VND' END"}),
    "transactions": ("events", {
        "transaction_id": "concat('TXN', CAST(event_id * 1000000 AS STRING))", "type": "CAST(event_id % 7 AS INT)",
        "amount": "(CAST(round(value * 100) AS BIGINT) - 2000) * 10000",
        "receiver_account_id": "CASE WHEN event_id % 3 = 0 THEN 'ACC0000001' END",
        "currency": "CASE WHEN event_type = 'error' THEN 'USD' ELSE 'VND' END"}),
    "cards": ("part", {
        "card_id": "concat('CRD', CAST(p_partkey * 1000 AS STRING))", "card_type_id": "CAST(p_partkey % 6 AS INT)",
        "issuance_date": "DATE '2020-01-01' + CAST(p_partkey % 1000 AS INT)",
        "expiration_date": "DATE '2020-01-01' + CAST(p_partkey % 1000 + 1095 + CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS INT)",
        "monthly_fee": "CAST(50000 * (p_partkey % 3) AS INT)", "interest_rate": "CAST(p_partkey % 2 AS DOUBLE) * 2.5"}),
    "loans": ("orders", {
        "loan_id": "concat('LOA', CAST(o_orderkey * 100 AS STRING))", "loan_type_id": "CAST(o_orderkey % 6 AS INT)",
        "amount": "CAST(round(o_totalprice * 100) AS BIGINT) * 100",
        "currency": "CASE WHEN o_orderstatus = 'P' THEN 'USD' ELSE 'VND' END",
        "interest_rate": "CAST(5 + o_orderkey % 13 AS DOUBLE)", "term": "CAST(12 * (1 + o_orderkey % 11) AS INT)",
        "start_date": "CAST(o_orderdate AS DATE)",
        "end_date": "CAST(o_orderdate AS DATE) + CAST(360 * (1 + o_orderkey % 11) + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INT)"}),
    "loan_payments": ("lineitem", {
        "payment_id": "concat('PAY', CAST(l_orderkey * 1000 AS STRING))",
        "loan_id": "CASE WHEN l_orderkey % 9 <> 0 THEN concat('LOA', CAST(l_orderkey * 100 AS STRING)) ELSE 'LOA-' END",
        "payment_amount": "CAST(round(l_extendedprice * 100) AS BIGINT) * 5",
        "principal_amount": "CAST(round(l_extendedprice * (1 - l_discount * 5) * 100) AS BIGINT) * 5",
        "paid_amount": "CAST(round(l_extendedprice * 100) AS BIGINT) * 5 + CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END",
        "scheduled_payment_date": "CAST(l_shipdate AS DATE) - CAST(l_orderkey % 30 AS INT)",
        "payment_date": "CAST(l_shipdate AS DATE)",
        "paid_date": "CAST(l_shipdate AS DATE) + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END"}),
    "customers": ("customer", {
        "customer_id": "concat('CUS', CAST(c_custkey * 10000 AS STRING))",
        "country": "CASE WHEN c_nationkey = 1 THEN 'Laos' ELSE 'Việt Nam' END",
        "city": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Hà Nội' ELSE c_mktsegment END"}),
}
