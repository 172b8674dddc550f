"""Scalar functions and row-level rules: F1-F28, P9-P15, K9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import scalars as FX
from ledgerlake.operators import analytics, conform
from ledgerlake.plans import roles as R
from ledgerlake.sources.lookups import rows_frame
from ledgerlake.sources.tables import Tables
from ledgerlake.plans.catalog.common import loan_terms


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1."""
    return Tables(spark, sf_dir).orders.select("o_orderkey", *FX.date_parts("o_orderdate"))


def date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2."""
    return Tables(spark, sf_dir).orders.select("o_orderkey",
                                               FX.date_key("o_orderdate").alias("date_id"))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 + F2-F6: one row per day over the span of the ship dates."""
    from ledgerlake.plans.star import dim_date_between
    span = Tables(spark, sf_dir).lineitem.agg(
        F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi"))
    return dim_date_between(span, "lo", "hi")


def mask_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8/U1."""
    return Tables(spark, sf_dir).customer.select("c_custkey",
                                                 FX.mask_account("c_name").alias("number"))


def mask_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9/U2."""
    return Tables(spark, sf_dir).supplier.select("s_suppkey",
                                                 FX.mask_phone("s_name").alias("phone_number"))


def mask_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10/U3."""
    return Tables(spark, sf_dir).part.select("p_partkey",
                                             FX.mask_card("p_partkey").alias("number"))


def format_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12."""
    return Tables(spark, sf_dir).orders.select(
        "o_orderkey", FX.format_id("CUS", "o_custkey", S.ID_WIDTH).alias("customer_id"),
        FX.format_id("TXN", "o_orderkey", S.TRANSACTION_ID_WIDTH).alias("transaction_id"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15 + P11: whole texts, newlines to spaces, trimmed."""
    return Tables(spark, sf_dir).documents.select("doc_id", FX.clean_text("text").alias("text"))


def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 + F14: flag and 'contains one of two'."""
    p = Tables(spark, sf_dir).pages.select("page_id", "url")
    return p.where(F.col("url").startswith("https://")
                   & conform.contains_any(F.col("url"), ["/fr/", "/de/"]))


def filter_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: loan-payment transactions only (type 4)."""
    e = R.signed_events(spark, Tables(spark, sf_dir))
    return e.where(F.col("transaction_type_id") == 4).select("event_id", "user_id",
                                                            "amount_cents")


def balance_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening balance + amount with the overdraft flip (cents)."""
    t = Tables(spark, sf_dir)
    e = R.signed_events(spark, t)
    acc = t.customer.select("c_custkey", R.cents("c_acctbal").alias("open_cents"))
    out = analytics.balance_after(e, acc, "user_id", "c_custkey", "open_cents", "amount_cents",
                                  "transaction_type_id", [2, 3])
    return out.select("event_id", "user_id", "amount_applied", "balance_after",
                      "overdraft_flip")


def normalize_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status that may arrive as the paid code '3' or as a code."""
    o = Tables(spark, sf_dir).orders
    raw = F.when(F.col("o_orderstatus") == "F", F.lit("3")).otherwise(F.col("o_orderstatus"))
    names = dict(S.LOAN_STATUS_TYPES)
    code_names = {code: names[i] for code, i in R.ORDER_STATUS_ROLES if code != "F"}
    return o.select("o_orderkey", conform.normalize_status(raw, code_names).alias("status"))


def conditional_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receiver only on transfers."""
    e = R.signed_events(spark, Tables(spark, sf_dir))
    recv = F.get_json_object("props", "$.k").try_cast("bigint")
    return e.select("event_id", conform.only_for(F.col("transaction_type_id") == 3, recv)
                    .alias("receiver_account_id"))


def round_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: round half to even, to whole units."""
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     FX.round_half_even("l_extendedprice").alias("amount"),
                     FX.round_half_even(F.col("l_quantity") / 2).alias("half_qty"))


def date_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date + 15 days, capped at the as-of day."""
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     FX.date_cap(FX.add_days("l_shipdate", 15),
                                 F.lit(R.LINEITEM_AS_OF)).alias("paid_date"))


def date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F20."""
    return Tables(spark, sf_dir).orders.select("o_orderkey",
                                               FX.format_ts("o_orderdate").alias("date_text"))


def array_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """element 0 of an array, NULL when empty (whole texts split)."""
    d = Tables(spark, sf_dir).documents
    lines = F.split(F.col("text"), "\n")
    long_lines = F.filter(lines, lambda x: F.length(x) > 200)
    return d.select("doc_id", FX.first_element(lines).alias("first_line"),
                    FX.first_element(long_lines).alias("first_long_line"))


def stream_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 + F22 + F23: keyed JSON record per event (batch form)."""
    from ledgerlake.streaming.feeds import envelope
    e = R.signed_events(spark, Tables(spark, sf_dir))
    return envelope(event_record(e), "account_id")


def event_record(e: DataFrame) -> DataFrame:
    """An event as the live transaction record (ids, type name, amount, ISO time)."""
    k = F.from_json("props", "k INT").getField("k")
    return e.select(F.col("event_id").alias("transaction_id"),
                    F.col("user_id").cast("string").alias("account_id"),
                    F.col("transaction_type").alias("type"),
                    F.col("amount_cents").alias("amount"),
                    FX.iso_timestamp("ts").alias("date"),
                    k.alias("k"))


def tenure_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """whole months since a date at the as-of day."""
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey",
                    FX.months_since("o_orderdate", F.lit(R.TENURE_AS_OF).cast("date"))
                    .alias("months"))


def credit_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """limit (order total) - outstanding (open lines), and the share."""
    t = Tables(spark, sf_dir)
    open_lines = (t.lineitem.where(F.col("l_linestatus") == "O").groupBy("l_orderkey")
                  .agg(F.sum(R.cents("l_extendedprice")).alias("outstanding_cents")))
    o = t.orders.select("o_orderkey", R.cents("o_totalprice").alias("limit_cents"))
    j = o.join(open_lines, o["o_orderkey"] == open_lines["l_orderkey"], "left")
    out = F.coalesce(F.col("outstanding_cents"), F.lit(0))
    return j.select("o_orderkey", F.col("limit_cents").alias("credit_limit"),
                    out.alias("outstanding_balance"),
                    FX.available_credit("limit_cents", out).alias("available_credit"),
                    (out / F.col("limit_cents") * 100).alias("utilisation"))


def loan_installment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """monthly payment = amount / term."""
    t = Tables(spark, sf_dir)
    terms = loan_terms(t)
    j = t.orders.join(terms, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
    return j.select("o_orderkey", "term",
                    FX.monthly_installment("o_totalprice", "term").alias("monthly_payment"))


def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code lookup with a default for codes the table lacks."""
    e = R.signed_events(spark, Tables(spark, sf_dir))
    partial = rows_frame(spark, [(1, "deposit"), (2, "withdrawal"), (3, "transfer"), (5, "interest")],
                         "transaction_type_id int, range_name string")
    out = conform.resolve_code(e, "transaction_type_id", partial, "transaction_type_id",
                               "range_name", "range_name", how="left", default="transfer")
    return out.select("event_id", "range_name")


def round2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """discounted prices rounded to 2 places (on exact decimals, half to
    even, so every engine agrees)."""
    li = Tables(spark, sf_dir).lineitem
    price = R.cents("l_extendedprice").cast("decimal(18,0)") * (100 - F.round(F.col("l_discount") * 100)).cast("decimal(3,0)")
    return li.select("l_orderkey", "l_linenumber",
                     FX.round2(price.cast("decimal(24,4)") / F.lit(10000).cast("decimal(5,0)")).cast("double").alias("net"))
