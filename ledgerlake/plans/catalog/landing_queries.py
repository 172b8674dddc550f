"""The landing plan functions and code resolution on role-mapped data: B1-B5, J1-J8, P1-P5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import scalars as FX
from ledgerlake.operators import conform
from ledgerlake.plans import roles as R
from ledgerlake.sources.lookups import lookup, rows_frame
from ledgerlake.sources.tables import Tables
from ledgerlake.plans.catalog.common import orders_as_loans


def _constant_lookups(spark: SparkSession):
    from ledgerlake.sources.lookups import lookups
    return lookups(spark)


def landing_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 plan code on customers as accounts: 12-digit account numbers with
    leading zeros, type by segment, status by sign of the balance."""
    from ledgerlake.plans import landing
    t = Tables(spark, sf_dir)
    seg = F.broadcast(rows_frame(spark, R.SEGMENT_ACCOUNT_TYPES, "c_mktsegment string, type int"))
    acc = t.customer.join(seg, "c_mktsegment", "left").select(
        FX.format_id("ACC", "c_custkey", S.ID_WIDTH).alias("account_id"),
        FX.format_id("CUS", "c_custkey", S.ID_WIDTH).alias("customer_id"),
        FX.format_id("BRA", "c_nationkey", S.ID_WIDTH).alias("branch_id"),
        F.col("type"), F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("status"),
        F.lit(S.CURRENCY).alias("currency"),
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("number"),
        R.cents("c_acctbal").alias("balance"), F.lit(0).alias("min_balance"),
        F.lit(None).cast("date").alias("date_opened"), F.lit(None).cast("date").alias("date_closed"))
    return landing.land_accounts(acc, _constant_lookups(spark))


def landing_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 plan code on events as transactions (type codes 1-5)."""
    from ledgerlake.plans import landing
    t = Tables(spark, sf_dir)
    roles = F.broadcast(R.event_roles(spark))
    e = t.events.join(roles, "event_type", "inner")
    amt = R.cents("value")
    tx = e.select(FX.format_id("TXN", "event_id", S.TRANSACTION_ID_WIDTH).alias("transaction_id"),
                  FX.format_id("ACC", "user_id", S.ID_WIDTH).alias("account_id"),
                  F.lit(None).cast("string").alias("receiver_account_id"),
                  F.lit(None).cast("string").alias("employee_id"),
                  F.col("transaction_type_id").alias("type"), F.lit(S.CURRENCY).alias("currency"),
                  F.col("ts").alias("date"),
                  F.when(F.col("sign") < 0, -amt).otherwise(amt).alias("amount"),
                  F.lit(None).cast("long").alias("balance_after"))
    return landing.land_transactions(tx, _constant_lookups(spark))


def landing_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 plan code on orders as loans."""
    from ledgerlake.plans import landing
    t = Tables(spark, sf_dir)
    prio = F.broadcast(rows_frame(spark, R.ORDER_PRIORITY_ROLES, "o_orderpriority string, loan_type_id int"))
    stat = F.broadcast(rows_frame(spark, R.ORDER_STATUS_ROLES, "o_orderstatus string, loan_status_id int"))
    o = t.orders.join(prio, "o_orderpriority", "left").join(stat, "o_orderstatus", "left")
    loans = o.select(FX.format_id("LOA", "o_orderkey", S.ID_WIDTH).alias("loan_id"),
                     FX.format_id("CUS", "o_custkey", S.ID_WIDTH).alias("customer_id"),
                     "loan_type_id", R.cents("o_totalprice").alias("amount"),
                     F.lit(S.CURRENCY).alias("currency"),
                     F.col("o_orderdate").cast("date").alias("start_date"), "loan_status_id")
    return landing.land_loans(loans, _constant_lookups(spark))


def landing_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 plan code on parts as cards: type by lookup, masked number from the card id."""
    from ledgerlake.plans import landing
    t = Tables(spark, sf_dir)
    roles = F.broadcast(rows_frame(spark, R.PART_TYPE_ROLES, "p_type string, card_type_id int"))
    p = t.part.join(roles, "p_type", "left")
    cards = p.select(FX.format_id("CRD", "p_partkey", S.ID_WIDTH).alias("card_id"),
                     "card_type_id", F.col("p_size").alias("monthly_fee"))
    return landing.land_cards(cards, _constant_lookups(spark))


def conform_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: J1 + J2 + P1 + F8 -- type and status by inner lookups, masked number."""
    t = Tables(spark, sf_dir)
    nat = t.nation.select("n_nationkey", F.col("n_name").alias("type"), "n_regionkey")
    c = t.customer.join(nat, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    c = conform.resolve_code(c, "n_regionkey", t.region, "r_regionkey", "r_name", "status")
    return c.select(F.col("c_custkey").alias("account_id"), "type", "status",
                    FX.mask_account("c_name").alias("number"),
                    F.col("c_acctbal").alias("balance"))


def conform_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: J3 + J4 + P2-P4 + F9 -- ``t.*`` plus names, codes dropped, renamed."""
    t = Tables(spark, sf_dir)
    s = t.supplier.join(t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                        F.col("s_nationkey") == F.col("n_nationkey"), "inner")
    s = s.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
    s = s.drop("s_nationkey", "n_nationkey", "n_regionkey", "r_regionkey")
    s = s.withColumnsRenamed({"n_name": "customer_type", "r_name": "status"})
    return s.withColumn("phone_number", FX.mask_phone("s_name"))


def conform_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 + P3 + F10 -- card type by lookup, repeatable masked number."""
    t = Tables(spark, sf_dir)
    roles = rows_frame(spark, R.PART_TYPE_ROLES, "p_type string, card_type_id int")
    p = t.part.join(F.broadcast(roles), "p_type", "inner")
    p = p.join(F.broadcast(lookup(spark, "card_types")), "card_type_id", "inner")
    p = p.drop("card_type_id", "p_type").withColumnRenamed("type_name", "card_type")
    return p.select(F.col("p_partkey").alias("card_id"), "card_type", "monthly_fee",
                    "interest_rate", FX.mask_card("p_partkey").alias("number"))


def conform_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 + J7 + P3 -- loan type and status by inner lookups."""
    o = orders_as_loans(spark, Tables(spark, sf_dir))
    return o.select(F.col("o_orderkey").alias("loan_id"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("o_totalprice").alias("amount"),
                    F.col("o_orderdate").cast("date").alias("start_date"),
                    "loan_type", "loan_status")


def conform_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 + P3 + F1 -- type name, signed amount, year/month/day."""
    e = R.signed_events(spark, Tables(spark, sf_dir))
    return e.select(F.col("event_id").alias("transaction_id"),
                    F.col("user_id").alias("account_id"), "transaction_type",
                    "amount_cents", F.col("ts").alias("date"), *FX.date_parts("ts"))


def dim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 + F7 + F11 (B10 shape): audit columns at a fixed as-of time."""
    s = Tables(spark, sf_dir).supplier.select(
        F.col("s_suppkey").alias("branch_id"), F.col("s_name").alias("name"))
    out = conform.add_audit_columns(s, as_of=R.AUDIT_TS)
    return out.withColumns({"created_at": F.col("created_at").cast("timestamp_ntz"),
                            "updated_at": F.col("updated_at").cast("timestamp_ntz")})


def landing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 plan code (J3, J4, P2-P4, F9) on customers: type by nation, status
    by sign of the balance, phone masked."""
    from ledgerlake.plans import landing
    c = Tables(spark, sf_dir).customer
    cust = c.select(FX.format_id("CUS", "c_custkey", S.ID_WIDTH).alias("customer_id"),
                    F.col("c_name").alias("name"), F.lit(S.COUNTRY).alias("country"),
                    F.col("c_mktsegment").alias("city"), F.lit(None).cast("string").alias("street"),
                    F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("phone_number"),
                    F.lit(None).cast("date").alias("registration_date"),
                    F.lit(None).cast("string").alias("email"),
                    (F.col("c_nationkey") % 4).cast("int").alias("customer_type_id"),
                    F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("status"))
    return landing.land_customers(cust, _constant_lookups(spark))


def landing_loan_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 plan code on lineitem as loan payments: F1 on the paid date."""
    from ledgerlake.plans import landing
    from ledgerlake.plans.catalog.star_queries import lineitem_as_landing_payments
    p = lineitem_as_landing_payments(Tables(spark, sf_dir)).drop("year", "month")
    return landing.land_loan_payments(p)


def suppliers_as_branches(t: Tables) -> DataFrame:
    """supplier in the landing ``branches`` shape (B7: taken as it is)."""
    return t.supplier.select(FX.format_id("BRA", "s_suppkey", S.ID_WIDTH).alias("branch_id"),
                             F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("address"),
                             F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("phone_number"))


def customers_as_employees(t: Tables) -> DataFrame:
    """customer in the landing ``employees`` shape (B7: taken as it is)."""
    return t.customer.select(FX.format_id("EMP", "c_custkey", S.ID_WIDTH).alias("employee_id"),
                             F.col("c_name").alias("name"), F.col("c_mktsegment").alias("position"),
                             FX.format_id("BRA", "c_nationkey", S.ID_WIDTH).alias("branch_id"))


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + B7 + K1: branches and employees written as the export's CSV
    files, read by schema with a view each, landed as Parquet and read back
    through the views' names."""
    from ledgerlake.session import scratch_path
    from ledgerlake.sinks import writers
    from ledgerlake.sources import files
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "landing-files")
    schemas = {n: S.LANDING_CSV[n] for n in ("branches", "employees")}
    writers.write_csv(suppliers_as_branches(t), f"{root}/branches.csv")
    writers.write_csv(customers_as_employees(t), f"{root}/employees.csv")
    files.read_landing_csvs(spark, root, schemas)
    for name in schemas:
        writers.write_parquet(spark.table(name), f"{root}/{name}")
    b, e = (files.read_parquet(spark, f"{root}/{n}", schemas[n]) for n in ("branches", "employees"))
    return e.select(F.lit("employee").alias("kind"), F.col("employee_id").alias("id"), "name",
                    F.col("position").alias("detail"), "branch_id").unionByName(
        b.select(F.lit("branch").alias("kind"), F.col("branch_id").alias("id"), "name",
                 F.concat_ws(" ", "address", "phone_number").alias("detail"), "branch_id"))
