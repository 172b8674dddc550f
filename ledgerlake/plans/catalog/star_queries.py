"""The star-schema plan functions on role-mapped driver data: B12, B15, B16."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import scalars as FX
from ledgerlake.plans import roles as R
from ledgerlake.sources.tables import Tables
from ledgerlake.plans.catalog.common import as_ntz


def orders_as_landing_transactions(t: Tables) -> DataFrame:
    """orders in the landing ``transactions`` shape (after B5)."""
    o = t.orders
    return o.select(FX.format_id("TXN", "o_orderkey", S.TRANSACTION_ID_WIDTH).alias("transaction_id"),
                    FX.format_id("ACC", "o_custkey", S.ID_WIDTH).alias("account_id"),
                    F.lit(None).cast("string").alias("employee_id"),
                    F.lit(S.CURRENCY).alias("currency"),
                    F.col("o_orderdate").cast("timestamp").alias("date"),
                    R.cents("o_totalprice").alias("amount"),
                    R.cents("o_totalprice").alias("balance_after"),
                    F.col("o_orderpriority").alias("transaction_type"),
                    F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


def star_fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B16 plan code: trailing 12 months, date key, renames, year/month."""
    from ledgerlake.plans import star
    tx = orders_as_landing_transactions(Tables(spark, sf_dir))
    return as_ntz(star.fact_transactions(tx, R.ORDERS_AS_OF, 12))


def lineitem_as_landing_payments(t: Tables) -> DataFrame:
    """lineitem in the landing ``loan_payments`` shape (after B6)."""
    li = t.lineitem
    ship = F.col("l_shipdate").cast("date")
    return li.select(F.concat(F.lit(S.ID_PREFIXES["payment"]), F.col("l_orderkey").cast("string"),
                              F.lit("-"), F.col("l_linenumber").cast("string")).alias("payment_id"),
                     FX.format_id("LOA", "l_orderkey", S.ID_WIDTH).alias("loan_id"),
                     F.lit(None).cast("string").alias("transaction_id"),
                     R.cents("l_extendedprice").alias("payment_amount"),
                     F.date_sub(ship, 3).alias("scheduled_payment_date"),
                     ship.alias("payment_date"),
                     R.cents(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("principal_amount"),
                     R.cents("l_extendedprice").alias("paid_amount"),
                     ship.alias("paid_date"),
                     F.year(ship).alias("year"), F.month(ship).alias("month"))


def star_fact_loan_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B15 plan code: 13 calendar months to the as-of month, three date keys."""
    from ledgerlake.plans import star
    p = lineitem_as_landing_payments(Tables(spark, sf_dir))
    return star.fact_loan_payments(p, star.payments_start("1999-10-15"), 2)


def star_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B12 plan code: customers with names resolved and audit columns."""
    from ledgerlake.plans import star
    t = Tables(spark, sf_dir)
    c = t.customer.join(t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                        F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    c = c.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
    landed = c.select(FX.format_id("CUS", "c_custkey", S.ID_WIDTH).alias("customer_id"),
                      F.col("c_name").alias("name"), F.lit(S.COUNTRY).alias("country"),
                      F.col("r_name").alias("city"), F.col("n_name").alias("street"),
                      FX.mask_phone("c_name").alias("phone_number"),
                      F.lit(None).cast("date").alias("registration_date"),
                      F.lit(None).cast("string").alias("email"),
                      F.col("c_mktsegment").alias("customer_type"),
                      F.when(F.col("c_acctbal") < 0, "Tạm khóa").otherwise("Hoạt động").alias("status"))
    return as_ntz(star.dim_customers(landed, as_of=R.AUDIT_TS))


def star_dim_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9 plan code on the landed accounts."""
    from ledgerlake.plans import star
    from ledgerlake.plans.catalog.landing_queries import landing_accounts
    return star.dim_accounts(landing_accounts(spark, sf_dir))


def star_dim_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B10 plan code on suppliers as branches."""
    from ledgerlake.plans import star
    from ledgerlake.plans.catalog.landing_queries import suppliers_as_branches
    return as_ntz(star.dim_branches(suppliers_as_branches(Tables(spark, sf_dir)), R.AUDIT_TS))


def star_dim_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11 plan code on the landed cards (issued on a day made from the part
    key, valid for the fixed number of days)."""
    from ledgerlake.plans import star
    from ledgerlake.plans.catalog.landing_queries import landing_cards
    n = F.substring("card_id", 4, 7).cast("int")
    issued = F.date_add(F.lit("2020-01-01").cast("date"), n % 1000)
    cards = landing_cards(spark, sf_dir).withColumns({
        "account_id": F.concat(F.lit("ACC"), F.substring("card_id", 4, 7)), "customer_id": F.lit("CUS"),
        "interest_rate": ((n % 8) / 4).cast("float"), "issuance_date": issued,
        "expiration_date": FX.add_days(issued, S.CARD_VALID_DAYS)})
    return star.dim_cards(cards)


def star_dim_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B13 plan code on customers as employees."""
    from ledgerlake.plans import star
    from ledgerlake.plans.catalog.landing_queries import customers_as_employees
    return as_ntz(star.dim_employees(customers_as_employees(Tables(spark, sf_dir)), R.AUDIT_TS))


def star_dim_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B14 plan code on the landed loans (rate and term made from the id)."""
    from ledgerlake.plans import star
    from ledgerlake.plans.catalog.landing_queries import landing_loans
    n = F.regexp_extract("loan_id", r"([0-9]+)$", 1).cast("int")
    term = F.element_at(F.array(*map(F.lit, S.LOAN_TERMS)), (n % len(S.LOAN_TERMS) + 1))
    loans = landing_loans(spark, sf_dir).withColumns({
        "interest_rate": (F.lit(6) + (n % 36) / 4).cast("float"), "term": term,
        "end_date": F.date_add("start_date", term * 30)})
    return star.dim_loans(loans)


def star_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3-K6 + S6: the branch dimension created as a catalog table and filled
    by name twice (an append, then a full refresh), the transaction fact
    written by year and month through the catalog, its last month written
    again; both read through ``spark.table``.  K6's ``years``/``months``
    transforms (``writers.write_to_catalog``) need a catalog that takes them,
    which the session's own doesn't: here they are derived columns."""
    import uuid

    from ledgerlake.session import scratch_path
    from ledgerlake.sinks import writers
    from ledgerlake.sources import files
    root, tag = scratch_path(spark, "star-tables"), uuid.uuid4().hex[:8]
    dim, fact, copy = (f"default.{n}_{tag}" for n in ("dim_branches", "fact_transactions", "dim_branches_copy"))
    branches = star_dim_branches(spark, sf_dir)
    branches = branches.withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at")})
    try:
        writers.create_table(spark, dim, S.DIM_BRANCHES, location=f"{root}/dim")
        writers.create_table(spark, dim, S.DIM_BRANCHES, location=f"{root}/dim")  # there already
        writers.insert_by_name(branches, dim)
        writers.insert_by_name(branches.withColumn("is_active", F.lit(False)), dim)
        writers.create_table(spark, copy, S.DIM_BRANCHES, location=f"{root}/copy")
        writers.insert_by_name(branches, copy)
        writers.insert_by_name(branches.withColumn("name", F.upper("name")), copy, overwrite=True, dynamic=False)
        writers.create_table(spark, fact, S.FACT_TRANSACTIONS, location=f"{root}/fact", partition_cols=("year", "month"))
        tx = star_fact_transactions(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        writers.insert_by_name(tx, fact, overwrite=True)
        again = tx.where("year = 1998 AND month = 7").withColumn("currency", F.lit("again"))
        writers.insert_by_name(again, fact, overwrite=True)
        parts = [files.read_table(spark, n).select(F.lit(k).alias("kind"), F.col(a).alias("id"), F.col(b).cast("string").alias("detail"))
                 for n, k, a, b in ((dim, "dim", "branch_id", "is_active"), (copy, "copy", "branch_id", "name"),
                                    (fact, "fact", "transaction_id", "currency"))]
        out = f"{root}/out"
        parts[0].unionByName(parts[1]).unionByName(parts[2]).write.parquet(out)
    finally:
        for n in (dim, fact, copy):
            spark.sql(f"DROP TABLE IF EXISTS {n}")
    return spark.read.parquet(out)
