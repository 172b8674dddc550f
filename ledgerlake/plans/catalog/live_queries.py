"""Tables kept up to date, bucketed or pruned, and checks made on the way:
W1, R3, S1, S4, O4, J10, J12, B17, V1-V11."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import bank_rules
from ledgerlake.plans import roles as R
from ledgerlake.plans.catalog.common import orders_as_balances
from ledgerlake.session import scratch_path
from ledgerlake.sources.tables import Tables


def incremental_latest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 over appended slices: one state row an account, each year's slice
    read once and merged into the buckets that its accounts fall into."""
    from ledgerlake.sinks.keyed import KeyedTable
    o = orders_as_balances(Tables(spark, sf_dir))
    table = KeyedTable(spark, scratch_path(spark, "latest_balance"), "account_id", ["timestamp", "transaction_id"], n_buckets=8)
    lo, hi = o.agg(F.min(F.year("timestamp")), F.max(F.year("timestamp"))).first()
    for version, year in enumerate(range(lo or 0, (hi or -1) + 1)):
        start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
        table.update(o.where((F.col("timestamp") >= start) & (F.col("timestamp") < end)), version)
    return table.read().select("account_id", "balance_after")


def customer360_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10 + B17 without a shuffle: customers, loans and events in tables
    bucketed by customer; every customer's transactions nested in chunks of 16
    beside its name and loans.  Customers with over a thousand events lie
    apart and take the skew-safe path."""
    from ledgerlake.operators import colocated
    t, tag, n = Tables(spark, sf_dir), uuid.uuid4().hex[:8], 8
    root = scratch_path(spark, "colocated")
    names = {x: f"default.{x}_{tag}" for x in ("customers", "loans", "events")}
    events = colocated.ColocatedChildren(spark, names["events"], f"{root}/hot", "user_id", ["ts", "event_id"], n)
    try:
        colocated.write_bucketed(t.customer.select("c_custkey", "c_name"), names["customers"], "c_custkey", n, path=f"{root}/customers")
        colocated.write_bucketed(t.orders.select("o_custkey", R.cents("o_totalprice").alias("cents")), names["loans"], "o_custkey", n, path=f"{root}/loans")
        events.write(t.events.select("user_id", "ts", "event_id", "value"), hot_rows=1000, path=f"{root}/events")
        out = f"{root}/out"
        colocated_documents(spark, names["customers"], names["loans"], events).write.parquet(out)
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(out)


def colocated_documents(spark: SparkSession, customers: str, loans: str, events) -> DataFrame:
    """The documents from the bucketed tables: no exchange in this plan."""
    from ledgerlake.operators import colocated
    per = spark.table(loans).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_loans"), F.sum("cents").alias("loans_total_cents"))
    head = spark.table(customers).hint("merge").join(per, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    docs = colocated.with_parent(head, "c_custkey", events.chunks(16), "user_id")
    return docs.select("c_custkey", "c_name", F.coalesce("n_loans", F.lit(0)).alias("n_loans"),
                       F.coalesce("loans_total_cents", F.lit(0)).alias("loans_total_cents"), "chunk",
                       F.coalesce("n", F.lit(0)).cast("int").alias("n"), F.col("items")[0]["event_id"].alias("first_event_id"),
                       F.element_at("items", -1)["event_id"].alias("last_event_id"))


def calendar_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekend transactions of second and fourth quarters, from a fact
    partitioned by month; the months follow from the filter on ``dim_date``
    by dynamic partition pruning."""
    from ledgerlake.sinks.writers import write_partitioned
    root = scratch_path(spark, "calendar_fact")
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    write_partitioned(o.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}), root, ("year", "month"))
    return calendar_plan(spark, root).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


def calendar_plan(spark: SparkSession, root: str) -> DataFrame:
    from ledgerlake.operators import slices
    from ledgerlake.plans.star import dim_date
    days = dim_date(spark, "1990-01-01", "2050-12-31").where("is_weekend AND quarter IN (2, 4)")
    return slices.scan_calendar(spark.read.parquet(root), days, "o_orderdate")


def observed_rule_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3-V11 observed during the landing write: the counts of
    ``landing_rule_checks`` without a scan of their own."""
    src = R.raw_landing(Tables(spark, sf_dir))
    return bank_rules.land_observed(spark, src, R.LINEITEM_AS_OF, scratch_path(spark, "landing_observed"))


#: The customer export of ``csv_quarantine``.
EXPORT = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("balance", T.DecimalType(15, 2))])


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers exported as CSV lines, some broken as the customer says
    (no balance, text for a balance, a field too many, an open quote); good
    rows and quarantined lines read back from where they were landed."""
    from ledgerlake.sources import files
    root = scratch_path(spark, "csv_quarantine")
    k = F.col("c_custkey")
    rest = (F.when(k % 11 == 1, F.concat(F.lit(","), "c_name"))
            .when(k % 11 == 2, F.concat(F.lit(","), "c_name", F.lit(",a lot")))
            .when(k % 11 == 3, F.concat(F.lit(","), "c_name", F.lit(",1.00,more")))
            .when(k % 11 == 4, F.concat(F.lit(",\"with, comma\","), F.col("c_acctbal").cast("decimal(15,2)")))
            .otherwise(F.concat(F.lit(","), "c_name", F.lit(","), F.col("c_acctbal").cast("decimal(15,2)"))))
    lines = Tables(spark, sf_dir).customer.select(F.concat(k.cast("string"), rest).alias("value"))
    lines.write.text(f"{root}/csv")
    files.land_csv(spark, f"{root}/csv", EXPORT, f"{root}/rows", f"{root}/bad", header=False)
    good = spark.read.parquet(f"{root}/rows").select(F.lit("row").alias("kind"), "id", "name", F.col("balance").cast("string").alias("detail"))
    bad = spark.read.parquet(f"{root}/bad").select(F.lit("quarantined").alias("kind"), F.regexp_extract("line", r"^([0-9]+)", 1).cast("long").alias("id"),
                                                   F.lit(None).cast("string").alias("name"), F.col("line").alias("detail"))
    return good.unionByName(bad)


def stream_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12 on streams: lines as payments and orders in good standing as loans,
    each sent at a time of its own, some payments before their loan; payments
    whose loan never comes.  A last record of either feed, far ahead, carries
    the watermark past all others."""
    from ledgerlake.streaming import orphans as O
    from ledgerlake.streaming import queries as SQ
    t, root = Tables(spark, sf_dir), scratch_path(spark, "orphans")
    at = lambda key, more: F.timestamp_seconds(F.lit(1_700_000_000) + (F.col(key) % 1000) * 60 + more)
    payments = t.lineitem.select(F.col("l_orderkey").alias("loan_id"), "l_linenumber", at("l_orderkey", (F.col("l_linenumber") * 997) % 6000 - 3000).alias("sent_at"))
    loans = t.orders.where(R.PARENT_FILTERS["orders"]).select(F.col("o_orderkey").alias("loan_id"), at("o_orderkey", F.lit(0)).alias("sent_at"))
    end = F.timestamp_seconds(F.lit(1_800_000_000))
    last = spark.range(1).select(F.lit(-1).cast("long").alias("loan_id"), F.lit(-1).cast("int").alias("l_linenumber"), end.alias("sent_at"))
    payments = payments.withColumns({"loan_id": F.col("loan_id").cast("long"), "l_linenumber": F.col("l_linenumber").cast("int")}).unionByName(last)
    loans = loans.withColumn("loan_id", F.col("loan_id").cast("long")).unionByName(last.drop("l_linenumber"))
    for name, df in (("payments", payments), ("loans", loans)):
        df.write.parquet(f"{root}/{name}")
    read = lambda name: spark.readStream.schema(spark.read.parquet(f"{root}/{name}").schema).parquet(f"{root}/{name}")
    out, ckpt = SQ.scratch(spark, "stream_orphans")
    found = O.orphans(read("payments"), read("loans"), "loan_id", "sent_at", wait="2 hours", term="1 day", salts=2)
    SQ.run_to_end(SQ.append_sink(found, out, ckpt))
    return spark.read.schema(found.schema).parquet(out).select("loan_id", "l_linenumber")


#: What the documents of ``document_drift`` are declared to hold.
DECLARED = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("amount", T.DoubleType()), T.StructField("branch", T.StringType()),
    T.StructField("customer", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]))])


def document_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 by inference: events as JSON documents whose fields have drifted
    (a new one, amounts as text, no branch at all, customers without a name)."""
    from ledgerlake.operators.drift import drift
    e = Tables(spark, sf_dir).events
    n = F.col("event_id")
    customer = F.struct(F.col("user_id").cast("long").alias("id"), F.when(n % 5 != 0, F.concat(F.lit("c"), F.col("user_id"))).alias("name"))
    body = F.to_json(F.struct(n.cast("string").alias("_id"), F.col("value").alias("amount"), customer.alias("customer"), F.when(n % 3 == 0, "app").alias("channel")))
    text = F.when(F.col("event_type") == "error", F.regexp_replace(body, r'"amount":([0-9.E-]+)', '"amount":"about $1"')).when(n % 50 == 7, "{").otherwise(body)
    path = scratch_path(spark, "drift")
    e.select(text.alias("value")).write.text(path)
    return drift(spark.read.text(path), DECLARED)
