"""Streams: S8, K9, R1-R5 (each runs to completion with availableNow, then reads its output)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import scalars as FX
from ledgerlake.plans import roles as R
from ledgerlake.sources.lookups import lookup
from ledgerlake.sources.tables import Tables
from ledgerlake.plans.catalog.common import as_ntz


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.streaming import queries as SQ
    return SQ.parquet_stream(spark, sf_dir, "events.parquet")


def _signed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events stream typed and signed like ``roles.signed_events``."""
    roles = F.broadcast(R.event_roles(spark))
    types = F.broadcast(lookup(spark, "transaction_types"))
    e = _events_stream(spark, sf_dir).join(roles, "event_type", "inner").join(
        types, "transaction_type_id", "inner")
    amt = R.cents("value")
    return e.select("event_id", "user_id", "ts", "value", "transaction_type_id",
                    F.col("type_name").alias("transaction_type"),
                    F.when(F.col("sign") < 0, -amt).otherwise(amt).alias("amount_cents"))


def transaction_feed_record(e: DataFrame) -> DataFrame:
    """An event as the live transaction feed record (S8 fields)."""
    return e.select(FX.format_id("TXN", "event_id", S.TRANSACTION_ID_WIDTH).alias("transaction_id"),
                    FX.format_id("ACC", "user_id", S.ID_WIDTH).alias("account_id"),
                    F.lit(None).cast("string").alias("employee_id"),
                    F.col("transaction_type").alias("type"),
                    F.lit(S.CURRENCY).alias("currency"),
                    FX.format_ts("ts").alias("date"),
                    F.col("amount_cents").alias("amount"))


def stream_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + K9: events -> keyed JSON records -> parsed feed, as a stream."""
    from ledgerlake.streaming import feeds
    from ledgerlake.streaming import queries as SQ
    records = feeds.envelope(transaction_feed_record(_signed_stream(spark, sf_dir)), "account_id")
    parsed = feeds.typed_transactions(feeds.parse_feed(records, "transaction"))
    out, ckpt = SQ.scratch(spark, "stream_transactions")
    SQ.run_to_end(SQ.append_sink(parsed, out, ckpt))
    return spark.read.parquet(out).select(
        "transaction_id", "account_id", "type", "currency", "amount",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def _published(records: DataFrame, name: str) -> DataFrame:
    """Keyed JSON records written as files and read as a stream.  The files
    hold key and value as compressed columns, since the JSON text of a table is
    many times the table; lightly, as a split's rows are one task's to parse."""
    from ledgerlake.session import scratch_path
    spark, topic = records.sparkSession, scratch_path(records.sparkSession, name)
    records.write.option("compression", "snappy").parquet(topic)
    return spark.readStream.schema(records.schema).parquet(topic)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 + S8 + R3: events published as keyed JSON records (files stand
    in for the stream), consumed as a stream and ingested into the
    ``fact_transactions`` shape, partitioned by year/month/batch."""
    from ledgerlake.streaming import feeds
    from ledgerlake.streaming import queries as SQ
    t = Tables(spark, sf_dir)
    records = feeds.envelope(transaction_feed_record(R.signed_events(spark, t)), "account_id")
    stream = _published(records, "transaction_records")
    table, ckpt = SQ.scratch(spark, "fact_transactions_live")
    SQ.run_to_end(SQ.ingest_feed(stream, "transaction", table, ckpt))
    return as_ntz(spark.read.parquet(table).drop("batch_id"))


def stream_balance_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 per event: the balance after every live transaction, from the
    opening balance and the amounts so far (skew-safe within each batch)."""
    from ledgerlake.streaming import queries as SQ
    t = Tables(spark, sf_dir)
    opening = t.customer.select("c_custkey", R.cents("c_acctbal").alias("open_cents"))
    s = _signed_stream(spark, sf_dir).select("event_id", "user_id", "ts", "amount_cents")
    out, ckpt = SQ.scratch(spark, "stream_balance_after")
    SQ.run_to_end(SQ.balance_after_sink(s, "user_id", ["ts", "event_id"], "amount_cents",
                                        opening, "c_custkey", "open_cents", out, ckpt))
    return spark.read.parquet(f"{out}/rows").select(
        "event_id", "user_id", F.col("balance_after").cast("bigint").alias("balance_after"))


def _spread(df: DataFrame) -> DataFrame:
    """``df`` dealt by its columns over the session's shuffle partitions, before
    its rows become text: the splits of a narrow file may be very few."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *df.columns)


def _in_parts(df: DataFrame, n: int, part, name: str) -> tuple[str, int]:
    """``df`` written as ``n`` deliveries by the number ``part``, one after the
    other; returns the folder and the number of files of a delivery.  The rows
    are made once, laid out by delivery, and each delivery reads its own."""
    from ledgerlake.session import path_exists, scratch_path
    spark = df.sparkSession
    folder, files = scratch_path(spark, name), 0
    made = scratch_path(spark, f"{name}_made")
    df.withColumn("__part", part.cast("int")).write.option("compression", "zstd").partitionBy("__part").parquet(made)
    for k in range(n):
        rows = spark.read.schema(df.schema).parquet(f"{made}/__part={k}") if path_exists(spark, f"{made}/__part={k}") else df.limit(0)
        rows.hint("rebalance").write.mode("append").parquet(folder)
        have = len(spark.read.parquet(folder).inputFiles())
        files = max(files, -(-have // (k + 1)))
    return folder, files


def stream_late_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 with late events: the events come in three deliveries, each over the
    whole time span, so that most events of the later two are late; every
    balance is corrected and equals W4 over the whole history."""
    from ledgerlake.streaming import late
    from ledgerlake.streaming import queries as SQ
    t = Tables(spark, sf_dir)
    e = R.signed_events(spark, t).select("event_id", "user_id", "ts", "amount_cents")
    folder, files = _in_parts(e, 3, F.pmod(F.xxhash64("event_id"), F.lit(3)), "late_events")
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", files).parquet(folder)
    out, ckpt = SQ.scratch(spark, "stream_late_balance")
    SQ.run_to_end(late.late_balance_sink(stream, "user_id", "ts", "event_id", "amount_cents", out, ckpt, slots_in_bucket=30))
    opening = t.customer.select("c_custkey", R.cents("c_acctbal").alias("open_cents"))
    return late.balances(spark, out, opening, "c_custkey", "open_cents").select(
        F.col("id").alias("event_id"), F.col("account").alias("user_id"), "balance_after")


def stream_latest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest value per account by event time, continuously."""
    from ledgerlake.streaming import queries as SQ
    SQ.use_rocksdb_state(spark)
    s = _events_stream(spark, sf_dir).select(F.col("user_id").alias("account_id"),
                                              "event_id", "ts",
                                              F.col("value").alias("balance_after"))
    agg = SQ.latest_per_key(s, "account_id", ["ts", "event_id"], ["balance_after"])
    out, ckpt = SQ.scratch(spark, "stream_latest_balance")
    SQ.run_to_end(SQ.changelog_sink(agg, out, ckpt))
    return SQ.current_view(spark, out, "account_id")


def stream_running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: opening balance + running sum of signed amounts per account.

    The stream keeps only the per-account sums (state: one row per key);
    the opening balances are joined when the current view is read, so no
    micro-batch scans the account table."""
    from ledgerlake.streaming import queries as SQ
    SQ.use_rocksdb_state(spark)
    t = Tables(spark, sf_dir)
    agg = SQ.running_totals(_signed_stream(spark, sf_dir), "user_id", "amount_cents",
                            "total_cents")
    out, ckpt = SQ.scratch(spark, "stream_running_balance")
    SQ.run_to_end(SQ.changelog_sink(agg, out, ckpt))
    opening = t.customer.select(F.col("c_custkey").alias("user_id"),
                                R.cents("c_acctbal").alias("open_cents"))
    view = SQ.current_view(spark, out, "user_id")
    return view.join(opening, "user_id", "left").select(
        "user_id", "n_events",
        (F.coalesce(F.col("open_cents"), F.lit(0)) + F.col("total_cents")).alias("balance_cents"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed delivered twice (at-least-once); replays are dropped.
    Skew-safe form: copies collapse map-side inside each micro-batch."""
    from ledgerlake.streaming import queries as SQ
    cols = ["event_id", "user_id", "event_type", "value", "props"]
    a = SQ.with_event_time(_events_stream(spark, sf_dir), "ts").select(*cols, "event_time")
    b = SQ.with_event_time(_events_stream(spark, sf_dir), "ts").select(*cols, "event_time")
    out, ckpt = SQ.scratch(spark, "stream_dedup")
    SQ.run_to_end(SQ.dedup_sink(a.unionByName(b), out, ckpt, "event_time", 600))
    return spark.read.parquet(out).select(
        "event_id", "user_id", F.col("event_time").cast("timestamp_ntz").alias("ts"),
        "event_type", "value")


def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4, low-latency form: ``dropDuplicatesWithinWatermark`` on the whole record."""
    from ledgerlake.streaming import queries as SQ
    SQ.use_rocksdb_state(spark)
    cols = ["event_id", "user_id", "event_type", "value", "props"]
    a = SQ.with_event_time(_events_stream(spark, sf_dir), "ts").select(*cols, "event_time")
    b = SQ.with_event_time(_events_stream(spark, sf_dir), "ts").select(*cols, "event_time")
    d = SQ.drop_replays(a.unionByName(b), "event_time", "10 minutes")
    out, ckpt = SQ.scratch(spark, "stream_dedup_wm")
    SQ.run_to_end(SQ.append_sink(d, out, ckpt))
    return spark.read.parquet(out).select(
        "event_id", "user_id", F.col("event_time").cast("timestamp_ntz").alias("ts"),
        "event_type", "value")


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-static joins to the type lookup and the customer table."""
    from ledgerlake.streaming import queries as SQ
    t = Tables(spark, sf_dir)
    cust = t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    e = _signed_stream(spark, sf_dir)
    j = SQ.enrich(e, [(cust, "user_id", False)])
    out, ckpt = SQ.scratch(spark, "stream_enrich")
    SQ.run_to_end(SQ.append_sink(j.select("event_id", "user_id", "transaction_type",
                                          "c_nationkey"), out, ckpt))
    return spark.read.parquet(out)


def _through_feed(spark: SparkSession, rows: DataFrame, feed: str, table: str) -> DataFrame:
    """Rows published as keyed JSON records (K9), consumed as a stream and
    ingested (R3); ``feed_shards`` shows R6."""
    from ledgerlake.streaming import feeds
    from ledgerlake.streaming import queries as SQ
    records = feeds.envelope(rows, S.FEED_KEYS[feed])
    stream = _published(records, f"{feed}_records")
    out, ckpt = SQ.scratch(spark, table)
    SQ.run_to_end(SQ.ingest_feed(stream, feed, out, ckpt))
    return as_ntz(spark.read.parquet(out).drop("batch_id"))


def stream_ingest_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + K9 + R3: lineitem as the loan-payment feed -> ``fact_loan_payments``."""
    from ledgerlake.plans.catalog.star_queries import lineitem_as_landing_payments
    p = lineitem_as_landing_payments(Tables(spark, sf_dir)).drop("year", "month")
    dates = ("scheduled_payment_date", "payment_date", "paid_date")
    p = p.withColumns({c: F.col(c).cast("string") for c in dates}).select(*S.FEED_LOAN_PAYMENT.names)
    return _through_feed(spark, p, "loan_payment", "fact_loan_payments_live")


def _loan_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as loan feed records; paid loans carry their status as 3."""
    from ledgerlake.plans.catalog.common import orders_as_loans
    o = orders_as_loans(spark, Tables(spark, sf_dir))
    paid = F.col("loan_status_id") == S.PAID_STATUS_CODE
    return o.select(FX.format_id("LOA", "o_orderkey", S.ID_WIDTH).alias("loan_id"),
                     FX.format_id("CUS", "o_custkey", S.ID_WIDTH).alias("customer_id"),
                     F.col("loan_type").alias("type"), R.cents("o_totalprice").alias("amount"),
                     F.lit(S.CURRENCY).alias("currency"), F.lit(7.5).alias("interest_rate"),
                     F.lit(12).alias("term"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"),
                     F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 360), "yyyy-MM-dd").alias("end_date"),
                     F.when(paid, F.lit(str(S.PAID_STATUS_CODE))).otherwise(F.col("loan_status")).alias("status"))


def stream_ingest_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + K9 + R3: orders as the loan feed -> ``dim_loans``; paid
    loans carry their status as the number 3 (P14)."""
    return _through_feed(spark, _loan_feed(spark, sf_dir), "loan", "dim_loans_live")


def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 + K7: the transaction feed in ten micro-batches, whose small batch
    folders are folded while the stream runs; same rows as without."""
    from ledgerlake.sinks import folding
    from ledgerlake.streaming import feeds
    from ledgerlake.streaming import queries as SQ
    e = R.signed_events(spark, Tables(spark, sf_dir)).select("event_id", "user_id", "ts", "transaction_type", "amount_cents")
    records = feeds.envelope(transaction_feed_record(_spread(e)), "account_id")
    folder, files = _in_parts(records, 10, F.pmod(F.xxhash64("value"), F.lit(10)), "transaction_records")
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", files).parquet(folder)
    table, ckpt = SQ.scratch(spark, "fact_transactions_folded")
    SQ.run_to_end(SQ.ingest_feed(stream, "transaction", table, ckpt, fold_every=4, least=3))
    return as_ntz(folding.read(spark, table).drop("batch_id"))


def stream_upsert_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 for ``dim_loans``: every loan is sent three times with a status each,
    the deliveries out of order; one row a loan stays, the one sent last."""
    from ledgerlake.sinks.keyed import KeyedTable
    from ledgerlake.streaming import feeds
    from ledgerlake.streaming import queries as SQ
    loans = _loan_feed(spark, sf_dir)
    sent = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("nth")
    n = F.regexp_extract("loan_id", r"([0-9]+)$", 1).cast("long")
    sends = loans.select("*", sent).withColumns({
        "status": F.when(F.col("nth") < 2, F.concat(F.lit("sent "), F.col("nth"))).otherwise(F.col("status")),
        "delivery": F.pmod(F.col("nth") + n, F.lit(3))})
    records = sends.select(F.col(S.FEED_KEYS["loan"]).cast("string").alias("key"),
                           F.to_json(F.struct(*loans.columns), feeds.JSON_OPTIONS).alias("value"), F.col("nth").alias("sent_at"), "delivery")
    folder, files = _in_parts(records, 3, F.col("delivery"), "loan_records")
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", files).parquet(folder)
    table, ckpt = SQ.scratch(spark, "dim_loans_keyed")
    SQ.run_to_end(SQ.upsert_loans(stream, table, ckpt, n_buckets=8))
    return as_ntz(KeyedTable(spark, table, "loan_id", ["sent_at"], 8).read().drop("sent_at"))


def feed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feed records over as many shards as the session has
    shuffle partitions: records of each account and the number of shards
    they lie on."""
    from ledgerlake.streaming import feeds
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = transaction_feed_record(R.signed_events(spark, Tables(spark, sf_dir)))
    on = feeds.envelope(rows, S.FEED_KEYS["transaction"], num_partitions=shards).withColumn("shard", F.spark_partition_id())
    per = on.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("key").agg(F.sum("n").alias("n_records"), F.count(F.lit(1)).alias("n_shards"))
