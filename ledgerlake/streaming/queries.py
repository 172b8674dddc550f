"""Stream queries R1-R6 on Structured Streaming.

Sources are any streaming DataFrame (a Kafka/Kinesis reader parsed with
``feeds.parse_feed``, or files).  Sinks write to the shared checkpoint
folder (``spark.checkpoint.dir``) so a restarted query resumes from its
checkpoint, and every micro-batch write is idempotent:

* ``changelog_sink`` -- update-mode aggregates: each batch overwrites
  ``<path>/batch_id=<n>``; ``current_view`` reads the newest row per key.
* append-mode file sink for row streams (exactly-once via the file sink
  log).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

if TYPE_CHECKING:
    from ledgerlake.streaming.orphans import Orphans

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Large keyed state (one row per account, kept for ever) off the JVM heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class state_partitions:
    """Context manager: the shuffle-partition count a stateful query is
    started with.  It is written into the checkpoint at first start and
    cannot change later, so size it for the key count at full scale
    (e.g. one partition per ~10-50 M keys of state)."""

    def __init__(self, spark: SparkSession, n: int):
        self.spark, self.n, self.prev = spark, n, None

    def __enter__(self):
        self.prev = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", str(self.n))
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.prev)
        return False


def parquet_stream(spark: SparkSession, folder: str, file_glob: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Files as a stream (tests and file drops); schema from the files."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(folder).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def with_event_time(df: DataFrame, ts_col: str, out_col: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (session zone UTC), not TIMESTAMP_NTZ."""
    return df.withColumn(out_col, F.col(ts_col).cast("timestamp"))


# R1 ------------------------------------------------------------------------
def latest_per_key(stream: DataFrame, key: str, order_by: Sequence[str],
                   values: Sequence[str]) -> DataFrame:
    """Newest row per key by event time (``max_by`` over (ts, id)).
    A late event with an older time never replaces a newer one.  State is
    one row per key; with fixed-width values it is hashed (``latest_by_agg``)."""
    from ledgerlake.operators import latest
    if latest.order_number(stream, order_by) is not None and all(latest.fixed_width(stream.schema[c].dataType) for c in values):
        return latest.latest_by_agg(stream, [key], order_by, values)
    ordering = F.struct(*[F.col(c) for c in order_by])
    return stream.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in values]), ordering).alias("__v")
    ).select(key, "__v.*")


# R2 ------------------------------------------------------------------------
def running_totals(stream: DataFrame, key: str, amount: str, out_col: str = "total"
                   ) -> DataFrame:
    """R2: per-key running sum of amounts (update mode)."""
    return stream.groupBy(key).agg(F.sum(amount).alias(out_col),
                                   F.count(F.lit(1)).alias("n_events"))


# R4 ------------------------------------------------------------------------
def drop_replays(stream: DataFrame, event_time: str, delay: str = "10 minutes",
                 columns: Sequence[str] | None = None, salts: int = 16) -> DataFrame:
    """R4, low-latency form: drop records seen again within the watermark
    delay, comparing the whole record (not an id, which the source may
    repeat, D11).  Copies are dropped twice: among the records of a group of
    source tasks first, then among what is left, ``salts`` copies of a record
    at most, so that a record copied very many times isn't one task's work."""
    cols = list(columns or stream.columns)
    marked = stream.withWatermark(event_time, delay).withColumn("__salt", F.spark_partition_id() % salts)
    return marked.dropDuplicatesWithinWatermark([*cols, "__salt"]).drop("__salt").dropDuplicatesWithinWatermark(cols)


def same(a: DataFrame, b: DataFrame, cols: Sequence[str]):
    """Null-safe equality of columns of two frames."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def dedup_sink(stream: DataFrame, path: str, checkpoint: str, event_time: str,
               delay_seconds: int = 600, columns: Sequence[str] | None = None,
               available_now: bool = True):
    """R4, skew-safe form: each micro-batch is de-duplicated as a batch
    (a partial aggregate, so a record sent a million times crosses the
    shuffle once per map task), then rows already written by earlier
    batches within ``delay_seconds`` of the batch's oldest event are
    removed by a null-safe anti join on a hash of the record, made once, and
    the record itself.  Rows without an event time are
    compared with all earlier rows without one.  The output is partitioned
    by batch and event day, so looking back lists and reads only the days in
    reach.  Each batch overwrites its own folder and ignores it when looking
    back, so a replayed batch writes the same rows."""
    from ledgerlake.session import path_exists
    cols = list(columns or stream.columns)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.to_date(F.col(event_time))
        fresh = batch.dropDuplicates(cols).persist()
        try:
            out = fresh
            if path_exists(spark, path):
                lo = fresh.agg(F.min(event_time)).first()[0]
                near = F.col("event_day").isNull()
                if lo is not None:
                    horizon = F.lit(lo).cast("timestamp") - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")
                    near = near | ((F.col("event_day") >= F.to_date(horizon)) & (F.col(event_time) >= horizon))
                seen = spark.read.schema(_with_parts(batch)).parquet(path)
                seen = seen.where((F.col("batch_id") != batch_id) & near).select(*cols).withColumn("__seen_hash", F.xxhash64(*cols))
                hashed = fresh.withColumn("__hash", F.xxhash64(*cols))
                equal = (hashed["__hash"] == seen["__seen_hash"]) & same(hashed, seen, cols)
                out = hashed.join(seen, equal, "left_anti").drop("__hash")
            (out.withColumn("event_day", day).hint("rebalance", "event_day")  # one task for a day unless it is large
             .write.mode("overwrite").partitionBy("event_day").parquet(f"{path}/batch_id={batch_id}"))
        finally:
            fresh.unpersist()

    w = (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(write_batch))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def _with_parts(batch: DataFrame):
    """Schema of the rows that ``dedup_sink`` has written."""
    from pyspark.sql import types as T
    return T.StructType(batch.schema.fields + [T.StructField("batch_id", T.LongType()),
                                               T.StructField("event_day", T.DateType())])


#: Batches between two folded states of the carried totals.
FOLD_EVERY = 16


def carried_totals(spark: SparkSession, path: str, batch_id: int, key: str, schema,
                   fold_every: int = FOLD_EVERY) -> DataFrame:
    """(key, total) after all batches before ``batch_id``.

    Every ``fold_every`` batches the totals so far are folded into one
    folder (written once, when the first batch after it starts), so a batch
    reads one folded folder and fewer than ``fold_every`` batch folders,
    however long the stream has run."""
    from ledgerlake.session import path_exists

    def read(base: int, upto: int) -> DataFrame:
        at = [(-1, f"{path}/folded/upto={base}")] if base else []
        at += [(n, f"{path}/batch_id={n}") for n in range(base, upto)]
        out = spark.createDataFrame([], schema).withColumn("__at", F.lit(-2))
        for n, p in at:
            if path_exists(spark, p):
                out = out.unionByName(spark.read.schema(schema).parquet(p).withColumn("__at", F.lit(n)))
        return out.groupBy(key).agg(F.max_by("total", "__at").alias("total"))

    base = batch_id // fold_every * fold_every
    for upto in range(fold_every, base + 1, fold_every):
        done = f"{path}/folded/upto={upto}"
        if upto == base and not path_exists(spark, f"{done}/_SUCCESS"):
            read(upto - fold_every, upto).write.mode("overwrite").parquet(done)
    return read(base, batch_id)


def balance_after_sink(stream: DataFrame, key: str, order_by: Sequence[str], amount: str,
                       opening: DataFrame, opening_key: str, opening_balance: str,
                       path: str, checkpoint: str, available_now: bool = True):
    """R2, per event: the balance after every transaction of a stream
    (what the live feed lacks and the latest-balance query reads).

    Each micro-batch: the batch's rows get the skew-safe running sum (W4);
    each account starts from its total after the previous batches
    (``carried_totals``) or, the first time, from its opening balance.  Rows
    go to ``path/rows/batch_id=n`` and new totals to
    ``path/totals/batch_id=n``; a replayed batch ignores its own earlier
    output and overwrites it, so the result is the same.  A NULL key is an
    account of its own without an opening balance.

    Events are applied in arrival order across batches and in event order
    within a batch, so an event that arrives after later ones gets another
    balance than W4 over the whole history gives it."""
    from pyspark.sql import types as T

    from ledgerlake.operators.analytics import running_balance
    rows_path, totals_path = f"{path}/rows", f"{path}/totals"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            schema = T.StructType([batch.schema[key], T.StructField("total", batch.schema[amount].dataType)])
            sums = batch.groupBy(F.col(key).alias("__k")).agg(F.coalesce(F.sum(amount), F.lit(0)).alias("__sum"))
            prev = carried_totals(spark, totals_path, batch_id, key, schema).select(
                F.col(key).alias("__pk"), F.col("total").alias("__prev"))
            first = opening.select(F.col(opening_key).alias("__ok"), F.col(opening_balance).alias("__open"))
            base = (sums.join(prev, F.col("__k").eqNullSafe(F.col("__pk")), "left")
                    .join(first, F.col("__k") == F.col("__ok"), "left")
                    .select("__k", "__sum", F.coalesce("__prev", "__open", F.lit(0)).alias("__base")))
            run = running_balance(batch, key, order_by, amount, out_col="__in_batch")
            rows = run.join(base, F.col(key).eqNullSafe(F.col("__k")), "left").withColumn(
                "balance_after", F.col("__base") + F.col("__in_batch")).drop("__k", "__sum", "__base", "__in_batch")
            rows.write.mode("overwrite").parquet(f"{rows_path}/batch_id={batch_id}")
            totals = base.select(F.col("__k").alias(key),
                                 (F.col("__base") + F.col("__sum")).cast(schema["total"].dataType).alias("total"))
            totals.write.mode("overwrite").parquet(f"{totals_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = (stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(write_batch))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


# R5 ------------------------------------------------------------------------
def enrich(stream: DataFrame, dims: Sequence[tuple[DataFrame, str | Sequence[str], bool]],
           persist_static: bool = False) -> DataFrame:
    """Stream-static inner joins; ``(dim, on, fixed_size)`` -- fixed-size
    dimensions are broadcast, the rest are left to the planner.  A static
    side is read again by every micro-batch; for a long-running stream on a
    large dimension ``persist_static`` keeps it on the executors
    (memory and disk; lost blocks are recomputed from the source)."""
    from pyspark import StorageLevel
    out = stream
    for dim, on, fixed in dims:
        if persist_static and not fixed:
            dim = dim.persist(StorageLevel.MEMORY_AND_DISK)
        out = out.join(F.broadcast(dim) if fixed else dim, on, "inner")
    return out


# Sinks ---------------------------------------------------------------------
def changelog_sink(agg: DataFrame, path: str, checkpoint: str,
                   transform: Callable[[DataFrame], DataFrame] | None = None,
                   available_now: bool = True):
    """Update-mode aggregate -> one folder per micro-batch (overwrite, so a
    replayed batch writes the same files)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        b = transform(batch) if transform else batch
        b.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(write_batch))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def current_view(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest row per key over all batches of a changelog."""
    log = spark.read.parquet(path)
    vals = [c for c in log.columns if c not in (key, "batch_id")]
    return log.groupBy(key).agg(F.max_by(F.struct(*vals), F.col("batch_id")).alias("__v")
                                ).select(key, "__v.*")


def compact_changelog(spark: SparkSession, path: str, key: str, snapshot_path: str) -> str:
    """Fold a changelog into one snapshot (newest row per key), written as a
    single batch folder of the same layout under ``snapshot_path``; readers
    switch to it once written, and later batches are read on top of it."""
    last = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    current_view(spark, path, key).write.mode("overwrite").parquet(
        f"{snapshot_path}/batch_id={last}")
    return snapshot_path


def append_sink(stream: DataFrame | Orphans, path: str, checkpoint: str, available_now: bool = True):
    """Append-mode parquet file sink (exactly-once through its log).  Orphans
    (``orphans.Orphans``) go to a folder a batch."""
    from ledgerlake.streaming.orphans import Orphans
    if isinstance(stream, Orphans):
        return stream.start(path, checkpoint, available_now)
    w = (stream.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint).option("path", path))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def ingest_feed(records: DataFrame, feed: str, table_path: str, checkpoint: str,
                available_now: bool = True, fold_every: int | None = None, **fold):
    """Parse a keyed JSON feed into its fact/dimension shape
    (``fact_transactions``, ``fact_loan_payments``, ``dim_loans``) and add
    each micro-batch to a table partitioned by ``year``/``month``/``batch_id``.
    Writes use dynamic partition overwrite, so a replayed batch replaces
    exactly its own partitions (idempotent), and readers prune by month.
    With ``fold_every``, small batch folders are folded after as many
    batches (``sinks.folding``); the table is then read with its ``read``."""
    from ledgerlake.sinks import folding
    from ledgerlake.streaming import feeds
    typer, shaper = feeds.TO_TABLE[feed]
    rows = shaper(typer(feeds.parse_feed(records, feed)))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        from ledgerlake.sinks.writers import write_partitioned
        write_partitioned(batch.withColumn("batch_id", F.lit(batch_id).cast("long")),
                          table_path, ("year", "month", "batch_id"), mode="overwrite")
        if fold_every and batch_id % fold_every == fold_every - 1:
            folding.fold(batch.sparkSession, table_path, before=batch_id, **fold)

    w = (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(write_batch))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def upsert_loans(records: DataFrame, table_path: str, checkpoint: str, sent: str = "sent_at", n_buckets: int = 64,
                 available_now: bool = True):
    """R3 for the loan dimension: a loan is sent again with each change of
    status, and ``dim_loans`` has one row per loan, the one sent last
    (``sent``, a column of the envelope).  Each micro-batch updates the keyed
    table under its batch id, so a replayed batch gives the same rows."""
    from ledgerlake.sinks.keyed import KeyedTable
    from ledgerlake.streaming import feeds
    rows = feeds.loans_to_dim(feeds.typed_loans(feeds.parse_feed(records, "loan", keep=[sent])), keep=[sent])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, table_path, "loan_id", [sent], n_buckets).update(batch, batch_id)

    w = (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(write_batch))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def run_to_end(query) -> None:
    """Wait for an ``availableNow`` query; re-raise its failure."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(str(exc))


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output path, checkpoint path) under the shared checkpoint root."""
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"
