"""Customer analytics and derived balances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import strip_prefix_int


def max_id(df: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """A1 + F13: largest numeric part of prefixed ids, 0 for an empty table.
    (A numeric max, right even when id widths differ.)"""
    return df.agg(F.coalesce(F.max(strip_prefix_int(id_col, prefix)), F.lit(0)).cast("bigint")
                  .alias("max_id"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A4: one row per table with its row count (each a partial aggregate)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def signed_amount(amount: Column, sign: Column) -> Column:
    """Amount with the sign its type implies (+1, -1; 0 keeps the amount)."""
    return F.when(sign < 0, -F.abs(amount)).when(sign > 0, F.abs(amount)).otherwise(amount)


def cashflow_summary(tx: DataFrame, key: str, amount: str, months: int = 12,
                     places: int = 2) -> DataFrame:
    """A5: total count, inflow, outflow, net, average per month.
    Rows must already be the period's rows (see ``slices.trailing_months``)."""
    a = F.col(amount)
    inflow = F.coalesce(F.sum(F.when(a > 0, a)), F.lit(0.0))
    outflow = F.coalesce(F.sum(F.when(a < 0, -a)), F.lit(0.0))
    g = tx.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("total_transactions"),
                            inflow.alias("total_inflow"), outflow.alias("total_outflow"))
    return g.select(
        key, "total_transactions",
        F.round("total_inflow", places).alias("total_inflow"),
        F.round("total_outflow", places).alias("total_outflow"),
        F.round(F.col("total_inflow") - F.col("total_outflow"), places).alias("net_cashflow"),
        F.floor(F.col("total_transactions") / months).cast("int").alias("avg_monthly_transactions"))


def spending_by_type(tx: DataFrame, key: str, type_col: str, amount: str,
                     places: int = 2, pct_places: int = 1) -> DataFrame:
    """Per key and type: count, amount (magnitude), share of the key's
    total amount in percent.  The share window runs over the aggregate,
    whose size per key is the number of types."""
    g = tx.groupBy(key, type_col).agg(F.count(F.lit(1)).cast("int").alias("count"),
                                      F.sum(F.abs(F.col(amount))).alias("__amt"))
    total = F.sum("__amt").over(Window.partitionBy(key))
    return g.select(key, F.col(type_col).alias("type"), "count",
                    F.round("__amt", places).alias("amount"),
                    F.round(F.col("__amt") / total * 100, pct_places).alias("percentage"))


def nest_by_type(by_type: DataFrame, key: str) -> DataFrame:
    """A6 nested: one array of {type, count, amount, percentage} per key
    (bounded by the number of types)."""
    return by_type.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct("type", "count", "amount", "percentage"))).alias("by_type"))


def spending_by_channel(tx: DataFrame, key: str, channel_col: str, amount: str | None,
                        channels: Sequence[str] = ("branch", "atm", "online"),
                        pct_places: int | None = 1) -> DataFrame:
    """Share per channel in percent.  ``amount=None`` shares by count;
    ``pct_places=None`` leaves the share unrounded."""
    w = F.lit(1.0) if amount is None else F.abs(F.col(amount))
    aggs = [F.sum(F.when(F.col(channel_col) == c, w).otherwise(0.0)).alias(c) for c in channels]
    g = tx.groupBy(key).agg(F.sum(w).alias("__total"), *aggs)
    shares = [F.col(c) / F.col("__total") * 100 for c in channels]
    if pct_places is not None:
        shares = [F.round(x, pct_places) for x in shares]
    shares = [x.alias(c) for x, c in zip(shares, channels)]
    return g.select(key, *shares)


def balance_after(tx: DataFrame, accounts: DataFrame, tx_account: str, acc_key: str,
                  balance: str, amount: str, type_col: str, flip_types: Sequence,
                  places: int = 0) -> DataFrame:
    """``balance_after = round(opening balance + amount)``; if that is
    negative for a flippable type the amount changes sign and the balance
    is recomputed (the type code is kept, D12).  Adds ``amount_applied``,
    ``overdraft_flip`` and ``balance_after``."""
    acc = accounts.select(F.col(acc_key).alias("__acc"), F.col(balance).alias("__open"))
    j = tx.join(acc, tx[tx_account] == acc["__acc"], "inner")
    first = F.round(F.col("__open") + F.col(amount), places)
    flip = (first < 0) & F.col(type_col).isin(list(flip_types))
    applied = F.when(flip, -F.col(amount)).otherwise(F.col(amount))
    return (j.withColumn("overdraft_flip", flip)
            .withColumn("amount_applied", applied)
            .withColumn("balance_after", F.round(F.col("__open") + F.col("amount_applied"), places))
            .drop("__acc", "__open"))


def running_balance(tx: DataFrame, key: str, order_by: Sequence[str], amount: str,
                    opening: DataFrame | None = None, opening_key: str | None = None,
                    opening_balance: str | None = None,
                    out_col: str = "running_balance") -> DataFrame:
    """Opening balance + cumulative amount in event order, per key.

    One method at every size: ``running_balance_ranges``.  No row is lost:
    a NULL key is a key of its own (opening balance 0), a NULL in
    ``order_by`` sorts first, a NULL amount counts as 0."""
    out = running_balance_ranges(tx, key, order_by, amount, out_col=out_col)
    return _add_opening(out, key, out_col, opening, opening_key, opening_balance)


def _add_opening(out: DataFrame, key: str, out_col: str, opening, opening_key, opening_balance):
    if opening is None:
        return out
    op = opening.select(F.col(opening_key).alias("__ok"), F.col(opening_balance).alias("__ob"))
    out = out.join(op, out[key] == op["__ok"], "left")
    return out.withColumn(out_col, F.coalesce(F.col("__ob"), F.lit(0)) + F.col(out_col)).drop(
        "__ok", "__ob")


def running_balance_ranges(tx: DataFrame, key: str, order_by: Sequence[str], amount: str,
                           out_col: str = "running_balance") -> DataFrame:
    """W4, balanced for any skew: a distributed prefix sum.

    1. Range-partition on (key, order_by...): Spark's sampler cuts even a
       key -- or one instant -- that holds a third of the rows into many
       ranges, and each range is sorted (NULLs first).  AQE sizes the
       partitions.
    2. One vectorised pass per partition (``mapInArrow``, carrying the sum
       across batches) gives running sums within the partition.  The
       built-ins cannot scan a partition in order without shuffling it
       again.  The result is written to the shared folder, so the reads
       below see the same rows, the shuffle runs once, and the small read
       touches only the key and two added columns.
    3. Only a partition's first and last key can continue into a
       neighbour, so the offsets that must cross partitions come from a
       table of one row per partition (first key, last key, last key's
       sum): a cumulative window over it gives each continuing key its
       offset, broadcast back (one row per partition).
    Keys are compared null-safely.  ``order_by`` (with ``key``) must order
    rows totally (end with an id).
    """
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql import types as T

    from ledgerlake.session import scratch_path

    spark = tx.sparkSession
    keys = [key, *order_by]
    ranged = (tx.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("__pid", F.spark_partition_id()))
    integral = isinstance(tx.schema[amount].dataType,
                          (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    np_type = "int64" if integral else "float64"       # integer sums stay exact
    local_type = T.LongType() if integral else T.DoubleType()
    schema = T.StructType(ranged.schema.fields + [T.StructField("__n", T.LongType()),
                                                  T.StructField("__local", local_type)])
    kpos = ranged.columns.index(key)
    apos = ranged.columns.index(amount)

    def scan(batches):
        carry_key, carry, done = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            k = batch.column(kpos)
            a = pc.fill_null(batch.column(apos).cast(np_type), 0).to_numpy(zero_copy_only=False)
            x, y = k.slice(1), k.slice(0, n - 1)
            same = pc.or_(pc.fill_null(pc.equal(x, y), False), pc.and_(pc.is_null(x), pc.is_null(y)))
            group = np.concatenate([[0], np.cumsum(~same.to_numpy(zero_copy_only=False))])
            local = pd.Series(a).groupby(group).cumsum().to_numpy()
            if done and k[0].as_py() == carry_key:
                local[group == 0] += carry
            carry_key, carry = k[n - 1].as_py(), local[-1]
            number = pa.array(np.arange(done, done + n))
            done += n
            yield pa.RecordBatch.from_arrays([*batch.columns, number, pa.array(local)],
                                             [*batch.schema.names, "__n", "__local"])

    path = scratch_path(spark, "running-balance")
    ranged.mapInArrow(scan, schema).write.parquet(path)
    local = spark.read.schema(schema).parquet(path)
    # Key ranges are contiguous, so a key that continues into partition p is
    # the last key of the previous non-empty partition; its offset is the
    # running total of that key's last-key sums up to there.  One window
    # over at most one row per partition, no pairs.
    edges = local.groupBy("__pid").agg(F.min_by(key, "__n").alias("__first"),
                                       F.max_by(key, "__n").alias("__last"),
                                       F.max_by("__local", "__n").alias("__tot"))
    by_pid = Window.orderBy("__pid")
    cum = F.sum("__tot").over(Window.partitionBy("__last").orderBy("__pid")
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = edges.withColumn("__cum", cum)
    offsets = (edges.select(F.col("__pid").alias("__p"), "__first",
                            F.lag("__pid").over(by_pid).alias("__prev"),
                            F.lag("__last").over(by_pid).alias("__prev_last"),
                            F.lag("__cum").over(by_pid).alias("__off"))
               .where(F.col("__prev").isNotNull() & F.col("__prev_last").eqNullSafe(F.col("__first")))
               .select("__p", "__first", "__off"))
    out = local.join(F.broadcast(offsets), (F.col("__pid") == F.col("__p"))
                     & F.col(key).eqNullSafe(F.col("__first")), "left")
    total = F.col("__local") + F.coalesce(F.col("__off"), F.lit(0))
    src_type = tx.schema[amount].dataType
    return out.withColumn(out_col, total.cast(src_type)).select(*tx.columns, out_col)


def sequence_ids(df: DataFrame, order_by: Sequence[str], id_col: str = "seq") -> DataFrame:
    """1-based sequential numbers in ``order_by`` order, without a
    single-partition window.

    Rows are range-partitioned and sorted within partitions; each row gets
    its partition index and local offset (``monotonically_increasing_id``),
    the numbered rows are written to the shared folder so every later read
    sees the same numbering, and per-partition counts (one row per
    partition, a proven small size) give the offsets.  AQE sizes the
    partitions.
    """
    from ledgerlake.session import scratch_path
    spark = df.sparkSession
    # Ties in ``order_by`` have no order of their own; a row-position
    # tiebreak (fixed by the input files) lets the range partitioner cut a
    # value that holds a third of the rows into many ranges.
    keyed = df.withColumn("__tb", F.monotonically_increasing_id())
    keys = [*order_by, "__tb"]
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tb")
    path = scratch_path(spark, "sequence")
    ordered = ordered.withColumn("__mid", F.monotonically_increasing_id())
    ordered.write.parquet(path)
    numbered = spark.read.schema(ordered.schema).parquet(path)
    part = F.shiftright(F.col("__mid"), 33)
    local = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = numbered.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    out = numbered.join(F.broadcast(offsets), part == F.col("__p"), "inner")
    return out.withColumn(id_col, (F.col("__off") + local + 1).cast("bigint")).drop(
        "__mid", "__p", "__off")


def next_ids(new_rows: DataFrame, existing: DataFrame, existing_id: str, prefix: str,
             order_by: Sequence[str], id_col: str = "id", width: int = 7) -> DataFrame:
    """A1 + W3 + F12: ids for new rows that continue after the largest id in
    ``existing`` (``prefix`` + zero-padded number), in ``order_by`` order.
    The largest id is a scalar subquery (computed once, no join); the
    numbering is the skew-safe ``sequence_ids``."""
    from ledgerlake.functions.scalars import format_id
    top = max_id(existing, existing_id, prefix).scalar()
    numbered = sequence_ids(new_rows, order_by, "__seq")
    return numbered.withColumn(id_col, format_id(prefix, top + F.col("__seq"), width)).drop("__seq")
