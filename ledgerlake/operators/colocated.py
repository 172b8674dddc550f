"""Customer 360 without shuffles (J10, B17): tables bucketed by customer.

A shuffle of all transactions by customer is paid once, when the tables are
written, and not by every run over them: tables bucketed and sorted by the
same key, into the same number of buckets, join and group bucket by bucket.

A bucket is read by one task, so no key may fill it alone.  Keys of more
than ``hot_rows`` rows are counted when the table is written (a partial
aggregate) and their rows kept apart, range-partitioned; the documents of
those keys come from the skew-safe path (``nest.nest_children_chunked``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.nest import nest_children_chunked


def write_bucketed(df: DataFrame, table: str, key: str, n_buckets: int, sort_by: Sequence[str] = (), path: str | None = None) -> None:
    """``df`` as a table in ``n_buckets`` files, one a bucket, sorted by key and
    ``sort_by`` (the shuffle's hash is the buckets' hash)."""
    w = df.repartition(n_buckets, key).write.mode("overwrite").format("parquet").bucketBy(n_buckets, key).sortBy(key, *sort_by)
    (w.option("path", path) if path else w).saveAsTable(table)


def hot_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys of more than ``hot_rows`` rows, NULL among them."""
    n = df.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
    return n.where(F.col("__n") > hot_rows).select("__hot")


class ColocatedChildren:
    """Children of a key in a bucketed table, those of hot keys beside it."""

    def __init__(self, spark: SparkSession, table: str, hot_path: str, key: str, order_by: Sequence[str], n_buckets: int):
        self.spark, self.table, self.hot_path = spark, table, hot_path
        self.key, self.order_by, self.n = key, list(order_by), n_buckets

    def write(self, df: DataFrame, hot_rows: int = 5_000_000, path: str | None = None) -> None:
        from ledgerlake.sinks.writers import write_parquet
        hot = hot_keys(df, self.key, hot_rows)
        is_hot = F.col(self.key).eqNullSafe(F.col("__hot"))
        write_parquet(df.join(hot, is_hot, "left_semi"), self.hot_path)
        write_bucketed(df.join(hot, is_hot, "left_anti"), self.table, self.key, self.n, self.order_by, path)

    def hot(self) -> DataFrame:
        return self.spark.read.schema(self.spark.table(self.table).schema).parquet(self.hot_path)

    def chunks(self, chunk_size: int = 1000, as_col: str = "items") -> DataFrame:
        """Every child nested in order, in chunks of ``chunk_size`` at most, as
        ``nest_children_chunked`` gives them; no shuffle for the keys in the
        table."""
        rows = self.spark.table(self.table)
        pos = F.row_number().over(Window.partitionBy(self.key).orderBy(*[F.col(c).asc_nulls_first() for c in self.order_by])) - 1
        items = F.array_sort(F.collect_list(F.struct("__pos", *rows.columns)))
        cold = (rows.withColumn("__pos", pos).groupBy(self.key, F.floor(F.col("__pos") / chunk_size).cast("long").alias("chunk"))
                .agg(items.alias("__items")))
        cold = cold.select(self.key, "chunk", F.size("__items").alias("n"),
                           F.transform("__items", lambda x: F.struct(*[x[c].alias(c) for c in rows.columns])).alias(as_col))
        if self.hot().isEmpty():
            return cold
        return cold.unionByName(nest_children_chunked(self.hot(), self.key, self.order_by, chunk_size, as_col))


def with_parent(parent: DataFrame, parent_key: str, chunks: DataFrame, child_key: str) -> DataFrame:
    """A parent's columns beside each of its chunks, NULL where it has none:
    a merge join, which two bucketed sides need no shuffle for."""
    return parent.hint("merge").join(chunks, parent[parent_key] == chunks[child_key], "left").drop(child_key)
