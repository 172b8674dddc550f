"""What streams read and write grows with the input, not faster."""

from collections import Counter

from pyspark.sql import functions as F

from ledgerlake.plans.catalog import stream_queries
from ledgerlake.session import checkpoint_root
from ledgerlake.sinks import paths
from ledgerlake.streaming import queries as SQ


def test_deliveries_make_their_rows_once(spark):
    """Rows that come out otherwise each time they are made: each still lies in one delivery."""
    df = spark.range(1000).select("id", F.expr("uuid()").alias("u"))
    folder, files = stream_queries._in_parts(df, 5, F.pmod(F.xxhash64("u"), F.lit(5)), "t_parts")
    got = spark.read.parquet(folder)
    assert sorted(r.id for r in got.select("id").collect()) == list(range(1000)) and files >= 1


def test_rows_of_one_split_are_spread(spark):
    spread = stream_queries._spread(spark.range(1000, numPartitions=1).withColumn("n", F.lit(None).cast("long")))
    per = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(per) > 1 and sum(r["count"] for r in per) == 1000


def test_published_records_are_smaller_than_their_text(spark):
    n = F.col("id")
    body = F.to_json(F.struct(n, F.lit("a field of each record that is always the same").alias("text"), F.lit(1.5).alias("rate")))
    records = spark.range(20000).select(F.when(n % 7 > 0, n.cast("string")).alias("key"), F.when(n % 11 > 0, body).alias("value")).coalesce(1)
    text = records.agg(F.sum(F.length("value"))).first()[0]
    stream = stream_queries._published(records, "t_published")
    out, ckpt = SQ.scratch(spark, "t_published_out")
    SQ.run_to_end(SQ.append_sink(stream, out, ckpt))
    assert Counter(spark.read.parquet(out).collect()) == Counter(records.collect())
    topic = next(f for f in paths.folders(spark, checkpoint_root(spark)) if f.startswith("t_published-"))
    assert paths.size(spark, f"{checkpoint_root(spark)}/{topic}") < text / 3
