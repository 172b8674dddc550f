"""Run with a retrying local master: tasks of one partition fail on their
first attempt; sequence ids and the range running balance must still give
the brute-force answer."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from ledgerlake.operators import analytics  # noqa: E402


@F.udf(T.BooleanType())
def fail_first_attempt(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def main():
    master = os.environ.get("RETRY_MASTER", "local[2,3]")   # up to 3 attempts per task
    spark = (SparkSession.builder.master(master).config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    rows = [(i, i % 5 if i % 3 else 0, i * 3 % 7 - 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k long, amt long").repartition(3)
    flaky = df.where(fail_first_attempt(F.col("id")))
    seq = sorted((r["id"], r["seq"]) for r in analytics.sequence_ids(flaky, ["id"]).collect())
    assert seq == [(i, i + 1) for i in range(3000)], "sequence ids"
    run = {r["id"]: r["rb"] for r in analytics.running_balance_ranges(
        flaky.withColumn("ts", F.lit(0)), "k", ["ts", "id"], "amt", out_col="rb").collect()}
    want, tot = {}, {}
    for i, k, a in sorted(rows, key=lambda r: (r[1], r[0])):
        tot[k] = tot.get(k, 0) + a
        want[i] = tot[k]
    assert run == want, "running balance"
    print("OK")


if __name__ == "__main__":
    main()
