"""J12 on streams: payments whose loan never comes.

A payment waits for its loan as long as ``wait`` after it was sent, as feeds
may overtake each other; a loan is kept for ``term``, as long as payments for
it may come.  A watermark over both feeds lets either expire, and a payment
that has waited in vain is given out.

What waits and what is kept lies in files beside the checkpoint, not in a
state store, which holds every payment and loan as an entry of its own and
outgrows memory with them.  Each micro-batch is one join by sorting, of the
payments that wait or arrive and the loans that are kept or arrive, which
spills where it must.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sinks import paths

#: Folders of kept loans that are read side by side before they become one.
FOLD_EVERY = 16


def orphans(payments: DataFrame, loans: DataFrame, key: str, sent: str, wait: str = "1 day", term: str = "3650 days",
            delay: str = "10 minutes", salts: int = 8) -> Orphans:
    """Rows of the stream ``payments`` for whose ``key`` no row of the stream
    ``loans`` was sent in the ``term`` before or the ``wait`` after (column
    ``sent`` of both), to be written by ``queries.append_sink``.  A NULL key
    refers to no loan and is no orphan; a row without a time neither expires
    nor meets another.  The watermark is the newest time of the feed that is
    behind, less ``delay``; rows that the watermark had passed before the last
    batch began are dropped.

    A loan's payments are dealt into ``salts`` groups, with a copy of the loan
    in each, so that a loan with very many payments isn't one task's work."""
    return Orphans(payments, loans, key, sent, wait, term, delay, salts)


class Orphans:
    """The orphans of two streams, of the columns ``schema``.

    ``kept/marks/<n>`` tells how far batch n came: the watermark that it began
    with, that of either feed after it, and the folders of the kept loans.  It
    is written last; a batch reads what the mark before its own names and
    replaces what it had written itself, so one that is cut off and done again
    gives the same rows.  A payment is given out by the batch after which the
    watermark has passed the end of its wait."""

    def __init__(self, payments: DataFrame, loans: DataFrame, key: str, sent: str, wait: str, term: str, delay: str, salts: int):
        self.key, self.sent, self.wait, self.term, self.delay, self.salts = key, sent, wait, term, delay, salts
        self.schema = payments.schema
        known = loans.select(F.col(key).alias("__lkey"), F.col(sent).alias("__lsent"))
        self.known_schema = known.schema
        valid = F.col(key).isNotNull() & F.col(sent).isNotNull()
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema]
        rows = payments.where(valid).select(F.struct(*payments.columns).alias("__row"), *nothing)
        self.both = rows.unionByName(known.where("__lkey IS NOT NULL AND __lsent IS NOT NULL").select(
            F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), "__lkey", "__lsent"))

    def start(self, path: str, checkpoint: str, available_now: bool = True):
        """Starts the query; batch n's orphans are written to ``path/batch_id=n``."""
        w = (self.both.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .foreachBatch(lambda batch, n: self.write_batch(batch, n, path, f"{checkpoint}/kept")))
        w = w.trigger(availableNow=True) if available_now else w
        return w.start()

    def write_batch(self, batch: DataFrame, n: int, path: str, kept: str) -> None:
        spark = batch.sparkSession
        marks = {int(k): json.loads(v) for k, v in paths.marks(spark, f"{kept}/marks").items()}
        last = max((k for k in marks if k < n), default=None)
        before = marks[last] if last is not None else {"from": 0, "upto": [None, None], "loans": []}
        began = self.watermark(before["upto"])
        late, given = F.timestamp_millis(F.lit(before["from"])), F.timestamp_millis(F.lit(began))
        at = F.col(self.sent).cast("timestamp")
        lat = F.col("__lsent").cast("timestamp")

        known = self.read(spark, [f"{kept}/loans/{k}" for k in before["loans"]], self.known_schema).where(
            lat >= late - F.expr(f"INTERVAL {self.term}"))
        fold = len(before["loans"]) >= FOLD_EVERY
        came = batch.where("__row IS NULL").select("__lkey", "__lsent").where(lat > late)
        (came.unionByName(known) if fold else came).distinct().write.mode("overwrite").parquet(f"{kept}/loans/{n}")
        new = self.read(spark, [f"{kept}/loans/{n}"], self.known_schema)
        known = new if fold else known.unionByName(new)

        rows = batch.where("__row IS NOT NULL").select("__row.*").where(at > late)
        if last is not None:
            rows = rows.unionByName(self.read(spark, [f"{kept}/waiting/{last}"], self.schema).where(self.expires > given))
        self.unmatched(rows, known).write.mode("overwrite").parquet(f"{kept}/waiting/{n}")

        newest = [F.max(F.col("__row")[self.sent].cast("timestamp")), F.max(lat)]
        came_upto = batch.agg(*[F.unix_millis(t - F.expr(f"INTERVAL {self.delay}")) for t in newest]).first()
        upto = [max((t for t in two if t is not None), default=None) for two in zip(before["upto"], came_upto)]
        waited = self.read(spark, [f"{kept}/waiting/{n}"], self.schema).where(
            self.expires <= F.timestamp_millis(F.lit(self.watermark(upto))))
        waited.write.mode("overwrite").parquet(f"{path}/batch_id={n}")

        here = {"from": began, "upto": upto, "loans": [n] if fold else [*before["loans"], n]}
        paths.mark(spark, f"{kept}/marks", str(n), json.dumps(here))
        self.clean(spark, kept, {"marks": {last, n}, "waiting": {last, n}, "loans": {*before["loans"], *here["loans"]}})

    @staticmethod
    def watermark(upto: list[int | None]) -> int:
        """The time up to which both feeds are in, in ms; 1970 until both have begun."""
        return 0 if None in upto else max(0, min(upto))

    @property
    def expires(self):
        return F.col(self.sent).cast("timestamp") + F.expr(f"INTERVAL {self.wait}")

    def unmatched(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        """``rows`` that meet none of the loans ``known``."""
        p = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(self.salts)).cast("int"))
        copies = known.withColumn("__lsalt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
        same = (F.col(self.key) == F.col("__lkey")) & (F.col("__salt") == F.col("__lsalt"))
        near = ((F.col("__lsent") >= F.col(self.sent) - F.expr(f"INTERVAL {self.term}"))
                & (F.col("__lsent") <= F.col(self.sent) + F.expr(f"INTERVAL {self.wait}")))
        return p.join(copies.hint("merge"), same & near, "left_anti").drop("__salt")

    @staticmethod
    def read(spark: SparkSession, folders: list[str], schema) -> DataFrame:
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    @staticmethod
    def clean(spark: SparkSession, kept: str, needed: dict[str, set]) -> None:
        """Removes what neither this batch nor the one before it names."""
        for kind, names in needed.items():
            have = paths.marks(spark, f"{kept}/{kind}") if kind == "marks" else paths.folders(spark, f"{kept}/{kind}")
            for k in have:
                if int(k) not in names:
                    paths.delete(spark, f"{kept}/{kind}/{k}")
