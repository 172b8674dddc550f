"""R2 with late events against the running sum over the whole history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.streaming import late
from ledgerlake.streaming import queries as SQ

SCHEMA = "account string, ts timestamp, id long, amount long"


def deliver(spark, folder, batch):
    spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, out, ckpt, **more):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    with SQ.state_partitions(spark, 1):
        SQ.run_to_end(late.late_balance_sink(stream, "account", "ts", "id", "amount", out, ckpt, **more))


def history(events, opening):
    """Opening balance and running sum in event order."""
    out, total = {}, {}
    for a, ts, i, x in sorted(events, key=lambda e: (e[1] is not None, e[1] or dt.datetime.min, e[2])):
        total[a] = total.get(a, opening.get(a, 0)) + (x or 0)
        out[a, i] = total[a]
    return out


def shown(spark, out, opening):
    first = spark.createDataFrame(sorted(opening.items()), "acc string, bal long")
    rows = late.balances(spark, out, first, "acc", "bal").collect()
    assert len(rows) == len({(r.account, r.id) for r in rows})
    return {(r.account, r.id): r.balance_after for r in rows}


def some_events(n, rnd):
    start = dt.datetime(2025, 6, 1)
    events = [(rnd.choice(["A", "A", "B", "C", None]), start + dt.timedelta(hours=rnd.randint(0, 400)), i, rnd.randint(-50, 60)) for i in range(n)]
    return events + [("A", None, n, 7), ("A", None, n + 1, None), ("B", start, n + 2, None)]


@pytest.mark.parametrize("settle_ms", [None, 0])
def test_three_batches_with_late_events(spark, tmp_path, settle_ms):
    """Batches in any time order; with a settle time of 0 every slot has
    settled before the next batch, so late events reopen it."""
    folder, (out, ckpt) = str(tmp_path / "in"), SQ.scratch(spark, "t_late")
    events = some_events(120, random.Random(1))
    opening = {"A": 1000, "B": -5}
    for k in range(3):
        deliver(spark, folder, events[k::3])
        run(spark, folder, out, ckpt, slots_in_bucket=3, settle_ms=settle_ms)
        have = [e for j in range(k + 1) for e in events[j::3]]
        assert shown(spark, out, opening) == history(have, opening)
    reopened = spark.read.parquet(out).where("running IS NULL AND total IS NULL").count()
    assert (reopened > 0) == (settle_ms == 0)


def test_a_late_event_rewrites_its_slot_only(spark, tmp_path):
    folder, (out, ckpt) = str(tmp_path / "in"), SQ.scratch(spark, "t_late_slot")
    day = lambda d, h: dt.datetime(2025, 6, d, h)
    first = [("A", day(d, h), 10 * d + h, 1) for d in (1, 2, 3) for h in (1, 5, 9)]
    deliver(spark, folder, first)
    run(spark, folder, out, ckpt)
    deliver(spark, folder, [("A", day(1, 4), 99, 100)])
    run(spark, folder, out, ckpt)
    changed = spark.read.parquet(out).where("batch_id = 1 AND total IS NULL")
    assert sorted((r.id, r.running) for r in changed.collect()) == [(15, 102), (19, 103), (99, 101)]
    assert shown(spark, out, {})[("A", 39)] == 109


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The state of a batch is committed with its checkpoint: a sink that
    fails after its write gets the same rows again."""
    folder, (out, ckpt) = str(tmp_path / "in"), SQ.scratch(spark, "t_late_replay")
    events = some_events(60, random.Random(2))
    deliver(spark, folder, events[::2])
    run(spark, folder, out, ckpt)
    deliver(spark, folder, events[1::2])
    calls = []

    def fails_once(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("lost after the write")

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    start = lambda: late.slot_balances(stream, "account", "ts", "id", "amount").writeStream.outputMode("update").option("checkpointLocation", ckpt).foreachBatch(fails_once).trigger(availableNow=True).start()
    with pytest.raises(Exception), SQ.state_partitions(spark, 1):
        SQ.run_to_end(start())
    with SQ.state_partitions(spark, 1):
        SQ.run_to_end(start())
    assert calls == [1, 1] and shown(spark, out, {"A": 3}) == history(events, {"A": 3})
