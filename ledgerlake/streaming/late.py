"""R2 with late events: balances after every event that are corrected when
an earlier event arrives.

Time is cut into slots, and an account's events of a slot are an ordered
entry of its state.  An arriving event takes its place among them, and the
balances from there to the end of the slot are given out anew; what lies in
later slots is left alone, since a row carries its running sum *within its
slot* and the slot's total is given out beside it.  ``balances`` puts the
newest rows together: opening balance + totals of the account's earlier
slots + running sum.  So an event that is days late rewrites one slot of one
account, in state and in output.

State is keyed by (account, bucket of slots): a busy account's events are
dealt over tasks by time.  A bucket of few events is one entry, read and
written once a batch; one that outgrows ``PACKED`` events has an entry a slot,
so that ``slot_seconds`` bounds what one entry holds.
A timer settles a bucket that has been quiet: its entries shrink to the
slots' totals.  An event that comes even later is not lost: it is given out
without a running sum, and ``balances`` works its slot out from the rows.
No watermark is used, as that would drop rows.

Events must be delivered once (see ``dedup_sink``) and be told apart by
(account, time, id).  A NULL account is an account of its own; events
without a time come first; a NULL amount counts as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ledgerlake.streaming.queries import use_rocksdb_state

#: Slot and bucket of events without a time: before all others.
NO_TIME = -(1 << 62)

#: Events that a bucket holds in one entry at most; each call to the state
#: store costs more than the handling of an event.
PACKED = 512

CHANGE = Row("account", "slot", "at", "id", "amount", "running", "total")


class SlotBalances(StatefulProcessor):
    """Running sums within slots, for one (account, bucket) key."""

    def __init__(self, id_type: str, settle_ms: int | None):
        self.id_type, self.settle_ms = id_type, settle_ms

    def init(self, handle) -> None:
        self.handle = handle
        events = f"at array<long>, id array<{self.id_type}>, amount array<long>"
        self.packed = handle.getValueState("packed", f"slot array<long>, {events}")
        self.open = handle.getMapState("open", "slot long", events)
        self.settled = handle.getMapState("settled", "slot long", "total long")

    @staticmethod
    def place(event) -> tuple:
        at, ident, _ = event
        return (at is not None, at or 0, ident is not None, ident if ident is not None else 0)

    def handleInputRows(self, key, rows, timerValues):
        arrived: dict[int, list] = {}
        for r in rows:
            arrived.setdefault(r["slot"], []).append((r["at"], r["id"], r["amount"]))
        settled = self.settle_ms is not None and self.settled.exists()
        packed = self.packed.get()
        if packed is None and self.open.exists():
            for slot in sorted(arrived):
                total = self.settled.getValue((slot,)) if settled else None
                if total is not None:
                    yield from self.reopened(key, slot, arrived[slot], total[0])
                    continue
                have = self.open.getValue((slot,))
                events, changes = self.merged(key, slot, list(zip(*have)) if have is not None else [], arrived[slot])
                yield from changes
                self.put(slot, events)
        else:
            held: dict[int, list] = {}
            for slot, *event in zip(*packed) if packed is not None else ():
                held.setdefault(slot, []).append(tuple(event))
            for slot in sorted(arrived):
                total = self.settled.getValue((slot,)) if settled else None
                if total is not None:
                    yield from self.reopened(key, slot, arrived[slot], total[0])
                    continue
                held[slot], changes = self.merged(key, slot, held.get(slot, []), arrived[slot])
                yield from changes
            self.keep(held, packed is not None)
        if self.settle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.settle_ms)

    def put(self, slot: int, events: list) -> None:
        self.open.updateValue((slot,), tuple(map(list, zip(*events))))

    def keep(self, held: dict[int, list], was_packed: bool) -> None:
        """The bucket's events as one entry, or an entry a slot if they are many."""
        flat = [(slot, *event) for slot, events in held.items() for event in events]
        if len(flat) > PACKED:
            for slot, events in held.items():
                self.put(slot, events)
            if was_packed:
                self.packed.clear()
        elif flat:
            self.packed.update(tuple(map(list, zip(*flat))))

    def reopened(self, key, slot: int, new: list, total: int):
        """Events of a slot that has settled: its total changes, their running sums are left to ``balances``."""
        for at, ident, amount in new:
            yield CHANGE(key[0], slot, at, ident, amount, None, None)
        total += sum(e[2] for e in new)
        self.settled.updateValue((slot,), (total,))
        yield CHANGE(key[0], slot, None, None, None, None, total)

    def merged(self, key, slot: int, have: list, new: list) -> tuple[list, list]:
        """The slot's events in order, and its changes from the first new one on."""
        events = sorted([*have, *new], key=self.place)
        first = min(map(self.place, new))
        total, changes = 0, []
        for event in events:
            at, ident, amount = event
            total += amount
            if changes or self.place(event) >= first:
                changes.append(CHANGE(key[0], slot, at, ident, amount, total, None))
        changes.append(CHANGE(key[0], slot, None, None, None, None, total))
        return events, changes

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """The bucket has been quiet: its entries become totals."""
        totals: dict[int, int] = {}
        for slot, _, _, amount in zip(*(self.packed.get() or ())):
            totals[slot] = totals.get(slot, 0) + amount
        for slot, total in totals.items():
            self.settled.updateValue((slot,), (total,))
        self.packed.clear()
        for (slot,), (_, _, amounts) in list(self.open.iterator()):
            self.settled.updateValue((slot,), (sum(amounts),))
            self.open.removeKey((slot,))
        return iter([])


def slot_balances(stream: DataFrame, key: str, time: str, id: str, amount: str, slot_seconds: int = 86_400,
                  slots_in_bucket: int = 7, settle_ms: int | None = None) -> DataFrame:
    """Change rows (account, slot, at, id, amount, running, total): an event's
    newest running sum within its slot, or (``total`` set) a slot's newest
    total.  ``amount`` is a whole number."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = stream.select(F.col(key).alias("account"), at.alias("at"), F.col(id).alias("id"),
                         F.coalesce(F.col(amount).cast("long"), F.lit(0).cast("long")).alias("amount"))
    slot = F.coalesce(F.floor(F.col("at") / (slot_seconds * 1_000_000)), F.lit(NO_TIME)).cast("long")
    rows = rows.withColumn("slot", slot).withColumn("bucket", F.floor(F.col("slot") / slots_in_bucket).cast("long"))
    types = {f.name: f.dataType for f in rows.schema.fields}
    out = T.StructType([T.StructField("account", types["account"]), T.StructField("slot", T.LongType()),
                        T.StructField("at", T.LongType()), T.StructField("id", types["id"]), T.StructField("amount", T.LongType()),
                        T.StructField("running", T.LongType()), T.StructField("total", T.LongType())])
    mode = "None" if settle_ms is None else "processingTime"
    processor = SlotBalances(types["id"].simpleString(), settle_ms)
    return rows.groupBy("account", "bucket").transformWithState(processor, out, "Update", mode)


def late_balance_sink(stream: DataFrame, key: str, time: str, id: str, amount: str, path: str, checkpoint: str,
                      available_now: bool = True, **slots):
    """Writes the change rows of each batch to ``path/batch_id=n``; a replayed
    batch overwrites its own folder.  With ``settle_ms`` a drained source is
    no end, since timers ask for one more batch for ever; ``available_now``
    then takes in what is there as one batch."""
    use_rocksdb_state(stream.sparkSession)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = (slot_balances(stream, key, time, id, amount, **slots).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(write_batch))
    if available_now:
        w = w.trigger(availableNow=True) if slots.get("settle_ms") is None else w.trigger(once=True)
    return w.start()


def balances(spark: SparkSession, path: str, opening: DataFrame, opening_key: str, opening_balance: str) -> DataFrame:
    """account, at (microseconds), id, amount, balance_after of every event so
    far: what W4 gives over the whole history.

    The newest version of a row is a partial aggregate.  Totals are one row
    per account and slot, so the window over an account's slots stays small
    however many events it has.  Only slots reopened after they had settled
    are summed again from their rows."""
    log = spark.read.parquet(path)
    newest = F.max(F.struct("batch_id", "amount", "running")).alias("v")
    rows = (log.where("total IS NULL").groupBy("account", "slot", "at", "id").agg(newest)
            .select("account", "slot", "at", "id", "v.amount", "v.running"))
    totals = (log.where("total IS NOT NULL").groupBy("account", "slot").agg(F.max(F.struct("batch_id", "total")).alias("v"))
              .select("account", "slot", "v.total"))
    earlier = Window.partitionBy("account").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("account").alias("__a"), F.col("slot").alias("__s"),
                            F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("__before"))
    again = rows.where("running IS NULL").select(F.col("account").alias("__a"), F.col("slot").alias("__s")).distinct()
    reopened = F.col("account").eqNullSafe(F.col("__a")) & (F.col("slot") == F.col("__s"))
    within = Window.partitionBy("account", "slot").orderBy(F.col("at").asc_nulls_first(), F.col("id").asc_nulls_first())
    summed = rows.join(again, reopened, "left_semi").withColumn("running", F.sum("amount").over(within))
    rows = rows.join(again, reopened, "left_anti").unionByName(summed)
    first = opening.select(F.col(opening_key).alias("__o"), F.col(opening_balance).alias("__open"))
    out = rows.join(offsets, F.col("account").eqNullSafe(F.col("__a")) & (F.col("slot") == F.col("__s")))
    out = out.join(first, F.col("account") == F.col("__o"), "left")
    balance = F.coalesce("__open", F.lit(0)) + F.col("__before") + F.col("running")
    return out.select("account", "at", "id", "amount", balance.cast("long").alias("balance_after"))
