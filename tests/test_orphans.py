"""J12 on streams: payments whose loan never comes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import quality
from ledgerlake.sinks import paths
from ledgerlake.streaming import orphans
from ledgerlake.streaming import queries as SQ

PAY, LOAN = "loan_id string, payment_id long, sent_at timestamp", "loan_id string, sent_at timestamp"
FAR = dt.datetime(2030, 1, 1)


def test_orphans_equal_the_batch_check(spark, tmp_path):
    """Payments before and after their loan, hot loans, null keys, over three
    deliveries; the far records carry the watermark past all others."""
    rnd = random.Random(8)
    start = dt.datetime(2025, 1, 1)
    loans = [(f"L{i}", start + dt.timedelta(hours=rnd.randint(0, 48))) for i in range(0, 40, 2)]
    at = dict(loans)
    payments = []
    for i in range(300):
        loan = None if i % 29 == 0 else "L0" if i % 3 == 0 else f"L{rnd.randint(0, 39)}"
        base = at.get(loan, start + dt.timedelta(hours=24))
        payments.append((loan, i, base + dt.timedelta(hours=rnd.randint(-5, 60))))
    late = ("L2", 900, at["L2"] - dt.timedelta(hours=20))      # sent too long before its loan
    old = ("L4", 901, at["L4"] + dt.timedelta(days=200))       # sent after the loan's term
    expected = {p[1] for p in payments if p[0] is not None and p[0] not in at}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        SQ.use_rocksdb_state(spark)
        out, ckpt = SQ.scratch(spark, "t_orphans")
        for k in range(3):
            more = [("far", -1, FAR), late, old] if k == 2 else []
            spark.createDataFrame(payments[k::3] + more, PAY).coalesce(1).write.mode("append").parquet(str(tmp_path / "p"))
            spark.createDataFrame(loans[k::3] + ([("far2", FAR)] if k == 2 else []), LOAN).coalesce(1).write.mode("append").parquet(str(tmp_path / "l"))
        read = lambda name, schema: spark.readStream.schema(schema).parquet(str(tmp_path / name))
        found = orphans.orphans(read("p", PAY), read("l", LOAN), "loan_id", "sent_at", wait="10 hours", term="100 days", salts=3)
        SQ.run_to_end(SQ.append_sink(found, out, ckpt))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = sorted(r.payment_id for r in spark.read.parquet(out).collect())
    assert got == sorted(expected | {900, 901})
    batch = quality.fk_orphans(spark.createDataFrame(payments, PAY), [("p->l", "loan_id", spark.createDataFrame(loans, LOAN).select(F.col("loan_id").alias("k")), "k")])
    assert batch.first().n_orphans == len(expected)


def hours(h):
    return dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)


def deliver(spark, root, rnd, n=6):
    """``n`` days of both feeds, a file a day; the last record of either carries the watermark past all others."""
    payments, loans = [], []
    for k in range(n):
        day = lambda: hours(24 * k + rnd.randint(0, 23))  # noqa: E731, B023
        p = [(f"L{rnd.randint(0, 30)}" if i % 9 else None, 100 * k + i // 2, day()) for i in range(40)] + [("L1", 100 * k + 99, None)]
        lo = [(f"L{rnd.randint(0, 30)}", day()) for _ in range(6)] + [("L0", hours(24 * k)), ("L0", hours(24 * k)), (None, day()), ("L2", None)]
        payments, loans = payments + p, loans + lo
        far = ([("far", -1, FAR)], [("far2", FAR)]) if k == n - 1 else ([], [])
        spark.createDataFrame(p + far[0], PAY).coalesce(1).write.mode("append").parquet(f"{root}/p")
        spark.createDataFrame(lo + far[1], LOAN).coalesce(1).write.mode("append").parquet(f"{root}/l")
    due = [(i, at) for key, i, at in payments if key is not None and at is not None and not any(
        key == k and t is not None and at - dt.timedelta(hours=50) <= t <= at + dt.timedelta(hours=10) for k, t in loans)]
    return sorted(due)


def start(spark, root, out, ckpt):
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
    return SQ.append_sink(orphans.orphans(read("p", PAY), read("l", LOAN), "loan_id", "sent_at", wait="10 hours", term="50 hours",
                                          delay="1 day", salts=2), out, ckpt)


def written(spark, out):
    return sorted((r.payment_id, r.sent_at) for r in spark.read.parquet(out).collect())


def test_no_row_is_an_entry_of_a_state_store(spark, tmp_path, monkeypatch):
    """Rows of both feeds are kept in files over the batches, and no longer than they are needed."""
    monkeypatch.setattr(orphans, "FOLD_EVERY", 2, raising=False)
    due = deliver(spark, tmp_path, random.Random(3))
    out, ckpt = SQ.scratch(spark, "t_orphans_kept")
    q = start(spark, tmp_path, out, ckpt)
    SQ.run_to_end(q)
    assert written(spark, out) == due and len(due) > 20
    assert not q.lastProgress["stateOperators"] and not paths.folders(spark, f"{ckpt}/state")
    assert paths.folders(spark, f"{ckpt}/kept/waiting") == sorted(paths.marks(spark, f"{ckpt}/kept/marks")) == ["4", "5"]
    held = spark.read.schema("__lkey string, __lsent timestamp").parquet(*[f"{ckpt}/kept/loans/{k}" for k in paths.folders(spark, f"{ckpt}/kept/loans")])
    assert len(paths.folders(spark, f"{ckpt}/kept/loans")) <= 4 and held.agg(F.min("__lsent")).first()[0] >= hours(24 * 2 - 50)


@pytest.mark.parametrize("cut", [0, 3, 5])
def test_a_batch_cut_off_is_done_again(spark, tmp_path, monkeypatch, cut):
    """A batch that fails after it has written all but its mark gives the same rows when it is done again."""
    due = deliver(spark, tmp_path, random.Random(4))
    out, ckpt = SQ.scratch(spark, "t_orphans_cut")
    real = paths.mark

    def lost(spark, folder, name, text):
        if name == str(cut):
            raise RuntimeError("lost")
        real(spark, folder, name, text)

    with monkeypatch.context() as m:
        m.setattr(paths, "mark", lost)
        with pytest.raises(Exception, match="lost"):
            SQ.run_to_end(start(spark, tmp_path, out, ckpt))
    SQ.run_to_end(start(spark, tmp_path, out, ckpt))
    assert written(spark, out) == due


def test_rows_after_the_watermark_are_dropped(spark, tmp_path):
    """Payments and loans of a time that both feeds had passed before the last delivery began."""
    days = [([("A", 1, hours(0)), ("B", 2, hours(100)), ("C", 3, hours(100))], [("Z", hours(100))]),
            ([("D", 4, hours(70)), ("E", 5, hours(80))], [("B", hours(70)), ("C", hours(80)), ("E", hours(79))]),
            ([("F", 6, hours(76)), ("G", 7, hours(77)), ("far", 8, FAR)], [("D", hours(71)), ("far2", FAR)])]
    for p, lo in days:
        spark.createDataFrame(p, PAY).coalesce(1).write.mode("append").parquet(f"{tmp_path}/p")
        spark.createDataFrame(lo, LOAN).coalesce(1).write.mode("append").parquet(f"{tmp_path}/l")
    out, ckpt = SQ.scratch(spark, "t_orphans_late")
    SQ.run_to_end(start(spark, tmp_path, out, ckpt))
    assert [i for i, _ in written(spark, out)] == [1, 4, 7]
