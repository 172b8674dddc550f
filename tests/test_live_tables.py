"""Folding of live tables and keyed updates: results stay the same after any
number of batches, crashes and repeats."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.sinks import folding, paths
from ledgerlake.sinks.keyed import KeyedTable
from ledgerlake.sinks.writers import write_partitioned
from ledgerlake.streaming import queries as SQ

ROWS = "id long, year int, month int"


def add(spark, table, batch_id, rows):
    df = spark.createDataFrame(rows, ROWS).withColumn("batch_id", F.lit(batch_id).cast("long"))
    write_partitioned(df, table, ("year", "month", "batch_id"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_fold_keeps_rows_and_bounds_folders(spark, tmp_path):
    table = str(tmp_path / "t")
    for b in range(6):
        add(spark, table, b, [(10 * b + k, 2025, 1 + k % 2) for k in range(4)] + [(100 + b, None, None)])
    want = ids(folding.read(spark, table))
    assert len(want) == 30
    assert folding.fold(spark, table, before=5, least=4) == 3
    assert folding.batches(spark, table) == {"year=2025/month=1": [-1, 5], "year=2025/month=2": [-1, 5], "year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__": [-1, 5]}
    assert ids(folding.read(spark, table)) == want == ids(spark.read.parquet(table))
    assert folding.fold(spark, table, least=4) == 0
    # a folder that isn't small is left alone
    add(spark, table, 6, [(200, 2025, 1)])
    assert folding.fold(spark, table, least=2, small_bytes=1) == 0
    assert folding.fold(spark, table, least=3) == 1 and ids(folding.read(spark, table)) == want + [200]


@pytest.mark.parametrize("cut", ["mark", "clean"])
def test_fold_cut_off_at_any_point(spark, tmp_path, monkeypatch, cut):
    table = str(tmp_path / "t")
    for b in range(4):
        add(spark, table, b, [(b, 2025, 1), (10 + b, 2025, 2)])
    want = ids(folding.read(spark, table))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if cut == "mark":
            m.setattr(paths, "mark", lost)
        else:
            real, calls = folding.clean, []
            m.setattr(folding, "clean", lambda *a: calls.append(1) or (real(*a) if len(calls) == 1 else lost()))
        with pytest.raises(RuntimeError):
            folding.fold(spark, table, least=2)
    assert -1 in folding.batches(spark, table)["year=2025/month=1"]  # both lie there
    assert ids(folding.read(spark, table)) == want
    folding.fold(spark, table, least=2)
    assert ids(folding.read(spark, table)) == want == ids(spark.read.parquet(table))
    assert all(len(b) == 1 for b in folding.batches(spark, table).values())


def test_forty_batches_of_a_feed(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(40):
        value = {"transaction_id": f"TXN{i:010d}", "account_id": "ACC1", "type": "Nạp tiền", "currency": "VND", "amount": i, "date": f"2025-0{1 + i % 2}-03 10:00:00"}
        (src / f"{i:02d}.json").write_text(json.dumps({"key": "ACC1", "value": json.dumps(value)}) + "\n")
        os.utime(src / f"{i:02d}.json", (1000 + i, 1000 + i))
    stream = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1).json(str(src))
    table, ckpt = SQ.scratch(spark, "t_forty")
    SQ.run_to_end(SQ.ingest_feed(stream, "transaction", table, ckpt, fold_every=8, least=4))
    got = folding.read(spark, table)
    assert sorted(r.amount for r in got.collect()) == list(range(40))
    assert [len(b) for b in folding.batches(spark, table).values()] == [1, 2]  # batch 39 came after the last fold
    assert sum(name.endswith(".parquet") for _, _, names in os.walk(table) for name in names) <= 4


def newest(history):
    out = {}
    for n, rows in enumerate(history):
        for k, at, v in rows:
            if k not in out or (at, n) >= out[k][:2]:
                out[k] = (at, n, v)
    return {k: v for k, (_, _, v) in out.items()}


def test_keyed_updates(spark, tmp_path):
    rnd = random.Random(3)
    table = KeyedTable(spark, str(tmp_path / "t"), "k", ["at"], n_buckets=8)
    history = []
    for n in range(4):
        rows = [(f"k{k}", rnd.randint(0, 50) * 10 + n, f"{n}-{k}") for k in rnd.sample(range(200), 60)]
        history.append(rows + [(None, n, f"{n}-null")])
        table.update(spark.createDataFrame(history[-1] + [("k0", -1, "old")] * 50, "k string, at long, v string"), n)
        history[-1].append(("k0", -1, "old"))
        got = {r.k: r.v for r in table.read().collect()}
        assert got == newest(history) and table.read().count() == len(got)


def test_keyed_update_touches_its_buckets_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", ["at"], n_buckets=16)
    table.update(spark.range(400).select(F.col("id").alias("k"), F.lit(0).alias("at"), F.lit("a").alias("v")), 0)
    touched = table.update(spark.createDataFrame([(7, 1, "b"), (7, 2, "c"), (8, 0, "d")], "k long, at int, v string"), 1)
    assert 1 <= len(touched) <= 2
    assert {b: v[0] for b, v in table.versions().items()} == {b: int(b in touched) for b in range(16)}
    assert {r.k: r.v for r in table.read().where("v <> 'a'").collect()} == {7: "c", 8: "d"} and table.read().count() == 400
    assert table.update(spark.createDataFrame([], "k long, at int, v string"), 2) == [] and table.read().count() == 400


def test_keyed_update_cut_off_and_done_again(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", ["at"], n_buckets=4)
    rows = lambda v: spark.createDataFrame([(k, v, f"v{v}") for k in range(20)], "k long, at int, v string")
    table.update(rows(1), 0)
    with monkeypatch.context() as m:
        m.setattr(paths, "mark", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.update(rows(2), 1)
    assert {r.v for r in table.read().collect()} == {"v1"}  # the cut-off version isn't read
    table.update(rows(2), 1)
    table.update(rows(2), 1)
    assert {r.v for r in table.read().collect()} == {"v2"} and table.read().count() == 20
    table.update(rows(3), 2)
    assert all(v == [2, 1] for v in table.versions().values())  # older versions are gone
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), "k", ["at"], n_buckets=5).read()


def test_a_loan_sent_with_three_statuses(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    sent = [("LOA1", "Đang vay", "2025-01-01"), ("LOA1", "Quá hạn", "2025-03-01"), ("LOA1", 3, "2025-05-01"), ("LOA2", "Đang vay", "2025-02-01"), ("LOA1", "Đang vay", "2025-02-01")]
    for i, (loan, status, day) in enumerate(sent):
        value = {"loan_id": loan, "customer_id": "CUS1", "type": "Kinh doanh", "amount": 100, "currency": "VND", "interest_rate": 9.5, "term": 12, "start_date": "2025-01-01", "end_date": "2025-12-27", "status": status}
        (src / f"{i}.json").write_text(json.dumps({"key": "CUS1", "value": json.dumps(value), "sent_at": f"{day} 00:00:00"}) + "\n")
        os.utime(src / f"{i}.json", (1000 + i, 1000 + i))
    stream = spark.readStream.schema("key string, value string, sent_at string").option("maxFilesPerTrigger", 1).json(str(src))
    table, ckpt = SQ.scratch(spark, "t_loans")
    SQ.run_to_end(SQ.upsert_loans(stream, table, ckpt, n_buckets=4))
    got = KeyedTable(spark, table, "loan_id", ["sent_at"], 4).read()
    assert {(r.loan_id, r.status) for r in got.collect()} == {("LOA1", "Đã thanh toán"), ("LOA2", "Đang vay")} and got.count() == 2


def test_latest_balance_over_twelve_slices(spark, tmp_path):
    """W1 kept up to date: each month is read once and merged."""
    from ledgerlake.operators.latest import latest_by_rank
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 30), i, f"2025-{1 + i % 12:02d}-{rnd.randint(1, 28):02d}", i * 1.5) for i in range(600)]
    df = spark.createDataFrame(rows, "account long, id long, ts string, balance double")
    table = KeyedTable(spark, str(tmp_path / "t"), "account", ["ts", "id"], n_buckets=4)
    for month in range(12):
        table.update(df.where(F.substring("ts", 6, 2).cast("int") == month + 1), month)
        if month in (0, 5, 11):
            so_far = df.where(F.substring("ts", 6, 2).cast("int") <= month + 1)
            want = latest_by_rank(so_far, ["account"], ["ts", "id"])
            assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, want.collect()))
