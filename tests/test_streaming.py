"""Streams over JSON record files: late events, replays, status '3',
stream = batch."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.streaming import feeds
from ledgerlake.streaming import queries as SQ

RAW = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def _write_records(folder, name, recs, key):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        for r in recs:
            fh.write(json.dumps({"key": r[key], "value": json.dumps(r, ensure_ascii=False)},
                                ensure_ascii=False) + "\n")


def _tx(i, acc, date, amount, typ="Gửi tiền"):
    return {"transaction_id": f"TXN{i:010d}", "account_id": acc, "employee_id": "EMP0000001",
            "type": typ, "currency": "VND", "date": date, "amount": amount}


def test_latest_balance_stream_ignores_late_older_event(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_records(src, "a.json", [_tx(1, "ACC1", "2025-06-04 10:00:00", 100),
                                   _tx(2, "ACC1", "2025-06-04 12:00:00", 200),
                                   _tx(3, "ACC2", "2025-06-04 09:00:00", 50)], "account_id")
    _write_records(src, "b.json", [_tx(4, "ACC1", "2025-06-03 08:00:00", 999)], "account_id")  # late
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(src)
    tx = feeds.typed_transactions(feeds.parse_feed(stream, "transaction"))
    agg = SQ.latest_per_key(tx, "account_id", ["timestamp", "transaction_id"], ["amount"])
    out, ck = SQ.scratch(spark, "t_latest")
    SQ.run_to_end(SQ.changelog_sink(agg, out, ck))
    got = {r["account_id"]: r["amount"] for r in SQ.current_view(spark, out, "account_id").collect()}
    assert got == {"ACC1": 200, "ACC2": 50}
    # stream = batch
    batch = feeds.typed_transactions(feeds.parse_feed(spark.read.schema(RAW).json(src), "transaction"))
    from ledgerlake.operators.latest import latest_by_rank
    b = {r["account_id"]: r["amount"] for r in
         latest_by_rank(batch, ["account_id"], ["timestamp", "transaction_id"]).collect()}
    assert b == got


def test_running_totals_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_records(src, "a.json", [_tx(1, "ACC1", "2025-06-04 10:00:00", 100),
                                   _tx(2, "ACC1", "2025-06-04 12:00:00", -30)], "account_id")
    _write_records(src, "b.json", [_tx(3, "ACC1", "2025-06-05 10:00:00", 5)], "account_id")
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(src)
    tx = feeds.parse_feed(stream, "transaction")
    out, ck = SQ.scratch(spark, "t_run")
    SQ.run_to_end(SQ.changelog_sink(SQ.running_totals(tx, "account_id", "amount"), out, ck))
    r = SQ.current_view(spark, out, "account_id").first()
    assert (r["total"], r["n_events"]) == (75, 3)
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 2


def test_replays_dropped_but_distinct_records_with_same_id_kept(spark, tmp_path):
    src = str(tmp_path / "in")
    p1 = {"payment_id": "PAY0000001", "loan_id": "LOA1", "transaction_id": "TXN1",
          "payment_amount": 10, "scheduled_payment_date": "2025-06-01", "payment_date": "2025-06-02",
          "principal_amount": 7, "paid_amount": 10, "paid_date": "2025-06-02"}
    p2 = dict(p1, loan_id="LOA2")   # same payment_id, different payment (D11)
    _write_records(src, "a.json", [p1, p2, p1], "loan_id")
    stream = spark.readStream.schema(RAW).json(src)
    parsed = feeds.typed_payments(feeds.parse_feed(stream, "loan_payment"))
    ev = parsed.withColumn("event_time", F.col("paid_date").cast("timestamp"))
    d = SQ.drop_replays(ev, "event_time", "1 day")
    out, ck = SQ.scratch(spark, "t_dedup")
    SQ.run_to_end(SQ.append_sink(d, out, ck))
    assert sorted(r["loan_id"] for r in spark.read.parquet(out).collect()) == ["LOA1", "LOA2"]


def test_loan_feed_status_three_and_ingest(spark, tmp_path):
    src = str(tmp_path / "in")
    recs = [{"loan_id": "LOA1", "customer_id": "CUS1", "type": "Kinh doanh", "amount": 100,
             "currency": "VND", "interest_rate": 9.5, "term": 12, "start_date": "2025-01-01",
             "end_date": "2025-12-27", "status": 3},
            {"loan_id": "LOA2", "customer_id": "CUS2", "type": "Kinh doanh", "amount": 100,
             "currency": "VND", "interest_rate": 9.5, "term": 12, "start_date": "2025-01-01",
             "end_date": "2025-12-27", "status": "Quá hạn"}]
    _write_records(src, "a.json", recs, "customer_id")
    stream = spark.readStream.schema(RAW).json(src)
    table, ck = SQ.scratch(spark, "t_ingest")
    SQ.run_to_end(SQ.ingest_feed(stream, "loan", table, ck))
    t = spark.read.parquet(table)
    got = {r["loan_id"]: (r["status"], r["start_date"]) for r in t.collect()}
    assert got == {"LOA1": ("Đã thanh toán", dt.date(2025, 1, 1)), "LOA2": ("Quá hạn", dt.date(2025, 1, 1))}
    from ledgerlake import schemas as S
    assert [c for c in t.columns if c not in ("year", "month", "batch_id")] == S.DIM_LOANS.fieldNames()


def test_transaction_feed_into_fact_partitions_and_replay_is_idempotent(spark, tmp_path):
    from ledgerlake import schemas as S
    src = str(tmp_path / "in")
    _write_records(src, "a.json", [_tx(1, "ACC1", "2025-05-31 23:59:59", 100),
                                   _tx(2, "ACC1", "2025-06-01 00:00:01", -20, "Rút tiền")], "account_id")
    stream = spark.readStream.schema(RAW).json(src)
    table, ck = SQ.scratch(spark, "t_fact")
    SQ.run_to_end(SQ.ingest_feed(stream, "transaction", table, ck))
    f = spark.read.parquet(table)
    assert [c for c in f.columns if c not in ("year", "month", "batch_id")] == S.FACT_TRANSACTIONS.fieldNames()
    assert sorted((r["date_id"], r["month"]) for r in f.collect()) == [(20250531, 5), (20250601, 6)]
    # replaying the same batch id rewrites its own partitions only
    from ledgerlake.sinks.writers import write_partitioned
    again = spark.createDataFrame(f.where("batch_id = 0").collect(), f.schema)   # the same batch, re-sent
    write_partitioned(again, table, ("year", "month", "batch_id"))
    assert spark.read.parquet(table).count() == 2


def test_envelope_round_trip_and_key_partitioning(spark):
    df = spark.createDataFrame([("ACC1", 5, dt.datetime(2025, 6, 4, 9, 15))],
                               "account_id string, amount long, date timestamp")
    env = feeds.envelope(df, "account_id", num_partitions=2).first()
    assert env["key"] == "ACC1"
    assert json.loads(env["value"]) == {"account_id": "ACC1", "amount": 5, "date": "2025-06-04T09:15:00"}


def test_running_totals_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    recs = [_tx(i, f"ACC{i % 4}", f"2025-06-0{1 + i % 5} 10:00:00", (i * 37) % 101 - 50) for i in range(40)]
    for j in range(4):
        _write_records(src, f"p{j}.json", recs[j * 10:(j + 1) * 10], "account_id")
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(src)
    out, ck = SQ.scratch(spark, "t_eq")
    SQ.run_to_end(SQ.changelog_sink(SQ.running_totals(feeds.parse_feed(stream, "transaction"),
                                                      "account_id", "amount"), out, ck))
    got = {r["account_id"]: r["total"] for r in SQ.current_view(spark, out, "account_id").collect()}
    batch = feeds.parse_feed(spark.read.schema(RAW).json(src), "transaction")
    want = {r[0]: r[1] for r in batch.groupBy("account_id").agg(F.sum("amount")).collect()}
    assert got == want


def test_dedup_sink_across_batches_and_hot_copies(spark, tmp_path):
    src = str(tmp_path / "in")
    hot = _tx(1, "ACC1", "2025-06-04 10:00:00", 100)
    _write_records(src, "a.json", [hot] * 300 + [_tx(2, "ACC2", "2025-06-04 10:01:00", 5)], "account_id")
    _write_records(src, "b.json", [hot] * 200 + [_tx(3, "ACC3", "2025-06-04 10:02:00", 7)], "account_id")
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(src)
    tx = feeds.typed_transactions(feeds.parse_feed(stream, "transaction"))
    out, ck = SQ.scratch(spark, "t_dedup_sink")
    SQ.run_to_end(SQ.dedup_sink(tx, out, ck, "timestamp", 600))
    got = sorted(r["transaction_id"] for r in spark.read.parquet(out).collect())
    assert got == ["TXN0000000001", "TXN0000000002", "TXN0000000003"]


def test_state_partitions_fixed_at_start(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_records(src, "a.json", [_tx(1, "ACC1", "2025-06-04 10:00:00", 100)], "account_id")
    stream = spark.readStream.schema(RAW).json(src)
    out, ck = SQ.scratch(spark, "t_parts")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with SQ.state_partitions(spark, 3):
        q = SQ.changelog_sink(SQ.running_totals(feeds.parse_feed(stream, "transaction"),
                                                "account_id", "amount"), out, ck)
        SQ.run_to_end(q)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert sorted(d for d in os.listdir(os.path.join(ck, "state", "0")) if d.isdigit()) == ["0", "1", "2"]


def test_malformed_records_do_not_stop_the_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    os.makedirs(src)
    good = _tx(1, "ACC1", "2025-06-04 10:00:00", 100)
    with open(os.path.join(src, "a.json"), "w", encoding="utf-8") as fh:
        fh.write(json.dumps({"key": "ACC1", "value": json.dumps(good)}) + "\n")
        fh.write(json.dumps({"key": "ACC2", "value": json.dumps(dict(good, transaction_id="T2", date="04/06/2025"))}) + "\n")
        fh.write(json.dumps({"key": "ACC3", "value": "{not json"}) + "\n")
    stream = spark.readStream.schema(RAW).json(src)
    table, ck = SQ.scratch(spark, "t_bad")
    SQ.run_to_end(SQ.ingest_feed(stream, "transaction", table, ck))
    rows = {r["transaction_id"]: r["timestamp"] for r in spark.read.parquet(table).collect()}
    assert rows["TXN0000000001"] == dt.datetime(2025, 6, 4, 10, 0)
    assert rows["T2"] is None


def test_balance_after_per_event_across_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    recs = [_tx(i, f"ACC{i % 3}", f"2025-06-0{1 + i // 10} {10 + i % 10}:00:00", (i * 13) % 40 - 20)
            for i in range(40)]
    for j in range(4):
        _write_records(src, f"p{j}.json", recs[j * 10:(j + 1) * 10], "account_id")
    opening = spark.createDataFrame([("ACC0", 1000), ("ACC1", 500)], "acc string, bal long")
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(src)
    tx = feeds.typed_transactions(feeds.parse_feed(stream, "transaction"))
    out, ck = SQ.scratch(spark, "t_balance")
    SQ.run_to_end(SQ.balance_after_sink(tx, "account_id", ["timestamp", "transaction_id"], "amount",
                                        opening, "acc", "bal", out, ck))
    rows = spark.read.parquet(out + "/rows").collect()
    got = {r["transaction_id"]: r["balance_after"] for r in rows}
    # arrival order across micro-batches, event order within one
    arrival = {r["transaction_id"]: r["batch_id"] for r in rows}
    want, tot = {}, {"ACC0": 1000, "ACC1": 500, "ACC2": 0}
    for r in sorted(recs, key=lambda r: (arrival[r["transaction_id"]], r["date"], r["transaction_id"])):
        tot[r["account_id"]] += r["amount"]
        want[r["transaction_id"]] = tot[r["account_id"]]
    assert got == want
    assert spark.read.parquet(out + "/rows").select("batch_id").distinct().count() == 4


def test_enrich_with_persisted_static_dimension(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_records(src, "a.json", [_tx(1, "ACC1", "2025-06-04 10:00:00", 100),
                                   _tx(2, "ACC9", "2025-06-04 11:00:00", 5)], "account_id")
    stream = feeds.parse_feed(spark.readStream.schema(RAW).json(src), "transaction")
    dim = spark.createDataFrame([("ACC1", "BRA0000001")], "account_id string, branch_id string")
    out, ck = SQ.scratch(spark, "t_enrich")
    SQ.run_to_end(SQ.append_sink(SQ.enrich(stream, [(dim, "account_id", False)], persist_static=True),
                                 out, ck))
    assert [(r["transaction_id"], r["branch_id"]) for r in spark.read.parquet(out).collect()] == [
        ("TXN0000000001", "BRA0000001")]


def test_replayed_records_without_a_time_are_dropped(spark, tmp_path):
    src = str(tmp_path / "in")
    recs = [_tx(1, "ACC1", "not a date", 10), _tx(2, "ACC1", "2025-06-04 12:00:00", 20)]
    for name in ("a.json", "b.json", "c.json"):
        _write_records(src, name, recs, "account_id")
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(src)
    tx = feeds.typed_transactions(feeds.parse_feed(stream, "transaction"))
    out, ck = SQ.scratch(spark, "t_null_time")
    SQ.run_to_end(SQ.dedup_sink(tx, out, ck, "timestamp"))
    assert sorted(r["transaction_id"] for r in spark.read.parquet(out).collect()) == ["TXN0000000001", "TXN0000000002"]


def _balances(spark, src, name, opening, **more):
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).json(src)
    tx = feeds.typed_transactions(feeds.parse_feed(stream, "transaction"))
    out, ck = SQ.scratch(spark, name)
    SQ.run_to_end(SQ.balance_after_sink(tx, "account_id", ["timestamp", "transaction_id"], "amount", opening, "acc", "bal", out, ck, **more))
    return out


def test_balances_over_many_batches_keep_null_keys_and_times(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SQ, "FOLD_EVERY", 2)
    monkeypatch.setattr(SQ.carried_totals, "__defaults__", (2,))
    src = str(tmp_path / "in")
    for i in range(7):
        recs = [_tx(10 * i + 1, "ACC1", f"2025-06-0{i + 1} 12:00:00", 10), _tx(10 * i + 2, "ACC1", "no date", 5), _tx(10 * i + 3, None, f"2025-06-0{i + 1} 12:00:00", 1)]
        _write_records(src, f"{i}.json", recs, "account_id")
        os.utime(os.path.join(src, f"{i}.json"), (1000 + i, 1000 + i))
    opening = spark.createDataFrame([("ACC1", 1000)], "acc string, bal long")
    out = _balances(spark, src, "t_many", opening)
    got = {r["transaction_id"]: r["balance_after"] for r in spark.read.parquet(f"{out}/rows").collect()}
    want = {}
    for i in range(7):
        want |= {f"TXN{10 * i + 2:010d}": 1000 + 15 * i + 5, f"TXN{10 * i + 1:010d}": 1000 + 15 * i + 15, f"TXN{10 * i + 3:010d}": i + 1}
    assert got == want
    assert sorted(os.listdir(f"{out}/totals/folded")) == ["upto=2", "upto=4", "upto=6"]


def test_unreadable_totals_stop_the_stream(spark, tmp_path):
    import pytest
    src = str(tmp_path / "in")
    _write_records(src, "a.json", [_tx(1, "ACC1", "2025-06-04 12:00:00", 10)], "account_id")
    opening = spark.createDataFrame([("ACC1", 1000)], "acc string, bal long")
    out = _balances(spark, src, "t_bad", opening)
    for f in os.listdir(f"{out}/totals/batch_id=0"):
        if f.startswith("part-"):
            with open(f"{out}/totals/batch_id=0/{f}", "wb") as fh:
                fh.write(b"not parquet")
    with pytest.raises(Exception):
        SQ.carried_totals(spark, f"{out}/totals", 1, "account_id", "account_id string, total long").collect()
