"""The job entry points end to end (documents in and out, latest balance)."""

import json
import os

from ledgerlake import jobs
from ledgerlake import schemas as S
from ledgerlake.sinks.writers import write_documents
from ledgerlake.streaming import queries as SQ
from tests.fixtures import customer360_sample as FX


def test_customer360_job_from_document_files(spark, tmp_path):
    docs = tmp_path / "docs"
    for name, rows in [("customers", FX.CUSTOMERS), ("accounts", FX.ACCOUNTS), ("cards", FX.CARDS),
                       ("loans", FX.LOANS), ("transactions", FX.TRANSACTIONS), ("analytics", FX.ANALYTICS)]:
        write_documents(spark.createDataFrame(rows, S.DOCUMENTS[name]), str(docs / name))
    out = tmp_path / "one"
    jobs.main(["customer360", "--docs", str(docs), "--out", str(out), "--customer-id", FX.CUSTOMER_ID])
    lines = [json.loads(x) for x in spark.read.text(str(out)).collect()[0][0].splitlines()]
    assert lines == [FX.EXPECTED]
    allout = tmp_path / "all"
    jobs.main(["customer360", "--docs", str(docs), "--out", str(allout)])
    d = spark.read.json(str(allout / "documents")).first()
    assert d["_id"] == FX.CUSTOMER_ID and "transactions" not in d.asDict()
    assert spark.read.json(str(allout / "transactions")).count() == 3


def test_latest_balance_job_and_compaction(spark, tmp_path):
    import datetime as dt
    facts = spark.createDataFrame(
        [("A", "T1", dt.datetime(2025, 1, 1), 10), ("A", "T2", dt.datetime(2025, 1, 2), 20),
         ("B", "T3", dt.datetime(2025, 1, 1), 5)],
        "account_id string, transaction_id string, timestamp timestamp, balance_after long")
    src = tmp_path / "facts"
    facts.write.parquet(str(src))
    jobs.main(["latest-balance", "--facts", str(src), "--out", str(tmp_path / "lb")])
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "lb")).collect()}
    assert got == {"A": 20, "B": 5}
    log = tmp_path / "log"
    facts.select("account_id", "balance_after").write.parquet(str(log / "batch_id=0"))
    facts.where("account_id = 'A'").selectExpr("account_id", "balance_after + 1 AS balance_after") \
        .write.parquet(str(log / "batch_id=1"))
    snap = SQ.compact_changelog(spark, str(log), "account_id", str(tmp_path / "snap"))
    view = {r[0]: r[1] for r in SQ.current_view(spark, snap, "account_id").collect()}
    assert view["B"] == 5 and view["A"] in (11, 21)


def test_landing_star_and_ingest_jobs(spark, tmp_path):
    from tests.test_landing_star import CSV
    src = tmp_path / "csv"
    src.mkdir()
    for name, lines in CSV.items():
        (src / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    jobs.main(["landing", "--csv", str(src), "--out", str(tmp_path / "landing")])
    jobs.main(["star", "--landing", str(tmp_path / "landing"), "--out", str(tmp_path / "star"),
               "--as-of", "2025-06-05", "--audit-ts", "2025-06-05 00:33:00"])
    assert spark.read.parquet(str(tmp_path / "star" / "fact_transactions")).count() == 3
    feed = tmp_path / "feed"
    feed.mkdir()
    rec = {"transaction_id": "TXN0000000099", "account_id": "ACC0000001", "employee_id": None,
           "type": "Gửi tiền", "currency": "VND", "date": "2025-06-04 09:15:00", "amount": 5}
    (feed / "a.json").write_text(json.dumps({"key": "ACC0000001", "value": json.dumps(rec)}) + "\n")
    jobs.main(["ingest", "--feed", "transaction", "--source", str(feed), "--out", str(tmp_path / "live")])
    row = spark.read.parquet(str(tmp_path / "live")).first()
    assert (row["transaction_id"], row["date_id"], row["year"], row["month"]) == ("TXN0000000099", 20250604, 2025, 6)


def test_checks_job_on_csv_export_and_documents(spark, tmp_path, capsys):
    from tests.test_landing_star import CSV
    src = tmp_path / "csv"
    src.mkdir()
    for name, lines in CSV.items():
        (src / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    docs = tmp_path / "docs"
    for name, rows in [("customers", FX.CUSTOMERS), ("accounts", FX.ACCOUNTS), ("cards", FX.CARDS),
                       ("loans", FX.LOANS), ("transactions", FX.TRANSACTIONS), ("analytics", FX.ANALYTICS)]:
        write_documents(spark.createDataFrame(rows, S.DOCUMENTS[name]), str(docs / name))
    jobs.main(["checks", "--csv", str(src), "--as-of", "2025-06-05", "--docs", str(docs),
               "--out", str(tmp_path / "report")])
    result = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert result["violations"] == {"accounts.unknown_type": 1, "transactions.unknown_type": 1,
                                    "transactions.overdraft_flip": 1,
                                    "payments.scheduled_outside_loan": 2}


def test_landing_job_with_a_quarantine(spark, tmp_path):
    from tests.test_landing_star import CSV
    src = tmp_path / "csv"
    src.mkdir()
    for name, lines in CSV.items():
        more = ["BAD,line"] if name in ("accounts", "branches") else []
        (src / f"{name}.csv").write_text("\n".join([*lines, *more]) + "\n", encoding="utf-8")
    jobs.main(["landing", "--csv", str(src), "--out", str(tmp_path / "plain")])
    jobs.main(["landing", "--csv", str(src), "--out", str(tmp_path / "landing"), "--quarantine", str(tmp_path / "bad")])
    bad = {name: [r.line for r in spark.read.parquet(str(tmp_path / "bad" / name)).collect()] for name in CSV if (tmp_path / "bad" / name).exists()}
    assert {n: x for n, x in bad.items() if x} == {"accounts": ["BAD,line"], "branches": ["BAD,line"]}
    rows = lambda out, name: spark.read.parquet(str(tmp_path / out / name)).count()
    assert rows("plain", "branches") == rows("landing", "branches") + 1 and rows("plain", "transactions") == rows("landing", "transactions")


def test_fold_and_upsert_jobs(spark, tmp_path, capsys):
    feed = tmp_path / "feed"
    feed.mkdir()
    loan = {"loan_id": "LOA1", "customer_id": "CUS1", "type": "Kinh doanh", "amount": 100, "currency": "VND", "interest_rate": 9.5,
            "term": 12, "start_date": "2025-01-01", "end_date": "2025-12-27"}
    for n, status in enumerate(["Đang vay", "Quá hạn", "Đang vay"]):
        (feed / f"{n}.json").write_text(json.dumps({"key": "CUS1", "value": json.dumps(loan | {"status": status}), "sent_at": f"2025-0{3 - n}-01"}) + "\n")
        jobs.main(["ingest", "--feed", "loan", "--source", str(feed), "--out", str(tmp_path / "log")])
        jobs.main(["ingest", "--feed", "loan", "--source", str(feed), "--out", str(tmp_path / "dim"), "--upsert", "--buckets", "2"])
    from ledgerlake.sinks.keyed import KeyedTable
    assert [r.status for r in KeyedTable(spark, str(tmp_path / "dim"), "loan_id", ["sent_at"], 2).read().collect()] == ["Đang vay"]
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3
    capsys.readouterr()
    jobs.main(["fold", "--table", str(tmp_path / "log"), "--least", "2"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"months_folded": 1}
    assert spark.read.parquet(str(tmp_path / "log")).select("batch_id").distinct().collect()[0][0] == -1
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3
