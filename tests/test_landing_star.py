"""CSV -> landing -> star on hand-made CSVs with the edge rows of the
source system (NULL and unknown codes, leading zeros, closed accounts,
overdraft flip, a month without transactions, year-end payments)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import landing, star
from ledgerlake.sinks import writers
from ledgerlake.sources import files

CSV = {
    "branches": ["branch_id,name,address,phone_number",
                 "BRA0000001,Chi nhánh A,\"1 Lê Lợi, Hà Nội\",0241",
                 "BRA0000002,Chi nhánh B,\"2 Hai Bà Trưng, Hồ Chí Minh\",0282"],
    "employees": ["employee_id,name,position,branch_id",
                  "EMP0000001,An,Kế toán,BRA0000001"],
    "customers": ["customer_id,name,country,city,street,phone_number,registration_date,email,customer_type_id,status",
                  "CUS0000001,An,Việt Nam,Hà Nội,1 A,0901234567,2020-03-15,a@x.vn,1,1",
                  "CUS0000002,Bình,Việt Nam,Hồ Chí Minh,2 B,,2021-01-01,b@x.vn,2,3",
                  "CUS0000003,Chi,Việt Nam,Hà Nội,3 C,0903,2022-01-01,c@x.vn,1,"],
    "accounts": ["account_id,customer_id,branch_id,type,status,currency,number,balance,min_balance,date_opened,date_closed",
                 "ACC0000001,CUS0000001,BRA0000001,1,1,VND,000000000012,10000000,500000,2023-01-01,",
                 "ACC0000002,CUS0000002,BRA0000002,2,3,VND,123456789012,2000000,50000,2022-01-01,2024-01-01",
                 "ACC0000003,CUS0000001,BRA0000001,1,,VND,111122223333,6000000,500000,2023-01-01,",
                 "ACC0000004,CUS0000001,BRA0000001,9,1,VND,999988887777,6000000,500000,2023-01-01,"],
    "transactions": ["transaction_id,account_id,receiver_account_id,employee_id,type,currency,date,amount,balance_after",
                     "TXN0000000001,ACC0000001,,EMP0000001,1,VND,2025-05-02 10:00:00,500000,10500000",
                     "TXN0000000002,ACC0000001,,EMP0000001,2,VND,2025-05-02 10:00:00,-200000,9800000",
                     "TXN0000000003,ACC0000002,ACC0000001,EMP0000001,3,VND,2025-03-31 23:59:59,-100000,1900000",
                     "TXN0000000004,ACC0000002,,EMP0000001,2,VND,2024-06-30 12:00:00,3000000,5000000",
                     "TXN0000000005,ACC0000001,,EMP0000001,4,VND,2024-05-31 08:00:00,-300000,9700000",
                     "TXN0000000006,ACC0000001,,EMP0000001,7,VND,2025-01-15 08:00:00,1,1"],
    "cards": ["card_id,account_id,customer_id,card_type_id,monthly_fee,interest_rate,expiration_date,issuance_date",
              "CRD0000001,ACC0000001,CUS0000001,3,100000,2.5,2027-01-01,2024-01-02"],
    "loans": ["loan_id,customer_id,loan_type_id,amount,currency,interest_rate,term,start_date,end_date,loan_status_id,_start_date_obj,_end_date_obj",
              "LOA0000001,CUS0000001,2,120000000,VND,9.5,12,2024-06-01,2025-05-27,1,2024-06-01,2025-05-27",
              "LOA0000002,CUS0000002,1,900000000,VND,7.25,120,2024-07-01,2034-05-10,3,2024-07-01,2034-05-10"],
    "loan_payments": ["payment_id,loan_id,transaction_id,payment_amount,scheduled_payment_date,payment_date,principal_amount,paid_amount,paid_date",
                      "PAY0000001,LOA0000001,TXN0000000005,10000000,2024-12-28,2024-12-31,7000000,10000000,2024-12-31",
                      "PAY0000002,LOA0000001,TXN0000000005,10000000,2024-12-30,2025-01-01,7000000,10000000,2025-01-01",
                      "PAY0000003,LOA0000001,TXN0000000005,10000000,2025-05-28,2025-06-01,7000000,10000000,2025-06-01",
                      "PAY0000004,LOA0000001,TXN0000000005,10000000,2024-05-20,2024-05-25,7000000,10000000,2024-05-25"],
}


@pytest.fixture(scope="module")
def built(spark):
    root = tempfile.mkdtemp(prefix="ledgerlake-landing-")
    src = os.path.join(root, "csv")
    os.makedirs(src)
    for name, lines in CSV.items():
        with open(os.path.join(src, f"{name}.csv"), "w", encoding="utf-8") as fh:
            fh.write("\n".join(lines) + "\n")
    landing_paths = landing.run_landing(spark, src, os.path.join(root, "landing"))
    star_paths = star.run_star(spark, os.path.join(root, "landing"), os.path.join(root, "star"),
                               as_of="2025-06-05", audit_ts="2025-06-05 00:33:00")
    return root, landing_paths, star_paths


def test_landing_accounts(spark, built):
    _, paths, _ = built
    a = {r["account_id"]: r for r in spark.read.parquet(paths["accounts"]).collect()}
    # NULL status (ACC3) and unknown type (ACC4) drop on the inner lookups
    assert set(a) == {"ACC0000001", "ACC0000002"}
    assert a["ACC0000001"]["number"] == "****0012"          # leading zeros kept
    assert a["ACC0000001"]["type"] == "Tiết kiệm" and a["ACC0000002"]["status"] == "Đóng"
    assert a["ACC0000001"]["date_closed"] is None and a["ACC0000002"]["date_closed"] == dt.date(2024, 1, 1)


def test_landing_customers_and_cards(spark, built):
    _, paths, _ = built
    c = {r["customer_id"]: r for r in spark.read.parquet(paths["customers"]).collect()}
    assert set(c) == {"CUS0000001", "CUS0000002"}            # NULL status drops
    assert c["CUS0000001"]["phone_number"] == "****567" and c["CUS0000002"]["phone_number"] is None
    assert c["CUS0000002"]["status"] == "Đóng" and c["CUS0000002"]["customer_type"] == "Doanh nghiệp"
    assert "customer_type_id" not in spark.read.parquet(paths["customers"]).columns
    card = spark.read.parquet(paths["cards"]).first()
    assert card["card_type"] == "Mastercard Credit" and card["number"].startswith("****")


def test_landing_partitioned_transactions(spark, built):
    root, paths, _ = built
    t = spark.read.parquet(paths["transactions"])
    assert {"year", "month", "day", "transaction_type"} <= set(t.columns)
    assert t.count() == 5                                    # type 7 is unknown and drops
    assert os.path.isdir(os.path.join(paths["transactions"], "year=2025", "month=5", "day=2"))
    lp = spark.read.parquet(paths["loan_payments"])
    assert lp.select("year").distinct().count() == 2
    loans = spark.read.parquet(paths["loans"])
    assert "_start_date_obj" not in loans.columns and loans.count() == 2


def test_star_dimensions(spark, built):
    _, _, sp = built
    assert spark.read.parquet(sp["dim_date"]).count() == 18628
    acc = spark.read.parquet(sp["dim_accounts"])
    assert "balance" not in acc.columns and acc.count() == 2
    br = spark.read.parquet(sp["dim_branches"]).first()
    assert br["is_active"] is True and br["created_at"] == dt.datetime(2025, 6, 5, 0, 33)
    loans = spark.read.parquet(sp["dim_loans"])
    assert {"type", "status"} <= set(loans.columns) and "currency" not in loans.columns
    assert "customer_id" not in spark.read.parquet(sp["dim_cards"]).columns


def test_star_fact_transactions_trailing_12_months(spark, built):
    _, _, sp = built
    f = spark.read.parquet(sp["fact_transactions"])
    ids = sorted(r["transaction_id"] for r in f.collect())
    # as of 2025-06-05: 2024-07-01 .. 2025-06-30; the 2024-05/06 rows are out
    assert ids == ["TXN0000000001", "TXN0000000002", "TXN0000000003"]
    row = f.where("transaction_id = 'TXN0000000003'").first()
    assert row["date_id"] == 20250331 and row["type"] == "Chuyển khoản"
    assert row["timestamp"] == dt.datetime(2025, 3, 31, 23, 59, 59)


def test_star_fact_loan_payments_months(spark, built):
    _, _, sp = built
    f = spark.read.parquet(sp["fact_loan_payments"])
    ids = sorted(r["payment_id"] for r in f.collect())
    # the 13 months 2024-06 .. 2025-06
    assert ids == ["PAY0000001", "PAY0000002", "PAY0000003"]
    r = f.where("payment_id = 'PAY0000002'").first()
    assert (r["scheduled_payment_date_id"], r["payment_date_id"], r["paid_date_id"]) == (20241230, 20250101, 20250101)


def test_star_rerun_is_idempotent(spark, built):
    root, _, sp = built
    before = spark.read.parquet(sp["fact_transactions"]).count()
    star.run_star(spark, os.path.join(root, "landing"), os.path.join(root, "star"),
                  as_of="2025-06-05", audit_ts="2025-06-05 00:33:00")
    assert spark.read.parquet(sp["fact_transactions"]).count() == before


def test_month_slice_reader_prunes_and_types_empty(spark, built):
    _, paths, _ = built
    df = files.read_month_slices(spark, paths["transactions"], "date", [(2025, 5), (2023, 2)])
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partition" in plan.lower()
    assert files.read_month_slices(spark, paths["transactions"], "date", [(2023, 2)]).count() == 0


def test_table_sinks(spark, built):
    root, paths, _ = built
    from ledgerlake import schemas as S
    spark.sql("DROP TABLE IF EXISTS t_dim_accounts")
    writers.create_table(spark, "t_dim_accounts", S.DIM_ACCOUNTS,
                         location=os.path.join(root, "tables", "dim_accounts"))
    acc = star.dim_accounts(spark.read.parquet(paths["accounts"]))
    writers.insert_by_name(acc.select(*reversed(acc.columns)), "t_dim_accounts")
    assert spark.table("t_dim_accounts").count() == 2
    writers.write_csv(acc, os.path.join(root, "csv_out"))
    back = files.read_csv(spark, os.path.join(root, "csv_out"), S.DIM_ACCOUNTS)
    assert back.count() == 2


def test_branch_json_source(spark, tmp_path):
    doc = ('{"branches_and_atm": [{"IsBranch": true, "Name": "\\n CN Hà Nội \\n", "Address": "1 Phố, Hà Nội", "Phone": "1"},'
           '{"IsBranch": false, "Name": "ATM", "Address": "Hà Nội", "Phone": "2"},'
           '{"IsBranch": true, "Name": "CN Huế", "Address": "Huế", "Phone": "3"}]}')
    p = tmp_path / "branches.json"
    p.write_text(doc, encoding="utf-8")
    rows = files.read_branches_json(spark, str(p)).collect()
    assert [(r["name"], r["phone_number"]) for r in rows] == [("CN Hà Nội", "1")]


def test_business_rules_on_landing_csvs(spark, built):
    from ledgerlake.operators import bank_rules
    root, _, _ = built
    src = files.read_landing_csvs(spark, os.path.join(root, "csv"), register=False)
    got = {r["rule"]: r["n_bad"] for r in bank_rules.check_landing(spark, src, "2025-06-05").collect()}
    bad = {k: v for k, v in got.items() if v}
    assert bad == {"accounts.unknown_type": 1,
                   "transactions.unknown_type": 1,
                   "transactions.overdraft_flip": 1,
                   "payments.scheduled_outside_loan": 2}   # PAY4 before start, PAY3 after end
    assert len(got) == 37


def test_star_in_catalog_tables(spark, built):
    root, _, sp = built
    spark.sql("CREATE DATABASE IF NOT EXISTS bank_star")
    for _ in range(2):   # a rerun replaces, never appends
        t = star.run_star(spark, os.path.join(root, "landing"), os.path.join(root, "catalog"),
                          as_of="2025-06-05", audit_ts="2025-06-05 00:33:00", catalog_db="bank_star")
    assert spark.table(t["fact_transactions"]).count() == 3
    assert spark.table(t["dim_date"]).count() == 18628
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {t['fact_transactions']}").collect()}
    assert parts == {"year=2025/month=3", "year=2025/month=5"}
    # the reference's own form: INSERT ... SELECT from a bound DataFrame
    extra = spark.table(t["dim_loans"]).where("false")
    spark.sql(f"INSERT INTO {t['dim_loans']} SELECT * FROM {{df}}", df=extra)
    assert spark.table(t["dim_loans"]).count() == 2


def test_end_to_end_latest_balance_from_star(spark, built):
    """CSV -> landing -> star -> B18: the newest balance per account,
    with the same-second tie broken by transaction id (D1)."""
    from ledgerlake import jobs
    root, _, sp = built
    out = os.path.join(root, "latest")
    jobs.main(["latest-balance", "--facts", sp["fact_transactions"], "--out", out])
    got = {r["account_id"]: r["balance_after"] for r in spark.read.parquet(out).collect()}
    assert got == {"ACC0000001": 9800000, "ACC0000002": 1900000}


def test_replace_table_and_catalog_scan(spark, built):
    root, paths, _ = built
    from ledgerlake.sinks.writers import replace_table, to_json_text
    tx = spark.read.parquet(paths["transactions"])
    spark.sql("DROP TABLE IF EXISTS t_full_refresh")
    replace_table(tx, "t_full_refresh", ("year", "month"))
    replace_table(tx, "t_full_refresh", ("year", "month"))     # full refresh, not append
    assert files.read_table(spark, "t_full_refresh").count() == tx.count()
    j = to_json_text(tx.select("transaction_id", "date").where("transaction_id = 'TXN0000000003'")).first()[0]
    assert j == '{"transaction_id":"TXN0000000003","date":"2025-03-31T23:59:59"}'


def test_write_to_catalog_falls_back_to_derived_partitions(spark, built):
    _, paths, _ = built
    from ledgerlake.sinks.writers import write_to_catalog
    tx = spark.read.parquet(paths["transactions"]).drop("year", "month", "day")
    spark.sql("DROP TABLE IF EXISTS t_v2_facts")
    assert write_to_catalog(tx, "t_v2_facts", "date") == "derived"
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS t_v2_facts").collect()}
    assert "year=2025/month=5" in parts and spark.table("t_v2_facts").count() == 5
    # rerun with one month: only that month's partition is replaced
    may = tx.where("date >= '2025-05-01' AND date < '2025-06-01'")
    assert write_to_catalog(may, "t_v2_facts", "date") == "overwrite"
    assert spark.table("t_v2_facts").count() == 5


def test_landing_reload_replaces_whole_export(spark, tmp_path):
    src = tmp_path / "csv"
    src.mkdir()
    for name, lines in CSV.items():
        (src / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    out = str(tmp_path / "landing")
    landing.run_landing(spark, str(src), out)
    # the next export no longer holds the 2024 transactions
    keep = [CSV["transactions"][0]] + [l for l in CSV["transactions"][1:] if ",2025-" in l]
    (src / "transactions.csv").write_text("\n".join(keep) + "\n", encoding="utf-8")
    landing.run_landing(spark, str(src), out)
    years = {r[0] for r in spark.read.parquet(os.path.join(out, "transactions")).select("year").distinct().collect()}
    assert years == {2025}


def test_star_next_year_rebuilds_transactions_keeps_payment_months(spark, built):
    root, _, _ = built
    wh = os.path.join(root, "star_next")
    star.run_star(spark, os.path.join(root, "landing"), wh, as_of="2025-06-05")
    before = spark.read.parquet(os.path.join(wh, "fact_loan_payments")).count()
    sp = star.run_star(spark, os.path.join(root, "landing"), wh, as_of="2026-06-05")
    read = lambda n: spark.read.schema(star.star_schema(n)).parquet(sp[n])
    assert read("fact_transactions").count() == 0          # whole rebuild, no rows in the window
    assert read("fact_loan_payments").count() >= before    # earlier months kept


def test_landing_reads_lookup_csvs_of_the_export(spark, tmp_path):
    src = tmp_path / "csv"
    src.mkdir()
    for name, lines in CSV.items():
        (src / f"{name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (src / "account_types.csv").write_text("account_type_id,type_name\n1,Savings\n2,Checking\n",
                                           encoding="utf-8")
    out = str(tmp_path / "landing")
    landing.run_landing(spark, str(src), out)
    a = {r["account_id"]: r["type"] for r in spark.read.parquet(os.path.join(out, "accounts")).collect()}
    assert a == {"ACC0000001": "Savings", "ACC0000002": "Checking"}
    # status names still come from the constant table (no CSV for them)
    st = {r["status"] for r in spark.read.parquet(os.path.join(out, "accounts")).collect()}
    assert st == {"Hoạt động", "Đóng"}


def test_payments_keep_the_as_of_month(spark):
    days = ["2024-05-31", "2024-06-01", "2024-11-30", "2024-12-01", "2024-12-31", "2025-05-02", "2025-06-02", "2025-07-01"]
    rows = [(f"P{i}", "L", "T", 1, d, d, 1, 1, d) for i, d in enumerate(days)]
    from ledgerlake import schemas as S
    p = spark.createDataFrame(rows, "payment_id string, loan_id string, transaction_id string, payment_amount long, scheduled_payment_date string,"
                              "payment_date string, principal_amount long, paid_amount long, paid_date string")
    p = p.select(*[p[f.name].cast(f.dataType) for f in S.LOAN_PAYMENTS.fields])
    got = sorted(r["payment_id"] for r in star.fact_loan_payments(p, star.payments_start("2025-06-05")).collect())
    assert got == ["P1", "P2", "P3", "P4", "P5", "P6"]


def test_an_unreadable_lookup_csv_is_an_error(spark, tmp_path, monkeypatch):
    from ledgerlake.sources import lookups

    def refuse(*_):
        raise PermissionError("no access")

    (tmp_path / "account_types.csv").write_text("account_type_id,type_name\n1,A\n", encoding="utf-8")
    assert lookups.lookups_from(spark, str(tmp_path / "none"))["account_types"].count() == 4
    monkeypatch.setattr(files, "read_csv", refuse)
    with pytest.raises(PermissionError):
        lookups.lookups_from(spark, str(tmp_path))
