"""B17 golden document and edge customers."""

import json
from datetime import datetime

import pytest

from ledgerlake import schemas as S
from ledgerlake.plans import customer360 as C
from tests.fixtures import customer360_sample as FX


def _frames(spark, customers=None, accounts=None, cards=None, loans=None, tx=None, an=None):
    def mk(rows, schema):
        return spark.createDataFrame(rows, schema)
    return (mk(customers if customers is not None else FX.CUSTOMERS, S.DOC_CUSTOMERS),
            mk(accounts if accounts is not None else FX.ACCOUNTS, S.DOC_ACCOUNTS),
            mk(cards if cards is not None else FX.CARDS, S.DOC_CARDS),
            mk(loans if loans is not None else FX.LOANS, S.DOC_LOANS),
            mk(tx if tx is not None else FX.TRANSACTIONS, S.DOC_TRANSACTIONS),
            mk(an if an is not None else FX.ANALYTICS, S.DOC_ANALYTICS))


def _docs(spark, frames, cid=None):
    ids = [cid] if cid else [r["_id"] for r in frames[0].collect()]
    out = [r for i in ids for r in C.to_json_documents(C.assemble(*frames, customer_id=i, transactions_mode="nested")).collect()]
    return {r["_id"]: json.loads(r["json"]) for r in out}


def test_nested_mode_needs_an_id(spark):
    with pytest.raises(ValueError):
        C.assemble(*_frames(spark), transactions_mode="nested")


def test_golden_document(spark):
    docs = _docs(spark, _frames(spark), FX.CUSTOMER_ID)
    assert docs[FX.CUSTOMER_ID] == FX.EXPECTED


def test_golden_document_without_filter(spark):
    docs = _docs(spark, _frames(spark))
    assert docs == {FX.CUSTOMER_ID: FX.EXPECTED}


def test_unknown_id_gives_no_rows(spark):
    assert _docs(spark, _frames(spark), "NOPE") == {}


def test_customer_without_children(spark):
    lone = dict(FX.CUSTOMERS[0], _id="CUST_0", accounts=[], cards=[], loans=[])
    docs = _docs(spark, _frames(spark, customers=FX.CUSTOMERS + [lone]))
    d = docs["CUST_0"]
    assert d["accounts"] == [] and d["cards"] == [] and d["loans"] == []
    assert d["transactions"] == []
    assert "analytics" not in d


def test_repeated_and_dangling_ids(spark):
    c = dict(FX.CUSTOMERS[0], accounts=[9, 8, 9, 77])
    docs = _docs(spark, _frames(spark, customers=[c]))
    assert [a["_id"] for a in docs[FX.CUSTOMER_ID]["accounts"]] == [8, 9]


def test_newest_analytics_wins(spark):
    older = FX.analytics(1, 10)
    newer = dict(FX.ANALYTICS[0], _id="newest", last_updated=datetime(2031, 7, 1))
    docs = _docs(spark, _frames(spark, an=[older, newer, *FX.ANALYTICS]))
    assert docs[FX.CUSTOMER_ID]["analytics"]["_id"] == "newest"


def test_rows_mode_keeps_transactions_apart(spark):
    docs, tx = C.assemble(*_frames(spark))          # population run: rows by default
    assert "transactions" not in docs.columns
    assert tx.count() == 3


def test_document_checks_required_and_types(spark):
    from ledgerlake.operators.bank_rules import check_documents
    good = {n: [json.dumps(FX._jsonable(r), ensure_ascii=False) for r in rows] for n, rows in [
        ("customers", FX.CUSTOMERS), ("accounts", FX.ACCOUNTS), ("cards", FX.CARDS),
        ("loans", FX.LOANS), ("transactions", FX.TRANSACTIONS), ("analytics", FX.ANALYTICS)]}
    bad_acc = dict(FX._jsonable(FX.ACCOUNTS[0]), balance="a lot")
    bad_acc.pop("currency")
    bad_cust = FX._jsonable(FX.CUSTOMERS[0])
    bad_cust["personal_info"] = dict(bad_cust["personal_info"], customer_since_months="x")
    del bad_cust["personal_info"]["address"]["city"]
    bad_cust["accounts"] = [5, "abc"]
    good["accounts"].append(json.dumps(bad_acc))
    good["customers"].append(json.dumps(bad_cust, ensure_ascii=False))
    raw = {k: spark.createDataFrame([(v,) for v in vals], "value string") for k, vals in good.items()}
    got = {r["rule"]: r["n_bad"] for r in check_documents(raw).collect() if r["n_bad"]}
    assert got == {"accounts.required:currency": 1,
                   "accounts.type:balance": 1,
                   "customers.required:personal_info.address.city": 1,
                   "customers.type:personal_info.customer_since_months": 1,
                   "customers.type:accounts[*]": 1}


def test_chunked_transactions_mode(spark):
    docs, chunks = C.assemble(*_frames(spark), transactions_mode="chunks", chunk_size=1)
    rows = sorted((r["customer_id"], r["chunk"], r["n"], r["transactions"][0]["_id"]) for r in chunks.collect())
    assert rows == [(FX.CUSTOMER_ID, n, 1, t) for n, t in enumerate(("T2", "T3", "T1"))]
    assert "transactions" not in docs.columns


def test_document_checks_inside_arrays_text_and_ids(spark):
    from ledgerlake.operators.bank_rules import check_documents
    doc = FX._jsonable(FX.ANALYTICS[0])
    doc["customer_id"] = 12
    patterns = doc["transaction_analytics"]["spending_patterns"]
    patterns["by_channel"], doc["financial_health_score"]["breakdown"] = {}, {}
    patterns["by_type"][1]["count"] = "abc"
    del patterns["by_type"][0]["amount"]
    account = dict(FX._jsonable(FX.ACCOUNTS[0]), _id=3_000_000_000)
    raw = {k: spark.createDataFrame([(json.dumps(v),)], "value string") for k, v in (("analytics", doc), ("accounts", account))}
    got = {r["rule"] for r in check_documents(raw).collect() if r["n_bad"]}
    path = "transaction_analytics.spending_patterns"
    assert got == {"accounts.type:_id", "analytics.type:customer_id", f"analytics.type:{path}.by_type[*].count",
                   f"analytics.required:{path}.by_type[*].amount",
                   *(f"analytics.required:{path}.by_channel.{c}" for c in ("branch", "atm", "online")),
                   *(f"analytics.required:financial_health_score.breakdown.{c}"
                     for c in ("payment_history", "account_balance", "credit_utilization", "relationship_depth"))}
