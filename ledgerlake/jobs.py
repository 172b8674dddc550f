"""Command-line entry points for the batch and stream jobs.

    python -m ledgerlake.jobs landing   --csv DIR --out DIR [--quarantine DIR]
    python -m ledgerlake.jobs star      --landing DIR --out DIR --as-of 2025-06-05
    python -m ledgerlake.jobs customer360 --docs DIR --out DIR [--customer-id ID]
    python -m ledgerlake.jobs latest-balance --facts DIR --out DIR
    python -m ledgerlake.jobs ingest    --feed transaction --source DIR --out DIR [--fold-every N]
    python -m ledgerlake.jobs ingest    --feed loan --source DIR --out DIR --upsert [--buckets N]
    python -m ledgerlake.jobs fold      --table DIR [--least N] [--small-mb N]
    python -m ledgerlake.jobs checks    [--csv DIR --as-of DATE] [--docs DIR] --out DIR

On a cluster, submit ``ledgerlake/jobs.py`` with the package zipped in
``--py-files``; the session is taken as configured by the platform and only the job settings
of ``session.configure`` are added.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    from ledgerlake.session import configure
    return configure(SparkSession.builder.getOrCreate())


def landing_job(args) -> dict:
    from ledgerlake.plans.landing import run_landing
    return run_landing(_session(), args.csv, args.out, args.quarantine)


def star_job(args) -> dict:
    from ledgerlake.plans.star import run_star
    return run_star(_session(), args.landing, args.out, args.as_of, args.audit_ts)


def customer360_job(args) -> dict:
    from ledgerlake.plans.customer360 import assemble, to_json_documents
    from ledgerlake.sinks.writers import write_documents
    from ledgerlake.sources.files import read_documents
    spark = _session()
    root = args.docs.rstrip("/")
    colls = [read_documents(spark, f"{root}/{c}", c) for c in
             ("customers", "accounts", "cards", "loans", "transactions", "analytics")]
    if args.customer_id:
        docs = assemble(*colls, customer_id=args.customer_id)
        to_json_documents(docs).select("json").write.mode("overwrite").text(args.out)
        return {"documents": args.out}
    docs, tx = assemble(*colls, transactions_mode="rows")
    write_documents(docs, f"{args.out}/documents")
    write_documents(tx, f"{args.out}/transactions")
    return {"documents": f"{args.out}/documents", "transactions": f"{args.out}/transactions"}


def latest_balance_job(args) -> dict:
    from ledgerlake.operators.latest import latest_by_rank
    from ledgerlake.sinks.writers import write_parquet
    spark = _session()
    facts = spark.read.parquet(args.facts)
    out = latest_by_rank(facts, ["account_id"], ["timestamp", "transaction_id"])
    write_parquet(out.select("account_id", "balance_after"), args.out)
    return {"latest_balance": args.out}


def ingest_job(args) -> dict:
    """Keyed JSON records (files with key/value) -> table folder, until
    the source is drained (``--continuous`` keeps running).  ``--fold-every``
    folds small batch folders as it goes; ``--upsert`` (loans) keeps the row
    sent last of each loan, by the record's ``sent_at``."""
    from ledgerlake.streaming.queries import ingest_feed, run_to_end, upsert_loans
    spark = _session()
    checkpoint, once = args.checkpoint or f"{args.out}/_checkpoint", not args.continuous
    records = spark.readStream.schema("key string, value string, sent_at string").json(args.source)
    if args.upsert:
        if args.feed != "loan":
            raise SystemExit("ingest: --upsert is for loans")
        q = upsert_loans(records, args.out, checkpoint, n_buckets=args.buckets, available_now=once)
    else:
        q = ingest_feed(records.drop("sent_at"), args.feed, args.out, checkpoint, available_now=once, fold_every=args.fold_every)
    run_to_end(q)
    return {args.feed: args.out}


def fold_job(args) -> dict:
    """K7 on a live table that no stream is writing: small batch folders of
    a month become one."""
    from ledgerlake.sinks import folding
    return {"months_folded": folding.fold(_session(), args.table, least=args.least, small_bytes=args.small_mb << 20)}


def checks_job(args) -> dict:
    """Data-quality report: business rules over a CSV export (V3-V11) and/or
    required fields and types over raw JSON document collections (V1, V2).
    Writes (rule, n_bad) as CSV and returns the rules that found rows."""
    from ledgerlake.operators import bank_rules
    from ledgerlake.operators.quality import union_counts
    from ledgerlake.sinks.writers import write_csv
    from ledgerlake.sources import files
    spark = _session()
    parts = []
    if args.csv:
        src = files.read_landing_csvs(spark, args.csv, register=False)
        parts.append(bank_rules.check_landing(spark, src, args.as_of))
    if args.docs:
        root = args.docs.rstrip("/")
        raw = {c: spark.read.text(f"{root}/{c}") for c in
               ("customers", "accounts", "cards", "loans", "transactions", "analytics")}
        parts.append(bank_rules.check_documents(raw))
    if not parts:
        raise SystemExit("checks: give --csv and/or --docs")
    report = union_counts(parts)
    write_csv(report, args.out)
    found = spark.read.schema("rule string, n_bad long").option("header", True).csv(args.out)
    return {"report": args.out,
            "violations": {r["rule"]: r["n_bad"] for r in found.where("n_bad > 0").collect()}}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="ledgerlake.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("landing")
    a.add_argument("--csv", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--quarantine", default=None)
    a.set_defaults(fn=landing_job)
    b = sub.add_parser("star")
    b.add_argument("--landing", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--as-of", required=True)
    b.add_argument("--audit-ts", default=None)
    b.set_defaults(fn=star_job)
    c = sub.add_parser("customer360")
    c.add_argument("--docs", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--customer-id", default=None)
    c.set_defaults(fn=customer360_job)
    d = sub.add_parser("latest-balance")
    d.add_argument("--facts", required=True)
    d.add_argument("--out", required=True)
    d.set_defaults(fn=latest_balance_job)
    e = sub.add_parser("ingest")
    e.add_argument("--feed", required=True, choices=["transaction", "loan_payment", "loan"])
    e.add_argument("--source", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--checkpoint", default=None)
    e.add_argument("--continuous", action="store_true")
    e.add_argument("--fold-every", type=int, default=None)
    e.add_argument("--upsert", action="store_true")
    e.add_argument("--buckets", type=int, default=64)
    e.set_defaults(fn=ingest_job)
    g = sub.add_parser("fold")
    g.add_argument("--table", required=True)
    g.add_argument("--least", type=int, default=8)
    g.add_argument("--small-mb", type=int, default=64)
    g.set_defaults(fn=fold_job)
    f = sub.add_parser("checks")
    f.add_argument("--csv", default=None)
    f.add_argument("--as-of", default=None)
    f.add_argument("--docs", default=None)
    f.add_argument("--out", required=True)
    f.set_defaults(fn=checks_job)
    args = p.parse_args(argv)
    print(json.dumps(args.fn(args)))


if __name__ == "__main__":
    main()
