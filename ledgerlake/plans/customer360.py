"""Customer 360 (B17): one nested document per customer.

match -> three lookups by id arrays (accounts, cards, loans; J9) -> all
transactions of the customer (J10) -> the newest analytics row (J11) ->
``analytics`` as a single field, absent when there is none.

Computed for all customers at once (joins on keys), or for one id: the
id filter is applied to the customer scan and to the transaction and
analytics scans directly.  The id-array lookups are bounded by the
arrays the customer row already holds.  The transaction array is the
customer's whole fan-out, so population-scale callers take
``transactions="rows"``: documents without that array plus the keyed
transaction rows, never one unbounded array per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import nest

DOC_ORDER = ["_id", "personal_info", "accounts", "cards", "loans", "primary_branch",
             "transactions", "analytics"]


def newest_analytics(analytics: DataFrame) -> DataFrame:
    """Per customer, the analytics row with the latest ``last_updated``
    (``_id`` breaks ties), whole, as one struct field."""
    row = F.struct(*[F.col(c) for c in analytics.columns])
    return analytics.groupBy(F.col("customer_id").alias("__cid")).agg(
        F.max_by(row, F.struct("last_updated", "_id")).alias("analytics"))


def assemble(customers: DataFrame, accounts: DataFrame, cards: DataFrame, loans: DataFrame,
             transactions: DataFrame, analytics: DataFrame, customer_id: str | None = None,
             transactions_mode: str | None = None, chunk_size: int = 1000):
    """Build customer documents.

    ``transactions_mode``: ``'nested'`` puts every transaction of the
    customer in the document; ``'rows'`` returns ``(documents,
    transaction_rows)`` instead; ``'chunks'`` returns ``(documents,
    transaction_chunks)`` with every transaction nested, in date order, in
    chunks of at most ``chunk_size`` per customer.  The default nests only
    under an id filter, and keeps transactions as rows for a population run."""
    if transactions_mode is None:
        transactions_mode = "nested" if customer_id is not None else "rows"
    if transactions_mode == "nested" and customer_id is None:
        raise ValueError("nested transactions are unbounded for each customer: name a customer_id, or use rows or chunks")
    if customer_id is not None:
        customers = customers.where(F.col("_id") == customer_id)
        transactions = transactions.where(F.col("customer_id") == customer_id)
        analytics = analytics.where(F.col("customer_id") == customer_id)
    doc = customers
    for field, coll in (("accounts", accounts), ("cards", cards), ("loans", loans)):
        if customer_id is not None:
            # one customer: cut the child collection to the ids in that
            # customer's array first (a list bounded by one row, broadcast)
            ids = customers.select(F.explode(F.array_distinct(F.col(field))).alias("__id"))
            coll = coll.join(F.broadcast(ids), coll["_id"] == ids["__id"], "left_semi")
        doc = nest.lookup_by_ids(doc, "_id", field, coll, "_id")
    newest = newest_analytics(analytics)
    if transactions_mode == "nested":
        doc = nest.nest_children(doc, "_id", transactions, "customer_id", "transactions",
                                 sort_by=["_id"])
    doc = doc.join(newest, doc["_id"] == newest["__cid"], "left").drop("__cid")
    cols = [c for c in DOC_ORDER if c in doc.columns]
    doc = doc.select(*cols, *[c for c in doc.columns if c not in cols])
    if transactions_mode == "nested":
        return doc
    if transactions_mode == "chunks":
        return doc, nest.nest_children_chunked(transactions, "customer_id", ["date", "_id"],
                                               chunk_size, "transactions")
    return doc, transactions


def to_json_documents(docs: DataFrame) -> DataFrame:
    """One JSON text per document, ISO timestamps, NULL fields left out."""
    return docs.select(F.col("_id"), F.to_json(
        F.struct(*docs.columns),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "ignoreNullFields": "true"}).alias("json"))


def analytics_documents(tx: DataFrame, key: str, type_col: str, channel_col: str, amount: str,
                        as_of: str, period: str = "last_12_months", months: int = 12,
                        last_updated=None) -> DataFrame:
    """The ``analytics`` collection from a period's transactions (A5-A7):
    cash-flow totals, spending by type (an array bounded by the number of
    types) and by channel, one document per customer.  ``amount`` is signed;
    the health score has no formula in the source and stays NULL."""
    from ledgerlake import schemas as S
    from ledgerlake.operators import analytics as A
    flow = A.cashflow_summary(tx, key, amount, months=months, places=2)
    by_type = A.nest_by_type(A.spending_by_type(tx, key, type_col, amount), key)
    by_channel = A.spending_by_channel(tx, key, channel_col, amount)
    j = flow.join(by_type, key, "left").join(by_channel, key, "left")
    stamp = F.lit(as_of).cast("timestamp") if last_updated is None else F.lit(last_updated).cast("timestamp")
    doc_id = F.concat(F.col(key).cast("string"), F.lit("_"),
                      F.date_format(F.lit(as_of).cast("date"), "yyyyMM"))
    ta = F.struct(
        "total_transactions", "total_inflow", "total_outflow", "net_cashflow",
        "avg_monthly_transactions",
        F.struct(F.col("by_type"), F.struct("branch", "atm", "online").alias("by_channel")
                 ).alias("spending_patterns"))
    out = j.select(doc_id.alias("_id"), F.col(key).cast("string").alias("customer_id"),
                   F.lit(period).alias("period"), ta.alias("transaction_analytics"),
                   F.lit(None).cast(S.HEALTH).alias("financial_health_score"),
                   stamp.alias("last_updated"))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.DOC_ANALYTICS.fields])
