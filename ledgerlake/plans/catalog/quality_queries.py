"""Data quality: J12, V1-V11."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import scalars as FX
from ledgerlake.operators import bank_rules, quality
from ledgerlake.plans import roles as R
from ledgerlake.sources.lookups import rows_frame
from ledgerlake.sources.tables import Tables
from ledgerlake.plans.catalog.common import loan_terms


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose foreign key has no parent, per relation.  Parents are
    those in good standing (``roles.PARENT_FILTERS``), so each relation has
    orphans."""
    t = Tables(spark, sf_dir)

    def parent(name):
        return t.read(name).where(R.PARENT_FILTERS[name])

    def rel(child, fk, name, pk):
        return (f"{child}.{fk}->{name}", fk, parent(name), pk)

    children = [("orders", [("o_custkey", "customer", "c_custkey")]),
                ("lineitem", [("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"),
                              ("l_suppkey", "supplier", "s_suppkey")]),
                ("customer", [("c_nationkey", "nation", "n_nationkey")]),
                ("supplier", [("s_nationkey", "nation", "n_nationkey")]),
                ("nation", [("n_regionkey", "region", "r_regionkey")]),
                ("events", [("user_id", "customer", "c_custkey")])]
    return quality.union_counts([quality.fk_orphans(t.read(c), [rel(c, *x) for x in rels])
                                 for c, rels in children])


def with_missing(t: Tables) -> dict[str, DataFrame]:
    """customer, orders and events with the values that have no role in the
    bank as missing ones."""
    return {n: t.read(n).withColumns({c: F.expr(e) for c, e in R.MISSING[n].items()}) for n in R.MISSING}


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: missing required fields, per table and field."""
    parts = [quality.rule_counts(df, quality.required_rules(list(R.MISSING[n]), prefix=f"{n}."))
             for n, df in with_missing(Tables(spark, sf_dir)).items()]
    return quality.union_counts(parts)


def type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: values present as text that do not read as their declared type.
    The text is what an export gives: some keys with a letter, some amounts
    with a comma, some balances with their currency."""
    t = Tables(spark, sf_dir)
    k = F.get_json_object("props", "$.k")
    ev = t.events.select(F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("k"), k)).otherwise(k).alias("props_k"),
                         F.when(F.col("event_type") == "error", F.translate(F.col("value").cast("string"), ".", ","))
                         .otherwise(F.col("value").cast("string")).alias("value_text"))
    r1 = quality.rule_counts(ev, quality.type_rules(ev, {"props_k": "int",
                                                         "value_text": "double"},
                                                    prefix="events."))
    bal = F.col("c_acctbal").cast("string")
    c = t.customer.select(F.col("c_name"), F.when(F.col("c_mktsegment") == "BUILDING", F.concat(bal, F.lit(" VND"))).otherwise(bal).alias("bal"))
    r2 = quality.rule_counts(c, quality.type_rules(c, {"c_name": "bigint", "bal": "double"},
                                                   prefix="customer."))
    return r1.unionByName(r2)


def id_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: id text patterns (prefix + fixed number of digits) on ids that
    were not padded."""
    t = Tables(spark, sf_dir)
    parts = []
    for table, key, entity, times in (("customer", "c_custkey", "customer", 10_000), ("supplier", "s_suppkey", "branch", 50_000),
                                      ("orders", "o_orderkey", "transaction", 1_000_000)):
        raw = t.read(table).select(F.concat(F.lit(S.ID_PREFIXES[entity]), (F.col(key) * times).cast("string")).alias("id"))
        parts.append(quality.rule_counts(raw, {f"{table}.{entity}_id": bank_rules.id_rule("id", entity)}))
    return quality.union_counts(parts)


def amount_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: amount magnitude outside its type's range, per type."""
    e = R.signed_events(spark, Tables(spark, sf_dir))
    rules = rows_frame(spark, R.EVENT_AMOUNT_RULES, "transaction_type_id int, lo double, hi double")
    j = e.join(F.broadcast(rules), "transaction_type_id", "inner")
    bad = quality.outside(F.abs(F.col("amount_cents")) / 100.0, F.col("lo"), F.col("hi"))
    return j.groupBy("transaction_type").agg(F.count_if(bad).alias("n_bad"),
                                             F.count(F.lit(1)).alias("n_rows"))


def amount_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: sign of the amount against its type (transfers take either).  The
    amount is the event's value over a fixed fee, as the feed gives it: its
    sign doesn't come from the type."""
    e = R.signed_events(spark, Tables(spark, sf_dir))
    raw = F.abs(F.col("amount_cents")) - R.EVENT_FEE_CENTS
    bad = ((F.col("sign") < 0) & (raw > 0)) | ((F.col("sign") > 0) & (raw < 0))
    return e.groupBy("transaction_type").agg(F.count_if(bad).alias("n_bad"))


def balance_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: balance outside its segment's range or under its minimum; a
    segment without a rule is a finding of its own."""
    c = Tables(spark, sf_dir).customer
    rules = rows_frame(spark, R.SEGMENT_BALANCE_RULES,
                       "c_mktsegment string, lo double, hi double, min_balance double")
    j = c.join(F.broadcast(rules), "c_mktsegment", "left")
    return j.groupBy("c_mktsegment").agg(
        F.count_if(F.col("lo").isNull()).alias("n_unknown_segment"),
        F.count_if(quality.outside(F.col("c_acctbal"), F.col("lo"), F.col("hi"))).alias("n_out_of_range"),
        F.count_if(F.col("c_acctbal") < F.col("min_balance")).alias("n_under_minimum"))


def date_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: a line shipped before its order date (closed before opened)."""
    t = Tables(spark, sf_dir)
    j = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return quality.rule_counts(j, {"ship_before_order": F.col("l_shipdate") < F.col("o_orderdate"),
                                   "ship_over_year_after_order":
                                       F.col("l_shipdate") > F.date_add(F.col("o_orderdate").cast("date"), 365)})


def date_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F18 + V8: expiry = issue + 1,095 days, due = start + 30 days."""
    o = Tables(spark, sf_dir).orders
    issue = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", issue.alias("issue_date"),
                    FX.add_days(issue, S.CARD_VALID_DAYS).alias("expiration_date"),
                    FX.add_days(issue, 30).alias("due_date"))


def loan_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: term in the allowed set; amount within its loan type's range; a
    loan of unknown type or without a term is a finding, not left out."""
    t = Tables(spark, sf_dir)
    prio = rows_frame(spark, R.ORDER_PRIORITY_ROLES, "o_orderpriority string, loan_type_id int")
    ranges = rows_frame(spark, R.ORDER_AMOUNT_RULES, "loan_type_id int, lo double, hi double")
    terms = loan_terms(t)
    j = t.orders.join(F.broadcast(prio), "o_orderpriority", "left").join(F.broadcast(ranges), "loan_type_id", "left")
    j = j.join(terms, j["o_orderkey"] == terms["l_orderkey"], "left")
    return quality.rule_counts(j, {
        "unknown_type": F.col("lo").isNull(),
        "no_term": F.col("term").isNull(),
        "term_not_allowed": quality.not_in(F.col("term"), S.LOAN_TERMS),
        "amount_out_of_range": quality.outside(F.col("o_totalprice"), F.col("lo"), F.col("hi")),
    })


def payment_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment against its loan (orders not yet finished) -- unknown
    loan, ratio to the instalment, paid before the loan starts, paid in the
    future."""
    t = Tables(spark, sf_dir)
    terms = loan_terms(t)
    loans = t.orders.where("o_orderstatus <> 'F'").join(terms, F.col("o_orderkey") == F.col("l_orderkey"), "inner").select(
        "o_orderkey", "o_orderdate",
        FX.monthly_installment("o_totalprice", "term").alias("installment"))
    p = t.lineitem.select("l_orderkey", "l_extendedprice", "l_shipdate")
    j = p.join(loans, p["l_orderkey"] == loans["o_orderkey"], "left")
    ratio = F.col("l_extendedprice") / F.col("installment")
    lo, hi = S.PAYMENT_RATIO
    return quality.rule_counts(j, {
        "unknown_loan": F.col("o_orderkey").isNull(),
        "payment_ratio": quality.outside(ratio, lo, hi),
        "paid_before_start": F.col("l_shipdate") < F.col("o_orderdate"),
        "paid_in_future": F.col("l_shipdate") > F.lit(R.LINEITEM_AS_OF).cast("timestamp_ntz"),
    })


def allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside their allowed sets (``roles.ALLOWED``)."""
    t = Tables(spark, sf_dir)
    return quality.union_counts([
        quality.rule_counts(t.read(n), {f"{n}.{c}": quality.not_in(F.col(c), allowed) for c, allowed in cols.items()})
        for n, cols in R.ALLOWED.items()])


def landing_rule_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule set of the bank over the driver's tables in
    landing shape (``roles.raw_landing``), whose values break each rule."""
    return bank_rules.check_landing(spark, R.raw_landing(Tables(spark, sf_dir)), R.LINEITEM_AS_OF)


def document_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 + V2 + K11 on raw documents: events written as JSON documents of the
    transactions collection, each field with a fault that depends on the
    event (absent, or of another type: an amount as text, a numeric customer
    id, an account id beyond 32 bits, a date that isn't one), read back as
    text and checked."""
    from ledgerlake.session import scratch_path
    e = Tables(spark, sf_dir).events
    n = F.col("event_id")
    text = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    number = lambda every, value: F.when(n % every == 0, n.cast("string")).otherwise(value)
    fields = [("_id", F.when(n % 37 != 0, number(17, text(n)))),
              ("customer_id", F.when(n % 41 != 0, number(10, text(F.col("user_id"))))),
              ("account_id", F.when(n % 11 == 0, F.lit("3000000000")).otherwise(F.col("user_id").cast("string"))),
              ("date", F.when(n % 19 == 0, F.lit('"yesterday"')).when(n % 13 != 0, text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")))),
              ("amount", F.when(F.col("event_type") == "error", F.lit('"a lot"')).when(n % 43 != 0, F.col("value").cast("string"))),
              ("type", F.when(n % 47 != 0, number(23, text(F.col("event_type"))))),
              ("payment_method", F.when(F.col("event_type") != "click", number(29, F.lit('"card"'))))]
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in fields])  # null fields are left out
    path = scratch_path(spark, "documents")
    e.select(F.concat(F.lit("{"), body, F.lit("}")).alias("value")).write.text(path)
    return bank_rules.check_documents({"transactions": spark.read.text(path)})
