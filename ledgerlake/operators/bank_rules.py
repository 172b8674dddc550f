"""The source system's business rules as data-quality rule sets over the
landing tables (V3-V11, plus P15 and the overdraft exception of D12).

Each function returns ``{rule name: bad-row Column}`` for one table, ready
for ``quality.rule_counts`` (one scan per table) or
``quality.violations``.  Per-type limits come from the constant tables in
``schemas`` through small broadcast joins (``with_*`` helpers).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.operators.quality import not_in, outside, pattern_rule


def id_rule(col: str, entity: str) -> Column:
    """V3: prefix + 7 digits (10 for transactions)."""
    width = S.TRANSACTION_ID_WIDTH if entity == "transaction" else S.ID_WIDTH
    return pattern_rule(col, rf"^{S.ID_PREFIXES[entity]}[0-9]{{{width}}}$")


def with_account_limits(spark: SparkSession, accounts: DataFrame) -> DataFrame:
    names = spark.createDataFrame(S.ACCOUNT_TYPES, "type int, __type_name string")
    limits = spark.createDataFrame(S.ACCOUNT_BALANCE_RULES,
                                   "__type_name string, __lo long, __hi long, __min long")
    lim = F.broadcast(names.join(limits, "__type_name"))
    return accounts.join(lim, "type", "left")


def account_rules() -> dict[str, Column]:
    """V6, V7, V11 on accounts (after ``with_account_limits``)."""
    return {
        "accounts.id": id_rule("account_id", "account"),
        "accounts.unknown_type": F.col("__type_name").isNull(),
        "accounts.balance_range": outside(F.col("balance"), F.col("__lo"), F.col("__hi")),
        "accounts.min_balance": F.col("min_balance") != F.col("__min"),
        "accounts.closed_before_opened": F.col("date_closed") < F.col("date_opened"),
        "accounts.currency": not_in(F.col("currency"), [S.CURRENCY]),
    }


def with_transaction_limits(spark: SparkSession, tx: DataFrame) -> DataFrame:
    lim = spark.createDataFrame(S.TRANSACTION_AMOUNT_RULES, "type int, __lo long, __hi long, __sign int")
    return tx.join(F.broadcast(lim), "type", "left")


def transaction_rules() -> dict[str, Column]:
    """V4, V5 (the overdraft flip reported apart, D12), P15, V11."""
    amt, sign = F.col("amount"), F.col("__sign")
    withdrawal = F.col("type") == 2
    return {
        "transactions.id": id_rule("transaction_id", "transaction"),
        "transactions.unknown_type": sign.isNull(),
        "transactions.amount_range": outside(F.abs(amt), F.col("__lo"), F.col("__hi")),
        "transactions.sign": ((sign < 0) & (amt > 0) & ~withdrawal) | ((sign > 0) & (amt < 0)),
        "transactions.overdraft_flip": withdrawal & (amt > 0),
        "transactions.receiver_not_transfer": F.col("receiver_account_id").isNotNull() & (F.col("type") != 3),
        "transactions.currency": not_in(F.col("currency"), [S.CURRENCY]),
    }


def with_card_types(spark: SparkSession, cards: DataFrame) -> DataFrame:
    ct = spark.createDataFrame(S.CARD_TYPES, "card_type_id int, __name string, __fee int, __rate double")
    return cards.join(F.broadcast(ct), "card_type_id", "left")


def card_rules() -> dict[str, Column]:
    """V8 and the fee/rate of the card type."""
    return {
        "cards.id": id_rule("card_id", "card"),
        "cards.unknown_type": F.col("__name").isNull(),
        "cards.expiry": F.col("expiration_date") != F.date_add("issuance_date", S.CARD_VALID_DAYS),
        "cards.fee": F.col("monthly_fee") != F.col("__fee"),
        "cards.rate": F.abs(F.col("interest_rate").cast("double") - F.col("__rate")) > 1e-6,
    }


def with_loan_limits(spark: SparkSession, loans: DataFrame) -> DataFrame:
    lim = spark.createDataFrame(S.LOAN_AMOUNT_RULES, "loan_type_id int, __lo long, __hi long")
    return loans.join(F.broadcast(lim), "loan_type_id", "left")


def loan_rules() -> dict[str, Column]:
    """V9: term, end date, rate and amount range."""
    lo, hi = S.LOAN_RATE_RANGE
    return {
        "loans.id": id_rule("loan_id", "loan"),
        "loans.unknown_type": F.col("__lo").isNull(),
        "loans.term": not_in(F.col("term"), S.LOAN_TERMS),
        "loans.end_date": F.col("end_date") != F.date_add("start_date", F.col("term") * 30),
        "loans.rate": outside(F.col("interest_rate"), lo, hi),
        "loans.amount_range": outside(F.col("amount"), F.col("__lo"), F.col("__hi")),
        "loans.currency": not_in(F.col("currency"), [S.CURRENCY]),
    }


def with_loan(payments: DataFrame, loans: DataFrame) -> DataFrame:
    """Payments with their loan's instalment and dates (left join: a
    payment of an unknown loan is itself a finding)."""
    ln = loans.select(F.col("loan_id").alias("__loan_id"), F.col("start_date").alias("__start"),
                      F.col("end_date").alias("__end"),
                      (F.col("amount").cast("double") / F.col("term")).alias("__instalment"))
    return payments.join(ln, payments["loan_id"] == ln["__loan_id"], "left")


def payment_rules(as_of: _dt.date | str) -> dict[str, Column]:
    """V10 (amounts are whole units, so bounds allow half a unit of rounding)."""
    plo, phi = S.PAYMENT_RATIO
    rlo, rhi = S.PRINCIPAL_RATIO
    pay, inst = F.col("payment_amount"), F.col("__instalment")
    late = F.datediff("payment_date", "scheduled_payment_date")
    return {
        "payments.id": id_rule("payment_id", "payment"),
        "payments.unknown_loan": F.col("__loan_id").isNull(),
        "payments.amount_vs_instalment": outside(pay, inst * plo - 0.5, inst * phi + 0.5),
        "payments.principal_share": outside(F.col("principal_amount"), pay * rlo - 0.5, pay * rhi + 0.5),
        "payments.paid_amount": F.col("paid_amount") != pay,
        "payments.paid_date": F.col("paid_date") != F.col("payment_date"),
        "payments.lateness": outside(late, -S.PAYMENT_EARLY_DAYS, S.PAYMENT_LATE_DAYS),
        "payments.scheduled_outside_loan": outside(F.col("scheduled_payment_date"), F.col("__start"),
                                                   F.col("__end")),
        "payments.in_future": F.col("payment_date") > F.lit(str(as_of)).cast("date"),
    }


def customer_rules() -> dict[str, Column]:
    """V3 and V11 on customers."""
    return {
        "customers.id": id_rule("customer_id", "customer"),
        "customers.country": not_in(F.col("country"), [S.COUNTRY]),
        "customers.city": not_in(F.col("city"), list(S.CITIES)),
    }


def landing_rule_sets(spark: SparkSession, src: dict[str, DataFrame], as_of) -> dict[str, tuple[DataFrame, dict[str, Column]]]:
    """Each raw landing table with the limits its rules need, and the rules."""
    return {
        "accounts": (with_account_limits(spark, src["accounts"]), account_rules()),
        "transactions": (with_transaction_limits(spark, src["transactions"]), transaction_rules()),
        "cards": (with_card_types(spark, src["cards"]), card_rules()),
        "loans": (with_loan_limits(spark, src["loans"]), loan_rules()),
        "loan_payments": (with_loan(src["loan_payments"], src["loans"]), payment_rules(as_of)),
        "customers": (src["customers"], customer_rules()),
    }


def check_landing(spark: SparkSession, src: dict[str, DataFrame], as_of) -> DataFrame:
    """All rule sets over the raw landing tables: (rule, n_bad), one scan per table."""
    from ledgerlake.operators.quality import rule_counts, union_counts
    return union_counts([rule_counts(df, rules) for df, rules in landing_rule_sets(spark, src, as_of).values()])


def land_observed(spark: SparkSession, src: dict[str, DataFrame], as_of, folder: str) -> DataFrame:
    """V3-V11 while the landing tables are written: the rules are counted on
    the rows as they pass to the writer, so no table is scanned a second time
    for its checks.  Returns (rule, n_bad); a row per rule reaches the driver."""
    from ledgerlake.sinks.writers import write_observed
    counts = []
    for name, (df, rules) in landing_rule_sets(spark, src, as_of).items():
        counts += write_observed(df, rules, f"{folder}/{name}", src[name].columns).items()
    return spark.createDataFrame(counts, "rule string, n_bad long")


def _fields(schema, prefix: str = ""):
    """(dotted path, type) of every scalar field and array; structs are entered."""
    from pyspark.sql import types as T
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _fields(f.dataType, f"{prefix}{f.name}.")
        else:
            yield f"{prefix}{f.name}", f.dataType


def _kind(value: Column) -> Column:
    """Type of a JSON value: STRING, BIGINT, ..., VOID for null."""
    return F.upper(F.schema_of_variant(value))


def _misread(value: Column, dtype) -> Column:
    """V2: a JSON value, there and not null, that isn't of the declared type.
    Text must be text; integers (the validator's int) must fit 32 bits."""
    from pyspark.sql import types as T
    kind = _kind(value)
    there = value.isNotNull() & (kind != "VOID")
    as_text = F.try_variant_get(value, "$", "string")
    if isinstance(dtype, T.StringType):
        return there & (kind != "STRING")
    if isinstance(dtype, T.TimestampType):
        return there & F.try_to_timestamp(as_text).isNull()
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return there & as_text.try_cast("int").isNull()
    return there & as_text.try_cast(dtype.simpleString()).isNull()


def _bad_item(dtype, field: str | None = None):
    """Whether an array's item, or a field of it, isn't of the declared type."""
    def bad(x: Column) -> Column:
        return F.coalesce(_misread(F.try_variant_get(x, f"$.{field}", "variant") if field else x, dtype), F.lit(False))
    return bad


def _items(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, "$." + path, "array<variant>")


def document_type_rules(json_col: str, collection: str) -> dict[str, Column]:
    """V2 on raw documents: a value present in the JSON text that does not
    read as the field's declared type.  Items of an array are checked
    together, each field of them: any item that fails counts."""
    from pyspark.sql import types as T
    doc = F.try_parse_json(F.col(json_col))
    rules = {}
    for path, dtype in _fields(S.DOCUMENTS[collection]):
        if not isinstance(dtype, T.ArrayType):
            rules[f"{collection}.type:{path}"] = _misread(F.try_variant_get(doc, "$." + path, "variant"), dtype)
        elif isinstance(dtype.elementType, T.StructType):
            for f in dtype.elementType.fields:
                rules[f"{collection}.type:{path}[*].{f.name}"] = F.exists(_items(doc, path), _bad_item(f.dataType, f.name))
        else:
            rules[f"{collection}.type:{path}[*]"] = F.exists(_items(doc, path), _bad_item(dtype.elementType))
    return rules


def document_required_rules(json_col: str, collection: str) -> dict[str, Column]:
    """V1 on raw documents: a required field absent (or JSON null) in the
    text; a nested one counts only when its parent is present, an item's when
    any item lacks it."""
    def absent(value: Column) -> Column:
        return F.coalesce(value.isNull() | (_kind(value) == "VOID"), F.lit(True))

    def without(field: str):
        return lambda x: absent(F.try_variant_get(x, f"$.{field}", "variant"))

    doc = F.try_parse_json(F.col(json_col))
    rules = {}
    for p in S.REQUIRED_FIELDS[collection]:
        array, star, field = p.partition("[*].")
        if star:
            rules[f"{collection}.required:{p}"] = F.exists(_items(doc, array), without(field))
            continue
        bad = without(p)(doc)
        if "." in p:
            bad = ~without(p.rsplit(".", 1)[0])(doc) & bad
        rules[f"{collection}.required:{p}"] = bad
    return rules


def check_documents(raw: dict[str, DataFrame], json_col: str = "value") -> DataFrame:
    """V1 + V2 over the six document collections given as raw JSON text
    (one document per row in ``json_col``): presence of the validator's
    required fields, and readability as the declared type -- two separate
    findings for one field.  One scan per collection; returns (rule, n_bad)."""
    from ledgerlake.operators.quality import rule_counts, union_counts
    return union_counts([
        rule_counts(df, {**document_required_rules(json_col, coll),
                         **document_type_rules(json_col, coll)})
        for coll, df in raw.items()])
