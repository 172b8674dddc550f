"""DuckDB SQL equal to each query in ``bank_queries.QUERIES``.

Column names match the Spark side.  DuckDB's BIGINT results of
``year()`` etc. and its HUGEINT sums are cast back to Spark's types.
Constant tables are written as VALUES from the same Python constants the
Spark side uses.
"""

from __future__ import annotations

from ledgerlake import schemas as S
from ledgerlake.plans import roles as R


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def values(name: str, cols: str, rows) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"{name}({cols}) AS (VALUES {body})"


def cents(expr: str) -> str:
    return f"CAST(round({expr} * 100) AS BIGINT)"


SE_CTE = ", ".join([
    values("roles", "event_type, transaction_type_id, sign, channel", R.EVENT_ROLES),
    values("ttypes", "transaction_type_id, type_name", S.TRANSACTION_TYPES),
    f"""se AS (
      SELECT e.event_id, e.user_id, e.ts, e.event_type, r.transaction_type_id,
             t.type_name AS transaction_type, r.sign, r.channel,
             CASE WHEN r.sign < 0 THEN -{cents('e.value')} ELSE {cents('e.value')} END AS amount_cents,
             e.props
      FROM events e JOIN roles r ON e.event_type = r.event_type
      JOIN ttypes t ON r.transaction_type_id = t.transaction_type_id)"""])

PERIOD = "se.ts >= TIMESTAMP '2023-02-01' AND se.ts < TIMESTAMP '2024-02-01'"

LOANS_CTE = ", ".join([
    values("prio", "code, id", R.ORDER_PRIORITY_ROLES),
    values("stat", "code, id", R.ORDER_STATUS_ROLES),
    values("ltypes", "loan_type_id, type_name", S.LOAN_TYPES),
    values("lstatus", "status_id, status_name", S.LOAN_STATUS_TYPES),
    """loans AS (
      SELECT o.*, p.id AS loan_type_id, s.id AS loan_status_id,
             lt.type_name AS loan_type, ls.status_name AS loan_status
      FROM orders o JOIN prio p ON o.o_orderpriority = p.code
      JOIN stat s ON o.o_orderstatus = s.code
      JOIN ltypes lt ON p.id = lt.loan_type_id
      JOIN lstatus ls ON s.id = ls.status_id)""",
    f"""terms AS (
      SELECT l_orderkey, CAST(count(*) * {R.TERM_MONTHS_PER_LINE} AS INTEGER) AS term
      FROM lineitem GROUP BY l_orderkey)"""])

LINE_SLICE = """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice,
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem WHERE l_shipdate >= TIMESTAMP '{lo}' AND l_shipdate < TIMESTAMP '{hi}'"""

WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _rule_union(table: str, rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(count(*) FILTER (WHERE coalesce({cond}, false)) AS BIGINT) AS n_bad FROM {table}"
        for name, cond in rules)


# the faults of the documents in ``document_checks``
_ABSENT = {"_id": "event_id % 37 = 0", "customer_id": "event_id % 41 = 0", "date": "event_id % 13 = 0 AND event_id % 19 <> 0",
           "amount": "event_type <> 'error' AND event_id % 43 = 0", "type": "event_id % 47 = 0", "payment_method": "event_type = 'click'"}
_RETYPED = {"_id": "event_id % 37 <> 0 AND event_id % 17 = 0", "customer_id": "event_id % 41 <> 0 AND event_id % 10 = 0",
            "account_id": "event_id % 11 = 0", "date": "event_id % 19 = 0", "amount": "event_type = 'error'",
            "type": "event_id % 47 <> 0 AND event_id % 23 = 0", "payment_method": "event_type <> 'click' AND event_id % 29 = 0"}


def _fk(name, child, fk, parent, pk):
    return (f"SELECT '{name}' AS relation, CAST(count(*) AS BIGINT) AS n_orphans FROM {child} c "
            f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")


ORACLE_SQL = {
    "latest_balance": """
        WITH ranked AS (
          SELECT o_custkey AS account_id, o_totalprice AS balance_after,
                 row_number() OVER (PARTITION BY o_custkey
                                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders)
        SELECT account_id, balance_after FROM ranked WHERE rn = 1""",
    "latest_balance_agg": """
        SELECT o_custkey AS account_id,
               arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS balance_after
        FROM orders GROUP BY o_custkey""",
    "latest_balance_sql": """
        SELECT o_custkey AS account_id, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS balance_after
        FROM orders GROUP BY o_custkey""",
    "sql_functions": """
        SELECT o.o_orderkey, '****' || right(c.c_name, 4) AS number,
               '****' || right(c.c_name, 3) AS phone_number,
               '****' || CAST(((('0x' || substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 8))::BIGINT) % 9000 + 1000) AS VARCHAR) AS card_number,
               CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date_id
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "latest_child": """
        WITH n AS (
          SELECT user_id, event_id, ts, event_type, value,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM events)
        SELECT c.c_custkey, c.c_name, n.event_id, n.ts, n.event_type, n.value
        FROM customer c LEFT JOIN n ON n.user_id = c.c_custkey AND n.rn = 1""",
    "scan_parquet": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "scan_month_range": LINE_SLICE.format(lo="1998-11-01", hi="1999-05-01"),
    "scan_missing_month": LINE_SLICE.format(lo="2001-11-01", hi="2002-02-01"),
    "csv_round_trip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "partitioned_month_scan": """
        SELECT l_orderkey, l_linenumber, l_shipdate,
               CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-11-01' AND l_shipdate < TIMESTAMP '1999-05-01'""",
    "union_slices": """
        SELECT l_orderkey, l_linenumber, l_shipdate, 1996 AS year FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_shipdate, 1997 AS year FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'""",
    "payments_6m": """
        SELECT l_orderkey AS loan_id, l_linenumber AS line, CAST(l_shipdate AS DATE) AS paid_date,
               CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS paid_date_id,
               l_extendedprice AS payment_amount,
               CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
        FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1998-10-01' AND l_shipdate < TIMESTAMP '1999-10-01'""",
    "transactions_12m": """
        SELECT o_orderkey AS transaction_id, o_custkey AS account_id,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
               o_orderdate AS timestamp, o_orderpriority AS type, o_totalprice AS amount,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-09-01' AND o_orderdate < TIMESTAMP '1998-09-01'""",
    "landing_accounts": f"""
        WITH {values('seg', 'c_mktsegment, type', R.SEGMENT_ACCOUNT_TYPES)},
             {values('atypes', 'account_type_id, type_name', S.ACCOUNT_TYPES)},
             {values('astatus', 'status_id, status_name', S.ACCOUNT_STATUS_TYPES)}
        SELECT printf('ACC%07d', c.c_custkey) AS account_id, printf('CUS%07d', c.c_custkey) AS customer_id,
               printf('BRA%07d', c.c_nationkey) AS branch_id, aty.type_name AS type, st.status_name AS status,
               '****' || right(lpad(CAST(c.c_custkey AS VARCHAR), 12, '0'), 4) AS number,
               {cents('c.c_acctbal')} AS balance, 0 AS min_balance,
               NULL::DATE AS date_opened, NULL::DATE AS date_closed
        FROM customer c JOIN seg ON c.c_mktsegment = seg.c_mktsegment
        JOIN atypes aty ON seg.type = aty.account_type_id
        JOIN astatus st ON (CASE WHEN c.c_acctbal < 0 THEN 2 ELSE 1 END) = st.status_id""",
    "landing_transactions": f"""
        WITH {SE_CTE}
        SELECT printf('TXN%010d', event_id) AS transaction_id, printf('ACC%07d', user_id) AS account_id,
               NULL::VARCHAR AS employee_id, 'VND' AS currency, ts AS date, amount_cents AS amount,
               NULL::BIGINT AS balance_after, transaction_type,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day
        FROM se""",
    "landing_loans": f"""
        WITH {LOANS_CTE}
        SELECT printf('LOA%07d', o_orderkey) AS loan_id, printf('CUS%07d', o_custkey) AS customer_id,
               {cents('o_totalprice')} AS amount, 'VND' AS currency, CAST(o_orderdate AS DATE) AS start_date,
               loan_type, loan_status
        FROM loans""",
    "landing_cards": f"""
        WITH {values('roles', 'p_type, card_type_id', R.PART_TYPE_ROLES)},
             {values('ctypes', 'card_type_id, type_name, monthly_fee, interest_rate', S.CARD_TYPES)}
        SELECT printf('CRD%07d', p.p_partkey) AS card_id, p.p_size AS monthly_fee, c.type_name AS card_type,
               '****' || CAST(((('0x' || substr(md5(printf('CRD%07d', p.p_partkey)), 1, 8))::BIGINT) % 9000 + 1000) AS VARCHAR) AS number
        FROM part p JOIN roles r ON p.p_type = r.p_type
        JOIN ctypes c ON r.card_type_id = c.card_type_id""",
    "star_fact_transactions": f"""
        SELECT printf('TXN%010d', o_orderkey) AS transaction_id, printf('ACC%07d', o_custkey) AS account_id,
               NULL::VARCHAR AS employee_id,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, o_orderdate AS timestamp,
               'VND' AS currency, o_orderpriority AS type,
               {cents('o_totalprice')} AS amount, {cents('o_totalprice')} AS balance_after,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
        FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-09-01' AND o_orderdate < TIMESTAMP '1998-09-01'""",
    "star_fact_loan_payments": f"""
        WITH p AS (
          SELECT 'PAY' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS payment_id,
                 printf('LOA%07d', l_orderkey) AS loan_id, NULL::VARCHAR AS transaction_id,
                 {cents('l_extendedprice')} AS payment_amount,
                 CAST(l_shipdate AS DATE) - 3 AS scheduled_payment_date,
                 CAST(l_shipdate AS DATE) AS payment_date,
                 {cents('l_extendedprice * (1 - l_discount)')} AS principal_amount,
                 {cents('l_extendedprice')} AS paid_amount,
                 CAST(l_shipdate AS DATE) AS paid_date
          FROM lineitem
          WHERE l_shipdate >= TIMESTAMP '1998-10-01' AND l_shipdate < TIMESTAMP '1999-11-01')
        SELECT payment_id, loan_id, transaction_id,
               CAST(strftime(scheduled_payment_date, '%Y%m%d') AS INTEGER) AS scheduled_payment_date_id,
               CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS payment_date_id,
               CAST(strftime(paid_date, '%Y%m%d') AS INTEGER) AS paid_date_id,
               payment_amount, principal_amount, paid_amount, scheduled_payment_date, payment_date, paid_date,
               CAST(year(paid_date) AS INTEGER) AS year, CAST(month(paid_date) AS INTEGER) AS month
        FROM p""",
    "star_dim_customers": f"""
        SELECT printf('CUS%07d', c.c_custkey) AS customer_id, c.c_name AS name, 'Việt Nam' AS country,
               r.r_name AS city, n.n_name AS street, '****' || right(c.c_name, 3) AS phone_number,
               NULL::DATE AS registration_date, NULL::VARCHAR AS email, c.c_mktsegment AS customer_type,
               CASE WHEN c.c_acctbal < 0 THEN 'Tạm khóa' ELSE 'Hoạt động' END AS status,
               TIMESTAMP '{R.AUDIT_TS}' AS created_at, TIMESTAMP '{R.AUDIT_TS}' AS updated_at,
               true AS is_active
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "conform_accounts": """
        SELECT c.c_custkey AS account_id, n.n_name AS type, r.r_name AS status,
               '****' || right(c.c_name, 4) AS number, c.c_acctbal AS balance
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "conform_customers": """
        SELECT s.s_suppkey, s.s_name, s.s_acctbal, n.n_name AS customer_type, r.r_name AS status,
               '****' || right(s.s_name, 3) AS phone_number
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "conform_cards": f"""
        WITH {values('roles', 'p_type, card_type_id', R.PART_TYPE_ROLES)},
             {values('ctypes', 'card_type_id, type_name, monthly_fee, interest_rate', S.CARD_TYPES)}
        SELECT p.p_partkey AS card_id, c.type_name AS card_type,
               CAST(c.monthly_fee AS INTEGER) AS monthly_fee,
               CAST(c.interest_rate AS DOUBLE) AS interest_rate,
               '****' || CAST(((('0x' || substr(md5(CAST(p.p_partkey AS VARCHAR)), 1, 8))::BIGINT) % 9000 + 1000) AS VARCHAR) AS number
        FROM part p JOIN roles r ON p.p_type = r.p_type
        JOIN ctypes c ON r.card_type_id = c.card_type_id""",
    "conform_loans": f"""
        WITH {LOANS_CTE}
        SELECT o_orderkey AS loan_id, o_custkey AS customer_id, o_totalprice AS amount,
               CAST(o_orderdate AS DATE) AS start_date, loan_type, loan_status
        FROM loans""",
    "conform_transactions": f"""
        WITH {SE_CTE}
        SELECT event_id AS transaction_id, user_id AS account_id, transaction_type, amount_cents,
               ts AS date, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day
        FROM se""",
    "dim_audit": f"""
        SELECT s_suppkey AS branch_id, s_name AS name,
               TIMESTAMP '{R.AUDIT_TS}' AS created_at, TIMESTAMP '{R.AUDIT_TS}' AS updated_at,
               true AS is_active
        FROM supplier""",
    "customer360_one": """
        SELECT c.c_custkey, c.c_name,
               (SELECT count(*) FROM orders WHERE o_custkey = 7) AS n_loans,
               CAST(coalesce((SELECT sum(CAST(round(o_totalprice * 100) AS BIGINT)) FROM orders
                              WHERE o_custkey = 7), 0) AS BIGINT) AS loans_total_cents,
               (SELECT count(*) FROM events WHERE user_id = 7) AS n_transactions,
               CAST(coalesce((SELECT sum(CAST(round(value * 100) AS BIGINT)) FROM events
                              WHERE user_id = 7), 0) AS BIGINT) AS tx_total_cents,
               (SELECT arg_max(event_id, (ts, event_id)) FROM events WHERE user_id = 7)
                 AS latest_event_id
        FROM customer c WHERE c.c_custkey = 7""",
    "customer360_summary": f"""
        WITH l AS (SELECT o_custkey, count(*) AS n_loans,
                          CAST(sum({cents('o_totalprice')}) AS BIGINT) AS loans_total_cents
                   FROM orders GROUP BY o_custkey),
        t AS (SELECT user_id, count(*) AS n_transactions,
                     CAST(sum({cents('value')}) AS BIGINT) AS tx_total_cents,
                     arg_max(event_id, (ts, event_id)) AS latest_event_id
              FROM events GROUP BY user_id)
        SELECT c.c_custkey, c.c_name, coalesce(l.n_loans, 0) AS n_loans,
               coalesce(l.loans_total_cents, 0) AS loans_total_cents,
               coalesce(t.n_transactions, 0) AS n_transactions,
               coalesce(t.tx_total_cents, 0) AS tx_total_cents, t.latest_event_id
        FROM customer c LEFT JOIN l ON l.o_custkey = c.c_custkey
        LEFT JOIN t ON t.user_id = c.c_custkey""",
    "customer360_arrays": """
        SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice, o.o_orderstatus
        FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey""",
    "customer360_tx": """
        SELECT c.c_custkey, e.event_id, e.ts, e.value
        FROM customer c LEFT JOIN events e ON e.user_id = c.c_custkey""",
    "customer360_tx_chunks": """
        WITH r AS (SELECT user_id, event_id,
                          row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos
                   FROM events)
        SELECT user_id, CAST(pos // 16 AS BIGINT) AS chunk, count(*) AS n,
               arg_min(event_id, pos) AS first_event_id, arg_max(event_id, pos) AS last_event_id
        FROM r GROUP BY user_id, pos // 16""",
    "id_array_lookup": """
        WITH ids AS (SELECT DISTINCT event_id, unnest([user_id, CAST(json_extract_string(props, '$.k') AS BIGINT)]) AS id
                     FROM events),
        m AS (SELECT ids.event_id, c.c_custkey AS account_id, c.c_name AS name, c.c_acctbal AS balance
              FROM ids JOIN customer c ON c.c_custkey = ids.id)
        SELECT * FROM m
        UNION ALL
        SELECT e.event_id, NULL::BIGINT, NULL::VARCHAR, NULL::DOUBLE FROM events e
        WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.event_id = e.event_id)""",
    "customer_analytics": f"""
        WITH {SE_CTE}
        SELECT user_id, CAST(count(*) AS INTEGER) AS total_transactions,
               CAST(coalesce(sum(amount_cents) FILTER (WHERE amount_cents > 0), 0) AS BIGINT) AS total_inflow,
               CAST(coalesce(sum(-amount_cents) FILTER (WHERE amount_cents < 0), 0) AS BIGINT) AS total_outflow,
               CAST(coalesce(sum(amount_cents) FILTER (WHERE amount_cents > 0), 0)
                    - coalesce(sum(-amount_cents) FILTER (WHERE amount_cents < 0), 0) AS BIGINT) AS net_cashflow,
               CAST(floor(count(*) / 12) AS INTEGER) AS avg_monthly_transactions
        FROM se WHERE {PERIOD} GROUP BY user_id""",
    "spending_by_type": f"""
        WITH {SE_CTE},
        g AS (SELECT user_id, transaction_type AS type, CAST(count(*) AS INTEGER) AS count,
                     CAST(sum(abs(amount_cents)) AS BIGINT) AS amount_cents
              FROM se WHERE {PERIOD} GROUP BY user_id, transaction_type)
        SELECT user_id, type, count, amount_cents,
               CAST(amount_cents AS DOUBLE) / CAST(sum(amount_cents) OVER (PARTITION BY user_id) AS DOUBLE) * 100 AS percentage
        FROM g""",
    "spending_by_channel": f"""
        WITH {SE_CTE}
        SELECT user_id,
               CAST(sum(CASE WHEN channel = 'branch' THEN abs(amount_cents) ELSE 0 END) AS DOUBLE)
                 / CAST(sum(abs(amount_cents)) AS DOUBLE) * 100 AS branch,
               CAST(sum(CASE WHEN channel = 'atm' THEN abs(amount_cents) ELSE 0 END) AS DOUBLE)
                 / CAST(sum(abs(amount_cents)) AS DOUBLE) * 100 AS atm,
               CAST(sum(CASE WHEN channel = 'online' THEN abs(amount_cents) ELSE 0 END) AS DOUBLE)
                 / CAST(sum(abs(amount_cents)) AS DOUBLE) * 100 AS online
        FROM se WHERE {PERIOD} GROUP BY user_id""",
    "analytics_documents": f"""
        WITH {SE_CTE},
        p AS (SELECT user_id, transaction_type, channel, amount_cents / CAST(100.0 AS DOUBLE) AS amount
              FROM se WHERE {PERIOD}),
        flow AS (SELECT user_id, CAST(count(*) AS INTEGER) AS total_transactions,
                        coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS inflow,
                        coalesce(sum(-amount) FILTER (WHERE amount < 0), 0) AS outflow
                 FROM p GROUP BY user_id),
        ch AS (SELECT user_id,
                      sum(CASE WHEN channel = 'branch' THEN abs(amount) ELSE 0 END) / sum(abs(amount)) * 100 AS branch,
                      sum(CASE WHEN channel = 'atm' THEN abs(amount) ELSE 0 END) / sum(abs(amount)) * 100 AS atm,
                      sum(CASE WHEN channel = 'online' THEN abs(amount) ELSE 0 END) / sum(abs(amount)) * 100 AS online
               FROM p GROUP BY user_id),
        ty AS (SELECT user_id, count(DISTINCT transaction_type) AS n_types FROM p GROUP BY user_id)
        SELECT CAST(f.user_id AS VARCHAR) AS customer_id, CAST(f.user_id AS VARCHAR) || '_202401' AS doc_id,
               f.total_transactions, round(f.inflow, 2) AS total_inflow, round(f.outflow, 2) AS total_outflow,
               round(f.inflow - f.outflow, 2) AS net_cashflow,
               CAST(floor(f.total_transactions / 12) AS INTEGER) AS avg_monthly_transactions,
               CAST(ty.n_types AS INTEGER) AS n_types,
               round(ch.branch, 1) AS branch, round(ch.atm, 1) AS atm, round(ch.online, 1) AS online,
               TIMESTAMP '{R.EVENTS_AS_OF}' AS last_updated
        FROM flow f JOIN ch ON f.user_id = ch.user_id JOIN ty ON f.user_id = ty.user_id""",
    "max_id": """
        SELECT 'customer' AS table_name,
               CAST(coalesce(max(TRY_CAST(CASE WHEN starts_with(c_name, 'Customer#')
                   THEN substr(c_name, 10) ELSE c_name END AS BIGINT)), 0) AS BIGINT) AS max_id
        FROM customer
        UNION ALL
        SELECT 'supplier' AS table_name,
               CAST(coalesce(max(TRY_CAST(CASE WHEN starts_with(s_name, 'Supplier#')
                   THEN substr(s_name, 10) ELSE s_name END AS BIGINT)), 0) AS BIGINT) AS max_id
        FROM supplier""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                  "events", "documents", "embeddings", "pages", "benchmark", "labels",
                  "conversations"]),
    "duplicate_keys": """
        SELECT o_custkey AS customer_id, o_orderdate AS date, count(*) AS n
        FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1""",
    "fk_orphans": " UNION ALL ".join([
        _fk(f"{c}.{fk}->{p}", c, fk, f"(SELECT * FROM {p} WHERE {R.PARENT_FILTERS[p]})", pk) for c, fk, p, pk in [
            ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey"), ("events", "user_id", "customer", "c_custkey")]]),
    "required_fields": " UNION ALL ".join(
        _rule_union(t, [(f"{t}.required:{c}", f"({e}) IS NULL") for c, e in cols.items()]) for t, cols in R.MISSING.items()),
    "type_check": " UNION ALL ".join([
        _rule_union("""(SELECT CASE WHEN event_id % 10 = 3 THEN 'k' || json_extract_string(props, '$.k') ELSE json_extract_string(props, '$.k') END AS props_k,
                            CASE WHEN event_type = 'error' THEN replace(CAST(value AS VARCHAR), '.', ',') ELSE CAST(value AS VARCHAR) END AS value_text FROM events)""",
                    [("events.type:props_k:int", "props_k IS NOT NULL AND TRY_CAST(props_k AS INTEGER) IS NULL"),
                     ("events.type:value_text:double", "value_text IS NOT NULL AND TRY_CAST(value_text AS DOUBLE) IS NULL")]),
        _rule_union("(SELECT c_name, CAST(c_acctbal AS VARCHAR) || CASE WHEN c_mktsegment = 'BUILDING' THEN ' VND' ELSE '' END AS bal FROM customer)",
                    [("customer.type:c_name:bigint", "c_name IS NOT NULL AND TRY_CAST(c_name AS BIGINT) IS NULL"),
                     ("customer.type:bal:double", "bal IS NOT NULL AND TRY_CAST(bal AS DOUBLE) IS NULL")])]),
    "id_pattern": " UNION ALL ".join(
        _rule_union(t, [(f"{t}.{n}_id", f"NOT regexp_matches('{p}' || CAST({k} * {x} AS VARCHAR), '^{p}[0-9]{{{w}}}$')")])
        for t, k, n, p, x, w in [("customer", "c_custkey", "customer", "CUS", 10_000, 7), ("supplier", "s_suppkey", "branch", "BRA", 50_000, 7),
                                 ("orders", "o_orderkey", "transaction", "TXN", 1_000_000, 10)]),
    "amount_range": f"""
        WITH {SE_CTE}, {values('rules', 'transaction_type_id, lo, hi', R.EVENT_AMOUNT_RULES)}
        SELECT transaction_type,
               count(*) FILTER (WHERE NOT (abs(amount_cents) / CAST(100.0 AS DOUBLE) BETWEEN lo AND hi)) AS n_bad,
               count(*) AS n_rows
        FROM se JOIN rules ON se.transaction_type_id = rules.transaction_type_id
        GROUP BY transaction_type""",
    "amount_sign": f"""
        WITH {SE_CTE}
        SELECT transaction_type,
               count(*) FILTER (WHERE (sign < 0 AND raw > 0) OR (sign > 0 AND raw < 0)) AS n_bad
        FROM (SELECT *, abs(amount_cents) - {R.EVENT_FEE_CENTS} AS raw FROM se) GROUP BY transaction_type""",
    "balance_range": f"""
        WITH {values('rules', 'c_mktsegment, lo, hi, min_balance', R.SEGMENT_BALANCE_RULES)}
        SELECT c.c_mktsegment, count(*) FILTER (WHERE r.lo IS NULL) AS n_unknown_segment,
               count(*) FILTER (WHERE NOT (c.c_acctbal BETWEEN r.lo AND r.hi)) AS n_out_of_range,
               count(*) FILTER (WHERE c.c_acctbal < r.min_balance) AS n_under_minimum
        FROM customer c LEFT JOIN rules r ON c.c_mktsegment = r.c_mktsegment
        GROUP BY c.c_mktsegment""",
    "date_order": _rule_union(
        "(SELECT l.l_shipdate, o.o_orderdate FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)",
        [("ship_before_order", "l_shipdate < o_orderdate"),
         ("ship_over_year_after_order", "l_shipdate > CAST(o_orderdate AS DATE) + 365")]),
    "date_add": f"""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS issue_date,
               CAST(o_orderdate AS DATE) + {S.CARD_VALID_DAYS} AS expiration_date,
               CAST(o_orderdate AS DATE) + 30 AS due_date
        FROM orders""",
    "loan_rules": f"""
        WITH {LOANS_CTE}, {values('ranges', 'loan_type_id, lo, hi', R.ORDER_AMOUNT_RULES)},
        j AS (SELECT o.o_totalprice, t.term, r.lo, r.hi FROM orders o LEFT JOIN prio p ON o.o_orderpriority = p.code
              LEFT JOIN ranges r ON p.id = r.loan_type_id LEFT JOIN terms t ON o.o_orderkey = t.l_orderkey)
        """ + _rule_union("j", [
        ("unknown_type", "lo IS NULL"), ("no_term", "term IS NULL"),
        ("term_not_allowed", f"term NOT IN ({', '.join(map(str, S.LOAN_TERMS))})"),
        ("amount_out_of_range", "NOT (o_totalprice BETWEEN lo AND hi)")]),
    "payment_rules": f"""
        WITH {LOANS_CTE},
        ln AS (SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice / t.term AS installment
               FROM orders o JOIN terms t ON o.o_orderkey = t.l_orderkey WHERE o.o_orderstatus <> 'F'),
        j AS (SELECT l.l_extendedprice, l.l_shipdate, ln.o_orderkey, ln.o_orderdate, ln.installment
              FROM lineitem l LEFT JOIN ln ON l.l_orderkey = ln.o_orderkey)
        """ + _rule_union("j", [
        ("unknown_loan", "o_orderkey IS NULL"),
        ("payment_ratio", f"NOT (l_extendedprice / installment BETWEEN CAST({S.PAYMENT_RATIO[0]} AS DOUBLE) AND CAST({S.PAYMENT_RATIO[1]} AS DOUBLE))"),
        ("paid_before_start", "l_shipdate < o_orderdate"),
        ("paid_in_future", f"l_shipdate > TIMESTAMP '{R.LINEITEM_AS_OF}'")]),
    "allowed_values": " UNION ALL ".join(
        _rule_union(t, [(f"{t}.{c}", f"{c} NOT IN ({', '.join(map(_lit, allowed))})") for c, allowed in cols.items()])
        for t, cols in R.ALLOWED.items()),
    "date_parts": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
        FROM orders""",
    "date_key": "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id FROM orders",
    "dim_date": """
        WITH b AS (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem),
        d AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS full_date FROM b)
        SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, full_date,
               CAST(day(full_date) AS INTEGER) AS day, CAST(month(full_date) AS INTEGER) AS month,
               CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
               CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week, isodow(full_date) >= 6 AS is_weekend
        FROM d""",
    "mask_account": "SELECT c_custkey, '****' || right(c_name, 4) AS number FROM customer",
    "mask_phone": "SELECT s_suppkey, '****' || right(s_name, 3) AS phone_number FROM supplier",
    "mask_card": """
        SELECT p_partkey, '****' || CAST(((('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8))::BIGINT) % 9000 + 1000) AS VARCHAR) AS number
        FROM part""",
    "format_id": """
        SELECT o_orderkey, printf('CUS%07d', o_custkey) AS customer_id,
               printf('TXN%010d', o_orderkey) AS transaction_id
        FROM orders""",
    "clean_text": f"SELECT doc_id, trim(replace(text, chr(10), ' '), {WS}) AS text FROM documents",
    "filter_contains": """
        SELECT page_id, url FROM pages
        WHERE starts_with(url, 'https://') AND (contains(url, '/fr/') OR contains(url, '/de/'))""",
    "filter_type": f"WITH {SE_CTE} SELECT event_id, user_id, amount_cents FROM se WHERE transaction_type_id = 4",
    "balance_after": f"""
        WITH {SE_CTE},
        acc AS (SELECT c_custkey, {cents('c_acctbal')} AS open_cents FROM customer),
        j AS (SELECT se.*, acc.open_cents,
                     (acc.open_cents + se.amount_cents < 0 AND se.transaction_type_id IN (2, 3)) AS flip
              FROM se JOIN acc ON se.user_id = acc.c_custkey)
        SELECT event_id, user_id,
               CASE WHEN flip THEN -amount_cents ELSE amount_cents END AS amount_applied,
               open_cents + CASE WHEN flip THEN -amount_cents ELSE amount_cents END AS balance_after,
               flip AS overdraft_flip
        FROM j""",
    "normalize_status": f"""
        SELECT o_orderkey,
               CASE WHEN raw = '3' THEN {_lit(S.PAID_STATUS_NAME)}
                    WHEN raw = 'O' THEN {_lit(dict(S.LOAN_STATUS_TYPES)[1])}
                    WHEN raw = 'P' THEN {_lit(dict(S.LOAN_STATUS_TYPES)[2])}
                    ELSE raw END AS status
        FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '3' ELSE o_orderstatus END AS raw
              FROM orders)""",
    "conditional_null": f"""
        WITH {SE_CTE}
        SELECT event_id,
               CASE WHEN transaction_type_id = 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END
                 AS receiver_account_id
        FROM se""",
    "round_even": """
        SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice, 0) AS BIGINT) AS amount,
               CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS half_qty
        FROM lineitem""",
    "date_cap": f"""
        SELECT l_orderkey, l_linenumber,
               least(CAST(l_shipdate AS DATE) + 15, DATE '{R.LINEITEM_AS_OF}') AS paid_date
        FROM lineitem""",
    "date_format": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date_text FROM orders",
    "array_first": """
        SELECT doc_id, string_split(text, chr(10))[1] AS first_line,
               [x FOR x IN string_split(text, chr(10)) IF length(x) > 200][1] AS first_long_line
        FROM documents""",
    "stream_envelope": f"""
        WITH {SE_CTE}
        SELECT CAST(user_id AS VARCHAR) AS key,
               CAST(json_object('transaction_id', event_id, 'account_id', CAST(user_id AS VARCHAR),
                                'type', transaction_type, 'amount', amount_cents,
                                'date', strftime(ts, '%Y-%m-%dT%H:%M:%S'),
                                'k', CAST(json_extract(props, '$.k') AS INTEGER)) AS VARCHAR) AS value
        FROM se""",
    "tenure_months": f"""
        SELECT o_orderkey, CAST(datesub('month', o_orderdate, TIMESTAMP '{R.TENURE_AS_OF}') AS INTEGER) AS months
        FROM orders""",
    "credit_utilisation": f"""
        WITH op AS (SELECT l_orderkey, CAST(sum({cents('l_extendedprice')}) AS BIGINT) AS out_cents
                    FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey),
        o AS (SELECT o_orderkey, {cents('o_totalprice')} AS limit_cents FROM orders)
        SELECT o.o_orderkey, o.limit_cents AS credit_limit,
               coalesce(op.out_cents, 0) AS outstanding_balance,
               o.limit_cents - coalesce(op.out_cents, 0) AS available_credit,
               CAST(coalesce(op.out_cents, 0) AS DOUBLE) / CAST(o.limit_cents AS DOUBLE) * 100 AS utilisation
        FROM o LEFT JOIN op ON o.o_orderkey = op.l_orderkey""",
    "loan_installment": f"""
        WITH {LOANS_CTE}
        SELECT o.o_orderkey, t.term, o.o_totalprice / t.term AS monthly_payment
        FROM orders o JOIN terms t ON o.o_orderkey = t.l_orderkey""",
    "lookup_default": f"""
        WITH {SE_CTE}, {values('partial', 'transaction_type_id, range_name',
                               [(1, 'deposit'), (2, 'withdrawal'), (3, 'transfer'), (5, 'interest')])}
        SELECT se.event_id, coalesce(p.range_name, 'transfer') AS range_name
        FROM se LEFT JOIN partial p ON se.transaction_type_id = p.transaction_type_id""",
    "next_ids": """
        SELECT event_id,
               printf('TXN%010d', (SELECT max(o_orderkey) FROM orders)
                                  + row_number() OVER (ORDER BY ts, event_id)) AS transaction_id
        FROM events""",
    "sequence_id": """
        SELECT s_suppkey, s_name, printf('BRA%07d', row_number() OVER (ORDER BY s_suppkey)) AS branch_id
        FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2))""",
    "running_balance": f"""
        WITH {SE_CTE},
        acc AS (SELECT c_custkey, {cents('c_acctbal')} AS open_cents FROM customer)
        SELECT se.event_id, se.user_id,
               CAST(coalesce(acc.open_cents, 0) + sum(se.amount_cents) OVER (
                    PARTITION BY se.user_id ORDER BY se.ts, se.event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_balance
        FROM se LEFT JOIN acc ON se.user_id = acc.c_custkey""",
    "stream_balance_after": f"""
        WITH {SE_CTE},
        acc AS (SELECT c_custkey, {cents('c_acctbal')} AS open_cents FROM customer)
        SELECT se.event_id, se.user_id,
               CAST(coalesce(acc.open_cents, 0) + sum(se.amount_cents) OVER (
                    PARTITION BY se.user_id ORDER BY se.ts, se.event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS balance_after
        FROM se LEFT JOIN acc ON se.user_id = acc.c_custkey""",
    "running_balance_ranges": f"""
        WITH {SE_CTE},
        e AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN user_id END AS user_id,
                     CASE WHEN event_id % 5 <> 0 THEN ts END AS ts,
                     CASE WHEN event_id % 7 <> 0 THEN amount_cents ELSE 0 END AS amount_cents FROM se)
        SELECT event_id, user_id,
               CAST(sum(amount_cents) OVER (
                    PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_balance
        FROM e""",
    "stream_transactions": f"""
        WITH {SE_CTE}
        SELECT printf('TXN%010d', event_id) AS transaction_id, printf('ACC%07d', user_id) AS account_id,
               transaction_type AS type, 'VND' AS currency, amount_cents AS amount,
               date_trunc('second', ts) AS timestamp
        FROM se""",
    "stream_ingest": f"""
        WITH {SE_CTE}
        SELECT printf('TXN%010d', event_id) AS transaction_id, printf('ACC%07d', user_id) AS account_id,
               NULL::VARCHAR AS employee_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id,
               date_trunc('second', ts) AS timestamp, 'VND' AS currency, transaction_type AS type,
               amount_cents AS amount, NULL::BIGINT AS balance_after,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
        FROM se""",
    "stream_latest_balance": """
        SELECT user_id AS account_id, arg_max(value, (ts, event_id)) AS balance_after
        FROM events GROUP BY user_id""",
    "stream_running_balance": f"""
        WITH {SE_CTE},
        acc AS (SELECT c_custkey, {cents('c_acctbal')} AS open_cents FROM customer)
        SELECT se.user_id, count(*) AS n_events,
               CAST(coalesce(any_value(acc.open_cents), 0) + sum(se.amount_cents) AS BIGINT) AS balance_cents
        FROM se LEFT JOIN acc ON se.user_id = acc.c_custkey GROUP BY se.user_id""",
    "stream_dedup": "SELECT DISTINCT event_id, user_id, ts, event_type, value FROM events",
    "stream_dedup_watermark": "SELECT DISTINCT event_id, user_id, ts, event_type, value FROM events",
    "stream_enrich": f"""
        WITH {SE_CTE}
        SELECT se.event_id, se.user_id, se.transaction_type, c.c_nationkey
        FROM se JOIN customer c ON se.user_id = c.c_custkey""",
}

_BRANCHES = """SELECT printf('BRA%07d', s_suppkey) AS branch_id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS address,
       lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS phone_number FROM supplier"""
_EMPLOYEES = """SELECT printf('EMP%07d', c_custkey) AS employee_id, c_name AS name, c_mktsegment AS position,
       printf('BRA%07d', c_nationkey) AS branch_id FROM customer"""
_AUDIT = f"TIMESTAMP '{R.AUDIT_TS}' AS created_at, TIMESTAMP '{R.AUDIT_TS}' AS updated_at, true AS is_active"
_PAYMENTS = f"""SELECT 'PAY' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS payment_id,
       printf('LOA%07d', l_orderkey) AS loan_id, NULL::VARCHAR AS transaction_id,
       {cents('l_extendedprice')} AS payment_amount, CAST(l_shipdate AS DATE) - 3 AS scheduled_payment_date,
       CAST(l_shipdate AS DATE) AS payment_date, {cents('l_extendedprice * (1 - l_discount)')} AS principal_amount,
       {cents('l_extendedprice')} AS paid_amount, CAST(l_shipdate AS DATE) AS paid_date FROM lineitem"""
_TERMS = "[" + ", ".join(map(str, S.LOAN_TERMS)) + "]"

# B2, B6, B7, B9-B11, B13, B14, K1-K6, S1, S2, S6, S9, S10, R3, R6, F17
ORACLE_SQL |= {
    "landing_customers": f"""
        WITH {values('ct', 'id, type_name', S.CUSTOMER_TYPES)}, {values('cs', 'id, status_name', S.CUSTOMER_STATUS_TYPES)}
        SELECT printf('CUS%07d', c.c_custkey) AS customer_id, c.c_name AS name, {_lit(S.COUNTRY)} AS country,
               c.c_mktsegment AS city, NULL::VARCHAR AS street,
               '****' || right(lpad(CAST(c.c_custkey AS VARCHAR), 10, '0'), 3) AS phone_number,
               NULL::DATE AS registration_date, NULL::VARCHAR AS email, ct.type_name AS customer_type, cs.status_name AS status
        FROM customer c JOIN ct ON c.c_nationkey % 4 = ct.id
        JOIN cs ON (CASE WHEN c.c_acctbal < 0 THEN 2 ELSE 1 END) = cs.id""",
    "landing_loan_payments": f"""
        SELECT *, CAST(year(paid_date) AS INTEGER) AS year, CAST(month(paid_date) AS INTEGER) AS month,
               CAST(day(paid_date) AS INTEGER) AS day FROM ({_PAYMENTS})""",
    "landing_files": f"""
        SELECT 'employee' AS kind, employee_id AS id, name, position AS detail, branch_id FROM ({_EMPLOYEES})
        UNION ALL SELECT 'branch', branch_id, name, address || ' ' || phone_number, branch_id FROM ({_BRANCHES})""",
    "star_dim_accounts": f"""
        SELECT account_id, customer_id, branch_id, type, status, number, CAST(min_balance AS INTEGER) AS min_balance,
               date_opened, date_closed FROM ({ORACLE_SQL['landing_accounts']})""",
    "star_dim_branches": f"SELECT *, {_AUDIT} FROM ({_BRANCHES})",
    "star_dim_employees": f"SELECT *, {_AUDIT} FROM ({_EMPLOYEES})",
    "star_dim_cards": f"""
        SELECT card_id, 'ACC' || substr(card_id, 4, 7) AS account_id, CAST(monthly_fee AS INTEGER) AS monthly_fee,
               CAST((n % 8) / 4 AS FLOAT) AS interest_rate, DATE '2020-01-01' + n % 1000 + {S.CARD_VALID_DAYS} AS expiration_date,
               DATE '2020-01-01' + n % 1000 AS issuance_date, card_type, number
        FROM (SELECT *, CAST(substr(card_id, 4, 7) AS INTEGER) AS n FROM ({ORACLE_SQL['landing_cards']}))""",
    "star_dim_loans": f"""
        SELECT loan_id, customer_id, amount, CAST(6 + (n % 36) / 4 AS FLOAT) AS interest_rate, term, start_date,
               start_date + term * 30 AS end_date, loan_type AS type, loan_status AS status
        FROM (SELECT *, {_TERMS}[n % {len(S.LOAN_TERMS)} + 1] AS term
              FROM (SELECT *, CAST(substr(loan_id, 4) AS INTEGER) AS n FROM ({ORACLE_SQL['landing_loans']})))""",
    "star_tables": f"""
        SELECT 'dim' AS kind, branch_id AS id, f AS detail FROM ({_BRANCHES}), (SELECT unnest(['true', 'false']) AS f)
        UNION ALL SELECT 'copy', branch_id, upper(name) FROM ({_BRANCHES})
        UNION ALL SELECT 'fact', transaction_id, CASE WHEN year = 1998 AND month = 7 THEN 'again' ELSE currency END
                  FROM ({ORACLE_SQL['star_fact_transactions']})""",
    "stream_ingest_payments": f"""
        SELECT payment_id, loan_id, transaction_id,
               CAST(strftime(scheduled_payment_date, '%Y%m%d') AS INTEGER) AS scheduled_payment_date_id,
               CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS payment_date_id,
               CAST(strftime(paid_date, '%Y%m%d') AS INTEGER) AS paid_date_id,
               payment_amount, principal_amount, paid_amount, scheduled_payment_date, payment_date, paid_date,
               CAST(year(paid_date) AS INTEGER) AS year, CAST(month(paid_date) AS INTEGER) AS month FROM ({_PAYMENTS})""",
    "stream_ingest_loans": f"""
        WITH {LOANS_CTE}
        SELECT printf('LOA%07d', o_orderkey) AS loan_id, printf('CUS%07d', o_custkey) AS customer_id,
               {cents('o_totalprice')} AS amount, CAST(7.5 AS FLOAT) AS interest_rate, 12 AS term,
               CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + 360 AS end_date,
               loan_type AS type, loan_status AS status,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM loans""",
    "feed_shards": f"""
        WITH {SE_CTE}
        SELECT printf('ACC%07d', user_id) AS key, count(*) AS n_records, CAST(1 AS BIGINT) AS n_shards FROM se GROUP BY 1""",
    "round2": """
        SELECT l_orderkey, l_linenumber,
               CAST(v // 100 + CASE WHEN v % 100 > 50 OR (v % 100 = 50 AND (v // 100) % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 100 AS net
        FROM (SELECT l_orderkey, l_linenumber,
                     CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS v
              FROM lineitem)""",
}


def _raw(name: str) -> str:
    """A table of ``roles.RAW_LANDING`` in SQL."""
    table, cols = R.RAW_LANDING[name]
    return f"(SELECT {', '.join(f'{e} AS {c}' for c, e in cols.items())} FROM {table})"


def _id(col: str, entity: str) -> str:
    w = S.TRANSACTION_ID_WIDTH if entity == "transaction" else S.ID_WIDTH
    return f"NOT regexp_matches({col}, '^{S.ID_PREFIXES[entity]}[0-9]{{{w}}}$')"


_NAMES = {i: n for i, n in S.ACCOUNT_TYPES}
_ACCOUNT_LIMITS = [(i, *r[1:]) for i, n in S.ACCOUNT_TYPES for r in S.ACCOUNT_BALANCE_RULES if r[0] == n]
_CURRENCY = f"currency NOT IN ({_lit(S.CURRENCY)})"

# V3-V11, P15 and V1, V2 on documents
ORACLE_SQL |= {
    "landing_rule_checks": "WITH " + ", ".join([
        values("al", "t, lo, hi, least", _ACCOUNT_LIMITS), values("tl", "t, lo, hi, sign", S.TRANSACTION_AMOUNT_RULES),
        values("ct", "t, name, fee, rate", S.CARD_TYPES), values("ll", "t, lo, hi", S.LOAN_AMOUNT_RULES),
        f"a AS (SELECT * FROM {_raw('accounts')} x LEFT JOIN al ON x.type = al.t)",
        f"t AS (SELECT * FROM {_raw('transactions')} x LEFT JOIN tl ON x.type = tl.t)",
        f"c AS (SELECT * FROM {_raw('cards')} x LEFT JOIN ct ON x.card_type_id = ct.t)",
        f"l AS (SELECT * FROM {_raw('loans')} x LEFT JOIN ll ON x.loan_type_id = ll.t)",
        f"""p AS (SELECT x.*, y.loan_id AS known, y.start_date, y.end_date, CAST(y.amount AS DOUBLE) / y.term AS inst
              FROM {_raw('loan_payments')} x LEFT JOIN {_raw('loans')} y ON x.loan_id = y.loan_id)"""]) + " " + " UNION ALL ".join([
        _rule_union("a", [
            ("accounts.id", _id("account_id", "account")), ("accounts.unknown_type", "t IS NULL"),
            ("accounts.balance_range", "NOT (balance BETWEEN lo AND hi)"), ("accounts.min_balance", "min_balance <> least"),
            ("accounts.closed_before_opened", "date_closed < date_opened"), ("accounts.currency", _CURRENCY)]),
        _rule_union("t", [
            ("transactions.id", _id("transaction_id", "transaction")), ("transactions.unknown_type", "sign IS NULL"),
            ("transactions.amount_range", "NOT (abs(amount) BETWEEN lo AND hi)"),
            ("transactions.sign", "(sign < 0 AND amount > 0 AND type <> 2) OR (sign > 0 AND amount < 0)"),
            ("transactions.overdraft_flip", "type = 2 AND amount > 0"),
            ("transactions.receiver_not_transfer", "receiver_account_id IS NOT NULL AND type <> 3"), ("transactions.currency", _CURRENCY)]),
        _rule_union("c", [
            ("cards.id", _id("card_id", "card")), ("cards.unknown_type", "name IS NULL"),
            ("cards.expiry", f"expiration_date <> issuance_date + {S.CARD_VALID_DAYS}"),
            ("cards.fee", "monthly_fee <> fee"), ("cards.rate", "abs(interest_rate - rate) > 1e-6")]),
        _rule_union("l", [
            ("loans.id", _id("loan_id", "loan")), ("loans.unknown_type", "t IS NULL"),
            ("loans.term", f"term NOT IN ({', '.join(map(str, S.LOAN_TERMS))})"), ("loans.end_date", "end_date <> start_date + term * 30"),
            ("loans.rate", f"NOT (interest_rate BETWEEN {S.LOAN_RATE_RANGE[0]} AND {S.LOAN_RATE_RANGE[1]})"),
            ("loans.amount_range", "NOT (amount BETWEEN lo AND hi)"), ("loans.currency", _CURRENCY)]),
        _rule_union("p", [
            ("payments.id", _id("payment_id", "payment")), ("payments.unknown_loan", "known IS NULL"),
            ("payments.amount_vs_instalment", f"NOT (payment_amount BETWEEN inst * CAST({S.PAYMENT_RATIO[0]} AS DOUBLE) - 0.5 AND inst * CAST({S.PAYMENT_RATIO[1]} AS DOUBLE) + 0.5)"),
            ("payments.principal_share", f"NOT (principal_amount BETWEEN payment_amount * CAST({S.PRINCIPAL_RATIO[0]} AS DOUBLE) - 0.5 AND payment_amount * CAST({S.PRINCIPAL_RATIO[1]} AS DOUBLE) + 0.5)"),
            ("payments.paid_amount", "paid_amount <> payment_amount"), ("payments.paid_date", "paid_date <> payment_date"),
            ("payments.lateness", f"NOT (payment_date - scheduled_payment_date BETWEEN -{S.PAYMENT_EARLY_DAYS} AND {S.PAYMENT_LATE_DAYS})"),
            ("payments.scheduled_outside_loan", "NOT (scheduled_payment_date BETWEEN start_date AND end_date)"),
            ("payments.in_future", f"payment_date > DATE '{R.LINEITEM_AS_OF}'")]),
        _rule_union(_raw("customers") + " u", [
            ("customers.id", _id("customer_id", "customer")), ("customers.country", f"country NOT IN ({_lit(S.COUNTRY)})"),
            ("customers.city", f"city NOT IN ({', '.join(map(_lit, S.CITIES))})")])]),
    "document_checks": _rule_union("events", [
        (f"transactions.required:{f}", _ABSENT[f]) for f in S.REQUIRED_FIELDS["transactions"]] + [
        (f"transactions.type:{f}", _RETYPED[f]) for f in S.DOCUMENTS["transactions"].names]),
}


ORACLE_SQL["customer360_documents"] = f"""
    WITH cards AS (SELECT c_custkey, count(DISTINCT p_partkey) AS n FROM customer JOIN part
                   ON p_partkey = c_custkey % 100 + 1 OR p_partkey = c_custkey % 7 + 1 GROUP BY ALL),
    loans AS (SELECT c_custkey, count(*) AS n, min(o_orderkey) AS first FROM customer JOIN orders
              ON o_orderkey = c_custkey + 1 OR o_orderkey = c_custkey * 20 GROUP BY ALL),
    a AS ({ORACLE_SQL['analytics_documents']}),
    t AS (WITH {SE_CTE} SELECT user_id, CAST(sum(amount_cents) AS BIGINT) AS tx_cents FROM se WHERE {PERIOD} GROUP BY 1)
    SELECT t.tx_cents, 'CUST_' || CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS name, '****' || right(c.c_name, 4) AS account_number,
           CAST(coalesce(cards.n, 0) AS INTEGER) AS n_cards, CAST(coalesce(loans.n, 0) AS INTEGER) AS n_loans, loans.first AS first_loan,
           'CUST_' || a.doc_id AS analytics_id, a.total_transactions, a.total_inflow
    FROM customer c LEFT JOIN cards ON c.c_custkey = cards.c_custkey LEFT JOIN loans ON c.c_custkey = loans.c_custkey
    LEFT JOIN a ON CAST(c.c_custkey AS VARCHAR) = a.customer_id LEFT JOIN t ON t.user_id = c.c_custkey"""
ORACLE_SQL["branches_json"] = """
    SELECT s_name AS name, 'Hà Nội ' || CAST(s_nationkey AS VARCHAR) AS address, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS phone_number
    FROM supplier WHERE s_nationkey % 3 = 0 AND s_acctbal >= 0"""

# queries that reach an answer another way give that answer
ORACLE_SQL |= {new: ORACLE_SQL[same] for new, same in {
    "stream_late_balance": "stream_balance_after", "stream_fold": "stream_ingest", "stream_upsert_loans": "stream_ingest_loans",
    "incremental_latest_balance": "latest_balance", "observed_rule_checks": "landing_rule_checks"}.items()}
ORACLE_SQL["customer360_colocated"] = f"""
    WITH l AS (SELECT o_custkey, count(*) AS n_loans, CAST(sum({cents('o_totalprice')}) AS BIGINT) AS loans_total_cents FROM orders GROUP BY 1),
    r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events),
    e AS (SELECT user_id, CAST(pos // 16 AS BIGINT) AS chunk, count(*) AS n, arg_min(event_id, pos) AS first_event_id, arg_max(event_id, pos) AS last_event_id
          FROM r GROUP BY user_id, pos // 16)
    SELECT c.c_custkey, c.c_name, coalesce(l.n_loans, 0) AS n_loans, coalesce(l.loans_total_cents, 0) AS loans_total_cents,
           e.chunk, CAST(coalesce(e.n, 0) AS INTEGER) AS n, e.first_event_id, e.last_event_id
    FROM customer c LEFT JOIN l ON l.o_custkey = c.c_custkey LEFT JOIN e ON e.user_id = c.c_custkey"""
ORACLE_SQL["calendar_scan"] = """
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
    WHERE quarter(o_orderdate) IN (2, 4) AND isodow(o_orderdate) >= 6"""
ORACLE_SQL["csv_quarantine"] = """
    WITH c AS (SELECT c_custkey AS k, c_name, CAST(CAST(c_acctbal AS DECIMAL(15, 2)) AS VARCHAR) AS bal FROM customer)
    SELECT CASE WHEN k % 11 IN (1, 2, 3) THEN 'quarantined' ELSE 'row' END AS kind, k AS id,
           CASE WHEN k % 11 = 4 THEN 'with, comma' WHEN k % 11 IN (1, 2, 3) THEN NULL ELSE c_name END AS name,
           CASE k % 11 WHEN 1 THEN k || ',' || c_name WHEN 2 THEN k || ',' || c_name || ',a lot' WHEN 3 THEN k || ',' || c_name || ',1.00,more' ELSE bal END AS detail
    FROM c"""
ORACLE_SQL["stream_orphans"] = f"""
    SELECT l_orderkey AS loan_id, CAST(l_linenumber AS INTEGER) AS l_linenumber FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {R.PARENT_FILTERS['orders']})"""
ORACLE_SQL["document_drift"] = """
    WITH e AS (SELECT event_id, event_type = 'error' AS as_text, event_type <> 'error' AND event_id % 50 = 7 AS broken FROM events),
    r AS (
      SELECT '' AS path, 'unreadable' AS status, NULL AS declared, NULL AS found, count(*) FILTER (WHERE broken) AS n_docs FROM e
      UNION ALL SELECT 'channel', 'added', NULL, 'string', count(*) FILTER (WHERE NOT broken AND event_id % 3 = 0) FROM e
      UNION ALL SELECT 'branch', 'missing', 'string', NULL, count(*) FILTER (WHERE NOT broken) FROM e
      UNION ALL SELECT 'customer.name', 'missing', 'string', 'string', count(*) FILTER (WHERE NOT broken AND event_id % 5 = 0) FROM e
      UNION ALL SELECT 'amount', 'retyped', 'double', 'variant', count(*) FILTER (WHERE as_text) FROM e)
    SELECT * FROM r WHERE n_docs > 0"""
