"""Schemas of the landing CSVs, the star schema, the documents and the
live feeds, plus the constant lookup rows (S12)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, F, DT, TS, B = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                            T.FloatType(), T.DateType(), T.TimestampType(), T.BooleanType())


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------------------
# Lookup tables of the bank (code -> name), as the source
# system defines them.  Names are Vietnamese and must stay as written.
# ---------------------------------------------------------------------------
CUSTOMER_TYPES = [(1, "Cá nhân"), (2, "Doanh nghiệp"), (3, "Tổ chức")]
CUSTOMER_STATUS_TYPES = [(1, "Hoạt động"), (2, "Tạm khóa"), (3, "Đóng")]
ACCOUNT_TYPES = [(1, "Tiết kiệm"), (2, "Thanh toán"), (3, "Đầu tư"), (4, "Doanh nghiệp")]
ACCOUNT_STATUS_TYPES = [(1, "Hoạt động"), (2, "Tạm khóa"), (3, "Đóng")]
TRANSACTION_TYPES = [(1, "Gửi tiền"), (2, "Rút tiền"), (3, "Chuyển khoản"),
                     (4, "Thanh toán khoản vay"), (5, "Lãi suất")]
CARD_TYPES = [(1, "ATM", 0, 0.0), (2, "Visa Debit", 50000, 0.0),
              (3, "Mastercard Credit", 100000, 2.5), (4, "Visa Credit Gold", 200000, 2.0)]
LOAN_TYPES = [(1, "Thế chấp nhà"), (2, "Tín chấp cá nhân"), (3, "Kinh doanh"), (4, "Xe máy/Ô tô")]
LOAN_STATUS_TYPES = [(1, "Đang vay"), (2, "Quá hạn"), (3, "Đã thanh toán"), (4, "Nợ xấu")]

# Business rules of the source system.
ID_PREFIXES = {"customer": "CUS", "account": "ACC", "branch": "BRA", "employee": "EMP",
               "transaction": "TXN", "card": "CRD", "loan": "LOA", "payment": "PAY"}
ID_WIDTH, TRANSACTION_ID_WIDTH = 7, 10
CURRENCY, COUNTRY, CITIES = "VND", "Việt Nam", ("Hà Nội", "Hồ Chí Minh")
# balance range and min balance per account type name
ACCOUNT_BALANCE_RULES = [("Tiết kiệm", 5_000_000, 500_000_000, 500_000),
                         ("Thanh toán", 1_000_000, 100_000_000, 50_000),
                         ("Đầu tư", 10_000_000, 1_000_000_000, 1_000_000),
                         ("Doanh nghiệp", 50_000_000, 2_000_000_000, 5_000_000)]
# amount magnitude range and sign per transaction type id (sign 0 = either)
TRANSACTION_AMOUNT_RULES = [(1, 100_000, 50_000_000, 1), (2, 100_000, 10_000_000, -1),
                            (3, 100_000, 20_000_000, 0), (4, 100_000, 20_000_000, -1),
                            (5, 50_000, 5_000_000, 1)]
LOAN_AMOUNT_RULES = [(1, 500_000_000, 5_000_000_000), (2, 10_000_000, 500_000_000),
                     (3, 100_000_000, 2_000_000_000), (4, 50_000_000, 800_000_000)]
LOAN_TERMS = (12, 24, 36, 48, 60, 84, 120)
LOAN_RATE_RANGE = (6.0, 15.0)
CARD_VALID_DAYS = 365 * 3
PAYMENT_RATIO = (0.8, 1.2)
PRINCIPAL_RATIO = (0.6, 0.8)
PAYMENT_EARLY_DAYS, PAYMENT_LATE_DAYS = 5, 15
PAID_STATUS_CODE, PAID_STATUS_NAME = 3, "Đã thanh toán"

# ---------------------------------------------------------------------------
# Landing CSV schemas (explicit; no inference pass)
# ---------------------------------------------------------------------------
BRANCHES = struct(("branch_id", S), ("name", S), ("address", S), ("phone_number", S))
EMPLOYEES = struct(("employee_id", S), ("name", S), ("position", S), ("branch_id", S))
CUSTOMERS = struct(("customer_id", S), ("name", S), ("country", S), ("city", S), ("street", S),
                   ("phone_number", S), ("registration_date", DT), ("email", S),
                   ("customer_type_id", I), ("status", I))
ACCOUNTS = struct(("account_id", S), ("customer_id", S), ("branch_id", S), ("type", I),
                  ("status", I), ("currency", S), ("number", S), ("balance", L),
                  ("min_balance", I), ("date_opened", DT), ("date_closed", DT))
TRANSACTIONS = struct(("transaction_id", S), ("account_id", S), ("receiver_account_id", S),
                      ("employee_id", S), ("type", I), ("currency", S), ("date", TS),
                      ("amount", L), ("balance_after", L))
CARDS = struct(("card_id", S), ("account_id", S), ("customer_id", S), ("card_type_id", I),
               ("monthly_fee", I), ("interest_rate", F), ("expiration_date", DT),
               ("issuance_date", DT))
LOANS = struct(("loan_id", S), ("customer_id", S), ("loan_type_id", I), ("amount", L),
               ("currency", S), ("interest_rate", F), ("term", I), ("start_date", DT),
               ("end_date", DT), ("loan_status_id", I))
LOAN_PAYMENTS = struct(("payment_id", S), ("loan_id", S), ("transaction_id", S),
                       ("payment_amount", L), ("scheduled_payment_date", DT),
                       ("payment_date", DT), ("principal_amount", L), ("paid_amount", L),
                       ("paid_date", DT))
LANDING_CSV = {"branches": BRANCHES, "employees": EMPLOYEES, "customers": CUSTOMERS,
               "accounts": ACCOUNTS, "transactions": TRANSACTIONS, "cards": CARDS,
               "loans": LOANS, "loan_payments": LOAN_PAYMENTS}

# ---------------------------------------------------------------------------
# Star schema (column order of the target tables)
# ---------------------------------------------------------------------------
DIM_DATE = struct(("date_id", I), ("full_date", DT), ("day", I), ("month", I), ("year", I),
                  ("quarter", I), ("day_of_week", I), ("is_weekend", B))
DIM_ACCOUNTS = struct(("account_id", S), ("customer_id", S), ("branch_id", S), ("type", S),
                      ("status", S), ("number", S), ("min_balance", I), ("date_opened", DT),
                      ("date_closed", DT))
DIM_BRANCHES = struct(("branch_id", S), ("name", S), ("address", S), ("phone_number", S),
                      ("created_at", TS), ("updated_at", TS), ("is_active", B))
DIM_CARDS = struct(("card_id", S), ("account_id", S), ("monthly_fee", I), ("interest_rate", F),
                   ("expiration_date", DT), ("issuance_date", DT), ("card_type", S),
                   ("number", S))
DIM_CUSTOMERS = struct(("customer_id", S), ("name", S), ("country", S), ("city", S),
                       ("street", S), ("phone_number", S), ("registration_date", DT),
                       ("email", S), ("customer_type", S), ("status", S), ("created_at", TS),
                       ("updated_at", TS), ("is_active", B))
DIM_EMPLOYEES = struct(("employee_id", S), ("name", S), ("position", S), ("branch_id", S),
                       ("created_at", TS), ("updated_at", TS), ("is_active", B))
DIM_LOANS = struct(("loan_id", S), ("customer_id", S), ("amount", L), ("interest_rate", F),
                   ("term", I), ("start_date", DT), ("end_date", DT), ("type", S), ("status", S))
FACT_LOAN_PAYMENTS = struct(("payment_id", S), ("loan_id", S), ("transaction_id", S),
                            ("scheduled_payment_date_id", I), ("payment_date_id", I),
                            ("paid_date_id", I), ("payment_amount", L), ("principal_amount", L),
                            ("paid_amount", L), ("scheduled_payment_date", DT),
                            ("payment_date", DT), ("paid_date", DT))
FACT_TRANSACTIONS = struct(("transaction_id", S), ("account_id", S), ("employee_id", S),
                           ("date_id", I), ("timestamp", TS), ("currency", S), ("type", S),
                           ("amount", L), ("balance_after", L))
STAR = {"dim_date": DIM_DATE, "dim_accounts": DIM_ACCOUNTS, "dim_branches": DIM_BRANCHES,
        "dim_cards": DIM_CARDS, "dim_customers": DIM_CUSTOMERS, "dim_employees": DIM_EMPLOYEES,
        "dim_loans": DIM_LOANS, "fact_loan_payments": FACT_LOAN_PAYMENTS,
        "fact_transactions": FACT_TRANSACTIONS}

# ---------------------------------------------------------------------------
# Live feeds (JSON records; dates are text)
# ---------------------------------------------------------------------------
FEED_TRANSACTION = struct(("transaction_id", S), ("account_id", S), ("employee_id", S),
                          ("type", S), ("currency", S), ("date", S), ("amount", L))
FEED_LOAN_PAYMENT = struct(("payment_id", S), ("loan_id", S), ("transaction_id", S),
                           ("payment_amount", L), ("scheduled_payment_date", S),
                           ("payment_date", S), ("principal_amount", L), ("paid_amount", L),
                           ("paid_date", S))
FEED_LOAN = struct(("loan_id", S), ("customer_id", S), ("type", S), ("amount", L),
                   ("currency", S), ("interest_rate", D), ("term", I), ("start_date", S),
                   ("end_date", S), ("status", S))
FEED_KEYS = {"transaction": "account_id", "loan_payment": "loan_id", "loan": "customer_id"}

# ---------------------------------------------------------------------------
# Documents (customer 360)
# ---------------------------------------------------------------------------
ADDRESS = struct(("street", S), ("city", S), ("country", S))
PERSONAL_INFO = struct(("name", S), ("email", S), ("phone", S), ("address", ADDRESS),
                       ("registration_date", TS), ("customer_since_months", I),
                       ("customer_type", S), ("kyc_status", S))
DOC_CUSTOMERS = struct(("_id", S), ("personal_info", PERSONAL_INFO),
                       ("accounts", T.ArrayType(L)), ("cards", T.ArrayType(L)),
                       ("loans", T.ArrayType(L)), ("primary_branch", S))
DOC_ACCOUNTS = struct(("_id", L), ("customer_id", S), ("account_type", S),
                      ("account_number", S), ("balance", D), ("currency", S),
                      ("interest_rate", D), ("min_balance", D), ("overdraft_limit", D),
                      ("status", S), ("date_opened", TS))
DOC_CARDS = struct(("_id", L), ("customer_id", S), ("card_type", S), ("masked_number", S),
                   ("linked_account", L), ("credit_limit", D), ("outstanding_balance", D),
                   ("available_credit", D), ("monthly_fee", D), ("interest_rate", D),
                   ("expiration_date", TS))
DOC_LOANS = struct(("_id", L), ("customer_id", S), ("loan_type", S), ("original_amount", D),
                   ("remaining_balance", D), ("interest_rate", D), ("monthly_payment", D),
                   ("next_payment_date", TS), ("term_remaining_months", I),
                   ("payment_history", S))
DOC_TRANSACTIONS = struct(("_id", S), ("customer_id", S), ("account_id", L), ("date", TS),
                          ("amount", D), ("type", S), ("payment_method", S))
BY_TYPE = T.ArrayType(struct(("type", S), ("count", I), ("amount", D), ("percentage", D)))
BY_CHANNEL = struct(("branch", D), ("atm", D), ("online", D))
TX_ANALYTICS = struct(("total_transactions", I), ("total_inflow", D), ("total_outflow", D),
                      ("net_cashflow", D), ("avg_monthly_transactions", I),
                      ("spending_patterns", struct(("by_type", BY_TYPE),
                                                   ("by_channel", BY_CHANNEL))))
HEALTH = struct(("overall_score", I),
                ("breakdown", struct(("payment_history", I), ("account_balance", I),
                                     ("credit_utilization", I), ("relationship_depth", I))),
                ("debt_to_income_ratio", D), ("savings_rate", D), ("liquidity_ratio", D),
                ("risk_category", S))
DOC_ANALYTICS = struct(("_id", S), ("customer_id", S), ("period", S),
                       ("transaction_analytics", TX_ANALYTICS),
                       ("financial_health_score", HEALTH), ("last_updated", TS))
DOCUMENTS = {"customers": DOC_CUSTOMERS, "accounts": DOC_ACCOUNTS, "cards": DOC_CARDS,
             "loans": DOC_LOANS, "transactions": DOC_TRANSACTIONS, "analytics": DOC_ANALYTICS}

# Required fields per collection (V1), as dotted paths.
REQUIRED_FIELDS = {
    "customers": ["_id", "personal_info", "accounts", "cards", "loans", "primary_branch",
                  "personal_info.name", "personal_info.email", "personal_info.phone",
                  "personal_info.address", "personal_info.registration_date",
                  "personal_info.customer_since_months", "personal_info.customer_type",
                  "personal_info.kyc_status", "personal_info.address.street",
                  "personal_info.address.city", "personal_info.address.country"],
    "accounts": ["_id", "customer_id", "account_type", "account_number", "balance",
                 "currency", "status"],
    "loans": ["_id", "customer_id", "loan_type", "original_amount", "remaining_balance",
              "interest_rate", "monthly_payment", "next_payment_date",
              "term_remaining_months"],
    "cards": ["_id", "customer_id", "card_type", "masked_number", "linked_account",
              "credit_limit", "outstanding_balance", "available_credit"],
    "transactions": ["_id", "customer_id", "date", "amount", "type", "payment_method"],
    "analytics": ["_id", "customer_id", "period", "transaction_analytics",
                  "financial_health_score", "last_updated",
                  "transaction_analytics.total_transactions",
                  "transaction_analytics.total_inflow", "transaction_analytics.total_outflow",
                  "transaction_analytics.net_cashflow",
                  "transaction_analytics.avg_monthly_transactions",
                  "transaction_analytics.spending_patterns",
                  "transaction_analytics.spending_patterns.by_type",
                  "transaction_analytics.spending_patterns.by_channel",
                  "financial_health_score.overall_score", "financial_health_score.breakdown",
                  "financial_health_score.debt_to_income_ratio",
                  "financial_health_score.savings_rate", "financial_health_score.liquidity_ratio",
                  "financial_health_score.risk_category",
                  *[f"transaction_analytics.spending_patterns.by_type[*].{f}" for f in ("type", "count", "amount", "percentage")],
                  *[f"transaction_analytics.spending_patterns.by_channel.{f}" for f in ("branch", "atm", "online")],
                  *[f"financial_health_score.breakdown.{f}" for f in ("payment_history", "account_balance", "credit_utilization",
                                                                     "relationship_depth")]],
}
