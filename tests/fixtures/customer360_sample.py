"""An invented customer: three accounts listed out of order with one id twice
and one that no account has, no card, one loan, three transactions, and two
analytics rows; and the document expected for that customer."""

from datetime import datetime

CUSTOMER_ID = "K-77"


def account(number, **more):
    return {"_id": number, "customer_id": CUSTOMER_ID, "account_type": "Vault", "account_number": f"****{number % 10000:04d}",
            "balance": number * 1.5, "currency": "XTS", "status": "open"} | more


def transaction(n, day, amount):
    return {"_id": f"T{n}", "customer_id": CUSTOMER_ID, "account_id": 5, "date": datetime(2031, 1, day, n, 0), "amount": amount,
            "type": "transfer" if amount < 0 else "salary", "payment_method": "wire"}


def analytics(month, score):
    return {
        "_id": f"{CUSTOMER_ID}/{month}", "customer_id": CUSTOMER_ID, "period": "quarter",
        "transaction_analytics": {
            "total_transactions": 3, "total_inflow": 90.0, "total_outflow": 31.0, "net_cashflow": 59.0, "avg_monthly_transactions": 1,
            "spending_patterns": {"by_type": [{"type": "salary", "count": 1, "amount": 90.0, "percentage": 74.4},
                                              {"type": "transfer", "count": 2, "amount": 31.0, "percentage": 25.6}],
                                  "by_channel": {"branch": 0.0, "atm": 10.0, "online": 90.0}}},
        "financial_health_score": {
            "overall_score": score, "breakdown": {"payment_history": 1, "account_balance": 2, "credit_utilization": 3, "relationship_depth": 4},
            "debt_to_income_ratio": 0.5, "savings_rate": 1.5, "liquidity_ratio": 2.5, "risk_category": "none"},
        "last_updated": datetime(2031, month, 1)}


CUSTOMERS = [{
    "_id": CUSTOMER_ID,
    "personal_info": {"name": "Ilse Quark", "email": "ilse@quark.test", "phone": "000-77",
                      "address": {"street": "Elm 1", "city": "Nowhere", "country": "Utopia"},
                      "registration_date": datetime(2029, 9, 9), "customer_since_months": 16, "customer_type": "person",
                      "kyc_status": "done"},
    "accounts": [8, 5, 8, 404], "cards": [], "loans": [61], "primary_branch": "Harbour",
}]
ACCOUNTS = [account(5, interest_rate=0.25, date_opened=datetime(2029, 10, 1)), account(8, overdraft_limit=12.0), account(9)]
CARDS = [{"_id": 31, "customer_id": "K-1", "card_type": "debit", "masked_number": "****0031", "linked_account": 9, "credit_limit": 1.0,
          "outstanding_balance": 0.5, "available_credit": 0.5, "monthly_fee": 0.0, "interest_rate": 0.0, "expiration_date": datetime(2035, 1, 1)}]
LOANS = [{"_id": 61, "customer_id": CUSTOMER_ID, "loan_type": "boat", "original_amount": 640.0, "remaining_balance": 64.0, "interest_rate": 3.0,
          "monthly_payment": 16.0, "next_payment_date": datetime(2031, 2, 28), "term_remaining_months": 4, "payment_history": "on time"}]
TRANSACTIONS = [transaction(2, 7, -30.0), transaction(1, 9, 90.0), transaction(3, 8, -1.0)]
ANALYTICS = [analytics(2, 20), analytics(3, 30)]


def _jsonable(obj):
    if isinstance(obj, datetime):
        return obj.strftime("%Y-%m-%dT%H:%M:%S")
    if isinstance(obj, list):
        return [_jsonable(x) for x in obj]
    return {k: _jsonable(v) for k, v in obj.items()} if isinstance(obj, dict) else obj


EXPECTED = _jsonable(CUSTOMERS[0] | {
    "accounts": ACCOUNTS[:2], "cards": [], "loans": LOANS,
    "transactions": sorted(TRANSACTIONS, key=lambda t: t["_id"]), "analytics": ANALYTICS[1]})
