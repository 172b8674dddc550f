"""The operator inventory run over the driver's tables (roles: ``roles.py``).

Every query reads whole tables and returns a flat DataFrame; none
samples, caps or subsets rows.  Money is summed as whole cents so that
sums are exact.
"""

from __future__ import annotations

from ledgerlake.plans.catalog.latest_queries import (  # noqa: F401
    latest_balance,
    latest_balance_agg,
    latest_balance_sql,
    sql_functions,
    latest_child,
)
from ledgerlake.plans.catalog.scan_queries import (  # noqa: F401
    scan_parquet,
    scan_month_range,
    scan_missing_month,
    csv_round_trip,
    partitioned_month_scan,
    union_slices,
    payments_6m,
    transactions_12m,
    branches_json,
)
from ledgerlake.plans.catalog.star_queries import (  # noqa: F401
    star_fact_transactions,
    star_fact_loan_payments,
    star_dim_customers,
    star_dim_accounts,
    star_dim_branches,
    star_dim_cards,
    star_dim_employees,
    star_dim_loans,
    star_tables,
)
from ledgerlake.plans.catalog.landing_queries import (  # noqa: F401
    landing_accounts,
    landing_transactions,
    landing_loans,
    landing_cards,
    conform_accounts,
    conform_customers,
    conform_cards,
    conform_loans,
    conform_transactions,
    dim_audit,
    landing_customers,
    landing_loan_payments,
    landing_files,
)
from ledgerlake.plans.catalog.customer_queries import (  # noqa: F401
    customer360_one,
    customer360_summary,
    customer360_arrays,
    customer360_tx,
    customer360_tx_chunks,
    id_array_lookup,
    analytics_documents,
    customer360_documents,
)
from ledgerlake.plans.catalog.analytics_queries import (  # noqa: F401
    customer_analytics,
    spending_by_type,
    spending_by_channel,
    max_id,
    table_counts,
    duplicate_keys,
)
from ledgerlake.plans.catalog.quality_queries import (  # noqa: F401
    fk_orphans,
    required_fields,
    type_check,
    id_pattern,
    amount_range,
    amount_sign,
    balance_range,
    date_order,
    date_add,
    loan_rules,
    payment_rules,
    allowed_values,
    landing_rule_checks,
    document_checks,
)
from ledgerlake.plans.catalog.scalar_queries import (  # noqa: F401
    date_parts,
    date_key,
    dim_date,
    mask_account,
    mask_phone,
    mask_card,
    format_id,
    clean_text,
    filter_contains,
    filter_type,
    balance_after,
    normalize_status,
    conditional_null,
    round_even,
    date_cap,
    date_format,
    array_first,
    stream_envelope,
    tenure_months,
    credit_utilisation,
    loan_installment,
    lookup_default,
    round2,
)
from ledgerlake.plans.catalog.window_queries import (  # noqa: F401
    next_ids,
    sequence_id,
    running_balance,
    running_balance_ranges,
)
from ledgerlake.plans.catalog.stream_queries import (  # noqa: F401
    stream_transactions,
    stream_ingest,
    stream_latest_balance,
    stream_running_balance,
    stream_balance_after,
    stream_dedup,
    stream_dedup_watermark,
    stream_enrich,
    stream_ingest_payments,
    stream_ingest_loans,
    stream_late_balance,
    stream_fold,
    stream_upsert_loans,
    feed_shards,
)
from ledgerlake.plans.catalog.live_queries import (  # noqa: F401
    incremental_latest_balance,
    customer360_colocated,
    calendar_scan,
    observed_rule_checks,
    csv_quarantine,
    stream_orphans,
    document_drift,
)

QUERIES = {
    "latest_balance": latest_balance,
    "latest_balance_agg": latest_balance_agg,
    "latest_balance_sql": latest_balance_sql,
    "sql_functions": sql_functions,
    "latest_child": latest_child,
    "scan_parquet": scan_parquet,
    "scan_month_range": scan_month_range,
    "scan_missing_month": scan_missing_month,
    "csv_round_trip": csv_round_trip,
    "partitioned_month_scan": partitioned_month_scan,
    "union_slices": union_slices,
    "payments_6m": payments_6m,
    "transactions_12m": transactions_12m,
    "landing_accounts": landing_accounts,
    "landing_transactions": landing_transactions,
    "landing_loans": landing_loans,
    "landing_cards": landing_cards,
    "star_fact_transactions": star_fact_transactions,
    "star_fact_loan_payments": star_fact_loan_payments,
    "star_dim_customers": star_dim_customers,
    "conform_accounts": conform_accounts,
    "conform_customers": conform_customers,
    "conform_cards": conform_cards,
    "conform_loans": conform_loans,
    "conform_transactions": conform_transactions,
    "dim_audit": dim_audit,
    "customer360_one": customer360_one,
    "customer360_summary": customer360_summary,
    "customer360_arrays": customer360_arrays,
    "customer360_tx": customer360_tx,
    "customer360_tx_chunks": customer360_tx_chunks,
    "id_array_lookup": id_array_lookup,
    "customer_analytics": customer_analytics,
    "spending_by_type": spending_by_type,
    "spending_by_channel": spending_by_channel,
    "analytics_documents": analytics_documents,
    "max_id": max_id,
    "table_counts": table_counts,
    "duplicate_keys": duplicate_keys,
    "fk_orphans": fk_orphans,
    "required_fields": required_fields,
    "type_check": type_check,
    "id_pattern": id_pattern,
    "amount_range": amount_range,
    "amount_sign": amount_sign,
    "balance_range": balance_range,
    "date_order": date_order,
    "date_add": date_add,
    "loan_rules": loan_rules,
    "payment_rules": payment_rules,
    "allowed_values": allowed_values,
    "date_parts": date_parts,
    "date_key": date_key,
    "dim_date": dim_date,
    "mask_account": mask_account,
    "mask_phone": mask_phone,
    "mask_card": mask_card,
    "format_id": format_id,
    "clean_text": clean_text,
    "filter_contains": filter_contains,
    "filter_type": filter_type,
    "balance_after": balance_after,
    "normalize_status": normalize_status,
    "conditional_null": conditional_null,
    "round_even": round_even,
    "date_cap": date_cap,
    "date_format": date_format,
    "array_first": array_first,
    "stream_envelope": stream_envelope,
    "tenure_months": tenure_months,
    "credit_utilisation": credit_utilisation,
    "loan_installment": loan_installment,
    "lookup_default": lookup_default,
    "sequence_id": sequence_id,
    "next_ids": next_ids,
    "running_balance": running_balance,
    "running_balance_ranges": running_balance_ranges,
    "stream_transactions": stream_transactions,
    "stream_ingest": stream_ingest,
    "stream_latest_balance": stream_latest_balance,
    "stream_running_balance": stream_running_balance,
    "stream_balance_after": stream_balance_after,
    "stream_dedup": stream_dedup,
    "stream_dedup_watermark": stream_dedup_watermark,
    "stream_enrich": stream_enrich,
    "star_dim_accounts": star_dim_accounts,
    "star_dim_branches": star_dim_branches,
    "star_dim_cards": star_dim_cards,
    "star_dim_employees": star_dim_employees,
    "star_dim_loans": star_dim_loans,
    "star_tables": star_tables,
    "landing_customers": landing_customers,
    "landing_loan_payments": landing_loan_payments,
    "landing_files": landing_files,
    "stream_ingest_payments": stream_ingest_payments,
    "stream_ingest_loans": stream_ingest_loans,
    "feed_shards": feed_shards,
    "round2": round2,
    "landing_rule_checks": landing_rule_checks,
    "document_checks": document_checks,
    "customer360_documents": customer360_documents,
    "branches_json": branches_json,
    "stream_late_balance": stream_late_balance,
    "stream_fold": stream_fold,
    "stream_upsert_loans": stream_upsert_loans,
    "incremental_latest_balance": incremental_latest_balance,
    "customer360_colocated": customer360_colocated,
    "calendar_scan": calendar_scan,
    "observed_rule_checks": observed_rule_checks,
    "csv_quarantine": csv_quarantine,
    "stream_orphans": stream_orphans,
    "document_drift": document_drift,
}

