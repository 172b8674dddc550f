"""ledgerlake: a retail-banking lakehouse expressed as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` (or
``Column -> Column`` for scalar functions).  Nothing here keeps session
state; the caller owns the ``SparkSession``.  The most used entry points
are re-exported here; the full set lives in the sub-packages.
"""

from ledgerlake.operators.analytics import (  # noqa: F401
    cashflow_summary, max_id, running_balance, running_balance_ranges, sequence_ids,
    spending_by_channel, spending_by_type, table_counts,
)
from ledgerlake.operators.conform import add_audit_columns, resolve_code, resolve_codes  # noqa: F401
from ledgerlake.operators.latest import attach_latest, latest_by_agg, latest_by_rank  # noqa: F401
from ledgerlake.operators.nest import (  # noqa: F401
    child_rows, lookup_by_ids, nest_children, nest_children_chunked,
)
from ledgerlake.operators.quality import (  # noqa: F401
    duplicate_keys, fk_orphans, rule_counts, violations,
)
from ledgerlake.plans.customer360 import assemble as customer_documents  # noqa: F401
from ledgerlake.session import build_session, checkpoint_root, configure  # noqa: F401

__all__ = [
    "add_audit_columns", "attach_latest", "build_session", "cashflow_summary", "checkpoint_root",
    "child_rows", "configure", "customer_documents", "duplicate_keys", "fk_orphans",
    "latest_by_agg", "latest_by_rank", "lookup_by_ids", "max_id", "nest_children",
    "nest_children_chunked", "resolve_code", "resolve_codes", "rule_counts", "running_balance",
    "running_balance_ranges", "sequence_ids", "spending_by_channel", "spending_by_type",
    "table_counts", "violations",
]
