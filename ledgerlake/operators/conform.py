"""Code resolution and shaping of the landing zone.

Every code lookup is an inner equi-join to a small table: unmatched and
NULL codes drop the row (D19; ``fk_orphans`` reports them).  The constant
lookup tables carry a broadcast hint from where they are made
(``sources.lookups``); a lookup that comes from data or from an export's
CSV is left to the planner, which broadcasts it only when its size estimate
is under ``autoBroadcastJoinThreshold`` and otherwise shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas as S


def resolve_code(df: DataFrame, code_col: str, lookup: DataFrame, lookup_key: str,
                 lookup_value: str, as_name: str, how: str = "inner",
                 default: str | None = None) -> DataFrame:
    """Replace-or-add a looked-up name for ``code_col`` (one of J1-J8).

    ``how='left'`` with ``default`` gives ``dict.get(k, default)`` (F26).
    """
    lk = lookup.select(F.col(lookup_key).alias("__lk"), F.col(lookup_value).alias("__lv"))
    out = df.join(lk, df[code_col] == lk["__lk"], how)
    value = F.col("__lv") if default is None else F.coalesce(F.col("__lv"), F.lit(default))
    return out.withColumn(as_name, value).drop("__lk", "__lv")


def resolve_codes(df: DataFrame, specs: Sequence[tuple], lookups: Mapping[str, DataFrame]
                  ) -> DataFrame:
    """Apply several lookups: specs are (code_col, lookup_name, key, value, as_name)."""
    for code_col, name, key, value, as_name in specs:
        df = resolve_code(df, code_col, lookups[name], key, value, as_name)
    return df


def add_audit_columns(df: DataFrame, as_of: datetime | str | None = None,
                      active: bool = True) -> DataFrame:
    """P5: created_at, updated_at, is_active.  ``as_of`` fixes the time so
    reruns compare equal (D8); without it the query's current time."""
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumns({"created_at": ts, "updated_at": ts, "is_active": F.lit(active)})


def normalize_status(status: Column, code_names: Mapping[str, str] | None = None,
                     paid_code: str = str(S.PAID_STATUS_CODE),
                     paid_name: str = S.PAID_STATUS_NAME) -> Column:
    """A status that arrives as the paid code ('3') becomes its name;
    other codes map through ``code_names``; names pass through."""
    out = F.when(status == F.lit(paid_code), F.lit(paid_name))
    for code, name in (code_names or {}).items():
        out = out.when(status == F.lit(code), F.lit(name))
    return out.otherwise(status)


def only_for(cond: Column, value: Column) -> Column:
    """The value where the condition holds, else NULL."""
    return F.when(cond, value)


def select_as(df: DataFrame, mapping: Sequence[tuple[str, str]] | Mapping[str, str]) -> DataFrame:
    """Explicit column list with aliases, in the given order."""
    items = mapping.items() if isinstance(mapping, Mapping) else mapping
    return df.select(*[F.col(src).alias(dst) for src, dst in items])


def contains_any(c: Column, needles: Sequence[str]) -> Column:
    """The text contains at least one of the needles."""
    cond = F.lit(False)
    for n in needles:
        cond = cond | c.contains(n)
    return cond
