"""Month slices of fact tables.

A slice is a predicate, never a path pattern: on the event-time column
(pushed to the parquet scan as min/max filters) and, when the table is
Hive-partitioned by ``year``/``month``, also on those columns so the
listing prunes directories.  One scan covers any set of months, so the
reference's loop of per-month reads and its UNION become one job.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(d: _dt.date | str) -> _dt.date:
    d = _dt.date.fromisoformat(d[:10]) if isinstance(d, str) else d
    return _dt.date(d.year, d.month, 1)


def add_months(d: _dt.date, n: int) -> _dt.date:
    idx = d.year * 12 + d.month - 1 + n
    return _dt.date(idx // 12, idx % 12 + 1, 1)


def months_of(start: _dt.date | str, n: int) -> list[tuple[int, int]]:
    s = month_start(start)
    return [(m.year, m.month) for m in (add_months(s, i) for i in range(n))]


def month_range_filter(df: DataFrame, ts_col: str, start, n_months: int,
                       partition_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows whose ``ts_col`` lies in ``[month(start), month(start) + n)`` (half open, D6)."""
    lo = month_start(start)
    hi = add_months(lo, n_months)
    out = df.where((F.col(ts_col) >= F.lit(lo).cast(df.schema[ts_col].dataType))
                   & (F.col(ts_col) < F.lit(hi).cast(df.schema[ts_col].dataType)))
    if partition_cols:
        out = out.where(partition_predicate(months_of(lo, n_months), *partition_cols))
    return out


def partition_predicate(months: Iterable[tuple[int, int]], year_col: str = "year",
                        month_col: str = "month") -> Column:
    """``(year = y AND month IN (...)) OR ...`` -- prunes Hive partitions."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    cond = F.lit(False)
    for y, ms in sorted(by_year.items()):
        cond = cond | ((F.col(year_col) == y) & F.col(month_col).isin(sorted(ms)))
    return cond


def scan_months(df: DataFrame, ts_col: str, months: Iterable[tuple[int, int]],
                partition_cols: Sequence[str] | None = None) -> DataFrame:
    """Any set of (year, month) in one scan.  A month with no data adds
    no rows; the result keeps its schema (typed empty, D7)."""
    months = sorted(set(months))
    ts = F.col(ts_col)
    cond = F.lit(False)
    for y, m in months:
        lo = _dt.date(y, m, 1)
        hi = add_months(lo, 1)
        dt = df.schema[ts_col].dataType
        cond = cond | ((ts >= F.lit(lo).cast(dt)) & (ts < F.lit(hi).cast(dt)))
    out = df.where(cond)
    if partition_cols:
        out = out.where(partition_predicate(months, *partition_cols))
    return out


def half_year_windows(start, count: int = 2) -> list[tuple[_dt.date, _dt.date]]:
    """Consecutive half-open six-month windows from the month of ``start``."""
    lo = month_start(start)
    return [(add_months(lo, 6 * i), add_months(lo, 6 * (i + 1))) for i in range(count)]


def trailing_months(as_of, n: int = 12) -> tuple[_dt.date, _dt.date]:
    """``n`` calendar months up to and including the month of ``as_of``."""
    cur = month_start(as_of)
    return add_months(cur, -(n - 1)), add_months(cur, 1)


def between_dates(df: DataFrame, ts_col: str, lo: _dt.date, hi: _dt.date) -> DataFrame:
    dt = df.schema[ts_col].dataType
    return df.where((F.col(ts_col) >= F.lit(lo).cast(dt)) & (F.col(ts_col) < F.lit(hi).cast(dt)))


def union_slices(slices: Sequence[DataFrame]) -> DataFrame:
    """O3: UNION ALL by name of slices with one schema."""
    out = slices[0]
    for s in slices[1:]:
        out = out.unionByName(s)
    return out


def scan_calendar(fact: DataFrame, calendar: DataFrame, date: str, parts: Sequence[str] = ("year", "month")) -> DataFrame:
    """S4/O4 by calendar: rows of a fact partitioned by ``parts`` whose day is
    in ``calendar``, a ``dim_date`` under any filter (quarters, weekends).

    The months to read follow from the calendar at run time: it is broadcast
    (a row a day, 18,628 for the whole dimension) and its months prune the
    fact's partitions before they are scanned (dynamic partition pruning).
    The months of a calendar's days are those of the days themselves, so the
    join on the day alone decides."""
    c = calendar.select(F.col("full_date").alias("__day"), *[F.col(p).alias(f"__{p}") for p in parts])
    on = F.to_date(F.col(date)) == F.col("__day")
    for p in parts:
        on = on & (F.col(p) == F.col(f"__{p}"))
    return fact.join(F.broadcast(c), on, "inner").select(*fact.columns)
