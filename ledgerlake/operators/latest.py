"""Latest row per key.

Two forms with equal results:

* ``latest_by_rank`` -- ``row_number() OVER (PARTITION BY key ORDER BY
  ts DESC, id DESC)`` then ``rn = 1``.  Spark plans a ``WindowGroupLimit``
  on both sides of the shuffle, so every map task keeps only its own
  newest row per key and a hot key ships one row per input partition.
* ``latest_by_agg`` -- ``max_by(value, number)``, a partial (map-side) hash
  aggregate without a sort; the same skew safety, and it also runs on a
  stream (ranking windows are refused there).  Its buffers must be of fixed
  width: (ts, id) is one whole number (``order_number``).  Where a value or
  the order has no fixed width it is the rank form.

The id column breaks ties so the answer is repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _order_cols(order_by: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
            for c in order_by]


def latest_by_rank(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   n: int = 1, descending: bool = True,
                   rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per ``keys`` in ``order_by`` order."""
    rn = rank_col or "__rn"
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order_by, descending))
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


#: More than there are ids of 64 bits; a NULL id comes before all others.
_ID_SPAN = 2 * 10**19


def order_number(df: DataFrame, order_by: Sequence[str]) -> Column | None:
    """One whole number that orders rows as (time, integer id) does, NULLs
    first; None for an order of another kind.  A decimal(38) holds the
    microseconds of any timestamp times the span of ids."""
    types = [df.schema[c].dataType for c in order_by]
    if len(types) != 2 or not isinstance(types[0], (T.DateType, T.TimestampType, T.TimestampNTZType)) or not isinstance(types[1], T.IntegralType):
        return None
    whole = lambda n: F.lit(Decimal(n))
    wide = lambda c: c.cast("decimal(19,0)")
    time = F.unix_micros(F.col(order_by[0]).cast("timestamp"))
    number = F.coalesce(wide(F.col(order_by[1])) + whole(1 << 63) + whole(1), whole(0))
    first = F.coalesce(time.cast("decimal(18,0)"), whole(-(10**18) + 1))
    return (first * whole(_ID_SPAN) + number).cast("decimal(38,0)")


def fixed_width(t: T.DataType) -> bool:
    return isinstance(t, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def latest_by_agg(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  values: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key as an aggregate (A3): ``max_by(value, (ts, id))``."""
    values = [c for c in (values or df.columns) if c not in keys]
    number = order_number(df, order_by)
    if number is None or not all(fixed_width(df.schema[c].dataType) for c in values):
        return latest_by_rank(df.select(*dict.fromkeys([*keys, *order_by, *values])), keys, order_by).select(*keys, *values)
    return df.groupBy(*keys).agg(*[F.max_by(c, number).alias(c) for c in values])


def attach_latest(parent: DataFrame, parent_key: str, child: DataFrame,
                  child_key: str, order_by: Sequence[str], as_field: str | None = None,
                  values: Sequence[str] | None = None) -> DataFrame:
    """Left-join the newest child row per parent (J11 with W2/O1/O2).

    A parent with no child keeps its row; the child fields are NULL (or the
    struct field is NULL when ``as_field`` nests them, which ``to_json``
    then leaves out, like the reference's absent field).
    """
    newest = latest_by_rank(child.select(*dict.fromkeys([child_key, *order_by, *(values or child.columns)])), [child_key], order_by)
    newest = newest.select(*dict.fromkeys([child_key, *(values or child.columns)]))
    if as_field:
        cols = [c for c in newest.columns if c != child_key]
        newest = newest.select(F.col(child_key), F.struct(*cols).alias(as_field))
    newest = newest.withColumnRenamed(child_key, "__child_key")
    joined = parent.join(newest, parent[parent_key] == newest["__child_key"], "left")
    return joined.drop("__child_key")
