"""Nested document assembly.

``lookup_by_ids`` replaces an array of ids with the array of matching
documents; the collect is bounded by the array the parent row already
holds.  ``nest_children`` gathers every child of a key into one array
(the reference's correlated lookup); its size is that key's fan-out, so
callers use it where fan-out is bounded or after an id filter.  For
population-scale work there are the keyed child rows (``child_rows``) and
``nest_children_chunked``, which nests every child in ordered arrays of a
bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup_by_ids(parent: DataFrame, parent_key: str, ids_col: str, child: DataFrame,
                  child_key: str, as_col: str | None = None) -> DataFrame:
    """``$lookup`` by an id array.  No match -> ``[]``; a repeated id
    does not repeat its document; dangling ids are dropped.  Documents are
    ordered by their key, so the result is repeatable."""
    as_col = as_col or ids_col
    child_cols = child.columns
    ids = (parent.select(F.col(parent_key).alias("__pk"),
                         F.explode(F.array_distinct(F.col(ids_col))).alias("__id")))
    docs = child.select(F.col(child_key).alias("__ck"), F.struct(*child_cols).alias("__doc"))
    matched = ids.join(docs, ids["__id"] == docs["__ck"], "inner")
    grouped = (matched.groupBy("__pk")
               .agg(F.array_sort(F.collect_list("__doc")).alias("__docs")))
    arr_type = T.ArrayType(child.select(F.struct(*child_cols)).schema[0].dataType, True)
    out = parent.join(grouped, parent[parent_key] == grouped["__pk"], "left")
    filled = F.coalesce(F.col("__docs"), F.array().cast(arr_type))
    return out.withColumn(as_col, filled).drop("__pk", "__docs")


def nest_children(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str,
                  as_col: str, sort_by: Sequence[str] | None = None) -> DataFrame:
    """J10 + A2: all children with ``child_key == parent_key`` as an array
    of structs (``[]`` when none), sorted by ``sort_by`` fields."""
    cols = child.columns
    order = list(sort_by or [])
    fields = order + [c for c in cols if c not in order]
    docs = child.select(F.col(child_key).alias("__ck"), F.struct(*fields).alias("__doc"))
    grouped = docs.groupBy("__ck").agg(F.array_sort(F.collect_list("__doc")).alias("__docs"))
    if order:
        # restore the child's own field order after sorting on the leading fields
        grouped = grouped.withColumn(
            "__docs", F.transform("__docs", lambda d: F.struct(*[d[c].alias(c) for c in cols])))
    arr_type = T.ArrayType(child.select(F.struct(*cols)).schema[0].dataType, True)
    out = parent.join(grouped, parent[parent_key] == grouped["__ck"], "left")
    return out.withColumn(as_col, F.coalesce(F.col("__docs"), F.array().cast(arr_type))
                          ).drop("__ck", "__docs")


def child_rows(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str,
               prefix: str = "") -> DataFrame:
    """The flat form of a nested lookup: one row per (parent, child), and
    one row with NULL child fields for a parent without children.

    Written as an inner join plus the childless parents, not as
    ``parent LEFT JOIN child``: AQE can split a skewed side of an inner
    join but not the right side of a left outer join, and a hot parent's
    children are exactly that side.  The childless parents come from an
    anti join against the child's keys, de-duplicated map-side first.
    """
    c = child.select(*[F.col(x).alias(prefix + x) for x in child.columns])
    ck = prefix + child_key
    matched = parent.join(c, parent[parent_key] == c[ck], "inner")
    keys = c.select(F.col(ck).alias("__ck")).where(F.col("__ck").isNotNull()).distinct()
    lonely = parent.join(keys, parent[parent_key] == keys["__ck"], "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in c.schema.fields]
    return matched.unionByName(lonely.select(*parent.columns, *nulls))


def nest_children_chunked(child: DataFrame, child_key: str, order_by: Sequence[str],
                          chunk_size: int = 1000, as_col: str = "items") -> DataFrame:
    """J10 in bounded pieces: every child of a key, in ``order_by`` order,
    nested in chunks of at most ``chunk_size`` (one row per key and chunk:
    ``chunk`` 0, 1, ..., ``n``, ``as_col``).  Nothing is dropped and no group
    is larger than ``chunk_size``: a child's position is the running count of
    its key in one range-partitioned pass (skew-safe, see
    ``analytics.running_balance_ranges``); a NULL key is a key of its own."""
    from ledgerlake.operators.analytics import running_balance_ranges
    cols = child.columns
    counted = running_balance_ranges(child.withColumn("__one", F.lit(1).cast("long")), child_key, order_by, "__one", out_col="__pos")
    pos = counted.withColumn("__pos", F.col("__pos") - 1).drop("__one")
    chunks = pos.groupBy(child_key, F.floor(F.col("__pos") / chunk_size).cast("long").alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("__pos"), *[F.col(c) for c in cols]))).alias("__items"))
    return chunks.select(child_key, "chunk", F.size("__items").alias("n"),
                         F.transform("__items", lambda x: F.struct(*[x[c].alias(c) for c in cols]))
                         .alias(as_col))
