"""Data-quality operators.

A rule is a name and a boolean Column that is true for a *bad* row.
``rule_counts`` checks any number of rules in one scan (one partial
aggregate) and returns one row per rule with the number of violations,
zero included.  ``violations`` returns the offending rows with the names
of the rules they break.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: (rule, n_bad).  NULL predicates count as passing."""
    names = list(rules)
    aggs = [F.count_if(F.coalesce(rules[n], F.lit(False))).alias(f"__r{i}")
            for i, n in enumerate(names)]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"__r{i}").cast("bigint").alias("n_bad"))
                     for i, n in enumerate(names)])
    return wide.select(F.inline(rows))


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking at least one rule, with ``broken_rules`` (array)."""
    flags = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n))
                                      for n, c in rules.items()]))
    return df.withColumn("broken_rules", flags).where(F.size("broken_rules") > 0)


def union_counts(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fk_orphans(child: DataFrame, relations: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Rows of ``child`` whose non-NULL key has no parent, one row
    (relation, n_orphans) for each of ``relations`` (relation, fk, parent, pk).

    One scan of the child: its keys are unrolled with the relation's number
    and counted (a map-side partial aggregate, so a hot key crosses the
    shuffle as one row per map task).  The parents' keys, tagged the same
    way, are the right side of one anti join, which needs no distinct."""
    keys = F.array(*[F.struct(F.lit(n).alias("r"), F.col(fk).cast("string").alias("k"))
                     for n, (_, fk, _, _) in enumerate(relations)])
    counted = (child.select(F.inline(keys)).where(F.col("k").isNotNull())
               .groupBy("r", "k").agg(F.count(F.lit(1)).alias("n")))
    parents = None
    for n, (_, _, parent, pk) in enumerate(relations):
        p = parent.select(F.lit(n).alias("r"), F.col(pk).cast("string").alias("k"))
        parents = p if parents is None else parents.unionByName(p)
    orphans = counted.join(parents, ["r", "k"], "left_anti")
    wide = orphans.agg(*[F.coalesce(F.sum(F.when(F.col("r") == n, F.col("n"))), F.lit(0)).cast("bigint").alias(f"__r{n}")
                         for n in range(len(relations))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("relation"), F.col(f"__r{n}").alias("n_orphans"))
        for n, (name, *_) in enumerate(relations)])))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def required_rules(paths: Sequence[str], prefix: str = "") -> dict[str, Column]:
    """V1: a field is missing; a nested field counts only when its parent
    is present (like a nested ``required`` list)."""
    rules = {}
    for p in paths:
        parts = p.split(".")
        bad = F.col(p).isNull()
        if len(parts) > 1:
            bad = F.col(".".join(parts[:-1])).isNotNull() & bad
        rules[f"{prefix}required:{p}"] = bad
    return rules


def type_rules(df: DataFrame, types: Mapping[str, str], prefix: str = "") -> dict[str, Column]:
    """V2: a value present as text that does not read as its declared type."""
    return {f"{prefix}type:{c}:{t}": F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull()
            for c, t in types.items()}


def pattern_rule(c: str, regex: str) -> Column:
    """V3: value does not match the pattern."""
    return F.col(c).isNotNull() & ~F.col(c).rlike(regex)


def outside(c: Column, lo, hi) -> Column:
    """V4/V6/V9: value outside [lo, hi]."""
    return ~c.between(lo, hi)


def not_in(c: Column, allowed: Sequence) -> Column:
    """Value not in the allowed set."""
    return c.isNotNull() & ~c.isin(list(allowed))
