"""Approximate nearest neighbours by a hash-prefix forest.

Rows are dealt into shards by a hash of their vector.  A shard's forest has
``TREES`` sorted arrays of ``BITS``-bit strings, the signs of a row's
products with random directions.  A query descends in each array to the rows
with the longest common prefix and then ascends in all arrays at the same
time, one bit less each step, which widens each array's range of candidates.
It stops at the prefix length at which a row as near as the k-th best so far
would have been met in one of the arrays with probability ``SURE``.
Candidates' cosines are computed in double precision on the vectors as they
are.

Equal vectors are one row of the index with their k + 1 smallest ids (a
query can exclude one of them only), so copies neither fill a shard nor hide
others.  A task holds one shard (about ``ROWS`` rows) and reads the query
set behind it batch by batch; queries go to every shard, and k + 1 rows for
each come back.

Defined results: vectors that are null, zero or have a null or non-finite
component, and rows without an id, take no part; vectors are compared with
those of their own length only; rows equal in id and vector count once;
fewer candidates than k are all returned; equal cosines go by id; an empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import written

TREES, BITS, SURE = 24, 32, 0.95
ROWS = 8192
#: Candidates at least before the first look at how near they are.
FIRST = 64
#: More than products of rounded unit vectors can be off by.
ROUNDING = 1e-9


def usable(v: Column) -> Column:
    """No null or non-finite component, and one that isn't zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


class Forest:
    def __init__(self, vectors: np.ndarray, seed: int = 7):
        n, dim = vectors.shape
        self.vectors = vectors
        self.units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.planes = np.random.default_rng(seed).standard_normal((dim, TREES * BITS))
        codes = self.codes(self.units)
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.sorted = [codes[self.order[:, t], t] for t in range(TREES)]

    def codes(self, units: np.ndarray) -> np.ndarray:
        """Bit strings by row and tree, as numbers."""
        bits = (units @ self.planes > 0).reshape(len(units), TREES, BITS)
        return bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def ranges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the arrays by query, tree and prefix length."""
        lo = np.zeros((len(codes), TREES, BITS + 1), np.int64)
        hi = np.zeros_like(lo)
        for t, have in enumerate(self.sorted):
            for x in range(BITS + 1):
                first = codes[:, t] >> (BITS - x) << (BITS - x)
                lo[:, t, x] = np.searchsorted(have, first)
                hi[:, t, x] = np.searchsorted(have, first + (np.int64(1) << (BITS - x)))
        return lo, hi

    def search(self, queries: np.ndarray, k: int):
        """For each query: the k rows found, and all that rounding can't tell
        from the last of them, with their exact cosines."""
        lengths = np.linalg.norm(self.vectors, axis=1)
        units = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        lo, hi = self.ranges(self.codes(units))
        met = np.zeros(len(self.units), bool)
        for q, unit in enumerate(units):
            def at(x: int) -> tuple[np.ndarray, np.ndarray]:
                met[:] = False
                for t in range(TREES):
                    met[self.order[lo[q, t, x] : hi[q, t, x], t]] = True
                rows = np.flatnonzero(met)
                return rows, self.units[rows] @ unit

            widths = (hi[q] - lo[q]).sum(0)  # by prefix length, never growing with it
            x = int(np.flatnonzero(widths >= min(FIRST, widths[0]))[-1])
            rows, near = at(x)
            while x and (enough := self.level(near, k)) < x:
                x = enough
                rows, near = at(x)
            if len(near) > k:
                rows = rows[near >= np.partition(near, -k)[-k] - ROUNDING]
            yield rows, self.vectors[rows] @ queries[q] / (lengths[rows] * np.linalg.norm(queries[q]))

    @staticmethod
    def level(near: np.ndarray, k: int) -> int:
        """Prefix length down to which a row as near as the k-th found is met
        with probability ``SURE``."""
        if len(near) < k:
            return 0
        same = 1 - np.arccos(np.clip(np.partition(near, -k)[-k], -1, 1 - 1e-12)) / np.pi
        need = 1 - (1 - SURE) ** (1 / TREES)
        return BITS if same**BITS >= need else int(np.log(need) / np.log(same)) if same > 0 else 0


def nearest(rows: DataFrame, is_query: Column, k: int = 5, rows_in_shard: int = ROWS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found for
    each row of ``rows`` for which ``is_query`` (a column of theirs) holds."""
    good = rows.where(F.col(id).isNotNull() & usable(F.col(vector)))
    good = good.select(F.col(id).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    good = written(good.groupBy("i", "v").agg(F.max("asks").alias("asks")), "vectors")
    nth = F.row_number().over(W.partitionBy("v").orderBy("i"))
    index = good.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("i")).alias("ids"))
    index = written(index, "distinct-vectors")
    shards = max(1, -(-index.count() // rows_in_shard))
    asked = written(good.where("asks").groupBy("v").agg(F.min("i").alias("q")), "queries")

    have = index.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), F.col("ids")[0].alias("id"), "ids", "v")
    ask = asked.select(F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), F.col("q").alias("id"), F.lit(None).cast("array<long>").alias("ids"), "v")
    cells = have.union(ask).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind", "id")

    def search(batches):
        now, held, ids, forest = None, [], [], None
        for batch in batches:
            for cell, part in batch.groupby(["dim", "shard"], sort=False):
                if cell != now:
                    now, held, ids, forest = cell, [], [], None
                mine = part[part["kind"] == 0]
                if len(mine):
                    held.append(np.stack(mine["v"].to_numpy()))
                    ids += mine["ids"].tolist()
                asks = part[part["kind"] == 1]
                if not len(asks) or not held:
                    continue
                if forest is None:
                    forest = Forest(np.concatenate(held))
                out = []
                for at in range(0, len(asks), 256):
                    some = asks.iloc[at : at + 256]
                    for q, (found, score) in zip(some["id"], forest.search(np.stack(some["v"].to_numpy()), k + 1)):
                        near = sorted((-s, int(i)) for r, s in zip(found, score.tolist()) for i in ids[r])[: k + 1]
                        out += [(q, i, -s) for s, i in near]
                yield pd.DataFrame(out, columns=["q", "vec_id", "score"])

    found = cells.mapInPandas(search, "q long, vec_id long, score double")
    order = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("n", order).where(F.col("n") <= k + 1).drop("n")
    mine = good.where("asks").join(asked, "v").select(F.col("i").alias("query_id"), "q")
    out = mine.join(found, "q").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
