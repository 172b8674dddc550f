"""Hard negatives by Fagin's threshold algorithm.

A row's components are floor(256 x), scores are integer inner products.  An
anchor's positives are the best rows of its label; each positive opens a
window of scores in which the best rows of other labels are its negatives.

Rows are dealt into shards by a hash of their vector.  A shard keeps a list
of its rows for each dimension, sorted by component.  For an anchor the
lists are read in step, from the top where the anchor's component is
positive and from the bottom where it is negative; a row met for the first
time is scored whole by random access.  No row still unmet can score above
the threshold, the anchor's product with the components at which the lists
stand.  A shard's search ends once the threshold is strictly below the k-th
score of every window (or below the window itself); strictly, as an unmet
row that ties may have a smaller id.  So results are exact.

Anchors go to every shard: a stated query set against all rows, in blocks.
First the shards' positives are merged and give the windows, then the
shards' negatives are merged.  Rows equal in vector and label are one row of
a shard with their smallest ids, as many as can be asked for, so a group of
copies neither fills a shard nor hides others.  A task holds one shard
(``ROWS`` rows) and reads the anchors behind it batch by batch.

Defined results: rows with a null id, label or vector, or a null or
non-finite component take no part; rows equal in id, vector and label count
once; an anchor is no negative or positive of its own id; vectors meet those
of their own length only; scores are exact, of any size, and one beyond a
long is returned as the nearest long; windows of negative positives are
empty; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import written

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of its positive's.
LEAST, MOST = 30, 90
SCALE = 256
ROWS = 8192
#: Rows read from each list before the first look at the threshold.
FIRST = 16
LONG = (1 << 63) - 1


def usable(v: Column) -> Column:
    """Not null, and no null or non-finite component."""
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def scaled(v: Column) -> Column:
    """floor(256 x) of each component, as doubles (a double of 2^52 or more is whole)."""

    def down(x: Column) -> Column:
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    return F.transform(v, down)


def whole(numbers: np.ndarray) -> np.ndarray:
    """Python's integers, exact at any size."""
    return np.frompyfunc(int, 1, 1)(numbers)


class Lists:
    """The sorted lists of a shard's distinct rows (whole numbers as doubles)."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: list[list[int]]):
        self.vectors, self.labels, self.ids = vectors, labels, ids
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.products = np.abs(vectors).max(initial=1) * max(vectors.shape[1], 1)
        self.kinds = {np.float64: vectors}

    def kind(self, anchor: np.ndarray):
        """The smallest type in which whole numbers add up exactly."""
        top = self.products * np.abs(anchor).max(initial=0)
        return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else object

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        kind = self.kind(anchor)
        if kind not in self.kinds:
            self.kinds[kind] = self.vectors.astype(kind) if kind is np.float32 else whole(self.vectors)
        return self.kinds[kind][rows] @ (whole(anchor) if kind is object else anchor.astype(kind))

    def met(self, anchor: np.ndarray):
        """Yields (rows first met, their scores, threshold) as the lists are
        read, twice as deep each time; the threshold is None once no row is
        unmet.  Fewer unmet rows than lists are scored at once, as one more
        step of all lists would cost that much."""
        n = len(self.vectors)
        falling, rising = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        lists = np.concatenate([falling, rising])
        new = np.ones(n, bool)
        depth, last = 0, FIRST
        while len(lists) and last < n:
            here = np.zeros(n, bool)
            here[self.order[n - last : n - depth, falling]] = True
            here[self.order[depth:last, rising]] = True
            rows = np.flatnonzero(here & new)
            new[rows] = False
            if np.count_nonzero(new) < len(lists):
                rows = np.concatenate([rows, np.flatnonzero(new)])
                yield rows, self.scores(rows, anchor), None
                return
            ends = np.concatenate([self.vectors[self.order[n - last, falling], falling], self.vectors[self.order[last - 1, rising], rising]])
            threshold = whole(ends) @ whole(anchor[lists]) if self.kind(anchor) is object else ends @ anchor[lists]
            yield rows, self.scores(rows, anchor), threshold
            depth, last = last, 2 * last
        rows = np.flatnonzero(new)
        yield rows, self.scores(rows, anchor), None

    def search(self, anchor: np.ndarray, me: int, wanted, windows: list[tuple], k: int) -> list[list[tuple]]:
        """For each window (lowest, highest score; None: open) the k best
        (score, id) of the rows whose label is ``wanted``, but not ``me``."""
        found = [[] for _ in windows]
        for rows, scores, threshold in self.met(anchor):
            fit = wanted(self.labels[rows])
            rows, scores = rows[fit], scores[fit]
            found = [self.best(have, rows, scores, low, high, me, k) for have, (low, high) in zip(found, windows)]
            if threshold is None or all((low is not None and (threshold < low or low > high)) or (len(x) == k and threshold < x[-1][0]) for x, (low, high) in zip(found, windows)):
                break
        return found

    def best(self, have: list[tuple], rows, scores, low, high, me: int, k: int) -> list[tuple]:
        """The k best of a window so far and of more rows."""
        if len(have) == k:
            low = have[-1][0]
        fit = np.ones(len(rows), bool)
        if low is not None:
            fit &= scores >= low
        if high is not None:
            fit &= scores <= high
        rows, scores = rows[fit], scores[fit]
        if len(rows) > k + 1:  # distinct rows; one of them may be the anchor's
            edge = np.sort(scores)[-k - 1]
            rows, scores = rows[scores >= edge], scores[scores >= edge]
        every = [(-s, i) for s, i in have] + [(-int(s), i) for r, s in zip(rows, scores) for i in self.ids[r] if i != me]
        return [(-s, i) for s, i in sorted(every)[:k]]


def window(positive: int) -> tuple[int, int]:
    """Lowest and highest score of a positive's negatives."""
    return -(-LEAST * positive // 100), MOST * positive // 100


def descending(score: str) -> list[Column]:
    """Order of whole numbers written as texts, largest first: by sign, then
    by the number of digits and the digits, which count the other way below 0."""
    text, below = F.col(score), F.col(score).startswith("-")
    length = F.when(below, -F.length(text)).otherwise(F.length(text))
    digits = F.when(below, F.translate(text, "0123456789", "9876543210")).otherwise(text)
    return [below.asc(), length.desc(), digits.desc()]


def _searched(index: DataFrame, asked: DataFrame, shards: int, ask, schema: str) -> DataFrame:
    """``ask(lists, row)`` gives result rows for each row of ``asked``, sent
    to every shard of the index of its vectors' length."""
    columns = "dim", "shard", "kind", "anchor", "id", "label", "v", "ids", "positives"
    have = index.withColumns({"shard": F.pmod(F.xxhash64("v"), F.lit(shards)), "kind": F.lit(0), "anchor": F.lit(None).cast("long"), "id": F.lit(None).cast("long"), "positives": F.lit(None).cast("array<string>")})
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    asks = asked.withColumns({"shard": each, "kind": F.lit(1), "ids": F.lit(None).cast("array<long>")})
    cells = have.select(*columns).union(asks.select(*columns)).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    names = [c.split()[0] for c in schema.split(", ")]

    def search(batches):
        now, held, lists = None, [], None
        for batch in batches:
            for cell, part in batch.groupby(["dim", "shard"], sort=False):
                if cell != now:
                    now, held, lists = cell, [], None
                mine = part[part["kind"] == 0]
                if len(mine):
                    held.append(mine)
                asks = part[part["kind"] == 1]
                if not len(asks) or not held:
                    continue
                if lists is None:
                    rows = pd.concat(held)
                    vectors = np.stack([np.asarray(v, float) for v in rows["v"]])
                    lists, held = Lists(vectors, rows["label"].to_numpy(np.int64), [list(map(int, i)) for i in rows["ids"]]), [None]
                out = [row for r in asks.itertuples(index=False) for row in ask(lists, r)]
                yield pd.DataFrame(out, columns=names)

    return cells.mapInPandas(search, schema)


def mine(rows: DataFrame, is_anchor: Column, id: str = "vec_id", vector: str = "embedding", label: str | Column = "label", rows_in_shard: int = ROWS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score for each row of ``rows`` for which ``is_anchor`` holds."""
    label = F.col(label) if isinstance(label, str) else label
    good = rows.where(F.col(id).isNotNull() & label.isNotNull() & usable(F.col(vector)))
    good = good.select(F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), scaled(F.col(vector)).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    good = good.where(F.forall("v", lambda x: F.abs(x) < float("inf")))
    good = written(good.groupBy("id", "label", "v").agg(F.max("asks").alias("asks")), "vectors")
    # an anchor leaves out one id at most
    k = max(POSITIVES + 1, NEGATIVES)
    nth = F.row_number().over(W.partitionBy("label", "v").orderBy("id"))
    index = good.withColumn("nth", nth).where(F.col("nth") <= k).groupBy("label", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    index = written(index.select(F.size("v").alias("dim"), "label", "v", "ids"), "index")
    shards = max(1, -(-index.count() // rows_in_shard))
    anchors = good.where("asks").select(F.monotonically_increasing_id().alias("anchor"), F.size("v").alias("dim"), "id", "label", "v")
    anchors = written(anchors, "anchors")

    # scores travel as texts, whole at any size
    def positives(lists, r):
        found = lists.search(np.asarray(r.v, float), r.id, lambda labels: labels == r.label, [(None, None)], POSITIVES)
        return [(r.anchor, i, str(s)) for s, i in found[0]]

    def negatives(lists, r):
        kept = [x.split(":") for x in r.positives]
        found = lists.search(np.asarray(r.v, float), r.id, lambda labels: labels != r.label, [window(int(s)) for _, s in kept], NEGATIVES)
        return [(r.anchor, r.id, int(i), s, n, str(score)) for (i, s), near in zip(kept, found) for score, n in near]

    asked = anchors.withColumn("positives", F.lit(None).cast("array<string>"))
    found = _searched(index, asked, shards, positives, "anchor long, positive_id long, score string")
    place = F.row_number().over(W.partitionBy("anchor").orderBy(*descending("score"), "positive_id"))
    found = found.withColumn("n", place).where(F.col("n") <= POSITIVES)
    pairs = found.groupBy("anchor").agg(F.collect_list(F.concat_ws(":", "positive_id", "score")).alias("positives"))
    asked = written(anchors.join(pairs, "anchor"), "positives")

    out = _searched(index, asked, shards, negatives, "anchor long, anchor_id long, positive_id long, positive string, negative_id long, score string")
    rank = F.row_number().over(W.partitionBy("anchor", "positive_id").orderBy(*descending("score"), "negative_id"))
    out = out.withColumn("rank", rank).where(F.col("rank") <= NEGATIVES)
    end = lambda c: F.when(F.col(c).startswith("-"), F.lit(-LONG - 1)).otherwise(F.lit(LONG))
    long = lambda c: F.coalesce(F.col(c).try_cast("long"), end(c))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", long("positive").alias("positive_score"), long("score").alias("negative_score"))


#: The query in DuckDB's SQL: every anchor against every row.
MINE_SQL = """
WITH good AS (
  SELECT DISTINCT vec_id AS id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM good a JOIN good b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INT AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
