"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order that depends
only on the document and a seed.  A document's virtual finish time is
(tokens of its source up to and including it) / (target tokens of its
source); a second and third pass over a source go on counting where the
first ended.  All queued copies, sorted by finish time, are the mix, cut
where the total budget is used up.

DataFrame functions only.  Nothing is summed along a whole source in one
task: cumulative tokens are taken within slices of the shuffled order and
the slices' totals are summed before them.  The cut looks at totals of
narrow finish-time slices and then at the rows of the one slice in which
the budget ends.

Defined results: a null text has 0 words and is taken (it costs nothing)
as often as its finish time allows, giving 0 words; a null source is a
source of its own and sorts last; rows equal in doc_id, source and text are
queued side by side as one entry and get the same decision; an empty table
gives an empty mix.  Columns besides doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import fresh, word_count, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: Slices of finish time: so many for each unit below 2, beyond it so many
#: for each doubling.
SLICES = 16384
#: Rows of one array when equal rows are dealt out again.
COPIES = 100_000


def entry_key(doc_id: Column, text: Column, seed: int = 0) -> Column:
    """Sort key of the shuffled order: the same for equal documents only."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(F.md5(text.cast("binary")), F.lit("null"))))


def targets(per_source: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size -> also target (double).

    The n-th source by code point (null last) has weight n of ``weights``,
    repeating.  The total of all sizes is shared by weight; a target above
    ``max_repeat`` times its source's size stops there and the excess is
    shared again.  In order of cap / weight the capped sources come first,
    so running sums find them without a loop.  One row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    s = per_source.withColumn("nth", F.row_number().over(by_name))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * max_repeat)
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "nth")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(1))
    s = s.withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "weights_left": F.sum("weight").over(rest),
    })
    capped = F.col("cap") * F.col("weights_left") <= F.col("weight") * F.col("left")
    s = s.withColumn("capped", capped)
    # the first source that isn't capped fixes the level for all after it
    at = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "nth", "left", "weights_left"))).over(everything)
    s = s.withColumn("at", at)
    share = F.col("weight").cast("double") * F.col("at.left").cast("double") / F.col("at.weights_left").cast("double")
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def queue(docs: DataFrame, size: Column, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 0) -> tuple[DataFrame, int]:
    """A row for each distinct (doc_id, source, text): n rows of it, size of
    one, key, source_size, target, upto (its source's tokens up to and
    including it); and the total of all sizes.  ``size`` is a column made
    from those of ``docs``."""
    entries = docs.select("doc_id", "source", size.cast("long").alias("size"), entry_key(F.col("doc_id"), F.col("text"), seed).alias("key"))
    entries = written(entries.groupBy("doc_id", "source", "size", "key").agg(F.count("*").alias("n")), "mix-entries")
    entries = entries.withColumns({"all": F.col("n") * F.col("size"), "slice": F.substring("key", 1, 3)})

    per_slice = entries.groupBy("source", "slice").agg(F.sum("all").alias("in_slice"))
    per_slice = per_slice.withColumn("before", F.sum("in_slice").over(W.partitionBy("source").orderBy("slice")) - F.col("in_slice"))
    per_source = targets(per_slice.groupBy("source").agg(F.sum("in_slice").alias("source_size")), weights, max_repeat)
    starts = per_slice.alias("p").join(per_source.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source"))).select("p.source", "slice", "before", "source_size", "target")

    e, s = entries.alias("e"), starts.alias("s")
    q = e.join(s, F.col("e.source").eqNullSafe(F.col("s.source")) & (F.col("e.slice") == F.col("s.slice")))
    q = q.select("doc_id", "e.source", "size", "key", "n", "all", "e.slice", "before", "source_size", "target")
    inside = W.partitionBy("source", "slice").orderBy("key", "doc_id", "size")
    q = q.withColumn("upto", F.col("before") + F.sum("all").over(inside)).drop("slice", "before")
    total = entries.agg(F.sum("all")).first()[0] or 0
    return written(q, "mix-queue"), total


def finish(epoch: Column) -> Column:
    """Virtual finish time of a queued document's copy in a pass (from 0)."""
    return (epoch * F.col("source_size") + F.col("upto")).cast("double") / F.when(F.col("target") > 0, F.col("target"))


def decide(queued: DataFrame, budget: int, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``queued`` with times: of how many passes the copies lie before the
    point of the sorted mix at which the budget is used up."""
    copies = queued.select("key", "doc_id", "source", "all", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))).alias("epoch"), "source_size", "target", "upto")
    copies = copies.withColumn("t", finish(F.col("epoch"))).where("t is not null")
    t = F.col("t")
    copies = copies.withColumn("at", F.when(t < 2, F.floor(t * SLICES)).otherwise(2 * SLICES + F.floor(F.log2(t / 2) * SLICES)))
    # sums of slices; the mix ends in the first whose running sum passes the budget
    sums = copies.groupBy("at").agg(F.sum("all").alias("tokens"))
    sums = sums.withColumn("upto", F.sum("tokens").over(W.orderBy("at")))
    last = sums.where(F.col("upto") > budget).orderBy("at").limit(1).first()
    order = F.struct("t", "key", "doc_id", F.col("source").alias("source"), "epoch")
    if last is None:  # all copies fit
        return queued.withColumn("times", F.when(F.col("target") > 0, F.lit(max_repeat)).otherwise(0))
    ending = copies.where(F.col("at") == last["at"]).withColumn("o", order)
    ending = ending.withColumn("sum", F.sum("all").over(W.orderBy("o")) + (last["upto"] - last["tokens"]))
    stop = ending.where(F.col("sum") > budget).agg(F.min("o").alias("o")).first()["o"]
    end = F.struct(F.lit(stop["t"]).alias("t"), F.lit(stop["key"]).alias("key"), F.lit(stop["doc_id"]).cast(queued.schema["doc_id"].dataType).alias("doc_id"), F.lit(stop["source"]).cast("string").alias("source"), F.lit(stop["epoch"]).alias("epoch"))
    kept = [F.when(F.struct(finish(F.lit(e)).alias("t"), "key", "doc_id", "source", F.lit(e).alias("epoch")) < end, 1).otherwise(0) for e in range(max_repeat)]
    return queued.withColumn("times", F.when(F.col("target") > 0, sum(kept[1:], kept[0])).otherwise(0))


def mix_report(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    times, taken (words the mix takes, repeats counted)."""
    queued, total = queue(docs, word_count(F.col("text")), weights, max_repeat, seed)
    out = decide(queued, total, max_repeat).withColumn("taken", F.col("times") * F.col("size"))
    parts = out.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES))))
    rows = parts.withColumn("one", F.explode(F.sequence(F.lit(1), F.least(F.lit(COPIES), F.col("n") - F.col("part") * COPIES))))
    return rows.select("doc_id", "source", "size", "source_size", "target", F.col("times").cast("int").alias("times"), F.col("taken").cast("long").alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 0) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, in
    the order of virtual finish time over the whole result."""
    queued, total = queue(docs, word_count(F.col("text")), weights, max_repeat, seed)
    chosen = decide(queued, total, max_repeat).where("times > 0")
    key, when, k, s, finishes = fresh(docs, "mix_key", "mix_finish", "mix_entry", "mix_source", "mix_finishes")
    chosen = chosen.select(F.col("key").alias(k), F.col("source").alias(s), F.transform(F.sequence(F.lit(0), F.col("times") - 1), finish).alias(finishes))
    keyed = docs.withColumn(key, entry_key(F.col("doc_id"), F.col("text"), seed))
    rows = keyed.join(chosen, (F.col(key) == F.col(k)) & F.col("source").eqNullSafe(F.col(s)))
    rows = rows.select(*docs.columns, key, F.explode(finishes).alias(when))
    return rows.orderBy(when, key).select(*docs.columns)


#: The report in DuckDB's SQL, over all documents.
REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS key
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM s0),
s2 AS (SELECT *, CASE (nth - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s1),
s3 AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest FROM s2),
s4 AS (SELECT *, cap * w_rest <= weight * rest AS capped FROM s3),
s5 AS (SELECT *, first_value(rest) OVER (ORDER BY capped, cap / weight, nth) AS r, first_value(w_rest) OVER (ORDER BY capped, cap / weight, nth) AS w FROM s4),
s AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE CAST(weight AS DOUBLE) * CAST(r AS DOUBLE) / CAST(w AS DOUBLE) END AS target FROM s5),
q AS (
  SELECT d.doc_id, d.source, d.size, d.key, s.source_size, s.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
c AS (
  SELECT q.*, e.epoch, CAST(e.epoch * source_size + upto AS DOUBLE) / target AS t
  FROM q, (SELECT unnest([0, 1, 2]) AS epoch) e WHERE target > 0),
m AS (SELECT *, sum(size) OVER (ORDER BY t, key, doc_id, source, epoch RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM c)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, CAST(coalesce(k.times, 0) AS INTEGER) AS times, CAST(coalesce(k.times, 0) * q.size AS BIGINT) AS taken
FROM q LEFT JOIN (SELECT key, source, count(DISTINCT epoch) AS times FROM m WHERE used <= (SELECT sum(size) FROM d) GROUP BY ALL) k
  ON q.key = k.key AND q.source IS NOT DISTINCT FROM k.source
"""
