"""SpotSigs document fingerprints.

A spot is a common word (an anchor) with the chain of the next ``CHAIN``
content words within ``SPAN`` words; the set of a text's hashed spots is its
fingerprint.  Likeness is the Jaccard measure of two sets.  Sets whose
lengths differ too much can't be alike, so ``near`` partitions them by
length, meets only those that share one of their rarest spots, and computes
the measure for what is left.

DataFrame functions only.  Whole texts are split into words once for each
fingerprint.

doc_ids are taken for identifiers: a slice holds at most 2 ** SLICE of them,
but rows that repeat one doc_id lie in one slice.

Defined results: a null text counts as empty; a text without a spot (no
anchor, or too few words after it) has one signature made from its whole
text, so only equal texts are alike then; words are runs of letters and
digits, lower-cased; documents are ordered by doc_id (null first), rows of
one doc_id by the hash of their text; an only document is followed by
itself; an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import written

#: Common words of four languages (fixed values).
ANCHORS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "was", "for", "on",
    "der", "die", "das", "und", "ist", "den", "von", "zu", "nicht", "mit",
    "le", "la", "les", "de", "des", "et", "un", "une", "est", "en", "que",
    "el", "los", "las", "y", "es", "del", "por", "con",
)
CHAIN, SPAN = 2, 8
#: Documents are walked in slices of 2 ** SLICE doc_ids; slices in groups of
#: 2 ** GROUP slices.
SLICE, GROUP = 10, 12


def let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def spots(text: Column) -> Column:
    """Sorted distinct signatures (60 bits of an MD5, as longs)."""
    signed = lambda s: F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")

    def chain(words: Column, anchor: Column, at: Column) -> Column:
        content = F.slice(F.filter(F.slice(words, at + 2, SPAN), lambda w: ~w.isin(*ANCHORS)), 1, CHAIN)
        return let(content, lambda c: F.when(F.size(c) == CHAIN, signed(F.concat_ws(" ", anchor, c).cast("binary"))))

    def of(words: Column) -> Column:
        return F.filter(F.transform(words, lambda w, at: F.when(w.isin(*ANCHORS), chain(words, w, at))), lambda s: s.isNotNull())

    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    found = F.array_sort(F.array_distinct(let(words, of)))
    return let(found, lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(signed(F.concat(F.lit("="), text).cast("binary")))))


def shown(signatures: Column) -> Column:
    """A fingerprint as text: 15 hex digits for each signature."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 15, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard measure of two sets."""
    both = let(F.size(F.array_intersect(a, b)), lambda n: n.cast("double") / (F.size(a) + F.size(b) - n))
    return both


def follow(heads: DataFrame) -> DataFrame:
    """(slice, head) -> with next_head, the head of the next slice; the first
    follows the last.  Walked within groups of slices, then across groups."""
    heads = heads.withColumn("grp", F.shiftright("slice", GROUP))
    tops = heads.groupBy("grp").agg(F.min("slice").alias("s"), F.min_by("head", F.struct(F.col("slice").isNotNull(), "slice")).alias("top"))
    in_order = W.orderBy(F.col("grp").asc_nulls_first())
    everything = in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    tops = tops.select(F.col("grp").alias("g"), F.coalesce(F.lead("top").over(in_order), F.first("top").over(everything)).alias("next_top"))
    inside = F.lead("head").over(W.partitionBy("grp").orderBy(F.col("slice").asc_nulls_first()))
    return heads.withColumn("next_inside", inside).join(tops, F.col("grp").eqNullSafe(F.col("g"))).select("slice", F.coalesce("next_inside", "next_top").alias("next_head"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sigs, next_text, next_sigs: each document and the next
    in ascending order, in one shuffle of the texts.  Only the last document
    of a slice finds its next in another slice, through a small join."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumns({"h": F.xxhash64("text"), "slice": F.shiftright("doc_id", SLICE)})
    heads = d.groupBy("slice").agg(F.min(F.struct("doc_id", "h")).alias("head"))
    heads = written(follow(heads).select("slice", "next_head.doc_id", "next_head.h"), "heads")
    firsts = d.alias("d").join(heads.select("doc_id", "h").distinct().alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.h") == F.col("f.h")), "left_semi")
    firsts = firsts.dropDuplicates(["doc_id", "h"]).select(F.col("doc_id").alias("i"), F.col("h").alias("j"), "text", spots(F.col("text")).alias("sigs"))
    tails = heads.join(firsts, heads.doc_id.eqNullSafe(F.col("i")) & (heads.h == F.col("j")))
    tails = tails.select(F.coalesce("slice", F.lit(-1 << 62)).alias("s"), F.struct("text", "sigs").alias("after"))

    walk = W.partitionBy("slice").orderBy("doc_id", "h")
    d = d.withColumns({"sigs": spots(F.col("text")), "slice": F.coalesce("slice", F.lit(-1 << 62))})
    d = d.withColumn("next", F.lead(F.struct("text", "sigs")).over(walk))
    d = d.join(tails, F.col("slice") == F.col("s"), "left").withColumn("next", F.coalesce("next", "after"))
    return d.select("doc_id", "text", "sigs", F.col("next.text").alias("next_text"), F.col("next.sigs").alias("next_sigs"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (the
    last half replaced by the start of the next document) and likenesses."""
    d = with_next(docs)
    n = F.length("text")
    k = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("next_text"), F.lit(1), k))
    d = d.select("doc_id", n.cast("long").alias("n_chars"), "sigs", "next_sigs", edited.alias("edited"))
    d = d.select("doc_id", "n_chars", "sigs", "next_sigs", F.sha2(F.col("edited"), 256).alias("edited_sha256"), spots(F.col("edited")).alias("edited_sigs"))
    return d.select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("sigs")).alias("fingerprint"), shown(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def near(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """Distinct fingerprints (fp, sigs) -> links a < b with their likeness,
    ``least`` or more.  Copies are one row here; a caller keeps the members
    of each fingerprint beside.

    Sets in length class c = floor(log(length) / log(1 / least)) can only be
    like sets of classes c and c + 1.  Spots are ranked by how many sets have
    them; two sets that are alike enough share one of the rarest
    length - ceil(least * length) + 1 spots of each.
    """
    import math

    sets = written(prints.select("fp", "sigs"), "spot-sets")
    one = sets.select("fp", F.explode("sigs").alias("sig"))
    common = one.groupBy("sig").agg(F.count("*").alias("df"))
    ranked = one.join(common, "sig").groupBy("fp").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "sig"))), lambda x: x["sig"]).alias("rare"))
    n = F.size("rare")
    ranked = ranked.withColumns({"n": n, "class": F.floor(F.log(n.cast("double")) / math.log(1 / least) + 1e-9)})
    first = ranked.select("fp", "n", "class", F.explode(F.slice("rare", F.lit(1), F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1)).alias("sig"))
    own = first.select(F.col("fp").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array("class", F.col("class") + 1)).alias("class"))
    met = own.join(first, ["sig", "class"]).where((F.col("fp") != F.col("a")) & (F.least("n", "na") >= least * F.greatest("n", "na")))
    met = met.select(F.least("a", "fp").alias("a"), F.greatest("a", "fp").alias("b")).distinct()
    x, y = sets.select(F.col("fp").alias("a"), F.col("sigs").alias("sa")), sets.select(F.col("fp").alias("b"), F.col("sigs").alias("sb"))
    return met.join(x, "a").join(y, "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness")).where(F.col("likeness") >= least)


_SPOTS_SQL = """
list_sort(list_distinct(list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN list_contains(stop, w[i]) AND
  len(list_filter(w[i + 1 : i + {span}], lambda y: NOT list_contains(stop, y))) >= {chain} THEN
  substr(md5(w[i] || ' ' || array_to_string(list_filter(w[i + 1 : i + {span}], lambda y: NOT list_contains(stop, y))[1 : {chain}], ' ')), 1, 15) END), lambda s: s IS NOT NULL)))
""".format(span=SPAN, chain=CHAIN)
_SETS_SQL = """
SELECT * EXCLUDE (found, w, stop), CASE WHEN len(found) > 0 THEN found ELSE [substr(md5('=' || {text}), 1, 15)] END AS {name} FROM (
  SELECT *, {spots} AS found FROM (
    SELECT *, list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w, {stop} AS stop FROM {source}))
"""
_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in ANCHORS) + "]"

#: The query in DuckDB's SQL.
EDITED_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_text FROM d),
e AS (SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) AS edited FROM n),
a AS ({_SETS_SQL.format(text="text", name="sigs", source="e", spots=_SPOTS_SQL, stop=_STOP_SQL)}),
b AS ({_SETS_SQL.format(text="edited", name="edited_sigs", source="a", spots=_SPOTS_SQL, stop=_STOP_SQL)}),
c AS ({_SETS_SQL.format(text="next_text", name="next_sigs", source="b", spots=_SPOTS_SQL, stop=_STOP_SQL)})
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(sigs, '') AS fingerprint, array_to_string(edited_sigs, '') AS edited_fingerprint,
       CAST(len(list_intersect(sigs, edited_sigs)) AS DOUBLE) / (len(sigs) + len(edited_sigs) - len(list_intersect(sigs, edited_sigs))) AS near_edited,
       CAST(len(list_intersect(sigs, next_sigs)) AS DOUBLE) / (len(sigs) + len(next_sigs) - len(list_intersect(sigs, next_sigs))) AS near_next
FROM c
"""
