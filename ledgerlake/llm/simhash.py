"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint has a bit set where over half of the document's shingle
hashes have it.  Distinct fingerprints at most ``radius`` bits apart are
linked; documents of linked fingerprints form a group.

Candidates: 64 bits are cut into radius + 2 blocks, so two fingerprints
within the radius agree on two whole blocks at least; fingerprints meet in
a bucket for each pair of blocks.  Within a bucket the bits lie in vertical
planes (one bit of each fingerprint side by side); a shift by d puts row i
beside row i + d, and carry-save counters made of bitwise operations count
the differing planes of all these pairs at once.  Words in which all pairs
exceed the radius are abandoned part of the way.

Scale: equal fingerprints are one row from the start, so copies cost
nothing.  A bucket over ``CHUNK`` rows is dealt into chunks and each pair of
chunks is compared in a cell of its own, so nothing is left out and no task
holds a whole bucket.  A cell returns a star (each row and the smallest it
is connected to), not its pairs.  Components come from alternating large-
and small-star steps, each a minimum and a join, written to the shared
folder.

Defined results: a null or blank text has fingerprint 0, linked like any
other; fewer words than a shingle give one shingle, the whole sequence; a
group whose doc_ids are all null has a null component_id; repeated rows
have the same fingerprint and group; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import fresh, written

SEED = 42
CHUNK = 2048
#: Planes counted before words without a pair within the radius are left.
PLANES = 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash64(flat, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    hashes = np.array([hash64(flat[a:b], SEED) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(name, of("text"))


def hexed(column: str):
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")


def near(prints: np.ndarray, ends: np.ndarray, radius: int):
    """Yields (i, j) arrays of rows within the radius; ``prints`` (uint64) lie
    group by group and ``ends`` has each row's end of group."""
    bits = np.ascontiguousarray(np.unpackbits(prints.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).T)
    counters, shift = radius.bit_length(), 1
    rows = np.flatnonzero(np.arange(len(prints)) + 1 < ends)
    while len(rows):
        differ = np.packbits(bits[:, rows], axis=1) ^ np.packbits(bits[:, rows + shift], axis=1)
        width = differ.shape[1]
        words = np.arange(width)  # those that still have a pair within the radius
        count = [np.zeros(width, np.uint8) for _ in range(counters)]
        over = np.zeros(width, np.uint8)
        for first in range(0, 64, PLANES):
            for plane in differ[first : first + PLANES]:
                carry = plane
                for c in range(counters):
                    count[c], carry = count[c] ^ carry, count[c] & carry
                over |= carry
            beyond, same = over.copy(), np.full(len(words), 255, np.uint8)
            for c in reversed(range(counters)):
                if radius >> c & 1:
                    same &= count[c]
                else:
                    beyond |= same & count[c]
                    same &= ~count[c]
            left = beyond != 255
            if not left.any():
                words = words[:0]
                break
            if not left.all():
                differ, words, over, beyond, count = differ[:, left], words[left], over[left], beyond[left], [c[left] for c in count]
        if len(words):
            ok = np.zeros(width, np.uint8)
            ok[words] = ~beyond
            hit = np.flatnonzero(np.unpackbits(ok)[: len(rows)])
            if len(hit):
                yield rows[hit], rows[hit] + shift
        shift += 1
        rows = rows[rows + shift < ends[rows]]


def stars(prints: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked prints of each group as (print, smallest print of its star)."""
    change = np.flatnonzero(np.diff(groups)) + 1
    bounds = np.append(change, len(prints))
    ends = bounds[np.searchsorted(bounds, np.arange(len(prints)), side="right")]
    top = np.arange(len(prints))
    for i, j in near(prints, ends, radius):
        while True:
            a, b = top[i], top[j]
            if (a == b).all():
                break
            np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
            while (top[top] != top).any():
                top = top[top]
    low = np.flatnonzero(top != np.arange(len(prints)))
    return prints[low], prints[top[low]]


def links(prints: DataFrame, radius: int = 2, column: str = "fp") -> DataFrame:
    """Distinct fingerprints -> links (a, b) whose components are those of
    all pairs within the radius."""
    cuts = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    masks = [sum(((1 << hi) - (1 << lo)) for lo, hi in pair) for pair in combinations(list(zip(cuts, cuts[1:])), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(n).cast("short").alias("pair"), F.col(column).bitwiseAND(F.lit(m).cast("long")).alias("key")) for n, m in enumerate(signed)])
    met = prints.select(F.col(column).alias("fp"), F.explode(keys).alias("k")).select("fp", "k.pair", "k.key")
    shared = met.groupBy("pair", "key").agg(F.count("*").alias("m")).where("m > 1")
    met = met.join(shared, ["pair", "key"])
    chunks = F.ceil(F.col("m") / CHUNK)
    met = met.withColumn("chunk", F.pmod(F.xxhash64("fp"), chunks))
    other = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda x: (chunks == 1) | (x != F.col("chunk"))))
    cells = met.select("fp", "pair", "key", "chunk", other.alias("other")).select("fp", "pair", "key", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
    group = ["pair", "key", "lo", "hi"]
    cells = cells.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group, "fp")

    def compare(batches):
        rest = None
        for batch in batches:
            both = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            change = (both[group] != both[group].shift()).any(axis=1).to_numpy()
            last = int(np.flatnonzero(change)[-1])  # the last group may go on in the next batch
            rest = both.iloc[last:]
            if last:
                yield starred(both.iloc[:last], np.cumsum(change[:last]))
        if rest is not None and len(rest):
            yield starred(rest, np.zeros(len(rest), np.int64))

    def starred(rows, groups):
        prints = rows["fp"].to_numpy(np.int64).view(np.uint64)
        a, b = stars(prints, groups, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return cells.mapInPandas(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs -> node, root (the smallest node connected)."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        # large star: larger neighbours go to the smallest of the neighbourhood
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "edges")
        # small star: a node and its smaller neighbours go to the smallest of these
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = written(pairs.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def group_of(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(doc_id, fp), a row for each document -> fp, root (of the fp's group)
    and component_id (smallest doc_id of the group), a row for each fp."""
    reps = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    linked = components(links(reps, radius))
    rooted = reps.join(linked, reps.fp == linked.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = written(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "fingerprints")
    found = group_of(prints, radius)
    return prints.join(found, "fp", "left").select("doc_id", hexed("fp").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` of which one stays for each group: the smallest
    doc_id's, then the smallest text hash's; of equal rows one."""
    prints = with_fingerprint(docs.select("doc_id", "text"), shingle)
    prints = written(prints.select("doc_id", F.xxhash64("text").alias("t"), "fp"), "fingerprints")
    found = group_of(prints.select("doc_id", "fp"), radius)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")
    name, id, t = fresh(docs, "text_hash", "kept_id", "kept_hash")
    kept = prints.join(found, "fp").groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias(id), F.col("k.t").alias(t))
    rows = docs.withColumn(name, F.xxhash64("text"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col(id)) & (F.col(name) == F.col(t)), "left_semi")
    return rows.dropDuplicates(["doc_id", name]).select(*docs.columns)
