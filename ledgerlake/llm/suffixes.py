"""Exact removal of repeated byte strings by a distributed suffix array.

Wanted: every byte covered by a string of ``LENGTH`` bytes that also starts
anywhere else.  Sorting all byte suffixes of a corpus would move each byte
many times, so the suffix array is built over phrases:

1. Phrases.  In each window of gram starts that a string of LENGTH bytes
   holds, the least hashed gram of ``GRAM`` bytes (the leftmost of equal ones)
   is an anchor; equal strings have the same anchor at the same place.  An
   anchor's block is the run of starts whose strings have it.  Texts are cut
   into phrases at anchors.  A start can be repeated only if its anchor's gram
   occurs twice, so other anchors leave here; nothing is sampled.
2. Difference cover modulo 3 on the strings of phrases.  Triples of phrases
   at sampled places (not 0 modulo 3) are sorted and named in that order; the
   names are strings again, of which triples are sorted and named, until a
   name spans as many phrases as any block needs.
3. Merge.  Two suffixes are compared where both, moved on by the same 0, 1 or
   2 phrases, are at sampled places: residues 1 and 2 by name, 0 and 1 by
   phrase and name, 0 and 2 by two phrases and name.  These three orders hold
   every pair of residues.
4. Neighbours in an order compare prefixes.  A block whose covering phrases
   are a common prefix is repeated as a whole.
5. Edges.  Blocks that aren't, at the ends of repeats, are compared start by
   start with the distinct blocks of the same gram, by hashes of their strings.

Scale: places with equal keys are counted before they are sorted, so a
passage that a third of the documents hold is one row in an order; a gram
with more than ``BIG`` distinct blocks is dealt by ranges of starts and a hash
of what their strings share.  Between steps rows are written to the shared
folder.

Defined results: texts are UTF-8 bytes, null counts as empty; matches never
cross documents; rows equal in doc_id and text are matches of each other;
texts under LENGTH bytes keep all; an empty table gives an empty result.
Equality is by 64-bit hashes with random byte values.
"""

from __future__ import annotations

import hashlib

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import Scratch, written

LENGTH, GRAM = 400, 32
BIG, RANGES = 2048, 16
CELL = {"gram": pa.int64(), "k": pa.int32(), "shared": pa.int64(), "row": pa.binary(), "a": pa.int32(), "s": pa.int32(), "whole": pa.bool_(), "raw": pa.binary()}
_ROOT = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(400).integers(1, 2**63, 256, dtype=np.uint64)
#: Texts are cut into phrases so many bytes at a time.
BATCH = 1 << 16
#: Places of a least gram are found within pieces of this many bytes.
_PIECE_BITS = 22
_powers: dict = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

TYPES = {"j": np.int32, "a": np.int32, "s": np.int32, "e": np.int32, "gram": np.int64, "c": np.int64, "f": np.int32, "need": np.int32, "known": np.bool_}
ANCHOR = "array<struct<j:int,a:int,s:int,e:int,gram:long,c:long,f:int,need:int,known:boolean>>"


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        n = max(n, 1 << 17)
        for name, root in (("up", _ROOT), ("down", pow(_ROOT, -1, 1 << 64))):
            _powers[name] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, root, np.uint64)]))
    return _powers["up"], _powers["down"]


class Hashes:
    """Hashes of substrings from running sums."""

    def __init__(self, text: bytes):
        up, self.down = powers(len(text) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[np.frombuffer(text, np.uint8)] * up[: len(text)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        """Hashes of all substrings of a size, by start."""
        h = self.sums[size:] - self.sums[:-size]
        h *= self.down[: len(h)]
        return self.mixed(h)

    @staticmethod
    def mixed(h: np.ndarray) -> np.ndarray:
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h


def least(h: np.ndarray, window: int) -> np.ndarray:
    """For each window, the place of its least value (leftmost of equals)."""
    n, low = len(h) - window + 1, np.uint64((1 << _PIECE_BITS) - 1)
    out = np.empty(n, np.int64)
    step = (1 << _PIECE_BITS) - window
    for at in range(0, n, step):
        part = h[at : at + step + window - 1]
        keyed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        full = np.full(-(-len(part) // window) * window, np.uint64(2**64 - 1))
        full[: len(part)] = keyed
        rows = full.reshape(-1, window)
        first = np.minimum.accumulate(rows, axis=1).ravel()
        last = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        k = len(part) - window + 1
        out[at : at + k] = (np.minimum(last[:k], first[window - 1 : window - 1 + k]) & low).astype(np.int64) + at
    return out


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[list, dict, list, list]:
    """Numbers of anchors by text, and arrays by anchor: place a, block of
    starts s..e, gram's hash, phrase c to the next anchor (0: none), first
    phrase f and number of phrases that cover the block's strings (0: no row
    of anchors left here covers them), and whether the block is known to be
    repeated; then, by text, numbers of runs of starts that are repeated
    within it, and these runs.

    Equal blocks of one text (a word or line written over and over) are
    repeated by each other; only the first stays, to be met by other texts.
    Texts of ``BATCH`` bytes together are joined, so that a short one doesn't
    cost dozens of calls; no string reaches into the next text."""
    sizes, spans, found, within = [], [], [], []
    at = 0
    while at < len(texts):
        end, total = at + 1, len(texts[at])
        while end < len(texts) and total + len(texts[end]) <= BATCH:
            total += len(texts[end])
            end += 1
        n, columns, m, some = joined_anchors(texts[at:end], length, gram)
        sizes += n
        spans += m
        found.append(columns)
        within.append(some)
        at = end
    columns = {name: np.concatenate([np.zeros(0, t), *[x[name] for x in found]]).astype(t) for name, t in TYPES.items()}
    return sizes, columns, spans, np.concatenate([np.zeros((0, 2), np.int32), *within]).astype(np.int32)


def joined_anchors(texts: list[bytes], length: int, gram: int) -> tuple[list, dict, list, np.ndarray]:
    size = np.array([len(t) for t in texts])
    long = size >= length
    offset = np.cumsum(size) - size
    if not long.any():
        return [0] * len(texts), {name: np.zeros(0, t) for name, t in TYPES.items()}, [0] * len(texts), np.zeros((0, 2), np.int64)
    text = b"".join(texts)
    hashes = Hashes(text)
    grams = hashes.all(gram)
    starts = np.zeros(len(text) + 1, np.int8)  # 1 where a text's strings start to be there, -1 after the last
    np.add.at(starts, offset[long], 1)
    np.add.at(starts, (offset + size - length + 1)[long], -1)
    starts = np.flatnonzero(np.cumsum(starts[:-1], dtype=np.int8))
    place = least(grams, length - gram + 1)[starts]
    # places of different texts differ, so no block reaches into the next text
    block = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    s, e, a = starts[block], starts[np.append(block[1:], len(place)) - 1], place[block]
    doc = np.searchsorted(offset, s, side="right") - 1
    n = np.bincount(doc, minlength=len(texts))
    first = (np.cumsum(n) - n)[doc]
    end = first + n[doc]
    at = np.arange(len(a))
    c = np.zeros(len(a), np.uint64)
    more = at[:-1][doc[1:] == doc[:-1]]
    c[more] = hashes.of(a[more], a[more + 1] + gram) | np.uint64(1)
    f = np.searchsorted(a, s, side="right") - 1
    to = np.searchsorted(a, e + length - gram, side="left")
    whole = hashes.of(s, e + length) + (a - s).astype(np.uint64)
    order = np.lexsort((whole, doc))  # stable: the first of equal blocks comes first
    kind = np.flatnonzero(np.concatenate([[True], (whole[order][1:] != whole[order][:-1]) | (doc[order][1:] != doc[order][:-1])]))
    times = np.diff(np.append(kind, len(order)))
    known = np.zeros(len(a), bool)
    known[order] = np.repeat(times > 1, times)
    stays = np.zeros(len(a), bool)
    stays[order[kind]] = True
    gone = np.concatenate([[0], np.cumsum(~stays)])  # anchors that leave, before each
    inside = (f >= first) & (to < end)
    need = np.where(inside & (gone[np.minimum(to, end - 1) + 1] == gone[np.maximum(f, first)]), to - f, 0)
    from_ = offset[doc]
    out = {"j": at - first, "a": a - from_, "s": s - from_, "e": e - from_, "gram": grams[a].view(np.int64), "c": c.view(np.int64), "f": f - first, "need": need, "known": known}
    # blocks follow one another, so known neighbours in a text make one run
    edge = np.concatenate([[True], doc[1:] != doc[:-1], [True]])
    opens = at[known & (edge[:-1] | ~np.concatenate([[False], known[:-1]]))]
    closes = at[known & (edge[1:] | ~np.append(known[1:], False))]
    spans = np.stack([(s - from_)[opens], (e - from_)[closes]], axis=1)
    return np.bincount(doc[stays], minlength=len(texts)).tolist(), {k: v[stays] for k, v in out.items()}, np.bincount(doc[opens], minlength=len(texts)).tolist(), spans


def repeated_starts(blocks: list[tuple[int, int, bytes]], length: int = LENGTH) -> list[np.ndarray]:
    """Blocks of one gram as (anchor - first start, number of starts, bytes)
    -> for each the mask of starts whose string another of them has at the
    same distance from the anchor."""
    places, codes, owner = [], [], []
    for v, (before, n, raw) in enumerate(blocks):
        places.append(before - np.arange(n))
        codes.append(Hashes(raw).all(length)[:n])
        owner.append(np.full(n, v))
    place, code, own = np.concatenate(places), np.concatenate(codes), np.concatenate(owner)
    order = np.lexsort((code, place))
    same = (place[order][1:] == place[order][:-1]) & (code[order][1:] == code[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.split(twice, np.cumsum([n for _, n, _ in blocks])[:-1])


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def listed(sizes: list[int], columns: list[np.ndarray], names) -> pa.ListArray:
    """Rows of some columns as lists of the given sizes."""
    rows = pa.StructArray.from_arrays([pa.array(x) for x in columns], list(names))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), rows)


def with_row(docs: DataFrame) -> DataFrame:
    """doc_id, text, row: identity of (doc_id, text)."""
    text = F.coalesce("text", F.lit("")).alias("text")
    d = docs.select("doc_id", text)
    row = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text").cast("binary")))
    return d.withColumn("row", F.coalesce(row, F.lit(b"")))  # never null, and known not to be


def ahead(name: str, by: int, step: int, window) -> "F.Column":
    """``name`` at place j + by, 0 where that place isn't there; rows of
    ``window`` are ``step`` places apart at least."""
    n = by // step
    return F.when(F.lead("j", n).over(window) == F.col("j") + by, F.lead(name, n).over(window)).otherwise(0)


def named(rows: DataFrame, triple: list[str], written: Callable) -> DataFrame:
    """``rows`` with name: place of their triple in the order of triples."""
    order = rows.select(*triple).distinct().orderBy(*triple)
    names = written(order.withColumn("name", F.monotonically_increasing_id() + 1), "names")
    return rows.join(names, triple).drop(*triple)


def prefixes(places: DataFrame, depth: int, written: Callable) -> DataFrame:
    """row, j, c of repeated phrases' places -> row, j, key, common: equal
    keys for equal suffixes, and the longest prefix (in phrases, depth at
    most) that the suffix shares with another.  ``written`` keeps a table."""
    in_row = W.partitionBy("row").orderBy("j")
    in_class = W.partitionBy("row", F.col("j") % 3).orderBy("j")
    # sampled triples, then triples of names
    c1, c2 = ahead("c", 1, 1, in_row), ahead("c", 2, 1, in_row)
    strings = written(places.select("row", "j", "c", c1.alias("c1"), c2.alias("c2")), "triples")
    sampled = written(named(strings.where("j % 3 <> 0").select("row", "j", F.col("c").alias("x"), F.col("c1").alias("y"), F.col("c2").alias("z")), ["x", "y", "z"], written), "sampled")
    span = 3
    while span < depth:
        triples = sampled.select("row", "j", F.col("name").alias("x"), ahead("name", span, 3, in_class).alias("y"), ahead("name", 2 * span, 3, in_class).alias("z"))
        sampled = written(named(triples, ["x", "y", "z"], written), "sampled")
        span *= 3
    # merge: keys in the three orders
    whole = strings.join(sampled, ["row", "j"], "left").withColumn("name", F.coalesce("name", F.lit(0)))
    n1, n2 = ahead("name", 1, 1, in_row), ahead("name", 2, 1, in_row)
    near = F.transform(F.filter(F.collect_list(F.struct("j", "c")).over(in_row.rowsBetween(0, depth - 1)), lambda x, i: x["j"] == F.col("j") + i), lambda x: x["c"])
    whole = written(whole.select("row", "j", "c", "c1", "name", n1.alias("n1"), n2.alias("n2"), near.alias("near")), "suffixes")
    key = lambda o, x, y, z: F.struct(F.lit(o).alias("o"), x.alias("x"), y.alias("y"), z.alias("z"))
    zero, c, residue = F.lit(0).cast("long"), F.col("c"), F.col("j") % 3
    by_name, by_one, by_two = key(0, c, F.col("name"), zero), key(1, c, F.col("n1"), zero), key(2, c, F.col("c1"), F.col("n2"))
    keys = F.when(residue == 0, F.array(by_one, by_two)).when(residue == 1, F.array(by_one, by_name)).otherwise(F.array(by_two, by_name))
    whole = whole.select("row", "j", "near", F.explode(keys).alias("key")).select("row", "j", "near", "key.*")
    order = ["o", "x", "y", "z"]
    distinct = whole.groupBy(*order).agg(F.count("*").alias("n"), F.first("near").alias("near"))
    walk = W.partitionBy("o", "x").orderBy("y", "z")

    def common(other) -> "F.Column":
        differ = F.array_position(F.zip_with("near", other, lambda p, q: F.coalesce(p == q, F.lit(False))), False)
        return F.when(other.isNull(), F.lit(0).cast("long")).when(differ > 0, differ - 1).otherwise(F.size("near"))

    shared = F.when(F.col("n") > 1, F.size("near").cast("long")).otherwise(F.greatest(common(F.lag("near").over(walk)), common(F.lead("near").over(walk))))
    distinct = written(distinct.select(*order, shared.alias("common")), "orders")
    found = whole.drop("near").join(distinct, order)
    return found.groupBy("row", "j").agg(F.max("common").alias("common"), F.min(F.struct(*order)).alias("key"))


def dealt(docs: DataFrame) -> DataFrame:
    """Rows of ``with_row`` as (row, doc), dealt by row.  Both joins with the
    texts use all of ``doc``, so Spark shuffles them once for the two."""
    return docs.select("row", F.struct("doc_id", "text").alias("doc")).repartition("row")


def phrases(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows of ``with_row`` -> row, found, within: anchors, and runs repeated
    within the text, of texts that have any.  These are told by their size; a
    condition on what the UDF returns would have Spark run it twice."""
    @F.arrow_udf(f"struct<found:{ANCHOR},within:array<struct<first:int,last:int>>>")
    def cut(texts: pa.Array) -> pa.Array:
        sizes, columns, spans, within = anchors([t.as_py().encode() for t in texts], length, gram)
        return pa.StructArray.from_arrays([listed(sizes, list(columns.values()), TYPES), listed(spans, [within[:, 0], within[:, 1]], ["first", "last"])], ["found", "within"])

    return docs.where(F.octet_length("text") >= length).select("row", cut("text").alias("x")).select("row", "x.*")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows of ``with_row`` -> row, first, last: runs of starts of repeated strings."""
    scratch = Scratch(docs.sparkSession)
    cuts = scratch.write(phrases(docs, length, gram), "anchors")
    every = cuts.select("row", F.inline("found"))
    twice = every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    hot = scratch.write(every.join(twice, "gram", "left_semi").dropDuplicates(["row", "j"]), "repeated-grams")
    depth = hot.agg(F.max("need")).first()[0] or 0
    common = prefixes(hot.where("c <> 0").select("row", "j", "c"), max(depth, 1), scratch.write)
    blocks = hot.join(common.select("row", F.col("j").alias("f"), "common", "key"), ["row", "f"], "left")
    whole = F.col("known") | (F.col("need") > 0) & (F.coalesce("common", F.lit(0)) >= F.col("need"))
    blocks = written(blocks.select("row", "a", "s", "e", "gram", "key", "need", F.coalesce(whole, F.lit(False)).alias("whole")), "blocks")
    within = written(cuts.select("row", F.inline("within")), "within")
    scratch.drop()

    copies = docs.groupBy("row").agg(F.count("*").alias("n"), F.first(F.octet_length("text")).alias("size")).where(f"n > 1 AND size >= {length}")
    copies = copies.select("row", F.lit(0).alias("first"), (F.col("size") - length).alias("last"))
    done = blocks.where("whole").select("row", F.col("s").alias("first"), F.col("e").alias("last"))
    edges = edge_runs(docs, blocks, length)
    return done.union(edges).union(copies).union(within)


def edge_runs(docs: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """Starts of blocks that aren't repeated as a whole, compared with one
    block of each kind of the same gram."""
    open_grams = blocks.where("NOT whole").select("gram").distinct()
    # blocks of equal suffix key and extent have equal bytes: one stands for all
    kind = F.when(F.col("whole") & (F.col("need") > 0) & F.col("key").isNotNull(), F.xxhash64("key", F.col("a") - F.col("s"), F.col("e") - F.col("s"), "need")).otherwise(F.xxhash64("row", "a"))
    some = blocks.join(open_grams, "gram", "left_semi").withColumn("kind", kind)
    one = some.groupBy("gram", "kind").agg(F.min(F.struct("row", "a", "s", "e", "whole")).alias("b")).select("gram", "b.*")
    sizes = one.groupBy("gram").agg(F.count("*").alias("v")).where("v > 1")
    wanted = one.join(sizes, "gram").groupBy("row").agg(F.collect_list(F.struct("gram", "a", "s", "e", "whole", "v")).alias("wanted"))
    cells = dealt(docs).join(wanted, "row")
    # at 0 the whole block, else ranges of distances from the anchor
    width = -(-(length - GRAM + 1) // RANGES)

    def extract(batches):
        for batch in batches:
            rows, texts, wants = batch.column("row"), batch.column("doc").field("text"), batch.column("wanted")
            out, seen = [], set()
            for i in range(batch.num_rows):
                row, raw = rows[i].as_py(), texts[i].as_py().encode()
                for w in wants[i].as_py():
                    gram, a, s, e, whole, v = (w[k] for k in ("gram", "a", "s", "e", "whole", "v"))
                    if (row, a) in seen:  # equal rows
                        continue
                    seen.add((row, a))
                    if v <= BIG:
                        out.append((gram, -1, 0, row, a, s, whole, raw[s : e + length]))
                        continue
                    for k in range((a - e) // width, (a - s) // width + 1):
                        lo, hi = max(s, a - (k + 1) * width + 1), min(e, a - k * width)
                        if lo > hi:
                            continue
                        shared = int.from_bytes(hashlib.blake2b(raw[a - k * width : a - (k + 1) * width + 1 + length], digest_size=8).digest(), "big", signed=True)
                        out.append((gram, k, shared, row, a, lo, whole, raw[lo : hi + length]))
                if len(out) > 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), CELL.values())], list(CELL))
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), CELL.values())], list(CELL))

    cell = ["gram", "k", "shared"]
    cells = cells.mapInArrow(extract, "gram long, k int, shared long, row binary, a int, s int, whole boolean, raw binary")
    cells = cells.repartition(*[F.col(c) for c in cell]).sortWithinPartitions(*cell, "row", "a")

    def compare(batches):
        rest = None
        for batch in batches:
            both = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            change = np.flatnonzero((both[cell] != both[cell].shift()).any(axis=1).to_numpy())
            rest = both.iloc[change[-1] :]  # the last cell may go on in the next batch
            yield compared(both, change)
        if rest is not None and len(rest):
            yield compared(rest.reset_index(drop=True), np.array([0, len(rest)]))

    def compared(rows, bounds):
        out = []
        names, places, starts, wholes, raws = (rows[c].tolist() for c in ("row", "a", "s", "whole", "raw"))
        for lo, hi in zip(bounds.tolist(), bounds[1:].tolist()):
            if hi - lo < 2 or all(wholes[lo:hi]):
                continue
            mine: dict = {}
            for i in range(lo, hi):  # a repeated row may be there twice
                mine.setdefault((names[i], places[i]), i)
            at = list(mine.values())
            masks = repeated_starts([(places[i] - starts[i], len(raws[i]) - length + 1, raws[i]) for i in at], length)
            out += [(names[i], starts[i] + x, starts[i] + y) for i, mask in zip(at, masks) if not wholes[i] for x, y in runs(mask)]
        return pd.DataFrame(out, columns=["row", "first", "last"])

    return cells.mapInPandas(compare, "row binary, first int, last int")


def cover(starts: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Sorted runs of starts -> maximal covered byte ranges [from, to)."""
    out: list = []
    for first, last in starts:
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(a, b) for a, b in out]


def removed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    d = with_row(docs)
    found = repeats(d, length).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("starts"))

    kind = docs.schema["doc_id"].dataType.simpleString()

    @F.arrow_udf(f"struct<doc_id:{kind},n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string>")
    def keep(texts: pa.Array, starts: pa.Array) -> pa.Array:
        out = []
        for text, some in zip(texts.field("text"), starts):
            raw = text.as_py().encode()
            spans = cover([(x["first"], x["last"]) for x in some.as_py() or []], length)
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            out.append((len(raw), sum(b - a for a, b in spans), len(spans), kept.hexdigest()))
        columns = list(zip(*out)) or [()] * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])]
        return pa.StructArray.from_arrays([texts.field("doc_id"), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return dealt(d).join(found, "row", "left").select(keep("doc", "starts").alias("r")).select("r.*")
