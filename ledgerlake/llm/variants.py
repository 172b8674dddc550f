"""Spelling variants by a dictionary of trie-node pairs.

The words' prefixes are the nodes of a trie, their suffixes those of a
reversed trie, and both kinds are numbered.  A word of length L enters the
dictionary under integer pairs (prefix node, suffix node): L pairs that skip
one position, and L + 1 pairs that split the word at a position.  Two words
of a skipping pair differ by the one replaced code point; a word that skips
and a word that splits at the same pair differ by the one inserted.  So the
equi-join on a pair finds exact neighbours, no distance is computed.

Numbers: a node's number is a polynomial of its code points modulo 2^61 - 1,
that is, a function of its parent's number and its code point.  ``numbered``
proves each numbering: were two nodes to share a number, some number would
have two (parent, code point) pairs; then it starts again from another base.

No pair of words is emitted.  Each replacement pair of words shares exactly
one skipping pair, and each insertion is counted at the first of equal
neighbouring code points only, so counts per dictionary key add up to the
number of neighbours, and a key's two best words settle everyone's best.
A key's words differ in one code point, so a key has no more words than the
alphabet has letters.  Words are counted with a partial aggregate.

Defined results: a null or empty text has no words; a null doc_id counts as
an empty one; repeated rows count as often as they occur; words of any
length are treated whole; ties go to the smaller word in code-point order;
an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import ascii_lower, written

RUN = "A-Za-zÀ-ÿ"
MODULUS = (1 << 61) - 1
SKIP, SPLIT = 0, 1


def counted(docs: DataFrame, min_length: int = 6, min_count: int = 5, drop_one_in: int = 199) -> DataFrame:
    """word, n: lower-cased runs of letters, one in ``drop_one_in`` by hash
    with a code point deleted, that are long and frequent enough."""
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{RUN}]{{{min_length},}}"), F.lit(0))
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run")).select("d", ascii_lower(F.col("run")).alias("run"))
    h = run.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = h.select(F.when(F.pmod("h", F.lit(drop_one_in)) == 0, cut).otherwise(F.col("run")).alias("word"))
    return word.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def path(points: list[int], base: int) -> list[int]:
    """Numbers of the nodes from the root down along ``points``."""
    out, node = [0], 0
    for c in points:
        node = (node * base + c + 1) % MODULUS
        out.append(node)
    return out


def _edges(words: DataFrame, base: int) -> DataFrame:
    """(trie, parent, point, node) of every word, equal ones of a batch once."""

    def edges(batches):
        for batch in batches:
            for trie, step in ((0, 1), (1, -1)):
                seen = set()
                for w in batch["word"]:
                    points = [ord(c) for c in w[::step]]
                    nodes = path(points, base)
                    seen.update(zip(nodes, points, nodes[1:]))
                yield pd.DataFrame(sorted(seen), columns=["parent", "point", "node"]).assign(trie=trie)

    return words.mapInPandas(edges, "parent long, point long, node long, trie int")


def one_to_one(words: DataFrame, base: int) -> bool:
    """Whether no two nodes of a trie share a number."""
    edge = F.struct("parent", "point")
    twice = _edges(words, base).groupBy("trie", "node").agg(F.min(edge).alias("a"), F.max(edge).alias("b"))
    return twice.where((F.col("a") != F.col("b")) | (F.col("node") == 0)).isEmpty()


def numbered(words: DataFrame, seed: int = 1) -> int:
    """A base under which nodes and numbers are one to one."""
    draw = random.Random(seed)
    while not one_to_one(words, base := draw.randrange(1 << 32, MODULUS)):
        pass
    return base


def dictionary(words: DataFrame, base: int) -> DataFrame:
    """Entries (prefix, suffix, kind, first, id, n): ``first`` says that the
    skipped code point is the first of equal neighbours."""

    names = ["prefix", "suffix", "kind", "first", "id", "n"]

    def entries(batches, rows=100_000):
        out = [[] for _ in names]

        def frame():
            return pd.DataFrame({name: np.array(x, bool if name == "first" else np.int64) for name, x in zip(names, out)})

        for batch in batches:
            for i, w, n in zip(batch["id"], batch["word"], batch["n"]):
                points = [ord(c) for c in w]
                prefix, suffix = path(points, base), path(points[::-1], base)[::-1]
                skips, splits = len(points), len(points) + 1
                changes = [a != b for a, b in zip(points, [-1] + points)]
                columns = prefix[:-1] + prefix, suffix[1:] + suffix, [SKIP] * skips + [SPLIT] * splits, changes + [False] * splits, [i] * (skips + splits), [n] * (skips + splits)
                for have, more in zip(out, columns):
                    have += more
                if len(out[0]) >= rows:
                    yield frame()
                    out = [[] for _ in names]
        yield frame()

    return words.mapInPandas(entries, "prefix long, suffix long, kind long, first boolean, id long, n long")


def neighbours(words: DataFrame, base: int) -> DataFrame:
    """id, n_near, best (n and negated id of the best near word) of the words
    (id, word, n) that have a near word."""
    skips, firsts = F.col("kind") == SKIP, (F.col("kind") == SKIP) & F.col("first")
    me = F.struct("n", (-F.col("id")).alias("neg"))
    key = W.partitionBy("prefix", "suffix")
    ranked = key.orderBy("kind", F.desc("n"), "id").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    e = dictionary(words, base).select(
        "id", "n", "kind", "first",
        F.sum(F.when(skips, 1).otherwise(0)).over(key).alias("skips"), F.sum(F.when(firsts, 1).otherwise(0)).over(key).alias("firsts"),
        F.first(F.when(skips, me)).over(ranked).alias("top"), F.nth_value(F.when(skips, me), 2).over(ranked).alias("second"),
        F.max(F.when(firsts, me)).over(key).alias("longer"), F.max(F.when(~skips, me)).over(key).alias("shorter"),
    )
    mine = skips & F.col("first")
    replaced = F.when(skips, F.when(F.col("top.neg") == -F.col("id"), F.col("second")).otherwise(F.col("top")))
    near = F.when(skips, F.col("skips") - 1 + F.when(mine & F.col("shorter").isNotNull(), 1).otherwise(0)).otherwise(F.col("firsts"))
    best = F.greatest(replaced, F.when(mine, F.col("shorter")).when(~skips, F.col("longer")), F.lit(None).cast("struct<n:bigint,neg:bigint>"))
    met = e.select("id", near.alias("near"), best.alias("best")).where("near > 0")
    return met.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """id, root for each (id, form): forms followed to the last.

    A form is ``ratio`` times as frequent as its word, so chains are short,
    and each round doubles the steps taken."""
    now = written(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        step = now.join(onward, "root", "left").select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        step = written(step, "roots")
        now = step.select("id", "root")
        if step.where("moved").isEmpty():
            return now


def group(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n for each (word, n).

    ``form`` is the near word of largest n if that is ``ratio`` times the
    word's n at least, ``root`` where forms lead (the word itself if it has
    none), ``n_near`` the number of near words."""
    ordered = words.select("word", F.col("n").cast("long").alias("n"))
    parts = int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # increasing in code-point order; written, so the numbers stay as they are
    ordered = written(ordered.repartitionByRange(parts, "word").sortWithinPartitions("word").withColumn("id", F.monotonically_increasing_id()), "words")
    near = neighbours(ordered, numbered(ordered))
    fits = F.col("best.n") >= ratio * F.col("n")
    found = ordered.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, -F.col("best.neg")).alias("form_id"), F.when(fits, F.col("best.n")).alias("form_n"))
    found = written(found, "neighbours")
    led = roots(found.where("form_id is not null").select("id", F.col("form_id").alias("form")))
    name = lambda id, word: ordered.select(F.col("id").alias(id), F.col("word").alias(word))
    ends = found.where("form_id is not null").join(led, "id").join(name("form_id", "form"), "form_id").join(name("root", "root_word"), "root")
    ends = ends.select("id", "form", "root_word")
    out = found.join(ends, "id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of ``docs``."""
    return group(written(counted(docs), "counts"))


#: The query in DuckDB's SQL: CRC-32 byte by byte, neighbours by the strings
#: that are left when a position is skipped or marked.
VARIANTS_SQL = r"""
WITH RECURSIVE
crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS MATERIALIZED (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
spelt AS (
  SELECT doc_id, run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM spelt, crc),
counts AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM counts WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS MATERIALIZED (
  SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT x.word, y.word AS other, y.n FROM places x JOIN places y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT p.word, w.word, w.n FROM places p JOIN words w ON w.word = p.a || p.b
  UNION SELECT w.word, p.word, p.n FROM places p JOIN words w ON w.word = p.a || p.b),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
led(word, root) AS (
  SELECT word, coalesce(form, word) FROM formed
  UNION SELECT led.word, f.form FROM led JOIN formed f ON f.word = led.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, led.root, f.n, f.n_near, f.form_n
FROM formed f JOIN led USING (word) JOIN formed e ON e.word = led.root AND e.form IS NULL
"""
