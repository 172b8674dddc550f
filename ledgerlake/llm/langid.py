"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for each piece of a fixed public vocabulary.
A text's likelihood in a language is the sum, over all ways to cut it into
pieces, of the product of the pieces' probabilities; a forward recursion
sums them.  Words (runs of letters, lower-cased, each with the blank mark
before it) are independent given the language because no piece crosses a
blank, so a task works out each word once.

The probabilities are learnt by expectation maximisation: a forward-backward
pass over the words of at most ``PER_LANG`` training documents for each
language (the first by hash of doc_id), as a Spark job for each round; what
reaches the driver is one count for each language and piece.  Training
documents are those with a text, a lang and a crc32(doc_id) mod 3 other than
1.  Prediction reads the text only.  The ids of the sample, ``PER_LANG`` for
each value of lang, are broadcast; lang holds codes of languages, so they
are bounded by the number of languages there are.

The score compares the learnt languages with each other, so a text in none
of them has a high one too.  ``accepted`` also asks whether the winner's
model explains the text: its log likelihood may lie below what the
language's training texts have for as many letters by ``FAR`` nats a letter
and ``SLACK`` nats once.  The slack is for short texts, of which a single
rare word may be most.

Defined results: a text that is null or has no letter is ``und`` with score
0, and so is every text where no language could be learnt (empty table, no
lang); equal likelihoods go to the smaller name; the score is the winner's
posterior under equal priors with a text's evidence held at ``EVIDENCE``
words, so that long texts don't all have 1; letters that no piece has share
one probability.  Very long words are summed whole, in logs, and so are very
long texts.  ``accepted`` keeps all columns as they are, whatever their
names, and rows that repeat are judged alike.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import fresh, written
from .vocabulary import MODEL, SPACE, Memo, Pieces

LETTERS = re.compile(r"[^\W\d_]+")
UND = "und"
#: Bounds: training documents for each language; rounds of learning.
PER_LANG, ROUNDS = 500, 3
EVIDENCE = 20
SMOOTH = 0.01
#: How far below its language's usual log likelihood a text may lie: nats for
#: each letter (and blank), and nats for the text.
FAR, SLACK = 2.0, 20.0
#: Ids are ranked in so many parts of a language first.
SALTS = 16
#: Among the counts of pieces: a language's log likelihood, its letters.
LIKELIHOOD, N_LETTERS = -1, -2
#: Words of one length that are worked out at once.
BLOCK = 2048
#: Texts whose new words are worked out together; words that are remembered.
CHUNK, REMEMBER = 128, 48


class Lattice:
    """All pieces in a word: the arcs of its segmentations."""

    def __init__(self, pieces: Pieces):
        self.trie = pieces.trie(lambda i: i)
        self.size = len(pieces.text) + 1  # the last: a letter that no piece has
        self.longest = max(len(t) for t in pieces.text if t)

    def arcs(self, words: list[str]) -> np.ndarray:
        """Words of one length n -> ids by word, start, piece length - 1; -1: none."""
        n = len(words[0]) + 1
        out = np.full((len(words), n, min(n, self.longest)), -1, np.int32)
        trie, unknown = self.trie, self.size - 1
        w_at, i_at, l_at, ids = [], [], [], []
        for w, word in enumerate(words):
            s = SPACE + word
            for i in range(n):
                node, j, alone = trie, i, False
                while j < n and (node := node.get(s[j])) is not None:
                    piece = node.get("")
                    if piece is not None:
                        alone = alone or j == i
                        w_at.append(w), i_at.append(i), l_at.append(j - i), ids.append(piece)
                    j += 1
                if not alone:
                    w_at.append(w), i_at.append(i), l_at.append(0), ids.append(unknown)
        out[w_at, i_at, l_at] = ids
        return out

    def forward(self, arcs: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """log of the summed probability up to each position, by language."""
        k, n, longest = arcs.shape
        a = np.full((k, n + 1, logp.shape[1]), -np.inf)
        a[:, 0] = 0
        for j in range(1, n + 1):
            for size in range(1, min(j, longest) + 1):
                ids = arcs[:, j - size, size - 1]
                has = np.flatnonzero(ids >= 0)
                if len(has):
                    a[has, j] = np.logaddexp(a[has, j], a[has, j - size] + logp[ids[has]])
        return a

    def counts(self, words: list[str], times: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words of one length; logp: one language's column."""
        return self.expected(words, times, logp)[0]

    def expected(self, words: list[str], times: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, float]:
        """``counts``, and the log likelihood of all the words."""
        arcs = self.arcs(words)
        k, n, longest = arcs.shape
        a = self.forward(arcs, logp)[:, :, 0]
        b = np.full((k, n + 1), -np.inf)
        b[:, n] = 0
        out = np.zeros(self.size)
        for i in reversed(range(n)):
            for size in range(1, min(n - i, longest) + 1):
                ids = arcs[:, i, size - 1]
                has = np.flatnonzero(ids >= 0)
                if len(has):
                    step = logp[ids[has], 0] + b[has, i + size]
                    b[has, i] = np.logaddexp(b[has, i], step)
                    np.add.at(out, ids[has], np.exp(a[has, i] + step - a[has, n]) * times[has])
        return out, float(a[:, n] @ times)


_lattices: dict = {}
_memos: dict = {}


def lattice(pieces: Pieces, key: str) -> Lattice:
    if key not in _lattices:
        _lattices[key] = Lattice(pieces)
    return _lattices[key]


def in_training(doc_id: Column) -> Column:
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 3, is 1 (a null doc_id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, model: str = MODEL, per_lang: int = PER_LANG, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages (sorted), log probabilities by piece and language, and each
    language's usual log likelihood of a letter: its training words' (with
    their blank marks) as the last round met them."""
    pieces = Pieces(model)
    able = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & in_training(F.col("doc_id")))
    rank = ["h", "doc_id", "t"]
    part = F.pmod(F.col("h"), F.lit(SALTS))
    ids = able.select("lang", "doc_id", F.xxhash64("doc_id", "lang").alias("h"), F.xxhash64("text").alias("t"))
    for group in (["lang", part], ["lang"]):  # the first of the first of each part: no task ranks a whole language
        first = W.partitionBy(*group).orderBy(*rank)
        ids = (ids.distinct() if len(group) > 1 else ids).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_lang).drop("nth")
    ids = ids.select("lang", "doc_id", "t")
    sample = able.select("lang", "doc_id", "text", F.xxhash64("text").alias("t"))
    sample = sample.join(F.broadcast(ids), on=(sample.lang == ids.lang) & sample.doc_id.eqNullSafe(ids.doc_id) & (sample.t == ids.t), how="left_semi")
    sample = sample.dropDuplicates(["lang", "doc_id", "t"]).select("lang", "text")

    def count(batches):
        for batch in batches:
            seen = Counter((g, w) for g, t in zip(batch["lang"], batch["text"]) for w in LETTERS.findall(t.lower()))
            yield pd.DataFrame([(g, w, n) for (g, w), n in seen.items()], columns=["lang", "word", "n"])

    words = sample.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = written(words, "words")
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((len(pieces.text) + 1, 0)), np.zeros(0)
    logp = np.full((len(pieces.text) + 1, len(langs)), -np.log(len(pieces.text) + 1))
    for _ in range(rounds):
        now, at = logp.astype(np.float32), {g: i for i, g in enumerate(langs)}

        def expect(batches):
            lat = lattice(pieces, model)
            for batch in batches:
                for (g, _), same in batch.groupby(["lang", batch["word"].str.len()]):
                    for x in range(0, len(same), BLOCK):
                        part = same.iloc[x : x + BLOCK]
                        c, total = lat.expected(part["word"].tolist(), part["n"].to_numpy(float), now[:, [at[g]]].astype(float))
                        used = np.flatnonzero(c)
                        yield pd.DataFrame({"lang": g, "piece": used.astype(np.int32), "c": c[used]})
                        letters = float(part["n"].sum()) * (len(part["word"].iloc[0]) + 1)
                        yield pd.DataFrame({"lang": g, "piece": np.array([LIKELIHOOD, N_LETTERS], np.int32), "c": [total, letters]})

        expected = words.mapInPandas(expect, "lang string, piece int, c double").groupBy("lang", "piece").agg(F.sum("c").alias("c"))
        c, sums = np.full(logp.shape, SMOOTH), np.zeros((2, len(langs)))
        for r in expected.collect():  # at most pieces x languages
            if r["piece"] < 0:
                sums[-1 - r["piece"], at[r["lang"]]] = r["c"]
            else:
                c[r["piece"], at[r["lang"]]] += r["c"]
        logp = np.log(c / c.sum(0))
    return langs, logp, sums[0] / np.maximum(sums[1], 1)


def predicted(docs: DataFrame, langs: list[str], logp: np.ndarray, model: str = MODEL, name: str = "found") -> DataFrame:
    """``docs`` with a struct of lang_pred, score, likelihood (the text's log
    likelihood in lang_pred) and letters (with a blank for each word), from
    the text alone."""
    pieces, table = Pieces(model), logp.astype(np.float32)
    key = f"{model}:{hash(table.tobytes())}"

    @F.arrow_udf("struct<lang_pred:string,score:double,likelihood:double,letters:long>")
    def find(texts: pa.Array) -> pa.Array:
        lat, n, full = lattice(pieces, model), len(langs), table.astype(float)
        if key not in _memos:  # a worker that lives on keeps one model's words
            _memos.clear()
            _memos[key] = Memo()
        memo = _memos[key]
        pred, score, likelihood, letters = [], [], [], []
        for at in range(0, len(texts), CHUNK):
            chunk = [LETTERS.findall((t.as_py() or "").lower()) for t in texts[at : at + CHUNK]]
            known, unseen = {}, {}
            for w in set().union(*chunk) if n else ():
                got = memo.get(w)
                if got is None:
                    unseen.setdefault(len(w), []).append(w)
                else:
                    known[w] = got
            for size, words in unseen.items():
                block = max(1, min(BLOCK, 12 * BLOCK // size))
                for x in range(0, len(words), block):
                    part = words[x : x + block]
                    for w, row in zip(part, lat.forward(lat.arcs(part), full)[:, -1]):
                        known[w] = row.tobytes()
                        if size <= REMEMBER:
                            memo.put(w, known[w])
            for words in chunk:
                if not words or not n:
                    pred.append(UND), score.append(0.0), likelihood.append(0.0), letters.append(0)
                    continue
                sums = np.frombuffer(b"".join([known[w] for w in words])).reshape(-1, n).sum(0)
                best = int(sums.argmax())
                odds = np.exp((sums - sums[best]) * min(1, EVIDENCE / len(words)))
                pred.append(langs[best]), score.append(float(1 / odds.sum()))
                likelihood.append(float(sums[best])), letters.append(len(words) + sum(map(len, words)))
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(likelihood, pa.float64()), pa.array(letters, pa.int64())], ["lang_pred", "score", "likelihood", "letters"])

    return docs.withColumn(name, find(F.col("text")))


def identify(docs: DataFrame, model: str = MODEL, per_lang: int = PER_LANG, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    langs, logp, _ = train(docs, model, per_lang, rounds)
    (f,) = fresh(docs, "found")
    out = predicted(docs.select("doc_id", "text"), langs, logp, model, f)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), f"{f}.lang_pred", f"{f}.score")


def accepted(docs: DataFrame, least: float = 0.3, model: str = MODEL, far: float = FAR, slack: float = SLACK) -> DataFrame:
    """The rows of ``docs`` whose language is identified with a score of
    ``least`` or more and whose text that language explains; texts without a
    letter go, and so do those in a language that wasn't learnt."""
    langs, logp, usual = train(docs, model)
    (f,) = fresh(docs, "found")
    out = predicted(docs, langs, logp, model, f)
    found = F.col(f)
    of = F.create_map(*[F.lit(x) for lang, u in zip(langs, usual.tolist()) for x in (lang, u)]) if langs else F.create_map(F.lit(UND), F.lit(0.0))
    explained = found["likelihood"] >= found["letters"] * (of[found["lang_pred"]] - far) - slack
    return out.where((found["lang_pred"] != UND) & (found["score"] >= least) & explained).select(*docs.columns)
