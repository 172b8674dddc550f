"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns.  The field then labels what the patterns
left: its nodes are a document's mentions (base spans, whose labels are
given, other strings of seven digits or more or with an @, and tokens: runs
of 16 or more letters, digits and signs of keys that mix letters and
digits), its chain joins neighbouring mentions, and skip edges join mentions of the same or a
similar key however far apart (the same digits, one number the end of the
other; the same name before the @).  Loopy belief propagation over the whole
document makes such mentions agree: a number written without its + or with
other separators gets the label of the full one.  Mentions whose belief in a
kind passes one half are added; base spans stay as they are.

Secrets (keys, tokens, passwords) are a kind of their own that no pattern
gives.  Whether a token is one is learnt from where its shape stands: tokens
that a word like ``token`` or ``password`` is set to are taken for secrets,
all others aren't.  A shape's weights follow from these counts, such a word
before a token speaks for a secret with ``NAMED``, and skip edges carry the
label to the same token without it.  Copies of a token in a document share
one shape weight, so many unnamed copies don't outvote a named one.

The weights are learnt piece by piece from the base labels of at most
``SAMPLE`` documents (the first by hash of doc_id): for each shape the log
odds of each label, for neighbours their labels' association, for skip edges
the log odds that both labels are the same.  Only these counts reach the
driver.

A mention is linked to the previous one of its key, so edges grow with the
mentions, not their pairs.  Every pattern is linear in the text's length.

Defined results: null counts as empty (no span); spans are in code points;
kinds are independent, so spans of two kinds may overlap; repeated rows get
the same spans; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Labels: the base kinds, what isn't personal, and secrets.
KINDS = ("email", "ip", "card", "phone", "other", "secret")
OTHER, SECRET = KINDS.index("other"), KINDS.index("secret")
SAMPLE = 4000
ROUNDS, DAMPING = 10, 0.3
#: Learnt weights are kept within these.
SHAPE_MOST, CHAIN_MOST, SKIP = 4.0, 0.5, (6.0, 9.0)
#: Log odds of a secret from a word before it that names one.
NAMED = 5.0

#: Digits of a number's shortest key; longer numbers are similar only if equal.
LEAST, LONG = 7, 40

# A run of digits never needs to be entered in its middle, so each is matched once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_HOST = re.compile(r"[A-Za-z0-9-]+")
_DIGITS = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])+")
_APART = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+")
_LETTER, _DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")
#: Words that name a secret (fixed values), before = or : and a quote.
_NAMED = re.compile(r"(?:token|secret|key|password|passwd|pwd|credential|auth)s?[\"']? ?[:=]{1,2} ?[\"']?\Z")
_NAME_SPAN = 24


def names(text: str, domain: re.Pattern = _DOMAIN):
    """(start, end) of name@domain, leftmost, not overlapping.  Goes from @ to
    @ and back over the name, which can't hold an @."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = start < at and domain.match(text, at + 1)
        if m:
            yield start, (end := m.end())
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _card(s: str) -> bool:
    d = _APART.sub("", s)
    return 16 <= len(d) <= 19 and luhn(d)


def _ip(s: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in s.split("."))


def base(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in names(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if _ip(m[0])]
    out += [(2, *m.span()) for m in _CARD.finditer(text) if _card(m[0])]
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_APART.sub("", m[0])) <= 15]
    return out


def mentions(text: str, found: list) -> list[tuple[int, int, int]]:
    """(start, end, label) of base spans and of what else looks like data, by start."""
    taken = sorted((a, b) for _, a, b in found)
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []

    def free(a: int, b: int) -> bool:
        i = bisect_left(starts, b)  # spans that start before b
        return i == 0 or reach[i - 1] <= a

    out = [(a, b, k) for k, a, b in found]
    out += [(a, b, OTHER) for a, b in names(text, _HOST) if free(a, b)]
    tokens = [m.span() for m in _TOKEN.finditer(text) if _LETTER.search(m[0]) and _DIGIT.search(m[0]) and free(*m.span())]
    out += [(a, b, OTHER) for a, b in tokens]
    first = [a for a, _ in tokens]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= LEAST and len(_APART.sub("", m[0])) >= LEAST and free(*m.span()):
            i = bisect_left(first, m.end())  # tokens that start before its end
            if i == 0 or tokens[i - 1][1] <= m.start():
                out.append((*m.span(), OTHER))
    return sorted(out)


def shape(s: str) -> str:
    """What the unary weights know of a mention."""
    if "@" in s:
        return "@" + str(min(3, s.partition("@")[2].count(".")))
    if _LETTER.search(s):
        letters = "hex" if not s.strip("0123456789abcdef") or not s.strip("0123456789ABCDEF") else "one case" if s in (s.lower(), s.upper()) else "both cases"
        return f"${letters}{min(len(s) // 16, 4)}{'-' if not s.isalnum() else ''}"
    d = _APART.sub("", s)
    valid = ("l" if 16 <= len(d) <= 19 and luhn(d) else "") + ("i" if s.count(".") == 3 and _ip(re.sub(r"[^0-9.]", "", s) or "999") else "")
    return f"{min(len(d), 20)}{'+' if s[0] == '+' else ''}{'.' if '.' in s else ''}{valid}"


def named(text: str, at: int) -> bool:
    """Whether a word that names a secret stands before a place."""
    return _NAMED.search(text[max(0, at - _NAME_SPAN) : at].lower()) is not None


def ends(s: str) -> tuple[str, list[str]]:
    """Key of a mention, and the ends of it that a similar key may be."""
    if "@" in s:
        name = "@" + s.partition("@")[0].lower()
        return name, [name]
    if _LETTER.search(s):
        return "$" + s, ["$" + s]
    d = _APART.sub("", s)
    return d, [d] if len(d) > LONG else [d[i:] for i in range(len(d) - LEAST + 1)]


def skips(text: str, nodes: list) -> list[tuple[int, int]]:
    """Edges from each mention to the last ones before it of the same key, of
    a key that is its end, or of one whose end it is."""
    by_key: dict = {}
    by_end: dict = {}
    out = []
    for i, (a, b, _) in enumerate(nodes):
        key, similar = ends(text[a:b])
        out += [(j, i) for j in sorted({by_key[s] for s in similar if s in by_key} | ({by_end[key]} if key in by_end else set()))]
        by_key[key] = i
        by_end.update(dict.fromkeys(similar, i))
    return out


class Field:
    """Weights: ``shapes`` (shape -> label weights), ``chain`` (label x label)
    and ``skip`` (of two equal labels)."""

    def __init__(self, counts: dict):
        k = len(KINDS)
        seen: dict = {}
        pairs, same, not_same = np.ones((k, k)), 1, 1
        for (what, x, y), n in counts.items():
            if what == "shape":
                seen.setdefault(x, np.zeros(k))[int(y)] += n
            elif what == "chain":
                pairs[int(x), int(y)] += n
            elif x == y:
                same += n
            else:
                not_same += n
        p = pairs / pairs.sum()
        self.chain = np.clip(np.log(p / p.sum(1)[:, None] / p.sum(0)), -CHAIN_MOST, CHAIN_MOST)
        self.skip = float(np.clip(math.log(same / not_same), *SKIP))
        self.shapes = {s: np.clip(np.log((c + 0.1) / (c.sum() + 0.1 * k)), -SHAPE_MOST, 0) for s, c in seen.items()}
        self.unseen = np.where(np.arange(k) == OTHER, 0.0, -SHAPE_MOST)

    def beliefs(self, text: str, nodes: list) -> np.ndarray:
        """Marginals by node and label, from loopy sum-product."""
        k = len(KINDS)
        shapes = [shape(text[a:b]) for a, b, _ in nodes]
        own = np.array([self.shapes.get(s, self.unseen) if l == OTHER else np.where(np.arange(k) == l, 0.0, -50.0) for s, (_, _, l) in zip(shapes, nodes)])
        met = set()
        for n, (s, (a, b, _)) in enumerate(zip(shapes, nodes)):
            if s[0] == "$":
                if text[a:b] in met:  # copies of a token share one shape weight
                    own[n] = np.where(np.isin(np.arange(k), (OTHER, SECRET)), 0.0, -SHAPE_MOST)
                met.add(text[a:b])
                own[n, SECRET] += NAMED if named(text, a) else 0.0
            else:  # only tokens are secrets
                own[n, SECRET] = -50.0
        edges = [(i, i + 1, 0) for i in range(len(nodes) - 1)] + [(i, j, 1) for i, j in skips(text, nodes)]
        if not edges:
            e = np.exp(own - own.max(1, keepdims=True))
            return e / e.sum(1, keepdims=True)
        i, j, t = np.array(edges).T
        pots = np.array([self.chain, np.eye(k) * self.skip])[t]
        src, dst = np.concatenate([i, j]), np.concatenate([j, i])
        pots = np.concatenate([pots, pots.transpose(0, 2, 1)])  # source label x target label
        back = np.concatenate([np.arange(len(i)) + len(i), np.arange(len(i))])
        m = np.zeros((len(src), k))
        for _ in range(ROUNDS):
            total = own.copy()
            np.add.at(total, dst, m)
            out = (total[src] - m[back])[:, :, None] + pots
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None]).sum(1))
            new -= new.max(1, keepdims=True)
            m = DAMPING * m + (1 - DAMPING) * new
        total = own.copy()
        np.add.at(total, dst, m)
        e = np.exp(total - total.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def spans(self, text: str, found: list) -> list[tuple[int, int, int]]:
        """Base spans and those that the field adds, by kind, then start."""
        nodes = mentions(text, found) if text else []
        if len(nodes) == len(found):
            return found
        b = self.beliefs(text, nodes)
        added = [(int(b[n].argmax()), s, e) for n, (s, e, l) in enumerate(nodes) if l == OTHER and b[n].argmax() != OTHER and b[n].max() > 0.5]
        return sorted(found + added)


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def train(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Weights from the base labels of a bounded sample of documents."""
    docs = docs.select("doc_id", "text")
    ids = docs.where("text is not null").select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().orderBy("h", "doc_id").limit(sample).select(F.col("doc_id").alias("i"))
    texts = docs.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("i")), "left_semi").where("text is not null")
    texts = texts.select("doc_id", F.xxhash64("text").alias("t"), "text").dropDuplicates(["doc_id", "t"]).select("text")

    def count(batches):
        for batch in batches:
            c: Counter = Counter()
            for text in batch["text"]:
                nodes = mentions(text, base(text))
                shapes = [(shape(text[a:b]), a, l) for a, b, l in nodes]
                c.update(("shape", s, str(SECRET if s[0] == "$" and named(text, a) else l)) for s, a, l in shapes)
                c.update(("chain", str(x[2]), str(y[2])) for x, y in zip(nodes, nodes[1:]))
                c.update(("skip", str(nodes[i][2]), str(nodes[j][2])) for i, j in skips(text, nodes) if OTHER not in (nodes[i][2], nodes[j][2]))
            yield pd.DataFrame([(*key, n) for key, n in c.items()], columns=["what", "x", "y", "n"])

    sums = texts.mapInPandas(count, "what string, x string, y string, n long").groupBy("what", "x", "y").agg(F.sum("n").alias("n"))
    return Field({(r["what"], r["x"], r["y"]): r["n"] for r in sums.collect()})  # one row for each shape or pair of labels


def find(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, base spans of each kind, base_sha256, spans."""
    field = train(docs, sample)

    @F.arrow_udf("struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base_sha256:string,spans:string>")
    def of(texts: pa.Array) -> pa.Array:
        rows = []
        for x in texts:
            text = x.as_py() or ""
            found = base(text)
            n = Counter(k for k, _, _ in found)
            rows.append((n[0], n[1], n[2], n[3], hashlib.sha256(joined(found).encode()).hexdigest(), joined(field.spans(text, found))))
        types = [pa.int64()] * 4 + [pa.string()] * 2
        columns = list(zip(*rows)) or [()] * 6
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", of("text").alias("r")).select("doc_id", "r.*")


def redact(text: str, spans: list) -> str:
    """Spans replaced by <KIND>; of overlapping ones the first names the whole."""
    out, end = [], 0
    for a, b, k in sorted((a, -b, k) for k, a, b in spans):
        if a >= end:
            out += [text[end:a], f"<{KINDS[k].upper()}>"]
        end = max(end, -b)
    return "".join(out) + text[end:]


def redacted(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the spans of each text replaced by their kind."""
    field = train(docs, sample)

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        plain = (x.as_py() for x in texts)
        return pa.array([None if t is None else redact(t, field.spans(t, base(t))) for t in plain], pa.string())

    return docs.select(*[of("text").alias("text") if c == "text" else F.col(c) for c in docs.columns])
