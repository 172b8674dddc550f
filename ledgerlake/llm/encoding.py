"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are compiled from the model: the normaliser (a blank
becomes U+2581, one more stands before the text), the pieces (a trie whose
final arcs put out a piece's id at its cost) and the byte fallback (any
character to the ids of its UTF-8 bytes, each dearer than any piece).  They
are composed with the input while it is read; the encoding is the shortest
path in the tropical semiring (costs add along a path, the least path
wins).  Of equally cheap paths the one found first from the left wins, with
shorter pieces tried before longer.

No piece crosses a cut before a blank run, around a line break or between a
letter and another character (checked when the model is read), so the
shortest path of a text is the shortest paths of its units put together,
and a task keeps the paths of the units it has seen.

Decoding is exact: the text comes back as it was, line breaks, blank runs
and U+2581 itself (always byte-encoded) included.

Defined results: null is encoded as null, and decodes to null; the empty
text has no ids; very long units are encoded whole; ties, repeated rows and
empty tables need nothing special.  Columns of the table pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fresh
from .vocabulary import LETTER, MODEL, OTHER, SPACE, Memo, Pieces

#: Letters or other characters, with the blanks before; rests and lone characters.
UNIT = re.compile(rf" *{LETTER}+| *(?:(?![ \n{SPACE}]){OTHER})+| +|\n|{SPACE}")
RESULT = "struct<ids:array<int>,n_tokens:int,n_bytes:int,round_trip:boolean>"
#: Units up to this many characters are remembered.
REMEMBER = 48


class Transducer:
    def __init__(self, pieces: Pieces):
        self.pieces, self.ready = pieces, False

    def __getstate__(self):  # tasks compile the transducers for themselves
        return {"pieces": self.pieces, "ready": False}

    def compile(self) -> "Transducer":
        p = self.pieces
        self.start = p.trie(lambda i: (p.weight[i], i))
        self.dear = max(p.weight) + 10  # of each fallback byte
        self.bytes_of = [b"" if t is None else t.replace(SPACE, " ").encode() for t in p.text]
        for b, i in p.byte.items():
            self.bytes_of[i] = bytes([b])
        self.is_byte = np.zeros(len(p.text), bool)
        self.is_byte[list(p.byte.values())] = True
        self.memo, self.ready = Memo(), True
        return self

    def path(self, unit: str) -> list[int]:
        """Ids along the shortest path of a unit (blanks as they are)."""
        byte = self.pieces.byte
        if unit == SPACE:
            return [byte[b] for b in unit.encode()]
        s = unit.replace(" ", SPACE)
        n, start = len(s), self.start
        best, back = [0.0] + [float("inf")] * n, [(0, ())] * (n + 1)
        for i in range(n):
            b, node, j = best[i], start, i
            while j < n and (node := node.get(s[j])) is not None:
                j += 1
                arc = node.get("")
                if arc is not None and b + arc[0] < best[j]:
                    best[j], back[j] = b + arc[0], (i, (arc[1],))
            if back[i + 1][0] != i or not back[i + 1][1]:  # no piece ends the first step: the fallback's arc
                raw = (" " if s[i] == SPACE else s[i]).encode("utf-8", "surrogatepass")
                if b + self.dear * len(raw) < best[i + 1]:
                    best[i + 1], back[i + 1] = b + self.dear * len(raw), (i, tuple(byte[x] for x in raw))
        out = []
        while n:
            n, ids = back[n]
            out.append(ids)
        return [i for ids in reversed(out) for i in ids]

    def miss(self, unit: str) -> bytes:
        got = self.memo.get(unit)
        if got is None:
            got = np.array(self.path(unit), "<i4").tobytes()
            if len(unit) <= REMEMBER:
                self.memo.put(unit, got)
        return got

    def encode(self, text: str) -> np.ndarray:
        if not self.ready:
            self.compile()
        if not text:
            return np.zeros(0, np.int32)
        known, miss = self.memo.new, self.miss
        return np.frombuffer(b"".join([known.get(u) or miss(u) for u in UNIT.findall(" " + text)]), "<i4")

    def decode(self, ids) -> str:
        if not self.ready:
            self.compile()
        bytes_of = self.bytes_of
        return b"".join([bytes_of[i] for i in ids]).decode("utf-8", "replace")[1:]


_compiled: dict = {}


def compiled(t: Transducer, key: str) -> Transducer:
    """A task process compiles a model's transducer once."""
    if key not in _compiled:
        _compiled[key] = t.compile()
    return _compiled[key]


def encoded(docs: DataFrame, model: str = MODEL, by_rank: bool = True, text: str = "text", name: str = "encoding") -> DataFrame:
    """``docs`` with a struct of ids, n_tokens, n_bytes (tokens that are
    fallback bytes) and round_trip (the ids decode to the text)."""
    t, key = Transducer(Pieces(model, by_rank)), f"{model}:{by_rank}"

    @F.arrow_udf(RESULT)
    def encode(texts: pa.Array) -> pa.Array:
        fst = compiled(t, key)
        ids, n_bytes, same = [], [], []
        for x in texts:
            x = x.as_py()
            got = fst.encode(x or "")
            ids.append(got)
            n_bytes.append(int(fst.is_byte[got].sum()))
            same.append(None if x is None else fst.decode(got.tolist()) == x)
        missing = np.array([s is None for s in same], bool)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
        return pa.StructArray.from_arrays([lists, pa.array(counts.astype(np.int32)), pa.array(n_bytes, pa.int32()), pa.array(same, pa.bool_())], ["ids", "n_tokens", "n_bytes", "round_trip"], mask=pa.array(missing))

    return docs.withColumn(name, encode(F.col(text)))


def decoded(rows: DataFrame, ids: str = "ids", model: str = MODEL, by_rank: bool = True, name: str = "text") -> DataFrame:
    """``rows`` with the text of an array of ids."""
    t, key = Transducer(Pieces(model, by_rank)), f"{model}:{by_rank}"

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        fst = compiled(t, key)
        return pa.array([None if x is None else fst.decode(x) for x in (y.as_py() for y in lists)], pa.string())

    return rows.withColumn(name, decode(F.col(ids)))


def encode_documents(docs: DataFrame, model: str = MODEL, by_rank: bool = True) -> DataFrame:
    """doc_id, n_tokens, n_bytes, round_trip, ids; null for a null text."""
    (e,) = fresh(docs, "encoding")
    out = encoded(docs.select("doc_id", "text"), model, by_rank, name=e)
    return out.select("doc_id", f"{e}.n_tokens", f"{e}.n_bytes", f"{e}.round_trip", f"{e}.ids")
