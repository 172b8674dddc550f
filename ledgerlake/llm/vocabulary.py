"""Pieces of a public SentencePiece model, read on the driver and sent to the
tasks; the file is a parameter and never trained."""

from __future__ import annotations

import math
import re

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # stands for a blank in pieces
#: Character classes between which no piece may cross.
LETTER, OTHER = r"[^\W\d_²³¹]", r"[\W\d_²³¹]"


class Pieces:
    """``text[i]``: piece i as text, None if it is a control or byte piece;
    ``byte[b]``: id of byte b's piece; ``weight[i]``: cost of piece i.

    A unigram model's scores are log probabilities, so a cost is the negated
    score.  A BPE model's scores are negated merge ranks, which don't add up;
    there the cost is the log of the rank (Zipf's law), ``by_rank``."""

    def __init__(self, model: str = MODEL, by_rank: bool = True):
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=model)
        ids = range(p.get_piece_size())
        names = [p.id_to_piece(i) for i in ids]
        plain = [not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)) for i in ids]
        self.text = [n if ok else None for n, ok in zip(names, plain)]
        self.byte = {int(n[3:5], 16): i for i, n in enumerate(names) if p.is_byte(i)}
        self.weight = [math.log(2 - p.get_score(i)) if by_rank else -p.get_score(i) for i in ids]
        # so texts may be cut before a run of blanks, around line breaks, and where letters end or begin
        crossing = [n for n in filter(None, self.text) if re.search(rf"[^{SPACE}]{SPACE}|[ \n]|{LETTER}{OTHER}|(?!{SPACE}){OTHER}{LETTER}", n)]
        if crossing:
            raise ValueError(f"{model} has pieces across words: {crossing[:5]}")

    def trie(self, arc) -> dict:
        """Nested dictionaries by character; ``arc(i)`` under '' where piece i ends."""
        root: dict = {}
        for i, name in enumerate(self.text):
            if name:
                node = root
                for c in name:
                    node = node.setdefault(c, {})
                node[""] = arc(i)
        return root


class Memo:
    """A task's results by word: the most recent ones stay, at most 2 * most."""

    def __init__(self, most: int = 200_000):
        self.most, self.new, self.old = most, {}, {}

    def get(self, word):
        x = self.new.get(word)
        if x is None and (x := self.old.get(word)) is not None:
            self.put(word, x)
        return x

    def put(self, word, x) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[word] = x
