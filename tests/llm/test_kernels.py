"""Brute-force versions of what runs inside tasks."""

import hashlib
import math
import random
import re

import numpy as np
import xxhash

from ledgerlake.llm import encoding, langid, neighbours, pii, simhash, suffixes
from ledgerlake.llm.vocabulary import SPACE, Pieces


def simple_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for t in [None, "", " \n", "One", "one TWO", "Ä b Ç d Ü f", "a b c d e f g a b c", "x\x1cy z\x85w v"]:
        assert simhash.fingerprint(t) == simple_fingerprint(t)


def test_bit_sliced_pairs():
    rng = np.random.default_rng(0)
    one = lambda n: np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    start = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = np.unique(np.concatenate([start] + [start ^ one(40) ^ one(40) for _ in range(12)]))
    groups = np.sort(rng.integers(0, 5, len(prints)))
    ends = np.searchsorted(groups, groups, side="right")
    for radius in (1, 2, 3, 6):
        got = {(int(a), int(b)) for i, j in simhash.near(prints, ends, radius) for a, b in zip(i, j)}
        want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if groups[i] == groups[j] and bin(int(prints[i]) ^ int(prints[j])).count("1") <= radius}
        assert got == want


def patterns(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]


def test_base_spans():
    rnd = random.Random(1)
    for _ in range(20_000):
        t = "".join(rnd.choice("1234 5.-+@a_(%é") for _ in range(rnd.randint(0, 40)))
        assert pii.base(t) == patterns(t)
    assert pii.base("1" * 200_000 + "a@" * 50_000) == []


def test_field_adds_similar_mentions():
    field = pii.Field({("shape", "11+", "3"): 50, ("shape", "10", "4"): 20, ("shape", "@2", "0"): 50, ("shape", "@0", "4"): 5, ("skip", "3", "3"): 40})
    t = "Call +1 (988) 555-2485 now, again 988-555-2485 or 19885552485, not 988-555-2486; bob.1@mail8.example.com or bob.1@mail8, al@x"
    found = {t[a:b] for _, a, b in field.spans(t, pii.base(t))}
    assert found == {"+1 (988) 555-2485", "988-555-2485", "19885552485", "bob.1@mail8.example.com", "bob.1@mail8"}
    clean = "In 1999 the 12345678 went to 10.20.30 and 4111 1111 1111 1112"
    assert field.spans(clean, pii.base(clean)) == []
    assert pii.redact("ab 1.2.3.4 c", [(1, 3, 10)]) == "ab <IP> c"


def test_field_finds_secrets():
    """A token's shape, a word that names it and its copies decide, not one pattern."""
    key, sha, slug = "04dbebab91ab85687d33", "9f" * 20, "release-notes-2024-final"
    usual = pii.Field({("shape", "$hex1", "5"): 30, ("shape", "$hex2", "4"): 40, ("shape", "$hex2", "5"): 1, ("shape", "$one case1-", "4"): 50})
    found = lambda f, t: [(pii.KINDS[k], t[a:b]) for k, a, b in f.spans(t, pii.base(t))]
    assert found(usual, f"so {key} it is") == [("secret", key)]  # the shape is mostly one of secrets
    assert found(usual, f"commit {sha} of {slug}") == []
    assert found(usual, f'PASSWORD: "{sha}" was set; {sha}.') == [("secret", sha)] * 2  # named once, the copy agrees
    assert found(usual, f"token = '{slug}'") == [("secret", slug)]
    none = pii.Field({})
    assert found(none, f"so {key} it is") == [] and found(none, f"api_key={key}") == [("secret", key)]
    assert found(none, "key: " + "a" * 300 + " token = 12345678901234567 " + "monkey: x") == []
    t = f"mail a.b@c.org, token: {key} and 1234567 in x1234567890123456"
    assert pii.redact(t, usual.spans(t, pii.base(t))) == "mail <EMAIL>, token: <SECRET> and 1234567 in x1234567890123456"


def test_shortest_path():
    p = Pieces()
    t = encoding.Transducer(p).compile()
    cost = {n: p.weight[i] for i, n in enumerate(p.text) if n}

    def least(s):
        if not s:
            return 0
        steps = [cost[s[:k]] + least(s[k:]) for k in range(1, len(s) + 1) if s[:k] in cost]
        return min(steps or [t.dear * len(s[0].replace(SPACE, " ").encode()) + least(s[1:])])

    for x in ("hello wor", "thentien a", "Ünïx☃k", "the&& é."):
        got = sum(p.weight[i] if p.text[i] else t.dear for i in t.encode(x).tolist())
        assert math.isclose(got, least(SPACE + x.replace(" ", SPACE)))
    for x in ("  a  b\n\n ▁x▁ \t<s><0x41>中𝔘é", " ", "", "\n", "▁", " ▁ ▁▁", " " * 50 + "x" * 2000):
        assert t.decode(t.encode(x).tolist()) == x


def test_forward_sums_all_segmentations():
    p = Pieces()
    lat = langid.Lattice(p)
    logp = np.log(np.random.default_rng(0).dirichlet(np.ones(lat.size), 3).T)
    ids = {n: i for i, n in enumerate(p.text) if n}

    def total(s, k):
        if not s:
            return 1.0
        out = sum(math.exp(logp[ids[s[:m]], k]) * total(s[m:], k) for m in range(1, len(s) + 1) if s[:m] in ids)
        return out if s[0] in ids else out + math.exp(logp[-1, k]) * total(s[1:], k)

    for w in ("thention", "an", "ünd", "ꙮa"):
        assert np.allclose(lat.forward(lat.arcs([w]), logp)[0, -1], [math.log(total(SPACE + w, k)) for k in range(3)])
    # expected counts are the derivative of the log of the sum
    one = logp[:, :1]
    counts = lat.counts(["thention"], np.ones(1), one)
    for i in np.flatnonzero(counts)[:5]:
        more = one.copy()
        more[i] += 1e-6
        slope = (lat.forward(lat.arcs(["thention"]), more)[0, -1, 0] - lat.forward(lat.arcs(["thention"]), one)[0, -1, 0]) / 1e-6
        assert abs(slope - counts[i]) < 1e-3


def test_least_places():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 2**64, 500, dtype=np.uint64)
    h[100:160] = h[7]
    cut = h >> np.uint64(suffixes._PIECE_BITS)
    for w in (1, 5, 37):
        assert suffixes.least(h, w).tolist() == [i + int(cut[i : i + w].argmin()) for i in range(len(h) - w + 1)]


def test_forest_finds_the_nearest():
    rng = np.random.default_rng(5)
    have, ask = rng.standard_normal((3000, 32)), rng.standard_normal((40, 32))
    sims = (ask / np.linalg.norm(ask, axis=1)[:, None]) @ (have / np.linalg.norm(have, axis=1)[:, None]).T
    hits = [len(set(rows) & set(np.argsort(-s)[:5])) for (rows, _), s in zip(neighbours.Forest(have).search(ask, 5), sims)]
    assert sum(hits) / 200 >= 0.9


def naive_repeats(texts, length):
    """doc -> (n_bytes, n_removed, n_spans, sha256 of the rest)."""
    seen: dict = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]] = seen.get(t[p : p + length], 0) + 1
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        spans = sum(m and (i == 0 or not mask[i - 1]) for i, m in enumerate(mask))
        out.append((len(t), sum(mask), spans, hashlib.sha256(bytes(c for c, m in zip(t, mask) if not m)).hexdigest()))
    return out


def test_anchors_of_joined_texts(monkeypatch):
    """Texts that are joined have the anchors that each has alone."""
    rnd = random.Random(3)
    texts = [bytes(rnd.choice(b"aab" if i % 2 else b"abcdefgh") for _ in range(n)) for i, n in enumerate((0, 11, 12, 13, 40, 200, 0, 90, 11, 300))]
    texts += [b"a" * 60, b"ab" * 40, texts[5]]
    alone = [suffixes.anchors([t], 12, 3) for t in texts]
    for size in (1, 150, 10**6):
        monkeypatch.setattr(suffixes, "BATCH", size)
        sizes, columns, spans, within = suffixes.anchors(texts, 12, 3)
        assert sizes == [x[0][0] for x in alone] and spans == [x[2][0] for x in alone]
        assert {k: v.tolist() for k, v in columns.items()} == {k: [n for x in alone for n in x[1][k].tolist()] for k in columns}
        assert {k: v.dtype for k, v in columns.items()} == {k: np.dtype(t) for k, t in suffixes.TYPES.items()}
        assert within.tolist() == [r for x in alone for r in x[3].tolist()]
