"""WARC archives, spelling variants and hard negatives against brute force
and on odd tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerlake.llm import negatives, variants, warc
from tests.llm.conftest import frame
from tests.llm.test_operators import rows_of

PAGES = "page_id long, url string, html string, row string, size string, same long, first_row string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], PAGES)


def recorded(rows, at_least=0):
    """What the archives must give back, as a multiset."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first, out = {}, Counter()
    for i in order:
        page, _, html = rows[i]
        body = (html or "").encode()
        full = len(body) < at_least or body not in first
        first.setdefault(body, page)
        out[page, "response" if full else "revisit", len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), None if full else first[body]] += 1
    return out


ODD_PAGES = [
    (7, "http://a/b c\r\nX: y", "same"), (3, None, "same"), (3, None, "same"), (None, "u", "same"), (4, "u", None), (5, "u", ""), (2**60 + 1, "é", "ü中\r\n\r\nWARC/1.1"),
    (8, "v", "z" * 5_000_000), (None, None, None), (9, "w", "<html>" + "text " * 300), (9, "w", "other"),
]


@pytest.mark.parametrize("at_least", [0, 5])
def test_warc_round_trip(spark, at_least):
    df = pages(spark, ODD_PAGES)
    assert Counter(rows_of(warc.report(df, at_least))) == recorded(ODD_PAGES, at_least)
    back = warc.read(warc.archive(df, at_least)).collect()
    assert all(r.payload is None if r.record_type == "revisit" else bytes(r.payload) in {(h or "").encode() for _, _, h in ODD_PAGES} for r in back)
    assert warc.report(df.limit(0)).count() == 0 and warc.archive(df.limit(0)).count() == 0


def test_warc_hot_payload_and_several_archives(spark):
    rnd = random.Random(3)
    rows = [(i, f"http://h/{i}", "copy" if i % 3 == 0 else f"<p>{rnd.random()} some words of a page</p>" * 20) for i in range(600)]
    rnd.shuffle(rows)
    df = pages(spark, rows).repartition(4)
    made = warc.archive(df, archive_bytes=1)
    assert made.count() >= 1 and made.agg(F.sum("n_records")).first()[0] == 600
    assert Counter(rows_of(warc.read(made).drop("url", "payload"))) == recorded(rows)


def test_warc_bytes(spark):
    """An archive as its format says: a dictionary in a leading skippable
    frame, then a frame for each record."""
    html = ["<p>" + f"page {i} with the same words as others have" * 9 for i in range(400)]
    one = warc.archive(pages(spark, [(i, f"http://h/{i}", h) for i, h in enumerate(html)]).coalesce(1))
    for path, n, size in rows_of(one):
        raw = open(path.removeprefix("file://"), "rb").read()
        assert raw[:4] == bytes([0x5D, 0x2A, 0x4D, 0x18]) and len(raw) == size
        length = int.from_bytes(raw[4:8], "little")
        made = zstandard.ZstdDecompressor().decompress(raw[8 : 8 + length])
        frames = list(warc.frames(path, chunk=100))
        assert len(frames) == n + 1 and all(f.startswith(b"WARC/1.1\r\n") and f.endswith(b"\r\n\r\n") for f in frames)
        plain = sum(len(zstandard.ZstdCompressor().compress(f)) for f in frames)
        assert size - 8 - length < plain / 2  # what the dictionary is for
        with pytest.raises(ValueError):
            cut = path.removeprefix("file://") + ".cut"
            open(cut, "wb").write(raw[:-3])
            list(warc.frames(cut))
        assert made


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts, ratio=5):
    form, out = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = len(others)
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], counts.get(form[w])))
    return rows


def test_variants_of_words(spark):
    rnd = random.Random(5)
    words = {"".join(rnd.choice("abß") for _ in range(rnd.randint(6, 9))) for _ in range(300)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "x" * 20_000, "x" * 20_001}
    counts = {w: rnd.choice([5, 6, 25, 30, 130, 700, 4000]) for w in sorted(words)}
    got = rows_of(variants.group(spark.createDataFrame(sorted(counts.items()), "word string, n long")))
    assert len(got) == len(counts) and set(got) == grouped(counts)
    assert any(form and form != root for _, form, root, *_ in got)


def spelt(rows):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    return {w: n for w, n in counts.items() if n >= 5}


def test_variants_of_texts(spark, odd, empty):
    rnd = random.Random(6)
    words = ["Étoiles", "étoiles", "letters", "lettres", "Numbers", "nombers", "SHORT", "×÷×÷×÷×", "a1bcdefg"]
    rows = [(rnd.randint(0, 400), " ".join(rnd.choice(words) for _ in range(400)), None, None) for _ in range(60)] + [(None, None, None, None), (None, "letters " * 9, None, None)]
    got = rows_of(variants.variants(frame(spark, rows)))
    assert len(got) == len(set(got)) and set(got) == grouped(spelt(rows))
    have = [tuple(r)[:4] for r in odd.collect()]
    assert set(rows_of(variants.variants(odd))) == grouped(spelt(have))
    assert variants.variants(empty).count() == 0


def test_node_numbers_are_proved(spark, monkeypatch):
    words = spark.createDataFrame([(w,) for w in ("abcdef", "abcxef", "zbcdef")], "word string")
    assert variants.one_to_one(words, 1 << 40)
    assert not variants.one_to_one(words, 0)  # every node named by its last letter
    draws = iter([0, 1 << 40])
    monkeypatch.setattr(variants.random.Random, "randrange", lambda *_: next(draws))
    assert variants.numbered(words) == 1 << 40


def mined(rows, anchors):
    """rows: distinct (id, vector of whole numbers, label)."""
    out = []
    for a, q, la in (r for r in rows if r[0] in anchors):
        score = [(-sum(int(x) * int(y) for x, y in zip(q, v)), i, lb) for i, v, lb in rows if i != a and len(v) == len(q)]
        for s, p, _ in sorted(x for x in score if x[2] == la)[:5]:
            fits = sorted((n, i) for n, i, lb in score if lb != la and -30 * s <= -100 * n <= -90 * s)[:10]
            out += [(a, p, k, i, -s, -n) for k, (n, i) in enumerate(fits, 1)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, "x", 2, "y") for i, v, g in rows], "vec_id long, embedding array<double>, label int, anchor long, shard string, v long, ids string")


@pytest.mark.parametrize("shard", [7, 8192])
def test_negatives(spark, shard):
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rnd.integers(-3, 4, 5)], int(rnd.integers(0, 3))) for i in range(200)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(40)]  # one vector many times, ties throughout
    rows += [(2000, [0.0] * 5, 0), (2001, [1.0, 2.0], 0), (2002, [1.0, 1.0], 0), (2003, [2.0, 0.5], 1)]
    more = rows + rows[:3] + [(None, rows[0][1], 0), (3000, None, 0), (3001, rows[0][1], None), (3002, [1.0, None, 0.0, 0.0, 0.0], 0), (3003, [float("nan")] * 5, 0), (3004, [float("inf")] * 5, 0)]
    got = rows_of(negatives.mine(vectors(spark, more), F.col("vec_id") % 4 == 0, rows_in_shard=shard))
    whole = [(i, [int(np.floor(256 * x)) for x in v], g) for i, v, g in rows]
    want = mined(whole, {i for i, *_ in rows if i % 4 == 0})
    assert len(want) > 500 and sorted(got) == sorted(want)


def test_negatives_of_any_size(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [3e30, 5.0], 0), (2, [1.5e30, 7.0], 1), (3, [1.5e30, 6.0], 1), (4, [-1e30, 0.0], 0)]
    got = rows_of(negatives.mine(vectors(spark, rows), F.col("vec_id") == 0))
    assert got == [(0, 1, 1, 2, negatives.LONG, negatives.LONG), (0, 1, 2, 3, negatives.LONG, negatives.LONG)]
    assert negatives.mine(vectors(spark, rows).limit(0), F.col("vec_id") == 0).count() == 0


def test_threshold_ends_early():
    """Far rows are not scored once the threshold is below the k-th score."""
    n = 4096
    v = np.zeros((n, 2))
    v[:, 0] = np.arange(n)
    v[:, 1] = np.arange(n)
    lists = negatives.Lists(v, np.zeros(n, int), [[i] for i in range(n)])
    scored = []
    whole = lists.scores
    lists.scores = lambda rows, anchor: scored.append(len(rows)) or whole(rows, anchor)
    assert lists.search(np.array([1.0, 1.0]), -1, lambda g: g == 0, [(None, None)], 3) == [[(8190, 4095), (8188, 4094), (8186, 4093)]]
    assert sum(scored) == negatives.FIRST




def test_neighbours_tied_at_the_cut(spark):
    """Multiples of one vector: the exact score decides, then the id."""
    from ledgerlake.llm import neighbours

    rnd = np.random.default_rng(5)
    base = rnd.normal(size=16)
    rows = [(i, [float(x) for x in base * (1 + i * 0.37)]) for i in range(40)] + [(100 + i, [float(x) for x in rnd.normal(size=16)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0, k=5).orderBy("query_id", "rank").collect()]
    vectors = {i: np.array(v) for i, v in rows}
    for q in (0, 10, 30):
        cosines = sorted((-float(v @ vectors[q] / (np.linalg.norm(v) * np.linalg.norm(vectors[q]))), i) for i, v in vectors.items() if i != q)[:5]
        mine = [(-s, i) for a, _, i, s in got if a == q]
        assert [round(s, 12) for s, _ in mine] == [round(s, 12) for s, _ in cosines]
        assert mine == sorted(mine) and len({i for _, i in mine}) == 5 and all(i < 100 for _, i in mine)
