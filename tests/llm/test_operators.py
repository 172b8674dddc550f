"""Operators on small tables against brute force, and on odd tables."""

import hashlib
import random
import textwrap
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import encoding, langid, licences, mixing, neighbours, pii, queries, simhash, spotsigs, suffixes, urls
from tests.conftest import SF0001
from tests.llm.conftest import frame
from tests.llm.test_kernels import naive_repeats, patterns, simple_fingerprint
from tests.oracle_compare import digest, duck, type_mismatches


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    df = queries.QUERIES[name](spark, SF0001)
    con = duck(SF0001)
    cur = con.execute(queries.ORACLE_SQL[name])
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(columns) == sorted(df.columns) and type_mismatches(df, con, queries.ORACLE_SQL[name]) == {}
    assert digest(df.columns, rows_of(df))[0] == digest(columns, want)[0]


def test_licences(spark, odd, empty):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3."]
    texts = ["\n".join(["Plain words go here for a while.", line, "And more of them follow."]) for line in lines]
    texts += ["He has a license to drive a bus.", "nothing at all\n\nhere", lines[0] + "\n" + lines[1]]
    docs = frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]).unionByName(odd.withColumn("doc_id", F.col("doc_id") + 100))
    got = {(r.doc_id, r.paragraph, r.family) for r in licences.scan(docs).collect()}
    assert got == {(0, 1, "mit"), (1, 1, "apache"), (2, 1, "cc-by-nc"), (3, 1, "gpl"), (6, 0, "mit"), (6, 1, "apache")}
    assert licences.scan(empty).count() == 0


def test_licences_count_numbers(spark, empty):
    """A number is a word, of paragraphs and of notices alike."""
    text = "CC0 1.0, v2 of 2020-01-02: All rights"
    row = spark.range(1).select(licences.words(F.lit(text)).alias("w"), licences.pairs(F.lit(text)).alias("p")).first()
    assert row.w == ["cc", "0", "0", "v", "0", "of", "0", "0", "0", "all", "rights"]
    assert sorted(row.p) == licences.notice_pairs(text)
    share = lambda t: spark.range(1).select(licences.overlap(licences.pairs(F.lit(t)), F.lit("proprietary"))).first()[0]
    assert share("All rights reserved.") < licences.CONFIRMED < share("Copyright 1999. All rights reserved.") == 1
    assert licences.FEATURES >= 1 << 12 and len(licences.train(empty).number) == licences.FEATURES


#: Notices as they are met in the wild, with the family that each gives.
COMMON = (
    ("mit", "Distributed under the terms of the MIT license."), ("mit", "SPDX-License-Identifier: MIT"), ("mit", "This project is MIT licensed."), ("bsd", "Licensed under the BSD license."),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice appears in all copies."),
    ("apache", "This code is licensed under Apache-2.0"), ("cc-by-sa", "Creative Commons Attribution-ShareAlike 3.0 Unported"), ("cc0", "This data is dedicated to the public domain under CC0 1.0."),
    ("proprietary", "Copyright 2019 Jane Doe. All rights reserved."), ("proprietary", "Copyright (c) 2019 Jane Doe. All rights reserved."),
)


def test_licences_common_forms(spark, documents):
    plain = ["SPDX-License-Identifier: OFL-1.1", "The ISC committee met.", "All projects are licensed by the city.", "The public domain was dedicated to the king."]
    rows = [(-1 - i, t, None, None) for i, t in enumerate([t for _, t in COMMON] + plain)]
    docs = documents.select("doc_id", "text").unionByName(frame(spark, rows).select("doc_id", "text"))
    got = {(r.doc_id, r.family) for r in licences.scan(docs).collect() if r.doc_id < 0}
    assert got == {(-1 - i, f) for i, (f, _) in enumerate(COMMON)}


def test_licence_bound_and_keys(spark, documents):
    """Neither the bound of a paragraph's lead nor the key pairs leave out a
    paragraph that scoring in full, or all word pairs, would report."""
    rnd = random.Random(5)
    lines = {t for _, t in (*licences.NOTICES, *COMMON)} | {*licences.PLAIN}
    lines |= {" ".join(w for w in t.split() if rnd.random() < 0.8) for t in sorted(lines) for _ in range(4)}
    lines |= {x for r in documents.limit(200).collect() for x in (r.text or "").split("\n") if x}
    rows = spark.createDataFrame(sorted((x,) for x in lines), "line string")
    model = licences.train(documents)
    got = {r.line: (r.family, r.probability) for r in model.scored(rows, "line").collect()}
    want = {}
    full = rows.select("line", model.active(F.col("line")).alias("a"), licences.may_confirm(F.col("line")).alias("may"), licences.pairs(F.col("line")).alias("p")).collect()
    for r in full:
        raw = model.start + model.weights[np.array(r.a, int) - 1].sum(0)
        p = np.exp((raw - raw.max()) / model.temperature)
        best = int(raw.argmax())
        if model.families[best] != licences.UNKNOWN and 1 / p.sum() >= licences.LEAST:
            want[r.line] = (model.families[best], 1 / p.sum())
    assert {x: f for x, (f, _) in got.items()} == {x: f for x, (f, _) in want.items()} and len(want) > 40
    assert all(abs(got[x][1] - p) < 1e-9 for x, (_, p) in want.items())
    notices = [set(licences.notice_pairs(t)) for _, t in licences.NOTICES]
    confirmed = {r.line for r in full if any(len(n & set(r.p)) / len(n) >= licences.CONFIRMED for n in notices)}
    assert len(confirmed) > 40 and confirmed <= {r.line for r in full if r.may}


def test_licence_key_pattern(spark):
    """The expression finds exactly the texts with a key pair among their words."""
    keys = sorted({p for _, t in licences.NOTICES for p in licences.key_pairs(t)})
    rnd = random.Random(9)
    parts = sorted({w for p in keys for w in p.split()} - {"0"}) + ["1.0", "7", "2020-01", "é", "x", "0"]
    glue = [" ", "-", "", "\n", "_", ", ", " (", "\u0301", "\U0001f600", ".", "0", "\u0663", "İ", "é"]
    texts = {"", " ", *keys, *[k.upper() for k in keys], *[g.join(k.split()) for k in keys for g in glue], *["x" + k for k in keys], *[k + "s" for k in keys], *["3 " + k + "4" for k in keys]}
    texts |= {"".join(rnd.choice(parts) + rnd.choice(glue) for _ in range(rnd.randint(1, 5))) for _ in range(4000)}
    rows = spark.createDataFrame(sorted((t,) for t in texts), "t string").union(spark.range(1).select(F.lit(None).cast("string")))
    got = rows.select("t", licences.may_confirm(F.col("t")).alias("may"), licences.pairs(F.col("t")).alias("p")).collect()
    wrong = [r for r in got if bool(r.may) != bool({*(r.p or [])} & {*keys})]
    assert not wrong and sum(bool(r.may) for r in got) > 500 and sum(r.may is False for r in got) > 500


def test_licences_wrapped(spark):
    """Notices wrapped over lines are found once, where they begin."""
    families = ["gpl", "bsd", "cc-by", "cc-by-nc", "cc-by-sa", "cc0", "mit"]
    notices = [(f, t) for f, t in licences.NOTICES if f in families and len(t) > 72]
    assert {f for f, _ in notices} == {*families}
    wrapped = [(f, "\n".join(textwrap.wrap(t, width, break_on_hyphens=False))) for f, t in notices for width in (48, 72)]
    texts = ["Plain words go here for a while.\n" + t + "\nAnd more of them follow." for _, t in wrapped]
    texts += ["Text before. Released under\nthe MIT License. Licensed under the\nApache License, Version 2.0."]
    got = sorted((r.doc_id, r.paragraph, r.family) for r in licences.scan(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect())
    last = len(wrapped)
    assert [g for g in got if g[0] < last] == [(i, 1, f) for i, (f, _) in enumerate(wrapped)]
    # windows with a key pair are those of all runs of paragraphs that are short enough
    longest, keys = max(len(licences.notice_words(t)) for _, t in licences.NOTICES), {p for _, t in licences.NOTICES for p in licences.key_pairs(t)}
    lines = texts[0].split("\n") + ["...", "a b c"] * 40 + ["", "mit"] + texts[-1].split("\n")
    rows = spark.createDataFrame([("\n".join(lines),)], "t string").select(F.inline(licences.windows(F.col("t")))).where(licences.may_confirm(F.col("line")))
    full = [(i, x, licences.notice_words(x)) for i, x in enumerate(filter(None, lines)) if licences.notice_words(x)]
    want = []
    for i in range(len(full)):
        for j in range(i, min(len(full), i + longest)):
            run = full[i : j + 1]
            line = " ".join(x for _, x, _ in run)
            if sum(len(w) for *_, w in run[1:-1]) <= longest - 2 and keys & {*licences.notice_pairs(line)}:
                want.append((run[0][0], run[-1][0], line))
    assert sorted(tuple(r) for r in rows.collect()) == sorted(want) and len(want) > 20
    # the second line has all word pairs of a notice of MIT, whatever their order
    assert [g for g in got if g[0] == last] == [(last, 1, "apache"), (last, 1, "mit")]


def test_mix(spark, odd, empty, documents):
    report = mixing.mix_report(odd).collect()
    assert len(report) == odd.count() and all(r.taken <= 3 * r.size for r in report)
    per = {r.source: r for r in report}
    assert abs(sum(r.target for r in per.values()) - sum(r.size for r in report)) < 1e-6
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert Counter(r.doc_id for r in mixed.collect() if r.text)[4] == next(r.times for r in report if r.doc_id == 4)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
    report = mixing.mix_report(documents).collect()
    got, want = Counter(), {}
    for r in report:
        got[r.source] += r.taken
        want[r.source] = r.target
    largest = max(r.size for r in report)
    assert all(abs(got[s] - t) <= largest for s, t in want.items())
    assert Counter(rows_of(mixing.mix_report(documents))) == Counter(map(tuple, report))


def test_mix_of_equal_rows(spark):
    docs = frame(spark, [(1, "a b c", None, "s")] * 5 + [(2, "d e", None, "t")])
    report = rows_of(mixing.mix_report(docs).orderBy("doc_id"))
    assert len(report) == 6 and len({r for r in report if r[0] == 1}) == 1


def test_language(spark, odd, empty, documents):
    got = {(r.doc_id, r.held_out, r.lang_pred) for r in langid.identify(odd).collect()}
    assert {(2, False, "und"), (3, True, "und")} <= {(i, i == 3, g) for i, _, g in got} and len(got) >= 9
    assert {g for i, _, g in got if i in (2, 3, 5, 6)} >= {"und"}
    assert langid.identify(empty).count() == 0
    assert langid.accepted(odd).columns == odd.columns
    found = langid.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.where("lang = lang_pred").count() / found.count()
    assert right > 0.97
    assert found.where("score < 0 or score > 1").count() == 0


#: Sentences in languages that the tables don't hold, and letter noise.
FOREIGN = (
    "Az ember, aki a hegyekben élt, minden reggel korán kelt, hogy megnézze a napfelkeltét, és aztán lement a faluba kenyeret venni.",
    "De man die in de bergen woonde stond elke ochtend vroeg op om brood te kopen in het dorp.",
    "Mies joka asui vuorilla nousi joka aamu aikaisin ostamaan leipää kylästä ja palasi illalla kotiin.",
    "Россия является крупнейшей страной в мире по площади и занимает первое место.",
    "日本語の文章はひらがなとカタカナと漢字を使います",
    "xq zvk wjprt qqmz kdfgh trplx vbnm zzxq wrtk plkjh gfdsq mnbvc qwrtp zxcvk",
)


def test_language_not_learnt(spark, documents):
    """Texts in no learnt language go, whatever their score; those that only
    hold some foreign words, and all of the table's own, stay."""
    own = documents.where("text is not null and lang = 'en' and length(text) > 300").orderBy("doc_id").first().text
    texts = [*FOREIGN, own, own + " " + FOREIGN[0][:40], "Hello", "12 " + own[:60]]
    rows = documents.select("doc_id", "text", "lang").unionByName(frame(spark, [(-1 - i, t, None, None) for i, t in enumerate(texts)]).select("doc_id", "text", "lang"))
    kept = {r.doc_id for r in langid.accepted(rows).collect()}
    letters = {r.doc_id for r in documents.collect() if any(unicodedata.category(c)[0] == "L" for c in r.text or "")}
    assert {i for i in kept if i < 0} == {-1 - i for i in range(len(FOREIGN), len(texts))}
    assert {i for i in kept if i >= 0} == letters
    few = {r.doc_id: r.score for r in langid.identify(rows).collect() if r.doc_id < 0}
    assert max(few[-1 - i] for i in range(len(FOREIGN))) > 0.9  # the score alone wouldn't tell


def test_language_sample_in_parts(spark, documents, monkeypatch):
    """Ranking ids in parts first changes nothing."""
    want = langid.train(documents, per_lang=7, rounds=1)
    monkeypatch.setattr(langid, "SALTS", 1)
    got = langid.train(documents, per_lang=7, rounds=1)
    assert got[0] == want[0] and np.allclose(got[1], want[1]) and np.allclose(got[2], want[2])
    langs, logp, usual = langid.train(documents, per_lang=10**6, rounds=2)
    words = Counter((r.lang, w) for r in documents.where(langid.in_training(F.col("doc_id"))).dropDuplicates(["doc_id", "lang", "text"]).collect() if r.lang and r.text for w in langid.LETTERS.findall(r.text.lower()))
    before = langid.train(documents, per_lang=10**6, rounds=1)[1].astype(np.float32).astype(float)
    lat = langid.Lattice(langid.Pieces(langid.MODEL))
    for i, g in enumerate(langs):
        mine = [(w, n) for (lang, w), n in words.items() if lang == g]
        total = sum(n * lat.forward(lat.arcs([w]), before[:, [i]])[0, -1, 0] for w, n in mine)
        assert np.isclose(usual[i], total / sum(n * (len(w) + 1) for w, n in mine), rtol=1e-4)


def test_suffixes(spark, odd, empty, documents):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, line = text(200), "x" * 70 + "\n"
    texts = [shared, text(50) + shared[:900] + text(40), shared[200:700] + text(90), text(300), "", "a" * 1500, "b" * 399, line * 20, text(30) + line * 9 + text(60)]
    texts += [shared[:450] + "!" + shared[450:], shared, text(20) + shared[-420:]]
    docs = frame(spark, [(i, t, None, None) for i, t in enumerate(texts)] + [(90, None, None, None), (91, shared, None, None), (91, shared, None, None)])
    want = naive_repeats([t.encode() for t in texts] + [b""] + [shared.encode()] * 2, 400)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removed(docs).collect())
    assert got == [(i, *w) for i, w in zip([*range(len(texts)), 90, 91, 91], want)]
    assert suffixes.removed(odd).count() == odd.count() and suffixes.removed(empty).count() == 0
    texts = [(r.doc_id, (r.text or "").encode()) for r in documents.collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removed(documents).collect()}
    assert got == dict(zip([i for i, _ in texts], naive_repeats([t for _, t in texts], 400)))


def test_suffixes_cut_each_text_once(spark):
    """The phrases of a text are made once, though texts without any are left out."""
    rnd = random.Random(6)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(700))
    d = suffixes.with_row(frame(spark, [(1, long, None, None), (2, "short", None, None), (3, None, None, None), (4, "é" * 200, None, None)]))
    cuts = suffixes.phrases(d)
    plan = cuts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(r.n for r in cuts.select(F.size("found").alias("n")).collect())[0] > 0 and cuts.count() == 2


def test_suffixes_of_one_gram(spark, monkeypatch):
    """A gram with more blocks than BIG is dealt by ranges."""
    monkeypatch.setattr(suffixes, "BIG", 2)
    rnd = random.Random(4)
    middle = "".join(rnd.choice("abcdefgh") for _ in range(420))
    texts = ["".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 90))) + middle[rnd.randint(0, 30) :] + "".join(rnd.choice("uvw") for _ in range(rnd.randint(0, 90))) for _ in range(25)]
    docs = frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removed(docs).collect())
    assert got == [(i, *w) for i, w in enumerate(naive_repeats([t.encode() for t in texts], 400))]


def test_urls(spark):
    pages = [(1, "http://a.Example.NET/en/x?q"), (2, "https://net/"), (3, "http://x.net"), (4, None), (5, "no scheme"), (6, "http://b.org/fr/1#f"), (7, "http://EXAMPLE.com/de/"), (8, "http://xnet/en/"), (1, "http://a.Example.NET/en/x?q"), (None, "u://q.net/é\nz?"), (9, "")]
    df = spark.createDataFrame([(i, u, "h", "p", "b", 1) for i, u in pages], "page_id long, url string, host string, p string, best string, h long")
    rules = spark.createDataFrame([*urls.RULES, ("net", "/", "block"), (None, "/", "block"), ("b.org", "/f", "block"), ("org", "", "block")], "host string, path string, verdict string")
    got = sorted(((r[0], r["url"], r["_host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(df, rules).collect()), key=str)
    want = [
        (1, pages[0][1], "a.example.net", "/en/x", "example.net/en/", "allow"), (1, pages[0][1], "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "https://net/", "net", "/", "net/", "block"),
        (3, "http://x.net", "x.net", "", None, "allow"), (4, None, "", "", None, "allow"), (5, "no scheme", "", "", None, "allow"), (6, pages[5][1], "b.org", "/fr/1", "b.org/f", "block"),
        (7, pages[6][1], "example.com", "/de/", "example.com/de/", "block"), (8, pages[7][1], "xnet", "/en/", None, "allow"), (9, "", "", "", None, "allow"), (None, pages[9][1], "q.net", "/é\nz", "net/", "block"),
    ]
    assert got == sorted(want, key=str)
    assert urls.judge(df, rules.limit(0)).where("verdict <> 'allow'").count() == 0
    assert urls.judge(df.limit(0), rules).count() == 0


def components(prints, radius):
    """row -> smallest id of its component, by brute force; ids may be None."""
    n, top = len(prints), list(range(len(prints)))
    find = lambda i: i if top[i] == i else find(top[i])
    for i in range(n):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= radius:
                top[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least.setdefault(find(i), []).append(doc)
    return [(doc, f"{p:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i, (doc, p) in enumerate(prints)]


def groups_of(docs):
    """Number of groups: rows with an id and the component of a null id are told apart by fingerprint."""
    prints = {simple_fingerprint(r.text) for r in docs.collect()}
    return len(components([(p, p) for p in prints], 2)) - sum(a != c for a, _, c in components([(p, p) for p in prints], 2))


def test_simhash(spark, odd, empty, documents):
    for docs in (odd, documents):
        prints = [(r.doc_id, simple_fingerprint(r.text)) for r in docs.collect()]
        assert Counter(rows_of(simhash.groups(docs))) == Counter(components(prints, 2))
    assert simhash.groups(empty).count() == 0
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == groups_of(odd)
    groups = {c for *_, c in components([(r.doc_id, simple_fingerprint(r.text)) for r in documents.collect()], 2)}
    assert sorted(r.doc_id for r in simhash.deduplicated(documents).collect()) == sorted(groups)


def test_simhash_chains_and_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = np.random.default_rng(1)
    chain = [0]
    for b in range(1, 60):  # each two bits from the one before
        chain.append(chain[-1] ^ (1 << b % 64) ^ (1 << (b * 7) % 64))
    prints = [(i, p) for i, p in enumerate(chain + rng.integers(0, 2**40, 300).tolist())]
    df = spark.createDataFrame([(i, int(np.uint64(p).view(np.int64))) for i, p in prints], "doc_id long, fp long")
    got = {(r.fp, r.component_id) for r in simhash.group_of(df).collect()}
    assert got == {(int(np.uint64(int(h, 16)).view(np.int64)), c) for _, h, c in components(prints, 2)}


def test_spotsigs(spark, odd, empty):
    got = spotsigs.edited_fingerprints(odd)
    rows = got.collect()
    assert len(rows) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_text = {}
    for r in got.join(odd.select("doc_id", "text"), "doc_id").where("doc_id not in (6)").collect():
        assert by_text.setdefault(r.text or "", r.fingerprint) == r.fingerprint
    assert spotsigs.edited_fingerprints(empty).count() == 0
    ids = [7, 2**40, 5, 3000, -9, 1024]  # next document across slices of ids
    docs = frame(spark, [(i, f"text{i} of the number{i} words", None, None) for i in ids])
    follow = dict(zip(sorted(ids), sorted(ids)[1:] + [-9]))
    for r in spotsigs.edited_fingerprints(docs).collect():
        t, u = f"text{r.doc_id} of the number{r.doc_id} words", f"text{follow[r.doc_id]} of the number{follow[r.doc_id]} words"
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - len(t) // 2] + u[: len(t) // 2]).encode()).hexdigest()


def test_spotsigs_links(spark):
    rng = random.Random(6)
    sets = [sorted(rng.sample(range(1000), 40))]
    for _ in range(40):
        s = set(rng.choice(sets))
        for _ in range(rng.randint(0, 4)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randrange(1000))
        sets.append(sorted(s))
    sets = [list(s) for s in {tuple(s) for s in sets}]
    df = spark.createDataFrame([(f"{i:03d}", s) for i, s in enumerate(sets)], "fp string, sigs array<long>")
    like = lambda a, b: len({*a} & {*b}) / len({*a} | {*b})
    want = {(f"{i:03d}", f"{j:03d}") for i in range(len(sets)) for j in range(i + 1, len(sets)) if like(sets[i], sets[j]) >= 0.8}
    assert {(r.a, r.b) for r in spotsigs.near(df, 0.8).collect()} == want


def test_neighbours(spark):
    rng = np.random.default_rng(8)
    vecs = rng.standard_normal((400, 16))
    vecs[100:200] = vecs[0]  # copies
    rows = [(i, v.tolist()) for i, v in enumerate(vecs)] + [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] + [1.0] * 15), (1150, [None] + [1.0] * 15), (1200, [1.0, 2.0]), (1250, [2.0, 1.0]), (None, vecs[3].tolist()), (5, vecs[5].tolist()), (1300, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, q long")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0, 5, rows_in_shard=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 50, 100, 150, 200, 250, 300, 350, 1200, 1250]
    flat = vecs.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 400, 50):
        near = sorted(got[q])
        assert [n for n, *_ in near] == [1, 2, 3, 4, 5]
        cos = flat @ flat[q] / np.linalg.norm(flat, axis=1) / np.linalg.norm(flat[q])
        best = sorted((-round(c, 9), i) for i, c in enumerate(cos) if i != q)[:5]
        hits += len({i for _, i in best} & {i for _, i, _ in near})
        assert all(abs(cos[i] - s) < 1e-9 for _, i, s in near)
    assert hits >= 36 and [i for _, i, _ in sorted(got[100])] == [0, 101, 102, 103, 104]
    assert [(n, i) for n, i, _ in got[1200]] == [(1, 1250)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_encoding(spark, odd, empty):
    done = encoding.encoded(odd, name="e")
    back = encoding.decoded(done.select("doc_id", F.col("text").alias("was"), "e.ids"))
    assert all(r.text == r.was for r in back.collect())
    assert done.where("text is not null and not e.round_trip").count() == 0
    assert encoding.encode_documents(odd).count() == odd.count() and encoding.encode_documents(empty).count() == 0


def test_personal_data(spark, odd, empty, documents):
    got = {r.doc_id: r for r in pii.find(documents).collect()}
    for r in documents.collect():
        want = patterns(r.text or "")
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in want)
        g = got[r.doc_id]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(k == n for k, *_ in want) for n in range(4))
        assert g.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(joined.split(",")) - {""} <= set(g.spans.split(","))
    assert pii.find(odd).count() == odd.count() and pii.find(empty).count() == 0
    clean = pii.redacted(odd)
    assert clean.columns == odd.columns and Counter(map(str, rows_of(clean))) == Counter(map(str, rows_of(odd)))


def test_pipeline(spark, documents):
    """Each stage against brute force on what the one before it kept."""
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_dedup", "pii", "mixing", "sentencepiece"] and P.ORACLE_SQL is None
    key = lambda r: (r.doc_id, r.text)
    kept = P.language(spark, documents, SF0001)
    assert kept.columns == documents.columns
    kept = kept.collect()
    letters = {key(r) for r in documents.collect() if any(unicodedata.category(c)[0] == "L" for c in r.text or "")}
    assert {key(r) for r in kept} == letters

    docs = spark.createDataFrame(kept, documents.schema)
    one = P.near_copies(spark, docs, SF0001)
    assert one.columns == documents.columns
    one = one.collect()
    groups = {c for *_, c in components([(r.doc_id, simple_fingerprint(r.text)) for r in kept], 2)}
    assert sorted(r.doc_id for r in one) == sorted(groups)

    docs = spark.createDataFrame(one, documents.schema)
    clean = P.personal_data(spark, docs, SF0001)
    assert clean.columns == documents.columns
    clean = {r.doc_id: r for r in clean.collect()}
    field = pii.train(docs)
    for r in one:
        spans = field.spans(r.text, patterns(r.text))
        assert clean[r.doc_id].text == pii.redact(r.text, spans) and not patterns(clean[r.doc_id].text)
        assert spans or clean[r.doc_id].text == r.text

    docs = spark.createDataFrame(list(clean.values()), documents.schema)
    mixed = P.mixture(spark, docs, SF0001)
    assert mixed.columns == documents.columns
    mixed = mixed.collect()
    times = {r.doc_id: r.times for r in mixing.mix_report(docs).collect()}
    assert Counter(r.doc_id for r in mixed) == Counter({i: n for i, n in times.items() if n})

    docs = spark.createDataFrame(mixed, documents.schema)
    rows = P.encode(spark, docs, SF0001).collect()
    fst = encoding.Transducer(encoding.Pieces()).compile()
    assert Counter((r.doc_id, fst.decode(r.ids)) for r in rows) == Counter((r.doc_id, r.text) for r in mixed)


def test_pipeline_run(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF0001).collect()
    assert rows and all(r.round_trip for r in rows)
