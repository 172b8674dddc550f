"""Licence scans by a trained paragraph classifier.

A paragraph is a line; lines over ``LONG`` characters are cut at sentence
ends.  Its features are its distinct words (runs of letters, and 0 for each
number) and word pairs, hashed into ``FEATURES`` buckets.  A multinomial logistic regression, made
sparse by an L1 share in its penalty, gives each licence family and the
class ``unknown`` a probability; a temperature chosen on held-out rows
calibrates it.  A paragraph is reported where a family has a calibrated
probability of ``LEAST`` or more and a notice of that family confirms it:
enough of the notice's word pairs are in the paragraph.

Notices are often wrapped over lines.  So each paragraph is judged alone and
joined with those after it, as far as the longest notice may reach; blank
lines don't end a notice.  Of windows that overlap and are confirmed by the
same word pairs the best is reported: most of a notice, then fewest
paragraphs, then the first.

Texts without a key pair are left out before that: of each notice so many
word pairs are keys that a text without them can't confirm the notice.  One
regular expression made from the keys looks for them.

Most paragraphs can't reach any family: the sum, over their features, of the
most by which a family's weight exceeds that of ``unknown`` is an upper
bound of every family's lead.  Only where the bound leaves room are all
classes scored; the bound changes no result.

Training rows: variants of public notices with words left out, sentences
that speak of licences without giving one, and at most ``NEGATIVES``
paragraphs of the corpus (the first by hash) that no notice matches.

DataFrame functions and Spark's own classifier only; each paragraph is
judged where it is read, so only the training rows and the confirmed windows
are shuffled.

Defined results: null and empty texts have no paragraphs, so no rows;
repeated rows are reported for each; equal probabilities go to the family
that is first by name; an empty table gives an empty result.  Other columns
are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import written

UNKNOWN = "unknown"
LONG, LEAST, CONFIRMED = 400, 0.5, 0.6
NEGATIVES, VARIANTS, FEATURES = 3000, 16, 1 << 12
NUMBER = r"[0-9]+([.][0-9]+)*"
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)

#: Public notices by family (fixed values).
NOTICES = (
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl", "SPDX-License-Identifier: AGPL-3.0"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache", "Released under the Apache License 2.0."),
    ("apache", "Licensed under Apache-2.0."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("bsd", "Licensed under the BSD license."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "Creative Commons Attribution 3.0 Unported"),
    ("cc-by", "SPDX-License-Identifier: CC-BY-4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 3.0 Unported"),
    ("cc-by-nc", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 3.0 Unported"),
    ("cc-by-sa", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc0", "Released under CC0 1.0 Universal Public Domain Dedication."),
    ("cc0", "Dedicated to the public domain under CC0 1.0."),
    ("cc0", "SPDX-License-Identifier: CC0-1.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "Licensed under the GNU GPL version 2 or later."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "Licensed under the ISC license."),
    ("isc", "SPDX-License-Identifier: ISC"),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("lgpl", "SPDX-License-Identifier: LGPL-2.1"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Licensed under the MIT license."),
    ("mit", "MIT licensed."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl", "Licensed under the Mozilla Public License, version 2.0."),
    ("mpl", "SPDX-License-Identifier: MPL-2.0"),
    ("proprietary", "Copyright 2020. All rights reserved."),
    ("proprietary", "Copyright (c) 2020. All rights reserved."),
    ("proprietary", "No part of this publication may be reproduced without the prior written permission of the publisher."),
)
#: Sentences that speak of licences, rights or terms without giving any.
PLAIN = (
    "The driver showed a license to the officer.", "The public was free to use the general work of the library.", "A new version of the software was released under pressure.",
    "The terms of the treaty were under discussion.", "He wrote a license plate number down.", "All rights of way were reserved for the parade.", "The public domain of the town is under water.",
    "It was licensed to sell wine.", "The work was done by the author in version 3 of the plan.", "A copy of the file is in the general store.", "The foundation published the source of the river.", "Released in the fall, the film was free of charge.",
    "SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: Unlicense", "Licensed under its own terms.", "Permission to use the hall was granted without fee.",
)


def paragraphs(text: Column) -> Column:
    long = F.split(F.lit(""), "x")  # only for the type
    lines = F.split(text, "\n")
    return F.flatten(F.transform(lines, lambda x: F.when(F.length(x) > LONG, F.split(x, r"(?<=[.!?;])\s+")).when(x != "", F.array(x)).otherwise(F.slice(long, 1, 0))))


def let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def words(paragraph: Column) -> Column:
    """Lower-cased runs of letters, and 0 for each number."""
    return F.filter(F.split(F.regexp_replace(F.lower(paragraph), NUMBER, " 0 "), r"[^\p{L}0]+"), lambda w: w != "")


def features(w: Column, of=lambda bucket: bucket) -> Column:
    """``of`` the buckets (from 1) of words and word pairs."""
    bucket = lambda *x: (F.pmod(F.xxhash64(*x), F.lit(FEATURES)) + 1).cast("int")
    ones = F.transform(w, lambda x: of(bucket(x)))
    twos = F.transform(F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda x, i: of(bucket(F.get(w, i), x)))
    return F.concat(ones, twos)


def pairs(paragraph: Column) -> Column:
    """Distinct word pairs of a paragraph as text."""
    return let(words(paragraph), lambda w: F.array_distinct(F.transform(F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda x, i: F.concat_ws(" ", F.get(w, i), x))))


def rows_of(spark: SparkSession, names: str, rows) -> DataFrame:
    """A small table of literals."""
    cols = names.split()
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(cols, r)]) for r in rows])))


def notice_words(text: str) -> list[str]:
    """Words of a notice, as ``words`` makes them."""
    return re.findall(r"[^\W\d_]+|0", re.sub(NUMBER, " 0 ", text.lower()))


def notice_pairs(text: str) -> list[str]:
    """Distinct word pairs of a notice, as ``pairs`` makes them."""
    w = notice_words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def key_pairs(text: str) -> list[str]:
    """Word pairs of a notice (the longest, they are rare) of which any
    confirmed paragraph has one: it lacks fewer than these."""
    have = sorted(notice_pairs(text), key=lambda p: (-len(p), p))
    needed = next(n for n in range(len(have) + 1) if n / len(have) >= CONFIRMED)
    return have[: len(have) - needed + 1]


def key_pattern() -> str:
    """Regular expression that finds a key pair of any notice in a lower-cased
    text behind one blank, with words and numbers cut as ``words`` cuts them."""
    gap, after = r"[^\p{L}0-9]", {}
    for a, b in sorted({tuple(p.split(" ")) for _, t in NOTICES for p in key_pairs(t)}):
        after.setdefault(a, []).append(gap + ("*+[0-9]" if b == "0" else ("*+" if a == "0" else "++") + b + r"(?!\p{L})"))
    first = {}  # by first letter, so that few branches are tried at a place
    for a, rest in after.items():
        first.setdefault(a[0], []).append(f"{a[1:]}(?:{'|'.join(rest)})")
    number = "|".join(x for x in first.pop("0", []))
    letters = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in first.items())
    return rf"[^\p{{L}}](?:{letters}{'|(?<=[0-9])' + number if number else ''})"


def may_confirm(text: Column) -> Column:
    """Whether a text has a key pair of any notice."""
    return F.concat(F.lit(" "), F.lower(text)).rlike(key_pattern())


def windows(text: Column) -> Column:
    """Each paragraph alone and joined with those after it: paragraph, last,
    line.  Between its first and last paragraph a window has no more words
    than the longest notice has between its first and last word.  Only windows
    with a paragraph that has a key pair, alone or with the next, are made."""
    longest = max(len(notice_words(t)) for _, t in NOTICES)
    lines = F.filter(F.transform(paragraphs(text), lambda x, i: F.struct(i.alias("paragraph"), x.alias("line"), F.size(words(x)).alias("n"))), lambda x: x["n"] > 0)

    def joined(ls: Column, i: Column, n: Column) -> Column:
        line = F.array_join(F.transform(F.slice(ls, i + 1, n), lambda x: x["line"]), " ")
        return F.struct(F.get(ls, i)["paragraph"].alias("paragraph"), F.get(ls, i + n - 1)["paragraph"].alias("last"), line.alias("line"))

    def sizes(ls: Column, near: Column, i: Column) -> Column:
        between = lambda n: F.aggregate(F.slice(ls, i + 2, F.greatest(n - 2, F.lit(0))), F.lit(0), lambda a, x: a + x["n"])
        most = F.when(F.exists(F.slice(near, i + 1, longest), lambda x: x), F.least(F.size(ls) - i, F.lit(longest))).otherwise(F.lit(0))
        return F.filter(F.filter(F.sequence(F.lit(0), most), lambda n: (n > 0) & F.exists(F.slice(near, i + 1, n), lambda x: x)), lambda n: between(n) <= longest - 2)

    near = lambda ls: F.transform(ls, lambda x, i: may_confirm(F.concat_ws(" ", x["line"], F.get(ls, i + 1)["line"])))
    return let(lines, lambda ls: let(near(ls), lambda n: F.flatten(F.transform(ls, lambda x, i: F.transform(sizes(ls, n, i), lambda k: joined(ls, i, k))))))


def evidence(found: Column, family: Column) -> Column:
    """Of the notice of ``family`` that ``found`` has the largest share of:
    the share as overlap, the number of its word pairs, and those found."""
    notices = F.array(*[F.struct(F.lit(f).alias("family"), F.array(*map(F.lit, notice_pairs(t))).alias("pairs")) for f, t in NOTICES])
    had = lambda n, h: F.struct((F.size(h) / F.size(n["pairs"])).alias("overlap"), F.size(n["pairs"]).alias("size"), h.alias("had"))
    return F.array_max(F.transform(F.filter(notices, lambda n: n["family"] == family), lambda n: let(F.array_intersect(found, n["pairs"]), lambda h: had(n, h))))


def best_windows(found: Column) -> Column:
    """Windows without those that overlap a better one whose word pairs leave
    them too few of their own."""
    def beaten(x: Column, y: Column) -> Column:
        return (x["paragraph"] <= y["last"]) & (y["paragraph"] <= x["last"]) & (F.size(F.array_except(x["had"], y["had"])) / x["size"] < CONFIRMED)

    add = lambda kept, x: F.when(F.exists(kept, lambda y: beaten(x, y)), kept).otherwise(F.concat(kept, F.array(x)))
    return let(F.sort_array(found), lambda f: F.aggregate(f, F.slice(f, 1, 0), add))


def overlap(found: Column, family: Column) -> Column:
    """Largest share of a notice's word pairs that ``found`` has, over the
    notices of ``family``."""
    def share(text: str) -> Column:
        have = notice_pairs(text)
        return F.size(F.array_intersect(found, F.array(*map(F.lit, have)))) / len(have)

    best = F.lit(0.0)
    for name in sorted({f for f, _ in NOTICES}):
        best = F.when(family == name, F.greatest(*[share(t) for f, t in NOTICES if f == name], F.lit(0.0))).otherwise(best)
    return best


class Classifier:
    """Weights of the buckets that any class uses, and how to apply them."""

    def __init__(self, model, families: list[str], temperature: float):
        weights, self.start = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        used = np.flatnonzero(np.abs(weights).max(0) > 0)
        self.families, self.temperature = families, temperature
        self.number = np.zeros(FEATURES, int)  # of each bucket in use, from 1
        self.number[used] = np.arange(1, len(used) + 1)
        self.weights = weights[:, used].T
        self.unknown = families.index(UNKNOWN)

    def active(self, paragraph: Column) -> Column:
        """Numbers of a paragraph's buckets that are in use."""
        table = F.array(*map(F.lit, self.number.tolist()))
        return F.array_distinct(F.filter(let(words(paragraph), lambda w: features(w, lambda b: F.element_at(table, b))), lambda n: n > 0))

    def scored(self, df: DataFrame, paragraph: str) -> DataFrame:
        """Rows of ``df`` whose paragraph has a family, with family and
        probability."""
        lead = (self.weights - self.weights[:, [self.unknown]]).max(1)
        most = F.array(F.lit(0.0), *map(F.lit, lead.tolist()))
        least = self.temperature * math.log(LEAST / (1 - LEAST)) - (self.start - self.start[self.unknown]).max() - 1e-9
        df = df.withColumn("active", self.active(F.col(paragraph)))
        df = df.where(F.aggregate("active", F.lit(0.0), lambda a, n: a + F.get(most, n)) >= least)
        table = F.array(*[F.array(*map(F.lit, w)) for w in self.weights.tolist()])
        raw = F.aggregate("active", F.array(*map(F.lit, self.start.tolist())), lambda a, n: F.zip_with(a, F.element_at(table, n), lambda x, y: x + y))
        names = F.array(*map(F.lit, self.families))
        best = let(raw, lambda r: let(F.array_max(r), lambda top: F.struct(F.element_at(names, F.array_position(r, top).cast("int")).alias("family"), probability(r, top, self.temperature).alias("probability"))))
        df = df.withColumn("best", best)
        return df.select(*df.drop("active", "best").columns, "best.*").where((F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST))


def probability(raw: Column, of: Column, temperature: float) -> Column:
    """Softmax of one class's margin at a temperature."""
    return 1 / F.aggregate(raw, F.lit(0.0), lambda a, x: a + F.exp((x - of) / temperature))


def train(docs: DataFrame, negatives: int = NEGATIVES) -> Classifier:
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    families = sorted({f for f, _ in NOTICES} | {UNKNOWN})
    given = rows_of(spark, "family paragraph", list(NOTICES) + [(UNKNOWN, t) for t in PLAIN])
    # variants leave out about an eighth of the words; the first is whole
    w = F.split("paragraph", " ")
    left = F.filter(w, lambda x, i: (F.col("variant") == 0) | (F.pmod(F.xxhash64(F.col("variant"), i), F.lit(8)) != 0))
    given = given.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1)))).select("family", F.array_join(left, " ").alias("paragraph"), "variant")

    texts = docs.where("text is not null").select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(negatives // 4)
    lines = docs.join(texts.select(F.col("doc_id").alias("i")).distinct(), F.col("doc_id").eqNullSafe(F.col("i")), "left_semi").select(F.explode(paragraphs(F.col("text"))).alias("paragraph")).distinct()
    lines = lines.withColumn("h", F.xxhash64("paragraph")).orderBy("h", "paragraph").limit(negatives)
    lines = written(lines.withColumn("pairs", pairs(F.col("paragraph"))), "licence-negatives")
    matched = F.greatest(*[overlap(F.col("pairs"), F.lit(f)) for f in families if f != UNKNOWN])
    lines = lines.where(matched < CONFIRMED).select(F.lit(UNKNOWN).alias("family"), "paragraph", F.pmod("h", F.lit(VARIANTS)).cast("int").alias("variant"))

    rows = given.union(lines)
    buckets = CountVectorizerModel.from_vocabulary([str(b + 1) for b in range(FEATURES)], inputCol="buckets", outputCol="features", binary=True)
    rows = buckets.transform(rows.withColumn("buckets", let(words(F.col("paragraph")), lambda w: features(w)).cast("array<string>")))
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    rows = written(rows.select(label.alias("label"), "features", "variant"), "licence-training").coalesce(2)
    fit = LogisticRegression(family="multinomial", maxIter=25, regParam=0.002, elasticNetParam=0.5, probabilityCol="probabilities")
    held = F.col("variant") % 4 == 3
    tested = fit.fit(rows.where(~held)).transform(rows.where(held)).select((F.col("label") + 1).cast("int").alias("k"), vector_to_array("rawPrediction").alias("raw"))
    losses = tested.agg(*[F.avg(-F.log(probability(F.col("raw"), F.element_at("raw", F.col("k")), t))).alias(str(n)) for n, t in enumerate(TEMPERATURES)]).first()
    temperature = min(zip(losses, TEMPERATURES), key=lambda x: x[0])[1]
    return Classifier(fit.fit(rows), families, temperature)


def scan(docs: DataFrame) -> DataFrame:
    """A row for each paragraph where a licence is given or begins: doc_id,
    paragraph (its place among the text's paragraphs, from 0), family,
    probability, overlap."""
    model = train(docs)
    rows = docs.select("doc_id", "text").where(may_confirm(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("doc_id", "row", F.inline(windows(F.col("text"))))
    found = model.scored(rows.where(may_confirm(F.col("line"))), "line").withColumn("notice", evidence(pairs(F.col("line")), F.col("family"))).where(F.col("notice.overlap") >= CONFIRMED)
    rank = [(-F.col("notice.overlap")).alias("rank"), (F.col("last") - F.col("paragraph")).alias("more")]
    found = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct(*rank, "paragraph", "last", "family", "probability", "notice.*")).alias("found"))
    found = found.select("doc_id", F.inline(best_windows(F.col("found"))))
    return found.select("doc_id", "paragraph", "family", F.round("probability", 3).alias("probability"), F.round("overlap", 3).alias("overlap"))
