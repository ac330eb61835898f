"""Licence scan: a paragraph classifier over sparse word n-grams, confirmed by template comparison.

The classifier is a multinomial logistic regression over the presence of word 1- to 3-grams of
known licence notices, with an explicit class ``unknown``. It is trained on parts and variations
of the notices; fragments too small to tell, look-alikes and a bounded sample of the corpus's own
paragraphs are ``unknown``. A temperature fitted on held-out variations calibrates the
probabilities. A prediction counts if its probability reaches ``threshold`` and the paragraph
contains at least ``containment`` of the n-grams of one notice of that family.

A confirmed paragraph therefore holds most n-grams of a notice, and so at least one of the anchor
words that :func:`anchors` derives from that bound. A paragraph is a line, or neighbouring lines
of a block as far as a notice may be wrapped over them (:func:`windows`). Paragraphs without an
anchor word cannot be confirmed and are not scored; this loses nothing.

DataFrame operations only. Weights and notices are tables of a fixed size.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import written

THRESHOLD, CONTAINMENT, SAMPLE = 0.5, 0.6, 1000
UNKNOWN = "unknown"

# Licence notices by family (fixed values).
NOTICES = {
    "AGPL": ["This program is licensed under the GNU Affero General Public License, version 3.",
             "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "BSD": ["Released under the BSD 3-Clause License.", "Licensed under the BSD License.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0": ["Released under the CC0 1.0 Universal public domain dedication.",
            "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 3.",
             "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# Texts that speak of licences without granting one; function words, with German "mit" (fixed values).
LOOK_ALIKES = ["You need a licence to drive this car.", "The license plate was stolen.", "He asked for permission to leave the room.",
               "The right to vote is reserved for citizens.", "She works at the public library.", "All rights are equal.", "Apache is a people of the southwest.",
               "The warranty covers any kind of damage.", "Copyright law is hard to understand.", "The licence agreement was signed under pressure.",
               "A general told the public.", "The terms of the contract are clear.", "Free software is popular.", "He was released under the bridge."]
STOP_WORDS = "a all an and any are as at be by can either for from has in is it may mit no not of on or part provided that the this to under with without work you".split()


# ---------------------------------------------------------------- text

def plain_grams(text: str) -> list[str]:
    """The distinct 1- to 3-grams of a notice (plain form of :func:`grams`)."""
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return sorted({" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)})


def grams(text: Column) -> Column:
    """Distinct word 1- to 3-grams of a text: ASCII letters and digits, lower-cased."""
    w = F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), lambda x: x != "")
    two = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    three = F.zip_with(two, F.slice(w, 3, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(F.concat(w, two, three), lambda x: x.isNotNull()))


def notices() -> list[tuple[int, str, str, list[str]]]:
    """(number, family, text, n-grams) of every notice."""
    flat = [(f, t) for f, ts in NOTICES.items() for t in ts]
    return [(k, f, t, plain_grams(t)) for k, (f, t) in enumerate(flat)]


def anchors(containment: float = CONTAINMENT) -> list[str]:
    """Words such that ``containment`` of any notice's n-grams cannot be met without one of them."""
    open_ = {k: [set(g.split()) for g in gs] for k, _, _, gs in notices()}
    room = {k: int((1 - containment) * len(gs) + 1e-9) for k, gs in open_.items()}
    chosen: list[str] = []
    while True:
        # without anchors a paragraph can still hold len(free) n-grams of a notice: too few once free is short enough
        short = {k: gs for k, gs in open_.items() if len(gs) >= containment * (len(gs) + _held(k, chosen)) - 1e-9}
        if not short:
            return sorted(chosen)
        gain = Counter(w for gs in short.values() for g in gs for w in g if w not in STOP_WORDS and not w.isdigit())
        if not gain:
            gain = Counter(w for gs in short.values() for g in gs for w in g)
        best = min(gain, key=lambda w: (-gain[w], w))
        chosen.append(best)
        open_ = {k: [g for g in gs if best not in g] for k, gs in open_.items()}


def _held(k: int, chosen: list[str]) -> int:
    """N-grams of notice ``k`` that hold a chosen word."""
    return sum(bool(set(g.split()) & set(chosen)) for g in notices()[k][3])


def gate(containment: float = CONTAINMENT) -> str:
    """Regular expression that finds an anchor word."""
    return r"(?i)(?<![A-Za-z0-9])(?:" + "|".join(anchors(containment)) + r")(?![A-Za-z0-9])"


# ---------------------------------------------------------------- training

def variations() -> list[tuple[str, str, bool]]:
    """(text, class, held out): parts of the notices, by the share of their words that they keep."""
    out = []
    for k, family, text, gs in notices():
        words = text.split()
        n = len(words)
        for size in range(1, n + 1):
            for start in range(0, n - size + 1, 1 if n < 12 else max(1, size // 3)):
                part = " ".join(words[start:start + size])
                share = len(set(plain_grams(part)) & set(gs)) / len(gs)
                if share >= 0.75 or share <= 0.35:
                    out.append((part, family if share >= 0.75 else UNKNOWN, (start + size + k) % 4 == 0 and size < n))
        for name in ("", "(c) 2019 Example Ltd. ", "Some words stand before. "):
            for end in ("", " See the file for details.", " More words follow here, and then more."):
                out.append((name + text + end, family, False))
        for i in range(0, n, 4):  # one word lost
            part = " ".join(words[:i] + words[i + 1:])
            if n > 8:
                out.append((part, family, i % 8 == 0))
    out += [(t, UNKNOWN, i % 4 == 0) for i, t in enumerate(LOOK_ALIKES)]
    families: dict[str, set] = {}
    for t, c, _ in out:
        families.setdefault(" ".join(plain_grams(t)), set()).add(c)
    # a part that several families share tells none of them
    clear = lambda t: len(families[" ".join(plain_grams(t))] - {UNKNOWN}) <= 1
    return [(t, c if clear(t) else UNKNOWN, h) for t, c, h in out]


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


class Classifier:
    """Weight table ``(gram, w)``, class names, intercepts and temperature."""

    def __init__(self, weights: DataFrame, classes: list[str], bias: list[float], temperature: float):
        self.weights, self.classes, self.bias, self.temperature = weights, classes, bias, temperature


def _logits(paragraphs: DataFrame, keys: list[str], weights: DataFrame, bias: list[float]) -> DataFrame:
    """Adds ``z``, the classes' logits, to ``paragraphs(keys..., gram array g)``: n-grams meet their weights."""
    n = len(bias)
    met = paragraphs.select(*keys, F.explode("g").alias("gram")).join(F.broadcast(weights), "gram")
    sums = met.groupBy(*keys).agg(*[F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(n)])
    return sums.select(*keys, F.array(*[F.col(f"s{i}") + F.lit(bias[i]) for i in range(n)]).alias("z"))


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Classifier:
    """Fits the classifier on the notices and at most ``sample`` paragraphs of the corpus (those of the documents with the least text hashes)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    spark = docs.sparkSession
    vocabulary = sorted({g for *_, gs in notices() for g in gs})
    classes = [UNKNOWN, *NOTICES]
    texts = docs.select(F.col(text_col).cast("string").alias("t")).where(~F.col("t").rlike(gate()))
    own = (texts.select(F.substring_index("t", "\n", 1).alias("text"), F.xxhash64("t").alias("h")).orderBy("h", "text").limit(sample)
           .select("text", F.lit(0.0).alias("label"), (F.pmod("h", F.lit(4)) == 0).alias("held")))
    made = _values(spark, [(t, float(classes.index(c)), h) for t, c, h in variations()], "text string, label double, held boolean")
    rows = written(made.union(own).select(F.monotonically_increasing_id().alias("k"), "label", "held", grams(F.col("text")).alias("g")), "licence-training")
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="g", outputCol="features", minTF=1.0)
    fitted = LogisticRegression(family="multinomial", regParam=2e-4, maxIter=60).fit(vectors.transform(rows.where("not held")))
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray().tolist()
    weights = written(_values(spark, [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(vocabulary)], "gram string, w array<double>").coalesce(1), "licence-weights")
    # temperature: least log-loss on the held-out rows; rows without any known n-gram keep the intercepts
    held = rows.where("held")
    z = held.select("k", "label").join(_logits(held, ["k"], weights, bias), "k", "left").select(
        "label", F.coalesce("z", F.array(*map(F.lit, bias))).alias("z"))
    grid = [0.25 * 1.15 ** i for i in range(24)]
    loss = lambda t: F.avg(F.log(_sum(F.transform("z", lambda x: F.exp((x - F.array_max("z")) / t))))
                           - (F.element_at("z", F.col("label").cast("int") + 1) - F.array_max("z")) / t)
    losses = z.agg(*[loss(t).alias(f"l{i}") for i, t in enumerate(grid)]).first()
    best = min(range(len(grid)), key=lambda i: losses[i] if losses[i] is not None else 0.0)
    return Classifier(weights, classes, bias, grid[best])


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


# ---------------------------------------------------------------- scan

#: What stands between blocks of numbered lines: a line without a letter or digit.
BLANK = r"\n\d+\t[^A-Za-z0-9\n]*(?=\n|\z)"


def candidates(docs: DataFrame, id_col: str, text_col: str, containment: float) -> DataFrame:
    """Per row: its id, a row number, its non-blank paragraphs counted, and the blocks of numbered lines that hold an anchor word."""
    text, pattern = F.coalesce(F.col(text_col).cast("string"), F.lit("")), gate(containment)
    numbered = F.array_join(F.transform(F.split(text, "\n"), lambda p, i: F.concat(i.cast("string"), F.lit("\t"), p)), "\n")
    return written(docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
        F.regexp_count(text, F.lit(r"\S[^\n]*")).cast("long").alias("n_paragraphs"),
        F.when(text.rlike(pattern), F.filter(F.split(numbered, BLANK), lambda x: x.rlike(pattern))).alias("blocks")), "licence-candidates")


def windows(blocks: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``blocks(row, lines)`` -> ``row, paragraph, last, text``: neighbouring lines with an anchor word that a wrapped notice may take.

    A window goes on until the lines after its first are as long as the longest notice; of its
    first line the end and of the others the beginning counts, twice that length.
    """
    longest = max(len(" ".join("".join(c if c.isascii() and c.isalnum() else " " for c in t.lower()).split())) for _, _, t, _ in notices())
    most = max(len(t.split()) for _, _, t, _ in notices()) + 1
    short = blocks.select("row", F.transform("lines", lambda x: F.struct(
        x["paragraph"].alias("paragraph"), F.trim(F.regexp_replace(F.lower(x["text"]), "[^a-z0-9]+", " ")).alias("text"))).alias("l")).where(F.size("l") > 1)
    starts = short.select("row", F.posexplode("l").alias("i", "x"), "l").select(
        "row", "x.paragraph", F.substring(F.col("x.text"), F.greatest(F.length("x.text") - 2 * longest, F.lit(0)) + 1, F.lit(2 * longest)).alias("t"),
        F.slice("l", F.col("i") + 2, F.lit(most)).alias("next"))
    empty = F.filter(F.array(F.struct(F.lit(0).cast("long").alias("last"), F.lit("").alias("text"))), lambda x: F.lit(False))

    def grown(acc: Column, y: Column) -> Column:
        t = F.concat(acc["t"], F.lit(" "), F.substring(y["text"], 1, 2 * longest))
        return F.when(acc["n"] >= longest, acc).otherwise(F.struct(
            t.alias("t"), (acc["n"] + F.length(y["text"])).alias("n"), F.concat(acc["w"], F.array(F.struct(y["paragraph"].alias("last"), t.alias("text")))).alias("w")))

    grow = F.aggregate("next", F.struct(F.col("t").alias("t"), F.lit(0).alias("n"), empty.alias("w")), grown, lambda acc: acc["w"])
    return starts.select("row", "paragraph", F.explode(grow).alias("w")).select("row", "paragraph", "w.last", "w.text").where(F.col("text").rlike(gate(containment)))


def wrapped(found: DataFrame, lines: DataFrame) -> DataFrame:
    """The windows ``found`` that stand for a notice each: without a line of the family that is confirmed alone, and without overlaps.

    Of overlapping windows the one that contains most of its notice stays, then the shortest, then the first.
    """
    each = found.select("row", "family", "last", F.explode(F.sequence("paragraph", "last")).alias("paragraph"), F.col("paragraph").alias("first"))
    told = each.join(lines.select("row", "paragraph", "family"), ["row", "paragraph", "family"], "left_semi").select("row", F.col("first").alias("paragraph"), "last").distinct()
    order = F.struct((-F.col("contained")).alias("c"), (F.col("last") - F.col("paragraph")).alias("n"), "paragraph", "last", "family", "probability")
    rows = found.join(told, ["row", "paragraph", "last"], "left_anti").groupBy("row").agg(F.array_sort(F.collect_list(order)).alias("w"))
    apart = lambda x, y: (x["last"] < y["paragraph"]) | (y["last"] < x["paragraph"])
    kept = F.aggregate("w", F.filter("w", lambda x: F.lit(False)),
                       lambda acc, x: F.when(F.forall(acc, lambda y: apart(x, y)), F.concat(acc, F.array(x))).otherwise(acc))
    return rows.select("row", F.explode(kept).alias("x")).select("row", "x.paragraph", "x.family", "x.probability")


def classify(paragraphs: DataFrame, keys: list[str], model: Classifier, containment: float = CONTAINMENT, threshold: float = THRESHOLD) -> DataFrame:
    """``paragraphs(keys..., text)`` -> ``keys..., family, probability, contained`` of the confirmed ones."""
    spark = paragraphs.sparkSession
    known = paragraphs.select(*keys, grams(F.col("text")).alias("g"))
    z = _logits(known, keys, model.weights, model.bias)
    e = z.select(*keys, F.transform("z", lambda x: F.exp((x - F.array_max("z")) / model.temperature)).alias("e"))
    p = e.select(*keys, F.array_position("e", F.array_max("e")).cast("int").alias("c"), (F.array_max("e") / _sum(F.col("e"))).alias("probability"))
    p = p.select(*keys, F.element_at(F.array(*map(F.lit, model.classes)), F.col("c")).alias("family"), "probability")
    parts = _values(spark, [(g, k, f, len(gs)) for k, f, _, gs in notices() for g in gs], "gram string, notice int, family string, size int")
    met = known.select(*keys, F.explode("g").alias("gram")).join(F.broadcast(parts), "gram")
    shares = met.groupBy(*keys, "notice", "family").agg((F.count("*") / F.max("size")).alias("share"))
    shares = shares.groupBy(*keys, "family").agg(F.max("share").alias("contained"))
    return p.where((F.col("family") != UNKNOWN) & (F.col("probability") >= threshold)).join(
        shares.where(F.col("contained") >= containment), [*keys, "family"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, containment: float = CONTAINMENT,
         sample: int = SAMPLE) -> DataFrame:
    """Licences of every row: ``<id_col>, n_paragraphs, n_licensed, families, family, probability, paragraph``.

    ``families``: distinct confirmed families, sorted, comma-joined; ``family``, ``probability``
    and ``paragraph`` (number of the line, from 0; of a wrapped notice its first): the likeliest,
    then the first; null without one. ``n_licensed`` counts confirmed lines and wrapped notices. Null and empty texts have no paragraph. Every row gives one result row, repeated rows
    too; an empty table gives none; other columns are ignored.
    """
    model = train(docs, text_col, sample)
    held = candidates(docs, id_col, text_col, containment)
    parts = F.transform(F.filter(F.split("block", "\n"), lambda x: x != ""), lambda x: F.struct(
        F.substring_index(x, "\t", 1).cast("long").alias("paragraph"), F.substring(x, F.instr(x, "\t") + 1, F.length(x)).alias("text")))
    blocks = held.where("blocks is not null").select("row", F.explode("blocks").alias("block")).select("row", parts.alias("lines"))
    lines = blocks.select("row", F.explode("lines").alias("x")).select("row", "x.paragraph", "x.text").where(F.col("text").rlike(gate(containment)))
    alone = written(classify(lines, ["row", "paragraph"], model, containment, threshold).select("row", "paragraph", "family", "probability"), "licence-lines")
    several = classify(written(windows(blocks, containment), "licence-windows"), ["row", "paragraph", "last"], model, containment, threshold)
    several = wrapped(written(several.select("row", "paragraph", "last", "family", "probability", "contained"), "licence-wrapped"), alone)
    found = alone.unionByName(several)
    best = F.min(F.struct((-F.col("probability")).alias("p"), "paragraph", "family")).alias("best")
    rows = found.groupBy("row").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("family")).alias("f"), best)
    return held.drop("blocks").join(rows, "row", "left").select(
        F.col("id").alias(id_col), "n_paragraphs", F.coalesce("n", F.lit(0).cast("long")).alias("n_licensed"),
        F.coalesce(F.array_join("f", ","), F.lit("")).alias("families"), F.col("best.family").alias("family"),
        (-F.col("best.p")).alias("probability"), F.col("best.paragraph").alias("paragraph"))
