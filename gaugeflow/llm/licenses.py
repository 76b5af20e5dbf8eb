"""Licence notices in texts, by a trained paragraph classifier that template comparison confirms.

A multinomial logistic regression on word unigrams and bigrams, kept sparse by an L1 penalty, tells
licence families, other licence talk and ordinary text apart. It is trained on perturbed copies of
the notices below and on a bounded sample of the corpus's own paragraphs. Its weights, a bounded
table, become literals of the plan, and every line is scored where it is read: nothing is shuffled,
and the whole path is built of DataFrame functions.

A paragraph is a line of a text, as texts here keep one paragraph on each line.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import common

# Usual notices of each family, as their stewards publish them.
NOTICES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License v2.0",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work under CC0 1.0 Universal.",
        "Released into the public domain under CC0 1.0.",
    ),
}
# Talk of licences that names no family above.
OTHER_NOTICES = (
    "All rights reserved.",
    "Copyright the authors. All rights reserved.",
    "Licensed under the terms of the commercial license agreement.",
    "Released under a proprietary license.",
    "This work is licensed under the terms in the accompanying license file.",
    "Use of this material is subject to the license agreement.",
    "You may not redistribute this document without permission.",
    "Licensed under the Example Community License, version 1.0.",
)
UNKNOWN, NONE = "unknown", "none"


@dataclass(frozen=True)
class Training:
    """Bounds of the training set and of the model; the rest of the corpus is only scored."""

    copies: int = 40
    paragraphs: int = 4000
    vocabulary: int = 4_000
    penalty: float = 0.002
    #: Share of a template's words that a paragraph must have for it to be confirmed.
    confirmed: float = 0.75
    #: And for it to count as licence talk at all, where a family is predicted.
    suspected: float = 0.5
    #: Wrong family predictions allowed among held-out paragraphs when the threshold is chosen.
    wrong: float = 0.005


def tokens(text: Column) -> Column:
    """Lower-case words of letters, digits and inner dots, hyphens and slashes as separators."""
    parts = F.split(F.lower(text), "[^a-z0-9.]+|[.]+(?![a-z0-9])")
    return F.filter(parts, lambda word: word != "")


def grams(words: str) -> Column:
    """Distinct words and pairs of neighbours."""
    pairs = F.transform(
        F.slice(words, 2, F.greatest(F.size(words), F.lit(1))),
        lambda word, i: F.concat_ws(" ", F.get(words, i), word),
    )
    return F.array_distinct(F.concat(F.col(words), pairs))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (from 0), words of each line with a word. docs: doc_id, text."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return lines.select("doc_id", "paragraph", tokens(F.col("line")).alias("words")).filter(
        F.size("words") > 0
    )


def templates(spark: SparkSession) -> DataFrame:
    """family, template, words of the fixed notices."""
    rows = [(f, n) for f, notices in NOTICES.items() for n in notices]
    rows += [(UNKNOWN, notice) for notice in OTHER_NOTICES]
    listed = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(n).alias("notice")) for f, n in rows))
    found = spark.range(1).select(F.posexplode(listed).alias("template", "t"))
    return found.select("t.family", "template", tokens(F.col("t.notice")).alias("words"))


def training_rows(docs: DataFrame, settings: Training) -> DataFrame:
    """family, words, held_out: perturbed notices, and paragraphs of the corpus as no licence.

    Copy v of a notice loses each word with probability v / (2 * copies), by hash, and every other
    one stands between words of an ordinary paragraph.
    """
    known = templates(docs.sparkSession)
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    hashed = lines.filter(F.col("line").rlike("[A-Za-z0-9]")).withColumn(
        "h", F.xxhash64("doc_id", "paragraph")
    )
    # So few of the smallest hashes are wanted that most lines need not be ordered. Texts have a
    # line each at least, so this leaves about as many as are wanted, or more.
    share = max(docs.count() // settings.paragraphs, 1)
    hashed = hashed.filter(F.pmod("h", F.lit(share)) == 0)
    # Words are cut after the sample is drawn.
    sampled = hashed.orderBy("h", "doc_id", "paragraph").limit(settings.paragraphs)
    sampled = sampled.select(tokens(F.col("line")).alias("words"), "h")
    listed = known.agg(F.collect_list(F.struct("family", "words")).alias("all"))
    shares = F.transform(
        "all", lambda t: F.size(F.array_intersect(t["words"], F.col("words"))) / F.size(t["words"])
    )
    # One row of templates beside each of the sampled paragraphs.
    plain = (
        sampled.join(F.broadcast(listed), F.lit(True))
        .filter(F.array_max(shares) < 0.6)
        .select(F.lit(NONE).alias("family"), F.slice("words", 1, 200).alias("words"), "h")
    )
    copies = known.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(settings.copies - 1))))
    kept = F.filter(
        "words",
        lambda word, i: F.pmod(F.xxhash64(word, i, F.col("v")), F.lit(2 * settings.copies))
        >= F.col("v") * F.lit(0.5),
    )
    around = F.when(F.col("v") % 2 == 1, F.split(F.lit(_FILLER), " "))
    turned = F.slice(around, F.pmod(F.xxhash64("template", "v"), F.lit(20)).cast("int") + 1, 6)
    wrapped = F.concat(F.coalesce(turned, F.array().cast("array<string>")), kept)
    notices = copies.select("family", wrapped.alias("words"), F.xxhash64("template", "v").alias("h"))
    # The ordinary words alone are no licence either.
    fillers = copies.filter("v % 2 = 1").select(
        F.lit(NONE).alias("family"), turned.alias("words"), F.xxhash64("v", "template").alias("h")
    )
    rows = notices.unionByName(plain).unionByName(fillers).filter(F.size("words") > 0)
    return rows.select("family", grams("words").alias("grams"), (F.pmod("h", F.lit(5)) == 0).alias("held_out"))


# Ordinary words that may stand before a notice on its line.
_FILLER = (
    "the text of this page was first written for a small group of readers and then made "
    "available to everyone who asked about it by mail"
)


@dataclass(frozen=True)
class Classifier:
    """Weights of each gram over ordinary text, per class, and the accepted probability.

    The grams are those that the penalty left, a bounded number; they become literals of the plan.
    """

    classes: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]
    intercepts: tuple[float, ...]
    threshold: float = 0.5

    def bounds(self) -> dict[str, float]:
        """By word, the most that the grams with it can add to the score of any licence class."""
        found: dict[str, float] = {}
        for gram, row in self.weights.items():
            for word in set(gram.split(" ")):
                found[word] = found.get(word, 0.0) + max(0.0, *row)
        return {word: bound for word, bound in found.items() if bound > 0}


def _literal_map(values: dict[str, Column]) -> Column:
    return F.create_map(*(x for word, value in values.items() for x in (F.lit(word), value)))


def possible(lines: DataFrame, model: Classifier) -> DataFrame:
    """The lines whose score can exceed that of ordinary text; no other line could be a licence.

    A line's words are looked up in the table of bounds first, without making its pairs.
    """
    bounds = model.bounds()
    if not bounds:
        return lines.limit(0)
    table = _literal_map({word: F.lit(value) for word, value in bounds.items()})
    hits = F.array_intersect("words", F.array(*map(F.lit, bounds)))
    most = F.aggregate("_hits", F.lit(0.0), lambda total, word: total + F.element_at(table, word))
    found = lines.withColumn("_hits", hits).filter(F.size("_hits") > 0)
    return found.filter(most + max(model.intercepts[:-1]) > 0).drop("_hits")


def score(rows: DataFrame, model: Classifier) -> DataFrame:
    """Adds family, the likeliest class, and its probability to rows with grams."""
    if not model.weights:
        sure = {"family": F.lit(NONE), "probability": F.lit(1.0)}
        return rows.withColumns(sure)
    table = _literal_map(
        {gram: F.array(*map(F.lit, row)) for gram, row in model.weights.items()}
    )
    known = F.array_intersect("grams", F.array(*map(F.lit, model.weights)))
    added = F.aggregate(
        known,
        F.array(*map(F.lit, model.intercepts)),
        lambda z, gram: F.zip_with(z, F.element_at(table, gram), lambda a, b: a + b),
    )
    # Generators of one row: filters on what follows are not pushed below them, where each use
    # of a score would add up the weights again.
    scored = rows.withColumn("_z", F.explode(F.array(added)))
    scored = scored.withColumn("_top", F.explode(F.array(F.array_max("_z"))))
    norm = F.aggregate("_z", F.lit(0.0), lambda total, z: total + F.exp(z - F.col("_top")))
    names = F.array(*map(F.lit, model.classes))
    best = F.get(names, (F.array_position("_z", F.col("_top")) - 1).cast("int"))
    judged = F.struct(best.alias("family"), (1 / norm).alias("probability"))
    return (
        scored.withColumn("_judged", F.explode(F.array(judged)))
        .withColumns({"family": F.col("_judged.family"), "probability": F.col("_judged.probability")})
        .drop("_z", "_top", "_judged")
    )


def train(docs: DataFrame, settings: Training = Training()) -> Classifier:
    """docs: doc_id, text."""
    spark = docs.sparkSession
    rows = common.stored(training_rows(docs, settings), "licence-training")
    # Bounded by the settings, and read in every step of the optimiser.
    fitted = rows.filter("not held_out").coalesce(4)
    counter = CountVectorizer(
        inputCol="grams", outputCol="features", vocabSize=settings.vocabulary, minDF=5, binary=True
    ).fit(fitted)
    classes = (*NOTICES, UNKNOWN, NONE)
    label = F.array_position(F.array(*map(F.lit, classes)), F.col("family")) - 1
    regression = LogisticRegression(
        family="multinomial", regParam=settings.penalty, elasticNetParam=1.0, maxIter=40,
        standardization=False,
    )
    vectors = counter.transform(fitted).withColumn("label", label.cast("double"))
    model = regression.fit(vectors.cache())
    vectors.unpersist()
    matrix = model.coefficientMatrix.toArray()
    matrix = matrix - matrix[len(classes) - 1]
    bias = model.interceptVector.toArray()
    bias = bias - bias[len(classes) - 1]
    weights = {
        counter.vocabulary[k]: tuple(float(x) for x in matrix[:, k])
        for k in range(matrix.shape[1])
        if matrix[:, k].any()
    }
    found = Classifier(classes, weights, tuple(map(float, bias)))
    held = rows.filter("held_out").select("grams", F.col("family").alias("truth"))
    wrong = score(held, found).filter(
        ~F.col("family").isin(UNKNOWN, NONE) & (F.col("family") != F.col("truth"))
    )
    # The accepted probability leaves at most the allowed share of held-out rows wrong.
    allowed = int(settings.wrong * held.count())
    above = wrong.select("probability").orderBy(F.desc("probability")).limit(allowed + 1).collect()
    threshold = above[allowed][0] if len(above) > allowed else 0.5
    return replace(found, threshold=max(threshold, 0.5))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Training = Training(),
    model: Classifier | None = None,
) -> DataFrame:
    """doc_id, paragraph, family, probability, predicted, similarity, confirmed of licence lines.

    predicted is the classifier's family. family is the same where its probability is accepted and
    a template of it is found in the line (similarity: the share of the template's words, the best
    of the family's); it is `unknown` for other licence talk, and where a template is found in part.
    A line of ordinary text gives no row, and nor does a null or empty text. Rows that share a
    doc_id give their lines each. An empty table gives no rows.
    """
    texts = common.ids_and_texts(docs, id_col, text_col)
    model = model or train(texts, settings)
    lines = possible(paragraphs(texts), model)
    scored = score(lines.withColumn("grams", grams("words")), model)
    scored = scored.filter(F.col("family") != NONE).withColumnRenamed("family", "predicted")
    known = templates(docs.sparkSession).filter(F.col("family") != UNKNOWN)
    known = known.groupBy(F.col("family").alias("predicted")).agg(
        F.collect_list("words").alias("templates")
    )
    matched = scored.join(F.broadcast(known), "predicted", "left")
    shares = F.transform(
        "templates", lambda t: F.size(F.array_intersect(t, F.col("words"))) / F.size(F.array_distinct(t))
    )
    matched = matched.withColumn("similarity", F.coalesce(F.array_max(shares), F.lit(0.0)))
    accepted = (
        (F.col("predicted") != UNKNOWN)
        & (F.col("probability") >= model.threshold)
        & (F.col("similarity") >= settings.confirmed)
    )
    suspected = (F.col("predicted") == UNKNOWN) | (F.col("similarity") >= settings.suspected)
    family = F.when(accepted, F.col("predicted")).otherwise(F.lit(UNKNOWN))
    return matched.filter(suspected).select(
        "doc_id",
        "paragraph",
        family.alias("family"),
        "probability",
        "predicted",
        "similarity",
        accepted.alias("confirmed"),
    )
