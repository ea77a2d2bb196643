"""Licence scan: a trained paragraph classifier, in DataFrame and SQL functions only.

Sparse features are word n-grams (1 to 3 words) of the templates that negative paragraphs hardly ever have. Lines with a
phrase of a template, or within one, are no negatives, however many documents have them. A multinomial
logistic regression (spark.ml) learns the family of windows cut from the templates against the class `unknown`, paragraphs
of a bounded sample of documents. The unknown class is calibrated: its logit is shifted so that on windows and paragraphs
left out of the fit the log loss is least. A paragraph's family counts when it beats unknown, and is confirmed when its
trigrams agree with one of the family's templates.

Scoring reads each document once: paragraphs without any feature can only be unknown (all their features are 0) and go
at once, mostly by their words alone: a phrase of common words is looked for only where its rarest word is; for the others the weights of their n-grams, a table as long as the templates, are joined and summed.

Null or empty texts have no paragraphs, an empty table none either. A null doc_id is kept as null. Repeated rows are reported once
each (documents are numbered by row). Paragraphs are lines, or runs of lines with features where a notice is wrapped; empty lines
count for the numbering and end a run. Ties go to the family that comes first. Very long texts are cut into lines like others. Extra
columns are not read, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import stored, table

#: Documents whose lines teach `unknown` (a bounded sample), the words of a training window, the agreement that confirms.
NEGATIVE_DOCUMENTS, WINDOWS, CONFIRM = 400, (4, 6, 9, 14), 0.5
UNKNOWN = "unknown"

# Standard notices and characteristic sentences of licence families.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "agpl": ["Licensed under the GNU Affero General Public License, version 3.", "You should have received a copy of the GNU Affero General Public License along with this program."],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released under CC0 1.0 Universal Public Domain Dedication."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, for any purpose, commercial or non-commercial, and by any means."],
    "proprietary": ["All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.", "Copyright. All rights reserved."],
}


def words(text: Column) -> Column:
    """Lower-case words of letters, digits, `-` and inner dots."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^a-z0-9.\-]+|\.(?=[^a-z0-9]|$)", " "), " +"), lambda w: w != "")


def ngrams(w: Column, orders: tuple[int, ...] = (1, 2, 3)) -> Column:
    """The distinct n-grams of a word array."""
    def order(n: int) -> Column:
        last = F.size(w) - n + 1
        windows = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(last > 0, windows).otherwise(F.array().cast("array<string>"))

    parts = [order(n) for n in orders]
    return F.array_distinct(F.concat(*parts))


def templates(spark: SparkSession) -> DataFrame:
    """(family, w): each template as a word array."""
    return spark.createDataFrame([(f, t) for f, texts in TEMPLATES.items() for t in texts], "family string, text string").select("family", words(F.col("text")).alias("w"))


def sentences(spark: SparkSession) -> DataFrame:
    """(family, w): the sentences of templates that have several, with a trigram each, as lines of their own may be."""
    parts = [(f, x) for f, texts in TEMPLATES.items() for t in texts if len(found := re.split(r"(?<=[.;]) ", t)) > 1 for x in found]
    return spark.createDataFrame(parts, "family string, text string").select("family", words(F.col("text")).alias("w")).where(F.size("w") >= 3)


def paragraphs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, paragraph, w): the lines of whole texts as word arrays."""
    # numbered before the lines are cut: each document's have one number
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.split(F.col(text_col).cast("string"), "\r?\n").alias("lines"))
    lines = rows.select("row", "doc_id", F.posexplode("lines").alias("paragraph", "line"))
    # a generator, so that the words are made once and not anew wherever an n-gram is cut from them
    return lines.select("row", "doc_id", "paragraph", F.explode(F.array(words(F.col("line")))).alias("w"))


class Model:
    """Classes, the weights of features by class, intercepts with the calibrated shift of `unknown`, the rarest words of phrases of common words."""

    def __init__(self, classes: list[str], vocabulary: list[str], weights: list[list[float]], intercepts: list[float]):
        self.classes, self.vocabulary, self.weights, self.intercepts = classes, vocabulary, weights, intercepts
        self.rarest: dict[str, str] = {}


def _fit(rows: DataFrame, classes: list[str], vocabulary: list[str]):
    vector = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features")
    rows = vector.transform(rows).select("label", "features", "fold").coalesce(2).cache()  # a bounded sample: tasks of a few thousand rows
    regression = LogisticRegression(family="multinomial", regParam=0.002, maxIter=25)
    part = regression.fit(rows.where("fold > 0"))
    held = part.transform(rows.where("fold = 0")).select("label", "rawPrediction").collect()  # a fifth of the bounded sample
    model = regression.fit(rows)
    rows.unpersist()
    unknown = classes.index(UNKNOWN)

    def loss(shift: float) -> float:
        import math

        total = 0.0
        for r in held:
            raw = [x + shift * (i == unknown) for i, x in enumerate(r["rawPrediction"])]
            top = max(raw)
            weight = 1.0 if int(r["label"]) == unknown else 0.2  # windows are many and alike
            total += weight * (top + math.log(sum(math.exp(x - top) for x in raw)) - raw[int(r["label"])])
        return total

    shift = min((s / 4 for s in range(-16, 17)), key=loss) if held else 0.0
    bias = [x + shift * (i == unknown) for i, x in enumerate(model.interceptVector)]
    return Model(classes, vocabulary, model.coefficientMatrix.toArray().T.tolist(), bias)


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """From the templates, and NEGATIVE_DOCUMENTS documents (by hash of the id) that teach `unknown`."""
    spark = documents.sparkSession
    known = templates(spark)
    windows = known.select(
        "family", "w", F.explode(F.array(*map(F.lit, WINDOWS))).alias("n")
    ).select("family", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - F.col("n") + 1, F.lit(1))), lambda i: F.slice("w", i, F.col("n")))).alias("w"))
    # each template itself counts as often as its windows, and so does each sentence of one
    positive = windows.unionAll(known.unionAll(sentences(spark)).crossJoin(spark.range(12)).select("family", "w"))
    # hashes first: only they are sorted; then the rows that have them, once each
    hashed = documents.where(F.col(text_col).isNotNull()).select(F.xxhash64(id_col, text_col).alias("_h"), id_col, text_col)
    chosen = stored(hashed.select("_h").orderBy("_h").limit(NEGATIVE_DOCUMENTS).distinct())
    sample = hashed.join(F.broadcast(chosen), "_h", "left_semi").groupBy("_h").agg(F.first(id_col).alias(id_col), F.first(text_col).alias(text_col)).drop("_h")
    grams = lambda orders, name: known.select(F.explode(ngrams(F.col("w"), orders)).alias("gram")).agg(F.collect_set("gram").alias(name))
    negative = paragraphs(sample, id_col, text_col).where(F.size("w") > 0).crossJoin(F.broadcast(grams((1, 2), "short"))).crossJoin(F.broadcast(grams((3,), "all")))  # of the templates alone
    notice = F.arrays_overlap(ngrams(F.col("w"), (3,)), "all") | F.array_contains("short", F.array_join("w", " "))
    negative = stored(negative.where(~notice).select(F.lit(UNKNOWN).alias("family"), "w"))
    common = negative.select(F.explode(ngrams(F.col("w"))).alias("gram")).groupBy("gram").count()
    share = negative.count() * 0.002
    features = known.select(F.explode(ngrams(F.col("w"))).alias("gram")).distinct().join(common, "gram", "left").where(F.coalesce("count", F.lit(0)) <= share)
    found = [r["gram"] for r in features.select("gram").orderBy("gram").collect()]  # of the templates alone
    single = {g for g in found if " " not in g}
    # of each phrase without a feature word the rarest word
    plain = [g for g in found if not single & set(g.split(" "))]
    often = {r["gram"]: r["count"] for r in common.where(F.col("gram").isin({w for g in plain for w in g.split(" ")})).collect()} if plain else {}  # the words of the templates
    rarest = {g: min(g.split(" "), key=lambda w: (often.get(w, 0), w)) for g in plain}
    classes = [*TEMPLATES, UNKNOWN]
    number = F.create_map(*(F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))))
    rows = positive.unionAll(negative).select(number[F.col("family")].alias("label"), ngrams(F.col("w")).alias("grams"), F.pmod(F.xxhash64(F.array_join("w", " ")), F.lit(5)).alias("fold"))
    model = _fit(rows, classes, found)
    model.rarest = rarest
    return model


def scan(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, paragraph, family, probability, similarity, confirmed, last_line: every paragraph that a family wins.

    A paragraph is a line, or a run of lines that only together, or all of them, are a notice of one family; it is named by its first line.
    """
    spark = documents.sparkSession
    array = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    heads = F.arrays_overlap("w", array([g for g in model.vocabulary if " " not in g]))  # every feature holds one of them, but those of model.rarest
    if model.rarest:
        heads = heads | (F.arrays_overlap("w", array(sorted(set(model.rarest.values())))) & F.arrays_overlap(ngrams(F.col("w"), (2, 3)), array(model.rarest)))
    weights = spark.createDataFrame(list(zip(model.vocabulary, model.weights, strict=True)), "gram string, weights array<double>")
    some = paragraphs(documents, id_col, text_col).where(heads)
    some = stored(some.withColumn("grams", ngrams(F.col("w"))))  # few: paragraphs with a feature
    lines = stored(_judged(some, model, weights))
    # lines with features that follow one another may be one wrapped notice: their words together, and what they then are
    w = Window.partitionBy("row").orderBy("paragraph")  # of the few lines with features of one document
    runs = some.withColumn("run", F.col("paragraph") - F.row_number().over(w))
    size = F.count("*").over(Window.partitionBy("row", "run"))
    runs = stored(runs.withColumn("size", size).where("size > 1"))
    # from the first line that a family wins to the last one, where there is one
    ends = lines.join(runs.select("row", "paragraph", "run"), ["row", "paragraph"]).groupBy("row", "run").agg(F.min("paragraph").alias("lo"), F.max("paragraph").alias("hi"))
    runs = stored(runs.join(ends, ["row", "run"], "left").where("paragraph between coalesce(lo, paragraph) and coalesce(hi, paragraph)").drop("lo", "hi"))
    joined = runs.groupBy("row", "doc_id", "run").agg(F.min("paragraph").alias("paragraph"), F.max("paragraph").alias("last"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("paragraph", "w"))), lambda x: x["w"])).alias("w"))
    whole = _judged(joined.withColumn("grams", ngrams(F.col("w"))), model, weights).where("confirmed")
    whole = whole.join(joined.select("row", "paragraph", "run", "last"), ["row", "paragraph"])
    # unless one of the lines is a notice of another family by itself
    own = lines.join(runs.select("row", "paragraph", "run"), ["row", "paragraph"]).where("confirmed").select("row", "run", F.col("family").alias("other"))
    against = whole.join(own, ["row", "run"]).where(F.col("family") != F.col("other")).select("row", "run")
    whole = stored(whole.join(against, ["row", "run"], "left_anti"))
    taken = whole.join(runs.select("row", "run", F.col("paragraph").alias("line")), ["row", "run"]).select("row", F.col("line").alias("paragraph"))
    single = lines.join(taken, ["row", "paragraph"], "left_anti").withColumn("last", F.col("paragraph"))
    out = whole.select(single.columns).unionByName(single)
    return out.select("doc_id", "paragraph", "family", "probability", "similarity", "confirmed", F.col("last").alias("last_line"))


def _judged(some: DataFrame, model: Model, weights: DataFrame) -> DataFrame:
    """row, doc_id, paragraph, family, probability, similarity, confirmed of the (row, doc_id, paragraph, grams) that a family wins."""
    found = some.select("row", "doc_id", "paragraph", F.explode("grams").alias("gram")).join(F.broadcast(weights), "gram")
    classes = range(len(model.classes))
    logits = found.groupBy("row", "doc_id", "paragraph").agg(*(F.sum(F.col("weights")[i]).alias(f"l{i}") for i in classes))
    raw = F.array(*(F.col(f"l{i}") + F.lit(model.intercepts[i]) for i in classes))
    top = F.array_max("raw")
    scored = logits.select("row", "doc_id", "paragraph", raw.alias("raw")).select(
        "row", "doc_id", "paragraph",
        (1 / F.aggregate("raw", F.lit(0.0), lambda a, x: a + F.exp(x - top))).alias("probability"),
        F.array(*map(F.lit, model.classes))[F.array_position("raw", top).cast("int") - 1].alias("family"),
    ).where(F.col("family") != UNKNOWN)
    # comparison with the templates of the family: shared trigrams against the shorter of the two
    known = templates(some.sparkSession).select("family", ngrams(F.col("w"), (3,)).alias("t"))
    trigrams = some.select("row", "paragraph", F.filter("grams", lambda g: F.size(F.split(g, " ")) == 3).alias("g"))
    pairs = scored.join(trigrams, ["row", "paragraph"]).join(F.broadcast(known), "family", "left")
    shared = F.size(F.array_intersect("g", "t")) / F.greatest(F.least(F.size("g"), F.size("t")), F.lit(1))
    out = pairs.groupBy("row", "doc_id", "paragraph", "family", "probability").agg(F.max(shared).alias("similarity"))
    return out.withColumn("confirmed", F.col("similarity") >= CONFIRM)


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    """doc_id, paragraph, family, probability, similarity, confirmed, last_line of every licence paragraph of every document."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
