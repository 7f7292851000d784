"""License scans (1): a trained paragraph classifier, DataFrame operations only.

A paragraph is a line with a word, together with the lines that hard wrapping cut
from it: a line of ``MIN_WRAP`` to ``MAX_WRAP`` characters without a closing mark goes on
in the next line, if that is not blank. Its features are word 1- to 3-grams with a
cue word: a word of the licence templates that is not an everyday word. A
multinomial logistic regression with an L1 penalty (sparse weights) tells the
licence families and ``unknown`` apart. It is fitted with Spark's own
estimator on labelled rows made by rule from the templates: whole, shortened
and with words around them, next to sentences that use cue words in another
sense; at most ``MAX_TRAINING_ROWS`` rows, whatever the corpus.

Calibration: a third of the labelled rows is held out; on them a temperature
is chosen by log loss, and the least probability that a family must reach is
the smallest one that lets no unknown row through.

A predicted family is confirmed by its templates: the largest share of a
template's words and word pairs that the paragraph has must reach
``CONFIRM``. Unconfirmed predictions stay in the result and say so.

Scoring is one narrow projection: the weights, bounded by the templates, are
a constant map. Paragraphs without a cue word have no features and are
unknown (checked after fitting); they end at the first filter.

Defined cases: null and empty texts have no paragraphs; very long texts are scored
paragraph by paragraph, and a paragraph of any length is one row; null ids and repeated
rows are scored row by row; families with one probability go in the order of
the model; other columns are ignored, whatever their names; an empty table gives an
empty table.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_TRAINING_ROWS = 4000
CONFIRM = 0.6
UNKNOWN = "unknown"
MIN_WRAP, MAX_WRAP = 40, 120     # characters of a line that hard wrapping may have cut

# fixed values: short licence statements by family, as projects write them
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "SPDX-License-Identifier: Apache-2.0",
               "you may not use this file except in compliance with the Apache License"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "SPDX-License-Identifier: GPL-3.0-or-later",
            "under the terms of the GNU General Public License as published by the Free Software Foundation",
            "Licensed under the GPL version 2."],
    "lgpl": ["Licensed under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-only",
             "Released under the LGPL version 3."],
    "bsd": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "mpl": ["Licensed under the Mozilla Public License, Version 2.0.", "SPDX-License-Identifier: MPL-2.0",
            "This Source Code Form is subject to the terms of the Mozilla Public License"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution License.",
              "Licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "Licensed under a Creative Commons Attribution NonCommercial License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "Licensed under a Creative Commons Attribution ShareAlike License."],
    "public-domain": ["Released into the public domain.", "Dedicated to the public domain under CC0 1.0.",
                      "This is free and unencumbered software released into the public domain"],
    "proprietary": ["All rights reserved.", "Copyright, all rights reserved.",
                    "Proprietary and confidential, unauthorized copying is prohibited."],
}
# fixed values: sentences that use cue words and are no licence statement
OTHER = ["He lost his driving license in spring.", "The licensed pilot spoke of the weather and the public garden.",
         "A copy of the book lay in the general store.", "Permission to enter the domain was granted by the king.",
         "She is free to use the source of the river.", "The apache helicopter landed on the common.",
         "The students of MIT released a new film.", "The version of the story in the second edition is longer.",
         "Public rights were reserved for the attribution of the crown.", "Software was published by the foundation.",
         "The public reserved all seats.", "No charge for any person in the work of the commons.",
         "Rights and duties of the person are subject to the general law.", "Form and clause of the contract.",
         "The creative work of the artist was copied.", "International trade in binary stars is a joke.",
         "The release of the lesser panda into the public park.", "Mozilla is the name of a browser maker."]
# fixed values: everyday words that make no feature by themselves
EVERYDAY = ("a an all and any are as by except for form forms free general hereby in into is may not of on or person "
            "source terms that the this to under use was were with without work you your code file new version "
            "public common other obtaining charge copy published subject permitted foundation").split()
WORD = r"[^a-z0-9.+\-]+"


def paragraph_words(line: Column) -> Column:
    """Lower-case words; marks at their ends are dropped."""
    parts = F.split(F.lower(line), WORD)
    return F.filter(F.transform(parts, lambda w: F.btrim(w, F.lit(".+-"))), lambda w: w != "")


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text: its lines, with wrapped ones joined by a space."""
    cut = rf"(?md)^([^\n]{{{MIN_WRAP - 1},{MAX_WRAP - 1}}}[^\n.!?:;\s])[ \t\r]*\n(?=[ \t]*\S)"
    return F.split(F.regexp_replace(text, cut, "$1 "), "\n")


def grams(words: Column, cues: Column) -> Column:
    """Distinct 1- to 3-grams that hold a cue word."""
    def of(n: int) -> Column:
        at = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(
            F.array().cast("array<int>"))
        runs = F.transform(at, lambda i: F.slice(words, i, n))
        return F.transform(F.filter(runs, lambda r: F.arrays_overlap(r, cues)), lambda r: F.array_join(r, " "))
    return F.array_distinct(F.concat(of(1), of(2), of(3)))


def _words(text: str) -> list[str]:
    return [w for w in (x.strip(".+-") for x in re.split(WORD, text.lower())) if w]


def cue_words() -> list[str]:
    """Template words that are not everyday words."""
    found = {w for ts in TEMPLATES.values() for t in ts for w in _words(t)}
    return sorted(w for w in found - set(EVERYDAY) if not w.replace(".", "").isdigit())


def labelled_rows() -> list[tuple[str, str, bool]]:
    """``(text, family, held out)``: variants of templates and of other sentences, by rule."""
    around = ["", "note to readers", "see the last page for more", "from the river to the old house they went"]
    rows: list[tuple[str, str]] = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            w = t.split()
            variants = {t, t.lower(), t.upper(), " ".join(w[1:]) if len(w) > 5 else t,
                        " ".join(w[:-1]) if len(w) > 6 else t, f"Copyright 2021 the authors. {t}"}
            if family == "proprietary":
                variants.discard(f"Copyright 2021 the authors. {t}")
            rows += [(f"{a} {v} {b}".strip(), family) for v in sorted(variants) for a in around for b in around[:2]]
    for t in OTHER:
        rows += [(f"{a} {v} {b}".strip(), UNKNOWN) for v in (t, t.lower()) for a in around for b in around]
    rows += [(a, UNKNOWN) for a in around] * 8
    rows += [(w, UNKNOWN) for w in cue_words() for _ in range(2)]
    rows = rows[:MAX_TRAINING_ROWS]
    return [(t, f, i % 3 == 2) for i, (t, f) in enumerate(rows)]


@dataclass
class LicenseModel:
    families: list[str]
    vocabulary: list[str]
    weights: list[list[float]]      # one list of family weights per gram
    bias: list[float]
    temperature: float = 1.0
    least: float = 0.5


def scores(df: DataFrame, features: str, model: LicenseModel) -> DataFrame:
    """Adds ``z``, one score per family: the bias and the weights of the grams that
    are there. The scores are generated, so what follows reads them as a value."""
    table = F.from_json(F.lit(json.dumps(dict(zip(model.vocabulary, model.weights)))), "map<string,array<double>>")
    known = F.filter(F.transform(F.col(features), lambda g: F.try_element_at(table, g)), lambda w: w.isNotNull())
    total = F.aggregate(known, F.lit(list(model.bias)), lambda s, w: F.zip_with(s, w, lambda x, y: x + y))
    return df.select("*", F.explode(F.array(total)).alias("z"))


def probability(of: Column, temperature: float) -> Column:
    """Softmax of the score ``of`` among the scores ``z``."""
    return F.lit(1.0) / F.aggregate("z", F.lit(0.0), lambda s, x: s + F.exp((x - of) / F.lit(float(temperature))))


def fit_license_model(spark: SparkSession) -> LicenseModel:
    """Fit on the labelled rows, then calibrate on those held out."""
    families = [UNKNOWN, *TEMPLATES]
    rows = [(t, float(families.index(f)), h) for t, f, h in labelled_rows()]
    cues = F.array(*[F.lit(c) for c in cue_words()])
    data = spark.createDataFrame(rows, "text string, label double, held boolean").coalesce(1)
    data = data.select("label", "held", paragraph_words(F.col("text")).alias("w")).select(
        "label", "held", grams(F.col("w"), cues).alias("grams")).persist()
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2.0).fit(data.filter("not held"))
    fitted = LogisticRegression(maxIter=80, regParam=0.001, elasticNetParam=1.0, family="multinomial",
                                standardization=False).fit(vectors.transform(data.filter("not held")))
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    used = [(g, matrix[:, i].tolist()) for i, g in enumerate(vectors.vocabulary) if abs(matrix[:, i]).max() > 0]
    model = LicenseModel(families, [g for g, _ in used], [w for _, w in used], bias.tolist())
    if bias.argmax() != 0:
        raise RuntimeError("a paragraph without features must be unknown")
    held = scores(data.filter("held"), "grams", model).persist()
    grid = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
    right = F.element_at("z", F.col("label").cast("int") + 1)
    loss = held.agg(*[F.avg(-F.log(probability(right, t) + 1e-12)) for t in grid]).first()
    model.temperature = grid[min(range(len(grid)), key=lambda i: loss[i])]
    named = F.array_max(F.slice("z", 2, len(families) - 1))
    worst = held.filter("label = 0").agg(F.max(probability(named, model.temperature))).first()[0]
    model.least = min(0.95, max(0.5, float(worst or 0.0) + 0.01))
    held.unpersist()
    data.unpersist()
    return model


def _pairs(words: Column) -> Column:
    """Distinct words and adjacent word pairs."""
    at = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.concat(words, F.transform(at, lambda i: F.array_join(F.slice(words, i, 2), " "))))


def template_similarity(words: Column, family: Column) -> Column:
    """Largest share of a template's words and pairs that the paragraph has."""
    out = F.lit(0.0)
    for name, texts in TEMPLATES.items():
        shares = []
        for t in texts:
            w = _words(t)
            parts = list(dict.fromkeys([*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]))
            shares.append(F.size(F.array_intersect(_pairs(words), F.lit(parts))) / F.lit(float(len(parts))))
        out = F.when(family == name, F.greatest(*shares)).otherwise(out)
    return out


def scan_licenses(docs: DataFrame, model: LicenseModel | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(doc_id, paragraph, text, family, probability, similarity, confirmed)``, a row
    for every paragraph that the classifier gives to a licence family."""
    model = model or fit_license_model(docs.sparkSession)
    cues = F.lit(cue_words())
    lines = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.posexplode(paragraphs(F.col(text_col))).alias("paragraph", "text"))
    words = lines.select("*", paragraph_words(F.col("text")).alias("w")).filter(F.arrays_overlap("w", cues))
    scored = scores(words.select("*", grams(F.col("w"), cues).alias("grams")), "grams", model)
    best = F.array_position("z", F.array_max("z")).cast("int")
    named = scored.select("doc_id", F.col("paragraph").cast("bigint").alias("paragraph"), "text", "w",
                          F.element_at(F.lit(model.families), best).alias("family"),
                          F.round(probability(F.array_max("z"), model.temperature), 6).alias("probability"))
    named = named.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= model.least))
    return named.select("doc_id", "paragraph", "text", "family", "probability",
                        F.round(template_similarity(F.col("w"), F.col("family")), 6).alias("similarity")) \
        .withColumn("confirmed", F.col("similarity") >= CONFIRM)
