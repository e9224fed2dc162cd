"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Paragraphs are lines, and runs of lines that follow each other without a blank one
(a line without words, as one of comment marks only), for notices wrapped over
several lines. They are read as sets of word 1- to 3-grams from the templates'
vocabulary. A multinomial logistic regression over these sparse features, fitted
on variants of the templates and on sentences that only sound alike, gives a
probability per family and one for ``unknown``. The least probability that counts
is calibrated on variants kept out of the fit: above all that sentences of the
unknown class reach. A paragraph accepted so is compared with the templates of
its family; the share of a template's word pairs that it holds must reach
``SIMILARITY``.

A run reaches from the last ``RUN_WORDS`` words of a line over the lines after it
until these hold as many (twice the longest template). The smallest runs (or lines)
that state a family tell its notices in a text apart; smallest runs that share lines
are one notice. Its row is that of the run most like a template, of equal ones the
shortest, and names the run's first line.

Texts and paragraphs without any telling word of the templates, or without any of the
templates' word pairs that hold one, are passed over before lines and n-grams are
made: more than 1 - SIMILARITY of every template's word pairs hold such a word (checked
on loading), so no template could confirm them.
Everything runs in DataFrame expressions; the weights (a few thousand rows, fixed
by the templates) are broadcast.

Cases: null and empty texts and blank paragraphs give no rows; of equal
probabilities the family first in order wins; repeated rows are reported each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

GRAMS = 3
SIMILARITY = 0.5
UNKNOWN = "unknown"
LEAST_PROBABILITY = 0.5

#: Notices by which the families are known.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License - see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}
#: Sentences that share words with notices and grant nothing.
SOUND_ALIKE = [
    "All rights reserved.",
    "The driver must carry a valid license and proof of insurance.",
    "Permission is required to enter the building after work.",
    "This software is provided by the vendor for a fee and may not be copied.",
    "Delivery is free of charge for any person who lives in the city.",
    "The general public was invited to the open house.",
    "The committee published the terms under which the work was distributed.",
    "See the file for details about the project and the version history.",
    "You should have received a copy of the letter along with the invoice.",
    "Version 2.0 of the program was released under pressure from the press.",
    "He was licensed under the old law and had to apply again.",
    "The license of the restaurant was not renewed in 2004.",
    "The public domain is a subject of debate among lawyers.",
    "The source of the binary star is subject to the following conditions.",
    "The warranty covers any kind of damage, either express or implied by the seller.",
    "The attribution of the painting to the master is in doubt.",
    "The foundation published a free book about the new law.",
    "Terms of service apply to the use of this website.",
]
#: Words too common to tell anything alone.
_COMMON = ("a an and any are as at be by can do either for free from has have he in is it law may not of on or other see should "
           "terms that the this to under use version was will with work you your").split()


def plain_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def word_pairs(text: str) -> set[str]:
    w = [x for x in (x.strip(".") for x in re.split(r"[^a-z0-9.]+", text.lower())) if x]
    return {" ".join(p) for p in pairwise(w)}


def telling_words() -> list[str]:
    """Words of the templates without which none can be confirmed."""
    telling = {w for ts in TEMPLATES.values() for t in ts for w in plain_words(t)} - set(_COMMON) - set("0123456789")
    for t in (t for ts in TEMPLATES.values() for t in ts):
        pairs = word_pairs(t)
        if sum(bool(telling & set(plain_words(p))) for p in pairs) <= (1 - SIMILARITY) * len(pairs):
            raise ValueError(f"a copy of {t!r} might hold no telling word")
    return sorted(telling)


def telling_pairs() -> list[str]:
    """Word pairs of the templates with a telling word; what holds none can't be confirmed."""
    telling = set(telling_words())
    return sorted({p for ts in TEMPLATES.values() for t in ts for p in word_pairs(t) if telling & set(plain_words(p))})


def words(text: Column) -> Column:
    """Lower-case words, with inner dots and pluses (2.0, gpl-3.0 is gpl and 3.0)."""
    w = F.split(F.lower(text), r"[^a-z0-9.]+")
    return F.filter(F.transform(w, lambda x: F.btrim(x, F.lit("."))), lambda x: x != "")


def once(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def grams(w: Column, n: int = GRAMS) -> Column:
    """Distinct 1- to n-grams."""
    def runs(k: int) -> Column:
        first = F.slice(w, 1, F.greatest(F.size(w) - (k - 1), F.lit(0)))
        return F.transform(first, lambda _, i: F.concat_ws(" ", F.slice(w, i + 1, k)))

    return F.array_distinct(F.concat(w, *map(runs, range(2, n + 1))))


def _listed(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, ts in [*TEMPLATES.items(), (UNKNOWN, SOUND_ALIKE)] for t in ts]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.family", "x.text").coalesce(1)


def _without_every_fourth(w: Column, k: int) -> Column:
    return F.filter(w, lambda _, i: (F.size(w) < 6) | (i % 4 != k))


def variants(spark: SparkSession) -> DataFrame:
    """(family, w, turn): each notice whole, with every fourth word gone in four
    ways, its halves, and inside other words."""
    one = _listed(spark).withColumn("w", words(F.col("text")))
    around = words(F.lit("then they went on to say that more would follow soon and left it there"))
    ways = [F.col("w"), F.concat(around, F.col("w")), F.concat(F.col("w"), around)]
    ways += [_without_every_fourth(F.col("w"), k) for k in range(4)]
    half = F.when(F.size("w") >= 16, F.ceil(F.size("w") / 2)).otherwise(F.size("w")).cast("int")
    ways += [F.slice("w", 1, half), F.slice("w", F.size("w") - half + 1, half)]
    return one.select("family", F.posexplode(F.array(*ways)).alias("turn", "w")).where("size(w) > 0")


class Classifier:
    """Weights per n-gram, biases and the least probability that counts."""

    def __init__(self, spark: SparkSession):
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import CountVectorizer

        data = variants(spark).withColumn("grams", once(F.col("w"), lambda w: grams(w))).cache()
        vocabulary = CountVectorizer(inputCol="grams", outputCol="x", binary=True, minDF=1).fit(data)
        self.families = sorted(TEMPLATES) + [UNKNOWN]
        index = F.array_position(F.array(*map(F.lit, self.families)), F.col("family")) - 1
        ready = vocabulary.transform(data).withColumn("y", index.cast("double")).withColumn("kept_out", F.col("turn") % 4 == 3)
        model = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", regParam=0.002, maxIter=80).fit(ready.where(~F.col("kept_out")))
        self.vocabulary, self.bias = vocabulary.vocabulary, [float(b) for b in model.interceptVector]
        self.weights = model.coefficientMatrix.toArray().T.tolist()
        top = self.scored(ready.where("kept_out").select(F.monotonically_increasing_id().alias("key"), "family", "grams"), ["key", "family"])
        alike = top.where(F.col("family") == UNKNOWN).agg(F.max("other")).first()[0]
        self.least = max(LEAST_PROBABILITY, float(alike or 0.0))
        data.unpersist()

    def table(self, spark: SparkSession) -> DataFrame:
        """(gram, weights): fixed by the templates, a few thousand rows."""
        rows = "\n".join(g + "\t" + ",".join(map(repr, w)) for g, w in zip(self.vocabulary, self.weights, strict=True))
        lines = spark.range(1).select(F.explode(F.split(F.lit(rows), "\n")).alias("line"))
        x = lines.select(F.split("line", "\t").alias("x"))
        return x.select(F.col("x")[0].alias("gram"), F.split(F.col("x")[1], ",").cast("array<double>").alias("w"))

    def scored(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """keys with ``predicted``, its ``probability`` and ``other``, the best of the known families."""
        n = len(self.families)
        hit = rows.select(*keys, F.explode("grams").alias("gram")).join(F.broadcast(self.table(rows.sparkSession)), "gram")
        sums = [(F.sum(F.col("w")[k]) + F.lit(self.bias[k])).alias(f"z{k}") for k in range(n)]
        z = hit.groupBy(*keys).agg(*sums)
        top = F.greatest(*[F.col(f"z{k}") for k in range(n)])
        z = z.withColumn("top", top)
        total = sum((F.exp(F.col(f"z{k}") - F.col("top")) for k in range(n)), F.lit(0.0))
        z = z.withColumn("total", total)
        best = F.greatest(*[F.col(f"z{k}") for k in range(n - 1)])
        name = F.coalesce(*[F.when(F.col(f"z{k}") == best, F.lit(self.families[k])) for k in range(n - 1)])
        return z.select(*keys, name.alias("best"), (F.exp(best - F.col("top")) / F.col("total")).alias("other"))


_fitted: dict[str, Classifier] = {}


def classifier(spark: SparkSession) -> Classifier:
    """The classifier of this session's application; it depends on nothing but the templates."""
    key = spark.sparkContext.applicationId
    if key not in _fitted:
        _fitted[key] = Classifier(spark)
    return _fitted[key]


def _pairs() -> list[Column]:
    return [F.struct(F.lit(f).alias("f"), F.lit(k).alias("template"), F.array(*map(F.lit, sorted(word_pairs(t)))).alias("held"))
            for f, ts in TEMPLATES.items() for k, t in enumerate(ts)]


#: Words on each side of a line end that runs of lines reach over.
RUN_WORDS = 2 * max(len(plain_words(t)) for ts in TEMPLATES.values() for t in ts)


def runs_of_lines(lines: Column, w: Column, i: Column) -> Column:
    """(last, w) of the runs of two and more lines from line ``i`` with the words ``w``."""
    tail = F.slice(w, F.greatest(F.size(w) - (RUN_WORDS - 1), F.lit(1)), RUN_WORDS)
    none = F.array().cast("array<struct<last: int, w: array<string>>>")

    def further(acc: Column, x: Column) -> Column:
        def joined(more: Column) -> Column:
            run = F.struct((i + F.size(acc.runs) + 1).cast("int").alias("last"), more.alias("w"))
            return F.struct(more.alias("w"), (F.size(more) < F.least(F.size(w), F.lit(RUN_WORDS)) + RUN_WORDS).alias("open"),
                            F.concat(acc.runs, F.array(run)).alias("runs"))

        stop = F.struct(acc.w.alias("w"), F.lit(False).alias("open"), acc.runs.alias("runs"))
        return F.when(~acc.open | (F.size(x) == 0), stop).otherwise(once(F.concat(acc.w, F.slice(x, 1, RUN_WORDS)), joined))

    start = F.struct(tail.alias("w"), (F.size(w) > 0).alias("open"), none.alias("runs"))
    return F.aggregate(F.slice(lines, i + 2, RUN_WORDS), start, further, lambda acc: acc.runs)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph, family, probability, template and similarity of every
    paragraph that states a licence."""
    spark = docs.sparkSession
    model = classifier(spark)
    telling = F.array(*map(F.lit, telling_words()))

    def may_tell(column: str) -> Column:
        return F.arrays_overlap(F.split(F.lower(column), "[^a-z0-9]+"), telling)

    some = F.array(*map(F.lit, telling_pairs()))
    # a line's end is a gap between words like any other, so a run's pairs are pairs of its text
    holds_pair = once(words(F.col("text")), lambda w: F.arrays_overlap(F.transform(w, lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1))), some))
    texts = (docs.select(F.monotonically_increasing_id().alias("text_row"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).where(may_tell("text")).where(holds_pair))
    lines = texts.select("text_row", "doc_id", F.transform(F.split("text", "\n"), words).alias("lines"))
    own = F.transform("lines", lambda w, i: F.array(F.struct(i.cast("int").alias("last"), w.alias("w"))))
    more = F.transform("lines", lambda w, i: runs_of_lines(F.col("lines"), w, i))
    near = lines.select("text_row", "doc_id", F.posexplode(F.zip_with(own, more, lambda a, b: F.concat(a, b))).alias("paragraph", "x"))
    near = near.select("text_row", "doc_id", "paragraph", F.inline("x"))
    near = near.where(F.arrays_overlap("w", telling))
    near = near.where(F.arrays_overlap(grams(F.col("w"), 2), some))
    # written, so that its row numbers, which tell repeated rows apart, stay
    near = table(near.select(F.monotonically_increasing_id().alias("row"), "text_row", "doc_id", "paragraph", "last", grams(F.col("w")).alias("grams")), "license-paragraphs")
    notices = spark.range(1).select(F.explode(F.array(*_pairs())).alias("x")).select("x.*")
    share = F.size(F.array_intersect("grams", "held")) / F.size("held")
    # runs of lines are compared first: few hold half of a template
    run = F.col("last") > F.col("paragraph")
    half = F.exists(F.array(*[x["held"] for x in _pairs()]), lambda held: F.size(F.array_intersect("grams", held)) >= SIMILARITY * F.size(held))
    near = near.where(~run | half)
    found = model.scored(near, ["row"]).where(F.col("other") > model.least)
    close = (found.join(near, "row").join(F.broadcast(notices), F.col("best") == F.col("f"))
             .withColumn("similarity", share).where(F.col("similarity") >= SIMILARITY))
    close = (close.groupBy("row", "text_row", "doc_id", "paragraph", "last", F.col("best").alias("family"))
             .agg(F.max("other").alias("probability"), F.max(F.struct("similarity", -F.col("template"))).alias("m")))
    # the smallest runs tell the notices apart: those that share lines are one place
    def over(*order, end: int = 0):
        return Window.partitionBy("text_row", "family").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)

    inwards, outwards = (F.desc("paragraph"), F.asc("last")), (F.asc("last"), F.desc("paragraph"))
    inner = F.min("last").over(over(*inwards, end=-1))
    close = close.withColumn("least", F.coalesce(inner > F.col("last"), F.lit(True)))
    onwards = (F.asc("paragraph"), F.asc("last"))
    ended = F.max(F.when(F.col("least"), F.col("last"))).over(over(*onwards, end=-1))
    close = close.withColumn("new", F.col("least") & F.coalesce(F.col("paragraph") > ended, F.lit(True)))
    close = close.withColumn("place", F.when(F.col("least"), F.sum(F.col("new").cast("int")).over(over(*onwards))))
    # of the runs that hold runs of one place only, the one most like a template
    low = F.min(F.when(F.col("least"), F.struct("last", "place"))).over(over(*inwards))["place"]
    high = F.max(F.when(F.col("least"), F.struct("paragraph", "place"))).over(over(*outwards))["place"]
    close = close.withColumn("low", low).withColumn("high", high).where(F.col("low") == F.col("high"))
    best = F.struct(F.col("m.similarity"), (F.col("paragraph") - F.col("last")).alias("short"), (-F.col("paragraph")).alias("p"), "m", "probability", "doc_id")
    return (close.groupBy("text_row", "family", "low").agg(F.max(best).alias("x"))
            .select("x.doc_id", (-F.col("x.p")).cast("long").alias("paragraph"), "family", "x.probability",
                    (-F.col("x.m.col2")).alias("template"), F.col("x.m.similarity").alias("similarity")))
