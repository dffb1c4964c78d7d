"""License scans: lines and paragraphs against licence templates by Dice coefficient over word bigrams.

Bigram sets are 64-bit hashes built by built-in functions. Size bounds that follow from the threshold discard units
before their bigrams are built and then all templates that are too short or too long for a unit.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

THRESHOLD = 0.8

#: Notices as they stand in files, short statements and the opening paragraphs of the full texts.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Distributed under the terms of the Apache License, Version 2.0.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "all-rights-reserved": ("All rights reserved.",),
}


def normalized_words(text: Column) -> Column:
    """Runs of a-z and 0-9 after lower-casing A-Z; everything else separates."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bare = F.btrim(F.regexp_replace(low, "[^a-z0-9]+", " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def bigrams(words: Column) -> Column:
    """Distinct hashed pairs of neighbouring words; none below two words."""

    def pairs(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))
        return F.when(F.size(w) < 2, F.array().cast("array<bigint>")).otherwise(F.array_distinct(every))

    return let(words, pairs)


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """The bigram counts a unit can have to reach the threshold against ``n`` bigrams: 2 min / (a + b) bounds Dice."""
    t = Fraction(str(threshold))
    return math.ceil(n * t / (2 - t)), math.floor(n * (2 - t) / t)


def _python_words(text: str) -> list[str]:
    import re

    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def template_sizes(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, int, str, int]]:
    """(licence, number, text, distinct bigrams) of each template."""
    out = []
    for lic, texts in templates.items():
        for k, text in enumerate(texts):
            w = _python_words(text)
            out.append((lic, k, text, len(set(zip(w, w[1:], strict=False)))))
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per (id, licence) found: ``license``, ``n_units`` that match, the best ``dice``, one matching ``unit``.

    Units are the lines of the text and its paragraphs of several lines (split at blank lines). A unit matches a
    template if the Dice coefficient of their distinct word bigrams is at least ``threshold``. Null, empty and
    one-word texts have no bigrams and match nothing; an empty table gives an empty result; texts of any length are scanned
    whole. Repeated rows of an id add up; ties for ``unit`` go to the least
    text. Other columns of ``docs`` are not read. The template list is configuration and does not grow with the data.
    """
    sizes = [(*x, *size_bounds(x[3], threshold)) for x in template_sizes(templates or TEMPLATES)]
    least, most = min(x[4] for x in sizes), max(x[5] for x in sizes)
    spark = docs.sparkSession
    fields = ("license", "template", "t_size", "low", "high")
    known = spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(x[i]).alias(n) for i, n in zip((0, 2, 3, 4, 5), fields, strict=True)]) for x in sizes])))
    known = known.withColumn("t_grams", bigrams(normalized_words(F.col("template"))))
    # By size: each bigram count that can reach a template's threshold leads to that template.
    by_size = known.select("license", "t_size", "t_grams", F.explode(F.sequence("low", "high")).alias("u_size"))
    every = F.array(*[F.lit(h) for h in _hashes(spark, sizes)])
    parts = F.split(F.col(text_col), r"\n[\x20\x09-\x0D]*\n", -1)
    units = F.concat(F.split(F.col(text_col), "\n", -1), F.filter(parts, lambda p: F.contains(F.btrim(p, F.lit("\n")), F.lit("\n"))))
    lines = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.explode(units).alias("__unit"))
    # A unit with too many words could only have few distinct bigrams by repetition, so the upper bound waits for the set.
    # Filters sit inside the generators: pushed below a projection, they would repeat its expressions.
    words = F.filter(F.array(normalized_words(F.col("__unit"))), lambda w: F.size(w) > least)
    lines = lines.select("__id", "__unit", F.explode(words).alias("__words"))
    grams = F.filter(F.array(bigrams(F.col("__words"))), lambda g: (F.size(g) <= most) & F.arrays_overlap(g, every))
    lines = lines.select("__id", "__unit", F.explode(grams).alias("__grams"))
    both = F.size(F.array_intersect("__grams", "t_grams"))
    dice = F.lit(2.0) * both / (F.size("__grams") + F.col("t_size"))
    hits = lines.join(F.broadcast(by_size), F.size("__grams") == F.col("u_size")).withColumn("__dice", dice).where(F.col("__dice") >= threshold)
    hits = hits.groupBy("__id", "license", "__unit").agg(F.count("*").alias("__n"), F.max("__dice").alias("__dice"), F.count_distinct("t_grams").alias("__t"))
    per_id = hits.groupBy("__id", "license").agg(
        F.sum(F.col("__n") / F.col("__t")).cast("long").alias("n_units"), F.max("__dice").alias("dice"), F.min("__unit").alias("unit")
    )
    return per_id.select(F.col("__id").alias(id_col), "license", "n_units", "dice", "unit")


def _hashes(spark, sizes) -> list[int]:
    """The hashed bigrams of all templates: a fixed list, computed by the same expressions as the texts'."""
    texts = spark.range(1).select(F.explode(F.array(*[F.lit(x[2]) for x in sizes])).alias("t"))
    rows = texts.select(F.explode(bigrams(normalized_words(F.col("t")))).alias("h")).distinct().collect()
    return sorted(r.h for r in rows)
