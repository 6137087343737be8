"""License scan with DataFrame functions only.

Words are runs of letters and digits, A-Z as a-z; shingles are three words. A template of m shingles lies within a
window of 2 m shingles that begins at a multiple of m, so texts are read in overlapping windows for each size of
template. MinHash with ``BANDS`` bands of one row retrieves templates: a window that contains a share c of a
template has Jaccard similarity of at least ``c m / (3 m - c m)`` (0.36 for c = 0.8) and misses it with a probability of
``(1 - similarity) ** BANDS``, 2e-5 at 24 bands. Exact containment of the template's shingles then decides.

Only windows that hold a shingle of some template can match, so documents without any are passed over first: this
loses nothing, and MinHash is worked out for few windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dupelens.llm.tables import keep

BANDS = 24
CONTAINMENT = 0.8
WORDS = 3
#: Share of the smaller of two templates that makes them variants of each other.
VARIANT = 0.5

# Notices of common licenses as they stand in documents.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "apache": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "reserved": "All rights reserved.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "lgpl": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
    "Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at",
    "epl1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
    "which accompanies this distribution",
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
    "which is available at",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    plain = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    return F.filter(plain, lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Hashes of all runs of three words, in order; none in shorter texts."""
    at = F.when(F.size(words) >= WORDS, F.sequence(F.lit(0), F.size(words) - WORDS)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*(words[i + k] for k in range(WORDS))))


def templates(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    """``(license, m, shingles, width)``: distinct shingles of each notice, their number, and the shingles it takes up."""
    rows = spark.createDataFrame(sorted(notices.items()), "license string, notice string")
    every = rows.select("license", _let(words_of(F.col("notice")), shingles_of).alias("every"))
    made = every.select("license", F.array_distinct("every").alias("shingles"), F.size("every").alias("width"))
    return made.select("license", F.size("shingles").alias("m"), "shingles", "width").where("m > 0")


def bands(shingles: Column) -> Column:
    """One MinHash value for each band, with the number of the band mixed in."""
    def least(i: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(i))))

    return F.array(*(F.xxhash64(least(i), F.lit(i)) for i in range(BANDS)))


def scanned(docs: DataFrame, notices: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, license, containment, first_word, windows)`` for each row and each template that it contains.

    ``first_word`` is the begin of the first matching window, ``windows`` their number. Null, empty and short texts
    contain nothing. Where windows of templates that mostly share their words overlap, the better covered template counts
    (an LGPL notice is not reported as GPL as well). Rows that repeat a ``doc_id`` and text give one result, rows with one
    ``doc_id`` and different texts (or a null id) one for each text; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    known = templates(spark, TEMPLATES if notices is None else notices)
    listed = known.collect()
    sets = {r["license"]: set(r["shingles"]) for r in listed}
    alike = [(a, b) for a in sets for b in sets if a != b and len(sets[a] & sets[b]) >= VARIANT * min(len(sets[a]), len(sets[b]))]
    # The templates are a parameter of a few entries; their shingles go into the plan as constants.
    wanted = sorted({h for shingles in sets.values() for h in shingles})
    widths = sorted({r["width"] for r in listed})
    every = F.array(*(F.lit(h) for h in wanted)) if wanted else F.array().cast("array<bigint>")

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    holds = _let(words_of(F.col("text")), lambda w: F.arrays_overlap(shingles_of(w), every))
    holding = source.where(F.coalesce(holds, F.lit(False)))
    read = holding.select("doc_id", F.xxhash64("text").alias("digest"), _let(words_of(F.col("text")), shingles_of).alias("all"))

    width = F.explode(F.array(*(F.lit(w) for w in widths)) if widths else F.array().cast("array<int>"))
    classes = read.select("doc_id", "digest", "all", width.alias("width"))
    begins = F.explode(F.sequence(F.lit(0), F.size("all") - 1, F.col("width")))
    windows = classes.where(F.size("all") > 0).select("doc_id", "digest", "all", "width", begins.alias("begin"))
    cut = windows.select("doc_id", "digest", "width", "begin", F.slice("all", F.col("begin") + 1, 2 * F.col("width")).alias("shingles"))
    held = cut.where(F.arrays_overlap("shingles", every))

    keys = known.select("license", "m", F.col("shingles").alias("template"), "width", F.posexplode(bands(F.col("shingles"))).alias("band", "value"))
    asked = held.select("doc_id", "digest", "width", "begin", "shingles", F.posexplode(bands(F.col("shingles"))).alias("band", "value"))
    met = asked.join(F.broadcast(keys), ["width", "band", "value"])
    share = F.size(F.array_intersect("shingles", "template")) / F.col("m")
    sure = met.withColumn("share", share).where(F.col("share") >= containment)
    sure = sure.select("doc_id", "digest", "license", "share", "begin", "width").distinct()
    if alike:
        # Read three times below, and small beside the texts.
        sure = _best_variants(keep(sure, "license-windows"), alike, 2 * max(widths))
    return sure.groupBy("doc_id", "digest", "license").agg(
        F.max("share").alias("containment"), F.min("begin").alias("first_word"), F.count_distinct("begin").alias("windows")
    ).drop("digest")


def _best_variants(sure: DataFrame, alike: list[tuple[str, str]], span: int) -> DataFrame:
    """The windows that no better covered window of a variant of their template overlaps.

    Windows are joined by the cells of ``span`` shingles that they touch (two at most), so a text that repeats a notice many times
    costs in proportion to its length.
    """
    touched = F.array_distinct(F.array(*(F.floor(at / span) for at in (F.col("begin"), F.col("begin") + 2 * F.col("width") - 1))))
    others = F.create_map(*(
        part for a in sorted({a for a, _ in alike}) for part in (F.lit(a), F.array(*(F.lit(b) for x, b in alike if x == a)))
    ))
    own = sure.withColumn("cell", F.explode(touched)).withColumn("variant", F.explode(others[F.col("license")]))
    better = sure.select(
        F.col("doc_id").alias("doc"), F.col("digest").alias("text"), F.col("license").alias("other"), F.explode(touched).alias("cell_2"),
        F.col("share").alias("share_2"), F.col("begin").alias("begin_2"), F.col("width").alias("width_2"),
    )
    near = (F.col("begin_2") < F.col("begin") + 2 * F.col("width")) & (F.col("begin") < F.col("begin_2") + 2 * F.col("width_2"))
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("digest") == F.col("text"))
    met = (F.col("cell") == F.col("cell_2")) & (F.col("variant") == F.col("other")) & near & (F.col("share_2") > F.col("share"))
    names = ["doc_id", "digest", "license", "begin", "width"]
    beaten = own.join(better, same & met, "left_semi").select(*(F.col(c).alias(f"_{c}") for c in names)).distinct()
    itself = F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    for name in names[1:]:
        itself = itself & (F.col(name) == F.col(f"_{name}"))
    return sure.join(beaten, itself, "left_anti")
