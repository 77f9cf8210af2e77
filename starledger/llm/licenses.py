"""License scans: MinHash finds the template, exact containment confirms it.

Texts are cut into overlapping windows of a few lengths, such that every passage as long as a
template lies in a window at most half again as long as the templates of its class. A window
and a template are compared if they agree in any of ``BANDS`` min-hashes over shingles of five
words; a template is found where the window holds ``least`` of its shingles or more.

Each band is a single min-hash: for a window that holds a template, the chance to agree in one
is their Jaccard similarity, an eighth at worst (a template of one shingle among the eight of
its window), so that all bands miss it with a chance of (7/8) ** 48 = 0.0017, and far less for
longer templates. Notices that differ in a word or two may both be found in one place.

A window that holds no shingle of any template agrees with none of them in any min-hash, so
its min-hashes are not computed. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHINGLE = 5
BANDS = 48
LEAST = 0.8
#: Longest template of the shortest class, in words; each further class is twice as long.
SHORTEST = 8

#: Notices of public licenses.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "LGPL-text": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version "
        "2.1 of the License, or (at your option) any later version."
    ),
    "AGPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation; either version "
        "3 of the License, or (at your option) any later version."
    ),
    "GFDL-text": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License"
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0"
    ),
    "CDDL": (
        "The contents of this file are subject to the terms of the Common Development and Distribution License"
    ),
    "EUPL-1.2": "Licensed under the EUPL, Version 1.2",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software."
    ),
    "CC0-1.0": "has waived all copyright and related or neighboring rights to this work",
    "CC-BY-NC-4.0-text": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."
    ),
    "CC-BY-NC-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "License."
    ),
    "CC-BY-NC-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License."
    ),
}


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, id: str = "doc_id", text: str = "text",
    least: float = LEAST,
) -> DataFrame:
    """``id``, ``license``, ``containment`` and ``start`` of each template found in a row.

    ``containment`` is the share of the template's different shingles that a window holds, of
    the best window; ``start`` is its first word, the earliest if several are as good. Words
    are runs of letters and digits in lower case. Rows with equal ids and texts are reported
    once; null ids are reported as such. Null, empty and shorter texts hold nothing. Templates
    have ``SHINGLE`` words or more, else ValueError; equal ones are all reported. Templates
    are a list that the driver holds, which goes to all tasks; other columns are not read.
    """
    spark = docs.sparkSession
    known = _templates(spark, templates)
    classes = sorted({row["length"] for row in known.select("length").distinct().collect()})
    shingles = [row[0] for row in known.select(F.explode("own")).distinct().collect()]
    rows = docs.select(
        F.col(id).alias("id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"),
        _words(F.coalesce(F.col(text), F.lit(""))).alias("words"),
    )
    rows = rows.select("id", "a", "b", _shingles("words").alias("held"))
    hits = F.array_compact(F.transform("held", lambda h, i: F.when(h.isin(shingles), i)))
    rows = rows.select("id", "a", "b", "held", hits.alias("hits"))
    windows = F.concat(*(_windows(length) for length in classes))
    # Outer, as Spark would otherwise make all windows twice to leave out rows without any.
    rows = rows.select("id", "a", "b", F.explode_outer(windows).alias("w")).where("w is not null")
    rows = rows.select("id", "a", "b", "w.*").dropDuplicates(["id", "a", "b", "length", "start"])
    signed = rows.select("*", F.posexplode(_min_hashes("held")).alias("band", "least"))
    signed_known = known.select("*", F.posexplode(_min_hashes("own")).alias("band", "least"))
    near = signed.join(F.broadcast(signed_known), ["length", "band", "least"])
    share = F.size(F.array_intersect("own", "held")) / F.size("own")
    verified = near.select("id", "a", "b", "license", "start", share.alias("share")).where(
        F.col("share") >= least
    )
    best = F.max(F.struct(F.col("share"), (-F.col("start")).alias("back"))).alias("best")
    return verified.groupBy("id", "a", "b", "license").agg(best).select(
        F.col("id").alias(id), "license", F.col("best.share").alias("containment"),
        (-F.col("best.back")).cast("long").alias("start"),
    )


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def _shingles(words: str) -> Column:
    """A 64-bit hash of every ``SHINGLE`` words in a row."""
    n = F.greatest(F.size(words) - SHINGLE + 1, F.lit(0))
    shifted = F.arrays_zip(*(F.slice(words, k + 1, n).alias(f"w{k}") for k in range(SHINGLE)))
    return F.transform(shifted, lambda w: F.xxhash64(*(w[f"w{k}"] for k in range(SHINGLE))))


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``license``, ``length`` (of its class) and ``own``, its different shingles."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    rows = rows.select("license", _words(F.col("text")).alias("words"))
    short = rows.where(F.size("words") < SHINGLE).select("license").collect()
    if short:
        raise ValueError(f"templates of less than {SHINGLE} words: {[row[0] for row in short]}")
    step = F.ceil(F.log2(F.size("words") / SHORTEST))
    length = (SHORTEST * F.pow(F.lit(2.0), F.greatest(step, F.lit(0)))).cast("int")
    return rows.select("license", length.alias("length"), F.array_distinct(_shingles("words")).alias("own"))


def _windows(length: int) -> Column:
    """The windows for templates of up to ``length`` words that hold one of the ``hits``.

    They start every half ``length`` words and are half again as long as it, so any ``length``
    words in a row lie in one of them.
    """
    step, shingles = length // 2, length + length // 2 - SHINGLE + 1
    of_hit = lambda p: F.sequence(
        F.greatest(F.ceil((p - shingles + 1) / step).cast("int"), F.lit(0)), F.floor(p / step).cast("int")
    )
    numbers = F.array_distinct(F.flatten(F.transform("hits", of_hit)))
    window = lambda k: F.struct(
        F.lit(length).alias("length"), (k * step).alias("start"),
        F.slice("held", k * step + 1, shingles).alias("held"),
    )
    return F.transform(numbers, window)


def _min_hashes(shingles: str) -> Column:
    one = lambda band: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, band)))
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), one)
