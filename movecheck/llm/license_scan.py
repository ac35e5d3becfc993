"""License scan: MinHash bands over text windows, then exact containment.

Texts and templates become hashes of 5-word shingles. A template is scanned for
in windows of four shingles if it is long enough for an occurrence to hold a
whole document window, else of one: document windows overlap by half, template
windows start at every shingle. So wherever a template stands unchanged, some document window
equals some template window, and all their bands collide. Of a changed
occurrence, a pair of windows with Jaccard similarity s collides in one of b
bands of r rows with probability 1 - (1 - s^r)^b: with b = 4 and r = 1, 0.974
at s = 0.6 for one window, and an occurrence has several.

What collides is verified exactly: the share of the template's shingles that
stand in the document where the template would lie, give or take a quarter of
its length. Everything is expressions and one join with the templates' bands,
whose number is bounded by the templates; texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 4
ROWS = 1
CONTAINED = 0.8
# Window lengths in shingles, each with the step between document windows.
WINDOWS = ((1, 1), (4, 2))
WORD_BREAK = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
MAX_TEMPLATE_ROWS = 200_000

# License notices in common use.
LICENSES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case (with an empty word at a broken end)."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK)


def shingle_hashes(words: Column) -> Column:
    """Hashes of the shingles, in order; none if there are too few words."""
    n = F.size(words)
    places = F.when(n >= SHINGLE, F.sequence(F.lit(0), n - SHINGLE)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[words[i + k] for k in range(SHINGLE)]))


def with_hashes(rows: DataFrame) -> DataFrame:
    """The rows with h, the shingle hashes, instead of text."""
    split = rows.withColumn("words", words_of(F.btrim(F.col("text"), F.lit(" .\n"))))
    return split.withColumn("h", shingle_hashes(F.col("words"))).drop("text", "words")


def _mask(i: int) -> int:
    """The i-th of a fixed sequence of spread-out 64-bit numbers."""
    value = (i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    return value - (1 << 64) if value >= 1 << 63 else value


def band_keys(h: Column, place: Column, length: int, bands: int, rows: int) -> Column:
    """The keys of the window's bands: minima of differently masked hashes."""
    if length == 1:
        return F.array(h[place])
    keys = []
    for band in range(bands):
        minima = [
            F.least(*[h[place + k].bitwiseXOR(F.lit(_mask(band * rows + row))) for k in range(length)])
            for row in range(rows)
        ]
        keys.append(minima[0] if rows == 1 else F.xxhash64(*minima))
    return F.array(*[key.bitwiseXOR(F.lit(band)) for band, key in enumerate(keys)])


def _scale_of(size: Column) -> Column:
    """The number of the window length at which a template is scanned for."""
    out = F.lit(0)
    for number, (length, step) in enumerate(WINDOWS):
        if number:
            out = F.when(size >= length + step - 1, number).otherwise(out)
    return out


def _windows(h: Column, steps: Sequence[int], wanted: Column | None = None) -> Column:
    """Starts of all windows, each as start * number of scales + scale."""
    n, k = F.size(h), len(WINDOWS)
    parts = []
    for scale, ((length, _), step) in enumerate(zip(WINDOWS, steps)):
        fits = n >= length if wanted is None else (n >= length) & (wanted == scale)
        starts = F.sequence(F.lit(scale), (n - length) * k + scale, F.lit(step * k))
        parts.append(F.when(fits, starts).otherwise(F.array().cast("array<int>")))
    return F.concat(*parts)


def _banded(rows: DataFrame, bands: int, per_band: int) -> DataFrame:
    """One row per band of every window: its scale, place, key."""
    k = len(WINDOWS)
    rows = rows.withColumns({"scale": F.col("window") % k, "place": F.expr(f"cast(window div {k} as int)")})
    keys = None
    for scale, (length, _) in reversed(list(enumerate(WINDOWS))):
        own = band_keys(F.col("h"), F.col("place"), length, bands, per_band)
        keys = own if keys is None else F.when(F.col("scale") == scale, own).otherwise(keys)
    return rows.withColumn("key", F.explode(keys)).drop("window")


def template_bands(spark: SparkSession, templates: Sequence[tuple[str, str]], bands: int, rows: int) -> DataFrame:
    """License, its shingles and the bands of its windows."""
    known = with_hashes(spark.createDataFrame(list(templates), "license string, text string"))
    known = known.filter(F.size("h") > 0).withColumn("own", _scale_of(F.size("h")))
    windows = known.withColumn("window", F.explode(_windows(F.col("h"), [1] * len(WINDOWS), F.col("own"))))
    return _banded(windows, bands, rows).select(
        "license", F.col("h").alias("wanted"), F.col("scale").alias("own_scale"),
        F.col("place").alias("offset"), F.col("key").alias("own_key"),
    ).distinct()


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = LICENSES,
    bands: int = BANDS,
    rows: int = ROWS,
    contained: float = CONTAINED,
) -> DataFrame:
    """doc_id, license, containment: the licenses found in each document.

    Words are runs of letters and digits, in lower case. ``containment`` is the
    largest share of a template's shingles found at one place. Null, empty and short texts match nothing. Rows with equal doc_id count as one document.
    Templates of fewer than five words are ignored. Only doc_id and text are read.
    """
    known = template_bands(docs.sparkSession, templates, bands, rows)
    n_words = sum(len(text.split()) for _, text in templates)
    if n_words * bands > MAX_TEMPLATE_ROWS:
        raise ValueError("too many templates to send to every task")
    hashed = with_hashes(docs.select("doc_id", "text"))
    windows = hashed.withColumn("window", F.explode(_windows(F.col("h"), [step for _, step in WINDOWS])))
    # At most a row per band and word of the templates, checked above.
    met = _banded(windows, bands, rows).join(
        F.broadcast(known), (F.col("key") == F.col("own_key")) & (F.col("scale") == F.col("own_scale"))
    )
    size = F.size("wanted")
    begin = F.col("place") - F.col("offset")
    slack = F.ceil(size / 4).cast("int")
    first = F.greatest(begin - slack, F.lit(0))
    there = F.slice("h", first + 1, begin + size + slack - first)
    found = F.size(F.array_intersect("wanted", there)) / F.size(F.array_distinct("wanted"))
    return (
        met.select("doc_id", "license", found.alias("containment"))
        .filter(F.col("containment") >= contained)
        .groupBy("doc_id", "license")
        .agg(F.max("containment").alias("containment"))
    )
