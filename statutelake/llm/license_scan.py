"""License scan: MinHash bands over overlapping windows, then exact shingle containment.

Only windows that hold an anchor word can hold enough of a template: anchors are
rare words chosen so that fewer of a template's five-word runs lack one than a
window must hold. Windows overlap so far that a passage as long as a template lies
whole in one. Each band takes a hash of its own of every run of a window and keeps
the smallest; a window is compared with the templates that have the same smallest
hash in some band. The number of bands follows from the lowest Jaccard value that
a window with enough runs can have, so that one is missed with a chance of MISS at
most. The templates' runs are then counted in the window itself.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import columns, written

WIDTH, PERCENT = 5, 80
#: Bytes of templates, over all bands, that are broadcast at most.
BROADCAST_BYTES = 32 << 20
#: Chance that no band retrieves a template for a window that holds enough of it.
MISS = 1e-7

#: Short notices of widely used licences (fixed wordings).
TEMPLATES = (
    ("Apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0-line", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("GPL-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT-line", "Released under the MIT License."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
#: Words that are never chosen as anchors unless a template has no others.
COMMON = frozenset(
    "a above all and any are as at be but by can can't copy files following for forms form free from general has hope if in is it its "
    "law may met may not of on or other person possible program public purpose source that the their this to under use used useful v "
    "version will with without work works you your 0 1 2 3 4".split()
)


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def runs_of(words: list[str]) -> list[tuple[str, ...]]:
    """Distinct runs of WIDTH words."""
    return list(dict.fromkeys(tuple(words[i : i + WIDTH]) for i in range(len(words) - WIDTH + 1)))


def least_held(runs: int, percent: int = PERCENT) -> int:
    """Runs that a window must hold, of a template with so many."""
    return max(1, -(-percent * runs // 100))


def anchors(templates: list[list[str]], percent: int = PERCENT) -> list[str]:
    """Words of which any ``least_held`` runs of a template hold one: of its runs fewer may lack them all."""
    left = [(least_held(len(runs), percent), [set(r) for r in runs]) for runs in map(runs_of, templates)]
    chosen: set[str] = set()
    while left := [(held, [r for r in runs if not r & chosen]) for held, runs in left]:
        left = [(held, runs) for held, runs in left if len(runs) >= held]
        if not left:
            break
        counts: dict[str, int] = {}
        for _, runs in left:
            rare = set().union(*runs) - COMMON
            for run in runs:
                for word in run & rare if rare else run:
                    counts[word] = counts.get(word, 0) + 1
        chosen.add(max(counts, key=lambda w: (counts[w], len(w), w)))
    return sorted(chosen)


def bands(fewest: int, most: int, window: int, percent: int = PERCENT) -> int:
    """Bands of one row that retrieve templates of ``fewest`` to ``most`` runs from windows of ``window`` words."""
    full = window - WIDTH + 1
    lowest = min(held / (n + full - held) for n in range(fewest, most + 1) for held in [min(least_held(n, percent), full)])
    return 1 if lowest >= 1 else math.ceil(math.log(MISS) / math.log(1 - lowest))


def size_classes(lengths: list[int]) -> list[tuple[int, int, int, int]]:
    """(least words, most words, window, stride) of classes with a ratio of 1.5 that hold some template."""
    out, low = [], WIDTH
    while low <= max(lengths, default=0):
        high = max(low, low * 3 // 2 - (low * 3 // 2 > low + 1))
        if any(low <= n <= high for n in lengths):
            stride = max(1, high // 2)
            out.append((low, high, high + stride, stride))
        low = high + 1
    return out


def _shingles(words: Column) -> Column:
    """Distinct runs of WIDTH words of an array."""
    starts = F.sequence(F.lit(1), F.size(words) - (WIDTH - 1))
    runs = F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i, WIDTH)))
    return F.when(F.size(words) >= WIDTH, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def _windows(words: Column, places: Column, number: int, window: int, stride: int) -> Column:
    """(size_class, start_word, window) of the windows of one class that hold an anchor."""

    def around(place: Column) -> Column:
        first = F.greatest(F.lit(0), F.floor((place - window) / stride) + 1)
        return F.sequence(first.cast("int"), F.floor(place / stride).cast("int"))

    def cut(k: Column) -> Column:
        return F.struct(F.lit(number).alias("size_class"), (k * stride).alias("start_word"), F.slice(words, k * stride + 1, window).alias("window"))

    return F.transform(F.array_distinct(F.flatten(F.transform(places, around))), cut)


def _smallest(runs: Column, count: int) -> Column:
    """(band, value): the smallest hash of the runs in each band; every band hashes the runs anew."""
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(runs, lambda run: F.xxhash64(run, b))).alias("value")))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, size_class, shingles) of the templates of at least WIDTH words."""
    split = [(name, words_of(text)) for name, text in templates]
    classes = size_classes([len(w) for _, w in split])
    rows = []
    for name, words in split:
        for i, (low, high, _, _) in enumerate(classes):
            if low <= len(words) <= high:
                rows.append((name, i, [" ".join(r) for r in runs_of(words)]))
    return spark.createDataFrame(rows, "template string, size_class int, shingles array<string>")


def scan(documents: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, template, containment, start_word): the templates that each whole text holds.

    Words are runs of a-z and 0-9 of the lower-cased text. A text holds a
    template if one of its windows has at least ``percent`` hundredths of the
    template's distinct five-word runs; ``containment`` is the largest share and
    ``start_word`` the first word (from 0) of the first such window. One row per
    document and template. Templates of fewer than five words are left out. Null
    and empty texts hold nothing; rows with a null id count as one document;
    other columns are dropped.
    """
    spark = documents.sparkSession
    split = [words_of(text) for _, text in templates]
    classes, chosen = size_classes([len(w) for w in split]), anchors([w for w in split if len(w) >= WIDTH], percent)
    if not classes:
        return spark.createDataFrame([], "doc_id long, template string, containment double, start_word int")
    docs = columns(documents, "doc_id", "text").toDF("doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text")).filter(
        F.col("text").rlike(rf"(?<![a-z0-9])(?:{'|'.join(chosen)})(?![a-z0-9])")
    )
    docs = docs.select("doc_id", F.array_remove(F.split("text", "[^a-z0-9]+"), "").alias("words"))
    words = F.col("words")
    places = F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(chosen), i).otherwise(F.lit(-1))), lambda i: i >= 0
    )
    # Few texts hold an anchor; they are written once and read by each class.
    docs = written(docs.select("doc_id", "words", places.alias("places")), "anchored")
    table, hits = template_table(spark, templates), None
    for i, (low, high, window, stride) in enumerate(classes):
        runs = [len(runs_of(w)) for w in split if low <= len(w) <= high]
        count = bands(min(runs), max(runs), window, percent)
        rows = docs.select("doc_id", F.explode(_windows(words, F.col("places"), i, window, stride)).alias("w")).select("doc_id", "w.*")
        rows = rows.select("doc_id", "start_word", _shingles(F.col("window")).alias("found")).filter(F.size("found") > 0)
        keyed = rows.select("doc_id", "start_word", "found", F.explode(_smallest(F.col("found"), count)).alias("k"))
        own = table.filter(F.col("size_class") == i)
        index = own.select("template", "shingles", F.explode(_smallest(F.col("shingles"), count)).alias("k"))
        # Each band has the template's text once; what is too large to broadcast is joined by shuffle.
        if count * sum(WIDTH * len(text.encode()) for _, text in templates if low <= len(words_of(text)) <= high) <= BROADCAST_BYTES:
            index = F.broadcast(index)
        met = keyed.join(index, "k")
        share = F.size(F.array_intersect("found", "shingles")) / F.size("shingles")
        part = met.select("doc_id", "template", "start_word", share.alias("containment")).filter(F.col("containment") * 100 >= percent - 1e-9)
        hits = part if hits is None else hits.unionByName(part)
    best = hits.groupBy("doc_id", "template").agg(
        F.max("containment").alias("containment"), F.min_by("start_word", F.struct(-F.col("containment"), F.col("start_word"))).alias("start_word")
    )
    return best
