"""License scans (operator 8): MinHash bands over overlapping text windows.

Shingles are five words, lower-cased and bare of punctuation. A template of n
shingles is searched in windows of W = 2 * 2**ceil(log2 n) shingles (32 at
least), half overlapping, so some window holds the whole passage. A window's
signature is its `BANDS` least distinct shingle hashes (bottom-k MinHash), each a band;
a template is retrieved when a band of the window is a band of the template.
With at least n > W/4 and four fifths of the template present, the Jaccard
similarity of window and template is J >= 0.19, and all bands miss with
probability (1 - J)**32 < 0.0012; windows of 32 shingles keep them all, so
short notices are never missed. What is retrieved is verified: the share of
the template's shingles, compared as text, that stand around the window.
Versions of one license share most shingles: a match is dropped if a better
one of its family overlaps it and holds all shingles that it rests on, so a
notice beside that of another version is still reported.

Built-in functions only: one projection over the texts, in which a row without
a band hit (nearly all) yields an empty array; hits are verified as rows of
their own, each window's words once. Templates are constants, so the broadcast side is bounded.

Defined results: a null text counts as empty; a null doc_id is kept; repeated
rows each get their own row; texts of under five words match nothing; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import materialize, text_or_empty

WORDS, BANDS, CONTAINMENT, SHORTEST_WINDOW = 5, 32, 0.8, 32

#: Public license notices, by SPDX-like name. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met""",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MIT": "Released under the MIT License",
    "MIT-permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


def templates_from(spark: SparkSession, folder: str) -> dict[str, str]:
    """Further templates: the text files of a folder, whole, by file name without its ending."""
    rows = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.(?:txt|md))?$", 1).alias("name"), "value").collect()
    return {r["name"]: r["value"] for r in rows}


_HITS = "array<struct<win:int,at:int,bands:array<bigint>,near:array<string>>>"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hashes(words: Column) -> Column:
    n = F.size(words) - WORDS
    each = F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WORDS)]))
    return F.when(n >= 0, each).otherwise(F.array().cast("array<bigint>"))


def _shingles(words: Column) -> Column:
    n = F.size(words) - WORDS
    each = F.transform(F.sequence(F.lit(0), n), lambda i: F.array_join(F.slice(words, i + 1, WORDS), " "))
    return F.when(n >= 0, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))


def window_of(n: int) -> int:
    """Shingles in the windows in which a template of n shingles is searched."""
    return max(SHORTEST_WINDOW, 2 * 2 ** (max(n, 1) - 1).bit_length())


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> list[tuple[str, int, list[int], list[str]]]:
    """(name, window, bands, shingles as text) of each template; one row a template goes to the driver."""
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string").withColumn("w", _words(F.col("text")))
    rows = rows.select("name", F.slice(F.array_sort(F.array_distinct(_hashes(F.col("w")))), 1, BANDS).alias("bands"), _shingles(F.col("w")).alias("shingles"))
    return [(r["name"], window_of(len(r["shingles"])), list(r["bands"]), list(r["shingles"])) for r in rows.collect() if r["shingles"]]


def _hits(words: Column, hashes: Column, window: int, bands: list[int]) -> Column:
    """Windows that share a band with a template, the bands, and the words around them."""
    none, step = F.array().cast(_HITS), window // 2

    def hit(at: Column, shared: Column) -> Column:
        begin = F.greatest(at - window, F.lit(0))
        return F.struct(F.lit(window).alias("win"), at.alias("at"), shared.alias("bands"), F.slice(words, begin + 1, 3 * window + WORDS).alias("near"))

    starts = F.sequence(F.lit(0), F.size(hashes) - 1, F.lit(step))
    if window <= BANDS:  # the signature of such a window is all its shingles
        signature = lambda s: F.slice(hashes, s + 1, window)
    else:
        signature = lambda s: F.slice(F.sort_array(F.array_distinct(F.slice(hashes, s + 1, window))), 1, BANDS)
    shared = F.transform(starts, lambda s: F.struct(s.alias("s"), F.array_distinct(F.filter(signature(s), lambda h: h.isin(bands))).alias("b")))
    found = F.transform(F.filter(shared, lambda x: F.size(x["b"]) > 0), lambda x: hit(x["s"], x["b"]))
    return F.when(F.size(hashes) > 0, found).otherwise(none)


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_licenses, licenses: `name:percent` of each template found, by name."""
    spark = docs.sparkSession
    known = template_table(spark, templates)
    by_window: dict[int, list[int]] = {}
    for _, window, bands, _ in known:
        by_window.setdefault(window, []).extend(bands)
    out = docs.select("doc_id", text_or_empty().alias("text")).withColumn("w", _words(F.col("text")))
    out = out.withColumn("h", _hashes(F.col("w")))
    found = [_hits(F.col("w"), F.col("h"), window, sorted(set(bands))) for window, bands in sorted(by_window.items())]
    out = out.withColumn("hits", F.concat(*found) if found else F.array().cast(_HITS))
    digest = materialize(out.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "hits"), "hits")

    bands = spark.createDataFrame([(n, w, b, s) for n, w, bs, s in known for b in bs], "name string, win int, band bigint, shingles array<string>")
    windows = materialize(digest.where(F.size("hits") > 0).select("rid", F.explode("hits").alias("x")).select("rid", "x.*"), "windows")
    pairs = windows.select("rid", "win", "at", "near", F.explode("bands").alias("band")).join(F.broadcast(bands), ["win", "band"]).dropDuplicates(["rid", "name", "at"])
    got = F.array_intersect(_shingles(F.col("near")), F.col("shingles"))
    family = F.regexp_extract("name", r"^(.*?)(?:-[0-9].*)?$", 1)
    matched = pairs.select("rid", "name", "at", "win", "shingles", got.alias("got"), family.alias("family")).withColumn("share", F.size("got") / F.size("shingles"))
    matched = materialize(matched.where(F.col("share") >= CONTAINMENT), "matched")
    # An interval join on bins of the windows; the number of templates bounds what shares a bin.
    bin_ = F.explode(F.sequence(F.floor(F.col("at") / SHORTEST_WINDOW), F.floor((F.col("at") + F.col("win")) / SHORTEST_WINDOW)))
    better = matched.select("rid", "family", F.col("at").alias("b_at"), F.col("win").alias("b_win"), F.col("share").alias("b_share"), F.col("shingles").alias("b_shingles"), bin_.alias("bin"))
    near = matched.select("rid", "family", "name", "at", "win", "share", "got", bin_.alias("bin")).join(better, ["rid", "family", "bin"])
    beaten = (F.col("b_share") > F.col("share")) & (F.col("b_at") < F.col("at") + F.col("win")) & (F.col("at") < F.col("b_at") + F.col("b_win")) & (F.size(F.array_except("got", "b_shingles")) == 0)
    kept = matched.join(near.where(beaten).select("rid", "name", "at").distinct(), ["rid", "name", "at"], "left_anti")
    best = kept.groupBy("rid", "name").agg(F.max("share").alias("share"))
    listed = best.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("name", "share"))).alias("found"))
    out = digest.select("rid", "doc_id").join(listed, "rid", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<name:string,share:double>>")))
    text = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["name"], F.floor(100 * x["share"]).cast("string"))), ",")
    return out.select("doc_id", F.size("found").cast("long").alias("n_licenses"), text.alias("licenses"))
