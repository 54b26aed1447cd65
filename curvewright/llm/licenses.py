"""Operator 9: license notices in texts by MinHash bands over windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvewright.llm.common import ascii_lower, query, stored, table

#: License notices as they stand in documents and source files: (id, SPDX name, text). Fixed values.
TEMPLATES = (
    ("mit-line", "MIT", "Released under the MIT License."),
    ("mit-line-2", "MIT", "Licensed under the MIT License."),
    ("mit-notice", "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
     "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software."),
    ("apache-line", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-notice", "Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
     "either express or implied."),
    ("gpl3-line", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3-notice", "GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
     "of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("gpl2-notice", "GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms "
     "of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
     "or (at your option) any later version."),
    ("agpl3-notice", "AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
     "of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("lgpl2.1-notice", "LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
     "the License, or (at your option) any later version."),
    ("lgpl3-notice", "LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
     "of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("isc-notice", "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
     "copies."),
    ("unlicense-notice", "Unlicense", "This is free and unencumbered software released into the public domain. Anyone is "
     "free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
     "compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("bsd-line", "BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the "
     "LICENSE file."),
    ("bsd-notice", "BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met: Redistributions of source code must retain the above "
     "copyright notice, this list of conditions and the following disclaimer."),
    ("mpl2-notice", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
     "a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by-nc-line", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-line", "CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-notice", "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("all-rights", "proprietary", "All rights reserved. No part of this publication may be reproduced without permission."),
)

#: Words of a shingle; a notice of fewer words is one shingle.
SHINGLE = 5
#: The share of a notice's shingles that a window must hold.
CONTAINED = 0.8
#: Bands of one MinHash row each. A window narrowed to the shingles of notices that is
#: similar to a notice to at least 0.4 agrees in a band with probability 0.4, so none of
#: 32 agrees with probability 0.6^32 < 1e-7. (A window of up to twice the notice's
#: length holds at least 0.8 of its shingles; its other shingles, at most as many as
#: the notice has, may be those of other notices: 0.8 / (0.2 + 0.8 + 1) = 0.4.)
BANDS = 32
_WORDS = r"[a-z0-9.\-/:]*[a-z0-9]"


def _shingled(texts: DataFrame, keep: list[str], shingle: int) -> DataFrame:
    """Columns ``keep`` plus (pos, h) of every run of ``shingle`` words; of all words if fewer."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(_WORDS), F.lit(0))
    last = F.size("__hashes") - shingle
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice("__hashes", i + 1, F.lit(shingle))).alias("h")),
    )
    hashed = texts.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias("__hashes"))
    return hashed.where(F.size("__hashes") > 0).select(*keep, F.inline(runs))


def templates(spark: SparkSession, notices=TEMPLATES, shingle: int = SHINGLE) -> DataFrame:
    """(template, license, h, turn, n): the distinct shingles of every notice, n of them.

    turn is a shingle's place in the notice, null if it has several.
    """
    frame = spark.createDataFrame(list(notices), "template string, license string, text string")
    exploded = (
        _shingled(frame, ["template", "license"], shingle)
        .groupBy("template", "license", "h")
        .agg(F.when(F.count(F.lit(1)) == 1, F.min("pos")).alias("turn"))
    )
    return exploded.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("template")))


def _bands(hashes: Column, bands: int) -> Column:
    """One (band, value) for each band: the least shingle hash under the band's seed."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.struct(b.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b))).alias("value")),
    )


def scan(
    docs: DataFrame, notices=TEMPLATES, shingle: int = SHINGLE, contained: float = CONTAINED, bands: int = BANDS
) -> DataFrame:
    """One row per notice found: row key, template, license, start (word), containment.

    ``docs`` has (key, text). Texts are cut into windows of twice a notice's
    length (lengths in powers of two) that overlap by half, so every notice lies
    whole in a window. Only shingles that some notice has can agree with one, so
    the others go first, by a join with the notices' shingles; then windows are
    signed, retrieve notices by equal bands, and are kept if they hold at least
    ``contained`` of a notice's distinct shingles, counted exactly.

    Finds are the occurrences in these windows: the notice's shingles by
    position, cut where their order starts again. Where the words are in another
    order, so that no such stretch holds enough, windows without a half in common
    are the finds.

    The notices are a fixed list in memory: that bounds what is broadcast.
    """
    spark = docs.sparkSession
    known = stored(templates(spark, notices, shingle), "notice-shingles")
    sizes = known.select("template", "license", "n").distinct()
    # Window lengths in shingles: the power of two at or above twice a notice's.
    width = F.pow(F.lit(2), F.ceil(F.log2(2 * F.greatest(F.col("n"), F.lit(1))))).cast("int")
    widths = sorted(r["w"] for r in sizes.select(width.alias("w")).distinct().collect())  # at most one per power of two
    vocabulary = F.broadcast(known.select("h").distinct())
    placed = _shingled(docs, ["key"], shingle).join(vocabulary, "h")
    halves = F.array(*[F.struct(F.lit(w).alias("w"), F.expr(f"cast(pos div {w // 2} as int)").alias("half")) for w in widths])
    windows = (
        placed.select("key", "pos", "h", F.explode(halves).alias("x"))
        # A shingle lies in the window that begins with its half and in the one before.
        .select("key", "h", "pos", F.col("x.w").alias("w"), F.explode(F.array(F.col("x.half"), F.col("x.half") - 1)).alias("at"))
        .where("at >= 0")
        .groupBy("key", "w", "at")
        # A set: all copies of a text have one key, and their shingles are combined before they move.
        .agg(F.collect_set(F.struct("pos", "h")).alias("items"))  # at most w shingles
        .withColumn("hs", F.array_distinct("items.h"))
    )
    signed = windows.select("*", F.explode(_bands(F.col("hs"), bands)).alias("b")).select(
        "key", "w", "at", "hs", "items", "b.band", "b.value"
    )
    notice = known.withColumn("w", width).groupBy("template", "license", "w", "n").agg(F.collect_set("h").alias("ts"))
    signs = notice.select("*", F.explode(_bands(F.col("ts"), bands)).alias("b")).select(
        "template", "license", "w", "n", "ts", "b.band", "b.value"
    )
    share = F.size(F.array_intersect("hs", "ts")) / F.col("n")
    full = stored(
        signed.join(F.broadcast(signs), ["w", "band", "value"])
        .withColumn("containment", share)
        .where(F.col("containment") >= contained)
        .select("key", "template", "license", "n", "w", "at", "containment", "items")
        .dropDuplicates(["key", "template", "at"]),
        "license-windows",
    )
    items = full.select("key", "template", "license", "n", "w", F.explode("items").alias("x"))
    items = items.select("key", "template", "license", "n", "w", "x.pos", "x.h").distinct()
    items = items.join(F.broadcast(known.select("template", "h", "turn")), ["template", "h"])
    along = Window.partitionBy("key", "template").orderBy("pos")
    before = F.last("turn", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    again = F.coalesce(F.col("turn") <= before, F.lit(False)) | (F.col("pos") - F.lag("pos", 1).over(along) > F.col("w"))
    in_order = (
        items.withColumn("again", F.coalesce(again, F.lit(False)).cast("int"))
        .withColumn("run", F.sum("again").over(along))
        .groupBy("key", "template", "license", "n", "run")
        .agg(F.min("pos").alias("start"), F.max("pos").alias("end"), F.count_distinct("h").alias("held"))
        .withColumn("containment", F.col("held") / F.col("n"))
        .where(F.col("containment") >= contained)
        .select("key", "template", "license", "start", "end", "containment")
    )
    in_order = stored(in_order, "license-runs")
    # The windows that no such find touches.
    half = F.expr("w div 2")
    spans = full.withColumn("from", F.col("at") * half).withColumn("to", (F.col("at") + 2) * half - 1)
    touched = in_order.join(full.select("key", "template", "w").distinct(), ["key", "template"])
    touched = touched.select("key", "template", F.explode(F.sequence(F.expr("start div (w div 2)"), F.expr("end div (w div 2)"))).alias("h"))
    touched = touched.select("key", "template", F.explode(F.array(F.col("h"), F.col("h") - 1)).alias("at")).distinct()
    own = F.array_sort(
        F.transform(
            F.filter("items", lambda x: F.array_contains("ts", x["h"])), lambda x: x["pos"]
        )
    )
    rest = (
        spans.join(touched, ["key", "template", "at"], "left_anti")
        .join(F.broadcast(notice.select("template", "ts")), "template")
        .withColumn("own", own)
        .withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy("key", "template").orderBy("at")))
        .withColumn("r", F.row_number().over(Window.partitionBy("key", "template", "run").orderBy("at")))
        .where("r % 2 = 1")
        .select(
            "key", "template", "license", F.element_at("own", 1).alias("start"), F.element_at("own", -1).alias("end"), "containment"
        )
    )
    finds = stored(in_order.unionByName(rest), "license-finds")
    # Of notices that cover the same words, half of the shorter find at least, the one held best stays.
    wide = widths[-1] if widths else 1
    celled = finds.withColumn("cell", F.explode(F.sequence(F.expr(f"start div {wide}"), F.expr(f"end div {wide}"))))
    a, b = celled.alias("a"), celled.alias("b")
    common = F.least("a.end", "b.end") - F.greatest("a.start", "b.start") + 1
    shorter = F.least(F.expr("a.end - a.start"), F.expr("b.end - b.start")) + 1
    worse = a.join(
        b,
        (F.col("a.key") == F.col("b.key")) & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.template") != F.col("b.template")) & (F.col("b.containment") > F.col("a.containment"))
        & (2 * common >= shorter),
    )
    worse = worse.select("a.key", "a.template", "a.start").distinct()
    return finds.join(worse, ["key", "template", "start"], "left_anti").select(
        "key", "template", "license", "start", "containment"
    )


def documents_with_licenses(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_notices, licenses, templates.

    licenses are the distinct SPDX names, sorted and comma-joined; templates
    lists ``template:start:containment`` by start. Null and empty texts have
    none; repeated rows are all returned, their text scanned once; other columns
    are not read; an empty table gives an empty result.
    """
    key = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    found = scan(docs.select(key.alias("key"), "text"), **options)
    listed = stored(
        found.groupBy("key").agg(
            F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
            F.array_sort(F.collect_set(F.struct("start", "template", "containment"))).alias("finds"),
        ),
        "licenses",
    )
    text = F.transform(
        "finds", lambda x: F.concat_ws(":", x["template"], x["start"].cast("string"), F.format_number(x["containment"], 3))
    )
    return docs.select("doc_id", key.alias("key")).join(listed, "key", "left").select(
        "doc_id",
        F.coalesce(F.size("finds"), F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce(F.array_join(text, ","), F.lit("")).alias("templates"),
    )


@query("op9_licenses")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the license notices found in them."""
    return documents_with_licenses(table(spark, sf_dir, "documents"))
