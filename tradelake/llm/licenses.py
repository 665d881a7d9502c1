"""License scan: MinHash bands over overlapping text windows, then exact shingle containment.

Texts are lower-cased and cut into words of letters and digits. A shingle is five words
in a row. Windows of six words begin at every second word, so that each shingle lies in
one of them; each window's two shingles give one minimum for each of eight hash
functions, and each minimum is a band of its own. Templates are cut into the same
windows at every word. A passage that repeats seven words or more of a template holds
a window with equal shingles and collides in every band. A template of one shingle shares
at most half of a window's, so windows that hold its shingle are candidates without a band.

A candidate is then checked exactly: the share of the template's shingles that occur in
the document near the colliding window has to reach ``least``.

Null and short texts match nothing, as do templates of under five words. Rows with the
same id are one document to this operator, and so are all rows without one. Texts of any
length are scanned whole. An empty table gives an empty result, and further columns play no
part. Everything runs on DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm.common import stored

SHINGLE = 5
BANDS = 8
LEAST = 0.8

#: Notices of public licenses (fixed values).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "isc-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}


def templates(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """``license_id, text`` of the notices to look for."""
    return spark.createDataFrame(sorted((texts or TEMPLATES).items()), "license_id string, text string")


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def once(value: Column) -> Column:
    """A value that later lambdas refer to; the generator keeps it from being computed for each element."""
    return F.explode(F.array(value))


def shingle_hashes(texts: DataFrame, key: str, found: Column) -> DataFrame:
    """``key, h``: a 64-bit hash of each five words in a row."""
    each = texts.select(key, once(F.transform(found, lambda w: F.xxhash64(w))).alias("e"))
    starts = F.sequence(F.lit(0), F.size("e") - SHINGLE)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get("e", i + k) for k in range(SHINGLE)]))
    return each.where(F.size("e") >= SHINGLE).select(key, once(hashes).alias("h"))


def band(first: Column, second: Column, number: int) -> Column:
    """Minimum of one hash function over a window's shingles; the last window may have one."""
    return F.least(F.xxhash64(first, F.lit(number)), F.xxhash64(F.coalesce(second, first), F.lit(number)))


def windows(docs: DataFrame, key: str, found: Column, stride: int) -> DataFrame:
    """``key, at, first, second``: the two shingles of each window of six words."""
    hashes = shingle_hashes(docs, key, found)
    starts = F.when(F.size("h") > 0, F.sequence(F.lit(0), F.size("h") - 1, F.lit(stride)))
    pairs = F.transform(starts, lambda i: F.struct(i.alias("at"), F.get("h", i).alias("first"), F.get("h", i + 1).alias("second")))
    return hashes.select(key, F.inline(pairs))


def scan(
    docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST
) -> DataFrame:
    """``doc_id, license_id, n_shingles, n_found, containment, position`` of every match.

    ``known`` holds ``license_id, text`` of the notices; their bands form a list of
    literals, so it has to stay small (hundreds of notices). ``position`` is the first
    word of the earliest colliding window.
    """
    spark = docs.sparkSession
    notices = stored(known.select("license_id", words(F.col("text")).alias("w")), "notices")
    bands = [band(F.col("first"), F.col("second"), n) for n in range(BANDS)]
    cut = windows(notices, "license_id", F.col("w"), 1)
    # The first shingle stands for a notice that has no other; its band has a number of its own.
    short = cut.join(cut.groupBy("license_id").agg(F.count(F.lit(1)).alias("c")).where("c = 1"), "license_id")
    of_notices = (
        cut
        .select("license_id", F.explode(F.array(*[F.struct(F.lit(n).alias("band"), b.alias("value")) for n, b in enumerate(bands)])).alias("b"))
        .select("license_id", "b.band", "b.value")
        .unionByName(short.select("license_id", F.lit(BANDS).alias("band"), F.col("first").alias("value")))
        .distinct()
    )
    listed = of_notices.collect()  # a few values for each word of the notices
    # Of a document's window the two shingles themselves are looked up beside its bands.
    looked = [*enumerate(bands), (BANDS, F.col("first")), (BANDS, F.coalesce("second", "first"))]
    values = [sorted({r.value for r in listed if r.band == n}) for n in range(BANDS + 1)]
    hits = [b.isin(values[n]) if values[n] else F.lit(False) for n, b in looked]
    any_hit = hits[0]
    for hit in hits[1:]:
        any_hit = any_hit | hit
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = windows(rows, "doc_id", words(F.col("text")), 2).where(any_hit)
    near = stored(
        found.select("doc_id", "at", F.explode(F.array(*[F.struct(F.lit(n).alias("band"), b.alias("value")) for n, b in looked])).alias("b"))
        .select("doc_id", "at", "b.band", "b.value")
        .join(F.broadcast(spark.createDataFrame(listed, of_notices.schema)), ["band", "value"])
        .select("doc_id", "license_id", "at")
        .distinct(),
        "license-candidates",
    )
    # Exact check on the words themselves, for candidate documents only.
    asked = near.groupBy("doc_id", "license_id").agg(F.sort_array(F.collect_set("at")).alias("places"))
    shingled = notices.select(
        F.col("license_id").alias("lid"),
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - (SHINGLE - 1)), lambda i: F.concat_ws(" ", F.slice("w", i, SHINGLE)))).alias("wanted"),
        F.size("w").alias("length"),
    ).where(F.size("w") >= SHINGLE)
    asked = asked.withColumnRenamed("doc_id", "asked")
    marked = rows.join(asked, F.col("doc_id").eqNullSafe(F.col("asked"))).select("doc_id", "license_id", "places", once(words(F.col("text"))).alias("w"))
    reach = F.col("length") * 2
    share = F.transform(
        "places",
        lambda at: F.struct(
            F.size(F.array_intersect(
                "wanted",
                F.transform(
                    F.sequence(F.greatest(at - reach, F.lit(0)) + 1, F.greatest(F.least(at + reach, F.size("w") - SHINGLE + 1), F.greatest(at - reach, F.lit(0)) + 1)),
                    lambda i: F.concat_ws(" ", F.slice("w", i, SHINGLE)),
                ),
            )).alias("n_found"),
            (-at).alias("order"),
        ),
    )
    best = marked.join(F.broadcast(shingled), F.col("license_id") == F.col("lid")).select(
        "doc_id", "license_id", F.size("wanted").cast("long").alias("n_shingles"), F.array_max(share).alias("best")
    )
    return (
        best.groupBy("doc_id", "license_id", "n_shingles")
        .agg(F.max("best").alias("best"))
        .select(
            "doc_id", "license_id", "n_shingles", F.col("best.n_found").cast("long").alias("n_found"),
            (F.col("best.n_found") / F.col("n_shingles")).alias("containment"),
            (-F.col("best.order")).cast("long").alias("position"),
        )
        .where(F.col("containment") >= least)
    )
