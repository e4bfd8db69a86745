"""Licence scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance along directories.

Only what lies around lines with a licence cue (and whole licence files with one) becomes term vectors, so what is shuffled is a
small share of the texts.  Headers are often wrapped, so each cue line counts alone and with its next lines, from itself or from
the line before; the best cosine of a file decides.  Files without a verdict of their own take that of the nearest ancestor
directory with a licence file: directories, not files, are expanded into their ancestors, of any depth, and joined by path.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import checkpointed, quoted, text_of, without, written

#: Templates: a licence and a text that announces it.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)
CUES = r"(?i)licen[sc]e|copyright|permission is hereby|redistribution|public domain|spdx"
LICENSE_FILES = r"(?i)^(?:licen[sc]e|copying|notice|unlicense)(?:[.][a-z]+)?$"
#: Terms: letters and digits, with inner dots (versions) kept.
TERM_GAP = r"[^a-z0-9.]+|[.](?![a-z0-9])|(?<![a-z0-9])[.]"
MIN_COSINE = 0.6
#: First line (from the cue line) and number of lines of the windows around a cue.
WINDOWS = ((0, 1), (0, 2), (0, 4), (-1, 2), (-1, 4))
#: Characters of templates: they are a parameter, and their terms are broadcast.
TEMPLATE_CHARS = 8 << 20
#: Terms of two rows or more up to this many are broadcast (a few MB); more are joined by a shuffle, with AQE's skew join.
BROADCAST_TERMS = 100_000


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TERM_GAP), lambda t: t != "")


def template_terms(text: str) -> list[str]:
    return [t for t in re.split(TERM_GAP, text.lower()) if t]


def _vectors(spark: SparkSession, templates) -> DataFrame:
    """(template, licence, term, tf)."""
    rows, size = [], 0
    for n, (name, text) in enumerate(templates):
        size += len(text)
        if size > TEMPLATE_CHARS:
            raise ValueError(f"the templates have more than {TEMPLATE_CHARS} characters")
        terms = template_terms(text)
        rows += [(n, name, t, terms.count(t)) for t in sorted(set(terms))]
    return spark.createDataFrame(rows, "template int, licence string, term string, tf long")


def _windows(text: Column) -> Column:
    """The distinct windows of lines around the lines with a cue."""
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    cued = F.transform(F.filter(lines, lambda x: x["line"].rlike(CUES)), lambda x: x["i"])
    # Lines count from 1 in a slice; a window that would begin before the text begins with it.
    around = lambda i: F.array(*[F.struct(F.greatest(i + 1 + at, F.lit(1)).alias("at"), F.lit(n).alias("n")) for at, n in WINDOWS])
    places = F.array_distinct(F.flatten(F.transform(cued, around)))
    return F.array_distinct(F.transform(places, lambda w: F.array_join(F.slice(F.split(text, "\n"), w["at"], w["n"]), "\n")))


def scan_licenses(
    files: DataFrame, path_col: str = "path", text_col: str = "text", templates=TEMPLATES, min_cosine: float = MIN_COSINE, carry: tuple[str, ...] | None = None
) -> DataFrame:
    """The columns ``carry`` (all but the text) of ``files`` plus license, cosine, via and from_dir.

    ``via`` is ``header`` or ``file`` for a verdict on the row's own text (a file if its name is a licence file's), else
    ``inherited`` with the directory it comes from, else null like all four.  The best cosine of the text's windows (and of a
    licence file's whole text) decides, then the smaller licence name; in a directory with several licence files likewise.
    Inverse document frequencies count all rows with a cue, and in them what was compared.  A null or empty text has no verdict
    of its own; a null path inherits nothing.  Texts may be long and paths deep.  Repeated rows stay and agree.  Input columns
    named like a result (in any case) are replaced.  An empty table gives no rows.
    """
    spark = files.sparkSession
    names = list(carry) if carry is not None else [c for c in without(files, "license", "cosine", "via", "from_dir").columns if c != text_col]
    text, path = text_of(F.col(quoted(text_col))), F.col(quoted(path_col))
    name = F.regexp_extract(F.coalesce(path, F.lit("")), r"(?s)([^/]*)$", 1)
    is_file = name.rlike(LICENSE_FILES)
    compared = F.array_union(F.when(is_file, F.array(text)).otherwise(F.array().cast("array<string>")), _windows(text))
    slim = written(
        files.select(
            *[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)],
            F.monotonically_increasing_id().alias("row"),
            is_file.alias("is_file"),
            F.when(path.isNotNull(), F.regexp_replace(path, r"(?s)/?[^/]*$", "")).alias("dir"),
            F.when(text.rlike(CUES), F.transform(compared, _terms)).alias("units"),
        ),
        "licenses",
    )
    # Term counts of what is compared; idf of terms over the rows with a cue.
    exploded = slim.where("units is not null").select("row", F.posexplode("units").alias("unit_no", "terms")).select("row", "unit_no", F.explode("terms").alias("term"))
    counts = written(exploded.groupBy("row", "unit_no", "term").agg(F.count(F.lit(1)).alias("tf")), "license-terms")
    n_rows = slim.where("units is not null").count()
    idf_of = lambda df: F.log((F.lit(1.0) + n_rows) / (1 + df)) + 1
    # Terms of one row, the most by far, need no table.
    often = counts.select("row", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    known = written(often.select("term", idf_of(F.col("df")).alias("idf")), "license-idf")
    few = F.broadcast(known) if known.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else known
    mine = counts.join(few, "term", "left").select("row", "unit_no", "term", (F.col("tf") * F.coalesce("idf", idf_of(F.lit(1)))).alias("w"))
    # Templates: a bounded table, so their terms' frequencies are one too.
    vectors = _vectors(spark, templates)
    found = counts.join(F.broadcast(vectors.select("term").distinct()), "term").select("row", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = checkpointed(
        vectors.join(F.broadcast(found), "term", "left").select("template", "licence", "term", (F.col("tf") * idf_of(F.coalesce("df", F.lit(0)))).alias("w"))
    )
    lengths = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    unit = weighted.join(F.broadcast(lengths), "template").select("term", "template", "licence", (F.col("w") / F.col("length")).alias("unit"))
    norms = mine.groupBy("row", "unit_no").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = mine.join(F.broadcast(unit), "term").groupBy("row", "unit_no", "template", "licence").agg(F.sum(F.col("w") * F.col("unit")).alias("dot"))
    scored = dots.join(norms, ["row", "unit_no"]).select("row", "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine")).where(F.col("cosine") >= min_cosine)
    best = F.min(F.struct((-F.col("cosine")).alias("minus"), "licence")).alias("best")
    own = checkpointed(scored.groupBy("row").agg(best).select("row", (-F.col("best.minus")).alias("cosine"), F.col("best.licence").alias("licence")))

    judged = slim.drop("units").join(own, "row", "left")
    in_dir = checkpointed(
        judged.where("is_file and licence is not null and dir is not null").groupBy("dir").agg(best)
        .select(F.col("dir").alias("from_dir"), F.xxhash64("dir").alias("digest"), (-F.col("best.minus")).alias("dir_cosine"), F.col("best.licence").alias("dir_licence"))
    )
    # Distinct directories and the digests of their ancestors, so that deep paths are not written out for each level; the join
    # checks the path itself.  The root is the empty path; the longest ancestor counts.
    parts = F.split("dir", "/")
    levels = F.sequence(F.lit(0), F.when(F.col("dir") == "", F.lit(0)).otherwise(F.size(parts)))
    ancestors = F.transform(levels, lambda n: F.xxhash64(F.array_join(F.slice(parts, F.lit(1), n), "/")))
    dirs = slim.where("dir is not null").select("dir").distinct().select("dir", F.explode(ancestors).alias("digest"))
    inside = (F.col("from_dir") == "") | (F.col("dir") == F.col("from_dir")) | F.startswith(F.col("dir"), F.concat(F.col("from_dir"), F.lit("/")))
    above = dirs.join(in_dir, "digest").where(inside)
    nearest = above.groupBy("dir").agg(F.max_by(F.struct("from_dir", "dir_cosine", "dir_licence"), F.length("from_dir")).alias("near"))
    # Many files to one directory: a hot directory is split by AQE's skew join.
    joined = judged.join(nearest, "dir", "left")
    mine_known, near_known = F.col("licence").isNotNull(), F.col("near").isNotNull()
    return joined.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
        F.coalesce("licence", "near.dir_licence").alias("license"),
        F.coalesce("cosine", "near.dir_cosine").alias("cosine"),
        F.when(mine_known, F.when(F.col("is_file"), "file").otherwise("header")).when(near_known, "inherited").alias("via"),
        F.when(~mine_known, F.col("near.from_dir")).alias("from_dir"),
    )
