"""License scans: TF-IDF cosine to templates, then directory inheritance.

Units are the lines of a file, runs of neighbouring lines (notices that are
wrapped), and a file as a whole (a licence file).  A unit and a template are
vectors of words weighted by count times inverse document frequency over the
templates; a word that no template has gets the highest weight.  A unit
matches when the cosine is at least MATCH.

Only few lines can match.  Of each template's words, those most common in
the corpus may be disregarded as long as they make up less than MATCH of its
length: a unit that shares no other word with it stays below MATCH.  The
other words are its key words.  Lines without any key word are left out on
that ground, and runs are of lines with one.  A file is taken as a whole
when a line or run of it matches or it bears the name of a licence file.  It
is a licence file when it matches as a whole, or has the name and a match.

A file without a match of its own takes the licence of the nearest
directory at or above its own that holds a licence file.  Directories are
joined, not files: each distinct one is spread over its ancestors.  The
path is DataFrame functions only; the templates are a parameter and are
broadcast up to MAX_BROADCAST words.

Defined results: null and empty texts match nothing but inherit; a null
path lies in the root; equal cosines go to the first licence by name, equal
licence files to the first path; repeated rows are judged each; an empty
table, or no templates, gives no match.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kcflow.llm.common import materialise, packed

MATCH = 0.75
MAX_BROADCAST = 200_000

#: Names of licence files, without their extension.
LICENCE_FILES = ("license", "licence", "copying", "copyright", "notice", "unlicense")

#: Notices and opening sentences of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                   "use this file except in compliance with the License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial "
                     "4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def templates(spark: SparkSession) -> DataFrame:
    """The default templates as (licence, text)."""
    return spark.createDataFrame(list(TEMPLATES), "licence string, text string")


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def template_weights(given: DataFrame) -> DataFrame:
    """(template, licence, term, idf, weight, n, length): one row per template and
    term; n: templates in all."""
    numbered = given.select(F.col("licence").cast("string").alias("licence"), "text").distinct() \
        .select(F.xxhash64("licence", "text").alias("template"), "licence",
                F.explode(terms(F.col("text"))).alias("term"))
    counts = numbered.groupBy("template", "licence", "term").agg(F.count(F.lit(1)).alias("tf"))
    n = numbered.agg(F.count_distinct("template").alias("n"))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
    weighted = counts.join(df, "term").crossJoin(F.broadcast(n)).withColumn(  # n: one row
        "idf", idf).withColumn("weight", F.col("tf") * F.col("idf"))
    square = F.col("weight") * F.col("weight")
    return weighted.select("template", "licence", "term", "idf", "weight", "n", F.sqrt(
        F.sum(square).over(Window.partitionBy("template"))).alias("length"))


def key_terms(weights: DataFrame, texts: DataFrame) -> DataFrame:
    """The key words of all templates (see the module docstring), from the number
    of texts that hold each word."""
    known = weights.select("term").distinct()
    if known.count() <= MAX_BROADCAST:
        known = F.broadcast(known)
    common = texts.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).join(
        known, "term").groupBy("term").agg(F.count(F.lit(1)).alias("texts"))
    square = F.col("weight") * F.col("weight")
    commonest = Window.partitionBy("template").orderBy(F.col("texts").desc(), "term").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = weights.join(common, "term", "left").fillna(0, ["texts"]).withColumn(
        "up_to", F.sqrt(F.sum(square).over(commonest)))
    return ranked.where(F.col("up_to") >= MATCH * F.col("length")).select("term").distinct()


UNIT = ["file", "line", "kind"]


def matches(units: DataFrame, weights: DataFrame, unknown: float) -> DataFrame:
    """Best (licence, cosine) per unit of rows (file, line, kind, terms)."""
    probe = F.broadcast(weights) if weights.count() <= MAX_BROADCAST else weights
    idf = weights.select("term", "idf").distinct()
    idf = F.broadcast(idf) if idf.count() <= MAX_BROADCAST else idf
    weighted = units.select(*UNIT, F.explode("terms").alias("term")).groupBy(*UNIT, "term").agg(
        F.count(F.lit(1)).alias("tf")).join(idf, "term", "left").withColumn(
            "w", F.col("tf") * F.coalesce("idf", F.lit(unknown))).drop("idf")
    length = weighted.groupBy(*UNIT).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    dots = weighted.join(probe, "term").groupBy(*UNIT, "template", "licence", "length").agg(
        F.sum(F.col("w") * F.col("weight")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("len") * F.col("length")), 9)
    return (dots.join(length, UNIT).withColumn("cosine", cosine)
            .where(F.col("cosine") >= MATCH)
            .groupBy(*UNIT).agg(F.max_by(
                F.struct("licence", "cosine"), F.struct("cosine", _reversed("licence"))).alias("m"))
            .select(*UNIT, "m.licence", "m.cosine"))


def _reversed(column: str) -> Column:
    """Orders names backwards inside a maximum: the first name wins a tie."""
    return F.transform(F.split(F.col(column), ""), lambda c: -F.ascii(c))


def directory(path: Column) -> Column:
    """What lies before the last slash; the root is the empty string."""
    return F.coalesce(F.regexp_replace(path, r"/?[^/]*$", ""), F.lit(""))


def scan_licences(files: DataFrame, path: str = "path", text: str = "text",
                  given: DataFrame | None = None) -> DataFrame:
    """`row` (the input row as a struct), licence, cosine, basis (`file`, `line`,
    `inherited` or null) and source (path of the file it comes from)."""
    spark = files.sparkSession
    name = F.lower(F.regexp_extract("path", r"([^/.]*)[^/]*$", 1))
    weights = materialise(template_weights(templates(spark) if given is None else given),
                          "templates")
    n = weights.agg(F.max("n")).first()[0] or 0
    unknown = float(spark.range(1).select(F.log(F.lit(1.0 + n)) + 1).first()[0])
    rows = files.select(packed(files).alias("row"), F.col(f"`{path}`").alias("path"),
                        F.col(f"`{text}`").alias("text"))
    ident = F.xxhash64("path", "text")
    texts = rows.select(ident.alias("file"), "path", "text")
    key = sorted(r.term for r in key_terms(weights, texts.where("text IS NOT NULL"))
                 .limit(MAX_BROADCAST + 1).collect())
    named = F.coalesce(name.isin(*LICENCE_FILES), F.lit(False)) & F.col("text").isNotNull()
    if len(key) > MAX_BROADCAST:
        holding = may = F.col("text").isNotNull()  # too many templates to tell beforehand
    elif key:
        # the cheap test of a text: one search for any key word
        may = F.col("text").rlike(r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, key))
                                  + r")(?![\p{L}\p{N}])")
        holding = F.arrays_overlap("terms", F.array(*map(F.lit, key)))
    else:
        may = holding = F.lit(False)

    some = materialise(texts.where(may | named).dropDuplicates(["file"]), "candidates")
    lines = materialise(
        some.select("file", F.posexplode(F.split("text", "\n")).alias("line", "text"))
        .select("file", "line", terms(F.col("text")).alias("terms"), "text").where(holding)
        .select("file", "line", "terms"), "lines")
    # neighbouring lines have the same difference of line number and rank
    rank = F.row_number().over(Window.partitionBy("file").orderBy("line"))
    runs = lines.withColumn("run", F.col("line") - rank).groupBy("file", "run").agg(
        F.min("line").alias("line"), F.count(F.lit(1)).alias("n"),
        F.flatten(F.array_sort(F.collect_list(F.struct("line", "terms")))["terms"]).alias("terms"))
    parts = lines.select("file", "line", F.lit(0).alias("kind"), "terms").unionByName(
        runs.where("n > 1").select("file", "line", F.lit(1).alias("kind"), "terms"))
    in_parts = materialise(matches(parts, weights, unknown), "part-matches")
    wholes = some.join(in_parts.select("file").distinct(), "file", "left_semi").unionByName(
        some.where(named)).dropDuplicates(["file"])
    found = in_parts.unionByName(matches(wholes.select(
        "file", F.lit(0).alias("line"), F.lit(2).alias("kind"),
        terms(F.col("text")).alias("terms")), weights, unknown))

    own = (found.groupBy("file").agg(
        F.max_by(F.struct("licence", "cosine"),
                 F.struct("cosine", _reversed("licence"), -F.col("line"))).alias("best"),
        F.max(F.col("kind") == 2).alias("whole"))
        .join(some.select("file", "path"), "file")
        .select("file", "path", "best.licence", "best.cosine",
                (F.col("whole") | F.coalesce(name.isin(*LICENCE_FILES), F.lit(False)))
                .alias("licence_file")))
    own = materialise(own, "own-licences")
    holders = own.where("licence_file AND path IS NOT NULL").groupBy(
        directory(F.col("path")).alias("dir")).agg(
            F.max_by(F.struct("licence", "path"), F.struct("cosine", _reversed("path"))).alias("h"))
    holders = holders.select("dir", "h.licence", "h.path")

    dirs = rows.select(directory(F.col("path")).alias("of")).distinct()
    parts = F.split("of", "/")
    ancestors = dirs.select("of", F.explode(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.array_join(F.slice(parts, 1, k), "/")))).alias("dir")).distinct()
    nearest = ancestors.join(holders, "dir").groupBy("of").agg(
        F.max_by(F.struct("licence", "path"), F.length("dir")).alias("h"))
    inherited = nearest.select("of", F.col("h.licence").alias("from_dir"),
                               F.col("h.path").alias("from_path"))

    return (rows.select("row", "path", directory(F.col("path")).alias("of"), ident.alias("file"))
            .join(own.select("file", "licence", "cosine", "licence_file"), "file", "left")
            .join(inherited, "of", "left")
            .select("row", F.coalesce("licence", "from_dir").alias("licence"), "cosine",
                    F.when(F.col("licence").isNotNull(),
                           F.when(F.col("licence_file"), "file").otherwise("line"))
                    .when(F.col("from_dir").isNotNull(), "inherited").alias("basis"),
                    F.when(F.col("licence").isNotNull(), F.col("path"))
                    .otherwise(F.col("from_path")).alias("source")))
