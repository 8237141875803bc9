"""Licence scan by sparse TF-IDF cosine and directory inheritance (DataFrame
functions only).

Units are the lines of every text (headers, notices) and every whole text
(licence files).  A unit's vector has a weight tf * idf per word; words no
template holds weigh the largest idf.  A unit can reach cosine ``t`` with a
template only if it holds one of the template's heaviest words (those before
the rest's norm falls below t): such anchors are looked for first in a row-local
scan, so only matching units are taken apart, and no match is lost.  The rest
is joins with the templates' few weights (a constant, broadcast).

A document's licence is that of its best line; a document that is a licence
file as a whole also gives its directory a licence, and documents without one
inherit from the nearest ancestor directory that has one.  Inheritance joins
distinct directories with the licensed ones, then documents with their
directory, so a directory that holds a third of all documents is one row until
that last join, which Spark splits.

Defined results: null and empty texts have no licence of their own but may
inherit; of equal cosines the licence first in alphabetical order wins, of
licence files in a directory the best, then the one of smallest id; repeated rows
are scanned each; null parts of a path count as ``-``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, text_or_empty

HEADER_COSINE = 0.7
FILE_COSINE = 0.5

# fixed values: notices and opening grants of usual licences
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

WORD = r"[a-z0-9]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def template_words(spark: SparkSession) -> DataFrame:
    """``(template, licence, term, tf)`` of the fixed templates."""
    rows = [(k, name, text) for k, (name, text) in enumerate(TEMPLATES)]
    t = spark.createDataFrame(rows, "template int, licence string, text string")
    return t.select("template", "licence", F.explode(words(F.col("text"))).alias("term")).groupBy("template", "licence", "term").agg(F.count(F.lit(1)).alias("tf"))


def idf_table(docs: DataFrame, terms: list[str]) -> tuple[dict[str, float], float]:
    """idf of the templates' words over all documents, and the largest idf."""
    vocabulary = F.array(*[F.lit(t) for t in terms])
    held = docs.select(F.explode(F.array_intersect(F.split(F.lower("text"), "[^a-z0-9]+"), vocabulary)).alias("term"))
    df = {r["term"]: r["n"] for r in held.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most the templates' words
    n = docs.count()
    return {t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for t in terms}, math.log(n + 1) + 1


def anchors(weights: list[tuple[int, str, float]], cosine: float) -> list[str]:
    """Words of which a unit must hold one to reach ``cosine``."""
    out: set[str] = set()
    for k in {w[0] for w in weights}:
        own = sorted(((w, t) for j, t, w in weights if j == k), reverse=True)
        rest = sum(w * w for w, _ in own)
        whole = rest
        for w, t in own:
            if rest < cosine * cosine * whole:
                break
            out.add(t)
            rest -= w * w
    return sorted(out)


def best_match(units: DataFrame, weights: DataFrame, idf: DataFrame, top_idf: float) -> DataFrame:
    """``(unit, licence, cosine)``: the best template of each of ``units (unit,
    text)``; units may repeat words, templates are normalised."""
    tf = units.select("unit", F.explode(words(F.col("text"))).alias("term")).groupBy("unit", "term").agg(F.count(F.lit(1)).alias("tf"))
    w = tf.join(F.broadcast(idf), "term", "left").select("unit", "term", (F.col("tf") * F.coalesce("idf", F.lit(top_idf))).alias("w"))
    norm = w.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = w.join(F.broadcast(weights), "term").groupBy("unit", "template", "licence").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cos = dot.join(norm, "unit").select("unit", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))
    best = cos.groupBy("unit").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
    return best.select("unit", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"))


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", header: float = HEADER_COSINE, file: float = FILE_COSINE) -> DataFrame:
    """One row per document row: ``doc_id, path, licence, cosine, via`` (header,
    file, inherited or null) and ``from_dir`` of an inherited licence."""
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), path.alias("path"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    tmpl = template_words(spark).collect()
    terms = sorted({r["term"] for r in tmpl})
    idf, top = idf_table(src, terms)
    norms: dict[int, float] = {}
    for r in tmpl:
        norms[r["template"]] = norms.get(r["template"], 0.0) + (r["tf"] * idf[r["term"]]) ** 2
    weights = [(r["template"], r["licence"], r["term"], r["tf"] * idf[r["term"]] / math.sqrt(norms[r["template"]])) for r in tmpl]
    weight_df = spark.createDataFrame(weights, "template int, licence string, term string, tw double")
    idf_df = spark.createDataFrame(list(idf.items()), "term string, idf double")
    # bounded as words() splits, where "_" is no part of a word
    pattern = r"(?<![a-z0-9])(" + "|".join(anchors([(k, t, w) for k, _, t, w in weights], min(header, file))) + r")(?![a-z0-9])"

    # units that hold an anchor; a row's number names it across the joins
    rows = src.withColumn("row", F.monotonically_increasing_id())
    some = rows.where(F.lower("text").rlike(pattern))
    whole = some.select(F.struct("row", F.lit(-1).alias("line")).alias("unit"), "text")
    lines = some.select("row", F.posexplode(F.split("text", "\n")).alias("line", "text")).where(F.lower("text").rlike(pattern))
    units = materialise(whole.unionByName(lines.select(F.struct("row", "line").alias("unit"), "text")), "licence_units")
    match = materialise(best_match(units, weight_df, idf_df, top), "licence_matches")
    is_file = (F.col("unit.line") < 0) & (F.col("cosine") >= file)
    is_header = (F.col("unit.line") >= 0) & (F.col("cosine") >= header)
    order = F.struct((~is_file).alias("header"), (-F.col("cosine")).alias("c"), "licence")
    own = match.where(is_file | is_header).groupBy(F.col("unit.row").alias("row")).agg(F.min(order).alias("b"))
    own = own.select("row", F.col("b.licence").alias("own"), (-F.col("b.c")).alias("own_cosine"), F.when(F.col("b.header"), "header").otherwise("file").alias("own_via"))
    narrow = materialise(rows.select("row", "doc_id", "path", F.regexp_replace("path", "/[^/]*$", "").alias("dir")), "licence_paths")
    docs_own = materialise(narrow.join(own, "row", "left"), "licence_own")

    # licensed directories, and the nearest one above every directory
    files = docs_own.where(F.col("own_via") == "file")
    licensed = files.groupBy("dir").agg(F.min(F.struct((-F.col("own_cosine")).alias("c"), "doc_id", F.col("own").alias("licence"))).alias("b"))
    licensed = materialise(licensed.select(F.col("dir").alias("from_dir"), F.col("b.licence").alias("dir_licence"), (-F.col("b.c")).alias("dir_cosine")), "licensed_dirs")
    parts = F.split("dir", "/")
    up = narrow.select("dir").distinct().select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("from_dir"))
    nearest = up.join(licensed, "from_dir").groupBy("dir").agg(F.max(F.struct(F.char_length("from_dir").alias("n"), "from_dir", "dir_licence", "dir_cosine")).alias("near"))
    nearest = materialise(nearest, "nearest_dirs")
    joined = docs_own.join(nearest, "dir", "left")
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("own", "near.dir_licence").alias("licence"),
        F.coalesce("own_cosine", "near.dir_cosine").alias("cosine"),
        F.coalesce("own_via", F.when(F.col("near").isNotNull(), "inherited")).alias("via"),
        F.when(F.col("own").isNull(), F.col("near.from_dir")).alias("from_dir"),
    )


def document_path(source: Column, lang: Column, doc_id: Column) -> Column:
    """Place of a ``documents`` row in a tree: source/lang/id."""
    return F.concat_ws("/", F.coalesce(source, F.lit("-")), F.coalesce(lang, F.lit("-")), F.coalesce(doc_id.cast("string"), F.lit("-")))
