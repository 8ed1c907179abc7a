"""Licence scan: TF-IDF cosine of lines and licence files to templates, then inheritance down the tree.

DataFrame functions only. Terms are runs of letters and digits, lower-cased. A term of the templates has the
idf ln((1 + N) / (1 + df)) + 1, counted over all N files; any other word has that of a term never seen. Each
line of each file is a possible header and is held against every template, and so is the whole text of a file
whose name says that it is a licence; the nearest template of a file is its own licence when the cosine is at
least ``LEAST_COSINE``. A notice may also stand inside a line or be wrapped over many: every run of as
many words as a template has, line ends and comment marks ignored, that begins with a term of the template is held
against that template too.

Most lines and runs never meet a template. A template's terms are sorted by weight, and its head are the terms up to
where the rest alone cannot reach the least cosine (Cauchy-Schwarz); a line without a head term of any
template cannot reach it either, so only lines with one are scored. Of the runs only those are scored whose cosine,
with every word counted as if it stood there once, reaches the least one; that is never below the cosine itself.
Nothing is lost by this.

A file is cut into words once and all of it is scored inside its row, from arrays of the templates' weights; only files
with a licence leave it. The templates are few and known to the driver; what grows with the corpus is not.

A directory's licence is that of its licence files: the highest cosine, then the least path. Files without a
licence of their own take the nearest ancestor directory's. Distinct directories, not files, are
joined with their ancestors, so a directory of a third of all files is one row there.

Edge cases: a null text has no licence of its own. Files without a path are judged by their lines, and
inherit nothing. Rows that repeat a path are one file. Equal cosines go to the licence that sorts first. An
empty table gives no rows. Extra columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tokloom.llm.common import named_rows, stored
from tokloom.llm.decontam import words

LEAST_COSINE = 0.6
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.-].*)?$"

#: Licence id and text: common notices, and openings of the licences themselves (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                   "file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the "
                     "LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or "
                "neighboring rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted, provided that the above copyright notice and this permission notice "
            "appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
                "copy of the MPL was not distributed with this file, You can obtain one at "
                "http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def template_terms(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, license, term, tf); as small as the templates."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(k).alias("license"),
                              F.lit(t).alias("text")) for i, (k, t) in enumerate(templates)])
    return (spark.range(1).select(F.inline(rows))
            .select("template", "license", F.explode(words(F.col("text"))).alias("term"))
            .groupBy("template", "license", "term").agg(F.count("*").alias("tf")))


def _idf(total: int, df: Column) -> Column:
    return F.log(F.lit(1.0 + total) / (F.lit(1.0) + df)) + 1


def weighted(terms: DataFrame, files: DataFrame, total: int) -> DataFrame:
    """``terms`` with idf, w and the template's norm; df counts the files that hold the term."""
    vocabulary = _strings([r["term"] for r in terms.select("term").distinct().orderBy("term").collect()])
    df = (files.select(F.explode(F.array_intersect(words(F.col("text")), vocabulary)).alias("term"))
          .groupBy("term").agg(F.count("*").alias("df")))
    idf = _idf(total, F.coalesce("df", F.lit(0)))
    return (terms.join(df, "term", "left").withColumn("idf", idf).withColumn("w", F.col("tf") * idf)
            .withColumn("norm", F.sqrt(F.sum(F.col("w") ** 2).over(Window.partitionBy("template"))))
            .drop("df"))


def _strings(values) -> Column:
    """An array literal of terms, which hold no space, as one small expression that Spark folds."""
    return F.split(F.lit(" ".join(values)), " ")


def _numbers(values) -> str:
    """SQL of an array literal of numbers."""
    return "cast(split('{}', ' ') as array<double>)".format(" ".join(repr(float(v)) for v in values))


class Weights:
    """The templates' weights as literals: term k has number k + 1, 0 is any other word."""

    def __init__(self, rows, total: int, least: float):
        self.terms = sorted({r["term"] for r in rows})
        number = {t: k + 1 for k, t in enumerate(self.terms)}
        unknown = math.log(1.0 + total) + 1
        idf = [unknown] + [0.0] * len(self.terms)
        self.templates: dict[int, dict] = {}
        for r in rows:
            idf[number[r["term"]]] = r["idf"]
            t = self.templates.setdefault(r["template"], {
                "license": r["license"], "norm": r["norm"], "words": 0, "dot": [0.0] * len(idf), "w": {}})
            t["words"] += r["tf"]
            t["dot"][number[r["term"]]] = r["idf"] * r["w"]
            t["w"][r["term"]] = r["w"]
        self.idf, self.unknown, self.least = idf, unknown, least
        self.vocabulary = _strings(self.terms)
        self.square = _numbers([v * v for v in idf])
        self.least_size = least * (1 - 1e-9)  # a little below, for the rounding of sums
        heads = {term for t in self.templates.values() for term in self._head(t)}
        self.head = _strings(sorted(heads))

    def _head(self, template: dict) -> list[str]:
        """The terms of which a text must hold one to reach the least cosine."""
        out, left = [], 0.0
        for w, term in sorted((w, term) for term, w in template["w"].items()):
            left += w * w
            # a little below the bound, for the rounding of sums
            if math.sqrt(left) >= self.least * template["norm"] * (1 - 1e-9):
                out.append(term)
        return out

    def ids(self) -> Column:
        """A number for each word of column ``all``: that of its term, or a hash below 0."""
        return F.transform("all", lambda x: F.coalesce(
            F.nullif(F.array_position(self.vocabulary, x), F.lit(0).cast("long")),
            F.xxhash64(x).bitwiseOR(F.lit(-2 ** 63))))

    def nearest_run(self, template: dict) -> Column:
        """The highest cosine of the template with a run of the words that column ``ids`` numbers, null if none may
        reach the least one."""
        dot, norm = _numbers(template["dot"]), template["norm"]
        run = f"slice(ids, i, {template['words']})"
        of = lambda weights, k: f"get({weights}, cast(greatest({k}, 0L) as int))"
        total = lambda weights: f"aggregate({run}, 0D, (a, k) -> a + {of(weights, 'k')})"
        # the words sorted, so that equal ones meet: (n + 1)^2 - n^2 = 2 n + 1
        size = f"""sqrt(aggregate(array_sort({run}), struct(0L as id, 0 as n, 0D as sum), (a, k) -> if(a.id = k,
            struct(k as id, a.n + 1 as n, a.sum + (2 * a.n + 1) * {of(self.square, 'k')} as sum),
            struct(k as id, 1 as n, a.sum + {of(self.square, 'k')} as sum)), a -> a.sum))"""
        return F.expr(f"""array_max(transform(
            filter(sequence(1, size(ids)), i -> {of(dot, 'get(ids, i - 1)')} > 0
                AND {total(dot)} >= sqrt({total(self.square)}) * {self.least_size * norm!r}D),
            i -> round({total(dot)} / ({size} * {norm!r}D), 6)))""")

    def best(self) -> Column:
        """(minus, license) of the nearest template of columns ``counts`` (k, n) and ``squares``."""
        unknown = f"{self.unknown ** 2!r}D"
        size = f"""sqrt({unknown} * squares
            + aggregate(counts, 0D, (a, c) -> a + c.n * c.n * (get({self.square}, c.k) - {unknown})))"""
        each = [f"""struct(-round(aggregate(counts, 0D, (a, c) -> a + c.n * get({_numbers(t["dot"])}, c.k))
                / ({size} * {t["norm"]!r}D), 6) as minus, '{t["license"]}' as license)"""
                for t in self.templates.values()]
        return F.expr(f"array_min(array({', '.join(each)}))")


def sum_of_squares(w: str) -> Column:
    """The squared numbers of occurrences of each word of an array, summed; the words are sorted once for it."""
    start = F.struct(F.lit(None).cast("string").alias("word"), F.lit(0).cast("long").alias("n"),
                     F.lit(0).cast("long").alias("sum"))
    # (n + 1)^2 - n^2 = 2 n + 1
    step = lambda a, x: F.when(a["word"] == x, F.struct(
        x.alias("word"), (a["n"] + 1).alias("n"), (a["sum"] + 2 * a["n"] + 1).alias("sum"))).otherwise(
        F.struct(x.alias("word"), F.lit(1).cast("long").alias("n"), (a["sum"] + 1).alias("sum")))
    return F.aggregate(F.array_sort(w), start, step, lambda a: a["sum"])


def own_licences(files: DataFrame, templates=TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """(path, license, cosine) of each file that has a licence of its own."""
    total = files.count()
    weights = Weights(weighted(template_terms(files.sparkSession, templates), files, total).collect(), total, least)
    if not weights.templates:
        return files.select("path", F.lit("").alias("license"), F.lit(0.0).alias("cosine")).limit(0)
    # each step is a column of its own, since an expression that is read twice would be computed twice
    lines = files.select("path", F.transform(F.split("text", "\n"), words).alias("lines"))
    whole = lines.select("path", "lines", F.flatten("lines").alias("all"))
    near = whole.select("path", "lines", "all", F.arrays_overlap("all", weights.head).alias("near"))
    numbered = near.select("path", "lines", "all", "near", F.when(F.col("near"), weights.ids()).alias("ids"))
    is_licence = F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENCE_FILE)
    said = F.concat(F.filter("lines", lambda w: F.arrays_overlap(w, weights.head)),
                    F.when(is_licence, F.array("all")).otherwise(F.array().cast("array<array<string>>")))
    reaches = lambda b: b["minus"] <= -least
    found = F.array(*[F.struct((-weights.nearest_run(t)).alias("minus"), F.lit(t["license"]).alias("license"))
                      for t in weights.templates.values()])
    of_runs = numbered.select("path", F.inline(F.when(F.col("near"), F.filter(found, reaches))))
    # explode and inline, not filter: a filter on a column is computed below it once more
    each = numbered.select("path", F.explode(F.when(F.col("near"), said)).alias("w"))
    counts = F.transform(F.array_intersect("w", weights.vocabulary), lambda t: F.struct(
        F.array_position(weights.vocabulary, t).cast("int").alias("k"),
        F.size(F.filter("w", lambda x: x == t)).cast("long").alias("n")))
    of_lines = (each.select("path", counts.alias("counts"), sum_of_squares("w").alias("squares"))
                .select("path", weights.best().alias("best"))
                .select("path", F.inline(F.filter(F.array("best"), reaches))))
    best = of_lines.unionByName(of_runs)
    return (best.groupBy("path").agg(F.min(F.struct("minus", "license")).alias("best"))
            .select("path", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("cosine")))


def directory(path) -> Column:
    """Everything before the last slash; empty for files at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherited(files: DataFrame, own: DataFrame) -> DataFrame:
    """(dir, license, from_dir) of each directory that has files and a licensed ancestor or itself."""
    name = F.regexp_extract("path", r"[^/]*$", 0)
    granted = (own.filter(name.rlike(LICENCE_FILE)).withColumn("granted", directory(F.col("path")))
               .groupBy("granted").agg(F.min(F.struct(-F.col("cosine"), F.col("path"), F.col("license")))
                                       .alias("best"))
               .select("granted", F.col("best.license").alias("license")))
    places = files.filter("path is not null").select(directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)),
                     lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    above = places.select("dir", F.explode(F.array_distinct(up)).alias("granted"))
    nearest = F.max_by(F.struct("license", "granted"), F.length("granted"))
    return (above.join(granted, "granted").groupBy("dir").agg(nearest.alias("near"))
            .select("dir", F.col("near.license").alias("dir_license"),
                    F.col("near.granted").alias("from_dir")))


def scan(files: DataFrame, templates=TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """(path, license, cosine, origin, from_dir) of each file.

    origin: own, inherited, or null without a licence; from_dir: where an inherited licence lies.
    """
    files = named_rows(files, path="string", text="string")
    own = stored(own_licences(files, templates, least), "own-licences")
    down = stored(inherited(files, own), "inherited")
    paths = files.select("path").distinct().withColumn("dir", directory(F.col("path")))
    return (paths.alias("f").join(own.alias("o"), F.col("f.path").eqNullSafe(F.col("o.path")), "left")
            .join(down, "dir", "left")
            .select("f.path", F.coalesce("o.license", "dir_license").alias("license"), "cosine",
                    F.when(F.col("o.license").isNotNull(), "own")
                    .when(F.col("dir_license").isNotNull(), "inherited").alias("origin"),
                    F.when(F.col("o.license").isNull(), F.col("from_dir")).alias("from_dir")))


def document_files(docs: DataFrame) -> DataFrame:
    """(path, text): documents as files of a tree.

    The source is the top directory, the digits of the id but the last are the directories below, so
    short ids lie above long ones; texts that speak of a licence are named as licence files.
    """
    doc = F.col("doc_id").cast("string")
    name = F.when(F.col("text").rlike("(?i)licen[cs]e"), F.concat(F.lit("LICENSE-"), doc)).otherwise(
        F.concat(doc, F.lit(".txt")))
    digits = F.regexp_extract_all(doc, F.lit("([0-9])"), 1)
    above = F.concat(F.array(F.coalesce("source", F.lit("unknown"))),
                     F.slice(digits, 1, F.greatest(F.size(digits) - 1, F.lit(0))))
    return named_rows(docs, doc_id="long", text="string", source="string").select(
        F.when(F.col("doc_id").isNotNull(), F.concat_ws("/", above, name)).alias("path"), "text")


def op3_licenses(docs: DataFrame) -> DataFrame:
    found = scan(document_files(docs))
    doc = F.regexp_extract("path", r"([0-9]+)(\.txt)?$", 1).cast("long")
    return found.select(doc.alias("doc_id"), "path", "license", "cosine", "origin", "from_dir")
