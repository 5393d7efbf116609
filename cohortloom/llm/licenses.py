"""Licence scans: sparse TF-IDF cosine of licence lines and whole texts to templates, then inheritance from the nearest ancestor directory.

A file's header is all of its lines, anywhere in the text, that speak of a licence, copyright, permission or warranty. Headers and templates are
vectors of term counts weighted by inverse header frequency, counted over all headers. Each licence has several templates: a declaration,
short forms that name it, and the licence lines of its full text. Headers are compared with all of them, each of their lines with the
short forms; a short form counts only where all terms of the name are there, since the rest of it fits any licence. The whole text of a file with
such lines is compared with the full licence texts by counts of three-word runs. A file's own licence is the best of all at or above the threshold.
A file that consists of licence lines for at least half of its words, or whose whole text fits a licence text, is a licence file and stands for
its directory. Files without a licence of their own take that of the nearest directory above them that has one: each directory of a path is a
row, joined by equality, and the deepest match counts.

Only the few files with such lines leave the scan, as (file, term, count) rows; templates are a fixed list and are broadcast. Paths are
exploded per distinct directory, not per file. The text of AGPL-3.0 is that of GPL-3.0 with the name replaced; there are no full texts of the CC licences.

Defined cases: null and empty texts have no licence of their own but inherit; ties go to the template first by name; of several licence files
in a directory the best match counts, then the first name; a null path has no directory and inherits nothing; repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import LOWER, UPPER, text_key, whole, word_count

#: Public licence names and the words by which files declare them.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License, version 3",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License, without warranty",
    "CC-BY-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License, CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License, CC BY-SA 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Licensed under the MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
}
SPEAKS = r"licen[cs]e|copyright|permission is hereby|warrant(y|ies)|all rights reserved"
TERM = r"[a-z0-9]+([.-][a-z0-9]+)*"
#: Short forms: each phrase with each name; the name's terms must all be there, but for those that any licence has.
PHRASES = ("Released under the {}.", "Licensed under the {}.", "Distributed under the {}.", "This work is licensed under the {}.", "This project is licensed under the terms of the {}.", "SPDX-License-Identifier: {}", "License: {}", "{}")
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPLv3"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache-2.0", "Apache 2.0 License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause", "3-clause BSD License"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPLv3"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPLv3"),
    "MIT": ("MIT License", "MIT"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"),
}
COMMON = {"license", "version", "international", "the"}


def _texts() -> dict[str, str]:
    """Full texts by licence, from the files beside this module."""
    found = {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
    named = re.sub("GNU General Public", "GNU Affero General Public", found["GPL-3.0"])
    return found | {"AGPL-3.0": named.replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC")}


TEXTS = _texts()


def forms(templates: dict[str, str], names: dict[str, tuple[str, ...]], texts: dict[str, str]) -> list[tuple[str, str, list[str]]]:
    """license, line, needs: all templates of headers; needs is null where no terms are asked for."""
    spoken = {k: "\n".join(x for x in v.split("\n") if re.search(SPEAKS, x.lower())) for k, v in texts.items()}
    asked = lambda name: sorted({m[0] for m in re.finditer(TERM, name.lower())} - COMMON)
    short = [(k, phrase.format(n), asked(n)) for k, all_names in names.items() for n in all_names for phrase in PHRASES]
    return [(k, v, None) for part in (templates, spoken) for k, v in part.items()] + short


def _low(c):
    return F.translate(c, UPPER, LOWER)


def terms(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, term, tf of column `line`."""
    each = df.select(*keys, F.explode(F.regexp_extract_all(_low(F.col("line")), F.lit(TERM), F.lit(0))).alias("term"))
    return each.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def headers(files: DataFrame) -> DataFrame:
    """file_key, line: the licence lines of each distinct text."""
    speaks = F.regexp_like(_low(whole()), F.lit(SPEAKS))
    lines = files.where(speaks).select(text_key().alias("file_key"), F.explode(F.split(whole(), "\n")).alias("line"), word_count(whole()).alias("words"))
    return lines.where(F.regexp_like(_low(F.col("line")), F.lit(SPEAKS)))


def whole_matches(files: DataFrame, texts: dict[str, str], threshold: float) -> DataFrame:
    """file_key, license, score of each distinct text with licence lines whose three-word runs fit a full text."""
    def counts(df: DataFrame, key: str) -> DataFrame:
        t = df.select(key, F.regexp_extract_all(_low(F.col("line")), F.lit(TERM), F.lit(0)).alias("t"))
        starts = F.when(F.size("t") >= 3, F.sequence(F.lit(0), F.size("t") - 3))
        each = t.select(key, "t", F.explode_outer(starts).alias("i")).where("i is not null")
        return each.select(key, F.xxhash64(*[F.get("t", F.col("i") + k) for k in range(3)]).alias("run")).groupBy(key, "run").agg(F.count(F.lit(1)).alias("n"))

    model = cut(counts(files.sparkSession.createDataFrame(list(texts.items()), "license string, line string"), "license").withColumnRenamed("n", "m"))
    other = model.groupBy("license").agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("other"))
    # copies of a text are added up: all counts of its vector grow alike, the cosine stays
    own = cut(counts(files.where(F.regexp_like(_low(whole()), F.lit(SPEAKS))).select(text_key().alias("file_key"), whole().alias("line")), "file_key"))
    norm = own.groupBy("file_key").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    dots = own.join(F.broadcast(model), "run").groupBy("file_key", "license").agg(F.sum(F.col("n") * F.col("m")).alias("dot"))
    scored = dots.join(norm, "file_key").join(F.broadcast(other), "license")
    return scored.select("file_key", "license", F.round(F.col("dot") / F.col("norm") / F.col("other"), 6).alias("score")).where(F.col("score") >= threshold)


def matches(files: DataFrame, templates: dict[str, str], names: dict[str, tuple[str, ...]], texts: dict[str, str], threshold: float) -> DataFrame:
    """Own licence of each distinct text that has one: file_key, license, score, whole_file."""
    spark = files.sparkSession
    lines = cut(headers(files))
    # copies of a text count once each: one row per line and copy goes in, copies leave the weights of their own header unchanged
    copies = lines.groupBy("file_key", "line", "words").agg(F.count(F.lit(1)).alias("n"))
    copies = cut(copies)
    tf = cut(terms(copies, ["file_key"]))
    total = tf.select("file_key").distinct().count()
    df = cut(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    weight = F.col("tf") * (F.log(F.lit(1.0 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1)
    listed = [(i, *form) for i, form in enumerate(forms(templates, names, texts))]
    known = spark.createDataFrame(listed, "form int, license string, line string, needs array<string>")
    weighed = lambda t, *keys: t.join(df, "term", "left").select(*keys, "term", weight.alias("w"))
    model = cut(weighed(terms(known, ["form"]), "form"))
    norm = lambda t, *keys: t.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    asked = known.select("form", F.explode("needs").alias("term")).withColumn("asked", F.lit(1))
    model = cut(model.join(asked, ["form", "term"], "left").select("form", "term", "w", F.coalesce("asked", F.lit(0)).alias("asked")))
    about = known.select("form", "license", F.size("needs").alias("needed"), F.col("needs").isNotNull().alias("short")).join(norm(model, "form").withColumnRenamed("norm", "other"), "form")

    def fits(w: DataFrame, keys: list[str], test) -> DataFrame:
        dots = w.join(F.broadcast(model.withColumnRenamed("w", "v")), "term").groupBy(*keys, "form").agg(F.sum(F.col("w") * F.col("v")).alias("dot"), F.sum("asked").alias("there"))
        scored = dots.join(F.broadcast(about), "form").where(test & (~F.col("short") | (F.col("there") == F.col("needed")))).join(norm(w, *keys), keys)
        return scored.select("file_key", "license", F.round(F.col("dot") / F.col("norm") / F.col("other"), 6).alias("score")).where(F.col("score") >= threshold)

    heads = fits(cut(weighed(tf, "file_key")), ["file_key"], F.lit(True))
    # each distinct line once, then back to its files
    single = copies.select("line", F.xxhash64("line").alias("line_key")).distinct()
    of_lines = fits(cut(weighed(terms(single, ["line_key"]), "line_key")).withColumnRenamed("line_key", "file_key"), ["file_key"], F.col("short")).withColumnRenamed("file_key", "line_key")
    single_best = copies.select("file_key", F.xxhash64("line").alias("line_key")).distinct().join(of_lines, "line_key").select("file_key", "license", "score")
    complete = cut(whole_matches(files, texts, threshold))
    best = heads.unionByName(single_best).unionByName(complete).groupBy("file_key").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    share = copies.groupBy("file_key").agg((2 * F.sum(word_count(F.col("line"))) >= F.max("words")).alias("mostly"))
    out = best.join(share, "file_key").join(complete.select("file_key", F.lit(True).alias("complete")).distinct(), "file_key", "left")
    return out.select("file_key", "b.license", (-F.col("b.s")).alias("score"), (F.col("mostly") | F.coalesce("complete", F.lit(False))).alias("whole_file"))


def ancestors(directory):
    """The directory itself and all above it, deepest last: '' is the root."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def scan(files: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.5, names: dict[str, tuple[str, ...]] = NAMES, texts: dict[str, str] = TEXTS) -> DataFrame:
    """One row per file of (path, text): path, license, score, origin (header, file, inherited or null), inherited_from (directory)."""
    own = cut(matches(files, templates, names, texts, threshold))
    names = files.select("path", text_key().alias("file_key"), F.when(F.col("path").contains("/"), F.regexp_extract("path", "^(.*)/[^/]*$", 1)).when(F.col("path").isNotNull(), F.lit("")).alias("dir"))
    placed = cut(names.join(own, "file_key", "left").select("path", "dir", "license", "score", "whole_file"))
    given = placed.where("whole_file and dir is not null").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b")).select(F.col("dir").alias("above"), F.col("b.license").alias("from_license"), (-F.col("b.s")).alias("from_score"))
    asked = placed.where("license is null and dir is not null").select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("above")).distinct()
    near = asked.join(given, "above").groupBy("dir").agg(F.max_by(F.struct("above", "from_license", "from_score"), F.length("above")).alias("g")).select("dir", "g.*")
    out = placed.join(near, "dir", "left")
    own_one = F.col("license").isNotNull()
    origin = F.when(own_one & F.col("whole_file"), "file").when(own_one, "header").when(F.col("above").isNotNull(), "inherited")
    return out.select("path", F.coalesce("license", "from_license").alias("license"), F.coalesce("score", "from_score").alias("score"), origin.alias("origin"), F.when(~own_one, F.col("above")).alias("inherited_from"))
