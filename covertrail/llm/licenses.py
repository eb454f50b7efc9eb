"""License scans: TF-IDF cosine of headers and licence files to templates, then directory inheritance.

Paragraphs that may be a notice are cut from every text. They, their lines and their
sentences are compared with templates (notices, standard headers and the passages that
open public licenses) as sparse TF-IDF vectors, so a notice is found alone, wrapped over
lines or inside a longer paragraph. A licence file, known by its name or by how much of
it templates cover, stands for its directory. Files without a license take that of the
nearest ancestor directory that has one, found by joining paths. All steps are SQL; the
templates are fixed and small, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, text_of, words_of

# Notices, headers and opening passages of public licenses.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License v3.0 or later",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
        "BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0 Universal.", "CC0 1.0 Universal"),
}
NOTICE = r"(?i:licen[sc]e|copyright|spdx|public domain|redistribution|hereby granted|cc0)"
#: Cosine from which a notice is taken as a template's license.
LIKE = 0.6
#: Names of licence files. Others are licence files if templates cover half of their words or more.
FILE_NAME = r"(?i:^(un)?licen[sc]e|^copying|^notice)"


def _terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?=\s|$)"), "")


def _weights(rows: DataFrame, key: list[str], idf: DataFrame, unseen: float) -> DataFrame:
    """key, term, weight: tf * idf, scaled so that each key's weights have length 1."""
    counted = rows.select(*key, F.explode("terms").alias("term")).groupBy(*key, "term").agg(F.count("*").alias("tf"))
    rated = counted.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    norms = rated.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rated.join(norms, key).select(*key, "term", (F.col("w") / F.col("norm")).alias("w"))


def templates(spark: SparkSession) -> tuple[DataFrame, DataFrame, float]:
    """Template weights (license, nr, term, w), idf by term, and the idf of an unseen term."""
    listed = F.array(*(F.struct(F.lit(k).alias("license"), F.lit(i).alias("nr"), F.lit(t).alias("notice")) for k, v in TEMPLATES.items() for i, t in enumerate(v)))
    rows = spark.range(1).select(F.inline(listed)).select("license", "nr", _terms(F.col("notice")).alias("terms"))
    n = sum(map(len, TEMPLATES.values()))
    seen = rows.select("license", "nr", F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = seen.select("term", (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    unseen = float(spark.range(1).select(F.log(F.lit(1.0 + n)) + 1.0).first()[0])
    return _weights(rows, ["license", "nr"], idf, unseen), idf, unseen


def _directory(path: Column) -> Column:
    """The path up to its last slash, "" if it has none."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def _ancestors(path: Column) -> Column:
    """The path and all directories above it, as (dir, depth)."""
    parts = F.split(path, "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(F.array_join(F.slice(parts, F.lit(1), n), "/").alias("dir"), n.alias("depth")))
    root = F.array(F.struct(F.lit("").alias("dir"), F.lit(0).alias("depth")))
    return F.when(path == "", root).otherwise(F.concat(root, up))


def _units(paragraphs: DataFrame) -> DataFrame:
    """row, par, kind, at, notice: paragraphs (kind 0), their lines (1) and their sentences (2) with a notice.

    Lines and sentences that are the whole paragraph are left out.
    """
    joined = F.regexp_replace("paragraph", r"\s+", " ")
    cut = {1: F.split("paragraph", r"[\n\r]+"), 2: F.split(joined, r"(?<=[.!?:;])\s+")}
    parts = [F.when(F.size(x) > 1, F.filter(x, lambda part: part.rlike(NOTICE))) for x in cut.values()]
    kinds = [F.array(joined), *(F.coalesce(x, F.array().cast("array<string>")) for x in parts)]
    listed = lambda k: F.transform(kinds[k], lambda t, i: F.struct(F.lit(k).alias("kind"), i.alias("at"), t.alias("notice")))
    rows = F.flatten(F.array(*map(listed, range(3))))
    return paragraphs.select("row", "par", F.inline(rows))


def scan(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """files without their text, with license, similarity, origin and from_dir.

    origin: own, inherited or none. Several notices in one file: the most similar decides,
    ties by license name; several licence files in one directory: the license of most of
    them, ties by name. A licence file stands for its own directory and all below. Null
    paths are in the root directory; null and empty texts have no notice; repeated rows
    are files like any other; columns with the added names are replaced.
    """
    added = ("license", "similarity", "origin", "from_dir")
    of = [c for c in files.columns if c not in (*added, text)]
    t, where = text_of(text), F.coalesce(F.col(path), F.lit(""))
    noticed = F.when(t.rlike(NOTICE), F.filter(F.split(t, r"\r?\n[^\S\n]*\r?\n\s*"), lambda x: x.rlike(NOTICE)))
    # words are counted only where a notice makes it matter
    whole = F.when(noticed.isNotNull(), F.size(words_of(t)))
    rows = files.select(
        F.struct(*of).alias("of"),
        F.monotonically_increasing_id().alias("row"),
        _directory(where).alias("dir"),
        F.regexp_extract(where, r"[^/]*$", 0).rlike(FILE_NAME).alias("named"),
        noticed.alias("paragraphs"),
        whole.alias("whole"),
    )
    rows = materialise(rows, "notices")

    terms, idf, unseen = templates(files.sparkSession)
    key = ["row", "par", "kind", "at"]
    units = _units(rows.where("paragraphs is not null").select("row", F.posexplode("paragraphs").alias("par", "paragraph")))
    units = units.select(*key, F.size(words_of(F.col("notice"))).alias("words"), _terms(F.col("notice")).alias("terms"))
    vectors = _weights(units, key, idf, unseen)
    dots = vectors.withColumnRenamed("w", "v").join(F.broadcast(terms), "term").groupBy(*key, "license", "nr").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    best = F.max(F.struct(F.round("dot", 6).alias("similarity"), "license")).alias("best")
    like = dots.where(F.col("dot") >= LIKE).groupBy(*key).agg(best)
    like = like.join(units.select(*key, "words"), key)
    covered = like.groupBy("row", "par", "kind").agg(F.sum("words").alias("words"), F.max("best").alias("best"))
    covered = covered.groupBy("row", "par").agg(F.max("words").alias("words"), F.max("best").alias("best"))
    own = covered.groupBy("row").agg(F.sum("words").alias("covered"), F.max("best").alias("best")).select("row", "covered", "best.similarity", "best.license")

    is_file = F.col("named") | (2 * F.col("covered") >= F.col("whole"))
    stated = rows.select("of", "row", "dir", "named", "whole").join(own, "row", "left")
    stated = materialise(stated.select("of", "row", "dir", is_file.alias("is_file"), "similarity", "license"), "stated")
    votes = stated.where("is_file and license is not null").groupBy("dir", "license").agg(F.count("*").alias("n"))
    held = votes.groupBy("dir").agg(F.max(F.struct("n", "license"))["license"].alias("held"))
    above = stated.select("dir").distinct().select("dir", F.inline(_ancestors(F.col("dir"))).alias("up", "depth"))
    nearest = above.join(held.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "held")).alias("near"))
    joined = stated.join(nearest, "dir", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return joined.select(
        "of.*",
        F.coalesce("license", "near.held").alias("license"),
        "similarity",
        origin.alias("origin"),
        F.when(origin == "inherited", F.col("near.up")).alias("from_dir"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source/language/hundred of ids/id.txt; every hundredth one level up, every thousandth two."""
    id, hundred = F.col("doc_id"), F.expr("doc_id div 100").cast("string")
    file = F.concat(id.cast("string"), F.lit(".txt"))
    path = F.when(id % 1000 == 0, F.concat_ws("/", "source", file)).when(id % 100 == 0, F.concat_ws("/", "source", "lang", file)).otherwise(F.concat_ws("/", "source", "lang", hundred, file))
    docs = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return scan(docs).select("doc_id", "path", "license", "similarity", "origin", "from_dir")
