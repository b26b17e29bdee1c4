"""Licence scans: headers and licence files against templates, and inheritance along paths."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import ASCII_SPACE, column, staged

# Notices by which works name their licence.
NOTICES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Titles of licence texts.
TITLES = (
    ("AGPL-3.0", "GNU Affero General Public License Version 3"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("ISC", "ISC License"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("MIT", "MIT License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
SPDX = tuple((name, f"SPDX-License-Identifier: {name}") for name in sorted({n for n, _ in NOTICES} - {"Proprietary"}))
TEMPLATES = (*NOTICES, *TITLES, *SPDX)
CUE = (r"(?i)licen[cs]|copyright|spdx|rights reserved|public domain|hereby granted|redistribution and use"
       r"|creative commons|\bcc[- ]by")
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"
LEAST = 0.6  # cosine from which a passage names a template's licence
SENTENCE_END = r"([.!?])[ \t]+"
SPAN = 4  # lines or sentences that a notice may be wrapped over
DIGITS = 6


def words(text: Column) -> Column:
    """Lower-case words of a notice; versions and hyphened names are one word each."""
    plain = F.regexp_replace(F.lower(text), r"[^a-z0-9.+-]+", " ")
    plain = F.regexp_replace(plain, r"[.-]+( |$)", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    spaced = F.translate(text, ASCII_SPACE, " " * len(ASCII_SPACE))
    return F.size(F.filter(F.split(spaced, " "), lambda w: w != ""))


def notices(units: Column) -> Column:
    """What may be a notice: each line or sentence with a licence word, and with those that follow it."""
    begin = F.filter(F.sequence(F.lit(1), F.size(units)), lambda i: F.get(units, i - 1).rlike(CUE))
    wrapped = F.transform(begin, lambda i: F.transform(
        F.sequence(F.lit(1), F.lit(SPAN)), lambda n: F.trim(F.array_join(F.slice(units, i, n), " "))))
    return F.array_distinct(F.flatten(wrapped))


def template_vectors(spark: SparkSession, templates=TEMPLATES) -> tuple[DataFrame, float]:
    """(template, license, word, idf, share): unit vectors of tf * idf, and the idf of unknown words.

    Document frequencies are those of the templates, so they do not depend on the corpus.
    """
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)],
                                 "template int, license string, text string")
    terms = (rows.select("template", "license", F.explode(words(F.col("text"))).alias("word"))
             .groupBy("template", "license", "word").agg(F.count(F.lit(1)).alias("tf")))
    n = len(templates)
    idf = terms.groupBy("word").agg((F.log((1.0 + n) / (1.0 + F.count(F.lit(1)))) + 1).alias("idf"))
    terms = terms.join(idf, "word").withColumn("x", F.col("tf") * F.col("idf"))
    norms = terms.groupBy("template").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return staged(terms.join(norms, "template").select(
        "template", "license", "word", "idf", (F.col("x") / F.col("norm")).alias("share")).coalesce(1),
        "templates"), unknown_idf(n)


def unknown_idf(n: int) -> float:
    return math.log(1.0 + n) + 1


def match(passages: DataFrame, vectors: DataFrame, unknown: float, least: float) -> DataFrame:
    """(passage, license, score) of each distinct passage whose best cosine reaches ``least``.

    The templates are constants of a few hundred words, so they are broadcast.
    """
    terms = (passages.select("passage", F.explode(words(F.col("passage"))).alias("word"))
             .groupBy("passage", "word").agg(F.count(F.lit(1)).alias("tf")))
    idf = F.broadcast(vectors.select("word", "idf").distinct())
    terms = terms.join(idf, "word", "left").withColumn(
        "x", F.col("tf") * F.coalesce("idf", F.lit(unknown))).drop("idf")
    norms = terms.groupBy("passage").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = (terms.join(F.broadcast(vectors), "word").groupBy("passage", "template", "license")
            .agg(F.sum(F.col("x") * F.col("share")).alias("dot")))
    scored = dots.join(norms, "passage").select(
        "passage", "license", F.round(F.col("dot") / F.col("norm"), DIGITS).alias("score"))
    return (scored.filter(F.col("score") >= least).groupBy("passage")
            .agg(F.max(F.struct("score", "license")).alias("best"))
            .select("passage", "best.license", "best.score"))


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text",
         least: float = LEAST, templates=TEMPLATES) -> DataFrame:
    """One row per input row: doc_id, path, license, score, origin, licensed_by.

    A text is taken apart into lines and sentences. Each one with a licence word is compared with the
    templates, by itself and joined with up to ``SPAN`` - 1 that follow it, so a wrapped notice is read
    whole; the best one names the document's licence (origin ``own``). A document named like a licence
    file, or at least half of whose words are such a notice, is a licence file of its directory; of
    several the best score counts, then the smallest path. Documents without a licence inherit that of
    the nearest directory at or above their own (origin ``inherited``); ``licensed_by`` is the path that
    gave it. Null and empty texts can only inherit; a null path is the empty one, and lies in the root
    directory. Repeated rows give equal rows, an empty table none, and other columns are not read.
    """
    vectors, unknown = template_vectors(docs.sparkSession, templates)
    rows = docs.select(column(id_col).alias("doc_id"), F.coalesce(path, F.lit("")).alias("path"),
                       F.coalesce(column(text_col), F.lit("")).alias("text"))
    cued = F.when(F.col("text").rlike(CUE), F.col("text"))
    # each array is a column of its own before it is indexed, so that it is built once per text
    found = staged(rows.select("doc_id", "path", F.split(F.regexp_replace(cued, SENTENCE_END, "$1\n"), "\n").alias("units"))
                   .select("doc_id", "path", notices(F.col("units")).alias("notices"),
                           F.aggregate("units", F.lit(0), lambda n, unit: n + word_count(unit)).alias("n_words")),
                   "notices")
    named = found.filter("size(notices) > 0").select("doc_id", "path", "n_words", F.explode("notices").alias("passage"))
    passages = staged(match(named.select("passage").distinct(), vectors, unknown, least), "passages")
    whole = 2 * word_count(F.col("passage")) >= F.col("n_words")
    own = staged(named.join(passages, "passage").groupBy("doc_id", "path")
                 .agg(F.max(F.struct("score", "license")).alias("b"), F.max(whole).alias("whole"))
                 .select("doc_id", "path", "b.license", "b.score", "whole"), "own")

    directory = F.regexp_replace(F.col("path"), "[^/]*$", "")
    name = F.element_at(F.split("path", "/"), -1)
    files = (own.filter(F.col("whole") | name.rlike(FILE_NAME)).withColumn("directory", directory)
             .groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("order"), "path", "license")).alias("f"))
             .select("directory", F.col("f.license").alias("license"), F.col("f.path").alias("licensed_by")))
    files = staged(files, "licence_files")

    directories = found.select(directory.alias("directory")).distinct()
    parts = F.split(F.regexp_replace("directory", "/$", ""), "/")
    above = F.when(F.col("directory") == "", F.array(F.lit(""))).otherwise(F.concat(
        F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)),
                                        lambda k: F.concat(F.array_join(F.slice(parts, F.lit(1), k), "/"), F.lit("/")))))
    nearest = (directories.select("directory", F.posexplode(above).alias("depth", "above"))
               .join(files.withColumnRenamed("directory", "above"), "above")
               .groupBy("directory").agg(F.max(F.struct("depth", "license", "licensed_by")).alias("n"))
               .select("directory", F.col("n.license").alias("given"), F.col("n.licensed_by").alias("giver")))
    nearest = staged(nearest, "nearest")

    mine = own.select(F.col("doc_id").alias("id"), F.col("path").alias("at"), "license", "score")
    all_rows = found.select("doc_id", "path", directory.alias("directory"))
    joined = (all_rows.join(mine, all_rows["doc_id"].eqNullSafe(mine["id"]) & (all_rows["path"] == mine["at"]), "left")
              .join(nearest, "directory", "left"))
    has = F.col("license").isNotNull()
    return joined.select(
        "doc_id", "path", F.coalesce("license", "given").alias("license"), "score",
        F.when(has, "own").when(F.col("given").isNotNull(), "inherited").alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("giver")).alias("licensed_by"))


def corpus_path() -> Column:
    """A path for documents that have none: source, language, and shards of their id."""
    part = [F.floor(F.col("doc_id") / n).cast("string") for n in (512, 32)]
    return F.concat_ws("/", "source", "lang", *part, F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))


def _sql() -> str:
    def split(text: str) -> str:
        plain = f"regexp_replace(lower({text}), '[^a-z0-9.+-]+', ' ', 'g')"
        return f"list_filter(string_split(regexp_replace({plain}, '[.-]+( |$)', ' ', 'g'), ' '), lambda w: w <> '')"

    values = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))
    n = len(TEMPLATES)
    cue = CUE.replace("(?i)", "")
    def count(text: str) -> str:
        spaced = f"translate({text}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')"
        return f"len(list_filter(string_split({spaced}, ' '), lambda w: w <> ''))"

    return f"""
WITH t(template, license, body) AS (VALUES {values}),
tt AS (SELECT template, license, word, count(*) AS tf FROM (SELECT template, license, unnest({split('body')}) AS word
       FROM t) GROUP BY ALL),
idf AS (SELECT word, ln({1.0 + n} / (1.0 + count(*))::DOUBLE) + 1 AS idf FROM tt GROUP BY 1),
tx AS (SELECT template, license, word, tf * idf AS x FROM tt JOIN idf USING (word)),
tn AS (SELECT template, sqrt(sum(x * x)) AS norm FROM tx GROUP BY 1),
vec AS (SELECT template, license, word, x / norm AS share FROM tx JOIN tn USING (template)),
d AS (SELECT doc_id, concat_ws('/', source, lang, floor(doc_id / 512)::BIGINT, floor(doc_id / 32)::BIGINT,
        'doc-' || doc_id) AS path, coalesce(text, '') AS text,
        {count("coalesce(text, '')")} AS n_words FROM documents),
units AS (SELECT doc_id, path, n_words,
            string_split(regexp_replace(text, '{SENTENCE_END}', '\\1' || chr(10), 'g'), chr(10)) AS u
          FROM d WHERE regexp_matches(text, '{cue}', 'i')),
begin AS (SELECT doc_id, path, n_words, u, unnest(range(1, len(u) + 1)) AS i FROM units),
lines AS (SELECT DISTINCT doc_id, path, n_words, trim(array_to_string(list_slice(u, i, i + n - 1), ' ')) AS passage
          FROM begin, range(1, {SPAN + 1}) AS spans(n) WHERE regexp_matches(u[i], '{cue}', 'i')),
pt AS (SELECT passage, word, count(*) AS tf FROM (SELECT passage, unnest({split('passage')}) AS word
       FROM (SELECT DISTINCT passage FROM lines)) GROUP BY ALL),
px AS (SELECT passage, word, tf * coalesce(idf, {unknown_idf(n)!r}) AS x FROM pt LEFT JOIN idf USING (word)),
pn AS (SELECT passage, sqrt(sum(x * x)) AS norm FROM px GROUP BY 1),
dots AS (SELECT passage, template, license, sum(x * share) AS dot FROM px JOIN vec USING (word) GROUP BY ALL),
best AS (SELECT passage, max(struct_pack(score := round(dot / norm, {DIGITS}), license := license)) AS b
         FROM dots JOIN pn USING (passage) WHERE round(dot / norm, {DIGITS}) >= {LEAST} GROUP BY 1),
own AS (SELECT doc_id, path, max(b) AS b, bool_or(2 * {count('passage')} >= n_words) AS whole
        FROM lines JOIN best USING (passage) GROUP BY ALL),
files AS (SELECT regexp_replace(path, '[^/]*$', '') AS directory,
            min(struct_pack(o := -b.score, path := path, license := b.license)) AS f FROM own
          WHERE whole OR regexp_matches(string_split(path, '/')[-1], '{FILE_NAME.replace("(?i)", "")}', 'i') GROUP BY 1),
dirs AS (SELECT DISTINCT regexp_replace(path, '[^/]*$', '') AS directory FROM d),
above AS (SELECT directory, unnest(range(len(string_split(directory, '/')))) AS depth FROM dirs),
near AS (SELECT a.directory, max(struct_pack(depth := depth, license := f.license, path := f.path)) AS m
         FROM above a JOIN files ON files.directory = CASE WHEN depth = 0 THEN '' ELSE
           array_to_string(list_slice(string_split(a.directory, '/'), 1, depth), '/') || '/' END GROUP BY 1)
SELECT d.doc_id, d.path, coalesce(own.b.license, m.license) AS license, own.b.score AS score,
  CASE WHEN own.b IS NOT NULL THEN 'own' WHEN m IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN own.b IS NOT NULL THEN d.path ELSE m.path END AS licensed_by
FROM d LEFT JOIN own USING (doc_id, path) LEFT JOIN near ON near.directory = regexp_replace(d.path, '[^/]*$', '')
"""


ORACLE = _sql()
