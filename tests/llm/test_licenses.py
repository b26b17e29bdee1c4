from __future__ import annotations

from pyspark.sql import functions as F

from spendlens.llm.licenses import TEMPLATES, scan

LONG = "some words of prose " * 30


def found(spark, *rows, **kwargs):
    docs = spark.createDataFrame(list(rows), "doc_id long, path string, text string")
    return {r["doc_id"]: (r["license"], r["origin"], r["licensed_by"]) for r in scan(docs, F.col("path"), **kwargs).collect()}


def test_headers_files_and_inheritance(spark):
    hits = found(
        spark, (1, "a/LICENSE", LONG + "\nReleased under the MIT License."), (2, "a/b/c/x.txt", LONG),
        (3, "a/b/COPYING.md", "This work is licensed under the GNU General Public License, version 3."),
        (4, "a/b/y.txt", f"# Licensed under the Apache License, Version 2.0\n{LONG}"), (5, "a/z.txt", LONG),
        (6, "other/z.txt", LONG), (7, "ab/z.txt", None), (8, None, ""))
    assert hits[1] == ("MIT", "own", "a/LICENSE") and hits[5] == ("MIT", "inherited", "a/LICENSE")
    assert hits[2] == ("GPL-3.0", "inherited", "a/b/COPYING.md") and hits[4][:2] == ("Apache-2.0", "own")
    assert hits[6] == hits[7] == hits[8] == (None, None, None)


def test_root_licence_covers_all(spark):
    hits = found(spark, (1, "LICENSE", "Released under the MIT License."), (2, "x/y/z", "prose"), (3, None, None))
    assert hits[2] == hits[3] == ("MIT", "inherited", "LICENSE")


def test_every_template_names_its_licence(spark):
    rows = [(i, f"d{i}/f", f"{LONG}\n// {text}") for i, (_, text) in enumerate(TEMPLATES)]
    assert {i: h[0] for i, h in found(spark, *rows).items()} == {i: name for i, (name, _) in enumerate(TEMPLATES)}


def test_prose_about_licences_is_none(spark):
    assert found(spark, (1, "a/b", "The driver lost his licence in a game of cards with a friend from school."))[1][0] is None


def test_wrapped_notices_titles_and_identifiers(spark):
    hits = found(
        spark, (1, "a/x.py", "# This work is licensed under the GNU General Public\n# License, version 2.\n" + LONG),
        (2, "b/COPYING", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\n" + LONG),
        (3, "c/x.py", "# SPDX-License-Identifier: Apache-2.0\n" + LONG), (4, "d/x.py", "# SPDX-License-Identifier: Zlib\n" + LONG),
        (5, "e/x.txt", LONG + "It ends here. Licensed under the Apache License, Version 2.0. " + LONG), (6, "b/y.txt", LONG))
    assert {i: h[0] for i, h in hits.items()} == {1: "GPL-2.0", 2: "GPL-3.0", 3: "Apache-2.0", 4: None,
                                                  5: "Apache-2.0", 6: "GPL-3.0"}


def test_a_text_that_is_mostly_a_notice_is_a_licence_file(spark):
    notice = "This work is licensed under the GNU General Public License, version 3."
    hits = found(spark, (1, "a/first", notice + "\nSigned by hand."), (2, "a/other", LONG),
                 (3, "b/first", notice + " " + " ".join(["word"] * 30)), (4, "b/other", LONG))
    assert hits[2] == ("GPL-3.0", "inherited", "a/first") and hits[3][0] == "GPL-3.0" and hits[4][0] is None
