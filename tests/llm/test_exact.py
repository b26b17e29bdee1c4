from __future__ import annotations

from pyspark.sql import functions as F

from spendlens.llm.exact import exact_duplicates, without_copies


def found(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()}


def test_longest_original_stays_then_smallest_id(docs):
    d = docs((9, "ab"), (3, "a b"), (2, " ab"), (5, "other"), (7, None), (8, " "))
    assert found(exact_duplicates(d)) == {
        9: (2, 3, False), 3: (2, 3, False), 2: (2, 3, True), 5: (5, 1, True), 7: (8, 2, False), 8: (8, 2, True)}


def test_texts_that_share_a_hash_are_not_copies(docs):
    d = docs((1, "a"), (2, "b"), (3, "a"))
    same = exact_duplicates(d, hashed=lambda text: F.unhex(F.lit("00")))
    assert found(same) == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False)}


def test_only_ascii_space_is_ignored(docs):
    d = docs((1, "a b"), (2, "ab"), (3, "a\x0bb"), (4, "a\x1cb"))
    assert found(exact_duplicates(d))[1][1] == 1
    assert found(exact_duplicates(d))[3][:2] == (3, 2)
    assert found(exact_duplicates(d))[4][1] == 1


def test_one_of_repeated_rows_stays(docs):
    d = docs((1, "a"), (1, "a"), (2, "a"), (3, "b"))
    assert sorted(r["doc_id"] for r in without_copies(d).collect()) == [1, 3]


def test_a_hot_group_keeps_one_row(docs):
    d = docs(*((i, "the same text") for i in range(400)), (400, "another"))
    assert sorted(r["doc_id"] for r in without_copies(d).collect()) == [0, 400]
