from __future__ import annotations

from spendlens.llm.quotes import link_quotes


def found(spark, *rows):
    df = spark.createDataFrame(list(rows), "conv_id long, turn long, role string, text string")
    return {(r["conv_id"], r["turn"]): r for r in link_quotes(df).collect()}


def test_nested_quotes_find_their_originals(spark):
    hits = found(
        spark, (1, 0, "user", "First question?\nWith two lines."), (1, 1, "assistant", "> First question?\n\nAn answer."),
        (1, 2, "user", "On Monday Ann wrote:\n>> First  question?\n> An answer.\nThanks.\n> With two lines.\nAnd this."),
        (1, 3, "user", "> something nobody wrote\nOk."), (2, 0, "user", "> An answer.\nIn another conversation."))
    assert [hits[1, t]["parent"] for t in range(4)] == [None, 0, 1, None]
    assert [(hits[1, t]["root"], hits[1, t]["depth"]) for t in range(4)] == [(0, 0), (0, 1), (0, 2), (3, 0)]
    assert hits[1, 2]["text"] == "Thanks.\nAnd this." and hits[1, 2]["n_linked"] == 3
    assert hits[1, 3]["n_quotes"] == 1 and hits[1, 3]["n_linked"] == 0
    assert hits[2, 0]["parent"] is None
    assert hits[1, 1]["chat"] == "<|assistant|>\nAn answer."


def test_odd_messages(spark):
    hits = found(spark, (None, 0, None, "Hello there."), (None, 1, "user", "> hello there.\nHi."), (3, None, "user", "> x"),
                 (4, 0, "user", None), (4, 0, "user", None), (5, 1, "user", ">\n>>\n> "), (6, 0, "user", "> a\n" * 20_000))
    assert hits[None, 1]["parent"] == 0 and hits[None, 0]["chat"] == "<|user|>\nHello there."
    assert hits[4, 0]["text"] == "" and hits[5, 1]["n_quotes"] == 0 and hits[6, 0]["n_quotes"] == 1
    assert hits[3, None]["root"] is None


def test_a_long_chain(spark):
    rows = [(1, 0, "user", "message 0")] + [(1, t, "user", f"> message {t - 1}\nmessage {t}") for t in range(1, 70)]
    hits = found(spark, *rows)
    assert all(hits[1, t]["root"] == 0 and hits[1, t]["depth"] == t for t in range(70))


def test_parts_of_messages_find_their_origin(spark):
    first = "The bridge is closed on Monday.\nPlease take the ferry instead. It leaves at nine in the morning.\nThank you."
    hits = found(
        spark, (1, 0, "user", first), (1, 1, "user", "Something else was said here before."),
        (1, 2, "user", "> The bridge is closed on Monday.\n> Please take the ferry instead. It leaves at nine in the morning.\nGood."),
        (1, 3, "user", "> It leaves at nine in\n> the morning.\n> Thank you.\nToo early."),  # wrapped anew, from the middle
        (1, 4, "user", "> It leaves at nine in the morning.\n> Something else was said here before.\n> Something else again was said.\nSo."),
        (1, 5, "user", "> Thank you.\n> And more that nobody wrote.\nNo."))
    assert [hits[1, t]["parent"] for t in range(6)] == [None, None, 0, 0, 1, None]
    assert [hits[1, t]["n_linked"] for t in range(6)] == [0, 0, 1, 1, 1, 0]
    assert hits[1, 3]["text"] == "Too early." and hits[1, 5]["n_quotes"] == 1


def test_clashing_columns_and_repeated_messages(spark):
    df = spark.createDataFrame([(1, 0, "user", "One line of text.", 5, "x"), (1, 1, "user", "> one line of text.\nYes.", 6, "y"),
                                (1, 1, "user", "> one line of text.\nYes.", 6, "y")],
                               "conv_id long, turn long, role string, text string, origin int, digest string")
    rows = [(r["turn"], r["parent"], r["n_quotes"], r["text"]) for r in link_quotes(df).collect()]
    assert sorted(rows, key=str) == [(0, None, 0, "One line of text."), (1, 0, 1, "Yes."), (1, 0, 1, "Yes.")]
