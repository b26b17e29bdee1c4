from __future__ import annotations

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F

from spendlens.llm.decontam import (
    MARK, ORACLE, contaminated, decontaminated, marked, marked_words, template, template_text)

ITEM = ("A train travels 60 km in 2 hours. How far does Maria think it goes in 5 hours, asked Peter, "
        "if Maria keeps 60 km as the distance?")
OTHER = ITEM.replace("60 km", "1,275.5 miles").replace("Maria", "Julia").replace("Peter", "Tom")
MIXED = OTHER.replace("Julia keeps 1,275.5", "Hans keeps 80")


def found(spark, docs, *items):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): (r["coverage"], r["changed"] > 0) for r in contaminated(docs, bench).collect()}


def test_copies_and_other_parameters_are_found(spark, docs):
    d = docs((1, f"before it {ITEM} and after"), (2, f"words. {OTHER}"), (3, MIXED), (4, ITEM.upper()), (5, None),
             (6, "a clean text that shares only as the distance with the item"))
    hits = found(spark, d, (1, ITEM), (2, None), (3, ""))
    assert hits[1, 1] == (1.0, False) and hits[2, 1] == (1.0, True)
    assert not {k for k in hits if k[0] in (3, 5, 6)}


def test_without_slots(spark, docs):
    item = "which of the following words names a colour that is seen at the end of the day"
    d = docs((1, "x, " + item.title()), (2, item.replace("colour", "tone")), (3, " ".join(item.split()[:8])), (4, item[:20]))
    assert set(found(spark, d, (7, item))) == {(1, 7), (2, 7)}  # 8 of 18 words are too few


def test_short_items_match_whole_documents_alone(spark, docs):
    assert set(found(spark, docs((1, "Short item!"), (2, "a short item here")), (1, "short item"))) == {(1, 1)}


def test_short_items_are_found_inside_texts(spark, docs):
    item = "What is the capital of France?"
    d = docs((1, f"They asked him: {item} He did not know."), (2, "What is the capital of Spain? he said again."),
             (3, "the capital of France is what it is"), (4, None))
    assert found(spark, d, (9, item)).keys() >= {(1, 9), (2, 9)}
    assert (3, 9) not in found(spark, d, (9, item))


PLAIN = ("Anna buys 12 apples and 30 pears at the market on Monday morning, then Anna gives her sister 12 apples and "
         "sells the 30 pears for 45 euros to a neighbour who lives near the river")


def test_a_word_put_in_or_left_out(spark, docs):
    put_in = PLAIN.replace("on Monday morning", "on a Monday morning")
    left_out = PLAIN.replace("at the market on", "at market on")
    changed = put_in.replace("12 apples", "17 apples")
    hits = found(spark, docs((1, f"Before it. {put_in}."), (2, left_out), (3, f"x y z {changed}")), (1, PLAIN))
    assert hits.keys() == {(1, 1), (2, 1), (3, 1)}
    assert [hits[k, 1][1] for k in (1, 2, 3)] == [False, False, True]
    assert all(coverage > 0.6 for coverage, _ in hits.values())


def test_values_outside_the_copied_part_do_not_count(spark, docs):
    words = PLAIN.split()
    copied = " ".join(words[:len(words) * 2 // 3])
    d = docs((1, f"{copied} and nothing else of it, but 99 other words and 7 Names of Peter and 1 more, 2 of 3"),
             (2, " ".join(words[:10])))
    assert found(spark, d, (1, PLAIN)).keys() == {(1, 1)}


def test_templates_of_texts_are_those_of_their_words(spark):
    texts = [ITEM, OTHER, MIXED, PLAIN, "", "  ", "5 Km, 6 kg km 7", "3rd of 12th; Anna Bell. Tom 1,000.5 kg", "x # 5 % @ 4 feet",
             "Ünder Ärger, Σας 7 Σ", "A b, C d. E 12:30 hours Maria", "\x01Word 5 \x01Kg"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for names in (False, True):
        whole = template_text(marked(F.col("text")))
        whole = F.regexp_replace(whole, f"{MARK}[^ ]+", "@") if names else F.translate(whole, MARK, "")
        found = rows.select(whole.alias("a"), F.array_join(template(marked_words(F.col("text")), names), " ").alias("b")).collect()
        assert [r["a"] for r in found] == [r["b"] for r in found]


@pytest.mark.parametrize("texts, items", [
    ([ITEM, OTHER, MIXED, f"before {OTHER} after {ITEM}"], [ITEM]),
    ([PLAIN.replace("Monday", "a Monday"), PLAIN.replace("the ", ""), PLAIN[:100], f"{PLAIN} {PLAIN}"], [PLAIN, ITEM]),
    (["They said: What is the capital of Spain? No.", "the capital of France"], ["What is the capital of France?", "a b"])])
def test_equals_sql(spark, texts, items):
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", documents.toPandas())
    con.register("benchmark", benchmark.toPandas())
    assert difference(contaminated(documents, benchmark), con, ORACLE) is None


def test_contaminated_documents_go(spark, docs):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminated(docs((1, ITEM), (2, "clean")), bench).collect()] == [2]
