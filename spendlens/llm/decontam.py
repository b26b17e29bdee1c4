"""Benchmark decontamination by template windows with slot checks.

A text becomes a template: numbers, units after numbers and names inside sentences are replaced by
typed placeholders. Windows of template words are hashed and joined to those of the benchmark, so a
question is found again after its numbers or names have been changed. Where an item has slots, each
of its values must stand for one value of the document throughout the passage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import column, id_and_text, staged, unpacked, whole_row

WORDS = 8  # words of a window
INSIDE = 4  # words of the shortest item that is looked for inside a text
PAIR = ("doc_id", "item_id", "length")
COVERED = 0.5  # share of an item's words that its windows must cover in a document
MAX_BROADCAST_WINDOWS = 1_000_000  # 24 bytes each; more of them are joined by a shuffle

# Unit words, in lower case.
UNITS = """
    acres bytes celsius cents centimeters centimetres cm cups days degrees dollars dozen euros fahrenheit
    feet foot ft gallons gb grams hectares hours hz inch inches kb kelvin kg kilograms kilometers
    kilometres km kmh kw lb lbs liters litres mb meters metres mg miles minutes ml mm months mph ounces
    oz percent pints pounds seconds tons tonnes volts watts weeks yards years
""".split()
NUMBER, UNIT, NAME, MARK = "#", "%", "@", "\x01"


def marked(text: Column) -> Column:
    """The words of a text, one space apart: letters and digits, numbers without separators, and a mark
    before each capitalised word that does not begin a sentence."""
    text = F.translate(text, MARK, " ")
    text = F.regexp_replace(text, r"(?<=\p{Nd})[.,:](?=\p{Nd})", "")
    text = F.regexp_replace(text, r"(?<=[\p{L}\p{Nd},;] )(?=\p{Lu}\p{Ll})", MARK)
    return F.trim(F.regexp_replace(text, rf"[^\p{{L}}\p{{Nd}}{MARK}]+", " "))


def _split(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def marked_words(text: Column) -> Column:
    return _split(marked(text))


def template(words: Column, names: bool) -> Column:
    """Words in lower case with placeholders; names are replaced too if ``names``."""
    def number(word: Column) -> Column:
        return word.rlike(r"^\x01?\p{Nd}")

    def typed(word: Column, at: Column) -> Column:
        plain = F.lower(F.translate(word, MARK, ""))
        before = F.get(words, at - 1)
        kind = F.when(number(word), NUMBER).when(plain.isin(UNITS) & number(before), UNIT)
        if names:
            kind = kind.when(word.startswith(MARK), NAME)
        return kind.otherwise(plain)

    return F.transform(words, typed)


def _windows(hashes: Column, size: int) -> Column:
    """Hash of each window of word hashes; a text of fewer words is one window."""
    def window(at: Column) -> Column:
        return F.xxhash64(*[F.get(hashes, at + i) for i in range(size)])

    last = F.greatest(F.size(hashes) - size, F.lit(0))
    return F.when(F.size(hashes) > 0, F.transform(F.sequence(F.lit(0), last), window))


def template_text(text: Column) -> Column:
    """``template`` of a whole marked text, names still marked: a few replacements in one string instead
    of a function for every word."""
    text = F.regexp_replace(F.lower(text), r"(?:^|(?<= ))\p{Nd}[^ ]*", NUMBER)
    return F.regexp_replace(text, rf"{NUMBER} {MARK}?(?:{'|'.join(UNITS)})(?= |$)", f"{NUMBER} {UNIT}")


def windows(texts: DataFrame, size: int, names: bool) -> DataFrame:
    """(doc_id, at, window) of each window of each text.

    With ``names``, the windows of a text with names come a second time, with names as placeholders.
    Each array is a column of its own before it is indexed, so that it is built once per text.
    """
    def hashes(template: Column) -> Column:
        return F.transform(F.split(template, " "), lambda word: F.xxhash64(word))

    typed = F.when(F.col("marked").contains(MARK), F.regexp_replace("marked", f"{MARK}[^ ]+", NAME))
    rows = (texts.select("doc_id", template_text(marked(F.col("text"))).alias("marked")).filter("marked <> ''")
            .select("doc_id", hashes(F.translate("marked", MARK, "")).alias("plain"),
                    (hashes(typed) if names else F.lit(None).cast("array<bigint>")).alias("typed"))
            .select("doc_id", _windows(F.col("plain"), size).alias("plain"), _windows(F.col("typed"), size).alias("typed")))
    both = F.concat("plain", F.coalesce("typed", F.array().cast("array<bigint>")))
    return (rows.select("doc_id", F.size("plain").alias("n"), F.posexplode(both).alias("at", "window"))
            .select("doc_id", (F.col("at") % F.col("n")).alias("at"), "window"))


def _items(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, words, length) of each item with words; equal ids keep all their texts."""
    rows = benchmark.select(F.col("doc_id").alias("item_id"), marked_words(F.col("text")).alias("words"))
    return rows.withColumn("length", F.size("words")).filter("length > 0").distinct()


def _item_windows(items: DataFrame, size: int, names: bool) -> DataFrame:
    """(window, item_id, at, length); windows that are mostly placeholders say too little and are left out."""
    typed = template(F.col("words"), names)
    rows = (items.select("item_id", "length", typed.alias("typed"))
            .select("item_id", "length", F.explode(F.transform(
                F.sequence(F.lit(0), F.greatest(F.col("length") - size, F.lit(0))),
                lambda at: F.struct(at.alias("at"), F.slice("typed", at + 1, size).alias("words"))))
                .alias("part")))
    part = F.col("part.words")
    said = F.size(F.filter(part, lambda w: ~w.isin(NUMBER, UNIT, NAME)))
    hashes = F.transform(part, lambda word: F.xxhash64(word))
    return (rows.filter(2 * said >= F.size(part))
            .select("item_id", "length", F.col("part.at").alias("item_at"), hashes.alias("hashes"))
            .select(F.xxhash64(*[F.get("hashes", F.lit(i)) for i in range(size)]).alias("window"),
                    "item_id", "item_at", "length").distinct())


def _passages(hits: DataFrame, size: int, covered: float) -> DataFrame:
    """(PAIR, chain, parts, covered): the passages of a document that cover enough of an item's words.

    A part is what matches at one shift between document and item. Where words are put in or left out,
    the shift changes by a little, so parts whose shifts lie at most ``size`` apart make one passage.
    """
    place = Window.partitionBy(*PAIR).orderBy("shift")
    parts = (hits.groupBy(*PAIR, "shift").agg(F.collect_set("word").alias("words"))
             .withColumn("apart", F.col("shift") - F.lag("shift").over(place) > size)
             .withColumn("chain", F.sum(F.coalesce(F.col("apart"), F.lit(False)).cast("int")).over(place)))
    words = F.array_distinct(F.flatten(F.col("parts.words")))
    return (parts.groupBy(*PAIR, "chain").agg(F.collect_list(F.struct("shift", "words")).alias("parts"))
            .withColumn("found", words).withColumn("covered", F.size("found"))
            .filter(F.col("covered") >= covered * F.col("length")))


def _consistent(found: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Passages with the number of slots they cover and of changed values; those where one value of the
    item stands for two values of the document are left out. A slot that two parts cover is read where
    the larger one puts it."""
    slots = F.filter(
        F.transform(template(F.col("words"), True),
                    lambda kind, at: F.struct(kind.alias("kind"), at.alias("at"),
                                              F.lower(F.translate(F.get("words", at), MARK, "")).alias("value"))),
        lambda s: s["kind"].isin(NUMBER, UNIT, NAME))
    slots = items.select("item_id", "length", slots.alias("slots"))
    held = F.filter("slots", lambda s: F.array_contains("found", s["at"]))
    found = staged(found.join(slots, ["item_id", "length"]).withColumn("slots", held).drop("found"), "passages")
    plain = found.filter(F.size("slots") == 0).select(
        "doc_id", "item_id", "length", "covered", F.lit(0).alias("slots"), F.lit(0).alias("changed"))
    open_ = found.filter(F.size("slots") > 0)
    if open_.isEmpty():
        return plain
    words = (docs.join(open_.select("doc_id").distinct(), "doc_id", "left_semi")
             .select("doc_id", marked_words(F.col("text")).alias("doc_words")))

    key = [*PAIR, "chain", "covered"]
    parts = open_.select(*key, "slots", F.explode("parts").alias("part"))
    slots = parts.select(*key, "part", F.explode("slots").alias("slot")).filter(
        F.array_contains("part.words", F.col("slot.at")))
    word = F.get("doc_words", F.col("slot.at") + F.col("part.shift"))
    valued = slots.join(words, "doc_id").select(
        *key, "slot.kind", F.col("slot.at").alias("at"), F.col("slot.value").alias("item"),
        F.lower(F.translate(word, MARK, "")).alias("doc"),
        F.struct(F.size("part.words"), -F.col("part.shift")).alias("weight"))
    checked = (valued.groupBy(*key, "kind", "item", "at").agg(F.max_by("doc", "weight").alias("doc"))
               .groupBy(*key, "kind", "item")
               .agg(F.count_distinct("doc").alias("values"), F.min("doc").alias("value"))
               .groupBy(*key).agg(F.max("values").alias("most"), F.count(F.lit(1)).cast("int").alias("slots"),
                                  F.sum((F.col("value") != F.col("item")).cast("int")).cast("int").alias("changed"))
               .filter("most <= 1"))
    return plain.unionByName(checked.select(*plain.columns))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", size: int = WORDS,
                 covered: float = COVERED) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, coverage, slots, changed.

    ``coverage`` is the share of the item's words that lie in matching windows of one passage, ``slots``
    the number of distinct numbers, units and names among them, ``changed`` how many of them the document
    gives another value. Of several passages of a document the best counts. An item of fewer than
    ``size`` words is looked for as a whole, and one of fewer than ``INSIDE`` words matches documents
    that consist of it alone. Null and empty texts, items without words and empty tables match nothing;
    repeated rows give one row; other columns are not read.
    """
    docs = id_and_text(docs, id_col, text_col)
    items = staged(_items(id_and_text(benchmark, item_id_col, item_text_col), size), "items")
    names = not items.filter(F.exists("words", lambda w: w.startswith(MARK))).isEmpty()
    keys = _item_windows(items, size, False)
    if names:
        keys = keys.unionByName(_item_windows(items, size, True)).distinct()
    keys = staged(keys, "item_windows")
    if keys.count() <= MAX_BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    short = items.filter(F.col("length").between(INSIDE, size - 1)).select("length").distinct().collect()
    of_docs = reduce(DataFrame.unionByName, [windows(docs, n, names) for n in (size, *sorted(r.length for r in short))])
    offsets = F.sequence(F.col("item_at"), F.least(F.col("item_at") + size, F.col("length")) - 1)
    hits = (of_docs.join(keys, "window")
            .select("doc_id", "item_id", "length", (F.col("at") - F.col("item_at")).alias("shift"),
                    F.explode(offsets).alias("word")))
    best = F.max(F.struct((F.col("covered") / F.col("length")).alias("coverage"), "slots", "changed"))
    return (_consistent(_passages(hits, size, covered), docs, items).groupBy("doc_id", "item_id")
            .agg(best.alias("best")).select("doc_id", "item_id", "best.coverage", "best.slots", "best.changed"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The rows of documents without a benchmark item, with all columns; rows with a null id stay."""
    found = staged(contaminated(docs, benchmark, id_col, text_col).select("doc_id").distinct(), "contaminated")
    rows = docs.select(whole_row(docs).alias("row"), column(id_col).alias("doc_id"))
    return unpacked(rows.join(found, "doc_id", "left_anti"), "row", docs.columns)


_UNITS = ", ".join(f"'{u}'" for u in UNITS)


def _sql_words(key: str, table: str) -> str:
    """Words of a table's texts; each replacement runs twice where its matches may overlap."""
    text = "translate(coalesce(text, ''), chr(1), ' ')"
    for _ in range(2):
        text = rf"regexp_replace({text}, '(\p{{Nd}})[.,:](\p{{Nd}})', '\1\2', 'g')"
    for _ in range(2):
        text = rf"regexp_replace({text}, '([\p{{L}}\p{{Nd}},;] )(\p{{Lu}}\p{{Ll}})', '\1' || chr(1) || '\2', 'g')"
    text = rf"trim(regexp_replace({text}, '[^\p{{L}}\p{{Nd}}\x01]+', ' ', 'g'))"
    return f"""SELECT {key}, CASE WHEN {text} = '' THEN [] ELSE string_split({text}, ' ') END AS words
        FROM {table}"""


def _sql_template(names: bool) -> str:
    name = f"WHEN starts_with(w, chr(1)) THEN '{NAME}'" if names else ""
    return rf"""list_transform(words, lambda w, i: CASE
        WHEN regexp_matches(w, '^\x01?\p{{Nd}}') THEN '{NUMBER}'
        WHEN i > 1 AND lower(replace(w, chr(1), '')) IN ({_UNITS})
             AND regexp_matches(words[i - 1], '^\x01?\p{{Nd}}') THEN '{UNIT}'
        {name} ELSE lower(replace(w, chr(1), '')) END)"""


ORACLE = f"""
WITH d AS ({_sql_words('doc_id', 'documents')}), b AS ({_sql_words('item_id', 'benchmark')}),
items AS (SELECT DISTINCT item_id, words, len(words) AS length FROM b WHERE len(words) > 0),
dt AS (SELECT doc_id, words, {_sql_template(False)} AS t FROM d WHERE len(words) > 0
       UNION ALL SELECT doc_id, words, {_sql_template(True)} AS t FROM d WHERE len(words) > 0),
it AS (SELECT item_id, length, {_sql_template(False)} AS t FROM items
       UNION ALL SELECT item_id, length, {_sql_template(True)} AS t FROM items),
sizes AS (SELECT {WORDS} AS size UNION SELECT length FROM items WHERE length BETWEEN {INSIDE} AND {WORDS} - 1),
da AS (SELECT doc_id, t, size, unnest(range(greatest(len(t) - size, 0) + 1)) AS p FROM dt, sizes),
ia AS (SELECT item_id, length, t, unnest(range(greatest(len(t) - {WORDS}, 0) + 1)) AS p FROM it),
dw AS (SELECT DISTINCT doc_id, p, array_to_string(list_slice(t, p + 1, p + size), ' ') AS w FROM da),
iw AS (SELECT DISTINCT item_id, length, p, array_to_string(list_slice(t, p + 1, p + {WORDS}), ' ') AS w FROM ia
       WHERE 2 * len(list_filter(list_slice(t, p + 1, p + {WORDS}), lambda x: x NOT IN ('{NUMBER}', '{UNIT}', '{NAME}')))
             >= len(list_slice(t, p + 1, p + {WORDS}))),
hits AS (SELECT doc_id, item_id, length, dw.p - iw.p AS shift,
                unnest(range(iw.p, least(iw.p + {WORDS}, length))) AS word
         FROM dw JOIN iw USING (w)),
parts AS (SELECT doc_id, item_id, length, shift, list_distinct(list(word)) AS words FROM hits GROUP BY ALL),
apart AS (SELECT *, shift - lag(shift) OVER (PARTITION BY doc_id, item_id, length ORDER BY shift) > {WORDS} AS far
          FROM parts),
chained AS (SELECT *, sum(CASE WHEN far THEN 1 ELSE 0 END)
                      OVER (PARTITION BY doc_id, item_id, length ORDER BY shift) AS chain FROM apart),
found AS (SELECT doc_id, item_id, length, chain, len(list_distinct(flatten(list(words)))) AS covered FROM chained
          GROUP BY ALL HAVING len(list_distinct(flatten(list(words)))) >= {COVERED} * length),
slots AS (SELECT item_id, length, unnest(range(length)) AS p, words, {_sql_template(True)} AS t FROM items),
pairs AS (SELECT doc_id, item_id, length, chain, p, t[p + 1] AS kind,
                 lower(replace(s.words[p + 1], chr(1), '')) AS item_value,
                 arg_max(lower(replace(d.words[p + shift + 1], chr(1), '')),
                         struct_pack(size := len(c.words), near := -shift)) AS doc_value
          FROM found JOIN chained c USING (doc_id, item_id, length, chain) JOIN slots s USING (item_id, length)
          JOIN d USING (doc_id)
          WHERE t[p + 1] IN ('{NUMBER}', '{UNIT}', '{NAME}') AND list_contains(c.words, p) GROUP BY ALL),
vals AS (SELECT doc_id, item_id, length, chain, kind, item_value, count(DISTINCT doc_value) AS n,
                min(doc_value) AS v FROM pairs GROUP BY ALL),
checked AS (SELECT doc_id, item_id, length, chain, max(n) AS most, count(*) AS slots,
                   sum(CASE WHEN v <> item_value THEN 1 ELSE 0 END) AS changed FROM vals GROUP BY ALL),
best AS (SELECT f.doc_id, f.item_id, max(struct_pack(coverage := covered::DOUBLE / f.length,
                slots := coalesce(slots, 0), changed := coalesce(changed, 0))) AS m
         FROM found f LEFT JOIN checked c USING (doc_id, item_id, length, chain)
         WHERE coalesce(most, 0) <= 1 GROUP BY ALL)
SELECT doc_id, item_id, m.coverage AS coverage, m.slots::INTEGER AS slots, m.changed::INTEGER AS changed
FROM best
"""
