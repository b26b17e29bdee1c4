"""Quotation linking: threads of messages that quote one another, formatted without the quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import column, staged

QUOTE = r"^(?:[ \t]*>)+[ \t]?"  # the marks before a quoted line
FIRST_SENTENCE = r"^[^.]*[.]\s+"
SENTENCE_END = r"([.!?]) "
UNIT_WORDS = 3  # words of the shortest line or sentence by which a part of a message is recognised
RUN = ("scope", "seq", "k", "level")
ATTRIBUTION = r"(?i)^[ \t]*(?:on\b.*\bwrote|.*\b(?:wrote|writes|schrieb|a écrit|escribió))[ \t]*:[ \t]*$"


def normalised(text: Column) -> Column:
    """Text whose white space and letter case do not matter, for passages that mail programs rewrap."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def with_runs(messages: DataFrame) -> DataFrame:
    """``messages`` with ``runs``: the text cut where the quote level changes, as (level, text).

    Lines that only announce a quote are part of none. Each array is a column of its own before it
    is indexed, so that a text is read once.
    """
    lines = F.transform(F.split("text", "\r?\n"), lambda line: F.struct(
        (F.length(F.regexp_extract(line, QUOTE, 0))
         - F.length(F.translate(F.regexp_extract(line, QUOTE, 0), ">", ""))).alias("level"),
        F.regexp_replace(line, QUOTE, "").alias("text")))
    rows = messages.withColumn("lines", F.filter(lines, lambda x: ~x["text"].rlike(ATTRIBUTION)))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: (i == 0) | (F.get("lines", i)["level"] != F.get("lines", i - 1)["level"]))
    rows = rows.withColumn("starts", F.when(F.size("lines") > 0, starts).otherwise(F.array().cast("array<int>")))

    def run(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("lines"))
        part = F.slice("lines", start + 1, end - start)
        return F.struct(F.get("lines", start)["level"].alias("level"),
                        F.array_join(F.transform(part, lambda x: x["text"]), "\n").alias("text"))

    runs = F.filter(F.transform("starts", run), lambda r: r["text"].rlike(r"\S"))
    return rows.withColumn("runs", runs).drop("lines", "starts", "text")


def _roots(parents: DataFrame) -> DataFrame:
    """(scope, seq, root, depth) of every message, by doubling the step towards the root.

    Only messages that have not reached their root take part in a round, so the rounds of one long
    conversation cost the others nothing.
    """
    is_root = F.col("parent").isNull()
    state = staged(parents.select(
        "scope", "seq", F.coalesce("parent", "seq").alias("up"), F.when(is_root, 0).otherwise(1).alias("depth"),
        is_root.alias("done")), "steps")
    while not state.filter("NOT done").isEmpty():
        active = state.filter("NOT done")
        above = state.select(F.col("scope").alias("s"), F.col("seq").alias("q"), F.col("up").alias("next"),
                             F.col("depth").alias("more"), F.col("done").alias("end"))
        moved = (active.join(above, active["scope"].eqNullSafe(above["s"]) & (active["up"] == above["q"]))
                 .select("scope", "seq", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
                         F.col("end").alias("done")))
        state = staged(state.filter("done").unionByName(moved), "steps")
    return state.select("scope", "seq", F.col("up").alias("root"), "depth")


def units(text: Column) -> Column:
    """The different lines and sentences of a passage, normalised; short ones prove nothing."""
    lines = F.transform(F.split(text, "\n"), normalised)
    sentences = F.split(F.regexp_replace(normalised(text), SENTENCE_END, "$1\n"), "\n")
    return F.array_distinct(F.filter(F.concat(lines, sentences), lambda unit: F.length(unit) - F.length(
        F.translate(unit, " ", "")) >= UNIT_WORDS - 1))


def _hashes() -> list[Column]:
    return [F.xxhash64("passage").alias("hash"), F.md5("passage").alias("digest")]


def _origins(passages: DataFrame, name: str) -> DataFrame:
    """The first message of a scope that wrote each passage."""
    return staged(passages.filter("passage <> ''").select("scope", "seq", *_hashes())
                  .groupBy("scope", "hash", "digest").agg(F.min("seq").alias("origin")), name)


def _linked(quoted: DataFrame, origins: DataFrame) -> DataFrame:
    """``quoted`` with the origin of its passage, null where no earlier message wrote it."""
    same = (F.col("q.scope").eqNullSafe(F.col("o.scope")) & (F.col("q.hash") == F.col("o.hash"))
            & (F.col("q.digest") == F.col("o.digest")) & (F.col("o.origin") < F.col("q.seq")))
    return quoted.alias("q").join(origins.alias("o"), same, "left").select(
        *[F.col(f"q.{c}") for c in (*RUN, "text", "digest")], "o.origin")


def _by_units(runs: DataFrame, own: DataFrame) -> DataFrame:
    """``runs`` with the origin of most of their lines and sentences."""
    scopes = runs.select(F.col("scope").alias("s")).distinct()
    near = own.join(scopes, own["scope"].eqNullSafe(scopes["s"]), "left_semi")
    origins = _origins(near.select("scope", "seq", F.explode(units(F.col("text"))).alias("passage")), "unit_origins")
    key = [*RUN, "run_digest"]
    parts = (runs.select(*RUN, F.col("digest").alias("run_digest"), "text")
             .select(*key, F.explode(units(F.col("text"))).alias("passage")))
    same = (F.col("q.scope").eqNullSafe(F.col("o.scope")) & (F.col("q.hash") == F.col("o.hash"))
            & (F.col("q.digest") == F.col("o.digest")) & (F.col("o.origin") < F.col("q.seq")))
    found = (parts.select(*key, *_hashes()).alias("q").join(origins.alias("o"), same)
             .groupBy(*[F.col(f"q.{c}") for c in key], "o.origin").agg(F.count(F.lit(1)).alias("units"))
             .groupBy(*key).agg(F.max(F.struct("units", "origin")).alias("best")).alias("f"))
    back = F.col("r.scope").eqNullSafe(F.col("f.scope")) & (F.col("r.digest") == F.col("f.run_digest"))
    for c in RUN[1:]:
        back = back & (F.col(f"r.{c}") == F.col(f"f.{c}"))
    return runs.drop("origin").alias("r").join(found, back, "left").select("r.*", F.col("f.best.origin").alias("origin"))


def link_quotes(messages: DataFrame, scope_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, parent, root, depth, n_quotes, n_linked, text, chat.

    A quoted passage is a run of lines of one level. Its normalised hash is looked up among the runs
    and lines that messages of the same scope wrote themselves; the first message that wrote it is
    its origin. A run that no message wrote as it is, such as part of a message, is looked up by its
    lines and sentences of ``UNIT_WORDS`` or more words: its origin is the message that was the first
    to write most of them, the latest of several. The parent is the origin of the shallowest linked passage, the latest of several;
    it must come before the message. ``text`` is the message without quotes, ``chat`` the same
    behind its role. Ordered by (root, depth, turn), every message follows the one it answers.

    Only equal scope and order make two messages the same; repeated rows give repeated results.
    A null scope is a scope of its own, a message without order has no links. A null or empty text
    has no runs; an empty table gives no rows; other columns are not read. All joins are by hash or
    message, against one row per key, so a passage that very many messages quote is only joined once
    to each.
    """
    rows = messages.select(column(scope_col).alias("scope"), column(order_col).alias("seq"),
                           column(role_col).alias("role"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    rows = staged(with_runs(rows), "runs")
    said = rows.filter("seq IS NOT NULL").select("scope", "seq", F.posexplode("runs").alias("k", "run"))
    own = said.filter("run.level = 0").select("scope", "seq", F.col("run.text").alias("text"))
    whole = own.select("scope", "seq", F.explode(F.array_distinct(F.concat(
        F.array("text"), F.split("text", "\n")))).alias("passage")).withColumn("passage", normalised(F.col("passage")))
    quoted = said.filter("run.level > 0").select(
        "scope", "seq", "k", "run.level", F.col("run.text").alias("text"), normalised(F.col("run.text")).alias("passage"))
    quoted = staged(quoted.filter("passage <> ''").select(
        *RUN, "text", *_hashes()), "quoted")
    linked = staged(_linked(quoted, _origins(whole, "origins")), "linked")
    rest = linked.filter("origin IS NULL")
    if not rest.isEmpty():
        linked = linked.filter("origin IS NOT NULL").unionByName(staged(_by_units(rest, own), "linked_units"))
    # rows that repeat a message repeat its runs, which count once
    parents = linked.select(*RUN, "digest", "origin").distinct().groupBy("scope", "seq").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("origin").alias("n_linked"),
        F.min(F.when(F.col("origin").isNotNull(), F.struct("level", (-F.col("origin")).alias("late")))).alias("best"))
    parents = parents.select("scope", "seq", "n_quotes", "n_linked", (-F.col("best.late")).alias("parent"))
    keys = rows.filter("seq IS NOT NULL").select("scope", "seq").distinct()
    known = staged(keys.alias("k").join(
        parents.alias("p"), F.col("k.scope").eqNullSafe(F.col("p.scope")) & (F.col("k.seq") == F.col("p.seq")), "left")
        .select("k.scope", "k.seq", "parent", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
                F.coalesce("n_linked", F.lit(0)).alias("n_linked")), "parents")
    roots = _roots(known)
    facts = known.alias("k").join(roots.alias("r"), F.col("k.scope").eqNullSafe(F.col("r.scope"))
                                  & (F.col("k.seq") == F.col("r.seq"))).select(
        F.col("k.scope").alias("s"), F.col("k.seq").alias("q"), "parent", "root", "depth", "n_quotes", "n_linked")
    own_text = F.array_join(F.transform(F.filter("runs", lambda r: r["level"] == 0),
                                        lambda r: F.btrim(r["text"], F.lit(" \t\r\n"))), "\n")
    clean = rows.select("scope", "seq", "role", own_text.alias("text"))
    out = clean.join(facts, clean["scope"].eqNullSafe(facts["s"]) & (clean["seq"] == facts["q"]), "left")
    return out.select(
        F.col("scope").alias("conv_id"), F.col("seq").alias("turn"), "role", "parent",
        F.coalesce("root", "seq").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "text", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "text").alias("chat"))


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: each turn quotes the turn before it, and that one's quote of the turn
    before, at a deeper level. The first turn quotes nothing. Every third turn leaves out the first
    sentence of the turn before it, if there are more."""
    def quote(name: str, mark: str) -> Column:
        return F.regexp_replace(F.col(name), "(?dm)^", mark)

    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    said = staged(rows.groupBy("conv_id", "turn").agg(F.min("text").alias("text")), "said")
    for back in (1, 2):
        before = said.select(F.col("conv_id").alias("c"), (F.col("turn") + back).alias("t"),
                             F.col("text").alias(f"text{back}"))
        rows = rows.join(before, (rows["conv_id"] == before["c"]) & (rows["turn"] == before["t"]), "left").drop("c", "t")
    rows = rows.withColumn("text1", F.when(F.col("turn") % 3 == 2, F.regexp_replace("text1", FIRST_SENTENCE, ""))
                           .otherwise(F.col("text1")))
    return rows.select("conv_id", "turn", "role", F.concat_ws(
        "\n", F.when(F.col("text2").isNotNull(), quote("text2", "> > ")),
        F.when(F.col("text1").isNotNull(), quote("text1", "> ")), "text").alias("text"))


ORACLE = r"""
WITH RECURSIVE base AS (SELECT conv_id, turn, role, coalesce(text, '') AS own FROM conversations),
said AS (SELECT conv_id, turn, min(own) AS own FROM base GROUP BY ALL),
passages AS (SELECT conv_id, turn, trim(regexp_replace(lower(p), '\s+', ' ', 'g')) AS p FROM (
    SELECT conv_id, turn, own AS p FROM base
    UNION ALL SELECT conv_id, turn, unnest(string_split(own, chr(10))) FROM base)),
origins AS (SELECT conv_id, p, min(turn) AS origin FROM passages WHERE p <> '' GROUP BY ALL),
cited AS (SELECT b.conv_id, b.turn, k AS level, CASE WHEN k = 1 AND b.turn % 3 = 2
        THEN regexp_replace(s.own, '^[^.]*[.]\s+', '') ELSE s.own END AS cited
    FROM base b CROSS JOIN (VALUES (1), (2)) v(k) JOIN said s ON s.conv_id = b.conv_id AND s.turn = b.turn - k),
quoted AS (SELECT *, trim(regexp_replace(lower(cited), '\s+', ' ', 'g')) AS p FROM cited),
whole AS (SELECT q.*, origin FROM quoted q LEFT JOIN origins o ON o.conv_id = q.conv_id AND o.p = q.p AND origin < q.turn
    WHERE q.p <> ''),
texts AS (SELECT conv_id, turn, 0 AS level, own AS text FROM base
    UNION ALL SELECT conv_id, turn, level, cited FROM whole WHERE origin IS NULL),
parts AS (SELECT DISTINCT conv_id, turn, level, u FROM (
    SELECT conv_id, turn, level, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '\s+', ' ', 'g')) AS u FROM texts
    UNION ALL SELECT conv_id, turn, level, unnest(string_split(regexp_replace(
        trim(regexp_replace(lower(text), '\s+', ' ', 'g')), '([.!?]) ', '\1' || chr(10), 'g'), chr(10))) FROM texts)
    WHERE len(string_split(u, ' ')) >= 3),
first_parts AS (SELECT conv_id, u, min(turn) AS origin FROM parts WHERE level = 0 GROUP BY ALL),
votes AS (SELECT p.conv_id, p.turn, p.level, origin, count(*) AS n FROM parts p JOIN first_parts f
    ON f.conv_id = p.conv_id AND f.u = p.u AND origin < p.turn WHERE level > 0 GROUP BY ALL),
most AS (SELECT conv_id, turn, level, max(struct_pack(n := n, origin := origin)) AS m FROM votes GROUP BY ALL),
found AS (SELECT w.conv_id, w.turn, w.level, coalesce(w.origin, m.origin) AS origin
    FROM whole w LEFT JOIN most USING (conv_id, turn, level)),
links AS (SELECT conv_id, turn, count(*) AS n_quotes, count(origin) AS n_linked,
    min(CASE WHEN origin IS NOT NULL THEN struct_pack(level := level, late := -origin) END) AS best
    FROM found GROUP BY ALL),
parents AS (SELECT DISTINCT b.conv_id, b.turn, -best.late AS parent, coalesce(n_quotes, 0) AS n_quotes,
    coalesce(n_linked, 0) AS n_linked FROM base b LEFT JOIN links l USING (conv_id, turn)),
up AS (SELECT conv_id, turn, turn AS root, 0 AS depth FROM parents WHERE parent IS NULL
    UNION ALL SELECT p.conv_id, p.turn, up.root, up.depth + 1 FROM parents p JOIN up
    ON up.conv_id = p.conv_id AND up.turn = p.parent)
SELECT b.conv_id, b.turn, role, parent, root, depth, n_quotes, n_linked, trim(own, ' ' || chr(9) || chr(10) || chr(13)) AS text,
    '<|' || coalesce(role, 'user') || '|>' || chr(10) || trim(own, ' ' || chr(9) || chr(10) || chr(13)) AS chat
FROM base b JOIN parents USING (conv_id, turn) JOIN up USING (conv_id, turn)
"""
