"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells of source, language and topic. The cells' token weights are raked to
the target share of each source, language and topic in turn, and each document is then sampled with
a probability in proportion to its cell's weight over its natural share.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import column, staged, unpacked, whole_row

MARGINS = ("source", "lang", "topic")
UNKNOWN = "(none)"
ROUNDS = 8  # of raking; each fits every margin once
CAPS = 8  # steps in which cells reach probability one
POWER = 0.5  # default target: shares in proportion to tokens to this power
BUDGET = 0.5  # expected share of all tokens in the sample
SEED = "mix-1"
DIGITS = 6  # of the probabilities


def words(text: Column) -> Column:
    """Tokens of a text, as words between ASCII white space."""
    trimmed = F.regexp_replace(F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     ")), " +", " ")
    return F.when(trimmed == "", 0).otherwise(
        F.length(trimmed) - F.length(F.translate(trimmed, " ", "")) + 1).cast("long")


def form(text: Column, tokens: Column) -> Column:
    """A topic for texts that carry none: what form a text has."""
    return (F.when(text.contains(" | "), "table").when(text.rlike("[0-9]{3}"), "figures")
            .when(tokens >= 1000, "long prose").otherwise("prose"))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def described(docs: DataFrame, keep: Mapping[str, Column], text_col: str, source_col: str, lang_col: str,
              topic: Column | None) -> DataFrame:
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], text.alias("text"),
                       F.coalesce(column(source_col).cast("string"), F.lit(UNKNOWN)).alias("source"),
                       F.coalesce(column(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       *([] if topic is None else [F.coalesce(topic.cast("string"), F.lit(UNKNOWN)).alias("topic")]))
    rows = rows.withColumn("tokens", words(F.col("text")))
    if topic is None:
        rows = rows.withColumn("topic", form(F.col("text"), F.col("tokens")))
    return rows.select(*keep, *MARGINS, "tokens")


def _target(cells: DataFrame, margin: str, given: Mapping[str, float] | None, power: float) -> DataFrame:
    """(margin, target share) over the values that have tokens, summing to one.

    Values that ``given`` does not name have no share.
    """
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("tokens")).filter("tokens > 0")
    if given is None:
        share = F.pow("tokens", F.lit(power))
    else:
        share = F.lit(0.0)
        if given:
            table = F.create_map(*[F.lit(x) for item in given.items() for x in item])
            share = F.coalesce(table[F.col(margin)].cast("double"), F.lit(0.0))
    sums = staged(sums.select(margin, share.alias("target")), f"target_{margin}")
    total = sums.agg(F.sum("target")).first()[0] or 1.0
    return sums.select(margin, (F.col("target") / F.lit(total)).alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells with ``weight``: their token share after fitting each margin ``rounds`` times.

    The targets are joined once, and every fit is written before the next one reads it: a fit reads the
    cells twice, so a plan of several holds the first ones many times over, and the driver keeps each
    broadcast table and each description of such a plan.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    for margin, target in targets.items():
        cells = cells.join(target.withColumnRenamed("target", f"target_{margin}"), margin, "left")
    cells = staged(cells.withColumn("weight", F.col("tokens") / F.lit(total)), "unfitted")
    for i in range(rounds):
        for margin in targets:
            sums = cells.groupBy(margin).agg(F.sum("weight").alias("sum"))
            factor = F.when(F.col("sum") > 0, F.coalesce(f"target_{margin}", F.lit(0.0)) / F.col("sum")).otherwise(0.0)
            fitted = cells.join(sums, margin).withColumn("weight", F.col("weight") * factor).drop("sum")
            cells = staged(fitted, f"raked_{i}_{margin}")
    return cells.drop(*[f"target_{margin}" for margin in targets])


def calibrated(cells: DataFrame, budget: float = BUDGET, caps: int = CAPS) -> DataFrame:
    """Cells with ``ratio`` (weight over natural share) and ``probability``.

    The probability is c * ratio, at most one. The constant c is raised in steps, each of which
    takes the cells that have reached one out of the budget, so that the expected tokens of the
    sample are ``budget`` of all; cells without weight get none.
    """
    tokens, weights = cells.agg(F.sum("tokens"), F.sum("weight")).first()
    tokens, weights = float(tokens or 0), float(weights or 0) or 1.0
    share = F.col("tokens") / F.lit(max(tokens, 1.0))
    cells = cells.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.lit(weights) / share)
                             .otherwise(0.0))
    c = budget
    for _ in range(caps):
        full = F.lit(c) * F.col("ratio") >= 1
        inside = F.col("tokens") * F.col("ratio")
        capped, rest = cells.agg(F.sum(F.when(full, F.col("tokens").cast("double"))),
                                 F.sum(F.when(~full, inside))).first()
        if rest:
            c = max(c, (budget * tokens - (capped or 0.0)) / rest)
    return cells.withColumn("probability", F.round(F.least(F.lit(c) * F.col("ratio"), F.lit(1.0)), DIGITS))


def _cells(rows: DataFrame, targets: Mapping[str, Mapping[str, float]], power: float, rounds: int,
           budget: float, caps: int) -> DataFrame:
    cells = staged(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    margins = {m: _target(cells, m, targets.get(m), power) for m in MARGINS}
    return staged(calibrated(rake(cells, margins, rounds), budget, caps), "probabilities").select(
        *MARGINS, "ratio", "probability")


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
        topic: Column | None = None, power: float = POWER, rounds: int = ROUNDS, budget: float = BUDGET,
        caps: int = CAPS, seed: str = SEED) -> DataFrame:
    """One row per input row: doc_id, source, lang, topic, tokens, ratio, probability, sampled.

    ``targets`` gives shares by value for some of source, lang and topic; the others aim at shares in
    proportion to tokens to the ``power``. ``topic`` is the topic column; without one the form of the
    text is used. Whether a row is sampled depends on its id, the seed and its probability, so
    repeated rows go together; a null id counts as an empty one. A null source, language or topic
    is a value of its own. A document without tokens has its cell's probability, and where a
    whole cell has no tokens it is zero. An empty table gives no rows.
    """
    rows = staged(described(docs, {"doc_id": column(id_col)}, text_col, source_col, lang_col, topic), "described")
    cells = _cells(rows, targets or {}, power, rounds, budget, caps)
    return rows.join(cells, list(MARGINS)).select(
        "doc_id", *MARGINS, "tokens", F.round("ratio", DIGITS).alias("ratio"), "probability",
        (uniform(F.col("doc_id"), seed) < F.col("probability")).alias("sampled"))


def sampled(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
            topic: Column | None = None, power: float = POWER, rounds: int = ROUNDS, budget: float = BUDGET,
            caps: int = CAPS, seed: str = SEED) -> DataFrame:
    """The sampled rows with all their columns."""
    names = text_col, source_col, lang_col
    cells = _cells(described(docs, {}, *names, topic), targets or {}, power, rounds, budget, caps)
    keep = {"row": whole_row(docs), "doc_id": column(id_col)}
    rows = described(docs, keep, *names, topic).join(cells, list(MARGINS))
    return unpacked(rows.filter(uniform(F.col("doc_id"), seed) < F.col("probability")), "row", docs.columns)


def _sql() -> str:
    text = "translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')"
    text = f"regexp_replace(trim({text}, ' '), ' +', ' ', 'g')"
    parts = [f"""d AS (SELECT doc_id, coalesce(source, '{UNKNOWN}') AS source, coalesce(lang, '{UNKNOWN}') AS lang,
          coalesce(text, '') AS raw, CASE WHEN {text} = '' THEN 0
            ELSE length({text}) - length(replace({text}, ' ', '')) + 1 END AS tokens FROM documents),
      rows_ AS (SELECT doc_id, source, lang, tokens, CASE WHEN contains(raw, ' | ') THEN 'table'
          WHEN regexp_matches(raw, '[0-9]{{3}}') THEN 'figures' WHEN tokens >= 1000 THEN 'long prose'
          ELSE 'prose' END AS topic FROM d),
      c0 AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM rows_ GROUP BY ALL),
      w0 AS (SELECT *, tokens / sum(tokens) OVER () AS weight FROM c0)"""]
    for m in MARGINS:
        parts.append(f"""t_{m} AS (SELECT {m}, t / sum(t) OVER () AS target FROM
          (SELECT {m}, pow(sum(tokens), {POWER}) AS t FROM c0 GROUP BY 1 HAVING sum(tokens) > 0))""")
    n = 0
    for _ in range(ROUNDS):
        for m in MARGINS:
            parts.append(f"""w{n + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens,
              CASE WHEN s > 0 THEN weight * coalesce(target, 0) / s ELSE 0 END AS weight
              FROM (SELECT *, sum(weight) OVER (PARTITION BY {m}) AS s FROM w{n}) LEFT JOIN t_{m} USING ({m}))""")
            n += 1
    parts.append(f"""r AS MATERIALIZED (SELECT *, CASE WHEN tokens > 0 THEN weight / (sum(weight) OVER ())
          / (tokens / sum(tokens) OVER ()) ELSE 0 END AS ratio FROM w{n}),
      k0 AS (SELECT {BUDGET}::DOUBLE AS c)""")
    for i in range(CAPS):
        parts.append(f"""k{i + 1} AS MATERIALIZED (SELECT greatest(any_value(c), coalesce(({BUDGET} * sum(tokens)
          - coalesce(sum(tokens) FILTER (c * ratio >= 1), 0))
          / nullif(sum(tokens * ratio) FILTER (c * ratio < 1), 0), any_value(c))) AS c FROM r, k{i})""")
    return f"""WITH {', '.join(parts)},
      p AS (SELECT source, lang, topic, ratio, round(least(c * ratio, 1.0), {DIGITS}) AS probability FROM r, k{CAPS})
      SELECT doc_id, source, lang, topic, tokens::BIGINT AS tokens, round(ratio, {DIGITS}) AS ratio, probability,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13))::UBIGINT / pow(16.0, 13)
          < probability AS sampled
      FROM rows_ JOIN p USING (source, lang, topic)"""


ORACLE = _sql()
