from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendlens.llm import mixing


@pytest.fixture
def corpus(spark):
    rows = [(i, "w " * (5 + i % 7), ("en", "de", "fr")[i * 7 % 3], ("a", "b")[i % 5 == 0], ("x", "y")[i % 2])
            for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kind string")


def test_margins_are_met(corpus):
    targets = {"source": {"a": 0.3, "b": 0.7}, "lang": {"en": 0.5, "de": 0.25, "fr": 0.25}, "topic": {"x": 0.5, "y": 0.5}}
    d = mixing.described(corpus, {"doc_id": F.col("doc_id")}, "text", "source", "lang", F.col("kind"))
    cells = d.groupBy(*mixing.MARGINS).agg(F.sum("tokens").alias("tokens"))
    margins = {m: mixing._target(cells, m, targets[m], 0.5) for m in mixing.MARGINS}
    raked = mixing.rake(cells, margins, rounds=12)
    for margin, shares in targets.items():
        found = {r[0]: r[1] for r in raked.groupBy(margin).agg(F.sum("weight")).collect()}
        assert found == pytest.approx(shares, abs=1e-3)


def test_expected_tokens_are_the_budget(corpus):
    found = mixing.mix(corpus, topic=F.col("kind"), budget=0.4)
    expected, total = found.agg(F.sum(F.col("probability") * F.col("tokens")), F.sum("tokens")).first()
    assert expected / total == pytest.approx(0.4, abs=1e-3)
    assert found.filter("probability > 1 or probability < 0").isEmpty()


def test_the_sample_is_the_same_each_time(corpus):
    kept = [sorted(r["doc_id"] for r in mixing.sampled(corpus.repartition(n)).collect()) for n in (1, 3)]
    assert kept[0] == kept[1] == sorted(r["doc_id"] for r in mixing.mix(corpus).filter("sampled").collect())


def test_values_without_a_target_are_left_out(corpus):
    kept = mixing.sampled(corpus, targets={"lang": {"en": 1.0}}, budget=0.2)
    assert {r["lang"] for r in kept.select("lang").distinct().collect()} == {"en"}


def test_a_written_plan_holds_one_fit(corpus, monkeypatch):
    plans, staged = {}, mixing.staged

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(mixing, "staged", recorded)
    assert mixing.sampled(corpus, topic=F.col("kind")).count() > 0
    fits = {name: plan.count("Join ") for name, plan in plans.items() if name.startswith("raked")}
    assert fits == {f"raked_{i}_{margin}": 1 for i in range(mixing.ROUNDS) for margin in mixing.MARGINS}
