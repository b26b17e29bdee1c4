"""Toxicity by weak supervision.

Many voters (lexicons and patterns) vote on each document. A generative model estimates how
accurate each voter is and which voters are correlated, from the vote patterns of all documents.
Its posterior labels train a linear classifier over bounded n-gram features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import id_and_text, staged
from spendlens.llm.labels import FOLDS, held_out, labelled_sample

MAX_ROWS = 20_000  # labelled rows, and rows with posterior labels, that are learnt from at most
LEAST_RATIO = 14.0  # log-likelihood ratio of an n-gram with the toxic label, to enter a lexicon
WEAK, STRONG = 0.9, 0.98  # share of toxic documents, of equally many of both kinds, for each tier
THRESHOLD = 0.5
SURE = 0.98  # accuracy of a given label, as one more voter on its document

# Common English insults.
INSULTS = frozenset("""
    clown coward creep cretin disgusting dumb dumbass dumbo fool freak idiot idiotic imbecile jerk
    loser lowlife lunatic moron moronic nitwit pathetic pig scum scumbag sick stupid trash ugly
    useless vermin weirdo worthless
""".split())

WORD = re.compile(r"\w+")
PREFIXES = range(3, 8)  # lengths of word prefixes that may enter a lexicon
HEAD = PREFIXES[0]

PATTERNS = (
    re.compile(r"\byou(?:'re| are|r)?\s+(?:an?|so|such|all)\b"),
    re.compile(r"\b(?:kill|hurt|hate|shoot) (?:you|him|her|them|yourself)\b"
               r"|\bgo (?:die|to hell)\b|\bshut up\b|\bget lost\b"),
    re.compile(r"\b[a-z]+[*@$][a-z]+\b"),
    re.compile(r"!{3,}"),
)

LEXICONS = ("strong word", "strong stem", "strong start", "weak word", "weak stem", "weak start")
VOTERS = (*LEXICONS, "insult", "address", "threat", "disguise", "shout", "no hit", "sparse", "dense")
DENSE = 0.01  # words with a strong n-gram, of all words, that separate "sparse" from "dense"
DENSITIES = np.array([1e-9, 0.0025, 0.005, 0.01, 0.015, 0.03])  # edges of the classifier's density bins


def grams(words: set[str]) -> Iterator[str]:
    """Each word (with an end mark) and its prefixes."""
    for word in words:
        yield word + "$"
        for size in PREFIXES:
            if size < len(word):
                yield word[:size]


def lexicon_of(gram: str, precision: float) -> int:
    kind = 0 if gram.endswith("$") else 1 if len(gram) > 4 else 2
    return kind + (0 if precision >= STRONG else 3)


def _ratio(toxic: pd.Series, clean: pd.Series, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-likelihood ratio of each n-gram for toxic documents; zero if it leans to clean ones."""
    def term(seen, expected):
        seen = np.asarray(seen, dtype=float)
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / expected), 0.0)

    both = np.asarray(toxic + clean, dtype=float)
    total = max(1, n_toxic + n_clean)
    have_toxic, have_clean = both * n_toxic / total, both * n_clean / total
    lack = np.maximum(total - both, 1e-9)
    ratio = 2 * (term(toxic, have_toxic) + term(clean, have_clean)
                 + term(n_toxic - toxic, np.maximum(lack * n_toxic / total, 1e-9))
                 + term(n_clean - clean, np.maximum(lack * n_clean / total, 1e-9)))
    return np.where(np.asarray(toxic) > have_toxic, ratio, 0.0)


def induce_lexicon(docs: DataFrame, sample: DataFrame) -> dict[str, float]:
    """All n-grams that go with the toxic label in the sample, with their precision.

    The precision is smoothed and that of equally many toxic and clean documents. The sample bounds the
    number of n-grams; only those that pass both tests leave the tasks.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            counts = (Counter(), Counter())
            for text, label in zip(part.column(0), part.column(1)):
                counts[label.as_py() > 0].update(grams(set(WORD.findall(text.as_py().lower()))))
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64())
                                                 for c in (counts[1], counts[0]))],
                ["gram", "toxic", "clean"])

    rows = docs.join(F.broadcast(sample), "doc_id").select("text", "label")
    n_toxic, n_clean = rows.agg(*(F.coalesce(F.sum(F.when(F.col("label") > 0, a).otherwise(b)), F.lit(0))
                                  for a, b in ((1, 0), (0, 1)))).first()
    if not n_toxic or not n_clean:
        return {}
    share = n_toxic / (n_toxic + n_clean)
    # pos * ln(1 / share) bounds the ratio from above where no clean text has the n-gram
    least = max(2, math.ceil(LEAST_RATIO / (2 * math.log(1 / share))))
    toxic, clean = F.col("toxic"), F.col("clean")
    def significant(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rates = part["toxic"] / n_toxic, (part["clean"] + 0.5) / n_clean
            part["precision"] = rates[0] / (rates[0] + rates[1])
            strength = _ratio(part["toxic"], part["clean"], n_toxic, n_clean)
            yield part.loc[(strength >= LEAST_RATIO) & (part["precision"] >= WEAK), ["gram", "precision"]]

    found = (rows.mapInArrow(batches, "gram string, toxic long, clean long").groupBy("gram")
             .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .filter((toxic >= least) & (toxic / n_toxic > 4 * clean / n_clean))
             .mapInPandas(significant, "gram string, precision double"))
    return {row.gram: row.precision for row in found.orderBy("gram").collect()}


@dataclass
class Signals:
    """What one text shows: the n-grams of the lexicon it has, and the vote of each voter."""

    grams: list[str]
    lexicons: list[int]

    @classmethod
    def of(cls, lexicon: dict[str, float]) -> Signals:
        names = sorted(lexicon)
        return cls(names, [lexicon_of(g, lexicon[g]) for g in names])

    def __post_init__(self) -> None:
        self.number = {g: i for i, g in enumerate(self.grams)}
        self.heads = {g[:HEAD] for g in self.grams}

    def read(self, text: str) -> tuple[str, list[int], float]:
        """The votes as one character per voter ('+' toxic, '-' clean, '0' none), the hits, and the
        share of words with a strong hit."""
        lower, number, heads = text.lower(), self.number, self.heads
        words = Counter(WORD.findall(lower))
        hits: set[int] = set()
        strong = 0
        for word, times in words.items():
            if word[:HEAD] in heads or (word + "$")[:HEAD] in heads:
                found = [number[g] for g in grams({word}) if g in number]
                hits.update(found)
                strong += times * any(self.lexicons[i] < 3 for i in found)
        density = strong / max(1, words.total())
        groups = {self.lexicons[i] for i in hits}
        toxic = [k in groups for k in range(len(LEXICONS))]
        toxic.append(not INSULTS.isdisjoint(words))
        toxic += [p.search(lower) is not None for p in PATTERNS]
        votes = ["+" if v else "0" for v in toxic]
        votes.append("0" if groups or toxic[len(LEXICONS)] else "-")
        votes.append("-" if groups and density < DENSE else "0")
        votes.append("+" if density >= DENSE else "0")
        return "".join(votes), sorted(hits), density


STATES = {"-": 0, "0": 1, "+": 2}


@dataclass
class LabelModel:
    """Mixture over the hidden label; each block of correlated voters has a joint table of votes.

    A voter's accuracy is read off its table; an uninformative voter has two equal rows.
    """

    share: float
    blocks: list[tuple[int, ...]]
    tables: list[np.ndarray]  # per block: P(joint vote | label), one row per label

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.log([1 - self.share, self.share])[:, None] + sum(
            np.log(t[:, _joint(votes, b)]) for b, t in zip(self.blocks, self.tables))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def _joint(votes: np.ndarray, block: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(votes), dtype=int)
    for voter in block:
        out = out * 3 + votes[:, voter]
    return out


def _expect(votes, weight, anchor, blocks, share, rounds=60) -> LabelModel:
    """Expectation maximisation; ``anchor`` holds the votes seen with each label, as pseudo-counts.

    They weigh as much as all other documents, else the hidden label could drift to whatever else
    splits the votes in two, such as the language or the length.
    """
    anchor = anchor * max(1.0, weight.sum() / max(1.0, anchor.sum()))
    def tables(p: np.ndarray) -> list[np.ndarray]:
        out = []
        for block in blocks:
            joint, size = _joint(votes, block), 3 ** len(block)
            rows = np.stack([np.bincount(joint, weight * q + a, size) for q, a in zip((1 - p, p), anchor)])
            rows += 0.5 / size
            out.append(rows / rows.sum(axis=1, keepdims=True))
        return out

    p = (anchor[1] + share) / (anchor.sum(axis=0) + 1)
    for _ in range(rounds):
        p = LabelModel(share, blocks, tables(p)).posterior(votes)
        share = float(np.clip((weight * p).sum() / max(weight.sum(), 1e-9), 1e-4, 0.5))
    return LabelModel(share, blocks, tables(p))


def fit_labels(votes: np.ndarray, weight: np.ndarray, anchor: np.ndarray, share: float,
               dependent: float = 0.01, largest: int = 6) -> LabelModel:
    """Accuracies by expectation maximisation, first with independent voters, then with blocks.

    Two voters are correlated if their mutual information given the label is over ``dependent``
    nats; the strongest pairs are joined first, into blocks of at most ``largest`` voters.
    """
    alone = [(i,) for i in range(votes.shape[1])]
    model = _expect(votes, weight, anchor, alone, share)
    p = model.posterior(votes)
    found = []
    for i, j in combinations(range(votes.shape[1]), 2):
        information = 0.0
        for q in (1 - p, p):
            joint = np.bincount(_joint(votes, (i, j)), weight * q, 9).reshape(3, 3) + 1e-9
            joint /= joint.sum()
            outer = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
            information += (weight * q).sum() / weight.sum() * float((joint * np.log(joint / outer)).sum())
        if information > dependent:
            found.append((information, i, j))
    block_of = {i: (i,) for i in range(votes.shape[1])}
    for _, i, j in sorted(found, reverse=True):
        joined = tuple(sorted({*block_of[i], *block_of[j]}))
        if len(joined) <= largest:
            block_of.update(dict.fromkeys(joined, joined))
    return _expect(votes, weight, anchor, sorted(set(block_of.values())), share)


def fit_linear(hits: list[list[int]], extra: np.ndarray, labels: np.ndarray, n_grams: int,
               rounds: int = 300, penalty: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression with soft labels, by accelerated gradient steps; (weights, intercept)."""
    rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    cols = np.concatenate([np.asarray(h, dtype=int) for h in hits] or [np.zeros(0, dtype=int)])
    size = n_grams + extra.shape[1]
    weights, momentum, bias, bias_momentum = np.zeros(size), np.zeros(size), 0.0, 0.0
    n = max(1, len(hits))
    # features that many rows have take smaller steps
    scale = 1 / (np.concatenate([np.bincount(cols, minlength=n_grams), extra.sum(axis=0)]) / 4 + penalty)
    step = 0.3
    for _ in range(rounds):
        z = bias + np.bincount(rows, weights[cols], n) + extra @ weights[n_grams:]
        gap = labels - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        slope = np.concatenate([np.bincount(cols, gap[rows], n_grams), gap @ extra]) - penalty * weights
        momentum = 0.8 * momentum + step * scale * slope / 4
        bias_momentum = 0.8 * bias_momentum + step * gap.sum() / n
        weights += momentum
        bias += bias_momentum
    return weights, bias


def linear_extras(votes: np.ndarray, density: np.ndarray) -> np.ndarray:
    """The fixed voters and the bin of the density of strong hits, as features beside the n-grams."""
    fixed = votes[:, len(LEXICONS):len(LEXICONS) + 1 + len(PATTERNS)] == STATES["+"]
    bins = np.searchsorted(DENSITIES, density, side="right")
    return np.hstack([fixed, bins[:, None] == np.arange(1, len(DENSITIES) + 1)]).astype(float)


def _states(keys) -> np.ndarray:
    return np.array([[STATES[c] for c in key] for key in keys], dtype=int).reshape(-1, len(VOTERS))


def read_signals(docs: DataFrame, signals: Signals) -> DataFrame:
    """(doc_id, votes, hits, density) of each row of (doc_id, text), in one pass over the texts."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [signals.read(text.as_py()) for text in part.column(1)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([v for v, _, _ in found], pa.string()),
                 pa.array([h for _, h, _ in found], pa.list_(pa.int32())),
                 pa.array([x for _, _, x in found], pa.float64())],
                ["doc_id", "votes", "hits", "density"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(batches, f"doc_id {kind}, votes string, hits array<int>, density double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1, higher: toxic likelier), votes, hits.

    Lexicons are induced from at most ``max_rows`` labelled documents outside the held-out fold. One
    more fold of them is kept apart from the lexicons: the votes on it start the label model, so
    that an n-gram that fits its own documents by chance is not taken for an accurate voter. The
    label model is fitted on the vote patterns of all documents (their number is bounded by the
    number of voters), the classifier on at most ``max_rows`` documents outside the held-out fold;
    a label of the sample counts there as a voter that overrules the others. A null
    or empty text has no hits and scores low; repeated rows score alike; without labels, or with
    one class only, the lexicons are empty and the fixed voters decide. An empty table gives no
    rows; other columns are not read.
    """
    pair = id_and_text(docs, id_col, text_col)
    sample = staged(labelled_sample(labels, target, max_rows, id_col), "labelled")
    apart = F.crc32(F.col("doc_id").cast("string")) % FOLDS == 1
    signals = Signals.of(induce_lexicon(pair, sample.filter(~apart)))
    found = staged(read_signals(pair, signals), "signals")

    known = (found.join(F.broadcast(sample.filter(apart)), "doc_id").groupBy("votes")
             .agg(F.sum((F.col("label") > 0).cast("long")).alias("toxic"), F.count("label").alias("n"))
             .toPandas().set_index("votes"))
    patterns = found.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").toPandas()
    votes, weight = _states(patterns["votes"]), patterns["n"].to_numpy(dtype=float)
    known = known.reindex(patterns["votes"]).fillna(0)
    anchor = np.stack([(known["n"] - known["toxic"]).to_numpy(float), known["toxic"].to_numpy(float)])
    share = float((anchor[1].sum() + 0.5) / (anchor.sum() + 5))
    if not len(patterns):
        return found.select("doc_id", F.lit(0.0).alias("score"), "votes", "hits")
    posterior = dict(zip(patterns["votes"], fit_labels(votes, weight, anchor, share).posterior(votes)))

    rows = (found.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(max_rows).join(F.broadcast(sample), "doc_id", "left")
            .select("votes", "hits", "density", "label").toPandas())
    given = (rows["label"] > 0).astype(float).where(rows["label"].notna())
    believed = given.clip(1 - SURE, SURE).fillna(rows["votes"].map(posterior)).to_numpy(dtype=float)
    extra = linear_extras(_states(rows["votes"]), rows["density"].to_numpy(dtype=float))
    weights, bias = fit_linear(rows["hits"].tolist(), extra, believed, len(signals.grams))
    n_grams = len(signals.grams)

    @F.pandas_udf("double")
    def scored(votes: pd.Series, hits: pd.Series, density: pd.Series) -> pd.Series:
        extra = linear_extras(_states(votes), density.to_numpy(dtype=float))
        z = extra @ weights[n_grams:] + np.array([weights[h].sum() for h in hits], dtype=float) + bias
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return found.select("doc_id", scored("votes", "hits", "density").alias("score"), "votes", "hits")
