"""Ranked lexical search of many items at once, with the work that items share done once.

Items that hold the same terms need the same sums. The sets of terms that items share are mined
first; each becomes a node of a graph whose leaves are single terms. For a batch of documents the
score of every node is the sum of its two children's, so a shared set is added up once, and an item
is read off at its root.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import id_and_text, staged

TOP = 20
MAX_TERMS = 200_000  # terms of a block of items, but for a single longer item; each block is one pass
CELLS = 1 << 22  # scores that a task holds at once: nodes times documents
PENDING = 1 << 18  # candidates that a task holds before it ranks them
# [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F] in UTF-8: letters and digits in lower case, all else a space
FOLD = bytes(c if c > 127 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32
             for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


@dataclass(frozen=True)
class Plan:
    """Which sums to form: node ``i`` is a leaf if ``i < len(leaf_terms)``, else the next pair."""

    leaf_terms: np.ndarray  # the term of each leaf
    leaf_times: np.ndarray  # how often an item repeats it
    levels: list[tuple[np.ndarray, np.ndarray]]  # left and right children, level by level
    roots: np.ndarray  # node of each item, -1 for one without terms

    @property
    def nodes(self) -> int:
        return len(self.leaf_terms) + sum(len(left) for left, _ in self.levels)

    def scores(self, parts: np.ndarray) -> np.ndarray:
        """(items, documents) from (terms, documents)."""
        sums = np.zeros((self.nodes, parts.shape[1]), dtype=np.int64)
        at = len(self.leaf_terms)
        sums[:at] = parts[self.leaf_terms] * self.leaf_times[:, None]
        for left, right in self.levels:
            np.add(sums[left], sums[right], out=sums[at:at + len(left)])
            at += len(left)
        found = sums[self.roots] if self.nodes else np.zeros((len(self.roots), parts.shape[1]), dtype=np.int64)
        found[self.roots < 0] = 0
        return found


def plan(items: list[Counter[int]]) -> Plan:
    """Mine the sets that items share and lay out the sums.

    The symbols of every item are ordered by the number of items that hold them, so that items with
    common terms have common neighbours. Each pair of neighbours that two or more items hold becomes
    a symbol of its own, and the next round finds pairs of those, until no pair is shared. What is
    left of an item is added up in pairs.
    """
    leaves = sorted({leaf for item in items for leaf in item.items()})
    number = {leaf: i for i, leaf in enumerate(leaves)}
    symbols = [[number[leaf] for leaf in item.items()] for item in items]
    nodes: dict[tuple[int, int], int] = {}

    def merged(row: list[int], take) -> list[int]:
        out, at = [], 0
        while at < len(row):
            pair = tuple(sorted(row[at:at + 2]))
            if len(pair) == 2 and take(pair):
                out.append(nodes.setdefault(pair, len(leaves) + len(nodes)))
                at += 2
            else:
                out.append(row[at])
                at += 1
        return out

    while True:
        held = Counter(s for row in symbols for s in row)
        for row in symbols:
            row.sort(key=lambda s: (-held[s], s))
        shared = Counter(tuple(sorted(pair)) for row in symbols for pair in pairwise(row))
        if max(shared.values(), default=0) < 2:
            break
        symbols = [merged(row, lambda pair: shared[pair] > 1) for row in symbols]
    while any(len(row) > 1 for row in symbols):
        symbols = [merged(row, lambda pair: True) for row in symbols]

    level = dict.fromkeys(range(len(leaves)), 0)
    for (left, right), node in nodes.items():
        level[node] = max(level[left], level[right]) + 1
    order = sorted(nodes.items(), key=lambda pair: (level[pair[1]], pair[1]))
    place = {node: i for i, node in enumerate([*range(len(leaves)), *(node for _, node in order)])}
    steps: dict[int, list[tuple[int, int]]] = {}
    for (left, right), node in order:
        steps.setdefault(level[node], []).append((place[left], place[right]))
    return Plan(np.array([term for term, _ in leaves], dtype=np.int64),
                np.array([times for _, times in leaves], dtype=np.int64),
                [tuple(np.array(side, dtype=np.int64) for side in zip(*pairs)) for pairs in steps.values()],
                np.array([place[row[0]] if row else -1 for row in symbols], dtype=np.int64))


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): all terms of a text counted in n, those of the items listed."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, terms, counts, ends = [], [], [], [0]
            for text in part.column(1):
                found = terms_of(text.as_buffer().to_pybytes())
                held = Counter(vocabulary[t] for t in found if t in vocabulary)
                sizes.append(len(found))
                terms.extend(held)
                counts.extend(held.values())
                ends.append(len(terms))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts, pa.int64()))],
                ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        batches, "doc_id long, n long, terms array<int>, counts array<bigint>").filter("n > 0")


class _Best:
    """The documents that lead for each item so far, from one task's share."""

    def __init__(self, items: int, top: int):
        self.top, self.found, self.pending = top, [], 0
        self.least = np.ones(items, dtype=np.int64)  # a score below is not among the leaders

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.found.append((item, scores[item, doc], known[doc], ids[doc]))
        self.pending += len(item)
        if self.pending > PENDING + self.top * len(self.least):
            self.rank()

    def rank(self) -> tuple[np.ndarray, ...]:
        """Highest scores first, then smallest ids, a null id last."""
        item, score, known, ids = (np.concatenate(values) for values in zip(*self.found))
        order = np.lexsort((ids, ~known, -score, item))
        item, score, known, ids = item[order], score[order], known[order], ids[order]
        starts = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        last, stays = place == self.top - 1, place < self.top
        self.least[item[last]] = score[last]
        self.found = [(item[stays], score[stays], known[stays], ids[stays])]
        self.pending = int(stays.sum())
        return self.found[0]


def _ranked(found: DataFrame, weights: np.ndarray, sums: Plan, docs: int, length: int, top: int) -> DataFrame:
    """(item, doc_id, score): the leaders of every task."""
    size = max(1, CELLS // max(1, sums.nodes))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(sums.roots), top)
        for part in (p.slice(at, size) for p in parts for at in range(0, p.num_rows, size)):
            held = part.column("terms")
            doc = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
            term = held.flatten().to_numpy()
            times = part.column("counts").flatten().to_numpy()
            lengths = 75 + 25 * part.column("n").to_numpy() * docs // length
            matrix = np.zeros((len(weights), len(held)), dtype=np.int64)
            matrix[term, doc] = weights[term] * (1_000_000_000 * times // (1000 * times + 12 * lengths[doc]))
            ids = part.column("doc_id")
            best.add(sums.scores(matrix), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False))
        if best.found:
            item, score, known, ids = best.rank()
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(ids, mask=~known), pa.array(score)], ["item", "doc_id", "score"])

    return found.mapInArrow(batches, "item long, doc_id long, score long")


def _blocks(items: DataFrame, max_terms: int) -> Iterable[list]:
    """The items as (item_id, terms), at most about ``max_terms`` terms at a time."""
    pattern = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.distinct().select("doc_id", F.regexp_extract_all(lower, F.lit(pattern), F.lit(0)).alias("terms"))
    rows = staged(rows.filter("size(terms) > 0"), "items")
    total = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(total / max_terms))
    for block in range(blocks):
        held = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == block)
        yield held.orderBy("doc_id", "terms").collect()


def search(docs: DataFrame, items: DataFrame, top: int = TOP, max_terms: int = MAX_TERMS, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above zero.

    Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. Ids of
    documents are integers. A null or empty text has no terms: such documents are not counted, and such
    items have no rows. Equal scores are ordered by id, a null id last. Repeated documents are documents
    of their own; repeated item rows count once, and the terms of different rows that share an item id
    add up. An empty table on either side gives no rows; other columns are not read.

    Items are taken in blocks of about ``max_terms`` terms, each of which is one pass over the documents:
    the vocabulary and the plan of sums that tasks receive are bounded by it, whatever the number of
    items. A task keeps ``top`` documents for each item, so what is shuffled does not grow with the texts.
    """
    pair = id_and_text(docs, id_col, text_col)
    kind = items.schema[item_col].dataType.simpleString()
    out = None
    for block in _blocks(id_and_text(items, item_col, item_text_col), max_terms):
        by_item: dict = {}
        for row in block:
            by_item.setdefault(row.doc_id, Counter()).update(t.encode() for t in row.terms)
        vocabulary = {t: i for i, t in enumerate(sorted({t for terms in by_item.values() for t in terms}))}
        found = staged(postings(pair, vocabulary), "postings")
        docs_n, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        held = dict(found.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        # a term that no text holds has no part in any score
        weights = np.array([math.floor(1000 * math.log((2 * docs_n + 2) / (2 * held.get(i, 0) + 1)))
                            for i in range(len(vocabulary))], dtype=np.int64)
        sums = plan([Counter({vocabulary[t]: c for t, c in terms.items()}) for terms in by_item.values()])
        ranked = staged(_ranked(found, weights, sums, docs_n, length or 1, top), "leaders")
        names = docs.sparkSession.createDataFrame(list(enumerate(by_item)), f"item long, item_id {kind}")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        rows = (ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
                .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        out = rows if out is None else out.unionByName(rows)
    return out


ORACLE = rf"""
WITH found AS (
  SELECT doc_id, row_number() OVER () AS number, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')) AS term
  FROM benchmark),
held AS (SELECT number, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM found GROUP BY number, term),
sizes AS (SELECT number, count(*) AS n FROM found GROUP BY number),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term),
parts AS (
  SELECT number, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))) AS part
  FROM held JOIN sizes USING (number) JOIN weights USING (term), corpus),
scored AS (
  SELECT item_id, number, any_value(doc_id) AS doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM asked JOIN parts USING (term) GROUP BY item_id, number),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
         doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
