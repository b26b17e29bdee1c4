"""Quality rules from tokeniser fertility: how a public vocabulary takes the words of a text apart."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import ASCII_SPACE, column, staged

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
SYMBOLS = b"#*$%&|<>"
SPACE = ASCII_SPACE.encode()
MAX_WORDS = 300_000  # distinct words whose pieces a task remembers
# First code point of each block of scripts, and its script; None: of no script.
SCRIPTS = ((0x41, "latin"), (0x5B, None), (0x61, "latin"), (0x7B, None), (0xAA, "latin"), (0x2B9, None),
           (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
           (0x700, None), (0x900, "devanagari"), (0x980, "indic"), (0xE00, "thai"), (0xE80, None),
           (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, None), (0x1E00, "latin"), (0x1F00, "greek"),
           (0x2000, None), (0x3040, "kana"), (0x3100, None), (0x3400, "han"), (0xA000, None),
           (0xAC00, "hangul"), (0xD7B0, None), (0x20000, "han"), (0x32000, None))
#: Measures of a text with the least quartile distance that a band is built from, all in thousandths:
#: characters per token, tokens that are single bytes, bits of entropy of the tokens.
MEASURES = {"chars_per_token": 40, "byte_share": 10, "entropy": 100}
FENCE = 3  # quartile distances beyond the quartiles: Tukey's "far out"


@lru_cache(maxsize=2)
def _vocabulary(path: str):
    """The processor of a vocabulary file, and which of its pieces stand for single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.vocab_size())])


class Words:
    """Pieces of each distinct word; forgotten as a whole when there are too many."""

    def __init__(self, path: str):
        self.model, self.single = _vocabulary(path)
        self.pieces: dict[bytes, list[int]] = {}

    def table(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of ``words`` one after the other, and where each word's begin and end."""
        missing = [w for w in words if w not in self.pieces]
        if len(self.pieces) + len(missing) > MAX_WORDS:
            self.pieces, missing = {}, words
        encoded = self.model.encode([w.decode() for w in missing], num_threads=1)
        self.pieces.update(zip(missing, encoded))
        held = [self.pieces[w] for w in words]
        ends = np.cumsum([0, *map(len, held)])
        return np.fromiter(chain.from_iterable(held), dtype=np.int64, count=ends[-1]), ends


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in a window of three that is found twice or more."""
    if len(ids) < 4:
        return 0
    size = int(ids.max()) + 1
    _, pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[windows] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift:shift + len(twice)] |= twice
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def script(text: bytes) -> str:
    """The script of most letters of a text, "none" without any; ties go to the first name."""
    points = np.frombuffer(text.decode().encode("utf-32-le"), dtype="<u4")
    starts = np.array([start for start, _ in SCRIPTS])
    places, counts = np.unique(np.searchsorted(starts, points, side="right") - 1, return_counts=True)
    totals: dict[str, int] = {}
    for place, count in zip(places, counts):
        if place >= 0 and (name := SCRIPTS[place][1]):
            totals[name] = totals.get(name, 0) + int(count)
    return min(totals, key=lambda name: (-totals[name], name), default="none")


def fertility(pieces: np.ndarray, times: np.ndarray, chars: int, single: np.ndarray) -> tuple[int, ...]:
    """Tokens, and the measures in thousandths, of pieces that occur ``times`` times each."""
    kinds, place = np.unique(pieces, return_inverse=True)
    counts = np.bincount(place, weights=times).astype(np.int64)
    total = int(counts.sum())
    if not total:
        return 0, 0, 0, 0
    shares = np.sort(counts) / total
    return (total, 1000 * chars // total, 1000 * int(counts[single[kinds]].sum()) // total,
            int(np.floor(1000 * -(shares * np.log2(shares)).sum() + 1e-6)))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", *MEASURES)


def measured(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str | None = "lang") -> DataFrame:
    """Per row: doc_id, band (language or script, and octave of the number of words), content and counts.

    A text is taken apart word by word, so its pieces are those of its words, whose pieces a task looks
    up once. ``content`` is a hash of the text, so that statistics can count copies once.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for part in (p.slice(at, 200) for p in parts for at in range(0, p.num_rows, 200)):
            texts = [value.as_buffer().to_pybytes() for value in part.column("text")]
            number: dict[bytes, int] = {}
            rows = [np.array([number.setdefault(w, len(number)) for w in text.split()], dtype=np.int64)
                    for text in texts]
            pieces, ends = words.table(list(number))
            groups, out = [], []
            for text, ids, lang in zip(texts, rows, part.column("lang").to_pylist()):
                chars = len(text.decode()) - (len(text) - len(text.translate(None, SPACE)))
                kinds, times = np.unique(ids, return_counts=True)
                sizes = ends[kinds + 1] - ends[kinds]
                places = np.arange(sizes.sum()) + np.repeat(ends[kinds] - np.cumsum(sizes) + sizes, sizes)
                found = fertility(pieces[places], np.repeat(times, sizes), chars, words.single)
                out.append((len(ids), chars, len(text) - len(text.translate(None, SYMBOLS)),
                            repeated_lines(text), repeated_words(ids), *found))
                groups.append(f"{lang or script(text)}/{len(ids).bit_length()}")
            columns = zip(*out) if out else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(groups, pa.string()), part.column("content"),
                 *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "band", "content", *COUNTS])

    lang = column(lang_col).cast("string") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.select(column(id_col).alias("doc_id"), text.alias("text"), lang.alias("lang"),
                       F.xxhash64(text).alias("content"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, band string, content long, "
                           + ", ".join(f"{name} long" for name in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def bands(rows: DataFrame, fence: int = FENCE) -> DataFrame:
    """Per band the least and greatest value of each measure that is not rejected.

    The quartiles are those of all different texts that pass the base rules. They are read off a
    histogram of the whole thousandths, whose size is bounded by the measures' range and not by the
    number of texts: it is summed before the shuffle, so no band, however large, meets in one task.
    """
    texts = rows.filter(~F.col("base_failed")).select("band", "content", *MEASURES).distinct()
    values = (texts.unpivot(["band"], list(MEASURES), "measure", "value")
              .groupBy("band", "measure", "value").agg(F.count(F.lit(1)).alias("n")))
    held = F.sum("n").over(Window.partitionBy("band", "measure").orderBy("value"))
    total = F.sum("n").over(Window.partitionBy("band", "measure"))
    placed = values.select("band", "measure", "value", held.alias("held"), total.alias("total"))
    quartiles = placed.groupBy("band", "measure").agg(
        F.min(F.when(4 * F.col("held") >= F.col("total"), F.col("value"))).alias("q1"),
        F.min(F.when(4 * F.col("held") >= 3 * F.col("total"), F.col("value"))).alias("q3"))
    least = F.create_map(*[F.lit(x) for pair in MEASURES.items() for x in pair])[F.col("measure")]
    reach = fence * F.greatest(F.col("q3") - F.col("q1"), least)
    limits = quartiles.select("band", "measure", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    return limits.groupBy("band").agg(*[
        F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{name}_{side}")
        for name in MEASURES for side in ("low", "high")])


def rules(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str | None = "lang", fence: int = FENCE) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, reason, band, n_tokens and the three measures.

    ``path`` is a vocabulary file with byte fallback. A text that passes the base rules is rejected if a
    measure lies outside the band of its language and length: more than ``fence`` quartile distances
    beyond the quartiles of such texts. The language is ``lang_col``; where that is null, empty or
    missing, the script of most letters takes its place. Lengths are compared within octaves of the
    number of words, as entropy grows with it.

    A null or empty text has no words and fails the base rules. Texts of any length are taken whole.
    Repeated rows are judged alike, and counted once in the quartiles, as are all copies of a text.
    A text whose band holds no other is kept. An empty table gives no rows; other columns are not read.
    """
    rows = staged(measured(docs, path, id_col, text_col, lang_col)
                  .withColumn("base_failed", base_failed()), "measured")
    limits = staged(bands(rows, fence), "bands")
    outside = [F.when((F.col(name) < F.col(f"{name}_low")) | (F.col(name) > F.col(f"{name}_high")), F.lit(name))
               for name in MEASURES]
    reason = F.when(F.col("base_failed"), F.lit("base")).otherwise(F.coalesce(*outside))
    return (rows.join(limits, "band", "left").withColumn("reason", reason)
            .select("doc_id", *COUNTS[:5], "base_failed", F.col("reason").isNull().alias("kept"), "reason", "band",
                    *COUNTS[5:]))
