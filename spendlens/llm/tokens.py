"""Token counts from pre-token frequencies.

A byte-level BPE vocabulary merges only inside pre-tokens, so a document's tokens are the sum over
its pre-tokens of frequency times pieces. Pieces are counted once per distinct pre-token of the
corpus and joined back to the frequencies; no token id is ever materialised.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import id_and_text, staged

MAX_PIECES = 500_000  # distinct pre-tokens of a block, at most, but for those of its last part
MAX_DOCS = 20_000  # documents of a block, at most
BLOCK_BITS, PLACE_BITS = 16, 20  # of the blocks of a task, and of the places of a block
SPAN_BITS = 12  # of the tasks whose entries of a pre-token are grouped
COUNT_BITS = 40  # of the pieces of a pre-token, which share a number with its place
PART = 1_000_000  # characters of a text from which its pre-tokens are taken in parts
# characters whose classes have not changed between Unicode versions: Latin, Greek, Cyrillic, dashes,
# quotation marks and currency signs
UNSETTLED = re.compile("[^\u0000-\u052f\u2000-\u206f\u20a0-\u20bf]")


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _rules(path: str) -> tuple[regex.Pattern, regex.Pattern | None, frozenset[str]]:
    """How the library splits a text: its pre-token pattern, its special strings, and all
    pre-tokens that are one piece (a subset of the vocabulary)."""
    with open(path, encoding="utf-8") as file:
        config = json.load(file)
    before = config["pre_tokenizer"]
    if before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"] or config["normalizer"]:
        raise ValueError(f"{path} is not a plain byte-level vocabulary")
    import public_tokenizers

    pattern = regex.compile(public_tokenizers.PATTERN)
    special = sorted((t["content"] for t in config["added_tokens"]), key=len, reverse=True)
    split = regex.compile("|".join(map(regex.escape, special))) if special else None
    library = _library(path)
    words = [library.decode([i], skip_special_tokens=False) for i in config["model"]["vocab"].values()]
    words = [w for w in words if w and pattern.fullmatch(w)]
    single = (w for w, found in zip(words, library.encode_batch(words, add_special_tokens=False))
              if len(found) == 1)
    return pattern, split, frozenset(single)


def pre_tokens(text: str, pattern: regex.Pattern, path: str) -> Iterator[Counter[str]]:
    """Pre-token frequencies of a text, in parts if it is long.

    The pattern's letters and numbers follow a newer Unicode than the library's, so a text with
    characters in ``UNSETTLED`` is split by the library itself.
    """
    if UNSETTLED.search(text):
        found = (text[a:b] for _, (a, b) in _library(path).pre_tokenizer.pre_tokenize_str(text))
    elif len(text) <= PART:
        yield Counter(pattern.findall(text))
        return
    else:
        found = (m.group() for m in pattern.finditer(text))
    while part := Counter(islice(found, PART // 4)):
        yield part


def packed(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising ids and their counts in few bytes: steps and counts by byte planes, compressed."""
    values = np.concatenate([np.diff(ids, prepend=0), counts]).astype("<i4")
    return pa.compress(values.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()
    return np.cumsum(values[:n]), values[n:]


class _Block:
    """Rows that share a dictionary of pre-tokens."""

    def __init__(self, number: int):
        self.number, self.local, self.rows = number, {}, []

    def add(self, row: int, doc_id, size: int, known: int, counts: Counter[str]) -> None:
        local = self.local
        ids = [local.setdefault(piece, len(local)) for piece in counts]
        self.rows.append((row, doc_id, size, known, ids, list(counts.values())))

    def full(self) -> bool:
        return len(self.local) >= MAX_PIECES or len(self.rows) >= MAX_DOCS

    def batches(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """First the dictionary in alphabetical order, which compresses well, then the documents."""
        pieces = sorted(self.local)
        place = np.empty(len(pieces), dtype=np.int32)
        for at, piece in enumerate(pieces):
            place[self.local[piece]] = at
        nothing = [None]
        fields = ("block", "row", "doc_id", "n_bytes", "known", "n", "data", "pieces")
        kinds = (pa.int64(), pa.int64(), kind, pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.number], pa.int64()), *(pa.array(nothing, k) for k in kinds[1:]),
             pa.array([pieces], pa.list_(pa.string()))], fields)
        for at in range(0, len(self.rows), 1000):
            rows = []
            for row, doc_id, size, known, ids, counts in self.rows[at:at + 1000]:
                places = place[ids] if ids else np.zeros(0, np.int32)
                order = np.argsort(places)
                data = packed(places[order], np.array(counts, np.int32)[order])
                rows.append((self.number, row, doc_id, size, known, len(ids), data))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(zip(*rows), kinds)),
                 pa.array(nothing * len(rows), pa.list_(pa.string()))], fields)


def frequencies(docs: DataFrame, path: str) -> DataFrame:
    """Per block one row with its distinct pre-tokens, and one row for each document of the block.

    A document's row holds places in the block's dictionary and frequencies, packed. Pre-tokens that are one
    piece are summed up in ``known``; special strings count as one token each, and split the text.
    """
    kind = pa.int64() if docs.schema["doc_id"].dataType.simpleString() == "bigint" else pa.string()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, special, single = _rules(path)
        part_id = TaskContext.get().partitionId()
        block, row = _Block(part_id << BLOCK_BITS), part_id << 32
        for part in parts:
            for doc_id, value in zip(part.column(0), part.column(1)):
                text, size, known = value.as_py(), value.as_buffer().size if value.is_valid else 0, 0
                segments = [text]
                if special and special.search(text):
                    segments = special.split(text)
                    known = len(segments) - 1
                for segment in segments:
                    for counts in pre_tokens(segment, pattern, path):
                        for piece in single.intersection(counts):
                            known += counts.pop(piece)
                        block.add(row, doc_id.as_py(), size, known, counts)
                        size = known = 0
                        if block.full():
                            yield from block.batches(kind)
                            block = _Block(block.number + 1)
                row += 1
        if block.rows:
            yield from block.batches(kind)

    name = "long" if kind == pa.int64() else "string"
    return docs.mapInArrow(
        batches, f"block long, row long, doc_id {name}, n_bytes long, known long, n int, "
                 "data binary, pieces array<string>")


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    ``path`` is the vocabulary file. Counts are those of the library without begin, end or added
    special tokens, truncation or padding. A null or empty text has none; repeated rows count
    alike, an empty table gives no rows, and other columns are not read. A text of any length is
    taken whole: if its pre-tokens fill a block, it goes on in the next.
    """
    found = staged(frequencies(id_and_text(docs, id_col, text_col), path), "frequencies")

    @F.pandas_udf("int")
    def pieces_of(pieces: pd.Series) -> pd.Series:
        encoded = _library(path).encode_batch(pieces.tolist(), add_special_tokens=False)
        return pd.Series([len(e) for e in encoded])

    places = found.filter("pieces IS NOT NULL").select("block", F.posexplode("pieces").alias("place", "piece"))
    entries = places.select(F.shiftleft("block", PLACE_BITS).bitwiseOR(F.col("place").cast("long")).alias("entry"),
                            "piece")
    # All entries of a pre-token meet in one shuffle of plain rows, which the dictionaries' order makes
    # compress well. A group holds one entry per block, of at most 2 ** SPAN_BITS tasks: a span is some
    # 250 GB of text, beyond which a pre-token is counted once more for each span.
    span = F.shiftright("entry", PLACE_BITS + BLOCK_BITS + SPAN_BITS)
    counted = (entries.withColumn("span", span).repartition("span", "piece")
               .groupBy("span", "piece").agg(F.collect_list("entry").alias("entries"))
               .select(pieces_of("piece").cast("long").alias("pieces"), "entries"))
    place = F.col("entry").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    tables = (counted.select("pieces", F.explode("entries").alias("entry"))
              .groupBy(F.shiftright("entry", PLACE_BITS).alias("of_block"))
              .agg(F.collect_list(F.shiftleft(place, COUNT_BITS).bitwiseOR(F.col("pieces"))).alias("pieces")))

    def summed(rows: pa.Table, table: pa.Table) -> pa.Table:
        packs = table.column("pieces").combine_chunks().values.to_numpy() if len(table) else np.zeros(0, np.int64)
        pieces = np.sort(packs) & ((1 << COUNT_BITS) - 1)
        totals = []
        for n, data, known in zip(*(rows.column(c).to_pylist() for c in ("n", "data", "known"))):
            ids, counts = unpacked(data, n)
            totals.append(known + int(pieces[ids] @ counts.astype(np.int64)))
        return pa.table([rows.column("row"), rows.column("doc_id"), rows.column("n_bytes"),
                         pa.array(totals, pa.int64())], names=["row", "doc_id", "n_bytes", "n_tokens"])

    kind = found.schema["doc_id"].dataType.simpleString()
    rows = found.filter("pieces IS NULL").select("block", "row", "doc_id", "n_bytes", "known", "n", "data")
    totals = (rows.groupBy("block").cogroup(tables.groupBy("of_block"))
              .applyInArrow(summed, f"row long, doc_id {kind}, n_bytes long, n_tokens long")
              .groupBy("row", "doc_id").agg(F.sum("n_bytes").alias("n_bytes"),
                                            F.sum("n_tokens").alias("n_tokens")))
    return totals.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
