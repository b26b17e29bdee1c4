from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

TABLES = ("documents", "embeddings", "labels", "pages", "benchmark", "conversations")
#: Columns that operators use as names of their own.
CLASHING = ("row", "kept", "fp", "content", "score", "label", "tokens", "topic", "hits", "window", "Text2")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in CLASHING)


@pytest.fixture(scope="session")
def duck(small_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(small_dir) / name}.parquet')")
    yield con
    con.close()


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash."""
    def build(*pairs):
        return spark.createDataFrame(
            [(i, t, "en" if i is None or i % 2 else None, "a" if i else None, len(t or ""),
              *(f"{name}-{i}" for name in CLASHING)) for i, t in pairs], DOCS)
    return build


@pytest.fixture
def odd_docs(docs):
    """Nulls, empty and white texts, a very long text, ties, repeated rows and a null id."""
    return docs((1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six seven eight nine"),
                (5, "one two three four five six seven eight nine"),
                (5, "one two three four five six seven eight nine"),
                (6, "word " * 60_000), (None, "a text without an id"), (7, "x"))
