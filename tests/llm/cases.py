"""Fixtures and rows that the tests of this folder share (imported by name; the session is that of tests/conftest.py)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def engine(spark):
    from dayload.llm.common import importable

    return importable(spark)


@pytest.fixture(scope="session")
def small(engine):
    """documents of the smallest scale as [(doc_id, text)]."""
    return [tuple(r) for r in engine.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


#: Texts that every operator must take: null, empty, blank, one word, very long, repeated rows, null ids, clashing column names.
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, LONG), (6, LONG), (7, "a b c d e f g"), (7, "a b c d e f g"), (None, "a b c d e f g"), (None, None),
       (8, "x" * 5000), (9, "Ärger über Öl 'tis don't <|endoftext|> end."), (10, "tie tie tie tie tie tie")]


@pytest.fixture(scope="session")
def odd(engine):
    from pyspark.sql import functions as F

    df = engine.createDataFrame(ODD, "doc_id long, text string")
    clash = [("text_", "t"), ("bucket", 1), ("payload", "p"), ("score", 2.0), ("row", 3), ("extra", None), ("disc", 4), ("own", 5), ("prefix", 6), ("rep", 7), ("n", 8)]
    return df.select("doc_id", "text", *[F.lit(v).cast("string").alias(c) for c, v in clash])
