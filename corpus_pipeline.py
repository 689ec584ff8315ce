"""Five stages from raw documents to encoded ones, each by one operator of ``dayload.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``docs``.

1. ``toxicity``: documents that the model scores 0.5 or more go.
2. ``ngram_join``: of each component of near copies (five words, 0.8; the query
   op1 has its own four and 0.85) the document with the smallest id stays (rows
   without an id stay).
3. ``substring_dedup``: words of 13-word windows that also start in a document
   with a smaller id are cut out of the text; ``n_chars`` follows the text.
4. ``decontaminate``: documents in which a benchmark item is found go.
5. ``bpe_lexicon``: texts are encoded and decoded; ids and their digests.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from dayload.llm import toxicity as tox  # noqa: E402
from dayload.llm.bpe_lexicon import build_lexicon, encode_digests  # noqa: E402
from dayload.llm.common import importable, saved  # noqa: E402
from dayload.llm.decontaminate import clean_rows  # noqa: E402
from dayload.llm.ngram_join import linked_documents  # noqa: E402
from dayload.llm.substring_dedup import dedup_texts  # noqa: E402
from dayload.session import scratch_dir  # noqa: E402


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    model = tox.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return tox.score(docs, model, to="__score").where(F.col("__score") < 0.5).drop("__score")


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    others = linked_documents(docs, n=5, above=80, of=100).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    cut = dedup_texts(docs)
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_lexicon(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    lexicon = build_lexicon(docs, f"{scratch_dir(spark, 'lexicon')}/words.lex", tokenizer)
    return encode_digests(docs, tokenizer, lexicon)


STAGES = [("toxicity", toxicity), ("ngram_join", ngram_join), ("substring_dedup", substring_dedup), ("decontaminate", decontaminate), ("bpe_lexicon", bpe_lexicon)]
#: Fitted models and digests of ids can't be written in SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``, one after the other."""
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
