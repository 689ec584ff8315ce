"""One registered query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import license_scan, lm_score, periodic_runs, toxicity, url_filter, whitening
from .bpe_lexicon import build_lexicon, encode_digests
from .common import importable
from .decontaminate import contaminated
from .multi_index import nearest
from .ngram_join import linked_documents
from .packing import pack_documents
from .substring_dedup import kept_digests
from .token_files import read_documents, write_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = write_tokens(docs, scratch_dir(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"), vocabulary=49_408, end_id=1)
    return read_documents(manifest)


@query
def op6_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tokenizer = table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    lexicon = build_lexicon(docs, f"{scratch_dir(spark, 'lexicon')}/words.lex", tokenizer)
    return encode_digests(docs, tokenizer, lexicon)


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digests(table(spark, sf_dir, "documents"))


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"))


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


ORACLES["op8_license_scan"] = license_scan.oracle()
ORACLES["op9_url_filter"] = url_filter.oracle()


@query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scored(table(spark, sf_dir, "documents"))


@query
def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"), planted=True)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
