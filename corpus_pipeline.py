"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read back as the next one's docs.
All but the last return the columns of `docs`; columns of `docs` whose names an operator also uses pass through as they
are. Nulls, empty tables and repeated rows are defined in the operators' docstrings.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recordlink.llm.line_dedup import line_dedup
from recordlink.llm.mixing import mix_sources
from recordlink.llm.near_dedup import keep_one
from recordlink.llm.packing import pack_documents
from recordlink.llm.scratch import keep
from recordlink.llm.toxicity import score_toxicity

TOKENIZER = "byte_bpe_50k.json"
SEQUENCE = 2048


def aside(docs: DataFrame, used: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run an operator that adds columns of names `used`, and give back exactly the columns of `docs`."""
    hidden = {name: f"__own_{name}" for name in docs.columns if name in used}
    done = work(docs.withColumnsRenamed(hidden))
    return done.select(*hidden.values(), *[c for c in docs.columns if c not in hidden]).withColumnsRenamed({v: k for k, v in hidden.items()}).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of `sf_dir`, does not call toxic; null and empty texts too get a score."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return aside(docs, ("held_out", "score", "predicted", "offending"), lambda d: score_toxicity(d, labels).filter("predicted = 0"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without lines that match an earlier one; a document may end up empty, a null text stays null."""
    return aside(docs, ("n_lines", "n_removed_lines"), line_dedup)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; texts without words are linked with nothing and stay."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate draws it, none to several times; a null source is one source."""
    return aside(docs, ("copy", "copies", "order_key", "rate"), mix_sources)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences; a null or empty text is its end id alone."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), SEQUENCE)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("mixing", mixing),
    ("best_fit_packing", packing),
]
ORACLE_SQL = None  # trained scores, set-similarity joins and packing: tests/llm/test_pipeline.py holds run() against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
