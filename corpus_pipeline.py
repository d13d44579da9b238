"""Documents to packed training sequences: the stages, and ``run`` over all of them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hemline.llm import cuckoo, mixing, ngram_join, packing, toxicity
from hemline.llm.common import read_table, stage
from hemline.sources.staging import Scope


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The tables that the result of the last stage still reads.
_last: Scope | None = None


def alone(apply: Stage) -> Stage:
    """A stage that first deletes what the stage before it staged.

    A stage's result is written and reread before the next one starts, so its staged tables have
    no reader then but one that ``docs`` itself may be. Tables that the result does not read go
    when the stage returns.
    """
    @functools.wraps(apply)
    def run_alone(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _last
        if _last is not None and _last.spark.sparkContext is spark.sparkContext:
            _last.close(docs)
        with Scope(spark) as scope:
            result = scope.keep(apply(spark, docs, sf_dir))
        _last = scope
        return result

    return run_alone


@alone
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that operator 6, fitted on the labelled documents, scores below 0.3."""
    return toxicity.clean_documents(docs, read_table(spark, sf_dir, "labels"))


@alone
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one that operator 8 keeps."""
    return cuckoo.unique_documents(docs)


@alone
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of operator 7, the document with the smallest id."""
    return ngram_join.one_of_each(docs)


@alone
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as operator 3 takes it."""
    return mixing.mixture(docs)


@alone
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of operator 1, in windows of 2048 ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: The first stage applies a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next; what a stage read is then deleted."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, apply in STAGES[:-1]:
        with Scope(spark) as scope:
            docs = scope.keep(stage(apply(spark, docs, sf_dir), f"stage-{name}"))
        if before is not None:
            before.close()
        before = scope
    result = STAGES[-1][1](spark, docs, sf_dir)
    before.close(result)
    return result
