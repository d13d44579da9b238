"""Bounded samples of labelled rows, the only rows a model is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int,
                    per_class: int) -> DataFrame:
    """(label, text) of at most ``per_class`` labelled rows of each class, chosen by a hash.

    Held-out ids are never chosen. The chosen ids are at most twice ``per_class`` rows, a
    bound that lets them be broadcast to the scan of the documents.
    """
    usable = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
        & (remainder(F.col("doc_id"), divisor) != held_out))
    chosen = None
    for value in (0, 1):
        some = usable.filter(F.col("label") == value).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    ids = chosen.select(F.col("doc_id").alias("__id"), "label")
    # the join's order is no part of the sample: the hash and the id give it
    return docs.select("doc_id", "text").join(
        F.broadcast(ids), F.col("doc_id") == F.col("__id")).select("doc_id", "label", "text")
