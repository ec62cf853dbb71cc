"""Bounded samples of labelled documents to fit models on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.sources.io import persist_cut

#: Ids up to which rows are dropped by a broadcast anti join (16 bytes each).
BROADCAST_IDS = 500_000


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int) -> DataFrame:
    """(doc_id, text, y) of at most ``most`` labelled documents, the first by
    hashed id, so the choice does not depend on order or partitioning.

    ``labels``: doc_id and a 0/1 column. Ids whose label rows are null or
    disagree are not used. The chosen ids are broadcast: ``most`` bounds them.
    """
    y = (labels.select("doc_id", F.col(label).alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)").where(usable)
         .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").drop("other")
         .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs``, all their columns, whose doc_id is not among ``ids``
    (doc_id); rows with a null doc_id stay. Few ids are broadcast, so no text is
    shuffled; more make the same anti join shuffle."""
    ids = persist_cut(ids.select(F.col("doc_id").alias("dropped_id")).distinct(), docs.sparkSession, "dropped")
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, docs["doc_id"] == ids["dropped_id"], "left_anti")
