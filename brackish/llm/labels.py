"""A bounded sample of labelled texts for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONGEST = 50_000  # code points of a text that a classifier is fitted on; longer ones are scored, not learned from


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list[bytes], np.ndarray, float]:
    """Texts, 0/1 labels and the share of label 1 among all labels; texts of at most ``per_class`` documents
    a class, chosen by a hash of doc_id.

    Null labels, null ids and labels without a document are passed over.  Only the ids are ranked; they
    are few by ``per_class`` and are sent to the scan of the documents.
    """
    marked = labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("mark")).distinct()
    totals = {row["mark"]: row["count"] for row in marked.where("mark in (0, 1)").groupBy("mark").count().collect()}
    docs = docs.where(F.col("text").isNotNull() & (F.length("text") <= LONGEST)).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = None
    for mark in (0, 1):
        # A few more than needed, as some documents are too long or absent.
        few = marked.where(F.col("mark") == mark).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class + per_class // 10)
        chosen = few if chosen is None else chosen.unionByName(few)
    rows = docs.join(F.broadcast(chosen), "doc_id").withColumn("_order", F.xxhash64("doc_id")).toPandas().sort_values(["_order", "doc_id", "mark"])
    rows = rows.groupby("mark", sort=False).head(per_class)
    return [t.encode() for t in rows["text"]], rows["mark"].to_numpy(np.int64), totals.get(1, 0) / max(1, sum(totals.values()))


def prior_shift(labels: np.ndarray, share: float) -> float:
    """What to add to a logit learned on ``labels`` where a ``share`` of all is 1."""
    had = labels.mean()
    return float(np.log(share / (1 - share)) - np.log(had / (1 - had)))
