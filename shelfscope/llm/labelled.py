"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def sample_texts(
    docs: DataFrame, labels: DataFrame, columns: list[str], strata: list[tuple[Column, int]], id_col: str, text_col: str
) -> DataFrame:
    """Texts and labels of a bounded sample: for each stratum (a condition on
    the label columns, null where a document has no label) the documents whose
    hashed id is smallest, up to its bound.  Columns: ``id``, ``text``,
    ``stratum`` and the label columns.

    Only ids outside remainder 0 take part.  Labels that contradict each other
    for an id count as none; of a repeated id the row whose text has the smallest
    hash is the document.  So the chosen ids, which are broadcast, and the rows
    are at most the sum of the bounds.
    """
    one = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        *[F.when(F.min(c) == F.max(c), F.min(c)).alias(c) for c in columns]
    )
    ids = docs.select(docs[id_col].alias("id")).where(remainder(F.col("id")) != 0).distinct().join(one, "id", "left")
    ids = ids.withColumn("_order", F.xxhash64("id"))
    chosen = None
    for i, (cond, most) in enumerate(strata):
        part = ids.where(cond).orderBy("_order", "id").limit(most).withColumn("stratum", F.lit(i)).drop("_order")
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "stratum", *columns).agg(first).select("id", "text", *columns, "stratum")
