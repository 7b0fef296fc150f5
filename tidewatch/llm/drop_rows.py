"""Removing documents by key without moving the texts of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 18


def one_of_each(docs: DataFrame, verdicts: DataFrame, key: str = "doc_id", kept: str = "kept") -> DataFrame:
    """Rows of ``docs`` whose key ``verdicts`` (one row per document row) keeps,
    one row per key.

    Only rows whose key shares a hash slot with a dropped or repeated key take
    part in a join; the broadcast slot table has at most ``SLOTS`` rows. Rows
    with a null key stay.
    """
    dropped = verdicts.where(~F.col(kept)).select(key).distinct()
    repeated = verdicts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(SLOTS))
    slots = F.broadcast(dropped.union(repeated).select(slot.alias("_slot")).distinct())
    marked = docs.withColumn("_slot", F.when(F.col(key).isNotNull(), slot))
    apart = marked.join(slots, "_slot", "left_anti").select(*docs.columns)
    joined = marked.join(slots, "_slot", "left_semi").select(*docs.columns)
    return apart.union(joined.join(dropped, key, "left_anti").select(*docs.columns).dropDuplicates([key]))
