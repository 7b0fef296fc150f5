"""Sharding over fixed virtual slots (DataFrame functions only).

Records hash into thousands of virtual slots; one aggregate measures the bytes
of every slot; a versioned map sends slots to shards. Rebalancing edits the
map, never the hash: rows only move when their slot does.

* Version 1 gives the slots, largest first, to the least loaded shard.
* :func:`grow_map` adds a shard: every old shard hands over slots beyond its
  new fair share, so rows move into the new shard and nowhere else.

The map has one row per slot (``n_slots``, a parameter), which bounds what is
folded, broadcast and stored. Positions inside a shard come from the slot's
offset plus a row number inside the virtual slot, so no task sorts a whole
shard.

Edge cases: a null key is replaced by a hash of the row's text, so rows
without ids still spread; repeated rows share a slot and get positions of
their own; null text has 0 bytes; an empty table gives an empty result and a
map in which slots are dealt in turn; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

N_SLOTS = 4096
ROW_OVERHEAD = 16


def records(docs: DataFrame, key: str = "doc_id", text: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """``key, size, text_crc32, vslot`` of every row. Bytes, not the text, move on."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body).cast("long") + F.lit(ROW_OVERHEAD)).alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.pmod(F.when(F.col(key).isNull(), F.xxhash64(body)).otherwise(F.xxhash64(key)),
               F.lit(n_slots)).cast("int").alias("vslot"))


def slot_sizes(recs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """``vslot, slot_rows, slot_bytes`` for every slot, also the empty ones."""
    used = recs.groupBy("vslot").agg(F.count("*").alias("slot_rows"), F.sum("size").alias("slot_bytes"))
    every = recs.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(F.broadcast(used), "vslot", "left").na.fill(0, ["slot_rows", "slot_bytes"])


def _least(loads: Column) -> Column:
    return F.array_position(loads, F.array_min(loads)).cast("int")


def first_map(sizes: DataFrame, n_shards: int) -> DataFrame:
    """Version 1: slots by falling bytes, each to the least loaded shard.

    The fold runs over one row per slot (bounded by ``n_slots``). Load counts
    bytes plus one, so empty slots are dealt in turn."""
    ordered = F.sort_array(F.collect_list(F.struct("slot_bytes", "vslot")), asc=False).alias("slots")
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), n_shards).alias("loads"),
                     F.array().cast("array<struct<vslot:int,shard:int>>").alias("dealt"))

    def deal(acc: Column, slot: Column) -> Column:
        to = _least(acc["loads"])
        load = F.get(acc["loads"], to - 1) + slot["slot_bytes"] + 1
        return F.struct(
            F.transform(acc["loads"], lambda old, i: F.when(i == to - 1, load).otherwise(old)).alias("loads"),
            F.concat(acc["dealt"], F.array(F.struct(slot["vslot"].alias("vslot"), (to - 1).alias("shard")))).alias("dealt"))

    return (sizes.groupBy().agg(ordered)
            .select(F.explode(F.aggregate("slots", start, deal, lambda acc: acc["dealt"])).alias("d"))
            .select("d.vslot", "d.shard", F.lit(1).alias("version")))


def grow_map(slot_map: DataFrame, sizes: DataFrame, n_shards: int) -> DataFrame:
    """Next version with shard ``n_shards`` added. Each old shard keeps slots,
    smallest first, up to the new mean; what lies beyond goes to the new shard."""
    w = Window.partitionBy("shard").orderBy("slot_bytes", "vslot")
    total = sizes.agg(F.sum("slot_bytes").alias("b")).scalar()
    kept = F.sum("slot_bytes").over(w) * F.lit(n_shards + 1) <= total
    return (slot_map.join(F.broadcast(sizes), "vslot")
            .withColumn("kept", kept)
            .select("vslot", F.when(F.col("kept"), F.col("shard")).otherwise(F.lit(n_shards)).alias("shard"),
                    (F.col("version") + 1).alias("version")))


def store_map(slot_map: DataFrame, path: str) -> None:
    """Append a version of the map; old versions stay readable."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map (the newest by default)."""
    maps = spark.read.parquet(path).select("vslot", "shard", F.col("version").cast("int").alias("version"))
    newest = maps.agg(F.max("version").alias("v")).scalar()
    return maps.where(F.col("version") == (F.lit(version) if version is not None else newest))


def place(recs: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """``recs`` with their ``shard`` and gapless ``position`` in it."""
    offset = F.sum("slot_rows").over(Window.partitionBy("shard").orderBy("vslot")) - F.col("slot_rows")
    lookup = slot_map.join(F.broadcast(sizes), "vslot").select("vslot", "shard", offset.alias("first"))
    inside = F.row_number().over(Window.partitionBy("vslot").orderBy("key", "text_crc32", "size"))
    return (recs.withColumn("inside", inside).join(F.broadcast(lookup), "vslot")
            .withColumn("position", F.col("first") + F.col("inside") - 1).drop("first", "inside"))


def shard_documents(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text",
                    n_slots: int = N_SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(placed records, slot map, slot sizes)``; the narrow record table is
    written once, so the text is read a single time."""
    recs = cut_lineage(records(docs, key, text, n_slots), "slot-records")
    sizes = cut_lineage(slot_sizes(recs, n_slots), "slot-sizes")
    slot_map = cut_lineage(first_map(sizes, n_shards), "slot-map")
    return place(recs, slot_map, sizes), slot_map, sizes
