"""Sharding by fixed virtual slots.

Rows hash into SLOTS slots, for good. One aggregation gives bytes and rows per slot, the only thing that comes to the
driver (SLOTS rows at most). A slot map says which shard holds which slot; maps are stored by version, and rebalancing
edits the last one: it moves as few slots as it takes to level the bytes. Rows are numbered within their shard by slot,
so no task ever holds a whole shard.

The hash takes the id and the text, so neither a repeated id, a null id nor a common text fills one slot; only rows that
are equal in both share one. Null texts have no bytes. An empty table gives an empty result and a map of even slot counts.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.common import text_or_empty

SLOTS = 4096
ROW_BYTES = 16
MAP = "slot int, shard int, first long, bytes long, n_rows long"


def slot_of(*columns: str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def slot_totals(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """rows(virtual_slot, size) -> bytes and rows per slot."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))
    return {r["virtual_slot"]: (r["bytes"], r["n_rows"]) for r in found.collect()}


def planned(totals: Mapping[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> list[int]:
    """A first map: the largest slots first, each to the shard with the fewest bytes so far."""
    heap = [(0, 0, k) for k in range(shards)]
    out = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-totals.get(s, (0, 0))[0], s)):
        size, count, k = heapq.heappop(heap)
        out[slot] = k
        heapq.heappush(heap, (size + totals.get(slot, (0, 0))[0], count + 1, k))
    return out


def rebalanced(old: list[int], totals: Mapping[int, tuple[int, int]], shards: int) -> list[int]:
    """The old map edited for a new number of shards: slots leave shards that go or that hold more than their share."""
    new, load = list(old), [0] * max(shards, max(old, default=-1) + 1)
    size = lambda s: totals.get(s, (0, 0))[0]
    for slot, k in enumerate(old):
        load[k] += size(slot)
    share = sum(load) / shards
    moving = [s for s, k in enumerate(old) if k >= shards]
    for slot in sorted(range(len(old)), key=lambda s: (-size(s), s)):
        k = old[slot]
        if k < shards and size(slot) and load[k] - size(slot) >= share:
            load[k] -= size(slot)
            moving.append(slot)
    heap = [(load[k], k) for k in range(shards)]
    heapq.heapify(heap)
    for slot in sorted(moving, key=lambda s: (-size(s), s)):
        held, k = heapq.heappop(heap)
        new[slot] = k
        heapq.heappush(heap, (held + size(slot), k))
    return new


def as_map(spark: SparkSession, shard_of: list[int], totals: Mapping[int, tuple[int, int]]) -> DataFrame:
    """The map as a table; first: how many rows of the shard lie in its slots before this one."""
    seen: dict[int, int] = {}
    rows = []
    for slot, k in enumerate(shard_of):
        size, count = totals.get(slot, (0, 0))
        rows.append((slot, k, seen.get(k, 0), size, count))
        seen[k] = seen.get(k, 0) + count
    return spark.createDataFrame(rows, MAP)


def save_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Stores a version beside the others; one that is there already is never changed."""
    slot_map.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{path}/version={version}")


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot."""
    text = text_or_empty()
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), slot_of("doc_id", "text", slots=slots).alias("virtual_slot"))


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds shard and slot: the row's number in its shard, from 0. The map has SLOTS rows, so it is broadcast."""
    order = Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    known = slot_map.select(F.col("slot").alias("virtual_slot"), "shard", "first")
    numbered = rows.withColumn("nth", F.row_number().over(order).cast("long") - 1).join(F.broadcast(known), "virtual_slot")
    return numbered.withColumn("slot", F.col("first") + F.col("nth")).drop("first", "nth")
