"""Removing duplicate sources of a frame."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.operators.cone import cone_pairs, renamed
from skyloom.sources.lineage import written

CONE = 5.0
# Which catalogue wins over which.
PRIORITY = {"Simbad": 0, "Gaia DR3": 1, "2MASS": 2, "Pan-STARRS": 3, "MPC": 4}


def by_identity(sources: DataFrame) -> DataFrame:
    """One row per catalogue identity and frame: no subtraction row if there is another, then the most flux, then the first.

    Uncatalogued rows stay. `place` is the first place (seq) of the identity. Only rows with an identity are shuffled together.
    """
    key = Window.partitionBy("frame_id", "catalog_name", "catalog_id")
    best = key.orderBy(F.coalesce("from_subtraction", F.lit(False)), F.coalesce("flux", F.lit(0e0)).desc(), "seq")
    named = sources.where("catalog_name IS NOT NULL AND catalog_id IS NOT NULL")
    kept = named.withColumns({"_rank": F.row_number().over(best), "place": F.min("seq").over(key)}).where("_rank = 1").drop("_rank")
    return kept.unionByName(sources.where("catalog_name IS NULL OR catalog_id IS NULL").withColumn("place", F.col("seq")))


def _without(rows: DataFrame, losers: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows less those of `losers` that lie nearer than the cone to a winner of their frame."""
    near = cone_pairs(losers.select("obs_id", "frame_id", "ra", "dec"), renamed(winners, "w_", "obs_id", "frame_id", "ra", "dec"), CONE, on=[("frame_id", "w_frame_id")], right_at=("w_ra", "w_dec"))
    return rows.join(near.select("obs_id").distinct(), "obs_id", "left_anti")


def subtraction_pairs(sources: DataFrame) -> DataFrame:
    """Drops uncatalogued subtraction candidates beside an uncatalogued normal detection."""
    free = sources.where("catalog_name IS NULL")
    return _without(sources, free.where("from_subtraction"), free.where("NOT from_subtraction"))


def unmatched_near_matched(sources: DataFrame) -> DataFrame:
    """Drops uncatalogued rows beside a catalogued one."""
    return _without(sources, sources.where("catalog_name IS NULL"), sources.where("catalog_name IS NOT NULL"))


def cross_catalog(sources: DataFrame) -> DataFrame:
    """Of rows of different catalogues beside each other the lower in priority goes.

    Pairs that share no row are decided by one comparison. Rows of chains (A-B-C, where B loses to A but would beat C) are
    replayed in the order of `seq`, frame after frame as the sorted pairs stream by; only one frame's losers are held. Rows and pairs are
    worked out once, to the shared folder.
    """
    rank = F.coalesce(F.create_map(*[F.lit(x) for k, v in PRIORITY.items() for x in (k, v)])[F.col("catalog_name")], F.lit(5))
    own = sources.where("catalog_name IS NOT NULL").select("obs_id", "frame_id", "seq", "ra", "dec", "catalog_name", rank.alias("rank"), F.coalesce(F.col("from_subtraction"), F.lit(False)).alias("sub"), F.coalesce(F.col("flux"), F.lit(0e0)).alias("flux"))
    own = written(own)
    pairs = cone_pairs(own, renamed(own, "o_"), CONE, on=[("frame_id", "o_frame_id")], right_at=("o_ra", "o_dec"), condition=(F.col("catalog_name") != F.col("o_catalog_name")) & (F.col("seq") < F.col("o_seq")))
    first_wins = F.struct("rank", "sub", -F.col("flux"), "seq") < F.struct(F.col("o_rank").alias("rank"), F.col("o_sub").alias("sub"), -F.col("o_flux"), F.col("o_seq").alias("seq"))
    pairs = written(pairs.select("frame_id", "obs_id", "seq", "o_obs_id", "o_seq", first_wins.alias("wins")))
    each = pairs.select("obs_id").unionAll(pairs.select(F.col("o_obs_id").alias("obs_id"))).groupBy("obs_id").count()
    busy = each.where("count > 1").select("obs_id", F.lit(True).alias("busy"))
    marked = pairs.join(busy, "obs_id", "left").join(busy.withColumnsRenamed({"obs_id": "o_obs_id", "busy": "o_busy"}), "o_obs_id", "left")
    lost = marked.where("busy IS NULL AND o_busy IS NULL").select(F.when(F.col("wins"), F.col("o_obs_id")).otherwise(F.col("obs_id")).alias("obs_id"))
    chains = marked.where("busy OR o_busy").select("frame_id", "seq", "o_seq", "obs_id", "o_obs_id", "wins")
    kind = sources.schema["obs_id"].dataType.simpleString()
    lost = lost.union(chains.repartition("frame_id").sortWithinPartitions("frame_id", "seq", "o_seq").mapInArrow(_replayed, f"obs_id {kind}"))
    return sources.join(lost.distinct(), "obs_id", "left_anti")


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs by frame and in order: the loser of each whose rows are both still there. What is held is one frame's losers."""
    at, gone = None, set()
    for batch in batches:
        out = []
        for frame, one, other, wins in zip(*[batch.column(n).to_pylist() for n in ("frame_id", "obs_id", "o_obs_id", "wins")], strict=True):
            if frame != at:
                at, gone = frame, set()
            if one not in gone and other not in gone:
                loser = other if wins else one
                gone.add(loser)
                out.append(loser)
        yield pa.RecordBatch.from_arrays([pa.array(out, batch.column("obs_id").type)], names=["obs_id"])
