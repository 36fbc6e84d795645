"""A table of frames' rows that is read by place: coarse sky cells and months as partitions, replaced frame by frame.

Rows belong to cubic cells of the unit sphere of about CELL_DEG degrees (some hundreds in all, whatever the history's length). A folder holds a block of
ACROSS cells each way (some fifty in all), then months, sorted by cell and declination, so that row groups can be skipped too. A write adds a part
with the rows of the frames it speaks for, and names these frames in each cell in which they have rows now or had some before, in a small table
sorted by cell; a frame's rows in a cell are those of the newest part that names it there. So replacing or emptying a frame never rewrites other frames'
files, a read opens the wanted cells' folders alone, and only rows of older parts are held against names. `compact` merges parts, so that a folder has few
files again.
"""

from __future__ import annotations

from functools import reduce
from math import radians, sin

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyloom.functions import sky
from skyloom.sources.manifest import Manifest

CELL_DEG = 10.0
EDGE = 2 * sin(radians(CELL_DEG) / 2)
#: Cells that a folder spans each way.
ACROSS = 3
NOWHERE = "none"


def cell(ra: str = "ra", dec: str = "dec", across: int = 1) -> Column:
    """The name of the cell that a position is in, or of the block of cells; `none` for rows without one."""
    named = F.concat_ws("_", *[F.floor(F.floor(v / EDGE) / across).cast("string") for v in sky.unit_vector(ra, dec)])
    return F.when(F.col(ra).isNotNull() & F.col(dec).isNotNull(), named).otherwise(NOWHERE)


def block(name: str) -> str:
    """The block that a cell is in, by their names."""
    return name if name == NOWHERE else "_".join(str(int(k) // ACROSS) for k in name.split("_"))


def cells_near(rows: DataFrame, radius_arcsec: float, ra: str = "ra", dec: str = "dec") -> set[str]:
    """The cells that a ball around any row touches: names for the driver, never more than there are cells on the sphere."""
    reach = 2 * sin(radians(min(radius_arcsec / 3600, 180)) / 2) * (1 + 1e-9)
    placed = rows.where(F.col(ra).isNotNull() & F.col(dec).isNotNull())
    for k, v in enumerate(sky.unit_vector(ra, dec)):
        placed = placed.withColumn(f"_c{k}", F.explode(F.sequence(F.floor((v - reach) / EDGE), F.floor((v + reach) / EDGE))))
    return {r[0] for r in placed.select(F.concat_ws("_", *[F.col(f"_c{k}").cast("string") for k in range(3)])).distinct().collect()}


HOMES = StructType().add("frame_id", "string").add("cell", "string")


class SkyHistory:
    """schema: the rows' columns, with frame_id, a position and a time under the names given (time None: no months)."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, ra: str = "ra", dec: str = "dec", time: str | None = "obs_time") -> None:
        self.spark, self.schema, self.ra, self.dec, self.time = spark, schema, ra, dec, time
        self.manifest = Manifest(spark, path)

    def _parts(self) -> list[dict]:
        return self.manifest.current()[1].get("parts", [])

    def _at(self, folder: str, kind: str) -> str:
        return f"{self.manifest.path}/parts/{folder}/{kind}"

    def _none(self, kind: StructType) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields])

    def _speaks(self, parts: list[dict], first: int = 0) -> DataFrame:
        """frame_id, cell, part: which frames each part from the first on speaks for, and in which cells."""
        read = lambda part: self.spark.read.schema(HOMES).parquet(self._at(part["names"], "cells"))
        named = [read(part).withColumn("part", F.lit(order)) for order, part in enumerate(parts) if order >= first]
        return reduce(DataFrame.union, named) if named else self._none(StructType([*HOMES.fields]).add("part", "integer"))

    def _kind(self) -> StructType:
        return StructType([*self.schema.fields]).add("small", "string").add("cell", "string").add("month", "string")

    def _rows(self, parts: list[dict], cells: set[str] | None) -> list[DataFrame]:
        """The rows of each part, with small (the cell) and part; only the folders of the wanted cells are opened."""
        blocks, out = None if cells is None else {block(c) for c in cells}, []
        for order, part in enumerate(parts):
            base = self._at(part["rows"], "rows")
            names = sorted(part["cells"] if blocks is None else blocks.intersection(part["cells"]))
            if names:
                folders = [base] if len(names) == len(part["cells"]) else [f"{base}/cell={n}" for n in names]
                rows = self.spark.read.schema(self._kind()).option("basePath", base).parquet(*folders).withColumn("part", F.lit(order))
                out.append(rows if cells is None else rows.where(F.col("small").isin(sorted(cells))))
        return out

    def _current(self, parts: list[dict], cells: set[str] | None) -> DataFrame:
        """The newest part's rows are current as they are; an older part's where no newer one names their frame in their cell."""
        names = self._speaks(parts, 1)
        if cells is not None:
            names = names.where(F.col("cell").isin(sorted(cells)) if cells else F.lit(False))
        newest = names.groupBy(F.col("cell").alias("n_cell"), F.col("frame_id").alias("n_frame_id")).agg(F.max("part").alias("n_part"))
        replaced = (F.col("small") == F.col("n_cell")) & (F.col("frame_id") == F.col("n_frame_id")) & (F.col("n_part") > F.col("part"))
        out = [rows.select(*self.schema.names) for rows in self._rows(parts[-1:], cells)]
        if older := self._rows(parts[:-1], cells):
            out.append(reduce(DataFrame.union, older).join(newest, replaced, "left_anti").select(*self.schema.names))
        return reduce(DataFrame.union, out) if out else self._none(self.schema)

    def read(self, cells: set[str] | None = None) -> DataFrame:
        """The current rows, of these cells or all."""
        return self._current(self._parts(), cells)

    def homes(self, frames: DataFrame) -> set[str]:
        """The cells in which these frames have or had rows: names for the driver, never more than there are cells."""
        if not (parts := self._parts()):
            return set()
        where = self._speaks(parts).join(frames.select("frame_id").distinct(), "frame_id", "left_semi")
        return {r[0] for r in where.select("cell").distinct().collect()}

    def _written_rows(self, rows: DataFrame) -> tuple[dict, DataFrame]:
        """Writes the rows; returns their folder and the blocks in it, and frame_id and cell of each frame in each cell."""
        folder, path = self.manifest.folder()
        month = F.coalesce(F.date_format(self.time, "yyyy-MM"), F.lit(NOWHERE)) if self.time else F.lit(NOWHERE)
        placed = rows.where("frame_id IS NOT NULL").select(*self.schema.names).withColumns({"small": cell(self.ra, self.dec), "cell": cell(self.ra, self.dec, ACROSS), "month": month})
        placed.repartition("cell", "month").sortWithinPartitions("cell", "month", "small", self.dec).write.partitionBy("cell", "month").parquet(f"{path}/rows")
        back = self.spark.read.schema(self._kind()).parquet(f"{path}/rows")
        return {"rows": folder, "cells": self.manifest.values(f"parts/{folder}/rows", "cell")}, back.select("frame_id", F.col("small").alias("cell"))

    def _part(self, rows: dict, homes: DataFrame) -> dict:
        """Writes which frames a part speaks for, sorted by cell."""
        names, path = self.manifest.folder()
        homes.distinct().sort("cell").write.parquet(f"{path}/cells")
        return {**rows, "names": names}

    def publish(self, batch: DataFrame, affected: DataFrame | None = None, only: bool = False) -> int:
        """Replaces all rows of the affected frames (the batch's own, where none are given) by the batch's; returns the version.

        The same batch again changes nothing that can be read. Two writers may be at work: the later commit has the last word on a frame.
        only: the batch is known to hold rows of the affected frames alone.
        """
        ids = (affected if affected is not None else batch).select(F.col("frame_id").cast("string").alias("frame_id")).distinct()
        rows, has = self._written_rows(batch if only else batch.join(ids, "frame_id", "left_semi"))

        def change(state: dict) -> dict:
            parts = state.get("parts", [])
            homes = has.union(ids.withColumn("cell", F.lit(NOWHERE)))
            if parts:
                homes = homes.union(self._speaks(parts).select("frame_id", "cell").join(ids, "frame_id", "left_semi"))
            return {"parts": [*parts, self._part(rows, homes)]}

        return self.manifest.commit(change)

    def compact(self, keep: int = 0) -> int:
        """Merges all parts but the first `keep` into one, with one file for each folder and month; what is read stays the same."""

        def change(state: dict) -> dict:
            parts = state.get("parts", [])
            if len(parts) <= keep + 1:
                return state
            rows, _ = self._written_rows(self._current(parts[keep:], None))
            return {"parts": [*parts[:keep], self._part(rows, self._speaks(parts[keep:]).select("frame_id", "cell"))]}

        return self.manifest.commit(change)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes what the newest `keep` versions don't use; only while no writer is at work."""
        return self.manifest.vacuum(lambda state: {p[k] for p in state.get("parts", []) for k in ("rows", "names")}, keep)
