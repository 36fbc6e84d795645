"""History of positions without pairs: how many rows came before at a place, and their median magnitude, in O(n log n).

The cone join gives n(n-1)/2 pairs for a position that was seen n times. Here the past rows go to the cells that their cone touches and the
current ones to their own, so a cell's group holds all that its current rows need. Groups with few pairs are compared directly, many groups at once.
In the others both sides are cut into small boxes of a quarter of the radius. A box of past rows that lies wholly within the radius of a
box of current ones is taken as a whole: it is counted by ranks of time, and its magnitudes go in a tree of counts by rank in the order of time, which gives the
median before any time. Only boxes that the cone's rim crosses are compared row by row, inside the task and in bounded portions.

A group holds the epochs of one cell (four radii wide), some tens of bytes each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators.cone import cell_edge
from skyloom.operators.matching import MATCH_CONE

#: Pairs up to which a group is compared directly, pairs compared at once, and rows of whole groups that are worked on at once.
DIRECT, PAIRS_AT_ONCE, ROWS_AT_ONCE = 1 << 14, 1 << 20, 1 << 16
BOXES_PER_RADIUS = 4


class Counts:
    """Values by rank, with how many of each are in; finds the k-th smallest of those."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(values)
        self.size = 1 << max(0, int(len(self.values) - 1).bit_length())
        self.tree, self.n = [0] * (self.size + 1), 0

    def add(self, rank: int, by: int = 1) -> None:
        self.n += by
        at = rank + 1
        while at <= self.size:
            self.tree[at] += by
            at += at & -at

    def smallest(self, k: int) -> float:
        at, step = 0, self.size
        while step:
            if at + step <= self.size and self.tree[at + step] <= k:
                at += step
                k -= self.tree[at]
            step >>= 1
        return float(self.values[at])

    def median(self) -> float:
        return 0.5 * self.smallest((self.n - 1) // 2) + 0.5 * self.smallest(self.n // 2)


def separation(ra1: np.ndarray, dec1: np.ndarray, ra2: np.ndarray, dec2: np.ndarray) -> np.ndarray:
    """Arcseconds by the haversine formula, like `sky.separation_arcsec`."""
    d_dec, d_ra = np.sin(np.radians(dec2 - dec1) / 2), np.sin(np.radians(ra2 - ra1) / 2)
    h = d_dec * d_dec + np.cos(np.radians(dec1)) * np.cos(np.radians(dec2)) * d_ra * d_ra
    return 2 * np.degrees(np.arcsin(np.sqrt(np.minimum(1.0, h)))) * 3600


def middles(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The median of each row's values; nan for rows without any."""
    out = np.full(n, np.nan)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    own, first, count = np.unique(row, return_index=True, return_counts=True)
    out[own] = 0.5 * value[first + (count - 1) // 2] + 0.5 * value[first + count // 2]
    return out


class Cells:
    """Whole groups of current rows (kind 0) and past ones (kind 1). found: n and median of each current row, in the order of `current`."""

    def __init__(self, group, kind, at, ra, dec, mag, band, radius: float, most: int = DIRECT) -> None:
        self.at, self.ra, self.dec, self.mag, self.band, self.radius = at, ra, dec, mag, band, radius
        self.compared = 0
        self.current = np.flatnonzero(kind == 0)
        past = np.flatnonzero(kind == 1)
        self.past = past[np.lexsort((at[past], group[past]))]
        last = int(group[-1]) + 1 if len(group) else 0
        self.c_edge = np.searchsorted(group[self.current], np.arange(last + 1))
        self.p_edge = np.searchsorted(group[self.past], np.arange(last + 1))
        self.n = np.zeros(len(self.current), np.int64)
        self.median = np.full(len(self.current), np.nan)
        n_c, n_p = np.diff(self.c_edge), np.diff(self.p_edge)
        direct = np.flatnonzero((n_c * n_p > 0) & (n_c * n_p <= most))
        self._direct(direct, n_c, n_p)
        for g in np.flatnonzero(n_c * n_p > most).tolist():
            self._boxed(np.arange(self.c_edge[g], self.c_edge[g + 1]), self.past[self.p_edge[g] : self.p_edge[g + 1]])

    def _hits(self, c: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs (place in `current`, row of a past one) those within the radius and strictly before."""
        self.compared += len(c)
        row = self.current[c]
        early = np.flatnonzero(self.at[p] < self.at[row])
        c, p, row = c[early], p[early], row[early]
        near = separation(self.ra[row], self.dec[row], self.ra[p], self.dec[p]) <= self.radius
        return c[near], p[near]

    def _same(self, c: np.ndarray, p: np.ndarray) -> np.ndarray:
        return (self.band[self.current[c]] == self.band[p]) & (self.band[p] >= 0) & ~np.isnan(self.mag[p])

    def _direct(self, groups: np.ndarray, n_c: np.ndarray, n_p: np.ndarray) -> None:
        c = np.concatenate([np.zeros(0, np.int64), *(np.arange(self.c_edge[g], self.c_edge[g + 1]) for g in groups.tolist())])
        partners, begin = np.repeat(n_p[groups], n_c[groups]), np.repeat(self.p_edge[groups], n_c[groups])
        total = np.cumsum(partners)
        at = 0
        while at < len(c):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
            n = partners[at:stop]
            own = np.repeat(c[at:stop], n)
            other = self.past[np.repeat(begin[at:stop] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            own, other = self._hits(own, other)
            self.n += np.bincount(own, minlength=len(self.n))
            same = self._same(own, other)
            found = middles(own[same], self.mag[other[same]], len(self.n))
            self.median = np.where(np.isnan(found), self.median, found)
            at = stop

    def _boxes(self, rows: np.ndarray, edge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Which box each row is in, the boxes' corners, and the rows' places by box."""
        ra, dec = np.radians(self.ra[rows]), np.radians(self.dec[rows])
        v = np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], axis=1)
        _, box = np.unique(np.floor(v / edge).astype(np.int64), axis=0, return_inverse=True)
        box = box.ravel()
        order = np.argsort(box, kind="stable")
        cuts = np.searchsorted(box[order], np.arange(box.max() + 1))
        return np.minimum.reduceat(v[order], cuts), np.maximum.reduceat(v[order], cuts), np.split(order, cuts[1:])

    def _boxed(self, c: np.ndarray, past: np.ndarray) -> None:
        chord = 2 * np.sin(np.radians(self.radius / 3600) / 2)
        edge = chord / BOXES_PER_RADIUS
        c_low, c_high, c_in = self._boxes(self.current[c], edge)
        p_low, p_high, p_in = self._boxes(past, edge)
        for low, high, mine in zip(c_low, c_high, c_in, strict=True):
            least = np.maximum(0, np.maximum(p_low - high, low - p_high))
            most = np.maximum(p_high - low, high - p_low)
            least, most = (np.sqrt((x**2).sum(axis=1)) for x in (least, most))
            whole = most <= chord * (1 - 1e-9)
            rim = ~whole & (least <= chord * (1 + 1e-9))
            taken = [p_in[k] for k in np.flatnonzero(whole).tolist()]
            inside = past[np.sort(np.concatenate(taken))] if taken else past[:0]  # in the order of time, as `past` is
            crossed = np.concatenate([past[:0], *(past[p_in[k]] for k in np.flatnonzero(rim).tolist())])
            self._box(c[mine], inside, crossed)

    def _box(self, c: np.ndarray, inside: np.ndarray, crossed: np.ndarray) -> None:
        self.n[c] += np.searchsorted(self.at[inside], self.at[self.current[c]], side="left")
        own, other = [c[:0]], [crossed[:0]]
        step = max(1, PAIRS_AT_ONCE // max(1, len(crossed)))
        for a in range(0, len(c) if len(crossed) else 0, step):
            part = c[a : a + step]
            x, y = self._hits(np.repeat(part, len(crossed)), np.tile(crossed, len(part)))
            self.n += np.bincount(x, minlength=len(self.n))
            same = self._same(x, y)
            own.append(x[same])
            other.append(y[same])
        own, other = np.concatenate(own), np.concatenate(other)
        for band in np.unique(self.band[self.current[c]]).tolist():
            if band < 0:
                continue
            mine = c[self.band[self.current[c]] == band]
            mine = mine[np.argsort(self.at[self.current[mine]], kind="stable")]
            held = inside[(self.band[inside] == band) & ~np.isnan(self.mag[inside])]
            at_rim = np.flatnonzero(np.isin(own, mine))
            at_rim = at_rim[np.argsort(own[at_rim], kind="stable")]
            counts = Counts(self.mag[np.concatenate([held, other[at_rim]])])
            rank = np.searchsorted(counts.values, self.mag[held]).tolist()
            extra = np.searchsorted(counts.values, self.mag[other[at_rim]]).tolist()
            begin, end = (np.searchsorted(own[at_rim], mine, side=s).tolist() for s in ("left", "right"))
            before = np.searchsorted(self.at[held], self.at[self.current[mine]], side="left").tolist()
            done = 0
            for k, row in enumerate(mine.tolist()):
                for r in rank[done : before[k]]:
                    counts.add(r)
                done = max(done, before[k])
                for r in extra[begin[k] : end[k]]:
                    counts.add(r)
                if counts.n:
                    self.median[row] = counts.median()
                for r in extra[begin[k] : end[k]]:
                    counts.add(r, -1)


def _numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _counted(radius: float, direct: int) -> Callable:
    def worked(table: pa.Table) -> pa.RecordBatch:
        cx, cy, cz, kind, at, ra, dec = (_numbers(table.column(k)) for k in ("cx", "cy", "cz", "kind", "at", "ra", "dec"))
        group = np.append(0, np.cumsum((np.diff(cx) != 0) | (np.diff(cy) != 0) | (np.diff(cz) != 0)))
        mag = _numbers(table.column("mag").fill_null(np.nan).combine_chunks()).astype(np.float64)
        band = _numbers(table.column("filter").combine_chunks().dictionary_encode().indices.fill_null(-1))
        cells = Cells(group, kind, at, ra, dec, mag, band.astype(np.int64), radius, direct)
        seen = np.flatnonzero(cells.n)
        ids = table.column("obs_id").combine_chunks().take(pa.array(cells.current[seen]))
        return pa.RecordBatch.from_arrays([ids, pa.array(cells.n[seen]), pa.array(cells.median[seen], mask=np.isnan(cells.median[seen]))], names=["obs_id", "n_history", "median_mag"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                table = pa.Table.from_batches(held)
                cell = np.stack([_numbers(table.column(k)) for k in ("cx", "cy", "cz")])
                cut = int(np.argmax((cell == cell[:, -1:]).all(axis=0)))  # the last group may go on
                if cut:
                    yield worked(table.slice(0, cut))
                    held = table.slice(cut).combine_chunks().to_batches()
                    rows = table.num_rows - cut
        if rows:
            yield worked(pa.Table.from_batches(held))

    return run


def narrow(current: DataFrame, past: DataFrame, radius: float = MATCH_CONE, direct: int = DIRECT) -> DataFrame:
    """Per current row with any: n_history, past rows within the radius (inclusive) and strictly before its time; median_mag of those with the
    same known filter and a magnitude (null if none). Rows without a position or a time have no history and are none. direct: up to so many pairs
    a cell's rows are compared one by one.
    """
    edge, reach = cell_edge(radius)
    cell = lambda v: F.floor(v / edge)
    at = F.unix_micros(F.col("obs_time").cast("timestamp")).alias("at")
    columns = lambda df, known: [(F.col(n) if n in df.columns else F.lit(None)).cast("double" if n != "filter" else "string").alias(n) if known or n != "mag" else F.lit(None).cast("double").alias(n) for n in ("ra", "dec", "mag", "filter")]
    placed = lambda df: df.where(F.col("ra").isNotNull() & F.col("dec").isNotNull() & F.col("obs_time").isNotNull())
    v = sky.unit_vector("ra", "dec")
    mine = placed(current).select(*[cell(x).alias(n) for n, x in zip(("cx", "cy", "cz"), v, strict=True)], F.lit(0).alias("kind"), "obs_id", at, *columns(current, False))
    rows = placed(past).select(F.lit(1).alias("kind"), at, *columns(past, True))
    for n, x in zip(("cx", "cy", "cz"), v, strict=True):
        rows = rows.withColumn(n, F.explode(F.sequence(cell(x - reach), cell(x + reach))))
    rows = rows.withColumn("obs_id", F.lit(None).cast(current.schema["obs_id"].dataType)).select(*mine.columns)
    met = mine.union(rows).repartition("cx", "cy", "cz").sortWithinPartitions("cx", "cy", "cz")
    kind = current.schema["obs_id"].dataType.simpleString()
    return met.mapInArrow(_counted(radius, direct), f"obs_id {kind}, n_history long, median_mag double")
