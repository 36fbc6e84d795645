"""The grid cone join: pairs of positions within a radius, as an equi-join.

Positions are points on the unit sphere in cubic cells whose edge is four times the radius' chord. A right row is in one
cell. A left row probes the cells that its ball touches: 3.4 on average, 8 at most. Pairs that meet are then held against
the exact great-circle distance. There is no special case at RA 0 or at the poles, each pair comes out once, and neither
side is broadcast by hand: Spark picks a hash or a sort-merge join, and adaptive execution splits crowded cells.
"""

from __future__ import annotations

from math import radians, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import sky

CELLS_PER_RADIUS = 4


def cell_edge(radius_arcsec: float) -> tuple[float, float]:
    """How wide a cell is, and how far a ball of the radius reaches, on the unit sphere."""
    chord = 2 * sin(radians(radius_arcsec / 3600) / 2)
    return chord * CELLS_PER_RADIUS, chord * (1 + 1e-9)


def cone_pairs(left: DataFrame, right: DataFrame, radius_arcsec: float, inclusive: bool = False, on: list[tuple[str, str]] | None = None, left_at: tuple[str, str] = ("ra", "dec"), right_at: tuple[str, str] = ("cat_ra", "cat_dec"), condition: Column | None = None, dense: bool = False) -> DataFrame:
    """All columns of both sides (whose names differ) and sep_arcsec, for pairs nearer than the radius.

    on: further equal columns (left, right); condition: a further predicate over both sides' columns. dense: most pairs that meet are near, so rows
    carry their points, and the great-circle distance decides only at the rim, where the chord doesn't.
    """
    edge, reach = cell_edge(radius_arcsec)
    lx, rx = sky.unit_vector(*left_at), sky.unit_vector(*right_at)
    cell = lambda v: F.floor(v / edge)
    spans = [F.sequence(cell(v - reach), cell(v + reach)) for v in lx]
    cells = F.flatten(F.transform(spans[0], lambda x: F.flatten(F.transform(spans[1], lambda y: F.transform(spans[2], lambda z: F.struct(x.alias("_cx"), y.alias("_cy"), z.alias("_cz")))))))
    known = lambda df, at: df.where(F.col(at[0]).isNotNull() & F.col(at[1]).isNotNull())
    probe = known(left, left_at).withColumn("_cell", F.explode(cells)).select("*", "_cell.*").drop("_cell")
    build = known(right, right_at).withColumns({f"_r{n}": cell(v) for n, v in zip(("cx", "cy", "cz"), rx, strict=True)})
    rule = (F.col("_cx") == F.col("_rcx")) & (F.col("_cy") == F.col("_rcy")) & (F.col("_cz") == F.col("_rcz"))
    for a, b in on or []:
        rule &= F.col(a) == F.col(b)
    if condition is not None:
        rule &= condition
    sep = sky.separation_arcsec(*left_at, *right_at)
    near = sep <= radius_arcsec if inclusive else sep < radius_arcsec
    points = ([f"_l{k}" for k in range(3)], [f"_r{k}" for k in range(3)]) if dense else ([], [])
    if dense:
        probe, build = probe.withColumns(dict(zip(points[0], lx, strict=True))), build.withColumns(dict(zip(points[1], rx, strict=True)))
        square = sum((F.col(a) - F.col(b)) * (F.col(a) - F.col(b)) for a, b in zip(*points, strict=True))
        chord = edge / CELLS_PER_RADIUS
        surely, maybe = max(0.0, chord * (1 - 1e-9) - 1e-13), chord * (1 + 1e-9) + 1e-13
        near = (square < surely * surely) | ((square <= maybe * maybe) & near)
    met = probe.join(build, rule & near).withColumn("sep_arcsec", sep)
    return met.drop("_cx", "_cy", "_cz", "_rcx", "_rcy", "_rcz", *points[0], *points[1])


def cone_any(left: DataFrame, right: DataFrame, radius_arcsec: float, inclusive: bool = False, left_at: tuple[str, str] = ("ra", "dec"), right_at: tuple[str, str] = ("cat_ra", "cat_dec"), condition: Column | None = None) -> DataFrame:
    """The left rows with any right row nearer than the radius that the condition holds for, each once: a semi join, which gives no pairs.

    Here the right rows go to the cells that their ball touches, so they should be the fewer ones.
    """
    edge, reach = cell_edge(radius_arcsec)
    cell = lambda v: F.floor(v / edge)
    names = ("cx", "cy", "cz")
    probe = left.withColumns({f"_{n}": cell(v) for n, v in zip(names, sky.unit_vector(*left_at), strict=True)})
    build = right.where(F.col(right_at[0]).isNotNull() & F.col(right_at[1]).isNotNull())
    for n, v in zip(names, sky.unit_vector(*right_at), strict=True):
        build = build.withColumn(f"_r{n}", F.explode(F.sequence(cell(v - reach), cell(v + reach))))
    sep = sky.separation_arcsec(*left_at, *right_at)
    rule = F.abs(F.col(left_at[1]) - F.col(right_at[1])) <= radius_arcsec / 3.6e3 * (1 + 1e-6) + 1e-9  # spares most of the distances
    for n in names:
        rule &= F.col(f"_{n}") == F.col(f"_r{n}")
    if condition is not None:
        rule &= condition
    rule &= sep <= radius_arcsec if inclusive else sep < radius_arcsec
    return probe.join(build, rule, "left_semi").drop(*[f"_{n}" for n in names])


def renamed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """The columns, each under prefix + name: the right side of a cone join."""
    return df.select(*[F.col(c).alias(prefix + c) for c in columns or df.columns])
