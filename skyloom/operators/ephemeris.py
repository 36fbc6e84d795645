"""Movers where they are when a frame is taken: an as-of join in time and on the sphere.

Ephemerides are knots (designation, at, ra, dec, mag, object_type). Between two knots a mover goes along the great circle at an even pace. Each
stretch is cut at the edges of time buckets; a piece of it lies in a ball around its middle, so it goes to the sky cells that this ball and the
field's radius touch. A frame is in one bucket and one cell: the join is an equi-join on both, and what meets is placed at the frame's time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators.cone import cell_edge, cone_pairs, renamed
from skyloom.operators.matching import FOOTPRINT, MOVING_CONE, one_to_one

BUCKET_HOURS, MAX_GAP_DAYS = 24, 10
Vector = tuple[Column, Column, Column]


def weights(share: Column, angle: Column, sine: Column) -> tuple[Column, Column]:
    """What two unit vectors, an angle apart whose sine is given too, count for in the point at a share of the great circle's way between them."""
    near = angle < 1e-9
    return F.when(near, 1e0 - share).otherwise(F.sin((1e0 - share) * angle) / sine), F.when(near, share).otherwise(F.sin(share * angle) / sine)


def distance2(a: Vector, b: Vector) -> Column:
    """The square of the chord between two points."""
    return sum(((y - x) * (y - x) for x, y in zip(a, b, strict=True)), F.lit(0e0))


def _once(rows: DataFrame, **columns: Column | str) -> DataFrame:
    """Rows with these columns, worked out once as fields of an array's one element. Columns of a plain projection are put into every expression that uses
    them, filters included, and code that grows too long for the JVM's compiler is many times slower.
    """
    held = F.array(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]))
    return rows.select(*[c for c in rows.columns if c not in columns], F.explode(held).alias("_o")).select("*", "_o.*").drop("_o")


def stretches(knots: DataFrame, max_gap_days: float = MAX_GAP_DAYS) -> DataFrame:
    """designation, t0, t1 (microseconds), ra0, dec0, ra1, dec1, mag0, mag1, object_type, last: the ways between neighbouring knots.

    A gap of more than max_gap_days isn't bridged: its first knot, like an object's last one, stands for its own instant alone. Of knots at one
    time the first by position counts. Knots without a time or a position are left out.
    """
    known = knots.where(F.col("designation").isNotNull() & F.col("at").isNotNull() & F.col("ra").isNotNull() & F.col("dec").isNotNull())
    own = Window.partitionBy("designation").orderBy("t0")
    rows = known.withColumn("t0", F.unix_micros(F.col("at").cast("timestamp"))).groupBy("designation", "t0").agg(F.min(F.struct("ra", "dec", "mag", "object_type")).alias("k"))
    after = F.lead(F.struct("t0", "k")).over(own)
    rows = rows.withColumn("n", after)
    bridged = F.col("n").isNotNull() & (F.col("n.t0") - F.col("t0") <= int(max_gap_days * 86_400_000_000))
    to = lambda c: F.when(bridged, F.col(f"n.k.{c}")).otherwise(F.col(f"k.{c}"))
    return rows.select("designation", "t0", F.when(bridged, F.col("n.t0")).otherwise(F.col("t0")).alias("t1"), F.col("k.ra").alias("ra0"), F.col("k.dec").alias("dec0"), to("ra").alias("ra1"), to("dec").alias("dec1"), F.col("k.mag").alias("mag0"), to("mag").alias("mag1"), F.col("k.object_type").alias("object_type"))


def predicted(frames: DataFrame, knots: DataFrame, max_fov_deg: float, bucket_hours: float = BUCKET_HOURS, max_gap_days: float = MAX_GAP_DAYS, mag_limit: float | None = None) -> DataFrame:
    """frame_id, catalog_id (the designation), ra, dec, mag, object_type, sep_arcsec of the movers within a frame's field of view at its time.

    A frame at a knot's time sees the knot. mag is interpolated, null where a knot has none; with a limit, fainter movers go and those of an unknown
    magnitude stay. Frames without a time or centre see none.
    """
    bucket = int(bucket_hours * 3_600_000_000)
    edge, field = cell_edge(max_fov_deg * 3600 * FOOTPRINT["MPC"])
    ways = stretches(knots, max_gap_days)
    for k in (0, 1):
        ways = ways.withColumns(dict(zip((f"x{k}", f"y{k}", f"z{k}"), sky.unit_vector(f"ra{k}", f"dec{k}"), strict=True)))
    start, stop, middle = (tuple(F.col(n) for n in names) for names in (("x0", "y0", "z0"), ("x1", "y1", "z1"), ("mx", "my", "mz")))
    ways = ways.withColumn("angle", 2e0 * F.asin(F.least(F.lit(1e0), F.sqrt(distance2(start, stop)) / 2e0))).withColumn("sine", F.sin("angle"))
    share = lambda t: F.when(F.col("t1") > F.col("t0"), (t - F.col("t0")) / (F.col("t1") - F.col("t0"))).otherwise(0e0)
    weigh = lambda df, h: df.withColumns(dict(zip(("w0", "w1"), weights(h, F.col("angle"), F.col("sine")), strict=True)))
    point = tuple(F.col("w0") * a + F.col("w1") * b for a, b in zip(start, stop, strict=True))
    pieces = ways.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("t0") / bucket), F.floor(F.col("t1") / bucket))))
    first, last = share(F.greatest("t0", F.col("_bucket") * bucket)), share(F.least("t1", (F.col("_bucket") + 1) * bucket))
    pieces = weigh(_once(pieces, _from=first, _to=last), (F.col("_from") + F.col("_to")) / 2e0)
    pieces = _once(pieces, _reach=(F.col("_to") - F.col("_from")) * F.col("angle") / 2e0 * (1 + 1e-9) + field, **dict(zip(("mx", "my", "mz"), point, strict=True))).drop("_from", "_to", "w0", "w1")
    for n in "xyz":
        pieces = pieces.withColumn(f"_c{n}", F.explode(F.sequence(F.floor((F.col(f"m{n}") - F.col("_reach")) / edge), F.floor((F.col(f"m{n}") + F.col("_reach")) / edge))))
    pieces = pieces.select("_bucket", "_cx", "_cy", "_cz", "designation", "t0", "t1", "mag0", "mag1", "object_type", "angle", "sine", "_reach", *start, *stop, *middle)
    at = F.unix_micros(F.col("obs_time").cast("timestamp"))
    own = frames.where(F.col("obs_time").isNotNull() & F.col("ra_center").isNotNull() & F.col("dec_center").isNotNull()).select("frame_id", at.alias("t"), "ra_center", "dec_center", "fov_deg")
    own = own.withColumns(dict(zip(("fx", "fy", "fz"), sky.unit_vector("ra_center", "dec_center"), strict=True)))
    own = own.withColumns({"f_bucket": F.floor(F.col("t") / bucket), **{f"f_c{n}": F.floor(F.col(f"f{n}") / edge) for n in "xyz"}})
    # the ball spares placing what shares the cell alone: it's much smaller than a cell
    ball = distance2(tuple(F.col(f"f{n}") for n in "xyz"), middle) <= F.col("_reach") * F.col("_reach")
    met = own.join(pieces, (F.col("f_bucket") == F.col("_bucket")) & (F.col("f_cx") == F.col("_cx")) & (F.col("f_cy") == F.col("_cy")) & (F.col("f_cz") == F.col("_cz")) & (F.col("t") >= F.col("t0")) & ((F.col("t") < F.col("t1")) | (F.col("t0") == F.col("t1")) & (F.col("t") == F.col("t0"))) & ball)
    met = weigh(met, share(F.col("t"))).select("frame_id", "designation", "object_type", "ra_center", "dec_center", "fov_deg", (F.col("mag0") + (F.col("mag1") - F.col("mag0")) * share(F.col("t"))).alias("mag"), *[c.alias(f"_{n}") for n, c in zip("xyz", point, strict=True)])
    size = F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y") + F.col("_z") * F.col("_z"))
    placed = _once(_once(met, mag="mag", _x="_x", _y="_y", _z="_z"), ra=F.pmod(F.degrees(F.atan2("_y", "_x")), F.lit(36e1)), dec=F.degrees(F.asin(F.greatest(F.lit(-1e0), F.least(F.lit(1e0), F.col("_z") / size)))))
    placed = placed.withColumn("sep_arcsec", sky.separation_arcsec("ra_center", "dec_center", "ra", "dec")).where(F.col("sep_arcsec") <= FOOTPRINT["MPC"] * F.col("fov_deg") * 3.6e3)
    if mag_limit is not None:
        placed = placed.where(F.col("mag").isNull() | (F.col("mag") <= mag_limit))
    return placed.select("frame_id", F.col("designation").alias("catalog_id"), "ra", "dec", "mag", "object_type", "sep_arcsec")


def movers_in_time(sources: DataFrame, predictions: DataFrame, matched: DataFrame, radius: float = MOVING_CONE) -> DataFrame:
    """`matching.movers` with each frame's own predictions: a mover meets the sources of the frame that it was predicted for, where it is then."""
    free = sources.join(matched.select("obs_id"), "obs_id", "left_anti").select("obs_id", "frame_id", "ra", "dec")
    pairs = cone_pairs(free, renamed(predictions, "cat_", "frame_id", "catalog_id", "ra", "dec", "object_type"), radius, on=[("frame_id", "cat_frame_id")])
    return one_to_one(pairs)
