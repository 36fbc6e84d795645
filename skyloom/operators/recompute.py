"""What a late, re-analysed or demoted frame changes in the classification of others, and the reclassification of those alone.

A row's outcome rests on earlier rows within the wide cone (the narrow one lies inside it), on earlier frames whose field holds its
place, and on its own frame's rows. So the joins of the classification are walked backwards: from the changed rows (as they
were and as they are) to later rows around them, and from the changed frames' fields to later rows in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators.cone import cone_any
from skyloom.operators.matching import MOVING_CONE


def affected_frames(rows: DataFrame, changed_rows: DataFrame, changed_frames: DataFrame, max_fov_deg: float, radius: float = MOVING_CONE, coverage_at: str = "tile") -> DataFrame:
    """frame_id of the frames in `rows` with a row whose outcome may rest on the changes, and of the changed frames themselves.

    rows: obs_id, frame_id, obs_time, ra, dec of current rows, at least those around the changes. changed_rows and changed_frames: both versions of what
    changed, the one before and the one after (a demoted frame has the first alone, a new one the second). Rows without a position or a time rest on nothing.
    """
    mine = rows.select("frame_id", "obs_time", "ra", "dec")
    old = changed_rows.groupBy(F.col("ra").alias("h_ra"), F.col("dec").alias("h_dec")).agg(F.min("obs_time").alias("h_obs_time"))
    cone = cone_any(mine, old, radius, inclusive=True, right_at=("h_ra", "h_dec"), condition=F.col("h_obs_time") < F.col("obs_time"))
    at = {"tile": (sky.tile("ra"), sky.tile("dec")), "source": (F.col("ra"), F.col("dec"))}[coverage_at]
    places = mine.where(F.col("ra").isNotNull() & F.col("dec").isNotNull()).select("frame_id", "obs_time", at[0].alias("t_ra"), at[1].alias("t_dec")).distinct()
    center = ("f_ra_center", "f_dec_center")
    fields = changed_frames.groupBy(*[F.col(c).alias(f"f_{c}") for c in ("ra_center", "dec_center", "fov_deg")]).agg(F.min("obs_time").alias("f_obs_time"))
    inside = (F.col("f_obs_time") < F.col("obs_time")) & (sky.separation_arcsec("t_ra", "t_dec", *center) <= F.col("f_fov_deg") / 2 * 3.6e3)
    held = cone_any(places, fields, max_fov_deg / 2 * 3600, inclusive=True, left_at=("t_ra", "t_dec"), right_at=center, condition=inside)
    return cone.select("frame_id").union(held.select("frame_id")).union(changed_frames.select("frame_id")).union(changed_rows.select("frame_id")).distinct()
