"""Body channels from keypoints: angles in the image plane, and lengths in units of the body.

A keypoint is a struct (x, y, conf); after ``smooth_keypoints`` a frame has a column ``p<number>`` (struct x, y; null where unknown) for each
number in ``JOINTS``.  Left and right are told apart by the place along the lane, as lead and trail.  Everything is columns and windows: the
coordinates of one keypoint are one series, so that all of them share one shuffle by run and keypoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions import geometry as G
from tidegrid.operators.series import gap_fill, savgol

# Keypoint numbers (left, right), the least confidence, and the longest gap in frames.
SHOULDERS, ELBOWS, WRISTS, HIPS, KNEES, ANKLES = (5, 6), (7, 8), (9, 10), (11, 12), (13, 14), (15, 16)
JOINTS = range(5, 17)
SURE, GAP = 0.3, 4
#: The channels that ``channels`` adds.
NAMES = ("trunk_angle", "hip_height_ratio", "knee_lead", "knee_trail", "hip_flex_lead", "hip_flex_trail", "shin_angle_lead", "thigh_sep", "elbow_angle", "arm_swing")


def masked(points: Column, number: int, least: float = SURE) -> Column:
    """A keypoint, null if it is unsure."""
    p = F.get(points, F.lit(number))
    return F.when(p["conf"] >= least, F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))


def xy(name: str) -> G.Point:
    return F.col(name)["x"], F.col(name)["y"]


def smooth_keypoints(frames: DataFrame, key: list[str], frame: str, points: str, width: int = 7, degree: int = 2) -> DataFrame:
    """The key, the frame and the smoothed keypoints: unsure ones masked, gaps of up to ``GAP`` frames filled, each coordinate smoothed."""
    each = F.array(*(F.struct(F.lit(j).alias("joint"), masked(F.col(points), j).alias("p")) for j in JOINTS))
    long = frames.select(*key, frame, F.explode(each).alias("_e")).select(*key, frame, F.col("_e.joint").alias("_joint"), F.col("_e.p.x").alias("_x"), F.col("_e.p.y").alias("_y"))
    for c in ("_x", "_y"):
        long = gap_fill(long, [*key, "_joint"], frame, c, GAP, "null", f"_f{c}")
        long = savgol(long, [*key, "_joint"], frame, f"_f{c}", width, degree, 0, 1.0, f"_s{c}")
    whole = F.when(F.col("_s_x").isNotNull() & F.col("_s_y").isNotNull(), F.struct(F.col("_s_x").alias("x"), F.col("_s_y").alias("y")))
    return long.groupBy(*key, frame).agg(*(F.max(F.when(F.col("_joint") == j, whole)).alias(f"p{j}") for j in JOINTS))


def span(a: str, b: str) -> Column:
    return G.norm(G.minus(xy(a), xy(b)))


def body_scale(frames: DataFrame, key: list[str]) -> DataFrame:
    """The key with leg_len (median thigh plus median shank, of both sides) and arm_len (median length of the left arm): constants of a run."""
    segment = lambda upper, lower: F.array(*(span(f"p{u}", f"p{v}") for u, v in zip(upper, lower, strict=True)))
    sides = frames.select(*key, F.explode(F.arrays_zip(segment(HIPS, KNEES).alias("thigh"), segment(KNEES, ANKLES).alias("shank"))).alias("_l")).select(*key, "_l.*")
    legs = sides.groupBy(*key).agg((F.median("thigh") + F.median("shank")).alias("leg_len"))
    upper, lower, hand = (f"p{x[0]}" for x in (SHOULDERS, ELBOWS, WRISTS))
    arms = frames.groupBy(*key).agg(F.median(span(upper, lower) + span(lower, hand)).alias("arm_len"))
    return legs.join(arms, key)


def lead_left(left: Column, right: Column) -> Column:
    """Whether the left ankle is at least as far along the lane; the right leg leads where either is unknown."""
    return F.coalesce(left >= right, F.lit(False))


def mean_known(*values: Column) -> Column:
    """The mean of what is known, null if nothing is."""
    count = sum(v.isNotNull().cast("int") for v in values)
    return F.when(count > 0, sum(F.coalesce(v, F.lit(0.0)) for v in values) / count)


def channels(frames: DataFrame) -> DataFrame:
    """``frames`` with the channels in ``NAMES``.

    Columns used: p5 to p16, forward (struct x, y: the run's unit direction in the image), ground_y (the lane under the hip), ankle_l and ankle_r (places
    along the lane), leg_len and arm_len.  What a channel needs and lacks makes it null."""
    left = lead_left(F.col("ankle_l"), F.col("ankle_r"))
    lead = {n: F.when(left, F.col(f"p{a}")).otherwise(F.col(f"p{b}")).alias(f"_lead_{n}") for n, (a, b) in (("hip", HIPS), ("knee", KNEES), ("ankle", ANKLES))}
    trail = {n: F.when(left, F.col(f"p{b}")).otherwise(F.col(f"p{a}")).alias(f"_trail_{n}") for n, (a, b) in (("hip", HIPS), ("knee", KNEES), ("ankle", ANKLES))}
    out = frames.select("*", *lead.values(), *trail.values())
    shoulder, hip = (G.midpoint(xy(f"p{a}"), xy(f"p{b}")) for a, b in (SHOULDERS, HIPS))
    forward = xy("forward")
    reach = [G.dot(G.minus(xy(f"p{w}"), xy(f"p{s}")), forward) / F.col("arm_len") for w, s in zip(WRISTS, SHOULDERS, strict=True)]
    found = {
        "trunk_angle": G.lean(shoulder, hip, forward),
        "hip_height_ratio": (F.col("ground_y") - hip[1]) / F.col("leg_len"),
        "knee_lead": G.joint_angle(xy("_lead_hip"), xy("_lead_knee"), xy("_lead_ankle")),
        "knee_trail": G.joint_angle(xy("_trail_hip"), xy("_trail_knee"), xy("_trail_ankle")),
        "hip_flex_lead": G.joint_angle(shoulder, xy("_lead_hip"), xy("_lead_knee")),
        "hip_flex_trail": G.joint_angle(shoulder, xy("_trail_hip"), xy("_trail_knee")),
        "shin_angle_lead": G.lean(xy("_lead_knee"), xy("_lead_ankle"), forward),
        "thigh_sep": G.joint_angle(xy("_lead_knee"), hip, xy("_trail_knee")),
        "elbow_angle": mean_known(*(G.joint_angle(*(xy(f"p{x[side]}") for x in (SHOULDERS, ELBOWS, WRISTS))) for side in (0, 1))),
        "arm_swing": F.greatest(*reach) - F.least(*reach),
    }
    return out.select(*frames.columns, *(found[n].alias(n) for n in NAMES))
