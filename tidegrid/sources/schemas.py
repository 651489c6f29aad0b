"""The tables' schemas: explicit types, with unit and description in each field's metadata."""

from __future__ import annotations

from pyspark.sql import types as T

KINDS = {"s": T.StringType(), "i": T.IntegerType(), "d": T.DoubleType(), "b": T.BooleanType(), "t": T.DateType()}

#: The channels of a run's series, with unit and meaning.
CHANNELS = [
    ("x_yd", "yd", "distance of the hip from the start line"),
    ("v_yds", "yd/s", "speed along the lane"),
    ("a_yds2", "yd/s2", "acceleration along the lane"),
    ("trunk_angle", "deg", "lean of the trunk, positive forward"),
    ("hip_height_ratio", "", "height of the hip over the leg's length"),
    ("knee_lead", "deg", "knee angle of the leading leg"),
    ("knee_trail", "deg", "knee angle of the trailing leg"),
    ("hip_flex_lead", "deg", "hip angle of the leading leg"),
    ("hip_flex_trail", "deg", "hip angle of the trailing leg"),
    ("shin_angle_lead", "deg", "lean of the leading shin"),
    ("thigh_sep", "deg", "angle between the thighs"),
    ("elbow_angle", "deg", "mean elbow angle"),
    ("arm_swing", "", "distance of the wrists along the lane over the arm's length"),
    ("foot_contact", "", "1 while a foot is on the ground"),
    ("step_freq_hz", "1/s", "steps a second"),
    ("step_len_yd", "yd", "length of a step"),
]
CORE = ("x_yd", "trunk_angle", "hip_height_ratio")


def table(*fields: tuple[str, str, str, str]) -> T.StructType:
    """Fields as (name, kind, unit, description)."""
    return T.StructType([T.StructField(n, KINDS[k], True, {"unit": u, "description": d}) for n, k, u, d in fields])


_channels = [(n, "d", u, d) for n, u, d in CHANNELS]
SCHEMAS = {
    "videos": table(
        ("video_id", "s", "", "video"), ("season", "i", "", "season"), ("group", "s", "", "session group"), ("positions", "s", "", "positions of the session, separated by bars"), ("cls", "s", "", "class code"),
        ("title", "s", "", "title"), ("channel", "s", "", "channel"), ("upload_date", "t", "", "date of upload"), ("duration_s", "i", "s", "duration"), ("url", "s", "", "address"),
        ("width", "i", "px", "width"), ("height", "i", "px", "height"), ("fps", "s", "1/s", "frame rate as a fraction"), ("sha256", "s", "", "checksum of the file"),
    ),
    "runs_raw": table(
        ("run_id", "s", "", "run"), ("video_id", "s", "", "video"), ("group", "s", "", "session group"), ("positions", "s", "", "positions of the session"), ("slot", "i", "px", "place of the clock field"),
        ("t_origin", "d", "s", "when the clock was zero"), ("split10_coarse", "d", "s", "coarse reading of the split"), ("clip_ss", "d", "s", "start of the clip"), ("clip_frames", "i", "", "frames of the clip"),
        ("k0", "d", "frame", "frame at which the clock was zero"), ("final_time", "d", "s", "time that the clock stopped at"), ("split10", "d", "s", "split at 10 yards"), ("clock_resid_p95", "d", "s", "95th percentile of the clock's residual"),
        ("clock_monotone", "b", "", "whether readings never fall"), ("n_clock", "i", "", "readings used"), ("bib", "i", "", "number on the shirt"), ("bib_agree", "d", "", "share of readings that agree on it"),
    ),
    "panel_positions": table(("run_id", "s", "", "run"), ("panel_pos", "s", "", "position code on the panel"), ("panel_pos_score", "d", "", "score of the match")),
    "readings": table(("video_id", "s", "", "video"), ("t", "d", "s", "time"), ("x", "i", "px", "centre of the field"), ("value", "d", "s", "value read"), ("bib", "s", "", "number read")),
    "runs": table(
        ("run_id", "s", "", "run"), ("video_id", "s", "", "video"), ("group", "s", "", "session group"), ("position", "s", "", "position"), ("panel_pos", "s", "", "position code on the panel"), ("cls", "s", "", "class"),
        ("athlete", "s", "", "position code and number"), ("bib", "i", "", "number on the shirt"), ("attempt", "i", "", "attempt of the athlete, from 1"), ("split", "s", "", "train or test"), ("status", "s", "", "ok, rejected, duplicate or excluded"),
        ("qc_reason", "s", "", "rules that failed"), ("time_40yd", "d", "s", "time over 40 yards"), ("time_10yd", "d", "s", "split at 10 yards"), ("t_at_10yd", "d", "s", "when the hip crosses 10 yards"),
        ("clip_ss", "d", "s", "start of the clip"), ("clip_frames", "i", "", "frames of the clip"), ("k0", "d", "frame", "frame at which the clock was zero"),
        *((n, "d", "", d) for n, d in (
            ("clock_resid_p95", "95th percentile of the clock's residual"), ("clock_coverage", "readings over frames of the clock"), ("bib_agree", "share of readings that agree on the number"), ("panel_min_corr", "least correlation of the logo"),
            ("max_cut", "largest histogram distance between frames"), ("turf_min", "least share of turf"), ("turf_median", "median share of turf"), ("lane_frac", "share of frames with a lane"), ("track_frac", "share of frames with a position"))),
        ("start_support", "i", "", "frames that support the start line"),
        *((n, "d", "yd", d) for n, d in (("x_at_zero", "place when the clock starts"), ("x_at_stop", "place when the clock stops"), ("max_step_yd", "largest step between frames"), ("yardline_resid", "median distance of painted lines from multiples of 5"))),
    ),
    "series": table(("run_id", "s", "", "run"), ("frame", "i", "", "frame of the clip"), ("t_clock", "d", "s", "clock time"), *_channels, ("valid", "i", "", "1 if the core channels are there")),
    "series_by_time": table(("run_id", "s", "", "run"), ("phase", "d", "", "share of the clock's window"), ("t_clock", "d", "s", "clock time"), *_channels),
    "series_by_distance": table(("run_id", "s", "", "run"), ("x_yd", "d", "yd", "distance"), ("t_clock", "d", "s", "clock time"), *_channels[1:]),
}

#: The source's frame bundle, one row for each frame of a run.
FRAMES = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("k", T.IntegerType()),
        T.StructField("boxes", T.ArrayType(T.ArrayType(T.FloatType()))),
        T.StructField("conf", T.ArrayType(T.FloatType())),
        T.StructField("kpts", T.ArrayType(T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("x", "y", "conf")])))),
        T.StructField("logo", T.ArrayType(T.IntegerType())),
        T.StructField("hist", T.ArrayType(T.FloatType())),
    ]
)


def logical_type(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "number"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date" if isinstance(kind, T.DateType) else "datetime"
    return "string"
