"""Plane geometry on columns.  Points and vectors are pairs of columns (x, y); the image's y grows downwards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[Column, Column]
TINY = 1e-9


def minus(a: Point, b: Point) -> Point:
    return a[0] - b[0], a[1] - b[1]


def dot(a: Point, b: Point) -> Column:
    return a[0] * b[0] + a[1] * b[1]


def norm(a: Point) -> Column:
    return F.hypot(a[0], a[1])


def midpoint(a: Point, b: Point) -> Point:
    return (a[0] + b[0]) / 2, (a[1] + b[1]) / 2


def joint_angle(a: Point, b: Point, c: Point) -> Column:
    """Degrees at b between the directions to a and to c."""
    u, v = minus(a, b), minus(c, b)
    cosine = dot(u, v) / (norm(u) * norm(v) + F.lit(TINY))
    # Least and greatest pass over nulls: an unknown point must not make an angle of 0.
    return F.when(cosine.isNotNull(), F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))))


def lean(top: Point, bottom: Point, forward: Point) -> Column:
    """Degrees between bottom-to-top and straight up; positive if tilted forward or exactly across."""
    v = minus(top, bottom)
    angle = F.degrees(F.atan2(F.abs(v[0]), -v[1]))
    return F.when(dot(v, forward) < 0, -angle).otherwise(F.when(dot(v, forward).isNotNull(), angle))


def angular_distance(a: Column, b: Column) -> Column:
    """Of two undirected angles in degrees: 0 to 90."""
    d = F.pmod(F.abs(a - b), F.lit(180.0))
    return F.least(d, F.lit(180.0) - d)


def cross_line(p: Point, d: Point, q: Point, e: Point) -> tuple[Column, Column, Column]:
    """Where the line p + t d meets q + u e: x, y and t, null for parallel lines."""
    det = d[1] * e[0] - d[0] * e[1]
    r = minus(q, p)
    t = F.when(F.abs(det) >= TINY, (r[1] * e[0] - r[0] * e[1]) / det)
    return p[0] + t * d[0], p[1] + t * d[1], t


def project(s: Column, a: Column, b: Column, c: Column) -> Column:
    """A projective map of the line."""
    return (a * s + b) / (c * s + 1)


def unproject(u: Column, a: Column, b: Column, c: Column) -> Column:
    """Its inverse."""
    return (u - b) / (a - c * u)


def at_x(p: Point, d: Point, x: Column) -> Point:
    """The point of the line p + t d at abscissa x."""
    t = (x - p[0]) / d[0]
    return p[0] + t * d[0], p[1] + t * d[1]


def rung_angle(forward: Point, up: Point) -> Column:
    """Degrees from ``forward`` to ``up``, positive upwards in the image."""
    return -F.degrees(F.atan2(forward[0] * up[1] - forward[1] * up[0], dot(forward, up)))
