"""Quaternion algebra and angles as plain column expressions.

A quaternion is a tuple of four columns (w, x, y, z), a vector a tuple of three.  Nothing
here needs Python at run time: Catalyst folds and shares the expressions.
"""

from __future__ import annotations

from functools import reduce
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

Quaternion = tuple[Column, Column, Column, Column]
Vector = tuple[Column, Column, Column]


def norm(q: tuple[Column, ...]) -> Column:
    """Length of a quaternion or vector (total acceleration for a vector)."""
    return F.sqrt(sum((c * c for c in q[1:]), q[0] * q[0]))


def normalize(q: tuple[Column, ...]) -> tuple[Column, ...]:
    n = norm(q)
    return tuple(c / n for c in q)


def conjugate(q: Quaternion) -> Quaternion:
    """Conjugate as it is; :func:`inverse` normalizes first."""
    return q[0], -q[1], -q[2], -q[3]


def inverse(q: Quaternion) -> Quaternion:
    return conjugate(normalize(q))


def hamilton(p: Quaternion, q: Quaternion) -> Quaternion:
    """Hamilton product as it is; :func:`product` normalizes its second factor."""
    a, b, c, d = p
    w, x, y, z = q
    return a * w - b * x - c * y - d * z, a * x + b * w + c * z - d * y, a * y - b * z + c * w + d * x, a * z + b * y - c * x + d * w


def product(*qs: Quaternion) -> Quaternion:
    """Product of one or more quaternions, folded from the right."""
    if not qs:
        raise ValueError("no quaternion to multiply")
    return reduce(lambda right, left: hamilton(left, normalize(right)), qs[-2::-1], qs[-1]) if len(qs) > 1 else qs[0]


def rotate(v: Vector, q: Quaternion) -> Vector:
    """conj(q) v q for a unit quaternion."""
    return hamilton(hamilton(conjugate(q), (F.lit(0.0), *v)), q)[1:]


def rotation_between(p: Quaternion, q: Quaternion) -> Quaternion:
    """The rotation that takes p to q."""
    return hamilton(inverse(p), normalize(q))


def slerp(p: Quaternion, q: Quaternion, alpha: Column) -> Quaternion:
    """Spherical interpolation on the short way; linear where both are (nearly) one."""
    dot = sum((a * b for a, b in zip(p[1:], q[1:])), p[0] * q[0])
    sign, c = F.when(dot < 0, -1.0).otherwise(1.0), F.abs(dot)
    theta = F.acos(F.least(c, F.lit(1.0)))
    flat = c >= 1.0
    s = F.sin(theta)
    wp = F.when(flat, 1 - alpha).otherwise(F.sin((1 - alpha) * theta) / s)
    wq = F.when(flat, alpha).otherwise(F.sin(alpha * theta) / s)
    return tuple(wp * a + wq * sign * b for a, b in zip(p, q))


def to_euler(q: Quaternion) -> Vector:
    """Roll (x), pitch (y) and yaw (z) of a unit quaternion; the pitch is clamped."""
    w, x, y, z = q
    pitch = F.asin(2 * F.least(F.greatest(w * y - x * z, F.lit(-0.5)), F.lit(0.5)))
    return F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)), pitch, F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def from_euler(x: Column, y: Column, z: Column) -> Quaternion:
    """Unit quaternion of roll, pitch and yaw (applied z, then y, then x)."""
    (cx, sx), (cy, sy), (cz, sz) = ((F.cos(a / 2), F.sin(a / 2)) for a in (x, y, z))
    return cx * cy * cz + sx * sy * sz, sx * cy * cz - cx * sy * sz, cx * sy * cz + sx * cy * sz, cx * cy * sz - sx * sy * cz


def mean(q: Quaternion) -> Quaternion:
    """Aggregate: mean of the parts (nulls left out), normalized."""
    return normalize(tuple(F.avg(c) for c in q))


def to_body_frame(q: Quaternion, acc: Vector, reference: Quaternion) -> tuple[Quaternion, Vector]:
    """Orientation and acceleration of a sensor relative to its reference."""
    return normalize(hamilton(q, conjugate(reference))), hamilton(hamilton(reference, (F.lit(0.0), *acc)), conjugate(reference))[1:]


def correct_heading(q: Quaternion, heading: Quaternion) -> Quaternion:
    """conj(h) q h."""
    return hamilton(hamilton(conjugate(heading), q), heading)


def heading_of(reference: Quaternion) -> Column:
    """Heading of a reference: direction of the rotated x axis, less half a turn, in radians."""
    x, y, _ = rotate((F.lit(1.0), F.lit(0.0), F.lit(0.0)), conjugate(reference))
    return F.atan2(y, x) - pi


def correct_acceleration(acc: Vector, q: Quaternion, gravity: float = 1000.0) -> Vector:
    """Acceleration in the world frame without gravity (milli-g)."""
    x, y, z = hamilton(hamilton(q, (F.lit(0.0), *acc)), conjugate(q))[1:]
    return x, y, z - gravity


def milli_g(acc: Column) -> Column:
    """Milli-g to metres per second squared."""
    return acc * 9.80665 / 1000


def adduction(q: Quaternion) -> Column:
    """Elevation of the rotated y axis."""
    w, x, y, z = q
    return F.atan2(2 * (y * z + w * x), F.hypot(2 * (x * y - w * z), 1 - 2 * (x * x + z * z)))


def flexion(q: Quaternion) -> Column:
    """Negative elevation of the rotated x axis."""
    w, x, y, z = q
    return -F.atan2(2 * (x * z - w * y), F.hypot(1 - 2 * (y * y + z * z), 2 * (x * y + w * z)))


def upside_down(q: Quaternion) -> Column:
    """Has the rotated z axis turned over, so that angles are mirrored?"""
    _, x, y, _ = q
    return 1 - 2 * (x * x + y * y) < 0
