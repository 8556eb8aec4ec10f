"""Rotations and rigid transforms as column expressions.

Quaternions are (w, x, y, z); matrices are nine numbers in row order; vectors
are arrays of three.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _at(c: Column, n: int) -> list[Column]:
    return [c[i] for i in range(n)]


def dot(a: Column, b: Column, n: int = 3) -> Column:
    return sum((a[i] * b[i] for i in range(1, n)), a[0] * b[0])


def norm(a: Column, n: int = 3) -> Column:
    return F.sqrt(dot(a, a, n))


def cross(a: Column, b: Column) -> Column:
    return F.array(a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def scaled(a: Column, k: Column, n: int = 3) -> Column:
    return F.array(*[a[i] * k for i in range(n)])


def minus(a: Column, b: Column) -> Column:
    return F.array(*[a[i] - b[i] for i in range(3)])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; else each use would repeat the whole expression."""
    return F.transform(F.array(value), use)[0]


def unit(a: Column, n: int = 3) -> Column:
    of = lambda x, size: F.array(*[F.when(size > 1e-12, x[i] / size).otherwise(0.0) for i in range(n)])
    return let(a, lambda x: let(norm(x, n), lambda size: of(x, size)))


def matrix_of_quaternion(q: Column) -> Column:
    """The identity where the norm is about 0."""
    s = dot(q, q, 4)
    w, x, y, z = _at(q, 4)
    k = F.when(s > 1e-12, 2 / s).otherwise(0.0)
    return F.array(
        1 - k * (y * y + z * z), k * (x * y - z * w), k * (x * z + y * w),
        k * (x * y + z * w), 1 - k * (x * x + z * z), k * (y * z - x * w),
        k * (x * z - y * w), k * (y * z + x * w), 1 - k * (x * x + y * y),
    )


def angle_of_matrix(m: Column) -> Column:
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (m[0] + m[4] + m[8] - 1) / 2)))


def axis_angle_of_matrix(m: Column) -> Column:
    """Rotation vector; zero at angle 0, from the diagonal close to a half turn."""
    angle = angle_of_matrix(m)
    off = F.array(m[7] - m[5], m[2] - m[6], m[3] - m[1])
    plain = scaled(off, angle / (2 * F.sin(angle)))
    root = lambda i: F.sqrt(F.greatest((m[i] + 1) / 2, F.lit(0.0)))
    x, y, z = root(0), root(4), root(8)
    sign = lambda v: F.when(v < 0, -1.0).otherwise(1.0)
    half = F.when((x >= y) & (x >= z), F.array(x, y * sign(m[1]), z * sign(m[2]))).when(y >= z, F.array(x * sign(m[1]), y, z * sign(m[5]))).otherwise(F.array(x * sign(m[2]), y * sign(m[5]), z))
    zero = F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    return F.when(angle < 1e-8, zero).when(angle > 3.14159, scaled(half, angle)).otherwise(plain)


def matrix_of_axis_angle(r: Column) -> Column:
    """Rodrigues' formula."""
    a = norm(r)
    x, y, z = (F.when(a > 1e-12, r[i] / a).otherwise(0.0) for i in range(3))
    s, c = F.sin(a), F.cos(a)
    v = 1 - c
    return F.array(
        c + x * x * v, x * y * v - z * s, x * z * v + y * s,
        y * x * v + z * s, c + y * y * v, y * z * v - x * s,
        z * x * v - y * s, z * y * v + x * s, c + z * z * v,
    )


def matrix_of_rpy(roll: Column, pitch: Column, yaw: Column) -> Column:
    """Turns about the fixed x, y and z axes, in this order."""
    cr, sr, cp, sp, cy, sy = F.cos(roll), F.sin(roll), F.cos(pitch), F.sin(pitch), F.cos(yaw), F.sin(yaw)
    return F.array(
        cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr,
        sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr,
        -sp, cp * sr, cp * cr,
    )


def times(m: Column, p: Column) -> Column:
    return F.array(*[m[3 * i] * p[0] + m[3 * i + 1] * p[1] + m[3 * i + 2] * p[2] for i in range(3)])


def transposed(m: Column) -> Column:
    return F.array(*[m[3 * j + i] for i in range(3) for j in range(3)])


def product(a: Column, b: Column) -> Column:
    return F.array(*[sum((a[3 * i + k] * b[3 * k + j] for k in range(1, 3)), a[3 * i] * b[j]) for i in range(3) for j in range(3)])


def to_world(m: Column, t: Column, p: Column) -> Column:
    turned = times(m, p)
    return F.array(*[turned[i] + t[i] for i in range(3)])


def to_camera(m: Column, t: Column, p: Column) -> Column:
    return times(transposed(m), minus(p, t))


def projected(p: Column, fx: float, fy: float, cx: float, cy: float) -> Column:
    """Pixel (u, v) of a point in front of the camera, else NaN."""
    ahead, nan = p[2] > 1e-3, F.lit(float("nan"))
    return F.array(F.when(ahead, fx * p[0] / p[2] + cx).otherwise(nan), F.when(ahead, fy * p[1] / p[2] + cy).otherwise(nan))


def back_projected(u: Column, v: Column, depth: Column, fx: float, fy: float, cx: float, cy: float) -> Column:
    """The point at a pixel's depth; null where the depth isn't positive."""
    return F.when(depth > 0, F.array((u - cx) * depth / fx, (v - cy) * depth / fy, depth))


def wrist_frame(wrist: Column, index: Column, middle: Column) -> Column:
    """Axes from three points: z to the middle knuckle, x to the index knuckle at right angles, y = z x x; as columns of a matrix."""
    frame = lambda x, y, z: F.array(*[c[i] for i in range(3) for c in (x, y, z)])
    side = lambda t, z: let(dot(t, z), lambda k: unit(minus(t, scaled(z, k))))
    return let(
        unit(minus(middle, wrist)),
        lambda z: let(
            minus(index, wrist), lambda t: let(side(t, z), lambda x: let(cross(z, x), lambda y: frame(x, y, z)))
        ),
    )
