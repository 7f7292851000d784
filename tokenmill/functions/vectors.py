"""Column functions over ``ARRAY<FLOAT|DOUBLE>`` vectors (M3, M4, M5).

Built from higher-order functions (``transform``, ``aggregate``), so they
run inside the JVM with no Python round trip.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill.constants import RMS_EPS, ROPE_THETA
from tokenmill.functions.text import col_of


def as_double(vec) -> Column:
    return F.transform(col_of(vec), lambda x: x.cast("double"))


def rotary(vec, pos, theta: float = ROPE_THETA, offset: int = 0) -> Column:
    """M3: rotary position: ``x * cos(p f) + rot(x) * sin(p f)`` with
    ``f_d = theta ** (-2 (d mod D/2) / D)`` and ``rot(x) = (-x2, x1)``."""
    v = as_double(vec)
    n = F.size(v)
    half = (n / 2).cast("int")
    p = (col_of(pos) + F.lit(offset)).cast("double")

    def one(x, d):
        f = F.pow(F.lit(float(theta)), -2.0 * (d % half).cast("double") / n.cast("double"))
        other = F.when(d < half, -F.element_at(v, d + half + 1)).otherwise(F.element_at(v, d - half + 1))
        return x * F.cos(p * f) + other * F.sin(p * f)

    return F.transform(v, one)


def rms_normalize(vec, eps: float = RMS_EPS, gain=None) -> Column:
    """M4: ``x / sqrt(mean(x^2) + eps) * g`` (no centring; g = 1 by default)."""
    v = as_double(vec)
    ms = F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x * x) / F.size(v)
    scale = F.sqrt(ms + F.lit(eps))
    out = F.transform(v, lambda x: x / scale)
    if gain is not None:
        out = F.zip_with(out, as_double(gain), lambda x, g: x * g)
    return out


def softmax(vec) -> Column:
    """M5: stable softmax of an array: subtract the max, exp, divide by the sum."""
    v = as_double(vec)
    m = F.array_max(v)
    e = F.transform(v, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)
