"""Rounding, vectors, half precision and quantisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column) -> Column:
    """Nearest integer, ties to even, as a long."""
    return F.rint(x).cast("bigint")


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def l2_normalize(vec: Column, least: float = 1e-12) -> Column:
    """Vector over its length, the length taken as `least` at least."""
    n = F.greatest(norm(vec), F.lit(least))
    return F.transform(vec, lambda x: x.cast("double") / n)


def l2_normalize_eps(vec: Column, eps: float = 1e-6) -> Column:
    """Vector over its length plus eps."""
    n = norm(vec) + eps
    return F.transform(vec, lambda x: x.cast("double") / n)


def half(x: Column) -> Column:
    """x rounded to half precision and back, as a double; beyond 65504 infinite."""
    x = x.cast("double")
    exponent = F.greatest(F.floor(F.log2(F.abs(x))), F.lit(-14))
    quantum = F.pow(F.lit(2.0), exponent - 10)
    out = F.rint(x / quantum) * quantum
    return F.when(x == 0, F.lit(0.0)).when(F.abs(out) > 65504, F.when(x > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))).otherwise(out)


def quantize(vec: Column, bits: int = 4) -> Column:
    """struct(codes, lo, step): the vector in 2^bits even steps from its least to its largest value."""
    if bits not in (2, 3, 4):
        raise ValueError("bits must be 2, 3 or 4")
    wide = F.transform(vec, lambda x: x.cast("double"))
    lo, hi = F.array_min(wide), F.array_max(wide)
    step = (hi - lo) / (2**bits - 1)
    codes = F.transform(wide, lambda x: F.when(step > 0, F.rint((x - lo) / step)).otherwise(F.lit(0.0)).cast("int"))
    return F.struct(codes.alias("codes"), lo.alias("lo"), step.alias("step"))


def dequantize(q: Column) -> Column:
    return F.transform(q["codes"], lambda c: q["lo"] + c * q["step"])


def elu_scale(x: Column) -> Column:
    """ELU(x) + 1."""
    return F.when(x > 0, x + 1).otherwise(F.exp(x))


def frame_rate(text: Column, default: float = 25.0) -> Column:
    """Rate of `a/b` or `a`; `default` where it is empty, malformed or b is 0."""
    part = F.split(text, "/")
    a, b = F.get(part, F.lit(0)).try_cast("double"), F.coalesce(F.get(part, F.lit(1)).try_cast("double"), F.when(F.size(part) == 1, F.lit(1.0)))
    return F.coalesce(F.try_divide(a, b), F.lit(default))


def raw_frame_rate(text: Column) -> Column:
    """The text, '' where it says nothing."""
    return F.when(F.coalesce(text, F.lit("")).isin("", "0/0"), F.lit("")).otherwise(text)


def duration_ms(seconds: Column) -> Column:
    """Milliseconds of a text in seconds, ties to even; 0 where it is no number."""
    return F.coalesce(half_even(seconds.try_cast("double") * 1000), F.lit(0).cast("bigint"))


def real_time_factor(elapsed: Column, duration: Column) -> Column:
    return F.when(duration > 0, F.try_divide(elapsed, duration)).otherwise(F.lit(0.0))


def to_ms(sample: Column, rate: Column | float) -> Column:
    """Sample number to milliseconds, ties to even."""
    return half_even(sample.cast("double") / rate * 1000)


def mono(channels: Column) -> Column:
    """Mean of an array of channels, each an array of samples."""
    n = F.size(channels)
    zero = F.transform(F.get(channels, F.lit(0)), lambda _: F.lit(0.0))
    total = F.aggregate(channels, zero, lambda a, c: F.zip_with(a, c, lambda x, y: x + y.cast("double")))
    return F.transform(total, lambda x: x / n)
