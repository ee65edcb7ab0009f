"""Exact decimal arithmetic helpers (column expressions, JVM-side).

Rounding follows PostgreSQL NUMERIC: half away from zero on the exact
value. Ratios are rounded from integers, never from a double, so the
result does not depend on summation order or on the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _abs(c: Column) -> Column:
    return F.abs(c)


def round_ratio(num: Column, den: Column, scale: int, num_scale: int = 0,
                precision: int = 18, den_scale: int = 0) -> Column:
    """``round(num / den, scale)`` exactly, half away from zero.

    ``num`` is an integer or a decimal with ``num_scale`` places, ``den`` an
    integer. NULL when ``den`` is 0 or NULL (the NULLIF guard of the models).
    """
    a = (num * F.lit(10 ** num_scale)).cast("decimal(38,0)") if num_scale else num.cast("decimal(38,0)")
    b = (den * F.lit(10 ** den_scale)).cast("decimal(38,0)") if den_scale else den.cast("decimal(38,0)")
    b = F.nullif(b, F.lit(0).cast("decimal(38,0)"))
    if den_scale:
        a = a * F.lit(10 ** den_scale).cast("decimal(38,0)")
    if scale >= num_scale:
        a = a * F.lit(10 ** (scale - num_scale)).cast("decimal(38,0)")
    else:
        b = b * F.lit(10 ** (num_scale - scale)).cast("decimal(38,0)")
    q = F.lit(2).cast("decimal(38,0)") * _abs(a) + _abs(b)
    r = idiv(q, F.lit(2).cast("decimal(38,0)") * _abs(b))
    signed = r * F.signum(a).cast("bigint") * F.signum(b).cast("bigint")
    return to_scaled(signed, scale, precision)


def idiv(a: Column, b: Column) -> Column:
    """Integral division ``a div b`` (the quotient must fit a long)."""
    return F.call_function("div", a, b)


def to_scaled(unscaled: Column, scale: int, precision: int = 18) -> Column:
    """Integer ``unscaled`` -> decimal(precision, scale) equal to unscaled / 10^scale."""
    if scale == 0:
        return unscaled.cast(f"decimal({precision},0)")
    step = F.lit(f"0.{'0' * (scale - 1)}1").cast(f"decimal({scale + 1},{scale})")
    # keep the product's precision <= 38 so Spark never trims the scale
    wide = min(36 - scale, 30)
    return (unscaled.cast(f"decimal({wide},0)") * step).cast(f"decimal({precision},{scale})")


def avg_exact(col: Column, scale: int, col_scale: int, precision: int = 18) -> Column:
    """``round(avg(col), scale)`` as an aggregate expression, exact."""
    return round_ratio(F.sum(col), F.count(col), scale, col_scale, precision)


def sql_round_ratio(num: str, den: str, scale: int, num_scale: int = 0,
                    precision: int = 18, den_scale: int = 0) -> str:
    """The same rule as :func:`round_ratio` as DuckDB SQL text (for oracles)."""
    a = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT)" if num_scale else f"CAST(({num}) AS HUGEINT)"
    b = (f"CAST(NULLIF(({den}) * {10 ** den_scale}, 0) AS HUGEINT)" if den_scale
         else f"CAST(NULLIF({den}, 0) AS HUGEINT)")
    if den_scale:
        a = f"({a} * {10 ** den_scale})"
    if scale >= num_scale:
        a = f"({a} * {10 ** (scale - num_scale)})"
    else:
        b = f"({b} * {10 ** (num_scale - scale)})"
    r = f"((2 * abs({a}) + abs({b})) // (2 * abs({b})) * sign({a}) * sign({b}))"
    if scale == 0:
        return f"CAST({r} AS DECIMAL({precision},0))"
    step = f"CAST(0.{'0' * (scale - 1)}1 AS DECIMAL({scale + 1},{scale}))"
    return f"CAST(CAST({r} AS DECIMAL(38,0)) * {step} AS DECIMAL({precision},{scale}))"
