"""Scalar column functions (JVM-side built-ins only, whole-stage codegen friendly)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO52 = float(2 ** 52)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: str | Column, lo: Column | float | None, hi: Column | float | None) -> Column:
    """pandas ``clip``: NULL stays NULL (Spark's least/greatest would skip it)."""
    x = col(c)
    out = x
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(float(lo)))
    return F.when(x.isNotNull(), out)


def round_half_even(c: str | Column, step: float | None = 1.0) -> Column:
    """Round to a multiple of ``step`` with ties to even (numpy ``round``)."""
    x = col(c)
    if step is None:
        return x
    if step == 1.0:
        return F.rint(x)
    return F.rint(x / step) * step


def _md5(key: Column, salt: str) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt)))


def _slice_uniform(h: Column, start: int) -> Column:
    return F.conv(F.substring(h, start, 13), 16, 10).cast("double") / _TWO52


def uniform(key: Column, salt: str) -> Column:
    """Deterministic U(0,1) from md5(key|salt): first 13 hex digits / 2^52.

    Same value on every retry and every partitioning (unlike ``rand``), and
    reproducible in SQL engines with md5.
    """
    return _slice_uniform(_md5(key, salt), 1)


def _sql_slice(key_sql: str, salt: str, start: int) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{salt}'), {start}, 13)) AS BIGINT)"
            f" / {_TWO52!r})")


def uniform_sql(key_sql: str, salt: str) -> str:
    """DuckDB twin of :func:`uniform`."""
    return _sql_slice(key_sql, salt, 1)


def normal(key: Column, salt: str, mean: Column | float = 0.0, sd: Column | float = 1.0) -> Column:
    """Box-Muller normal from one md5(key|salt): hex digits 1-13 and 14-26
    give two independent uniforms (u1 shifted away from 0)."""
    h = _md5(key, salt)
    u1 = (_slice_uniform(h, 1) * (_TWO52 - 1) + 1) / _TWO52
    u2 = _slice_uniform(h, 14)
    z = F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)
    m = mean if isinstance(mean, Column) else F.lit(float(mean))
    s = sd if isinstance(sd, Column) else F.lit(float(sd))
    return m + s * z


def normal_sql(key_sql: str, salt: str, mean: str = "0.0", sd: str = "1.0") -> str:
    u1 = f"(({_sql_slice(key_sql, salt, 1)} * {(_TWO52 - 1)!r} + 1) / {_TWO52!r})"
    u2 = _sql_slice(key_sql, salt, 14)
    return f"(({mean}) + ({sd}) * (sqrt(-2.0 * ln({u1})) * cos({2.0 * math.pi!r} * {u2})))"


def pick(key: Column, salt: str, choices: Sequence[str]) -> Column:
    """Uniform pick among ``choices`` by hash (replacement for np.random.choice)."""
    u = uniform(key, salt)
    idx = F.least(F.floor(u * len(choices)).cast("int"), F.lit(len(choices) - 1)) + 1
    return F.element_at(F.array(*[F.lit(v) for v in choices]), idx)


def domain_repair(c: str | Column, valid: Sequence[str], key: Column, salt: str = "repair") -> Column:
    """Values outside ``valid`` (incl. NULL) are replaced by a hash-uniform valid value."""
    x = col(c)
    return F.when(x.isin(*valid), x).otherwise(pick(key, salt, valid))


def percent(p: str | Column, decimals: int = 2) -> Column:
    """Python ``f'{p:.2%}'``."""
    return F.format_string(f"%.{decimals}f%%", col(p) * 100.0)


def text_bar(p: str | Column, width: int = 20, full: str = "█", empty: str = "░") -> Column:
    """``full * int(p*width) + empty * (width - int(p*width))``."""
    n = F.floor(col(p) * width).cast("int")
    return F.concat(F.repeat(F.lit(full), n), F.repeat(F.lit(empty), F.lit(width) - n))


def confidence_band(p: str | Column) -> Column:
    """Confidence ladder on the top-class probability (fixed thresholds)."""
    x = col(p)
    return (F.when(x >= 0.8, "very_confident").when(x >= 0.6, "confident")
            .when(x >= 0.4, "fairly_confident").otherwise("not_confident"))
