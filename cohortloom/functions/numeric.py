"""Numeric columns: ages, clock hours, units, body measures, indicator transforms, normal quantiles, tail probabilities."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import fixed
from .text import col


def age_at(ts, birth) -> Column:
    return F.datediff(col(ts).cast("date"), col(birth).cast("date")) / F.lit(365.25)


def fractional_year(birth) -> Column:
    """Year of birth with the day as a fraction of that year, leap years included."""
    d = col(birth).cast("date")
    start, nxt = F.make_date(F.year(d), F.lit(1), F.lit(1)), F.make_date(F.year(d) + 1, F.lit(1), F.lit(1))
    return F.year(d) + F.datediff(d, start) / F.datediff(nxt, start)


def wrap_hour(h, noon: int = 12) -> Column:
    h = col(h)
    return F.when(h < noon, h + 24).otherwise(h)


def to_months(value, unit) -> Column:
    """Months for a value in years, months or weeks; null outside the unit's bounds."""
    value, unit = col(value), col(unit)
    factor = {"years": value * 12.0, "months": value * 1.0, "weeks": value / fixed.WEEKS_PER_MONTH}
    out = None
    for name, (lo, hi) in fixed.UNIT_BOUNDS.items():
        hit = (unit == name) & value.between(lo, hi)
        out = F.when(hit, factor[name]) if out is None else out.when(hit, factor[name])
    return out


def within(value, window) -> Column:
    value = col(value)
    lo, hi = window
    keep = value >= lo if hi is None else value.between(lo, hi)
    return F.when(keep, value)


def body_mass_index(weight_kg, height_cm) -> Column:
    h = within(height_cm, fixed.WINDOWS["height_cm"]) / 100.0
    return within(within(weight_kg, fixed.WINDOWS["weight_kg"]) / (h * h), fixed.WINDOWS["bmi"])


def pulse_pressure(sys, dia) -> Column:
    return within(col(sys) - col(dia), fixed.WINDOWS["pulse_pressure"])


def mean_pressure(sys, dia) -> Column:
    return within(col(dia) + (col(sys) - col(dia)) / 3.0, fixed.WINDOWS["mean_pressure"])


def transform_indicator(c, kind: str, eps: float = 1e-3, clip: float = fixed.LOGIT_CLIP) -> Column:
    """Shape an indicator; null where the transform is undefined."""
    c = col(c).cast("double")
    p = F.least(F.greatest(c, F.lit(clip)), F.lit(1.0 - clip))
    return {
        "identity": lambda: c,
        "neg": lambda: -c,
        "neg_log": lambda: F.when(c > 0, -F.log(c)),
        "log_eps": lambda: F.when(c + F.lit(eps) > 0, F.log(c + F.lit(eps))),
        "logit": lambda: F.when(c.isNotNull(), F.log(p / (F.lit(1.0) - p))),
        "log1p": lambda: F.when(c > -1, F.log1p(c)),
        "percent": lambda: c / 100.0,
    }[kind]()


def neg_log10(p) -> Column:
    p = col(p)
    return F.when(p > 0, -F.log10(p))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def safe_corr(a, b) -> Column:
    """Pearson correlation over rows with both values; null instead of a division error when one side is constant."""
    a, b = col(a), col(b)
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def _poly(coefs, x: Column) -> Column:
    return reduce(lambda acc, a: acc * x + F.lit(a), reversed(coefs[:-1]), F.lit(coefs[-1]))


def normal_quantile(p) -> Column:
    """Inverse of the normal distribution as plain arithmetic, so that it stays in generated code."""
    p = col(p)
    q = p - 0.5
    tail = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    centre = F.lit(0.180625) - q * q
    near, far = tail - 1.6, tail - 5.0
    outer = F.when(tail <= 5.0, _poly(fixed.PPF_C, near) / _poly(fixed.PPF_D, near)).otherwise(_poly(fixed.PPF_E, far) / _poly(fixed.PPF_F, far))
    return (
        F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
        .when(F.abs(q) <= 0.425, q * _poly(fixed.PPF_A, centre) / _poly(fixed.PPF_B, centre))
        .when(q < 0, -outer)
        .otherwise(outer)
    )


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after shifting the argument above 10."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    for _ in range(10):
        low = x < 10
        shift = np.where(low, shift + np.log(x), shift)
        x = np.where(low, x + 1, x)
    inv = 1.0 / x
    series = inv / 12 - inv**3 / 360 + inv**5 / 1260 - inv**7 / 1680
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series - shift


def student_log10_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """log10 of the two-sided tail probability of Student's t, by the continued fraction of the incomplete beta function."""
    t, df = np.abs(np.asarray(t, float)), np.asarray(df, float)
    with np.errstate(all="ignore"):
        x = df / (df + t * t)
        a, b = df / 2.0, np.full_like(df, 0.5)
        swap = x > (a + 1) / (a + b + 2)
        aa, bb, xx = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
        xx = np.where(swap, t * t / (df + t * t), xx)
        front = aa * np.log(xx) + bb * np.log1p(-xx) - np.log(aa) - (_log_gamma(aa) + _log_gamma(bb) - _log_gamma(aa + bb))
        tiny = 1e-300
        c, d = np.ones_like(xx), 1 - (aa + bb) * xx / (aa + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        h = d
        for m in range(1, 300):
            for step in (m * (bb - m) * xx / ((aa + 2 * m - 1) * (aa + 2 * m)), -(aa + m) * (aa + bb + m) * xx / ((aa + 2 * m) * (aa + 2 * m + 1))):
                d = 1 + step * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + step / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                h = h * d * c
            if np.nanmax(np.abs(d * c - 1), initial=0.0) < 1e-14:
                break
        log_part = front + np.log(h)
        out = np.where(swap, np.log1p(-np.exp(np.minimum(log_part, 0.0))), log_part) / np.log(10)
    out = np.where(t == 0, 0.0, out)
    return np.where(np.isfinite(t) & (df > 0), np.minimum(out, 0.0), np.nan)


@F.pandas_udf(DoubleType())
def log10_p_of_t(t: pd.Series, df: pd.Series) -> pd.Series:
    out = student_log10_p(t.to_numpy(dtype=float), df.to_numpy(dtype=float))
    return pd.Series(out).where(np.isfinite(out), None).astype("float64")
