"""Black-Scholes Greeks as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hart's rational approximation of the normal distribution, as published by G. West (2005).
HART_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
HART_BOTTOM = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
HART_TAIL = 2.506628274631
HART_SPLIT = 7.07106781186547


def _poly(x: Column, cs: tuple[float, ...]) -> Column:
    out = F.lit(cs[0])
    for c in cs[1:]:
        out = out * x + F.lit(c)
    return out


def normal_cdf(z: Column) -> Column:
    x = F.abs(z)
    e = F.exp(-x * x / 2)
    inner = e * _poly(x, HART_TOP) / _poly(x, HART_BOTTOM)
    tail = x
    for k in (0.65, 4.0, 3.0, 2.0, 1.0):
        tail = x + k / tail if k != 0.65 else x + F.lit(k)
    outer = e / tail / F.lit(HART_TAIL)
    upper = F.when(x > 37, 0.0).when(x < HART_SPLIT, inner).otherwise(outer)
    return F.when(z > 0, 1 - upper).otherwise(upper)


def with_greeks(df: DataFrame, spot: str = "underlying_price", legacy_put_rho: bool = False) -> DataFrame:
    """df with delta, gamma, theta (a day), vega and rho (a percent each); null where volatility, time, spot or strike
    is not above zero. callput c or call is a call, anything else a put. legacy_put_rho: a put's rho with a plus."""
    s, k, t, v = (F.col(c).cast("double") for c in (spot, "strike", "time_to_maturity", "iv"))
    r = F.coalesce(F.col("interest_rate").cast("double"), F.lit(0.0))
    ok = (s > 0) & (k > 0) & (t > 0) & (v > 0)
    s, k, t, v = (F.when(ok, x) for x in (s, k, t, v))
    d1 = (F.ln(s / k) + (r + v * v / 2) * t) / (v * F.sqrt(t))
    d2 = d1 - v * F.sqrt(t)
    base = df.withColumns({"__d1": d1, "__d2": d2})
    d1, d2 = F.col("__d1"), F.col("__d2")
    density = F.exp(-d1 * d1 / 2) / F.lit(math.sqrt(2 * math.pi))
    call = F.lower("callput").isin("c", "call")
    up, down1, down2 = normal_cdf(d1), normal_cdf(-d1), normal_cdf(-d2)
    up2, discount = normal_cdf(d2), F.exp(-r * t)
    decay = -(s * density * v) / (2 * F.sqrt(t))
    put_rho = k * t * discount * down2 / 100
    return base.withColumns(
        {
            "delta": F.when(call, up).otherwise(-down1),
            "gamma": density / (s * v * F.sqrt(t)),
            "theta": F.when(call, decay - r * k * discount * up2).otherwise(decay + r * k * discount * down2) / 365,
            "vega": s * density * F.sqrt(t) / 100,
            "rho": F.when(call, k * t * discount * up2 / 100).otherwise(put_rho if legacy_put_rho else -put_rho),
        }
    ).drop("__d1", "__d2")
