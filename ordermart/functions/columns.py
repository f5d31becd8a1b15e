"""Reusable column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermart.functions import fixed


def when_chain_below(value: Column, bands: Sequence[tuple[float, str]], otherwise: str, inclusive: bool = False) -> Column:
    """``value < b1 -> n1, < b2 -> n2, ... else otherwise`` (``<=`` when
    inclusive). A NULL value falls through to ``otherwise``."""
    expr = None
    for bound, name in bands:
        cond = value <= bound if inclusive else value < bound
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(otherwise))


def size_tier(item_count: Column) -> Column:
    """1 -> single_item, <=5 small, <=20 medium, else (and NULL) large."""
    first, *rest = fixed.SIZE_TIERS
    expr = F.when(item_count == first[0], F.lit(first[1]))
    for bound, name in rest:
        expr = expr.when(item_count <= bound, F.lit(name))
    return expr.otherwise(F.lit(fixed.SIZE_TIER_ELSE))


def revenue_band(amount_usd: Column) -> Column:
    """<25 micro, <100 small, <500 medium, <2000 large, else (and NULL)
    enterprise."""
    return when_chain_below(amount_usd, fixed.REVENUE_BANDS, fixed.REVENUE_BAND_ELSE)


def is_cross_border(shipping_country: Column, customer_country: Column) -> Column:
    """False only when both countries are known and equal."""
    return ~F.coalesce(shipping_country == customer_country, F.lit(False))


def safe_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """``round(1.0 * n / nullif(d, 0), digits)``."""
    return F.round(numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double"), digits)


def count_when(cond: Column) -> Column:
    """``count(case when cond then 1 end)``."""
    return F.count(F.when(cond, F.lit(1)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = fixed.EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km, computed in double."""
    p1 = F.radians(lat1.cast("double"))
    p2 = F.radians(lat2.cast("double"))
    dphi = F.radians(lat2.cast("double") - lat1.cast("double"))
    dlam = F.radians(lon2.cast("double") - lon1.cast("double"))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlam / 2), 2)
    return F.lit(2 * radius_km) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def elapsed_hours(later_ts: Column, earlier_ts: Column) -> Column:
    """Hours between two timestamps, from microsecond epochs."""
    return (F.unix_micros(later_ts) - F.unix_micros(earlier_ts)).cast("double") / F.lit(3_600_000_000.0)


def parse_iso_instant(text: Column) -> Column:
    """ISO-8601 instant text ('...Z' or with offset) -> timestamp."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]X"))
