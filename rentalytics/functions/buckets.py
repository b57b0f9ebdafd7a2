"""Bucketing helpers (F24, F25) and the geo distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col as _c


def bucket_right(c, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """right-closed buckets ``(e[i], e[i+1]]``; at or below ``e[0]`` or above ``e[-1]`` -> null.

    Returns the label, or the 0-based bucket index when ``labels`` is None.
    Unlike ``Bucketizer`` (left-closed) this matches ``pandas.cut(right=True)``.
    """
    if labels is not None and len(labels) != len(edges) - 1:
        raise ValueError("need len(edges) - 1 labels")
    v = _c(c)
    expr = None
    for i in range(len(edges) - 1):
        out = F.lit(labels[i]) if labels is not None else F.lit(i)
        cond = (v > F.lit(edges[i])) & (v <= F.lit(edges[i + 1]))
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr


def price_tier(c, p25, p75, labels: Sequence[str] = ("Budget", "Mid-range", "Premium")) -> Column:
    """<= p25 first label, <= p75 second, else third; null price stays null."""
    v = _c(c)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(v <= _c(p25), F.lit(labels[0]))
            .when(v <= _c(p75), F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = 6371.0) -> Column:
    """great-circle distance in km."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(radius_km) * 2 * F.asin(F.sqrt(a))


def ordinal(c, order: Sequence[str]) -> Column:
    """Position of a category in a custom order (unknown -> null)."""
    m = F.create_map(*[x for i, name in enumerate(order) for x in (F.lit(name), F.lit(i))])
    return m[_c(c)]
