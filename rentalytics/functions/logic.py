"""Boolean and label helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col as _c

TRUE_TOKENS = ["t", "true", "1", "1.0"]
FALSE_TOKENS = ["f", "false", "0", "0.0"]


def parse_bool(c) -> Column:
    """``t``/``f``, ``true``/``false`` or 0/1 -> boolean; anything else -> null.

    Decided per value, so the result does not depend on row order.
    """
    x = F.lower(F.trim(_c(c).cast("string")))
    return F.when(x.isin(TRUE_TOKENS), F.lit(True)).when(x.isin(FALSE_TOKENS), F.lit(False))


def bool_label(c, true_label: str, false_label: str) -> Column:
    """class label from a boolean (null stays null)."""
    x = _c(c)
    return F.when(x, F.lit(true_label)).when(~x, F.lit(false_label))


def greater_than_flag(c, threshold: float = 1) -> Column:
    """``count > threshold`` with null read as false."""
    return F.coalesce(_c(c) > threshold, F.lit(False))


def threshold_label(c, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """label by absolute value against ascending cut points.

    ``labels`` has one more entry than ``cuts``: ``|v| < cuts[0]`` gets
    ``labels[0]`` and so on.
    """
    v = F.abs(_c(c))
    expr = None
    for cut, label in zip(cuts, labels):
        expr = F.when(v < cut, F.lit(label)) if expr is None else expr.when(v < cut, F.lit(label))
    return expr.otherwise(F.lit(labels[len(cuts)]))
