"""Numeric column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col as _c


def round_even(c, digits: int = 0) -> Column:
    """F16: round half-to-even on the double, as ``numpy.round`` does.

    numpy scales by 10**digits, rounds to the nearest integer (ties to even)
    and scales back; ``rint`` is the same operation on the JVM side.
    """
    scale = F.lit(float(10 ** digits))
    return F.rint(_c(c).cast("double") * scale) / scale


def settle(c) -> Column:
    """An aggregate of doubles as a value that does not depend on the order of its sums: noise below 1e-10 is cut.

    Partial sums meet in any order, so a mean that is a rounding tie on paper lies on either side of it by chance.
    Values of one row are never settled.  Infinities, NaN and values beyond DECIMAL(38,10) pass through.
    """
    x = _c(c).cast("double")
    return F.when(F.abs(x) < F.lit(1e27), x.cast("decimal(38,10)").cast("double")).otherwise(x)


def round_aggregate(c, digits: int = 0) -> Column:
    """F16 on an aggregate: half-to-even after ``settle``."""
    return round_even(settle(c), digits)


def round_half_up(c, digits: int = 0) -> Column:
    """round half away from zero on the decimal value (SQL ``ROUND(x::numeric, k)``)."""
    return F.round(_c(c).cast("decimal(38,10)"), digits).cast("double")


def safe_ratio(numerator, denominator) -> Column:
    """``numerator / denominator`` only where the denominator is > 0, else null."""
    d = _c(denominator)
    return F.when(d > 0, _c(numerator) / d)


def pct_deviation(value, benchmark) -> Column:
    """percentage deviation from a benchmark; zero benchmark gives null."""
    b = _c(benchmark)
    return F.try_divide(_c(value) - b, b) * F.lit(100.0)


def product(a, b) -> Column:
    """plain product (revenue = price x booked days)."""
    return _c(a) * _c(b)


def row_mean(cols: Sequence) -> Column:
    """mean across columns of one row, ignoring nulls; null when all are null."""
    arr = F.filter(F.array(*[_c(x).cast("double") for x in cols]), lambda v: v.isNotNull())
    total = F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(arr) > 0, total / F.size(arr))


def log1p(c) -> Column:
    """F22."""
    return F.log1p(_c(c))


def human_money(c, symbol: str = "$") -> Column:
    """``1.2K`` / ``3.4M`` style label with a currency symbol."""
    v = _c(c).cast("double")
    return (F.when(v >= 1_000_000, F.format_string(symbol + "%.1fM", v / 1_000_000))
            .when(v >= 1_000, F.format_string(symbol + "%.1fK", v / 1_000))
            .otherwise(F.concat(F.lit(symbol), F.format_number(v, 0))))


# Fixed values of the integer mix below (a 32-bit xorshift-multiply hash).
MIX_MULTIPLIER = 0x45D9F3B
_U32 = 1 << 32


def mix32(c, seed: int = 0) -> Column:
    """Seeded 32-bit integer hash, a bijection on [0, 2^32).

    Only +, *, xor, shift and modulo on BIGINT with every intermediate below
    2^63, so it never overflows under ANSI mode and any SQL engine computes
    the same value (the oracle re-states it in SQL).
    """
    x = F.pmod(_c(c).cast("long") + F.lit(seed), F.lit(_U32))
    for _ in range(2):
        x = F.pmod(F.shiftright(x, 16).bitwiseXOR(x) * F.lit(MIX_MULTIPLIER), F.lit(_U32))
    return F.shiftright(x, 16).bitwiseXOR(x)
