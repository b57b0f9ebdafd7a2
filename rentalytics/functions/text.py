"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col as _c

# The text tokens pandas' CSV reader turns into missing values
# by default; raw files written by that reader's users rely on them.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def null_token(c) -> Column:
    """A string column with missing-value tokens turned into null."""
    x = _c(c)
    return F.when(~x.isin(NULL_TOKENS), x)


def normalise_null_tokens(df: DataFrame) -> DataFrame:
    """S02 applied to every string column of a frame (one projection)."""
    return df.select(*[
        null_token(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def parse_currency(c, allow_negative: bool = False) -> Column:
    """delete every character that is not a digit or a dot; '' or unparsable -> null.

    The minus sign is deleted too, so ``-$5`` reads as 5.0 (kept on purpose); with ``allow_negative`` an amount that begins
    with a minus sign or stands in parentheses is negative, so that the rule on negative prices (Q01) can fire.
    """
    text = _c(c).cast("string")
    amount = F.nullif(F.trim(F.regexp_replace(text, r"[^0-9.]", "")), F.lit("")).try_cast("double")
    if not allow_negative:
        return amount
    return F.when(text.rlike(r"^[^0-9.]*[-\u2212]|^\s*\(.*\)\s*$"), -amount).otherwise(amount)


def parse_percent(c) -> Column:
    """``'95%'`` -> 95.0; numbers pass through; blank or junk -> null."""
    stripped = F.trim(F.replace(_c(c).cast("string"), F.lit("%"), F.lit("")))
    return F.nullif(stripped, F.lit("")).try_cast("double")


# Split points between letters and non-letters: each non-letter is its own
# piece, so initcap on the pieces capitalises every letter run.
_TITLE_SPLIT = r"(?<=[^\p{L}])|(?=[^\p{L}])"


def title_case(c) -> Column:
    """trim, then capitalise every run of letters (``D'Água``, ``A-B``, ``3Rd``)."""
    pieces = F.split(F.lower(F.trim(_c(c))), _TITLE_SPLIT, -1)
    return F.array_join(F.transform(pieces, lambda p: F.initcap(p)), "")


def text_length(c) -> Column:
    """length in code points."""
    return F.length(_c(c))


def fill_text(c, value: str) -> Column:
    """constant fill for missing text."""
    return F.coalesce(_c(c), F.lit(value))
