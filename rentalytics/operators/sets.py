"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_union(frames: Sequence[DataFrame], col: str, out: str | None = None) -> DataFrame:
    """Union of one column from several frames -> distinct values (sort at the reader)."""
    out = out or col
    parts = [f.select(F.col(col).alias(out)) for f in frames]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.where(F.col(out).isNotNull()).distinct()


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def concat_labelled(frames: Mapping[str, DataFrame], label_col: str = "group") -> DataFrame:
    """Tag each frame with its label, then concatenate."""
    return concat_frames([f.withColumn(label_col, F.lit(k)) for k, f in frames.items()])
