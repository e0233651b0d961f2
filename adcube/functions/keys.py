"""Surrogate keys and the impression-weighted share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: str | Column) -> Column:
    """Parts joined by ``_``; NULL if any part is NULL (SQL ``||`` semantics).

    ``concat_ws`` would silently skip NULL parts, so ``concat`` is used with
    explicit string casts (dates render as ``yyyy-MM-dd``).
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        col = F.col(c) if isinstance(c, str) else c
        if i:
            parts.append(F.lit("_"))
        parts.append(col.cast("string"))
    return F.concat(*parts)


def share_numerator(impressions: Column, share: Column) -> Column:
    """Impressions of rows whose share is known (NULL share contributes 0)."""
    return F.when(share.isNotNull(), impressions).otherwise(F.lit(0)).cast("double")


def share_denominator(impressions: Column, share: Column) -> Column:
    """Eligible impressions implied by the share; 0 for NULL or zero share."""
    return F.coalesce(impressions.cast("double") / F.nullif(share.cast("double"), F.lit(0.0)), F.lit(0.0))


def weighted_share(num_sum: Column, den_sum: Column) -> Column:
    """Final ratio of the summed parts; 0 when undefined."""
    return F.coalesce(num_sum / F.nullif(den_sum, F.lit(0.0)), F.lit(0.0))
