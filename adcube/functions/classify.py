"""Campaign classification from the campaign name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Case-insensitive patterns and labels of the classifier, in
# branch order.
SEARCH = "search"
SHOPPING = "shopping"
BRAND = "brand"
NONBRAND = "unbranded|nonbrand"
LABELS = (
    "Campaign Type: Search Branded",
    "Campaign Type: Search Nonbrand",
    "Campaign Type: Search",
    "Campaign Type: Shopping Branded",
    "Campaign Type: Shopping Nonbrand",
    "Campaign Type: Shopping",
)


def _has(name: Column, pattern: str) -> Column:
    # NULL name -> NULL predicate -> falls through to the ELSE branch
    return name.rlike(f"(?i){pattern}")


def campaign_type(name: Column) -> Column:
    """Ordered CASE over the campaign name; no match (or NULL name) gives ''."""
    branded = _has(name, BRAND) & ~_has(name, NONBRAND)
    nonbrand = _has(name, NONBRAND)
    expr = None
    labels = iter(LABELS)
    for channel in (SEARCH, SHOPPING):
        ch = _has(name, channel)
        for cond in (ch & branded, ch & nonbrand, ch):
            label = F.lit(next(labels))
            expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(""))
