"""Left joins to dimensions and small keyed tables, without hints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import GRANULARITIES

# Rows with a NULL key are dealt to so many hash values.
NULL_SPREAD = 4096


def left_join(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """``rows ⟕ other USING keys``; rows with a NULL key keep their place but spread out.

    A NULL key matches nothing, yet a shuffle join hashes all of them to one
    task.  A second key, equal on both sides for real keys and a hash of the
    whole row for NULL ones, deals them out.  No hint: planner and AQE broadcast
    ``other`` by its size in bytes, and split skewed keys otherwise.
    """
    def any_null(df):
        return reduce(lambda a, b: a | b, [df[k].isNull() for k in keys])

    spread = F.when(any_null(rows), F.pmod(F.xxhash64(*[rows[c] for c in rows.columns]), F.lit(NULL_SPREAD).cast("long")) + 1)
    left = rows.withColumn("_spread", spread.otherwise(F.lit(0).cast("long")))
    # 0 for every row, but not a constant that the optimizer would fold out of the join key
    right = other.withColumn("_spread", F.pmod(F.xxhash64(*[other[k] for k in keys]), F.lit(1).cast("long")))
    return left.join(right, [*keys, "_spread"], "left").drop("_spread")


def dimension_chain(levels: list[tuple[DataFrame, str]]) -> DataFrame:
    """Left-join dimensions outward: ``levels[0] ⟕ levels[1] USING key1 ⟕ ...``.

    ``levels`` is ``[(dim0, None), (dim1, key1), ...]`` where ``key_i`` is the
    column of ``dim_i`` referenced by the previous level.  No hint: the outer
    levels (ad groups, campaigns, accounts) are small, and the planner
    broadcasts them from their scan-size estimate
    (``spark.sql.autoBroadcastJoinThreshold``), re-checked at run time by AQE;
    a large level stays a sort-merge join.
    """
    out = levels[0][0]
    for dim, key in levels[1:]:
        out = out.join(dim, key, "left")
    return out


def enrich(fact: DataFrame, hierarchy: DataFrame, key: str) -> DataFrame:
    """``fact ⟕ hierarchy USING key``.

    Equivalent to joining each level to the fact in turn (left joins on keys
    of the previous level associate), but the fact is joined only once.
    """
    return left_join(fact, hierarchy, [key])


def by_entity(rows: DataFrame, key: str) -> DataFrame:
    """Rows with a non-NULL ``key``, all of one key value in one partition.

    Aggregates and joins whose keys include ``key`` then work where the rows lie: the
    five report rows that come of one are neither sent nor sorted across tasks.  There
    are as many more partitions for that.
    """
    parts = len(GRANULARITIES) * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.where(F.col(key).isNotNull()).repartition(parts, key)


def unmatched(rows: DataFrame, hierarchy: DataFrame, key: str) -> DataFrame:
    """``rows ⟕ hierarchy`` for rows whose ``key`` is NULL: they match nothing."""
    null = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    return rows.select(null(rows, key), *[c for c in rows.columns if c != key], *[null(hierarchy, c) for c in hierarchy.columns if c != key])
