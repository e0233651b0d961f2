"""Conversion goals: discovery and the goal pivot (long -> one column pair per goal)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType
from pyspark.sql.types import StructField, StructType

from ..functions.naming import goal_columns


def discover_goals(conversions: DataFrame, max_goals: int | None = None) -> list[str]:
    """Distinct non-empty goal values, most frequent first (ties by name).

    The goal list becomes part of the output schema, so it has to reach the
    driver; the partial aggregate keeps the job cheap.  ``max_goals`` raises
    (never truncates) above so many goals; ``None`` takes them all.
    """
    g = F.col("goal")
    found = (conversions.where(g.isNotNull() & (g != ""))
             .groupBy("goal").count()
             .orderBy(F.desc("count"), F.asc("goal")))
    rows = (found if max_goals is None else found.limit(max_goals + 1)).collect()
    if max_goals is not None and len(rows) > max_goals:
        raise ValueError(f"more than {max_goals} distinct goals; pass EngineConfig(goals=...) "
                         "or raise max_goals")
    return [r["goal"] for r in rows]


# Up to so many goals a row of sums (two a goal) is one that generated code handles.
WIDE = 40
# Cells of the wide rows that a task makes at a time (8 MB a million).
CELLS = 2_000_000


def pivot_goals(conversions: DataFrame, keys: list[str], goals, measure: str, value: str,
                existing=(), struct: str | None = None) -> DataFrame:
    """Per ``keys``: for each goal, ``Σ measure`` and ``Σ value`` over its rows.

    ``struct`` names one struct column that holds the goals' columns as its fields; a Python UDF
    that takes it whole runs in the same Arrow batch, without sending thousands of columns.

    A key that has conversion rows but none for a goal reads 0 (``groupBy().pivot()`` gives
    NULL); so do all goals of a key whose rows have a NULL, empty or unlisted goal.

    Few goals are summed side by side: one pass, one exchange of partial sums.  With many
    goals every row would feed two sums for each of them and partial rows would be as wide;
    :func:`sparse_goal_sums` sums what is there instead.  Both give the same rows and types.
    """
    named = goal_columns(goals, existing)
    if len(named) > WIDE:
        return _filled(sparse_goal_sums(conversions, keys, [g for g, _, _ in named], measure, value), keys, named, struct)
    aggs = []
    for goal, name, value_name in named:
        hit = F.col("goal") == F.lit(goal)
        aggs.append(F.coalesce(F.sum(F.when(hit, F.col(measure)).otherwise(F.lit(0))), F.lit(0)).alias(name))
        aggs.append(F.coalesce(F.sum(F.when(hit, F.col(value)).otherwise(F.lit(0))), F.lit(0)).alias(value_name))
    return conversions.groupBy(*keys).agg(*(aggs if struct is None else [F.struct(*aggs).alias(struct)]))


def sparse_goal_sums(conversions: DataFrame, keys: list[str], goals: list[str], measure: str, value: str) -> DataFrame:
    """``keys, sums``: a map from each goal that the key has to its two sums.

    Rows are summed by key and goal first (combined map-side, no wider than the input), so the
    rows of a hot key or goal are added up by all tasks; then each key's sums, at most one
    entry a goal, come together in its map.
    """
    goal = F.when(F.col("goal").isin(*goals), F.col("goal"))
    sums = [F.sum(F.when(F.col("_goal").isNotNull(), F.col(c)).otherwise(F.lit(0))).alias(f"_{n}")
            for n, c in (("measure", measure), ("value", value))]
    by_goal = conversions.withColumn("_goal", goal).groupBy(*keys, "_goal").agg(*sums)
    entry = F.when(F.col("_goal").isNotNull(), F.struct("_goal", F.struct(F.col("_measure").alias("measure"), F.col("_value").alias("value"))))
    return by_goal.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_sums"))


def _filled(sums: DataFrame, keys: list[str], named, struct: str | None) -> DataFrame:
    """Columns from the map; 0 where a key lacks the goal.

    Thousands of expressions looking up the map cost a key milliseconds, so Arrow tasks set the
    map's entries into blocks of zeros (a sum has 8 or 16 bytes, all of them zero for 0).  As
    columns, ``CELLS`` are made at a time; as a struct, those of one Arrow batch.
    """
    fields = ("measure", "value")
    zero = [f"coalesce(_sums[''].{f}, 0) AS {f}" for f in fields]  # types as of sums side by side
    types = {f.name: f.dataType for f in sums.selectExpr(*zero).schema}
    entries = [f"transform(map_values(_sums), x -> cast(coalesce(x.{f}, 0) AS {types[f].simpleString()})) AS _{f}" for f in fields]
    columns = StructType([StructField(name, types[f], False) for _, *pair in named for name, f in zip(pair, fields)])
    goals, names, width = [goal for goal, _, _ in named], columns.names, len(keys)

    # Nested functions travel by value: workers need not have this library.
    def cells(of, *sums_of):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        rows, out = len(of), []
        goal = pc.index_in(of.flatten(), value_set=pa.array(goals, of.type.value_type)).to_numpy()
        row = np.repeat(np.arange(rows), np.diff(of.offsets.to_numpy()))
        for lists in sums_of:
            found = lists.flatten()
            words = found.type.bit_width // 64
            block = np.zeros((len(goals), rows, words), "u8")
            if len(found):
                raw = np.frombuffer(found.buffers()[1], "u8", len(found) * words, found.offset * 8 * words)
                block[goal, row] = raw.reshape(-1, words)
            out.append([pa.Array.from_buffers(found.type, rows, [None, pa.py_buffer(c)]) for c in block])
        return [c for pair in zip(*out) for c in pair]

    sparse = sums.selectExpr(*[f"`{k}`" for k in keys], "map_keys(_sums) AS _goals", *entries)
    if struct is not None:
        def row(of, measures, values):
            import pyarrow as pa
            return pa.StructArray.from_arrays(cells(of, measures, values), names)

        made = F.arrow_udf(row, columns, ArrowUDFType.SCALAR)("_goals", *[f"_{f}" for f in fields])
        return sparse.select(*[F.col(f"`{k}`") for k in keys], made.alias(struct))

    most = max(1, CELLS // len(names))

    def fill(batches):
        import pyarrow as pa
        for whole in batches:
            for b in (whole.slice(k, most) for k in range(0, whole.num_rows, most)):
                yield pa.RecordBatch.from_arrays([*b.columns[:width], *cells(*b.columns[width:])], [*keys, *names])

    return sparse.mapInArrow(fill, StructType([*(sums.schema[k] for k in keys), *columns]))
