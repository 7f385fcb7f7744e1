"""Dense surrogate keys and key uniqueness, both distributed."""

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom import scratch

# monotonically_increasing_id keeps the row's position in its partition in the low 33 bits.
_POSITION_BITS = 33


def with_surrogate_key(
    df: DataFrame,
    order: Sequence[Column],
    out: str,
    drop: Sequence[str] = (),
    named: Sequence[str] | None = None,
) -> DataFrame:
    """Number the rows 1..n in the given order, as a global ``row_number`` would.

    A window without partition keys would sort everything in one task. Here the rows are range
    partitioned and sorted in parallel, written once with their partition and position, and each
    partition's offset is added when they are read back. The written table fixes the layout: the
    range bounds are sampled, so a second evaluation could cut elsewhere.

    ``order`` must make rows unique, or leave ties only between rows whose order is of no interest.
    Columns in ``drop`` serve the ordering only and are left out of the result. ``named`` are SQL
    expressions of the result's columns, in place of those of ``df``; they are computed once the rows
    are sorted, so what is sampled and shuffled is their input.
    """
    slot = F.col("_slot")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.drop(*drop) if named is None else placed.selectExpr(*named)
    placed = placed.withColumn("_slot", F.monotonically_increasing_id())
    written = scratch.materialize(placed, out)
    part = F.shiftright(slot, _POSITION_BITS)
    position = slot.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    # One row per range partition, however many rows there are. The starts become one array
    # literal, so the result stays a plain projection of the written table and keeps its size
    # estimate for later joins.
    sizes = dict(written.groupBy(part).agg(F.max(position) + 1).collect())
    last = max(sizes, default=-1)
    starts = list(accumulate((sizes.get(p, 0) for p in range(last + 1)), initial=0))
    start = F.get(
        F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), part.cast("int")
    )
    kept = [F.col(f"`{c}`") for c in placed.columns if c != "_slot"]
    return written.select((start + position + 1).alias(out), *kept)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def _runs(df: DataFrame, key: str) -> DataFrame:
    """Bounds and sizes of the runs of a whole-number column: ``(run, low, high, n)``.

    A row's number less its place in the scan is the same along a run of consecutive numbers. Rows of
    one scan have different places, so numbers of one run are different too.
    """
    number = F.col(key).cast("bigint")
    placed = df.select(number.alias("k"), F.try_subtract(number, F.monotonically_increasing_id()).alias("run"))
    return placed.groupBy("run").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("n"))


def _told_by_runs(runs: list) -> int | None:
    """Rows without a number if no two runs overlap, so that no number repeats; else None."""
    if any(r["run"] is None and r["low"] is not None for r in runs):
        return None
    bounds = sorted((r["low"], r["high"]) for r in runs if r["run"] is not None)
    if any(low <= high for (_, high), (low, _) in zip(bounds, bounds[1:])):
        return None
    return sum(r["n"] for r in runs if r["run"] is None)


def key_report(
    checks: Sequence[tuple[str, DataFrame, Sequence[str]]], most_runs: int = 100_000
) -> DataFrame:
    """One row per (table, key): repeated keys, the rows that hold them, rows with a null key.

    A key with a null in it matches nothing in an equality join, so it is not counted as repeated.

    Tables stored in the order of a numbered key need no shuffle of it: all of them are scanned in
    one job for the bounds of their runs of numbers, and if these lie apart nothing repeats. Other
    keys, numbers whose runs overlap, and all of them if there are more than ``most_runs`` runs, are
    counted by grouping.
    """
    numbers = [
        (i, df, keys[0])
        for i, (_, df, keys) in enumerate(checks)
        if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, (T.IntegerType, T.LongType))
    ]
    proven = {}
    if numbers:
        runs = [_runs(df, key).withColumn("check", F.lit(i)) for i, df, key in numbers]
        found = reduce(DataFrame.unionByName, runs).limit(most_runs + 1).collect()
        if len(found) <= most_runs:
            proven = {i: _told_by_runs([r for r in found if r["check"] == i]) for i, _, _ in numbers}

    parts, told = [], []
    for i, (table, df, keys) in enumerate(checks):
        if proven.get(i) is not None:
            told.append((table, ", ".join(keys), 0, 0, proven[i]))
            continue
        complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        groups = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
        parts.append(
            groups.selectExpr(
                f"'{table}' AS table_name",
                f"'{', '.join(keys)}' AS key_columns",
                f"count_if(row_count > 1 AND {complete}) AS duplicate_keys",
                f"coalesce(sum(row_count) FILTER (WHERE row_count > 1 AND {complete}), 0)"
                " AS duplicate_rows",
                f"coalesce(sum(row_count) FILTER (WHERE NOT ({complete})), 0) AS null_rows",
            )
        )
    if told:
        spark = checks[0][1].sparkSession
        schema = "table_name string, key_columns string, duplicate_keys bigint, duplicate_rows bigint, null_rows bigint"
        parts.append(spark.createDataFrame(told, schema))
    return reduce(DataFrame.unionByName, parts)
