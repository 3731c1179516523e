"""Row numbers, running sums and history windows of groups that no task holds whole."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from duolog.sources.scratch import fresh, materialize

#: Rows of a group that one window holds at most, besides those it looks back at.
BLOCK = 50_000


def same(left: DataFrame, right: DataFrame, columns: Mapping[str, str]) -> Column:
    """Null-safe equality of columns of left and right."""
    match = F.lit(True)
    for a, b in columns.items():
        match = match & left[a].eqNullSafe(right[b])
    return match


def by_size(df: DataFrame, by: Sequence[str], sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """df as rows of groups of at most BLOCK rows, which one window may hold, and rows of larger groups (None without any). Groups are counted in sizes,
    a frame with the same rows as far as their keys go, or in df; either should be stored. Null keys are one group."""
    counts = (df if sizes is None else sizes).groupBy(*by).count().where(F.col("count") > BLOCK).drop("count")
    if counts.isEmpty():
        return df, None
    large = materialize(counts)
    large = large.toDF(*fresh(df, *[f"_l{k}" for k in range(len(by))]))
    match = same(df, large, dict(zip(by, large.columns)))
    return df.join(large, match, "left_anti"), df.join(large, match, "left_semi")


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], numbers: Mapping[str, Sequence[str]], sums: Mapping[str, tuple[Sequence[str], str]] | None = None) -> DataFrame:
    """df with row numbers from 1 (name -> group columns) and sums of what comes before a row (name -> group columns, value), all in
    the order given, nulls first. Every group's columns include `by`.

    Rows are dealt by sorted ranges of `by` and `order` and stored, so a group of any size is spread over as many tasks as its share of
    the rows asks for, if `order` tells its rows apart. Each range numbers its own rows; what a group has in earlier ranges
    comes from one row per group and range. Null group values are one group. An empty df gives no rows."""
    sums = sums or {}
    part, total, value = fresh(df.withColumns({n: F.lit(0) for n in [*numbers, *sums]}), "_part", "_total", "_value")
    stored = materialize(df.repartitionByRange(*by, *order).withColumn(part, F.spark_partition_id()))
    out = stored
    for name, keys, what in [*((n, k, None) for n, k in numbers.items()), *((n, k, v) for n, (k, v) in sums.items())]:
        keys = list(keys)
        local = Window.partitionBy(part, *keys).orderBy(*order)
        here = F.row_number().over(local).cast("bigint") if what is None else F.coalesce(F.sum(what).over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        measure = F.count("*") if what is None else F.sum(what)
        totals = stored.groupBy(part, *keys).agg(measure.alias(value))
        earlier = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        totals = totals.withColumn(total, F.sum(value).over(earlier.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))).where(F.col(total).isNotNull())
        held = out.withColumn(name, here)
        names = dict(zip([part, *keys], fresh(held, *[f"_r{n}" for n in range(len(keys) + 1)])))
        right = totals.select(*[F.col(c).alias(r) for c, r in names.items()], total)
        whole = (F.col(name) + F.coalesce(F.col(total), F.lit(0))).alias(name)
        out = held.join(right, same(held, right, names), "left").select(*[c for c in held.columns if c != name], whole)
    return out.drop(part)


def with_history(df: DataFrame, keys: Sequence[str], number: str, back: int, columns: Callable[[WindowSpec], Mapping[str, Column]], block: int = 0) -> DataFrame:
    """df with columns over windows of a group's rows in the order of `number` (from 1 without gaps), which look at most `back` rows back.

    A window holds `block` rows (BLOCK unless given) of a group; the last `back` rows of a block are sent to the next one as well, where they
    are only looked at."""
    block = block or BLOCK
    if back >= block:
        raise ValueError("a block must hold more rows than windows look back")
    own, at = fresh(df, "_own", "_at")
    place = F.floor((F.col(number) - 1) / block)
    late = (F.col(number) - 1) % block >= block - back
    rows = df.withColumn(own, place).withColumn(at, F.explode(F.when(late, F.array(place, place + 1)).otherwise(F.array(place))))
    window = Window.partitionBy(*keys, at).orderBy(number)
    return rows.withColumns(dict(columns(window))).where(F.col(own) == F.col(at)).drop(own, at)
