"""Two-sided rows to one row per side and back, and wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDES = ("home", "away")


def unpivot_sides(wide: DataFrame, keys: Sequence[str], stats: Sequence[str], sides: Sequence[str] = SIDES) -> DataFrame:
    """One row per side from columns `<stat>_<side>`, in one scan; missing columns are null. Adds `side`."""
    have = set(wide.columns)
    kinds = {s: next((wide.schema[f"{s}_{x}"].dataType for x in sides if f"{s}_{x}" in have), None) for s in stats}
    pick = lambda s, x: (F.col(f"{s}_{x}") if f"{s}_{x}" in have else F.lit(None)).cast(kinds[s] or "string").alias(s)
    rows = F.array(*[F.struct(F.lit(x).alias("side"), *[pick(s, x) for s in stats]) for x in sides])
    return wide.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def pivot_sides(long: DataFrame, keys: Sequence[str], stats: Sequence[str], side: str = "side", sides: Sequence[str] = SIDES) -> DataFrame:
    """One row per key with columns `<stat>_<side>`."""
    picked = [F.max(F.when(F.col(side) == x, F.col(s))).alias(f"{s}_{x}") for x in sides for s in stats]
    return long.groupBy(*keys).agg(*picked)


def metrics_long(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, str] | Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    """One row per key and metric."""
    return df.unpivot(list(keys), list(metrics), name, value)


def null_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For every pair of columns, rows where both are null, with the share in percent: pair, c1, c2, n, pct; one pass."""
    pairs = list(combinations(columns, 2))
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(a).isNull() & F.col(b).isNull()).alias(f"{a}~{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(f"{a}~{b}").alias("pair"), F.lit(a).alias("c1"), F.lit(b).alias("c2"), F.col(f"{a}~{b}").alias("n")) for a, b in pairs])
    return counts.select("_n", F.explode(rows).alias("_r")).select("_r.*", (F.col("_r.n") * F.lit(100.0) / F.nullif("_n", F.lit(0))).alias("pct")).where("n > 0")
