"""Null profiles, imputation, rule checks and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duolog.operators.ranges import same
from duolog.sources.scratch import materialize


#: A column is dense if its span has at most eight numbers for each of its values, or at most so many in all.
BITS = 32_768


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: column, n, nulls, n_distinct, min, max (as text), pct_null. Plain counts take one scan without a
    shuffle of rows. Distinct integers and dates that lie close enough are counted exactly as bits of words of 64 numbers, so what a task keeps and sends depends on the
    span and not on values, and is hashed, not sorted; others from (column, value) pairs, combined before the shuffle."""
    aggregates = [F.count("*").alias("_n")]
    for c in columns:
        aggregates += [F.count(c).alias(f"_u_{c}"), F.min(c).cast("string").alias(f"_l_{c}"), F.max(c).cast("string").alias(f"_h_{c}")]
    kinds = dict(df.dtypes)
    number = {c: F.unix_date(c) if kinds[c] == "date" else F.col(c).cast("bigint") for c in columns if kinds[c] in ("tinyint", "smallint", "int", "bigint", "date")}
    for c, value in number.items():
        aggregates += [F.min(value).alias(f"_a_{c}"), F.max(value).alias(f"_b_{c}")]
    one = materialize(df.agg(*aggregates))
    plain_row = one.first()
    dense = [c for c in number if plain_row[f"_u_{c}"] and (plain_row[f"_b_{c}"] - plain_row[f"_a_{c}"]) // BITS <= max(1, plain_row[f"_u_{c}"] // BITS * 8)]
    sparse = [c for c in columns if c not in dense]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col("_n").alias("n"), (F.col("_n") - F.col(f"_u_{c}")).alias("nulls"), F.col(f"_l_{c}").alias("min"), F.col(f"_h_{c}").alias("max")) for c in columns])
    plain = one.select(F.explode(rows).alias("_r")).select("_r.*")
    distinct = df.sparkSession.createDataFrame([], "column string, _d bigint")
    if dense:
        shift = {c: number[c] - F.lit(plain_row[f"_a_{c}"]) for c in dense}
        words = F.array(*[F.struct(F.lit(k).alias("_c"), F.shiftright(shift[c], 6).alias("_w"), shift[c].alias("_v")) for k, c in enumerate(dense)])
        words = df.select(F.explode(words).alias("_p")).select("_p.*").where("_v is not null")
        words = words.groupBy("_c", "_w").agg(F.bit_or(F.expr("shiftleft(1L, cast(_v & 63 as int))")).alias("_b"))
        named = F.element_at(F.array(*map(F.lit, dense)), F.col("_c") + 1).alias("column")
        distinct = distinct.unionByName(words.groupBy(named).agg(F.sum(F.bit_count("_b")).cast("bigint").alias("_d")))
    for kind in sorted({kinds[c] for c in sparse}):
        some = [c for c in sparse if kinds[c] == kind]
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), (F.col(c) if kind in ("float", "double", "bigint", "int") else F.col(c).cast("string")).alias("value")) for c in some])).alias("_p")).select("_p.*")
        distinct = distinct.unionByName(pairs.where("value is not null").distinct().groupBy("column").agg(F.count("*").alias("_d")))
    joined = plain.join(F.broadcast(distinct), "column", "left")
    return joined.select("column", "n", "nulls", F.coalesce("_d", F.lit(0)).alias("n_distinct"), "min", "max", (F.col("nulls") * F.lit(100.0) / F.nullif("n", F.lit(0))).alias("pct_null"))


def profile_tables(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """`null_profile` of several tables in one report: table_name, column_name, n_rows, n_null, pct_null (three digits), n_distinct,
    v_min, v_max; by table, worst columns first."""
    union = None
    for name, (df, columns) in tables.items():
        one = null_profile(df, columns).select(
            F.lit(name).alias("table_name"), F.col("column").alias("column_name"), F.col("n").alias("n_rows"), F.col("nulls").alias("n_null"), F.round("pct_null", 3).alias("pct_null"),
            "n_distinct", F.col("min").alias("v_min"), F.col("max").alias("v_max"),
        )
        union = one if union is None else union.unionByName(one)
    return union.orderBy("table_name", F.desc("pct_null"), "column_name")


def missing_by_group(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def missing_hotspots(df: DataFrame, keys: Sequence[str], columns: Sequence[str], least: float = 20.0) -> DataFrame:
    """Clusters and metrics with at least `least` percent missing, worst and largest first."""
    counts = missing_by_group(df, keys, columns)
    long = counts.select(*keys, "n", *[F.col(f"null_{c}").alias(c) for c in columns]).unpivot([*keys, "n"], list(columns), "metric", "nulls")
    return long.withColumn("pct", F.col("nulls") * F.lit(100.0) / F.col("n")).where(F.col("pct") >= least).orderBy(F.desc("pct"), F.desc("n"), *keys, "metric")


#: Rows of a group up to which its values may meet in one task, and distinct values of a bracket that a window ranks.
SMALL = 10_000
#: Accuracy of the rank sketches, and how far beside a rank a bracket begins and ends: twice the sketches' error.
ACCURACY = 1000
MARGIN = 2 / ACCURACY
#: Parts into which a bracket of many values is cut.
PARTS = 64
#: Groups of which a table is broadcast.
FEW = 10_000


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact continuous quantiles: per group of keys (one row without keys) an array a column, null without values. Null keys are a group.
    df is read three times, so it should be stored.

    Groups of at most SMALL rows are dealt by group and aggregated as they are. Values of larger ones never meet in one task. Integer columns that span at most SMALL
    numbers are counted by value, see `_counted`. For others, mergeable rank sketches of each
    group and column give a bracket around each rank, values below it are only counted, and only those within it, about 4 in 1,000 wherever
    they lie, are counted one by one, narrowed further while they are many, and ranked."""
    keys, kinds = list(keys), dict(df.dtypes)
    whole = [c for c in columns if kinds[c] in ("tinyint", "smallint", "int", "bigint")]
    values = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    if not keys:
        return _ranked(values, columns, whole, shares, keys)
    large = materialize(values.groupBy(*keys).count().where(F.col("count") > SMALL).drop("count"))
    n = large.limit(FEW + 1).count()
    plain = lambda rows: rows.repartition(*keys).groupBy(*keys).agg(*[F.percentile(c, F.array(*map(F.lit, shares))).alias(c) for c in columns])
    if not n:
        return plain(values)
    named = large.toDF(*[f"_l{k}" for k in range(len(keys))])
    match = same(values, named, dict(zip(keys, named.columns)))
    named = F.broadcast(named) if n <= FEW else named
    some = _ranked(values.join(named, match, "left_semi"), columns, whole, shares, keys)
    return plain(values.join(named, match, "left_anti")).unionByName(some)


def _ranked(values: DataFrame, columns: Sequence[str], whole: Sequence[str], shares: Sequence[float], keys: list[str]) -> DataFrame:
    """`quantiles` of large groups: columns of `whole` numbers of a small span by `_counted`, the others by `_selected`."""
    span = values.agg(*[(F.max(c) - F.min(c)).alias(c) for c in whole]).first() if whole else {}
    narrow = [c for c in whole if (span[c] or 0) <= SMALL]
    wide = [c for c in columns if c not in narrow]
    if not narrow:
        return _selected(values, columns, shares, keys)
    counted = _counted(values, narrow, shares, keys)
    if not keys:
        return (counted.crossJoin(_selected(values.select(*wide), wide, shares, keys)) if wide else counted).select(*columns)
    other = _selected(values.select(*keys, *wide), wide, shares, keys) if wide else values.select(*keys).distinct()
    return _joined(other, counted, keys, "left").select(*keys, *columns)


def _counted(values: DataFrame, columns: Sequence[str], shares: Sequence[float], keys: list[str]) -> DataFrame:
    """`quantiles` of whole numbers of a small span: tasks count values before the shuffle, so a group and column has no more rows than its span has numbers, and a window ranks them."""
    cell = [*keys, "_c"]
    counts = values.unpivot(keys, list(columns), "_c", "_v").where("_v is not null").groupBy(*cell, "_v").agg(F.count("*").alias("_k"))
    all_of = Window.partitionBy(*cell).orderBy("_v")
    ahead = F.coalesce(F.sum("_k").over(all_of.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = counts.select(*cell, "_v", "_k", ahead.alias("_from"), F.sum("_k").over(all_of.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"))
    place = [(F.col("_n") - 1) * F.lit(float(q)) for q in shares]
    at = lambda rank: F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_k")), F.col("_v")))
    ends = [x for n, h in enumerate(place) for x in (at(F.floor(h)).alias(f"_a{n}"), at(F.ceil(h)).alias(f"_b{n}"))]
    found = rows.groupBy(*cell).agg(F.first("_n").alias("_n"), *ends)
    value = F.array(*[F.col(f"_a{n}") + (F.col(f"_b{n}") - F.col(f"_a{n}")) * (h - F.floor(h)) for n, h in enumerate(place)])
    return found.withColumn("_y", value).groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == c, F.col("_y"))).alias(c) for c in columns])


def _selected(values: DataFrame, columns: Sequence[str], shares: Sequence[float], keys: list[str]) -> DataFrame:
    """`quantiles` of large groups by rank selection, all groups, columns and shares at once. values has keys and columns only."""
    long = values.unpivot(keys, list(columns), "_c", "_v").where("_v is not null")
    cell = [*keys, "_c"]
    edges = [p for q in shares for p in (max(0.0, q - MARGIN), min(1.0, q + MARGIN))]
    sketch = long.groupBy(*cell).agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.percentile_approx("_v", edges, ACCURACY).alias("_p"))
    # groups with too few values for the sketch's error to cover a rank's neighbours are their own bracket
    whole = F.col("_n") < 4 / MARGIN
    side = lambda name, k: F.when(whole, F.col(name)).otherwise(F.get("_p", F.lit(k)))
    brackets = materialize(sketch.select(*cell, "_n", F.array(*[F.struct(F.lit(i).alias("i"), side("_low", 2 * i).alias("a"), side("_high", 2 * i + 1).alias("b")) for i in range(len(shares))]).alias("_e")))
    near = brackets.drop("_n")
    near = F.broadcast(near) if brackets.limit(FEW + 1).count() <= FEW else near
    place = F.transform("_e", lambda e: F.when(F.col("_v") <= e["b"], F.struct(e["i"].alias("_i"), F.when(F.col("_v") >= e["a"], F.col("_v")).alias("_v"))))
    met = _joined(long, near, cell).select(*cell, F.explode(F.filter(place, lambda x: x.isNotNull())).alias("_x"))
    cell = [*cell, "_i"]
    held = materialize(met.select(*cell[:-1], "_x.*").groupBy(*cell, "_v").agg(F.count("*").alias("_k")))  # a null value stands for all below the bracket

    share = F.element_at(F.array(*map(F.lit, shares)), F.col("_i") + 1)
    ranks = brackets.select(*cell[:-1], "_n", F.explode(F.sequence(F.lit(0), F.lit(len(shares) - 1))).alias("_i")).withColumn("_h", (F.col("_n") - 1) * share)
    ranks = _joined(ranks, held.where("_v is null").select(*cell, F.col("_k").alias("_at")), cell, "left").withColumn("_at", F.coalesce("_at", F.lit(0)))
    ranks = ranks.withColumn("_r", F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h"))))).drop("_n")
    held = held.where("_v is not null")
    size = held.groupBy(*cell).count().agg(F.max("count")).first()[0] or 0
    rows, cell_of = _joined(held, ranks, cell), [*cell, "_r"]
    while size > SMALL:
        rows = materialize(_narrowed(rows, cell_of))
        size = rows.groupBy(*cell_of).count().agg(F.max("count")).first()[0] or 0
    ahead = F.coalesce(F.sum("_k").over(Window.partitionBy(*cell_of).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = rows.withColumn("_from", F.col("_at") + ahead).where("_r >= _from and _r < _from + _k")
    low = F.min_by("_v", "_r")
    value = found.groupBy(*cell, "_h").agg((low + (F.max_by("_v", "_r") - low) * (F.col("_h") - F.floor("_h"))).alias("_y"))
    arrays = [F.sort_array(F.collect_list(F.when(F.col("_c") == c, F.struct("_i", "_y")))) for c in columns]
    out = value.groupBy(*keys).agg(*[F.when(F.size(a) > 0, F.transform(a, lambda x: x["_y"])).alias(c) for a, c in zip(arrays, columns)])
    return _joined(values.select(*keys).distinct(), out, keys, "left") if keys else out


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, null matching null."""
    other = right.withColumnsRenamed({c: f"_j{n}" for n, c in enumerate(on)})
    return left.join(other, same(left, other, {c: f"_j{n}" for n, c in enumerate(on)}), how).drop(*[f"_j{n}" for n in range(len(on))])


def _narrowed(held: DataFrame, cells: Sequence[str]) -> DataFrame:
    """held (cells, _at, _h, _v, _k) with the values of the one part of PARTS, cut at ranks of distinct values, in which a cell's rank _r lies."""
    cuts = held.groupBy(*cells).agg(F.percentile_approx("_v", [k / PARTS for k in range(1, PARTS)], 4 * PARTS).alias("_cuts"))
    parted = _joined(held, cuts, cells).withColumn("_part", F.size(F.filter("_cuts", lambda x: x < F.col("_v")))).drop("_cuts")
    parts = parted.groupBy(*cells, "_at", "_part").agg(F.sum("_k").alias("_w"))
    ahead = F.coalesce(F.sum("_w").over(Window.partitionBy(*cells).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    right = parts.withColumn("_to", F.col("_at") + ahead).where("_r >= _to and _r < _to + _w").select(*cells, "_part", "_to")
    return _joined(parted, right, [*cells, "_part"]).withColumn("_at", F.col("_to")).drop("_part", "_to")


def medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str], prefix: str) -> DataFrame:
    """Exact medians per key; without keys one row, see `quantiles`."""
    return quantiles(df, columns, [0.5], keys).select(*keys, *[F.get(c, F.lit(0)).alias(f"{prefix}{c}") for c in columns])


def impute_medians(df: DataFrame, columns: Sequence[str], levels: Sequence[Sequence[str]]) -> DataFrame:
    """Nulls become the median of the first level that has one, with `was_imputed_<column>`; levels go from narrow to wide, [] being all."""
    out = df
    for number, keys in enumerate(levels):
        level = medians(df, keys, columns, f"_m{number}_")
        out = out.join(level, list(keys), "left") if keys else out.crossJoin(F.broadcast(level))
    filled = {c: F.coalesce(F.col(c).cast("double"), *[F.col(f"_m{n}_{c}") for n in range(len(levels))]) for c in columns}
    flags = {f"was_imputed_{c}": F.col(c).isNull() for c in columns}
    return out.withColumns(flags).withColumns(filled).drop(*[f"_m{n}_{c}" for n in range(len(levels)) for c in columns])


@dataclass(frozen=True)
class Rule:
    """A rule that rows must keep: it counts only where none of its columns is null."""

    columns: tuple[str, ...]
    predicate: str

    @property
    def sql(self) -> str:
        return " or ".join([*(f"{c} is null" for c in self.columns), self.predicate])


# The physical rules of a box.
RULES = (
    Rule(("fgm", "fga"), "fgm <= fga"),
    Rule(("tpm", "tpa"), "tpm <= tpa"),
    Rule(("fgm", "tpm"), "fgm >= tpm"),
    Rule(("fga", "fta"), "fga >= 0 and fta >= 0"),
    Rule(("pts",), "pts >= 0"),
    Rule(("oreb", "dreb"), "oreb >= 0 and dreb >= 0"),
)


def constraint_guard(facts: DataFrame, strict: bool = True, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows that keep all rules. strict=False joins the rules by "and" without brackets, as they once were: "and" binds tighter than
    "or", so nearly every row passes."""
    return facts.where(" and ".join(f"({r.sql})" if strict else r.sql for r in rules))


def points_identity(facts: DataFrame) -> DataFrame:
    """facts with points from made shots and whether they agree; null where a part is missing."""
    made = 2 * (F.col("fgm") - F.col("tpm")) + 3 * F.col("tpm") + F.col("ftm")
    return facts.withColumn("pts_formula", made).withColumn("pts_ok", F.col("pts") == F.col("pts_formula"))


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and distinct keys."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct(*keys)).alias("n_keys"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df, or an error that names the keys if any repeats."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"repeated keys in {', '.join(keys)}")
    return df


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, completeness (share of rows with a value)."""
    one = df.agg(*[(F.lit(1.0) - F.avg(F.col(c).isNull().cast("int"))).alias(c) for c in columns])
    return one.unpivot([], list(columns), "feature", "completeness")


def feature_asserts(features: DataFrame, since: str) -> DataFrame:
    recent = features.where(F.col("game_date") >= F.lit(since).cast("date"))
    return recent.agg(F.count_if(F.col("y_win").isNull()).alias("null_labels"), F.count_if(F.col("pts_l5_opp").isNull() & F.col("y_win").isNotNull()).alias("missing_opp_features"))


def side_imbalance(games: DataFrame, sides: DataFrame, cutoff: str) -> DataFrame:
    """Games (game_id, game_date) without exactly one home and one away row; failure from the cutoff on, else a warning."""
    counts = sides.groupBy("game_id").agg(F.count_if(F.col("side") == "home").alias("home_ct"), F.count_if(F.col("side") == "away").alias("away_ct"))
    joined = games.join(counts, "game_id", "left").na.fill(0, ["home_ct", "away_ct"])
    level = F.when(F.col("game_date") >= F.lit(cutoff).cast("date"), "failure").otherwise("warning")
    return joined.withColumn("null_ct", 2 - F.col("home_ct") - F.col("away_ct")).withColumn("level", level).where("home_ct <> 1 or away_ct <> 1")


def newest(df: DataFrame, n: int, date: str, ties: Sequence[str]) -> DataFrame:
    """The n newest rows; a top-k without a full sort."""
    return df.orderBy(F.col(date).desc_nulls_last(), *ties).limit(n)


def minutes_gate(minutes: DataFrame, targets: DataFrame, cutoff: str, newest_rows: int = 20_000, most: float = 1.0) -> DataFrame:
    """The newest rows of minutes (game_id, team_id, minutes_raw) with their game's target (game_id, game_date, target_minutes) and
    min_bad: both are known and differ by more than `most`. level: failure from the cutoff on, else legacy; null for good rows."""
    rows = minutes.join(targets, "game_id").withColumn("min_bad", F.coalesce(F.abs(F.col("minutes_raw") - F.col("target_minutes")) > most, F.lit(False)))
    level = F.when(F.col("min_bad"), F.when(F.col("game_date") >= F.lit(cutoff).cast("date"), "failure").otherwise("legacy"))
    return newest(rows, newest_rows, "game_date", ["game_id", "team_id"]).withColumn("level", level)


def require_none(df: DataFrame, what: str) -> DataFrame:
    """One row with bad_rows, or an error where there are any."""
    bad = df.agg(F.count("*").alias("bad_rows"))
    if found := bad.first().bad_rows:
        raise ValueError(f"{found} rows: {what}")
    return bad


def label_counts(df: DataFrame, label: str, missing: str = "MISSING") -> DataFrame:
    return df.groupBy(F.coalesce(F.nullif(F.trim(label), F.lit("")), F.lit(missing)).alias(label)).agg(F.count("*").alias("n"))
