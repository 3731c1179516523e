"""Drift monitoring: baseline, monthly means, mean shift, population stability, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duolog.operators.quality import quantiles
from duolog.sources.scratch import materialize
from duolog.streaming import incremental

METRICS = ("pts", "fga", "tpm", "fta", "reb", "tov", "pf")
DECILES = tuple(k / 10 for k in range(1, 10))


def baseline_rows(facts: DataFrame, label: str = "REG", seasons: int = 2) -> DataFrame:
    """Rows of the label's last seasons, by a semi-join with the few season numbers."""
    regular = facts.where(F.col("season_type") == label)
    last = regular.agg(F.max("season").alias("_last")).select(F.explode(F.sequence(F.col("_last") - (seasons - 1), F.col("_last"))).alias("season"))
    return regular.join(F.broadcast(last), "season", "left_semi")


def decile_cuts(facts: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row of arrays of nine continuous quantiles."""
    return quantiles(materialize(baseline_rows(facts).select(*metrics)), metrics, DECILES).toDF(*[f"q_{m}" for m in metrics])


def decile_bin(value: Column, cuts: Column) -> Column:
    """1 to 10: one more than the cuts below the value; null for null."""
    return F.when(value.isNotNull(), F.size(F.filter(cuts, lambda q: q < value)) + 1)


FORM = ("pts_l5", "tpm_l10", "reb_l10")
KEYS = ("ym", "season", "team_id")


def month_state(facts: DataFrame, schedule: DataFrame | None, cuts: DataFrame | None, metrics: Sequence[str] = METRICS, form: Sequence[str] = FORM) -> DataFrame:
    """What drift reports need, one row per month, season and team: of its regular games their number, and for each metric its count, sum and squared sum
    (in double precision) and the numbers of its values in bins 1 to 10, with nulls first (`b_<metric>`); of all its games count and sum of each form.

    States of disjoint rows add up, see `merged_state`. Facts and schedule are tagged and united, so that a null month or team is one row, as in
    a join of rows. Rows are dealt by cell before they are binned and counted: a row has a tenth of a state's numbers, and a cell has few rows. cuts is the one row of
    `decile_cuts`; a state counts in the bins of its cuts, so new cuts need a new state. Without cuts it has no bins, which no report reads by team
    (see `bin_state`): with few games in a cell they are larger than the games. Without a schedule it has no form, but a cell for every fact."""
    month = F.trunc("game_date", "month").alias("ym")
    regular = F.col("season_type") == "REG"
    a = facts.select(month, "season", "team_id", *[F.when(regular, c).alias(n) for n, c in (("_g", F.lit(1)), *((m, F.col(m)) for m in metrics))])
    if schedule is None:
        form, rows = (), a
    else:
        rows = a.where("_g = 1").unionByName(schedule.select(month, "season", "team_id", *form), allowMissingColumns=True)
    rows, bins = rows.repartition(*KEYS), {}
    if cuts is not None:
        rows = rows.crossJoin(F.broadcast(cuts))
        bins = {f"_b_{m}": F.when(F.col("_g").isNotNull(), F.coalesce(decile_bin(F.col(m), F.col(f"q_{m}")), F.lit(0))) for m in metrics}
    rows = rows.withColumns(bins | {c: F.col(c).cast("double") for c in [*metrics, *form]}).select(*KEYS, "_g", *metrics, *form, *bins)
    amounts = [F.count("_g").alias("n_games")]
    for m in metrics:
        amounts += [F.count(m).alias(f"n_{m}"), F.sum(m).alias(f"s_{m}"), F.sum(F.col(m) * F.col(m)).alias(f"ss_{m}")]
        amounts += [F.array(*[F.count_if(F.col(f"_b_{m}") == k) for k in range(11)]).alias(f"b_{m}")] if bins else []
    for f in form:
        amounts += [F.count(f).alias(f"n_{f}"), F.sum(f).alias(f"s_{f}")]
    return rows.groupBy(*KEYS).agg(*amounts)


def bin_state(facts: DataFrame, cuts: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """The bins of `month_state` per month and season: number of regular games and, for each metric, of its values in bins 1 to 10, with nulls first.
    Its size is that of the calendar, however many teams play."""
    rows = facts.where("season_type = 'REG'").select(F.trunc("game_date", "month").alias("ym"), "season", *metrics).crossJoin(F.broadcast(cuts))
    rows = rows.select("ym", "season", *[F.coalesce(decile_bin(F.col(m), F.col(f"q_{m}")), F.lit(0)).alias(f"_b_{m}") for m in metrics])
    counts = [F.array(*[F.count_if(F.col(f"_b_{m}") == k) for k in range(11)]).alias(f"b_{m}") for m in metrics]
    return rows.groupBy("ym", "season").agg(F.count("*").alias("n_games"), *counts)


def league_state(state: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """A `month_state` added up per month and season, with the number and sum of its teams' means (`t_<metric>`, `m_<metric>`)."""
    mean = lambda m: F.col(f"s_{m}") / F.nullif(F.col(f"n_{m}"), F.lit(0))
    sums = [F.sum(f"{k}_{m}").alias(f"{k}_{m}") for m in metrics for k in ("n", "s", "ss")]
    return state.groupBy("ym", "season").agg(F.sum("n_games").alias("n_games"), *sums, *[f(mean(m)).alias(f"{k}_{m}") for m in metrics for k, f in (("t", F.count), ("m", F.sum))])


def league_means(league: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """`monthly_league` of the metrics, from a `league_state`."""
    return league.groupBy("ym").agg(*[(F.sum(f"m_{m}") / F.nullif(F.sum(f"t_{m}"), F.lit(0))).alias(f"mean_{m}") for m in metrics])


def merged_state(*states: DataFrame) -> DataFrame:
    """The state of all rows of states."""
    rows = states[0]
    for other in states[1:]:
        rows = rows.unionByName(other)
    keys = [c for c in KEYS if c in rows.columns]
    bins = [c for c in rows.columns if c.startswith("b_")]
    plain = [c for c in rows.columns if c not in keys and c not in bins]
    sums = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in plain], *[F.array(*[F.sum(F.get(c, F.lit(k))) for k in range(11)]).alias(c) for c in bins])
    return sums.select(*rows.columns)


def add_months(spark: SparkSession, folder: str, new: DataFrame) -> list[int]:
    """Add a state of new rows to the published one: cells that both have add up, others are added. Only buckets that hold
    a cell of new are read and written; returns them. new must count in the same bins."""
    new = materialize(new)
    cells = new.select(*[c for c in KEYS if c in new.columns]).distinct()
    met = incremental.current_of(spark, folder, cells)
    return incremental.upsert_published(spark, folder, merged_state(new, met))


def _last_seasons(state: DataFrame, seasons: int) -> DataFrame:
    """Cells of regular games in the last seasons that have any."""
    regular = state.where("n_games > 0")
    last = regular.agg(F.max("season").alias("_last"))
    return regular.crossJoin(F.broadcast(last)).where(F.col("season").between(F.col("_last") - (seasons - 1), F.col("_last")))


def baseline(state: DataFrame, metrics: Sequence[str] = METRICS, seasons: int = 2) -> DataFrame:
    """One row of means and deviations of the regular games of the last seasons."""
    one = _last_seasons(state, seasons).agg(*[F.sum(f"{k}_{m}").alias(f"{k}_{m}") for m in metrics for k in ("n", "s", "ss")])
    mean = lambda m: F.col(f"s_{m}") / F.nullif(F.col(f"n_{m}"), F.lit(0))
    spread = lambda m: F.sqrt(F.greatest(F.lit(0.0), F.col(f"ss_{m}") - F.col(f"s_{m}") * mean(m)) / F.nullif(F.col(f"n_{m}") - 1, F.lit(0)))
    return one.select(*[c for m in metrics for c in (mean(m).alias(f"mean_{m}"), spread(m).alias(f"sd_{m}"))])


def monthly(state: DataFrame, metrics: Sequence[str] = METRICS, form: Sequence[str] = FORM) -> DataFrame:
    """Means per month, season and team: metrics of regular games, form of all."""
    return state.select(*KEYS, *[(F.col(f"s_{c}") / F.nullif(F.col(f"n_{c}"), F.lit(0))).alias(f"mean_{c}") for c in [*metrics, *form]])


def monthly_league(by_team: DataFrame) -> DataFrame:
    """Mean of the teams' means per month."""
    means = [c for c in by_team.columns if c.startswith("mean_")]
    return by_team.groupBy("ym").agg(*[F.avg(c).alias(c) for c in means])


def mean_shift(league: DataFrame, base: DataFrame, metrics: Sequence[str] = METRICS, sigmas: float = 3.0) -> DataFrame:
    """z of each month's mean against the baseline's one row, and flags (null where there is no z)."""
    other = F.broadcast(base.toDF(*[f"b_{c}" for c in base.columns]))
    z = {m: (F.col(f"mean_{m}") - F.col(f"b_mean_{m}")) / F.nullif(F.col(f"b_sd_{m}"), F.lit(0.0)) for m in metrics}
    rows = league.crossJoin(other).select("ym", *[c.alias(f"z_{m}") for m, c in z.items()])
    return rows.withColumns({f"flag_{m}": F.abs(f"z_{m}") >= sigmas for m in metrics})


def _bin_counts(state: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """keys, metric, bin (null for null values), n: bins that have values."""
    sums = state.groupBy(*keys).agg(*[F.array(*[F.sum(F.get(f"b_{m}", F.lit(k))) for k in range(11)]).alias(m) for m in metrics])
    rows = sums.unpivot(list(keys), list(metrics), "metric", "counts")
    rows = rows.select(*keys, "metric", F.posexplode("counts").alias("bin", "n")).where("n > 0")
    return rows.withColumn("bin", F.nullif("bin", F.lit(0)))


def psi_baseline(state: DataFrame, metrics: Sequence[str] = METRICS, seasons: int = 2) -> DataFrame:
    """metric, bin, p: share of each bin in the baseline. Null values count in the total only."""
    counts = _bin_counts(_last_seasons(state, seasons), [], metrics)
    totals = counts.groupBy("metric").agg(F.sum("n").alias("_n"))
    return counts.join(F.broadcast(totals), "metric").select("metric", "bin", (F.col("n").cast("double") / F.col("_n")).alias("p"))


def psi_monthly(state: DataFrame, shares: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """ym, metric, psi: sum of (p - q) * ln(p / q) over bins that both have; regular games."""
    counts = _bin_counts(state.where("n_games > 0"), ["ym"], metrics)
    totals = counts.groupBy("ym", "metric").agg(F.sum("n").alias("_n"))
    q = counts.join(totals, ["ym", "metric"]).select("ym", "metric", "bin", (F.col("n").cast("double") / F.col("_n")).alias("q"))
    joined = q.join(F.broadcast(shares), ["metric", "bin"])
    term = (F.col("p") - F.col("q")) * F.ln(F.nullif("p", F.lit(0.0)) / F.nullif("q", F.lit(0.0)))
    return joined.groupBy("ym", "metric").agg(F.sum(term).alias("psi"))


def alerts(shift: DataFrame, psi: DataFrame, metrics: Sequence[str] = METRICS, major: float = 0.25) -> DataFrame:
    """Per month: any flag (three-valued), and 1 per metric whose index is above `major`, 0 also for months without one."""
    flag = None
    for m in metrics:
        flag = F.col(f"flag_{m}") if flag is None else flag | F.col(f"flag_{m}")
    high = psi.groupBy("ym").agg(*[F.max(F.when((F.col("metric") == m) & (F.col("psi") > major), 1).otherwise(0)).alias(f"psi_{m}_major") for m in metrics])
    joined = shift.select("ym", flag.alias("any_3sigma")).join(high, "ym", "left")
    return joined.na.fill(0, [f"psi_{m}_major" for m in metrics])
