"""History-safe features, ratings, standard scores and composite indices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duolog.operators.facts import opponent_values, win_label
from duolog.operators.ranges import by_size, numbered, with_history

BOX = ("pts", "fga", "fta", "tpm", "tov", "oreb", "dreb", "pf")


def ratio(a: Column, b: Column) -> Column:
    """a / b in double precision; null where b is 0 or null."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def schedule_features(facts: DataFrame) -> DataFrame:
    """Game number, rest, back-to-backs and form before each game. Game numbers and rest restart every season, form does not.
    Ties on a date go by game_id. No rest (a first game) falls into the longest bucket. facts is read twice, so it should be stored. Teams of at most
    `ranges.BLOCK` games are dealt once and windowed as they are; those of more are numbered in sorted ranges and looked back on in blocks, see `ranges`."""
    order = ["game_date", "game_id"]
    days = lambda w: {f"_d{k}": F.lag("game_date", k).over(w) for k in (1, 2, 3)}
    form = lambda w: {
        "pts_l5": F.avg("pts").over(w.rowsBetween(-5, -1)), "tov_l5": F.avg("tov").over(w.rowsBetween(-5, -1)),
        "tpm_l10": F.avg("tpm").over(w.rowsBetween(-10, -1)), "reb_l10": F.avg(F.col("oreb") + F.col("dreb")).over(w.rowsBetween(-10, -1)),
    }
    some, large = by_size(facts, ["team_id"])
    career, year = (Window.partitionBy(*keys).orderBy(*order) for keys in (["team_id"], ["team_id", "season"]))
    rows = some.withColumns(form(career)).withColumns({"gnum": F.row_number().over(year), **days(year)})
    if large is not None:
        held = numbered(large, ["team_id"], order, {"_c": ["team_id"], "gnum": ["team_id", "season"]}).withColumn("gnum", F.col("gnum").cast("int"))
        held = with_history(with_history(held, ["team_id", "season"], "gnum", 3, days), ["team_id"], "_c", 10, form)
        rows = rows.unionByName(held.drop("_c"))
    rest = F.datediff("game_date", "_d1")
    rows = rows.withColumns({"prev_date": F.col("_d1"), "days_rest": rest})
    bucket = (
        F.when(F.col("days_rest") == 0, "0D").when(F.col("days_rest") == 1, "B2B").when(F.col("days_rest").between(2, 3), "2-3D")
        .when(F.col("days_rest").between(4, 6), "4-6D").otherwise("7D+")
    )
    near = lambda n, k, days: (F.col("days_rest") <= 2) & (F.col("gnum") >= n) & (F.datediff("game_date", f"_d{k}") <= days)
    return rows.withColumns(
        {
            "rest_bucket": bucket, "is_0in2": F.col("days_rest") == 0, "is_b2b": F.col("days_rest") == 1, "is_3in4": near(3, 2, 4), "is_4in6": near(4, 3, 6),
        }
    ).drop("_d1", "_d2", "_d3")


def opponent_box(facts: DataFrame) -> DataFrame:
    """facts with the opponent's box and the win label."""
    return opponent_values(facts, BOX).withColumn("y_win", win_label(F.col("pts"), F.col("pts_opp")))


def derived_ratings(box: DataFrame) -> DataFrame:
    """Possessions and zero-guarded ratings of both sides."""
    c = F.col
    possessions = lambda s: (c("fga" + s) + F.lit(0.44) * c("fta" + s) - c("oreb" + s) + c("tov" + s)).cast("double")
    rows = box.withColumns({"poss_team": possessions(""), "poss_opp": possessions("_opp")}).withColumn("poss_game", (c("poss_team") + c("poss_opp")) / 2)
    shooting = lambda s: F.when(F.nullif(c("fga" + s), F.lit(0)).isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio(c("pts" + s) - F.lit(0.44) * c("fta" + s) + F.lit(0.5) * c("tpm" + s), c("fga" + s)))))
    return rows.withColumns(
        {
            "reb": c("oreb") + c("dreb"), "reb_opp": c("oreb_opp") + c("dreb_opp"), "efg": shooting(""), "efg_opp": shooting("_opp"),
            "tov_pct": ratio(c("tov"), c("poss_team")), "opp_tov_pct": ratio(c("tov_opp"), c("poss_opp")),
            "orb_pct": ratio(c("oreb"), c("oreb") + c("dreb_opp")), "opp_orb_pct": ratio(c("oreb_opp"), c("oreb_opp") + c("dreb")),
            "ftr": ratio(c("fta"), c("fga")), "opp_ftr": ratio(c("fta_opp"), c("fga_opp")),
            "ortg": ratio(F.lit(100.0) * c("pts"), c("poss_team")), "drtg_opp": ratio(F.lit(100.0) * c("pts_opp"), c("poss_opp")),
        }
    )


def rolling_form(rated: DataFrame, rows: int = 10, sizes: DataFrame | None = None) -> DataFrame:
    """Means of the last games before each one within team, season and type, and the opponent's defence in its own sequence. Sequences of at most
    `ranges.BLOCK` games are dealt once and windowed as they are; longer ones are numbered in sorted ranges and looked back on in blocks, see
    `ranges`. sizes: the stored facts that rated was made of, row by row, to count sequences in; otherwise rated is read for that."""
    source = {"win_pct": "y_win", "ortg": "ortg", "drtg": "drtg_opp", "pace": "poss_game", "efg": "efg", "tov_pct": "tov_pct", "orb_pct": "orb_pct", "ftr": "ftr"}
    out = rated
    for team, means in (("team_id", source), ("opp_team_id", {"opp_drtg": "drtg_opp"})):
        keys, order = [team, "season", "season_type"], ["game_date", "game_id"]
        before = lambda w: {f"{name}_l{rows}": F.avg(c).over(w.rowsBetween(-rows, -1)) for name, c in means.items()}  # noqa: B023, E731
        some, large = by_size(out, keys, rated if sizes is None else sizes)
        out = some.withColumns(before(Window.partitionBy(*keys).orderBy(*order)))
        if large is not None:
            held = numbered(large, keys, order, {"_n": keys})
            out = out.unionByName(with_history(held, keys, "_n", rows, before).drop("_n"))
    return out


def calendar_features(formed: DataFrame, schedule: DataFrame) -> DataFrame:
    """Form joined with schedule features, day of week (Sunday 0) and month; streak lengths are placeholders."""
    some = schedule.select("game_id", "team_id", "days_rest", "rest_bucket", "is_b2b", "is_3in4", "is_4in6", "gnum", "prev_date")
    joined = formed.join(some, ["game_id", "team_id"]).withColumn("pace", F.col("poss_game"))
    none = F.lit(None).cast("int")
    return joined.withColumns({"road_trip_len": none, "home_stand_len": none, "dow": F.dayofweek("game_date") - 1, "month": F.month("game_date")})


def league_context(calendar: DataFrame) -> DataFrame:
    """Rows with their rating, pace and shooting less the league's mean of the month (columns `*_z` are centred, not scaled);
    `drtg` is the defence's form."""
    keys = ["season", "season_type", "ym"]
    rows = calendar.withColumn("ym", F.trunc("game_date", "month"))
    means = rows.groupBy(*keys).agg(F.avg("ortg").alias("_o"), F.avg("pace").alias("_p"), F.avg("efg").alias("_e"))
    joined = rows.join(means, keys, "left")
    return joined.withColumns({"drtg": F.col("drtg_l10"), "ortg_z": F.col("ortg") - F.col("_o"), "pace_z": F.col("pace") - F.col("_p"), "efg_z": F.col("efg") - F.col("_e")}).drop("_o", "_p", "_e")


def recent_features(facts: DataFrame, schedule: DataFrame) -> DataFrame:
    """Own and opponent's recent form with the win label."""
    form = ["pts_l5", "tpm_l10", "reb_l10"]
    some = schedule.select("game_id", "team_id", "days_rest", "rest_bucket", "is_b2b", "is_3in4", "is_4in6", *form)
    rows = opponent_values(facts.withColumn("reb", F.col("oreb") + F.col("dreb")), ["pts"]).join(some, ["game_id", "team_id"], "left")
    other = schedule.select("game_id", F.col("team_id").alias("opp_team_id"), *[F.col(c).alias(c + "_opp") for c in form])
    return rows.join(other, ["game_id", "opp_team_id"], "left").withColumn("y_win", win_label(F.col("pts"), F.col("pts_opp"))).drop("pts_opp")


def standard_scores(df: DataFrame, group: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """df with z-scores (new name -> column) within groups; null where the deviation is 0 or null. Means are joined back, so a
    group is never gathered."""
    stats = df.groupBy(*group).agg(*[f(c).alias(f"_{k}_{c}") for c in columns.values() for k, f in (("m", F.avg), ("s", F.stddev_samp))])
    joined = df.join(stats, list(group), "left")
    scores = {z: (F.col(c) - F.col(f"_m_{c}")) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0)) for z, c in columns.items()}
    return joined.withColumns(scores).drop(*[f"_{k}_{c}" for c in columns.values() for k in "ms"])


def weighted(weights: Mapping[str, float], by: float = 1.0, fill: bool = False) -> Column:
    """Weighted sum divided by `by`; null if a part is null, unless parts are filled with 0."""
    part = lambda c: F.coalesce(c, F.lit(0.0)) if fill else F.col(c)
    total = None
    for c, w in weights.items():
        term = part(c) * F.lit(float(w))
        total = term if total is None else total + term
    return total / F.lit(float(by))


OFFENCE = ("odarko", "o_lebron", "o_drip", "o_bpm", "o_la3rapm")
DEFENCE = ("ddarko", "d_lebron", "d_drip", "d_bpm", "d_la3rapm")


def external_scores(metrics: DataFrame) -> DataFrame:
    """z-scores per season of ten external metrics."""
    z = standard_scores(metrics, ["season"], {f"z_{c}": c for c in OFFENCE + DEFENCE})
    return z.select("season", "player_id", *[f"z_{c}" for c in OFFENCE + DEFENCE])


def external_composites(scores: DataFrame) -> DataFrame:
    """Weighted offence and defence composites."""
    o = weighted(dict(zip([f"z_{c}" for c in OFFENCE], (2, 1, 1, 1, 1))), 6.0)
    d = weighted(dict(zip([f"z_{c}" for c in DEFENCE], (2, 1, 1, 0.5, 2))), 6.5)
    return scores.select("season", "player_id", o.alias("crafted_opm_z"), d.alias("crafted_dpm_z"))


def per_48(c: Column, minutes: Column) -> Column:
    return ratio(F.lit(100.0) * c, minutes) * F.lit(48.0)


def season_totals(games: DataFrame, by: Sequence[str] = ("season", "player_id", "team_id")) -> DataFrame:
    """Totals per season and player (and team), with per-minute rates."""
    plain = ["pts", "fga", "fgm", "fg3a", "fg3m", "fta", "ftm", "tov", "ast"]
    total = games.groupBy(*by).agg(F.sum("minutes").alias("mp"), *[F.sum(c).alias(c) for c in plain], F.sum(F.col("oreb") + F.col("dreb")).alias("trb"))
    return total.withColumns({f"{c}_per100_minutes": per_48(F.col(c), F.col("mp")) for c in ("fg3a", "fga", "fta")})


def league_efficiency(facts: DataFrame) -> DataFrame:
    """Effective field goals of the league per season: a ratio of sums."""
    return facts.groupBy("season").agg(ratio(F.sum("fgm") + F.lit(0.5) * F.sum("tpm"), F.sum("fga")).alias("league_efg_mean"))


def shooting_profile(totals: DataFrame, league: DataFrame) -> DataFrame:
    """Proficiency (volume through a sigmoid, times accuracy) and spacing relative to the league."""
    c = F.col
    pct3 = F.coalesce(ratio(c("fg3m"), c("fg3a")), F.when(c("fg3a") == 0, F.lit(0.0)))
    volume = F.lit(2.0) / (F.lit(1.0) + F.exp(-c("fg3a_per100_minutes"))) - F.lit(1.0)
    rows = totals.join(league, "season", "left")
    return rows.select("season", "player_id", (volume * pct3).alias("shooting_proficiency"), (c("fg3a") * (pct3 * F.lit(1.5)) - c("league_efg_mean")).alias("spacing"))


def rate_stats(totals: DataFrame) -> DataFrame:
    c = F.col
    return totals.select(
        "season", "player_id", "mp", ratio(c("fgm") + F.lit(0.5) * c("fg3m"), c("fga")).alias("efg_pct"), ratio(c("pts"), F.lit(2.0) * (c("fga") + F.lit(0.44) * c("fta"))).alias("ts_pct"),
        ratio(c("fg3a"), c("fga")).alias("three_par"), ratio(c("fta"), c("fga")).alias("ftr"), *[per_48(c(s), c("mp")).alias(f"{s}_per100_min") for s in ("trb", "ast", "tov")],
    )


def load_index(totals: DataFrame, shooting: DataFrame) -> DataFrame:
    """Creation and offensive load."""
    c = F.col
    rows = totals.join(shooting.select("season", "player_id", F.coalesce("shooting_proficiency", F.lit(0.0)).alias("_sp")), ["season", "player_id"], "left")
    used, skill = c("pts") + c("tov"), F.coalesce("_sp", F.lit(0.0))
    creation = c("ast") * F.lit(0.1843) + used * F.lit(0.0969) - F.lit(2.3021) * skill + F.lit(0.0582) * (c("ast") * used * skill) - F.lit(1.1942)
    rows = rows.withColumn("box_creation", creation)
    load = (c("ast") - F.lit(0.38) * c("box_creation")) * F.lit(0.75) + c("fga") + F.lit(0.44) * c("fta") + c("box_creation") + c("tov")
    return rows.select("season", "player_id", "box_creation", load.alias("offensive_load"))


def passer_index(load: DataFrame, totals: DataFrame, bio: DataFrame) -> DataFrame:
    """Sum of weighted season z-scores of load shares and height; a missing score counts as 0."""
    rows = load.join(totals.select("season", "player_id", "ast", "tov"), ["season", "player_id"], "left").join(bio, "player_id", "left")
    share = {"_a": "ast", "_t": "tov", "_b": "box_creation"}
    rows = rows.withColumns({k: ratio(F.col(c), F.col("offensive_load")) for k, c in share.items()})
    z = standard_scores(rows, ["season"], {"z_l": "offensive_load", "z_a": "_a", "z_t": "_t", "z_b": "_b", "z_h": "height_inches"})
    return z.select("season", "player_id", weighted({"z_l": 1, "z_a": 3, "z_t": -2, "z_b": 0.5, "z_h": 0.2}, fill=True).alias("passer_rating_raw"))


def portability_index(rates, shooting, composites, passer, load, versatility) -> DataFrame:
    """Shooting plus weighted season z-scores of six inputs; null if any is null."""
    on = ["season", "player_id"]
    rows = rates.select(*on, "ts_pct").join(shooting.select(*on, "shooting_proficiency"), on, "left").join(composites.select(*on, "crafted_dpm_z"), on, "left")
    rows = rows.join(passer, on, "left").join(load, on, "left").join(versatility, on, "left")
    parts = {"shooting_proficiency": 2.5, "crafted_dpm_z": 0.5, "versatility": 1.0 / 3.0, "passer_rating_raw": 1.5, "offensive_load": -0.25, "box_creation": -0.15}
    z = standard_scores(rows, ["season"], {f"z_{c}": c for c in parts})
    return z.select(*on, (F.col("ts_pct") + weighted({f"z_{c}": w for c, w in parts.items()})).alias("portability_raw"))


def _equal(keys: Sequence[str], other: Mapping[str, str]) -> Column:
    """Equality of each key with the column that other names; null equals nothing."""
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(other[k]))
    return match


def full_union(frames: Sequence[DataFrame], keys: Sequence[str], as_written: bool = False) -> DataFrame:
    """Full outer join of all frames, each with one row per key. By default on coalesced keys, one row per key: all frames are tagged and united, and one
    grouping by the keys takes each frame's columns, so the rows are shuffled once, whatever the number of frames. Rows with a null key match none.
    as_written matches every frame with the first one's keys only, so keys that the first lacks come once per frame: the first's rows are joined with each frame, and
    each frame's rows that the first lacks are added, rather than carried through the joins under null keys, which all meet in one task."""
    first, *rest = frames
    if not as_written:
        rows, lone = None, None
        for k in keys:
            lone = F.col(k).isNull() if lone is None else lone | F.col(k).isNull()
        for number, df in enumerate(frames):
            tagged = df.withColumn("_frame", F.when(lone, F.lit(number)).otherwise(F.lit(-1)))
            rows = tagged if rows is None else rows.unionByName(tagged, allowMissingColumns=True)
        columns = [c for c in rows.columns if c not in (*keys, "_frame")]
        return rows.groupBy(*keys, "_frame").agg(*[F.any_value(c, True).alias(c) for c in columns]).drop("_frame")
    out = first
    for n, df in enumerate(rest, 1):
        own = df.withColumnsRenamed({k: f"_k{n}_{k}" for k in keys})
        out = out.join(own, _equal(keys, {k: f"_k{n}_{k}" for k in keys}), "left").drop(*[f"_k{n}_{k}" for k in keys])
    known = first.select(*[F.col(k).alias(f"_k0_{k}") for k in keys])
    for df in rest:
        out = out.unionByName(df.join(known, _equal(keys, {k: f"_k0_{k}" for k in keys}), "left_anti"), allowMissingColumns=True)
    return out
