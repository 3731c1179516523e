"""Facts: opponents, survivors, collapsed rows, overtimes, coverage, the side-normalised fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duolog.functions.clean import blank_to_null, canonical_label, clock_minutes, known_prefix, padded_id, season, tolerant
from duolog.operators.dims import first_per_key
from duolog.operators.reshape import unpivot_sides


def with_opponent(stats: DataFrame, sides: DataFrame) -> DataFrame:
    """stats (game_id, team_id, ...) with is_home and opp_team_id from sides (game_id, home_id, away_id, ...); rows of no side go."""
    return opponents(stats.join(sides, "game_id"))


def opponents(boxes: DataFrame) -> DataFrame:
    """boxes (team_id, home_id, away_id, ...) with is_home and opp_team_id; rows of no side go."""
    home = F.col("team_id") == F.col("home_id")
    return boxes.where("team_id = home_id or team_id = away_id").withColumn("is_home", home).withColumn("opp_team_id", F.when(home, F.col("away_id")).otherwise(F.col("home_id"))).drop("home_id", "away_id")


def opponent_values(facts: DataFrame, columns: Sequence[str], suffix: str = "_opp") -> DataFrame:
    """facts with the opponent's columns, by the swapped key."""
    other = facts.select("game_id", F.col("team_id").alias("opp_team_id"), *[F.col(c).alias(c + suffix) for c in columns])
    return facts.join(other, ["game_id", "opp_team_id"], "left")


def result_of(points: Column, other: Column, fallback: Column | None = None) -> Column:
    """W, L, or null on a tie; the fallback where a score is missing."""
    known = points.isNotNull() & other.isNotNull()
    decided = F.when(known & (points > other), "W").when(known & (points < other), "L")
    return decided if fallback is None else F.when(known, decided).otherwise(fallback)


def win_label(points: Column, other: Column) -> Column:
    """1 won, 0 not won, null where a score is missing."""
    return F.when(points.isNotNull() & other.isNotNull(), (points > other).cast("int"))


def collapse(rows: DataFrame, keys: Sequence[str], largest: Sequence[str], summed: Sequence[str]) -> DataFrame:
    """Repeated keys become one row: maxima of `largest`, sums of `summed`."""
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in largest], *[F.sum(c).alias(c) for c in summed])


def player_games(rows: DataFrame, games: DataFrame, stats: Sequence[str]) -> DataFrame:
    """rows (game_id, player_id, team_id, minutes_raw, stats) with minutes parsed, repeats collapsed, and the game's columns joined. Rows are dealt by
    game once, for both."""
    timed = rows.where("game_id is not null and player_id is not null and team_id is not null").select("game_id", "player_id", "team_id", clock_minutes(F.col("minutes_raw")).alias("minutes"), *stats)
    return collapse(timed.repartition("game_id"), ["game_id", "player_id", "team_id"], ["minutes"], stats).join(games, "game_id", "left")


def overtime_targets(games: DataFrame, line: DataFrame, periods: int = 10) -> DataFrame:
    """games with ot_periods (overtimes in which either side of line has a score) and the minutes that a team should have played."""
    played = sum((F.col(f"pts_ot{k}_home").isNotNull() | F.col(f"pts_ot{k}_away").isNotNull()).cast("int") for k in range(1, periods + 1))
    joined = games.join(line.select("game_id", played.alias("_ot")), "game_id", "left")
    ot = F.coalesce("_ot", F.lit(0))
    return joined.withColumns({"ot_periods": ot, "ot_minutes": ot * 25, "target_minutes": ot * 25 + 240}).drop("_ot")


def flag_known(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """df with a boolean: whether the row's key occurs in other; an own value of that name wins."""
    hit = other.select(*keys).distinct().withColumn("_hit", F.lit(True))
    found = F.coalesce("_hit", F.lit(False))
    joined = df.join(hit, list(keys), "left")
    return joined.withColumn(name, F.coalesce(F.col(name), found) if name in df.columns else found).drop("_hit")


def line_scores(wide: DataFrame, quarters: int = 4, overtimes: int = 10) -> DataFrame:
    """One row per side of a wide line score, with blanks removed and periods as integers."""
    periods = [f"pts_qtr{k}" for k in range(1, quarters + 1)] + [f"pts_ot{k}" for k in range(1, overtimes + 1)] + ["pts"]
    text = ["team_id", "team_abbreviation"]
    long = unpivot_sides(wide, ["game_id", "game_date"], text + periods)
    return long.select(
        padded_id(F.col("game_id")).alias("game_id"), tolerant(F.col("game_date"), "date").alias("game_date"), "side",
        *[blank_to_null(F.col(c)).alias(c) for c in text], *[tolerant(F.col(c), "int").alias(c) for c in periods],
    )


def side_fact(wide: DataFrame, line: DataFrame, events: DataFrame, overrides: DataFrame, teams: DataFrame) -> DataFrame:
    """One checked row per (game_id, team_id) from raw wide games.

    wide holds text columns `<stat>_home/_away`; line (game_id, team_id, bx_side, bx_pts) scores by side; events (game_id) games with
    events; overrides as in `apply_side_overrides`; teams (team_id) known teams. Sides come from line, else from "vs."
    or "@" in the matchup, then from overrides. Points come from line, else from made shots. Shares are clamped to [0, 1]; minutes
    outside 200-330 are dropped and flagged; points that differ by more than 2 are flagged. The result is by comparison
    with the opponent, else the raw letter. Columns that wide lacks are null. Of repeated rows that with a result, letter, matchup and the latest date stays.
    """
    whole = ["pts", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf", "plus_minus"]
    shares, names = ["fg_pct", "fg3_pct", "ft_pct"], ["team_abbreviation", "team_name", "matchup", "wl"]
    long = unpivot_sides(wide, ["game_id", "season_id", "season_type", "game_date", "min"], ["team_id", "video_available", *names, *whole, *shares])
    raw = blank_to_null(F.col("season_type"))
    rows = long.select(
        padded_id(F.col("game_id")).alias("game_id"), blank_to_null(F.col("team_id")).alias("team_id"), "season_id", raw.alias("season_type_raw"),
        canonical_label(raw).alias("season_type"), tolerant(F.col("game_date"), "date").alias("game_date"), tolerant(F.col("min"), "double").alias("minutes_raw"),
        tolerant(F.col("video_available"), "boolean").alias("video_available"), *[blank_to_null(F.col(c)).alias(c) for c in names],
        *[tolerant(F.col(c), "double").alias(c) for c in whole], *[tolerant(F.col(c), "double").alias(f"{c}_raw") for c in shares],
    )
    rows = rows.withColumns({"game_id_prefix": F.substring("game_id", 1, 3), "prefix_known": known_prefix(F.col("game_id"))})
    rows = rows.join(line, ["game_id", "team_id"], "left")
    rows = flag_known(rows, events.select(padded_id(F.col("game_id")).alias("game_id")), ["game_id"], "has_events")
    guess = (
        F.when(F.col("bx_side") == "home", True).when(F.col("bx_side") == "away", False)
        .when(F.instr(F.lower(F.coalesce("matchup", F.lit(""))), "vs.") > 0, True).when(F.instr("matchup", "@") > 0, False)
    )
    fixed = overrides.select(F.col("game_id").alias("_g"), F.col("home_id").alias("_h"), F.col("away_id").alias("_a"), "home_override", "away_override")
    team = F.col("team_id").try_cast("bigint")
    rows = rows.join(fixed, F.col("game_id").try_cast("bigint") == F.col("_g"), "left")
    forced = F.when(F.col("home_override") & (team == F.col("_h")), True).when(F.col("away_override") & (team == F.col("_a")), False)
    rows = rows.withColumn("is_home", F.coalesce(forced, guess)).drop("_g", "_h", "_a", "home_override", "away_override")
    share = lambda made, tried: F.when(F.col(tried) > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(made) / F.col(tried))))
    none = lambda c: F.coalesce(c, F.lit(0.0))
    made = (none("fgm") - none("fg3m")) * 2 + none("fg3m") * 3 + none("ftm")
    rows = rows.withColumns(
        {
            "fg_pct": share("fgm", "fga"), "fg3_pct": share("fg3m", "fg3a"), "ft_pct": share("ftm", "fta"), "pts_calc": made, "pts_final": F.coalesce("bx_pts", made, "pts"),
            "has_pts_from_bx": F.col("bx_pts").isNotNull(),
            "min_final": F.when(F.col("minutes_raw").between(200, 330), F.col("minutes_raw")),
            "min_bad": F.coalesce((F.col("minutes_raw") < 200) | (F.col("minutes_raw") > 330), F.lit(False)),
            "pts_mismatch": F.coalesce(F.abs(F.col("bx_pts") - F.col("pts")) > 2, F.lit(False)), "has_line": F.col("bx_side").isNotNull(),
            "start_year": F.coalesce(season(F.col("game_date"), 8, "start"), F.substring("season_id", 1, 4).try_cast("int")),
        }
    )
    rows = flag_known(rows, teams, ["team_id"], "team_known")
    rows = rows.withColumn("row_valid_any", F.col("team_known")).withColumn("row_valid", F.col("team_known") & (F.col("start_year") >= 2010) & F.col("is_home").isNotNull())
    other = rows.select(F.col("game_id").alias("_game"), F.col("team_id").alias("_team"), F.col("pts_final").alias("_pts"))
    rows = rows.join(other, (F.col("game_id") == F.col("_game")) & (F.col("team_id") != F.col("_team")), "left").drop("_game")
    rows = rows.withColumn("wl_final", result_of(F.col("pts_final"), F.col("_pts"), F.upper("wl"))).drop("_team")
    order = [F.col("wl_final").isNull(), F.col("wl").isNull(), F.col("matchup").isNull(), F.col("game_date").desc_nulls_last(), F.col("_pts").desc_nulls_last(), F.col("pts_final").desc_nulls_last(), F.col("pts").desc_nulls_last()]
    return first_per_key(rows, ["game_id", "team_id"], order).drop("_pts")
