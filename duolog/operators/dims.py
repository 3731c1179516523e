"""Conformed dimensions: precedence, votes, label repair, pairs, bridges, overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duolog.functions.clean import season


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; the order should be total, so that the result is the same every time."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def by_precedence(sources: Sequence[tuple[int, DataFrame]], key: str, values: Sequence[str]) -> DataFrame:
    """One row per key: of the sources' rows, those of the lowest number first, then those with more values."""
    tagged = [df.select(key, *values, F.lit(number).alias("_source")) for number, df in sources]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df)
    order = [F.col("_source"), *[F.col(v).isNull() for v in values], *[F.col(v) for v in values]]
    return first_per_key(union.where(F.col(key).isNotNull()), [key], order).drop("_source")


def vote_label(log: DataFrame, game: str, date: str, label: str) -> DataFrame:
    """PRE, POST or REG per game by the most mentions in its rows' labels; on a tie by the month (9-10 PRE, 5-7 POST, else REG)."""
    text = F.lower(F.nullif(F.trim(label), F.lit("")))
    count = lambda word: F.count_if(F.coalesce(text.contains(word), F.lit(False)))
    votes = log.where(F.col(game).isNotNull() & F.col(date).isNotNull()).groupBy(game)
    votes = votes.agg(F.min(date).alias(date), count("pre").alias("_pre"), count("post").alias("_post"), count("reg").alias("_reg"))
    pre, post, reg, month = F.col("_pre"), F.col("_post"), F.col("_reg"), F.month(date)
    decided = (
        F.when(post > F.greatest(reg, pre), "POST").when(pre > F.greatest(reg, post), "PRE").when(reg > F.greatest(pre, post), "REG")
        .when(month.isin(9, 10), "PRE").when(month.isin(5, 6, 7), "POST").otherwise("REG")
    )
    return votes.select(game, date, decided.alias(label))


def extreme_sides(log: DataFrame, game: str, date: str, team: str) -> DataFrame:
    """home_id and away_id per game and date: the smallest and the largest team."""
    return log.groupBy(game, date).agg(F.min(team).alias("home_id"), F.max(team).alias("away_id"))


def game_dimension(games: DataFrame, line: DataFrame) -> DataFrame:
    """games (game_id, game_date, label, home_id) with the away side of line (game_id, away_id), season and PRE/POST/REG by the label's wording."""
    away = line.groupBy("game_id").agg(F.max("away_id").alias("away_id"))
    raw = F.coalesce("label", F.lit("Regular Season"))
    kind = F.when(F.lower(raw).contains("pre"), "PRE").when(F.lower(raw).contains("post"), "POST").otherwise("REG")
    return games.join(away, "game_id", "left").select(
        "game_id", "game_date", raw.alias("label_raw"), "home_id", "away_id", season(F.col("game_date")).alias("season"), kind.alias("season_type")
    )


def label_by_month(date: Column, label: Column) -> Column:
    """Calendar repair: 9 PRE; 10-3 REG; 4 POST if so labelled, else REG; 5-6 POST; 7-8 the label, else POST."""
    month = F.month(date)
    return (
        F.when(month == 9, "PRE").when(month.isin(10, 11, 12, 1, 2, 3), "REG").when((month == 4) & (label == "POST"), "POST").when(month == 4, "REG")
        .when(month.isin(5, 6), "POST").when(month.isin(7, 8), F.coalesce(label, F.lit("POST"))).otherwise(F.coalesce(label, F.lit("REG")))
    )


def impossible_label(date: Column, label: Column) -> Column:
    """Regular games in months 5-7, play-offs in months 9-10."""
    month = F.month(date)
    return (month.isin(5, 6, 7) & (label == "REG")) | (month.isin(9, 10) & (label == "POST"))


def label_overrides(games: DataFrame) -> DataFrame:
    """(game_id, new_label) for games (game_id, game_date, season_type) with an impossible label."""
    month = F.month("game_date")
    new = F.when(month.isin(5, 6, 7), "POST").when(month.isin(9, 10), "REG").otherwise(F.col("season_type"))
    return games.where(impossible_label(F.col("game_date"), F.col("season_type"))).select("game_id", new.alias("new_label"))


def apply_label_overrides(games: DataFrame, overrides: DataFrame) -> DataFrame:
    joined = games.join(overrides, "game_id", "left")
    return joined.withColumn("season_type", F.coalesce("new_label", "season_type")).drop("new_label")


def union_of_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of each, copies across both kept."""
    return a.distinct().unionByName(b.distinct())


def pairs_of_games(log: DataFrame, game: str, date: str, team: str) -> DataFrame:
    """(game, date, team_a, team_b) with team_a < team_b for every unordered pair of a game's teams, by gathering
    a game's distinct teams (a handful) rather than joining the log to itself."""
    teams = log.groupBy(game, date).agg(F.sort_array(F.collect_set(team)).alias("_t"))
    pairs = teams.select(game, date, "_t", F.posexplode("_t").alias("_i", "team_a"))
    return pairs.select(game, date, "team_a", F.explode(F.slice("_t", F.col("_i") + 2, F.size("_t"))).alias("team_b"))


def bridge_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Games of two id systems (game_id, game_date, side_1, side_2) matched by date and the two sides in any order: left_id, right_id."""
    keyed = lambda df, name: df.select(F.col("game_id").alias(name), "game_date", F.least("side_1", "side_2").alias("_lo"), F.greatest("side_1", "side_2").alias("_hi"))
    return keyed(left, "left_id").join(keyed(right, "right_id"), ["game_date", "_lo", "_hi"]).select("left_id", "right_id").distinct()


def resolve_sides(games: DataFrame) -> DataFrame:
    """(game_id, home_id, away_id) from whichever columns a source has: home/away ids, or (team_id, side) rows."""
    have = set(games.columns)
    if {"home_id", "away_id"} <= have:
        return games.groupBy("game_id").agg(F.min("home_id").alias("home_id"), F.min("away_id").alias("away_id"))
    if {"team_id", "side"} <= have:
        return games.groupBy("game_id").agg(*[F.min(F.when(F.col("side") == s, F.col("team_id"))).alias(f"{s}_id") for s in ("home", "away")])
    raise ValueError("neither home_id/away_id nor team_id/side")


def apply_side_overrides(sides: DataFrame, overrides: DataFrame) -> DataFrame:
    """(game_id, team_id, side) rows with overrides (game_id, home_id, away_id, home_override, away_override); both rows of a game take
    the overriding side. Ids are compared as 64-bit integers. Rows without a team go."""
    fixed = overrides.select(F.col("game_id").try_cast("bigint").alias("_g"), "home_id", "away_id", "home_override", "away_override")
    joined = sides.join(fixed, sides["game_id"].try_cast("bigint") == F.col("_g"), "left")
    team = F.coalesce(F.when(F.col("home_override"), F.col("home_id")).when(F.col("away_override"), F.col("away_id")), F.col("team_id"))
    side = F.coalesce(F.when(F.col("home_override"), "home").when(F.col("away_override"), "away"), F.col("side"))
    return joined.select(sides["game_id"], team.alias("team_id"), side.alias("side")).where("team_id is not null")
