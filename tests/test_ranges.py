"""Row numbers and history windows over ranges, against plain windows, with one group that holds nearly all rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from duolog.operators import features, ranges


def skewed(spark, n=3000):
    rng = random.Random(3)
    rows = [("a" if rng.random() < 0.9 else rng.choice(["b", "c", None]), rng.choice([1, 2, None]), k, rng.randrange(50)) for k in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "team string, season int, day int, value int").repartition(5)


def test_numbers_and_sums_equal_windows(spark, rows):
    df = skewed(spark)
    got = ranges.numbered(df, ["team"], ["day"], {"r": ["team"], "s": ["team", "season"]}, {"before": (["team"], "value")})
    own = Window.partitionBy("team").orderBy("day")
    both = Window.partitionBy("team", "season").orderBy("day")
    expected = df.withColumns({"r": F.row_number().over(own), "s": F.row_number().over(both), "before": F.coalesce(F.sum("value").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    assert rows(got, *expected.columns) == rows(expected)
    assert ranges.numbered(df.limit(0), [], ["day"], {"r": []}).count() == 0
    assert rows(ranges.numbered(df, [], ["day"], {"_part": []}), "_part", "day") == sorted(((k + 1, k) for k in range(3000)), key=repr)


def test_a_hot_group_is_spread_over_ranges_and_blocks(spark, rows):
    df = skewed(spark)
    numbered = ranges.numbered(df, ["team"], ["day"], {"r": ["team"]})
    assert numbered.where("team = 'a'").count() > 2500
    columns = lambda w: {"last": F.lag("value", 3).over(w), "mean": F.avg("value").over(w.rowsBetween(-10, -1))}
    got = ranges.with_history(numbered, ["team"], "r", 10, columns, block=64)
    own = Window.partitionBy("team").orderBy("day")
    expected = df.withColumn("r", F.row_number().over(own)).withColumns(columns(own))
    assert rows(got, *expected.columns) == rows(expected)
    sizes = numbered.groupBy("team", F.floor((F.col("r") - 1) / 64)).count().agg(F.max("count")).first()[0]
    assert sizes <= 64


def test_features_of_one_team_that_plays_nearly_all_games(spark, rows, monkeypatch):
    rng = random.Random(4)
    facts = [(k, rng.choice([1, 1, 1, 1, 1, 1, 2, 3]), 2000 + k // 300, "REG", k // 2, *[rng.randrange(9) for _ in range(5)]) for k in range(1200)]
    df = spark.createDataFrame(facts, "game_id int, team_id int, season int, season_type string, d int, pts int, tov int, tpm int, oreb int, dreb int")
    df = df.withColumn("game_date", F.date_add(F.lit("2001-01-01").cast("date"), F.col("d"))).drop("d")
    whole = features.schedule_features(df)
    monkeypatch.setattr(ranges, "BLOCK", 37)
    split = features.schedule_features(df)
    assert rows(whole, *sorted(whole.columns)) == rows(split, *sorted(whole.columns))
    career = Window.partitionBy("team_id").orderBy("game_date", "game_id").rowsBetween(-10, -1)
    season = Window.partitionBy("team_id", "season").orderBy("game_date", "game_id")
    plain = df.withColumns({"gnum": F.row_number().over(season), "prev_date": F.lag("game_date").over(season), "tpm_l10": F.avg("tpm").over(career)})
    assert rows(split, *plain.columns) == rows(plain)
    rated = df.withColumns({"opp_team_id": F.col("team_id") % 2, **{c: F.col("pts").cast("double") for c in "y_win ortg drtg_opp poss_game efg tov_pct orb_pct ftr".split()}})
    form = features.rolling_form(rated)
    own = Window.partitionBy("team_id", "season", "season_type").orderBy("game_date", "game_id").rowsBetween(-10, -1)
    other = Window.partitionBy("opp_team_id", "season", "season_type").orderBy("game_date", "game_id").rowsBetween(-10, -1)
    plain = rated.withColumns({"ortg_l10": F.avg("ortg").over(own), "opp_drtg_l10": F.avg("drtg_opp").over(other)})
    assert rows(form, "game_id", "ortg_l10", "opp_drtg_l10") == rows(plain, "game_id", "ortg_l10", "opp_drtg_l10")
