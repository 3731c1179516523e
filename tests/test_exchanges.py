"""Shuffles of the steps that many queries share, and the results of their plain and their split ways."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from duolog.operators import drift, facts, features, quality, ranges
from duolog.plans.catalog import Tables
from duolog.sources.scratch import materialize

DATA = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning")


@tables
def test_lines_are_dealt_by_game_once(spark):
    games = Tables(spark, DATA).games
    assert shuffles(games) <= 3 and plan(games).count("REPARTITION_BY_COL") == 1  # lines, sides and calendar at most


@tables
def test_form_of_short_histories_takes_what_a_query_reads(spark):
    t = Tables(spark, DATA)
    assert shuffles(t.schedule) == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # two sides of the opponent's join, one window, two sides of the schedule's join, whose windows are not needed
        some = t.month.select("game_id", "drtg_l10", "pace")
        assert shuffles(some) == 5 and "opp_drtg_l10" not in plan(some)
        assert shuffles(t.month.select("pace", "gnum")) <= 5
        assert shuffles(t.formed) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@tables
def test_features_of_large_and_small_teams_agree(spark, rows, monkeypatch):
    names = ["game_id", "team_id", "gnum", "days_rest", "pts_l5", "reb_l10"]
    whole, form = rows(Tables(spark, DATA).schedule, *names), rows(Tables(spark, DATA).formed, "game_id", "team_id", "ortg_l10", "opp_drtg_l10")
    sizes = sorted(r["count"] for r in Tables(spark, DATA).games.groupBy("team_id").count().collect())
    monkeypatch.setattr(ranges, "BLOCK", sizes[len(sizes) // 2])
    assert rows(Tables(spark, DATA).schedule, *names) == whole
    monkeypatch.setattr(ranges, "BLOCK", 11)
    assert rows(Tables(spark, DATA).formed, "game_id", "team_id", "ortg_l10", "opp_drtg_l10") == form


def test_union_as_written_carries_no_null_keys(spark, rows):
    keys = ["season", "player_id"]
    frames = [
        spark.createDataFrame([(1, 2, "a"), (None, 3, "b"), (7, 7, "c")], "season int, player_id int, x string"),
        spark.createDataFrame([(1, 2, 5), (4, 4, None), (None, 3, 6), (9, 9, 1)], "season int, player_id int, y int"),
        spark.createDataFrame([(4, 4, 1.5), (7, 7, 2.5), (9, 9, 3.5)], "season int, player_id int, z double"),
    ]
    out = features.full_union(frames, keys, as_written=True)
    expected = [(1, 2, "a", 5, None), (None, 3, "b", None, None), (7, 7, "c", None, 2.5), (4, 4, None, None, None), (None, 3, None, 6, None), (9, 9, None, 1, None), (4, 4, None, None, 1.5), (9, 9, None, None, 3.5)]
    assert rows(out, "season", "player_id", "x", "y", "z") == sorted(expected, key=repr)
    assert "FullOuter" not in plan(out)


def test_profiles_hash_and_do_not_sort(spark):
    df = spark.createDataFrame([(k, k % 7, float(k % 3), "t") for k in range(200)], "a bigint, b int, c double, d string").repartition(3)
    out = quality.null_profile(df, df.columns)
    assert {r.column: r.n_distinct for r in out.collect()} == {"a": 200, "b": 7, "c": 3, "d": 1}
    assert "SortAggregate" not in plan(out)


def test_states_are_made_after_rows_are_dealt(spark):
    facts = spark.createDataFrame([(2001, k % 3, "REG", dt.date(2001, 1 + k % 4, 1), k) for k in range(60)], "season int, team_id int, season_type string, game_date date, pts int")
    schedule = facts.selectExpr("season", "team_id", "game_date", "cast(pts as double) as pts_l5")
    cuts = materialize(drift.decile_cuts(facts, ["pts"]))
    state = drift.month_state(facts, schedule, cuts, ["pts"], ["pts_l5"])
    text = plan(state)
    assert shuffles(state) == 1 and text.rindex("HashAggregate") < text.index("Exchange hashpartitioning")
    assert sum(r.n_games for r in state.collect()) == 60


@tables
def test_sides_of_games_are_found_where_lines_are_dealt(spark, rows):
    t = Tables(spark, DATA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(t.games) == 2 and plan(t.games).count("/lineitem.parquet") == 1  # lines and calendar; sides take no scan of their own
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(t.games) == rows(facts.with_opponent(t.stats, t.pairs.join(t.calendar, "game_id")).select(*t.games.columns))


def test_sums_by_team_hold_no_bins_and_bins_no_team(spark, rows):
    days = [dt.date(2001, 1, 5), dt.date(2001, 2, 7), None]
    data = [(days[k % 3], 2001 + k % 2, None if k % 7 == 0 else k % 4, "REG" if k % 5 else "PRE", None if k % 6 == 0 else k % 11) for k in range(120)]
    df = spark.createDataFrame(data, "game_date date, season int, team_id int, season_type string, pts int")
    schedule, cuts = df.select("game_date", "season", "team_id", F.col("pts").cast("double").alias("pts_l5")), drift.decile_cuts(df, ["pts"])
    whole, sums, bins = drift.month_state(df, schedule, cuts, ["pts"], ["pts_l5"]), drift.month_state(df, None, None, ["pts"]), drift.bin_state(df, cuts, ["pts"])
    assert rows(sums) == rows(whole, *sums.columns) and "b_pts" not in sums.columns
    assert bins.count() <= 6 and rows(drift.psi_baseline(bins, ["pts"])) == rows(drift.psi_baseline(whole, ["pts"]))
    pairs = lambda df: {r.ym: r.psi for r in df.collect()}
    assert pairs(drift.psi_monthly(bins, drift.psi_baseline(bins, ["pts"]), ["pts"])) == pytest.approx(pairs(drift.psi_monthly(whole, drift.psi_baseline(whole, ["pts"]), ["pts"])))
    league = drift.league_state(sums, ["pts"])
    assert rows(drift.baseline(league, ["pts"])) == rows(drift.baseline(whole, ["pts"]))
    means = lambda df: {r.ym: r.mean_pts for r in df.collect()}
    assert means(drift.league_means(league, ["pts"])) == pytest.approx(means(drift.monthly_league(drift.monthly(whole, ["pts"], ["pts_l5"]))))


def test_quantiles_of_narrow_integers_take_no_sketch(spark, monkeypatch):
    rng = random.Random(8)
    data = [(rng.choice(["a", "a", "b", None]), None if k % 5 == 0 else rng.randrange(40) - 20, rng.random(), None, rng.randrange(10**6)) for k in range(900)]
    df = spark.createDataFrame(data, "g string, x bigint, y double, none int, far bigint").repartition(4)
    shares = [0.0, 0.1, 0.5, 0.77, 1.0]
    plain = lambda keys: {r[0]: r[1:] for r in df.groupBy(*keys).agg(*([] if keys else [F.lit(0)]), *[F.percentile(c, F.array(*map(F.lit, shares))) for c in ("x", "y", "none", "far")]).collect()}
    monkeypatch.setattr(quality, "SMALL", 100)
    for keys in (["g"], []):
        found = quality.quantiles(df, ["x", "y", "none", "far"], shares, keys)
        got = {r[0] if keys else 0: r[len(keys) :] for r in found.collect()}
        assert got.keys() == plain(keys).keys()
        for g, expected in plain(keys).items():
            for a, b in zip(got[g], expected):
                assert a == (b and pytest.approx(b))
    assert "percentile_approx" not in plan(quality._ranked(df.select("x", "none"), ["x", "none"], ["x", "none"], shares, []))
