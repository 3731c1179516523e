"""Edge cases and invariants of the dataset operators on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duolog.functions import clean
from duolog.operators import dims, drift, facts, features, quality, reshape
from duolog.sources import landing
from duolog.streaming import incremental


def day(n):
    return dt.date(2024, 1, n)


def test_tolerant_casts(spark):
    df = spark.createDataFrame([("12.7",), ("12.5",), ("-2.5",), ("",), (" ",), ("abc",), (None,), ("NaN",)], "x string")
    got = [r.v for r in df.select(clean.tolerant(F.col("x"), "int").alias("v")).collect()]
    assert got == [13, 13, -3, None, None, None, None, None]


def test_ids_labels_minutes(spark):
    df = spark.createDataFrame([("12345678901", "Pre Season", "34:30"), ("G22", "cup", "34"), (None, None, ":"), ("x", "PLAYIN", None)], "i string, l string, m string")
    got = df.select(clean.padded_id(F.col("i")), clean.digits_id(F.col("i")), clean.canonical_label(F.col("l")), clean.clock_minutes(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [("1234567890", "1234567890", "Pre Season", 34.5), ("0000000G22", "0000000022", "cup", 34.0), (None, None, None, None), ("000000000x", None, "PlayIn", None)]


def test_align_missing_and_extra_columns(spark):
    from pyspark.sql.types import StructType

    df = spark.createDataFrame([("1", "7.6", "z")], "`Game ID` string, PTS string, extra string")
    got = clean.align(df, StructType.fromDDL("game_id bigint, pts int, day date"))
    assert got.columns == ["game_id", "pts", "day"] and tuple(got.first()) == (1, 8, None)


def test_unpivot_undoes_pivot(spark, rows):
    long = spark.createDataFrame([(1, "home", 5, None), (1, "away", 6, 2)], "g int, side string, a int, b int")
    wide = reshape.pivot_sides(long, ["g"], ["a", "b"])
    assert rows(reshape.unpivot_sides(wide, ["g"], ["a", "b"])) == rows(long)


def test_null_pairs(spark, rows):
    df = spark.createDataFrame([(None, None, 1), (None, 2, 3)], "a int, b int, c int")
    assert rows(reshape.null_pairs(df, ["a", "b", "c"]), "pair", "n", "pct") == [("a~b", 1, 50.0)]


def test_vote_tie_goes_by_month(spark):
    log = spark.createDataFrame([(1, dt.date(2024, 5, 1), "pre"), (1, dt.date(2024, 5, 1), "post"), (2, day(1), None)], "g int, d date, l string")
    assert {r.g: r.l for r in dims.vote_label(log, "g", "d", "l").collect()} == {1: "POST", 2: "REG"}


def test_pairs_of_three_teams(spark, rows):
    log = spark.createDataFrame([(1, day(1), t) for t in (3, 1, 2, 2)], "g int, d date, t int")
    assert rows(dims.pairs_of_games(log, "g", "d", "t"), "team_a", "team_b") == [(1, 2), (1, 3), (2, 3)]


def games(spark, values):
    return spark.createDataFrame(
        [(k, 1, 2, 2024, "REG", day(d), *([p] * 8)) for k, d, p in values],
        "game_id int, team_id int, opp_team_id int, season int, season_type string, game_date date, pts int, fga int, fta int, tpm int, tov int, oreb int, dreb int, pf int",
    )


def test_schedule_first_game_same_day_and_no_leakage(spark):
    got = {r.game_id: r for r in features.schedule_features(games(spark, [(1, 1, 10), (2, 1, 20), (3, 2, 30), (4, 9, 40)])).collect()}
    assert got[1].days_rest is None and got[1].rest_bucket == "7D+" and got[1].pts_l5 is None
    assert got[2].rest_bucket == "0D" and got[3].is_b2b and got[3].is_3in4 and got[4].rest_bucket == "7D+"
    other = {r.game_id: r.pts_l5 for r in features.schedule_features(games(spark, [(1, 1, 10), (2, 1, 20), (3, 2, 999), (4, 9, 40)])).collect()}
    assert other[3] == got[3].pts_l5 == 15.0


def test_ratings_guard_zero_and_opponent_missing(spark):
    r = features.derived_ratings(features.opponent_box(games(spark, [(1, 1, 0)]))).first()
    assert r.efg is None and r.ortg is None and r.y_win is None


def test_standard_scores_of_one_and_constant(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 3.0), (2, 3.0), (3, 1.0), (3, 3.0)], "g int, x double")
    got = sorted((r.g, r.z) for r in features.standard_scores(df, ["g"], {"z": "x"}).where("z is not null").collect())
    assert [g for g, _ in got] == [3, 3] and got[0][1] == -got[1][1]


def test_impute_falls_back_and_leaves_no_null(spark):
    df = spark.createDataFrame([(1, 1, 4), (1, 1, None), (2, 1, None), (3, 2, None)], "t int, s int, x int")
    got = {r.t: r.x for r in quality.impute_medians(df, ["x"], [["t", "s"], ["s"], []]).where("was_imputed_x").collect()}
    assert got == {1: 4.0, 2: 4.0, 3: 4.0}


def test_side_fact_of_a_lonely_row(spark):
    wide = spark.createDataFrame([("1", "22024", " Pre Season ", "2024-10-01", "300", "7", "A vs. B", "w", "10", "4", "8", "1", "2", "1", "2")], "game_id string, season_id string, season_type string, game_date string, min string, team_id_home string, matchup_home string, wl_home string, pts_home string, fgm_home string, fga_home string, fg3m_home string, fg3a_home string, ftm_home string, fta_home string")
    none = lambda s: spark.createDataFrame([], s)
    got = facts.side_fact(wide, none("game_id string, team_id string, bx_side string, bx_pts double"), none("game_id string"), none("game_id bigint, home_id bigint, away_id bigint, home_override boolean, away_override boolean"), none("team_id string"))
    r = got.where("team_id = '7'").first()
    assert (r.pts_final, r.wl_final, r.is_home, r.season_type, r.start_year, r.min_final, r.team_known) == (10.0, "W", True, "Pre Season", 2024, 300.0, False)


def test_psi_of_the_baseline_against_itself_is_zero(spark):
    df = spark.createDataFrame([(2024, "REG", day(1), i % 17) for i in range(60)], "season int, season_type string, game_date date, x int")
    cuts = drift.decile_cuts(df, ["x"])
    state = drift.month_state(df.withColumn("team_id", F.lit(1)), df.select("game_date", "season", F.lit(1).alias("team_id"), F.col("x").alias("f")), cuts, ["x"], ["f"])
    got = drift.psi_monthly(state, drift.psi_baseline(state, ["x"]), ["x"]).collect()
    assert len(got) == 1 and abs(got[0].psi) < 1e-12


def test_decile_bin_of_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (5.0,), (99.0,)], "x double").withColumn("q", F.array(*[F.lit(float(i)) for i in range(1, 10)]))
    assert [r.b for r in df.select(drift.decile_bin(F.col("x"), F.col("q")).alias("b")).collect()] == [None, 1, 5, 10]


def test_upsert_is_idempotent_and_folds_labels(spark, rows):
    old = spark.createDataFrame([(1, "Reg", "a"), (2, None, "b")], "k int, label string, v string")
    new = spark.createDataFrame([(1, "REG", "c"), (1, "reg", "d"), (3, "x", "e")], "k int, label string, v string")
    once = incremental.upsert(old, new, ["k", "label"], label="label")
    assert [r[0] for r in rows(once)] == [1, 2, 3]
    assert rows(incremental.upsert(once, new, ["k", "label"], label="label")) == rows(once)
    assert rows(incremental.upsert(old, new.limit(0), ["k", "label"], label="label")) == rows(old)


def test_publish_rejects_repeated_keys_and_stream_upserts(spark, tmp_path, rows):
    folder = str(tmp_path / "t")
    with pytest.raises(ValueError):
        incremental.publish(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), folder, ["k"])
    incremental.publish(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), folder, ["k"])
    spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("k int, v string").parquet(str(tmp_path / "in"))
    incremental.upsert_stream(source, folder, str(tmp_path / "cp"), ["k"]).awaitTermination()
    assert rows(incremental.current(spark, folder)) == [(1, "a"), (2, "c"), (3, "d")]


def test_result_set_skips_broken_payloads(spark):
    df = spark.createDataFrame([('{"resultSets":[{"name":"L","headers":["A","B"],"rowSet":[["1","2"],["3"]]}]}',), ("{",), (None,)], "p string")
    assert [r.row for r in landing.result_set(df, "p", "L").collect()] == [{"a": "1", "b": "2"}]


def test_season_partitions_stay_unless_forced(spark, tmp_path, rows):
    folder = str(tmp_path / "s")
    first = spark.createDataFrame([(1, 2020)], "v int, season int")
    both = spark.createDataFrame([(9, 2020), (2, 2021)], "v int, season int")
    landing.write_seasons(first, folder)
    landing.write_seasons(both, folder)
    assert rows(spark.read.parquet(folder), "v", "season") == [(1, 2020), (2, 2021)]
    landing.write_seasons(both, folder, force=True)
    assert rows(spark.read.parquet(folder), "v", "season") == [(2, 2021), (9, 2020)]


def test_quantiles_equal_numpy_on_ties_nulls_and_outliers(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    columns = {"a": rng.integers(0, 9, 500), "b": rng.normal(size=500), "c": np.concatenate([rng.normal(size=499), [1e12]]), "d": np.full(500, 3)}
    values = [tuple(None if k == 0 and i % 7 == 0 else float(v[i]) for k, v in enumerate(columns.values())) + (None,) for i in range(500)]
    df = spark.createDataFrame(values, "a double, b double, c double, d double, e double").repartition(5)
    got = quality.quantiles(df, ["a", "b", "c", "d", "e"], drift.DECILES).first()
    for k, c in enumerate("abcd"):
        known = [v[k] for v in values if v[k] is not None]
        assert np.allclose(got[c], np.quantile(known, drift.DECILES))
    assert got["e"] is None and quality.quantiles(df.limit(0), ["a"], [0.5]).first()["a"] is None
    assert quality.medians(df.limit(0), [], ["a"], "m_").first()["m_a"] is None


def test_reports_are_in_order(spark):
    df = spark.createDataFrame([(1, None, 2), (1, None, None), (2, 1, None), (2, 1, 1), (2, 1, 1)], "g int, a int, b int")
    spots = [(r.g, r.metric) for r in quality.missing_hotspots(df, ["g"], ["a", "b"]).collect()]
    assert spots == [(1, "a"), (1, "b"), (2, "b")]
    report = [(r.table_name, r.column_name, r.pct_null, r.n_distinct) for r in quality.profile_tables({"y": (df, ["g", "a", "b"]), "x": (df, ["g"])}).collect()]
    assert report == [("x", "g", 0.0, 2), ("y", "a", 40.0, 1), ("y", "b", 40.0, 2), ("y", "g", 0.0, 2)]


def test_readers_find_a_version_while_another_is_published(spark, tmp_path, rows):
    folder = str(tmp_path / "t")
    for v in "abc":
        incremental.publish(spark.createDataFrame([(1, v)], "k int, v string"), folder, ["k"])
        assert rows(incremental.current(spark, folder)) == [(1, v)]
    with pytest.raises(ValueError):
        incremental.publish(spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), folder, ["k"])
    assert rows(incremental.current(spark, folder)) == [(1, "c")]


def test_labels_of_windows_and_empty_seasons(spark):
    spans = spark.createDataFrame([(dt.date(2024, m, 2), dt.date(2024, m, 20)) for m in (1, 4, 9, 10, 11)] + [(dt.date(2024, 8, 1), dt.date(2024, 12, 1))], "s date, e date")
    got = [r.x for r in spans.select(incremental.plausible_labels(F.col("s"), F.col("e")).alias("x")).collect()]
    late = ["PlayIn", "Playoffs"]
    assert got == [["Regular Season"], ["Regular Season", *late], ["Pre Season", "Regular Season", *late], ["Pre Season", "Regular Season", *late], ["Regular Season", "In-Season Tournament", *late], ["Pre Season", "Regular Season", "In-Season Tournament", *late]]
    log = spark.createDataFrame([(dt.date(2023, 10, 5),), (dt.date(2024, 6, 12),), (dt.date(2024, 10, 26),)], "d date")
    plan = {r.label: (r.n_rows, r.status) for r in incremental.partition_plan(log, "d", spark.createDataFrame([(2024,)], "season int"), "2022-07-01", "2024-11-01").collect()}
    assert plan == {"2022-23": (0, "empty"), "2023-24": (2, "processed"), "2024-25": (1, "skipped")}


def test_invalid_ids_go_and_optional_inputs_are_typed(spark):
    df = spark.createDataFrame([("22300001",), ("id 0042300001 x",), ("99",), (None,), ("none",), ("00123456789012",)], "game_id string")
    assert [r.game_id for r in clean.keep_known_ids(df, "game_id").collect()] == ["0022300001", "0042300001", "00123456789012"]
    none = landing.optional(spark, None, landing.EXTERNAL)
    assert none.count() == 0 and len(none.columns) == 12
    some = landing.optional(spark, spark.createDataFrame([("7", "80.5", 1)], "`Player ID` string, HEIGHT_INCHES string, extra int"), landing.BIO)
    assert tuple(some.first()) == (7, 80.5)
    with pytest.raises(ValueError):
        quality.require_none(df, "no rows wanted")
    assert quality.require_none(df.limit(0), "").first().bad_rows == 0


def test_large_season_is_written_by_several_tasks(spark, tmp_path):
    folder = str(tmp_path / "s")
    df = spark.range(4000).select(F.lit(2020).alias("season"), (F.col("id") * 7919 % 4000).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    landing.write_seasons(df, folder, order=["v"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(folder).groupBy(F.input_file_name()).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).orderBy("lo").collect()
    assert len(files) > 1 and sum(r.n for r in files) == 4000 and all(a.hi < b.lo for a, b in zip(files, files[1:]))


def test_quantiles_of_hot_groups_and_outliers_in_bounded_windows(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    n = 30_000
    group = rng.choice(["hot", "hot", "hot", "mid", None, "few"], n, p=[0.3, 0.3, 0.2, 0.1, 0.0999, 0.0001])
    value = np.concatenate([rng.normal(size=n - 1), [1e12]])
    ties = rng.integers(0, 3, n).astype(float)
    data = [(g, float(v), None if k % 5 == 0 else float(t), None) for k, (g, v, t) in enumerate(zip(group.tolist(), value, ties))]
    df = spark.createDataFrame(data, "g string, a double, b double, c double").repartition(6).cache()
    sizes = []
    narrowed = quality._narrowed
    monkeypatch.setattr(quality, "_narrowed", lambda *a: sizes.append(1) or narrowed(*a))
    for small in (10_000, 20):
        monkeypatch.setattr(quality, "SMALL", small)
        got = {r.g: r for r in quality.quantiles(df, ["a", "b", "c"], [0.0, 0.1, 0.5, 0.999, 1.0], ["g"]).collect()}
        assert got.keys() == {r[0] for r in data}
        for g, row in got.items():
            for k, c in enumerate("ab", 1):
                known = [r[k] for r in data if r[0] == g and r[k] is not None]
                assert np.allclose(row[c], np.quantile(known, [0.0, 0.1, 0.5, 0.999, 1.0]), rtol=1e-12) if known else row[c] is None
            assert row["c"] is None
        whole = quality.quantiles(df, ["a", "b"], drift.DECILES).first()
        assert np.allclose(whole["a"], np.quantile(value, drift.DECILES)) and np.allclose(whole["b"], np.quantile([r[2] for r in data if r[2] is not None], drift.DECILES))
    assert sizes  # brackets of more than 20 values were cut
    df.unpersist()


def test_upsert_rewrites_touched_buckets_only_and_rejects_repeats(spark, tmp_path, rows):
    folder = str(tmp_path / "t")
    old = spark.createDataFrame([(k, "Reg" if k % 2 else None, "old") for k in range(200)], "k int, label string, v string")
    incremental.publish(old, folder, ["k", "label"], label="label", buckets=16)
    before = incremental._state(spark, folder)["at"]
    files = {b: sorted(p.name for p in (tmp_path / "t").glob(f"version=*/_bucket={b}/*.parquet")) for b in range(16)}
    new = spark.createDataFrame([(3, "REG", "new"), (3, "reg", "second"), (4, "", "new"), (999, None, "added")], "k int, label string, v string")
    touched = incremental.upsert_published(spark, folder, new)
    after = incremental._state(spark, folder)["at"]
    assert 0 < len(touched) <= 3 and {b for b in after if after[b] != before.get(b)} == {str(b) for b in touched}
    now = {b: sorted(p.name for p in (tmp_path / "t").glob(f"version=*/_bucket={b}/*.parquet")) for b in range(16)}
    assert all(now[b] == files[b] for b in range(16) if b not in touched)
    expected = rows(incremental.upsert(old, new, ["k", "label"], label="label"))
    assert rows(incremental.current(spark, folder)) == expected and len(expected) == 201
    assert incremental.upsert_published(spark, folder, new.limit(0)) == [] and rows(incremental.current(spark, folder)) == expected
    planted = spark.createDataFrame([(3, "rEG", "a"), (3, "reg", "b"), (8, None, "c")], old.schema)
    with pytest.raises(ValueError):
        incremental.require_unique_keys(planted, new, ["k", "label"], "label")
    incremental.require_unique_keys(planted.where("v <> 'a'"), new, ["k", "label"], "label")
    incremental.require_unique_keys(planted, new.where("k = 999"), ["k", "label"], "label")  # a repeat that no incoming key touches
    at, state = incremental._state(spark, folder)["at"], incremental._state(spark, folder)
    (bucket,) = incremental.upsert_published(spark, folder, new.where("k = 999"))
    path = incremental._state(spark, folder)["at"][str(bucket)]
    assert path != at[str(bucket)] and rows(incremental.current(spark, folder)) == expected
    stale = incremental._bucket_files(spark, state)
    assert rows(stale) == expected  # readers of the old pointer still find their files


def test_drift_state_of_two_batches_and_null_keys(spark, rows):
    days = [dt.date(2001, 1, 5), dt.date(2001, 2, 7), None]
    facts = [(days[k % 3], 2001 + k % 2, None if k % 7 == 0 else k % 4, "REG" if k % 5 else "PRE", None if k % 6 == 0 else k % 11) for k in range(120)]
    df = spark.createDataFrame(facts, "game_date date, season int, team_id int, season_type string, pts int")
    schedule = df.select("game_date", "season", "team_id", F.col("pts").cast("double").alias("pts_l5"))
    cuts = drift.decile_cuts(df, ["pts"])
    state = lambda part: drift.month_state(df.where(part), schedule.where(part), cuts, ["pts"], ["pts_l5"])
    whole = state("true")
    early = F.coalesce(F.col("game_date") < dt.date(2001, 2, 1), F.lit(False))
    halves = drift.merged_state(drift.month_state(df.where(early), schedule.where(early), cuts, ["pts"], ["pts_l5"]), drift.month_state(df.where(~early), schedule.where(~early), cuts, ["pts"], ["pts_l5"]))
    assert rows(whole, *whole.columns) == rows(halves, *whole.columns)
    assert whole.count() == whole.select("ym", "season", "team_id").distinct().count()  # one row for a null month or team, too
    means = {(r.ym, r.season, r.team_id): r.mean_pts for r in drift.monthly(whole, ["pts"], ["pts_l5"]).collect()}
    for (ym, season, team), mean in means.items():
        known = [p for d, s, t, kind, p in facts if (d and d.replace(day=1)) == ym and s == season and t == team and kind == "REG" and p is not None]
        assert mean == (pytest.approx(sum(known) / len(known)) if known else None)
    base = drift.baseline(whole, ["pts"]).first()
    known = [p for _, s, _, kind, p in facts if kind == "REG" and p is not None]
    assert base.mean_pts == pytest.approx(sum(known) / len(known))
    shares = {r.bin: r.p for r in drift.psi_baseline(whole, ["pts"]).collect()}
    assert sum(shares.values()) == pytest.approx(1) and shares[None] == pytest.approx(sum(p is None for _, _, _, kind, p in facts if kind == "REG") / sum(kind == "REG" for *_, kind, _ in facts))


def test_union_of_frames_takes_one_exchange(spark, rows):
    frames = [spark.createDataFrame([(1, 2, "a"), (None, 3, "b")], "season int, player_id int, x string"), spark.createDataFrame([(1, 2, 5), (4, 4, None), (None, 3, 6)], "season int, player_id int, y int"), spark.createDataFrame([(4, 4, 1.5)], "season int, player_id int, z double")]
    out = features.full_union(frames, ["season", "player_id"])
    joined = frames[0]
    for df in frames[1:]:
        joined = joined.join(df, ["season", "player_id"], "full")
    assert rows(out, *joined.columns) == rows(joined)
    assert out._jdf.queryExecution().sparkPlan().toString().count("Join") == 0


def test_latest_date_comes_from_footers(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([(dt.date(2020, 1, k + 1), "x") for k in range(9)] + [(None, "y")], "day date, v string").repartition(3).write.parquet(path)
    assert incremental.footer_latest(spark, path, "day").first().latest == dt.date(2020, 1, 9)
    mark = incremental.watermark(spark, [(incremental.footer_latest(spark, path, "day"), "latest")]).first()
    assert (mark.watermark, mark.start) == (dt.date(2020, 1, 9), dt.date(2020, 1, 10))
    with pytest.raises(ValueError):  # text has no exact statistics
        incremental.footer_latest(spark, path, "v")
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList", "parquet")
    spark.createDataFrame([], "day date").write.parquet(str(tmp_path / "none"))
    assert incremental.footer_latest(spark, str(tmp_path / "none"), "day").first().latest is None


def test_added_months_meet_null_keys(spark, tmp_path, rows):
    folder = str(tmp_path / "d")
    cell = lambda ym, season, team, n: (ym, season, team, n, n, float(n), float(n * n), [0] * 10 + [n])
    schema = "ym date, season int, team_id int, n_games long, n_pts long, s_pts double, ss_pts double, b_pts array<long>"
    old = spark.createDataFrame([cell(dt.date(2001, 1, 1), 2001, 1, 2), cell(None, 2001, None, 3)], schema)
    incremental.publish(old, folder, list(drift.KEYS), buckets=8)
    new = spark.createDataFrame([cell(None, 2001, None, 4), cell(dt.date(2001, 2, 1), 2001, 1, 5)], schema)
    drift.add_months(spark, folder, new)
    got = {(r.ym, r.team_id): (r.n_games, r.s_pts, r.b_pts[10]) for r in incremental.current(spark, folder).collect()}
    assert got == {(dt.date(2001, 1, 1), 1): (2, 2.0, 2), (None, None): (7, 7.0, 7), (dt.date(2001, 2, 1), 1): (5, 5.0, 5)}


def test_distinct_counts_by_bitmaps_and_pairs(spark, monkeypatch):
    big = 2**62
    data = [(k % 7 - 3, None if k % 3 else k * big // 99, dt.date(1969, 12, 1) + dt.timedelta(days=k % 50), f"t{k % 5}", None, k * 40_000 % 1_000_003) for k in range(99)]
    df = spark.createDataFrame(data, "small int, wide bigint, day date, text string, none int, spread bigint").repartition(3)
    expected = {c: len({r[k] for r in data if r[k] is not None}) for k, c in enumerate(df.columns)}
    assert {r.column: r.n_distinct for r in quality.null_profile(df, df.columns).collect()} == expected
    monkeypatch.setattr(quality, "BITS", 1 << 60)  # all spans count as dense
    narrow = ["small", "day", "spread", "none"]
    assert {r.column: r.n_distinct for r in quality.null_profile(df, narrow).collect()} == {c: expected[c] for c in narrow}
    assert {r.column: (r.n, r.n_distinct) for r in quality.null_profile(df.limit(0), df.columns).collect()} == {c: (0, 0) for c in df.columns}


def test_csv_files_of_different_columns_types_and_bad_lines(spark, tmp_path, rows):
    (tmp_path / "deep").mkdir()
    (tmp_path / "A b.csv").write_text("id, when ,flag,x,,x\n1,2020-01-02,true,1e3,q,z\n\n2,,FALSE,.5,,\n3,2020-02-03\n4,2020-02-03,true,1,2,3,4\n")
    (tmp_path / "deep" / "a-B.csv").write_text("ID2,id,flag\n00012345678901234567890,9,true\n")
    (tmp_path / "c.csv").write_text('at,name,n\n2020-01-01,"x, ""y""",1\n2020-01-01 10:00:00,,2.5\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("a,b\n")
    (tmp_path / "other.txt").write_text("no,table\n")
    got = landing.read_tables(spark, str(tmp_path))
    assert got.tables.keys() == {"a_b", "c", "head"}
    assert dict(got.tables["a_b"].dtypes) == {"id": "bigint", "when": "date", "flag": "boolean", "x": "double", "column5": "string", "x_6": "string", "ID2": "string"}
    assert rows(got.tables["a_b"], "id", "when", "flag", "x", "column5", "x_6", "ID2") == sorted([(1, dt.date(2020, 1, 2), True, 1000.0, "q", "z", None), (2, None, False, 0.5, None, None, None), (9, None, True, None, None, None, "00012345678901234567890")], key=repr)
    assert rows(got.tables["c"]) == sorted([(dt.datetime(2020, 1, 1), 'x, "y"', 1.0), (dt.datetime(2020, 1, 1, 10), None, 2.5)], key=repr)
    assert dict(got.tables["head"].dtypes) == {"a": "string", "b": "string"} and got.tables["head"].count() == 0
    assert sorted((r.source, r.file.rsplit("/", 1)[1], r.line, r.reason) for r in got.rejects.collect()) == [("a_b", "A%20b.csv", "3,2020-02-03", "not 6 fields"), ("a_b", "A%20b.csv", "4,2020-02-03,true,1,2,3,4", "not 6 fields")]
