"""Further registered queries: reports, gates, counts, sinks and optional inputs, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolog.functions import clean
from duolog.operators import dims, drift, facts, quality
from duolog.plans import lens
from duolog.plans.catalog import _BAD, _BOTH, _LINE, _OLD, STATS, Tables, _line, _new_orders, _old_orders, _raw_wide, _shared, mart_fact, oracle
from duolog.sources import landing
from duolog.sources.scratch import materialize
from duolog.streaming import incremental


@oracle("raw", "select game_id, team_id, case lower(trim(l)) when 'regular season' then 'Regular Season' when 'pre season' then 'Pre Season' when 'playoffs' then 'Playoffs' when 'post season' then 'Playoffs' when 'in-season tournament' then 'In-Season Tournament' when 'play-in' then 'PlayIn' else l end as label from (select game_id, team_id, case game_id % 6 when 0 then ' In-Season Tournament' when 1 then 'Play-In ' when 2 then ' cup' else label_raw end as l from raw)")
def fetched_labels(t: Tables) -> DataFrame:
    k = F.col("game_id") % 6
    label = F.when(k == 0, " In-Season Tournament").when(k == 1, "Play-In ").when(k == 2, " cup").otherwise(F.col("label_raw"))
    return t.raw.select("game_id", "team_id", clean.fetched_label(label).alias("label"))


@oracle("games", "select '00' || (game_id % 8) || lpad(cast(game_id as varchar), 7, '0') || case when game_id % 9 = 0 then '123' else '' end as game_id, team_id from games where game_id % 8 between 1 and 5 and game_id % 11 <> 0")
def valid_ids(t: Tables) -> DataFrame:
    k = F.col("game_id")
    digits = F.concat(F.lit("00"), (k % 8).cast("string"), F.lpad(k.cast("string"), 7, "0"), F.when(k % 9 == 0, "123").otherwise(""))
    raw = F.when(k % 11 == 0, F.when(k % 2 == 0, "none")).otherwise(F.concat(F.lit("id "), digits, F.lit(" x")))
    return clean.keep_known_ids(t.games.select(raw.alias("game_id"), "team_id"), "game_id")


@oracle("", "select cast(greatest(f - o, 0) as bigint) as added_rows, f as final_rows from (select count(distinct (o_custkey, day)) as f from (select * from old union all select * from new)), (select count(*) as o from old)", extra=_BOTH)
def append_added(t: Tables) -> DataFrame:
    return incremental.append_counts(_old_orders(t), _new_orders(t), ["o_custkey", "day"])


_MINUTES = f"""select g.game_id, g.team_id, game_date, minutes_raw, target_minutes, coalesce(abs(minutes_raw - target_minutes) > 1.0, false) as min_bad,
    case when coalesce(abs(minutes_raw - target_minutes) > 1.0, false) then case when game_date >= date '1998-01-01' then 'failure' else 'legacy' end end as level
  from (select game_id, team_id, cast(case when game_id % 4 = 0 then null when game_id % 4 = 1 then 240 + team_id % 3 else 20 * sum(minutes) end as double) as minutes_raw from pg group by 1, 2) g
  join (select c.game_id, c.game_date, cast(240 + 25 * coalesce(({' + '.join(f'cast(coalesce(bool_or(pts_ot{k} is not null), false) as int)' for k in range(1, 11))}), 0) as int) as target_minutes
    from cal c join pair p on p.game_id = c.game_id left join ln on ln.game_id = c.game_id and ln.team_id in (p.home_id, p.away_id) group by 1, 2) e on e.game_id = g.game_id
  order by game_date desc, g.game_id, g.team_id limit 20000"""


@oracle("pair cal pg", _MINUTES, {4: "minutes_raw"}, extra=f"ln as ({_LINE})")
def minutes_gate(t: Tables) -> DataFrame:
    k = F.col("game_id") % 4
    played = t.players.groupBy("game_id", "team_id").agg(F.sum("minutes").alias("m"))
    minutes = played.select("game_id", "team_id", F.when(k == 1, (240 + F.col("team_id") % 3).cast("double")).when(k > 1, 20 * F.col("m")).alias("minutes_raw"))
    targets = facts.overtime_targets(t.calendar.join(t.pairs, "game_id", "left_semi").select("game_id", "game_date"), _line(t)).select("game_id", "game_date", "target_minutes")
    return quality.minutes_gate(minutes, targets, "1998-01-01").select("game_id", "team_id", "game_date", "minutes_raw", "target_minutes", "min_bad", "level")


_TABLES = {
    "game_dim": (["game_id", "game_date", "season", "season_type", "home_id", "away_id"], "(select c.*, home_id, away_id from cal c left join pair using (game_id))"),
    "side_games": (["season", "season_type", "game_date", "game_id", "team_id", "opp_team_id", "is_home", *STATS, "reb"], "(select *, oreb + dreb as reb from games)"),
    "schedule": (["season", "season_type", "game_date", "game_id", "team_id", "opp_team_id", "is_home", *STATS, "gnum", "prev_date", "days_rest", "rest_bucket", "is_0in2", "is_b2b", "is_3in4", "is_4in6", "pts_l5", "tov_l5", "tpm_l10", "reb_l10"], "sched"),
}
_EDGES = ("pts_l5", "tov_l5", "tpm_l10", "reb_l10")  # means: their text differs between engines


@oracle(
    "pair cal sched",
    " union all ".join(
        f"select '{name}' as table_name, '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_null, round((count(*) - count({c})) * 100.0::double / nullif(count(*), 0), 3) as pct_null, count(distinct {c}) as n_distinct, "
        + ("cast(null as varchar) as v_min, cast(null as varchar) as v_max" if c in _EDGES else f"cast(min({c}) as varchar) as v_min, cast(max({c}) as varchar) as v_max") + f" from {table}"
        for name, (columns, table) in _TABLES.items() for c in columns
    ),
)
def null_profile_tables(t: Tables) -> DataFrame:
    frames = {"game_dim": t.calendar.join(t.pairs, "game_id", "left"), "side_games": t.reb, "schedule": t.kept_schedule}
    frames["game_dim"] = materialize(frames["game_dim"])
    report = quality.profile_tables({name: (frames[name], columns) for name, (columns, _) in _TABLES.items()})
    edge = lambda c: F.when(~F.col("column_name").isin(*_EDGES), F.col(c)).alias(c)
    return report.select("table_name", "column_name", "n_rows", "n_null", "pct_null", "n_distinct", edge("v_min"), edge("v_max"))


_LOG_TEXT = {"season_id": "'2' || season", "team_id": "cast(team_id as varchar)", "team_abbreviation": "case when game_id % 7 = 0 then '' else 'T' || team_id end", "team_name": "case when game_id % 7 = 0 then '' else 'Team ' || team_id end", "game_id": "cast(game_id as varchar)"}
_LOG_TEXT |= {"game_date": "game_date", "matchup": "case game_id % 3 when 0 then case when is_home then 'A vs. B' else 'B @ A' end when 1 then 'A - B' else '' end", "wl": "case when game_id % 2 = 0 then 'W' else '' end"}
_LOG_TEXT |= {"min": "cast(case game_id % 3 when 0 then 240 when 1 then 12 end as double)", "fg_pct": "0.5::double", "fg3_pct": "cast(null as double)", "ft_pct": "cast(null as double)", "reb": "cast(case when game_id % 8 <> 0 then stl end as double)"}
_LOG_TEXT |= {"pts": "cast(case when game_id % 5 = 0 then fga + 3 else fga end as double)", "plus_minus": "cast(-tov as double) + 0.0", "video_available": "0", "fg3m": "cast(tpm as double)", "fg3a": "cast(tpa as double)"}
_LOG_TEXT |= {c: f"cast({c} as double)" for c in ("fgm", "fga", "ftm", "fta", "oreb", "dreb", "ast", "stl", "blk", "tov", "pf")}
_LOG_TEXT |= {"season_type": "case game_id % 4 when 0 then ' pre season ' when 1 then '' when 2 then 'Playoffs' else 'Cup' end"}


@oracle("games", f"select {', '.join(f'{v} as {k}' for k, v in _LOG_TEXT.items())} from games where game_id % 9 <> 0")
def bootstrap_log(t: Tables) -> DataFrame:
    return landing.bootstrap_log(_raw_wide(t))


@oracle("", "select p_partkey as player_id, cast(null as double) as height_inches, season, cast((p_partkey * 3 + season) % 100 + 1 as double) as versatility, cast(null as double) as odarko, p_size from part left join (select p_partkey as k, season from part, (values (1996), (1997), (1998)) y(season)) on k = p_partkey")
def optional_inputs(t: Tables) -> DataFrame:
    have = landing.optional(t.spark, lens.versatility(t.spark, t.sf_dir), landing.VERSATILITY)
    players = t("part").select(F.col("p_partkey").alias("player_id"), "p_size")
    rows = players.join(landing.optional(t.spark, None, landing.BIO), "player_id", "left").join(have, "player_id", "left")
    return rows.join(landing.optional(t.spark, None, landing.EXTERNAL).select("season", "player_id", "odarko"), ["season", "player_id"], "left")


@oracle("cal", f"select count(*) as bad_rows from cal where {_BAD}")
def season_type_assert(t: Tables) -> DataFrame:
    return t.calendar.where(dims.impossible_label(F.col("game_date"), F.col("season_type"))).agg(F.count("*").alias("bad_rows"))


@oracle("", "select o_custkey, o_orderkey, label, status, day, true as stamped from new union all select o.*, false from old o where not exists (select 1 from new n where n.o_custkey = o.o_custkey and n.o_orderkey = o.o_orderkey and lower(n.label) = lower(o.label))", extra=_BOTH)
def merge_stamped(t: Tables) -> DataFrame:
    old = _old_orders(t).withColumn("updated_at", F.lit("2000-01-01 00:00:00").cast("timestamp"))
    merged = incremental.upsert(old, incremental.stamped(_new_orders(t)), ["o_custkey", "o_orderkey", "label"], label="label")
    return merged.select("o_custkey", "o_orderkey", "label", "status", "day", (F.col("updated_at") > F.lit("2020-01-01").cast("timestamp")).alias("stamped"))


@oracle("games pair", "select game_id, min(team_id) as home_id, max(team_id) as away_id from games group by 1")
def resolve_sides_by_columns(t: Tables) -> DataFrame:
    return dims.resolve_sides(t.pairs.join(t.calendar, "game_id").select("game_id", "home_id", "away_id"))


# Sinks: written to the shared folder and read again


@oracle("games", "select season, game_id, team_id, case when season < 1998 then pts else pts + 1 end as pts from games")
def season_sink(t: Tables) -> DataFrame:
    folder, rows = _shared(t, "seasons"), t.kept_games.select("season", "game_id", "team_id", "pts")
    landing.write_seasons(rows.where("season < 1998"), folder, order=["game_id", "team_id"])
    landing.write_seasons(rows.withColumn("pts", F.col("pts") + 1), folder, order=["game_id", "team_id"])
    return t.spark.read.parquet(folder).select("season", "game_id", "team_id", "pts")


@oracle("", "select * from new union all select * from old o where not exists (select 1 from new n where n.o_custkey = o.o_custkey and n.o_orderkey = o.o_orderkey and lower(n.label) = lower(o.label))", extra=_BOTH)
def published_upsert(t: Tables) -> DataFrame:
    folder, keys = _shared(t, "table"), ["o_custkey", "o_orderkey", "label"]
    incremental.publish(_old_orders(t), folder, keys, label="label")
    incremental.upsert_published(t.spark, folder, _new_orders(t))
    return incremental.current(t.spark, folder)


@oracle("games", "select game_id, team_id, opp_team_id as opponent_id, game_date, season as season_id, season_type, is_home as home, pts, pts as points, fgm as field_goals_made, fga as field_goals_tried, oreb + dreb as rebounds, ast as assists from games")
def mart_sink(t: Tables) -> DataFrame:
    folder = _shared(t, "mart")
    incremental.publish(mart_fact(t), folder, ["game_id", "team_id"])
    return incremental.current(t.spark, folder)


@oracle("", "select max(day) as watermark, max(day) + 1 as start from old", extra=_OLD)
def watermark_from_footers(t: Tables) -> DataFrame:
    folder = _shared(t, "log")
    _old_orders(t).write.parquet(folder)
    latest = incremental.footer_latest(t.spark, folder, "day")
    return incremental.watermark(t.spark, [(latest.where("false"), "latest"), (latest, "latest")])


_ALERTS = f"select ym, {' or '.join(f'flag_{m}' for m in drift.METRICS)} as any_3sigma, " + ", ".join(f"coalesce((select max(case when psi > 0.25 then 1 else 0 end) from psim p where p.ym = f.ym and metric = '{m}'), 0) as psi_{m}_major" for m in drift.METRICS) + " from flags f"


@oracle("flags psim", _ALERTS)
def drift_alerts_in_batches(t: Tables) -> DataFrame:
    """The state of recent seasons is published; then older months arrive, and only they are read and only their buckets rewritten."""
    folder, keys = _shared(t, "drift"), list(drift.KEYS)
    old = F.col("season") < 1998
    state = lambda part: drift.month_state(t.reb.where(part), t.kept_form.where(part), t.cuts)
    incremental.publish(state(~old), folder, keys)
    drift.add_months(t.spark, folder, state(old))
    whole = materialize(incremental.current(t.spark, folder))
    shift = drift.mean_shift(drift.monthly_league(drift.monthly(whole)), drift.baseline(whole))
    return drift.alerts(shift, drift.psi_monthly(whole, drift.psi_baseline(whole)))
