"""Shared SQL of the oracles: named subqueries and how to put them together."""

from __future__ import annotations

from collections.abc import Iterable

STATS = "pts fgm fga tpm tpa ftm fta oreb dreb ast stl blk tov pf".split()
#: Added before rounding: decimal fractions that lie halfway would round either way.
NUDGE = 3.3e-8
METRICS = "pts fga tpm fta reb tov pf".split()

CTE = {
    "pair": "select l_orderkey as game_id, min(l_suppkey) as home_id, max(l_suppkey) as away_id from lineitem group by 1 having min(l_suppkey) < max(l_suppkey)",
    "cal": "select o_orderkey as game_id, cast(o_orderdate as date) as game_date, cast(year(o_orderdate) + case when month(o_orderdate) >= 8 then 1 else 0 end as int) as season, case o_orderpriority when '1-URGENT' then 'POST' when '5-LOW' then 'PRE' else 'REG' end as season_type from orders",
    "st": """select l_orderkey as game_id, l_suppkey as team_id, cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as pts,
      cast(sum(case when l_returnflag = 'R' then 1 end) as bigint) as fgm, cast(sum(cast(l_quantity as bigint)) as bigint) as fga,
      cast(sum(nullif(cast(round(l_tax * 100) as bigint), 0)) as bigint) as tpm, cast(sum(cast(round(l_tax * 100) as bigint) + 1) as bigint) as tpa,
      cast(sum(case when l_linestatus = 'F' then 1 end) as bigint) as ftm, count(*) as fta, count(*) filter (where l_returnflag = 'A') as oreb,
      count(*) filter (where l_returnflag = 'N') as dreb, cast(sum(nullif(cast(round(l_discount * 100) as bigint), 0)) as bigint) as ast,
      cast(min(l_linenumber) as bigint) as stl, cast(max(l_linenumber) as bigint) as blk, count(*) filter (where l_quantity < 10) as tov, count(distinct l_partkey) as pf
      from lineitem group by 1, 2""",
    "games": """select game_id, team_id, pts, fgm, fga, tpm, tpa, ftm, fta, oreb, dreb, ast, stl, blk, tov, pf, game_date, season, season_type, team_id = home_id as is_home,
      case when team_id = home_id then away_id else home_id end as opp_team_id
      from st join pair using (game_id) join cal using (game_id) where team_id in (home_id, away_id)""",
    "sched0": """select *, row_number() over s as gnum, lag(game_date) over s as prev_date, lag(game_date, 2) over s as d2, lag(game_date, 3) over s as d3
      from games window s as (partition by team_id, season order by game_date, game_id)""",
    "sched1": "select *, game_date - prev_date as days_rest from sched0",
    "sched": """select * exclude (d2, d3, gnum, days_rest), cast(gnum as int) as gnum, cast(days_rest as int) as days_rest,
      case when days_rest = 0 then '0D' when days_rest = 1 then 'B2B' when days_rest between 2 and 3 then '2-3D' when days_rest between 4 and 6 then '4-6D' else '7D+' end as rest_bucket,
      days_rest = 0 as is_0in2, days_rest = 1 as is_b2b, days_rest <= 2 and gnum >= 3 and game_date - d2 <= 4 as is_3in4, days_rest <= 2 and gnum >= 4 and game_date - d3 <= 6 as is_4in6,
      avg(pts) over w5 as pts_l5, avg(tov) over w5 as tov_l5, avg(tpm) over w10 as tpm_l10, avg(oreb + dreb) over w10 as reb_l10 from sched1
      window w5 as (partition by team_id order by game_date, game_id rows between 5 preceding and 1 preceding),
        w10 as (partition by team_id order by game_date, game_id rows between 10 preceding and 1 preceding)""",
    "box": """select g.*, o.pts as pts_opp, o.fga as fga_opp, o.fta as fta_opp, o.tpm as tpm_opp, o.tov as tov_opp, o.oreb as oreb_opp, o.dreb as dreb_opp, o.pf as pf_opp,
      cast(case when g.pts is not null and o.pts is not null then cast(g.pts > o.pts as int) end as int) as y_win
      from games g left join games o on o.game_id = g.game_id and o.team_id = g.opp_team_id""",
    "rated0": "select *, cast(fga + 0.44 * fta - oreb + tov as double) as poss_team, cast(fga_opp + 0.44 * fta_opp - oreb_opp + tov_opp as double) as poss_opp from box",
    "rated": """select *, (poss_team + poss_opp) / 2 as poss_game, oreb + dreb as reb, oreb_opp + dreb_opp as reb_opp,
      case when fga <> 0 then least(1.0, greatest(0.0, cast(pts - 0.44 * fta + 0.5 * tpm as double) / fga)) end as efg,
      case when fga_opp <> 0 then least(1.0, greatest(0.0, cast(pts_opp - 0.44 * fta_opp + 0.5 * tpm_opp as double) / fga_opp)) end as efg_opp,
      tov / nullif(poss_team, 0) as tov_pct, tov_opp / nullif(poss_opp, 0) as opp_tov_pct, oreb / nullif(oreb + dreb_opp, 0) as orb_pct, oreb_opp / nullif(oreb_opp + dreb, 0) as opp_orb_pct,
      fta / nullif(fga, 0) as ftr, fta_opp / nullif(fga_opp, 0) as opp_ftr, 100.0 * pts / nullif(poss_team, 0) as ortg, 100.0 * pts_opp / nullif(poss_opp, 0) as drtg_opp from rated0""",
    "formed": """select *, avg(y_win) over w as win_pct_l10, avg(ortg) over w as ortg_l10, avg(drtg_opp) over w as drtg_l10, avg(poss_game) over w as pace_l10, avg(efg) over w as efg_l10,
      avg(tov_pct) over w as tov_pct_l10, avg(orb_pct) over w as orb_pct_l10, avg(ftr) over w as ftr_l10,
      avg(drtg_opp) over (partition by opp_team_id, season, season_type order by game_date, game_id rows between 10 preceding and 1 preceding) as opp_drtg_l10
      from rated window w as (partition by team_id, season, season_type order by game_date, game_id rows between 10 preceding and 1 preceding)""",
    "calf": """select f.*, f.poss_game as pace, s.days_rest, s.rest_bucket, s.is_b2b, s.is_3in4, s.is_4in6, s.gnum, s.prev_date, cast(null as int) as road_trip_len, cast(null as int) as home_stand_len,
      cast(dayofweek(f.game_date) as int) as dow, cast(month(f.game_date) as int) as month from formed f join sched s on s.game_id = f.game_id and s.team_id = f.team_id""",
    "praw": """select l_orderkey as game_id, l_partkey as player_id, l_suppkey as team_id, cast(cast(l_quantity as int) as varchar) || ':' || lpad(cast(l_linenumber * 7 as varchar), 2, '0') as minutes_raw,
      cast(floor(l_extendedprice / 1000) as bigint) as pts, cast(l_returnflag = 'R' as bigint) as fgm, cast(l_quantity as bigint) as fga, cast(round(l_tax * 100) as bigint) as fg3m,
      cast(round(l_tax * 100) as bigint) + 1 as fg3a, cast(l_linestatus = 'F' as bigint) as ftm, cast(1 as bigint) as fta, cast(l_returnflag = 'A' as bigint) as oreb,
      cast(l_returnflag = 'N' as bigint) as dreb, cast(round(l_discount * 100) as bigint) as ast, cast(l_quantity < 10 as bigint) as tov, cast(1 as bigint) as pf from lineitem""",
    "pg": """select p.*, season, season_type, game_date from (
      select game_id, player_id, team_id, max(try_cast(split_part(minutes_raw, ':', 1) as double) + try_cast(split_part(minutes_raw, ':', 2) as double) / 60.0) as minutes, """
    + ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in "pts fgm fga fg3m fg3a ftm fta oreb dreb ast tov pf".split())
    + " from praw group by 1, 2, 3) p left join cal using (game_id)",
    "tot": "select season, player_id, sum(minutes) as mp, "
    + ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in "pts fga fgm fg3a fg3m fta ftm tov ast".split())
    + ", cast(sum(oreb + dreb) as bigint) as trb from pg group by 1, 2",
    "league": "select season, cast(sum(fgm) + 0.5 * sum(tpm) as double) / nullif(cast(sum(fga) as double), 0) as league_efg_mean from games group by 1",
    "shoot": """select t.season, player_id, (2.0 / (1.0 + exp(-(100.0 * fg3a / nullif(mp, 0) * 48.0))) - 1.0) * (case when fg3a = 0 then 0 else fg3m / fg3a end) as shooting_proficiency,
      fg3a * ((case when fg3a = 0 then 0 else fg3m / fg3a end) * 1.5) - league_efg_mean as spacing from tot t left join league l on l.season = t.season""",
    "rates": """select season, player_id, mp, cast(fgm + 0.5 * fg3m as double) / nullif(fga, 0) as efg_pct, pts / nullif(cast(2 * (fga + 0.44 * fta) as double), 0) as ts_pct, fg3a / nullif(fga, 0) as three_par,
      fta / nullif(fga, 0) as ftr, 100.0 * trb / nullif(mp, 0) * 48.0 as trb_per100_min, 100.0 * ast / nullif(mp, 0) * 48.0 as ast_per100_min, 100.0 * tov / nullif(mp, 0) * 48.0 as tov_per100_min from tot""",
    "load0": """select t.season, t.player_id, t.ast, t.tov, t.fga, t.fta, t.ast * 0.1843::double + (t.pts + t.tov) * 0.0969::double - 2.3021::double * coalesce(shooting_proficiency, 0)
      + 0.0582::double * (t.ast * (t.pts + t.tov) * coalesce(shooting_proficiency, 0)) - 1.1942::double as box_creation from tot t left join shoot s on s.season = t.season and s.player_id = t.player_id""",
    "load": "select season, player_id, box_creation, (ast - 0.38::double * box_creation) * 0.75::double + fga + 0.44::double * fta + box_creation + tov as offensive_load from load0",
    "ext": "select season, p_partkey as player_id, "
    + ", ".join(
        f"case when (p_partkey + {k}) % 13 <> 0 then cast((p_partkey * {7 + k} + season + p_size) % 41 as double) / 4 end as {n}"
        for k, n in enumerate("odarko o_lebron o_drip o_bpm o_la3rapm ddarko d_lebron d_drip d_bpm d_la3rapm".split())
    )
    + " from part, (values (1996), (1997), (1998)) y(season)",
    "zext": "select season, player_id, "
    + ", ".join(f"({n} - avg({n}) over s) / nullif(stddev_samp({n}) over s, 0) as z_{n}" for n in "odarko o_lebron o_drip o_bpm o_la3rapm ddarko d_lebron d_drip d_bpm d_la3rapm".split())
    + " from ext window s as (partition by season)",
    "comp": """select season, player_id, (2 * z_odarko + z_o_lebron + z_o_drip + z_o_bpm + z_o_la3rapm) / 6.0 as crafted_opm_z,
      (2 * z_ddarko + z_d_lebron + z_d_drip + z_d_bpm / 2.0 + 2 * z_d_la3rapm) / 6.5 as crafted_dpm_z from zext""",
    "bio": "select p_partkey as player_id, case when p_partkey % 9 <> 0 then cast(p_size % 20 + 70 as double) end as height_inches from part",
    "vers": "select season, p_partkey as player_id, cast((p_partkey * 3 + season) % 100 + 1 as double) as versatility from part, (values (1996), (1997), (1998)) y(season)",
    "pass0": """select l.season, l.player_id, offensive_load as x_l, t.ast / nullif(offensive_load, 0) as x_a, t.tov / nullif(offensive_load, 0) as x_t, box_creation / nullif(offensive_load, 0) as x_b, height_inches as x_h
      from load l left join tot t on t.season = l.season and t.player_id = l.player_id left join bio b on b.player_id = l.player_id""",
    "passer": "select season, player_id, "
    + " + ".join(f"coalesce({w} * (x_{c} - avg(x_{c}) over s) / nullif(stddev_samp(x_{c}) over s, 0), 0)" for c, w in {"l": 1, "a": 3, "t": -2, "b": 0.5, "h": 0.2}.items())
    + " as passer_rating_raw from pass0 window s as (partition by season)",
    "port0": """select r.season, r.player_id, ts_pct, shooting_proficiency, crafted_dpm_z, versatility, passer_rating_raw, offensive_load, box_creation from rates r
      left join shoot using (season, player_id) left join comp using (season, player_id) left join passer using (season, player_id) left join load using (season, player_id) left join vers using (season, player_id)""",
    "port": "select season, player_id, ts_pct + "
    + " + ".join(
        f"({w}) * (({c} - avg({c}) over s) / nullif(stddev_samp({c}) over s, 0))"
        for c, w in {"shooting_proficiency": "2.5", "crafted_dpm_z": "0.5", "versatility": "1.0::double / 3.0::double", "passer_rating_raw": "1.5", "offensive_load": "-0.25", "box_creation": "-0.15"}.items()
    )
    + " as portability_raw from port0 window s as (partition by season)",
    "gm": "select *, oreb + dreb as reb from games",
    "baserows": "select * from gm where season_type = 'REG' and season between (select max(season) from gm where season_type = 'REG') - 1 and (select max(season) from gm where season_type = 'REG')",
    "base": "select " + ", ".join(f"avg({m}) as mean_{m}, stddev_samp({m}) as sd_{m}" for m in METRICS) + " from baserows",
    "cuts": "select " + ", ".join(f"quantile_cont(cast({m} as double), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as q_{m}" for m in METRICS) + " from baserows",
    "ma": "select cast(date_trunc('month', game_date) as date) as ym, season, team_id, " + ", ".join(f"avg({m}) as mean_{m}" for m in METRICS) + " from gm where season_type = 'REG' group by 1, 2, 3",
    "mb": "select cast(date_trunc('month', game_date) as date) as ym, season, team_id, avg(pts_l5) as mean_pts_l5, avg(tpm_l10) as mean_tpm_l10, avg(reb_l10) as mean_reb_l10 from sched group by 1, 2, 3",
    "monthly": "select * from ma full join mb using (ym, season, team_id)",
    "mleague": "select ym, " + ", ".join(f"avg(mean_{m}) as mean_{m}" for m in [*METRICS, "pts_l5", "tpm_l10", "reb_l10"]) + " from monthly group by 1",
    "shift": "select ym, " + ", ".join(f"(m.mean_{m} - b.mean_{m}) / nullif(b.sd_{m}, 0) as z_{m}" for m in METRICS) + " from mleague m, base b",
    "flags": "select *, " + ", ".join(f"abs(z_{m}) >= 3 as flag_{m}" for m in METRICS) + " from shift",
    "bins": " union all ".join(f"select cast(date_trunc('month', g.game_date) as date) as ym, g.season, '{m}' as metric, case when {m} is not null then cast(len(list_filter(q_{m}, lambda q: q < {m})) + 1 as int) end as bin from gm g, cuts where season_type = 'REG'" for m in METRICS),
    "psib": """select metric, bin, cast(count(*) as double) / sum(count(*)) over (partition by metric) as p from bins
      where season between (select max(season) from gm where season_type = 'REG') - 1 and (select max(season) from gm where season_type = 'REG') group by 1, 2""",
    "psim0": "select ym, metric, bin, cast(count(*) as double) / sum(count(*)) over (partition by ym, metric) as q from bins group by 1, 2, 3",
    "psim": "select ym, metric, sum((p - q) * ln(nullif(p, 0) / nullif(q, 0))) as psi from psim0 join psib using (metric, bin) group by 1, 2",
    "raw": """select game_id, team_id, case when game_id % 5 = 0 then 'G' || game_id else cast(game_id as varchar) end as id_raw, case when game_id % 11 = 0 then '' else cast(game_date as varchar) end as date_raw,
      case game_id % 7 when 0 then '' when 1 then ' ' when 2 then pts || '.5' when 3 then 'abc' else cast(pts as varchar) end as pts_raw, coalesce(cast(fgm as varchar), '') as fgm_raw,
      case game_id % 4 when 0 then 'true' when 1 then 'false' when 2 then '' else 'maybe' end as flag_raw,
      case season_type when 'POST' then case when game_id % 2 = 0 then 'Playoffs' else 'post season' end when 'PRE' then case game_id % 3 when 0 then 'pre season' when 1 then 'PRE-SEASON' else '' end
        else case when game_id % 3 = 0 then 'REGULAR SEASON' else ' Regular Season ' end end as label_raw from games""",
}
NEEDS = {
    "games": "pair cal st", "sched0": "games", "sched1": "sched0", "sched": "sched1", "box": "games", "rated0": "box", "rated": "rated0", "formed": "rated", "calf": "formed sched", "pg": "praw cal", "tot": "pg",
    "league": "games", "shoot": "tot league", "rates": "tot", "load0": "tot shoot", "load": "load0", "zext": "ext", "comp": "zext", "pass0": "load tot bio", "passer": "pass0", "port0": "rates shoot comp passer load vers",
    "port": "port0", "gm": "games", "baserows": "gm", "base": "baserows", "cuts": "baserows", "ma": "gm", "mb": "sched", "monthly": "ma mb", "mleague": "monthly", "shift": "mleague base", "flags": "shift", "bins": "gm cuts",
    "psib": "bins", "psim0": "bins", "psim": "psim0 psib", "raw": "games",
}


def _order(names: Iterable[str], done: dict) -> dict:
    for n in names:
        if n not in done:
            _order(NEEDS.get(n, "").split(), done)
            done[n] = None
    return done


def sql(uses: str, body: str, digits: dict[int, str] | None = None, extra: str = "") -> str:
    """body with the named subqueries before it; digits: columns to round, by decimals."""
    parts = [f"{n} as materialized ({CTE[n]})" for n in _order(uses.split(), {})] + ([extra] if extra else [])
    head = f"with {', '.join(parts)} " if parts else ""
    rounded = [f"round({c} + {NUDGE}, {d}) + 0.0 as {c}" for d, cs in (digits or {}).items() for c in cs.split()]
    return f"{head}select * replace ({', '.join(rounded)}) from ({body}) q_" if rounded else f"{head}{body}"
