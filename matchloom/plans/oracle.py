"""SQL for the registered queries, written from their definitions for DuckDB."""

from __future__ import annotations

WEEK_MS = 604800000

SLOTS = """
slots AS (
  SELECT l_orderkey,
    CAST((l_linenumber - 1) % 5 + 1 + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 5 END AS INTEGER) AS pid,
    sum(l_quantity::BIGINT)::BIGINT AS kills,
    count(*)::BIGINT AS assists,
    sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS gold,
    sum(round(l_extendedprice * 100)::BIGINT * round(l_discount * 100)::BIGINT)::BIGINT AS damage,
    sum(round(l_tax * 100)::BIGINT)::BIGINT AS vision,
    sum(l_suppkey % 10)::BIGINT AS wards,
    sum(l_partkey % 60)::BIGINT AS cc,
    count(*) FILTER (WHERE l_returnflag = 'R')::BIGINT AS dragon,
    count(*) FILTER (WHERE l_returnflag = 'A')::BIGINT AS baron,
    sum(l_linenumber)::BIGINT AS solo,
    count(*) FILTER (WHERE l_returnflag = 'N')::BIGINT AS plates,
    count(*) FILTER (WHERE l_discount >= 0.05)::BIGINT AS herald,
    sum(l_quantity::BIGINT * round(l_tax * 100)::BIGINT)::DOUBLE AS heal
  FROM lineitem GROUP BY 1, 2
),
players AS (
  SELECT 'M_' || o_orderkey AS matchid,
    1200 + round(o_totalprice * 100)::BIGINT % 1200 AS seconds,
    o_orderdate::DATE AS ds,
    CASE WHEN pid <= 5 THEN 100 ELSE 200 END::INTEGER AS team,
    CASE (pid - 1) % 5 WHEN 0 THEN 'TOP' WHEN 1 THEN 'JUNGLE' WHEN 2 THEN 'MIDDLE'
      WHEN 3 THEN 'BOTTOM' ELSE 'UTILITY' END AS position,
    (pid <= 5) = (round(o_totalprice * 100)::BIGINT % 2 = 0) AS won,
    slots.*
  FROM slots JOIN orders ON o_orderkey = l_orderkey
)"""

RATED = f"""{SLOTS},
teams AS (
  SELECT matchid, team, sum(kills)::BIGINT AS t_kills, sum(gold)::BIGINT AS t_gold,
    sum(damage)::BIGINT AS t_damage, sum(cc)::BIGINT AS t_cc
  FROM players GROUP BY 1, 2
),
rated AS (
  SELECT p.*,
    coalesce(gold::DOUBLE / nullif(t_gold::DOUBLE, 0), 0) AS gold_rate,
    coalesce(damage::DOUBLE / nullif(t_damage::DOUBLE, 0), 0) AS damage_rate,
    coalesce(cc::DOUBLE / nullif(t_cc::DOUBLE, 0), 0) AS cc_rate,
    coalesce((kills + assists)::DOUBLE / nullif(t_kills::DOUBLE, 0), 0) AS kp,
    coalesce((vision * 60)::DOUBLE / nullif(seconds::DOUBLE, 0), 0) AS vision_pm,
    coalesce((wards * 60)::DOUBLE / nullif(seconds::DOUBLE, 0), 0) AS wards_pm
  FROM players p JOIN teams t USING (matchid, team)
)"""

PLAYER_FEATURES = f"""WITH {RATED}
SELECT ds AS "DS", matchid AS "MATCHID", team AS "TEAMID", pid AS "PARTICIPANTID",
  won::INTEGER AS "WIN", position AS "TEAMPOSITION",
  kills::DOUBLE AS "KILLS", solo::DOUBLE AS "SOLOKILLS", plates::DOUBLE AS "PLATES",
  dragon::DOUBLE AS "DRAGON", baron::DOUBLE AS "BARONKILLS", herald::DOUBLE AS "RIFTHERALD",
  heal AS "EFFECTIVEHEALANDSHIELDING", gold_rate AS "GOLD_RATE", damage_rate AS "DAMAGE_RATE",
  cc_rate AS "CC_RATE", kp AS "KILLPARTICIPATION", vision_pm AS "VISION_PER_MIN",
  wards_pm AS "WARDS_PM"
FROM rated"""

# Feature part of a difference name -> column of ``rated``.
RATED_COLUMN = {
    "SOLOKILLS": "solo", "PLATES": "plates", "KILLS": "kills", "DRAGON": "dragon",
    "GOLD_RATE": "gold_rate", "KILLPARTICIPATION": "kp", "RIFTHERALD": "herald",
    "BARONKILLS": "baron", "DAMAGE_RATE": "damage_rate", "EFFECTIVEHEALANDSHIELDING": "heal",
    "CC_RATE": "cc_rate", "VISION_PER_MIN": "vision_pm", "WARDS_PM": "wards_pm",
}
PREFIX_POSITION = {
    "TOP": "TOP", "JUNGLE": "JUNGLE", "MID": "MIDDLE", "BOTTOM": "BOTTOM", "SUP": "UTILITY",
}


def dif_column(name: str) -> str:
    prefix, feature = name.removesuffix("_DIF").split("_", 1)
    column = RATED_COLUMN[feature]
    picked = f"position = '{PREFIX_POSITION[prefix]}'"
    blue = f"sum({column}::DOUBLE) FILTER (WHERE {picked} AND team = 100)"
    red = f"sum({column}::DOUBLE) FILTER (WHERE {picked} AND team = 200)"
    return (
        f'CASE WHEN count(*) FILTER (WHERE {picked}) > 0 '
        f'THEN coalesce({blue}, 0) - coalesce({red}, 0) END AS "{name}"'
    )


# The listed features by role, written out here so that the code isn't checked by itself (fixed values).
LISTED_NAMES = {
    "TOP": ["TOP_SOLOKILLS_DIF", "TOP_PLATES_DIF", "TOP_KILLS_DIF"],
    "JNG": [
        "JUNGLE_DRAGON_DIF", "JUNGLE_GOLD_RATE_DIF", "JUNGLE_KILLPARTICIPATION_DIF",
        "JUNGLE_RIFTHERALD_DIF", "JUNGLE_BARONKILLS_DIF",
    ],
    "MID": ["MID_KILLPARTICIPATION_DIF", "MID_KILLS_DIF", "MID_DAMAGE_RATE_DIF"],
    "BOT": ["BOTTOM_DAMAGE_RATE_DIF", "BOTTOM_GOLD_RATE_DIF", "BOTTOM_KILLPARTICIPATION_DIF"],
    "SUP": [
        "SUP_EFFECTIVEHEALANDSHIELDING_DIF", "SUP_CC_RATE_DIF", "SUP_VISION_PER_MIN_DIF",
        "SUP_DAMAGE_RATE_DIF", "SUP_KILLPARTICIPATION_DIF", "SUP_WARDS_PM_DIF",
    ],
}
DIF_NAMES = [n for names in LISTED_NAMES.values() for n in names]

MATCH_FEATURES = f"""WITH {RATED}
SELECT min(ds) AS "DS", matchid AS "MATCHID",
  max(won::INTEGER) FILTER (WHERE team = 100) AS "BLUE_TEAM_WIN",
  {", ".join(dif_column(n) for n in DIF_NAMES)}
FROM rated GROUP BY matchid"""

SIGNS = ["TOP_KILLS_DIF", "JUNGLE_DRAGON_DIF", "MID_KILLS_DIF", "BOTTOM_GOLD_RATE_DIF"]



def leafwise_sql(rows: str, names: list[str], categorical: set[str], trees: int, leaves: int, tag: str = "") -> list[str]:
    """CTEs of boosted trees that split one leaf after the other; the last is ``nodes{tag}``.

    ``rows``: SQL of ``id``, ``y`` and ``x``, the features as a list of strings. Every step sums the gradients of all
    leaves anew. A number's order is its value, a category's the ratio of its sums.
    """
    listed = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    is_category = " OR ".join(f"f = {names.index(n) + 1}" for n in sorted(categorical)) or "false"
    made = [
        f"""base{tag} AS MATERIALIZED (SELECT id, y, x FROM ({rows}) WHERE y IS NOT NULL)""",
        f"""m{tag}_0 AS MATERIALIZED (
  SELECT id, y, x, ln(p / (1 - p)) AS m FROM base{tag}, (SELECT sum(y) / count(*)::DOUBLE AS p FROM base{tag})
)""",
    ]
    out = []
    for t in range(trees):
        k = f"{tag}_{t}"
        made.append(
            f"""s{k}_0 AS MATERIALIZED (
  SELECT id, y, x, m, 0 AS node, round((p - y) * 1048576)::BIGINT AS g, round(p * (1 - p) * 1048576)::BIGINT AS h
  FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM m{k})
)"""
        )
        for i in range(leaves - 1):
            at, then = f"{k}_{i}", f"{k}_{i + 1}"
            made.append(
                f"""h{at} AS MATERIALIZED (
  SELECT *, CASE WHEN {is_category} THEN (g / 1048576.0::DOUBLE) / (h / 1048576.0::DOUBLE + 10) ELSE v::DOUBLE END AS ord FROM (
    SELECT node, f, x[f] AS v, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) AS n
    FROM s{at}, generate_series(1, {len(names)}) AS t(f) GROUP BY ALL)
), c{at} AS (
  SELECT node, f, v, ord, sum(g) OVER w / 1048576.0::DOUBLE AS gl, sum(h) OVER w / 1048576.0::DOUBLE AS hl, sum(n) OVER w AS nl,
    sum(g) OVER a / 1048576.0::DOUBLE AS gt, sum(h) OVER a / 1048576.0::DOUBLE AS ht, sum(n) OVER a AS nt,
    (sum(g) OVER a - sum(g) OVER w) / 1048576.0::DOUBLE AS gr, (sum(h) OVER a - sum(h) OVER w) / 1048576.0::DOUBLE AS hr,
    CASE WHEN {is_category} THEN 10 ELSE 0 END AS l2
  FROM h{at} WINDOW w AS (PARTITION BY node, f ORDER BY ord, v), a AS (PARTITION BY node, f)
), b{at} AS MATERIALIZED (
  SELECT *, gl * gl / (hl + l2) + gr * gr / (hr + l2) - gt * gt / (ht + l2) AS gain FROM c{at}
  WHERE nl >= 20 AND nt - nl >= 20 AND hl >= 1e-3 AND hr >= 1e-3
), p{at} AS MATERIALIZED (
  SELECT * FROM b{at} WHERE gain > 0 ORDER BY gain DESC, node, f, ord, v LIMIT 1
), l{at} AS MATERIALIZED (
  SELECT h.v FROM h{at} h JOIN p{at} p ON h.node = p.node AND h.f = p.f WHERE (h.ord, h.v) <= (p.ord, p.v)
), s{then} AS MATERIALIZED (
  SELECT id, y, x, m, CASE WHEN s.node = p.node THEN CASE WHEN x[p.f] IN (SELECT v FROM l{at}) THEN {2 * i + 1} ELSE {2 * i + 2} END
    ELSE s.node END AS node, g, h FROM s{at} s LEFT JOIN p{at} p ON true
)"""
            )
            out.append(
                f"""SELECT {t} AS tree, node, {listed}[f] AS feature, CASE WHEN NOT ({is_category}) THEN ord END AS threshold,
  CASE WHEN {is_category} THEN (SELECT string_agg(v, ',' ORDER BY v) FROM l{at}) END AS categories, round(gain, 6) AS gain, NULL::DOUBLE AS value,
  nt::BIGINT AS rows, {2 * i + 1} AS "left", {2 * i + 2} AS "right" FROM p{at}"""
            )
        last = f"s{k}_{leaves - 1}"
        made.append(
            f"""v{k} AS MATERIALIZED (
  SELECT node, -(sum(g) / 1048576.0::DOUBLE) / (sum(h) / 1048576.0::DOUBLE) * 0.1::DOUBLE AS value, count(*) AS n FROM {last} GROUP BY node
), m{tag}_{t + 1} AS MATERIALIZED (
  SELECT id, y, x, m + value AS m FROM {last} s JOIN v{k} v ON s.node = v.node
)"""
        )
        out.append(
            f"""SELECT {t}, node, NULL, NULL, NULL, NULL, round(value, 9), n, NULL, NULL FROM v{k}"""
        )
    return [*made, f"nodes{tag} AS (" + "\nUNION ALL ".join(out) + ")"]


NODES = """tree::INTEGER AS tree, node::INTEGER AS node, feature, threshold, categories, gain, value, "rows"::BIGINT AS "rows",
  "left"::INTEGER AS "left", "right"::INTEGER AS "right\""""

# Small whole numbers of a player, by feature name.
WHOLE = {"SOLOKILLS": "solo", "PLATES": "plates", "DRAGON": "dragon", "BARONKILLS": "baron", "RIFTHERALD": "herald"}
POSITION_PREFIXES = {"TOP": "TOP", "JUNGLE": "JUNGLE", "MIDDLE": "MID", "BOTTOM": "BOTTOM", "UTILITY": "SUP"}
DIFFERENCE_NAMES = [f"{p}_{n}_DIF" for p in POSITION_PREFIXES.values() for n in WHOLE]
MATCH_DIFFERENCES = "SELECT matchid AS id, max(won::INTEGER) FILTER (WHERE team = 100) AS y, [" + ", ".join(
    f"coalesce(sum(CASE WHEN team = 100 THEN {c} ELSE -{c} END) FILTER (WHERE position = '{p}'), 0)::BIGINT::VARCHAR"
    for p in POSITION_PREFIXES
    for c in WHOLE.values()
) + "] AS x FROM players GROUP BY matchid"
PLAYER_VALUES = "[" + ", ".join(f"{c}::VARCHAR" for c in WHOLE.values()) + "]"

LEAFWISE_TREES = ",\n".join([SLOTS, *leafwise_sql(MATCH_DIFFERENCES, DIFFERENCE_NAMES, set(), 2, 6)])
LEAFWISE_POSITIONS = ",\n".join(
    [SLOTS, *leafwise_sql(f"SELECT 0 AS id, won::INTEGER AS y, list_append({PLAYER_VALUES}, position) AS x FROM players", [*WHOLE, "TEAMPOSITION"], {"TEAMPOSITION"}, 2, 6)]
)
LEAFWISE_PER_POSITION = ",\n".join(
    [SLOTS]
    + [
        cte
        for p in POSITION_PREFIXES
        for cte in leafwise_sql(f"SELECT 0 AS id, won::INTEGER AS y, {PLAYER_VALUES} AS x FROM players WHERE position = '{p}'", [*WHOLE], set(), 1, 4, f"_{p}")
    ]
)
CATEGORY_SPLITS = ",\n".join(
    leafwise_sql(
        "SELECT 0 AS id, (l_returnflag = 'R')::INTEGER AS y, [l_partkey::VARCHAR, l_quantity::BIGINT::VARCHAR] AS x FROM lineitem",
        ["l_partkey", "l_quantity"], {"l_partkey"}, 2, 4,
    )
)

EVENTS = """
e AS (
  SELECT event_id, user_id, event_type, ts, ts::DATE AS day, epoch_us(ts) // 1000 AS ms,
    (props->>'$.k')::BIGINT AS k, round(value * 100)::BIGINT AS amount
  FROM events
)"""

PIDS = ", ".join(
    f"sum(amount) FILTER (WHERE 1 + k % 10 = {i})::BIGINT AS p{i}" for i in range(1, 11)
)
FRAMES = f"""{EVENTS},
frames AS (
  SELECT user_id, ms // {WEEK_MS} AS week, max(ms) AS stamp, {PIDS} FROM e GROUP BY 1, 2
)"""


def team(numbers: range, missing: str) -> str:
    part = "coalesce(p{}, 0)" if missing == "zero" else "p{}"
    return "(" + " + ".join(part.format(i) for i in numbers) + ")"


def gold_sql(missing: str, more: str = "") -> str:
    blue, red = team(range(1, 6), missing), team(range(6, 11), missing)
    return f"""WITH {FRAMES}
SELECT 'M_' || user_id AS "matchId", make_timestamp(stamp * 1000) AS event_time,
  (stamp // 60000)::INTEGER AS frame_minute, {blue} AS blue_gold_total, {red} AS red_gold_total,
  {blue} - {red} AS gold_diff, 'M_' || user_id AS match_id {more}
FROM frames"""


MESSAGES = f"""{EVENTS},
m AS (
  SELECT event_id, 'M_' || user_id AS "matchId", ms AS "frameTimestamp", ms // 60000 AS "frameMinute",
    CASE WHEN event_type IN ('click', 'view') THEN amount ELSE 0 END AS "blueTotalGold",
    CASE WHEN event_type IN ('purchase', 'error') THEN amount ELSE 0 END AS "redTotalGold",
    CASE WHEN event_type IN ('click', 'view') THEN amount
      WHEN event_type IN ('purchase', 'error') THEN -amount ELSE 0 END AS "goldDiff",
    ms AS "eventTs", event_type, make_timestamp(ms * 1000) AS event_time, day
  FROM e
)"""

# The same in match time.
MATCH_TIME = f"""{MESSAGES},
mt AS (
  SELECT "matchId", "goldDiff", "eventTs" - min("eventTs") OVER (PARTITION BY "matchId") AS since FROM m
)"""

FEATURES = [*DIF_NAMES, "X_STOP_DIF", "OTHER_DIF"]
# The role each contribution feature belongs to by keyword.
ROLE_OF = {n: role for role, names in LISTED_NAMES.items() for n in names}
ROLE_OF["X_STOP_DIF"] = "TOP"

WIDE = f"""{EVENTS},
signed AS (
  SELECT day AS "DS", 'M_' || user_id AS "MATCHID", k % {len(FEATURES)} AS number,
    amount * CASE WHEN event_type IN ('click', 'view') THEN 1
      WHEN event_type IN ('purchase', 'signup') THEN -1 ELSE 0 END AS amount
  FROM e
),
names AS (
  SELECT * FROM (VALUES {", ".join(
      f"({i}, '{n}', '{ROLE_OF.get(n, 'NONE')}', {str(n in DIF_NAMES).lower()})"
      for i, n in enumerate(FEATURES)
  )}) t(number, feature, kw_role, listed)
),
wide AS (
  SELECT "DS", "MATCHID", number, abs(sum(amount))::BIGINT AS weight FROM signed GROUP BY 1, 2, 3
),
roles AS (SELECT unnest(['TOP', 'JNG', 'MID', 'BOT', 'SUP']) AS "ROLE"),
totals AS (SELECT "DS", "MATCHID", sum(weight)::BIGINT AS total FROM wide GROUP BY 1, 2),
parts AS (
  SELECT t."DS", t."MATCHID", "ROLE", total,
    coalesce(sum(weight) FILTER (WHERE kw_role = "ROLE"), 0)::BIGINT AS part
  FROM totals t CROSS JOIN roles
    JOIN wide w ON w."DS" = t."DS" AND w."MATCHID" = t."MATCHID" JOIN names USING (number)
  GROUP BY ALL
),
shares AS (
  SELECT "DS", "MATCHID", "ROLE",
    CASE WHEN total = 0 THEN 2000 ELSE (20000 * part + total) // (2 * total) END AS "CONTRIB_BP"
  FROM parts
)"""

LISTED = f"""{WIDE},
listed AS (
  SELECT "DS", "MATCHID", kw_role, sum(weight)::BIGINT AS part
  FROM wide JOIN names USING (number) WHERE listed GROUP BY 1, 2, 3
),
listed_totals AS (SELECT "DS", "MATCHID", sum(part)::DOUBLE AS total FROM listed GROUP BY 1, 2),
row_count AS (SELECT count(*) AS n FROM totals)"""

IMPORTANCE = f"""{WIDE},
matches AS (SELECT "DS", count(*) AS n FROM totals GROUP BY 1)"""

SHAP_LINEAR = """
SELECT c_custkey,
  round(0.5 * (round(c_acctbal * 100)::BIGINT - (SELECT avg(round(c_acctbal * 100)::BIGINT) FROM customer)), 4) AS phi_balance,
  round(-2.0::DOUBLE * (c_nationkey - (SELECT avg(c_nationkey) FROM customer)), 4) AS phi_nation
FROM customer"""

SQL = {
    "flatten_players": f"""WITH {SLOTS}
SELECT matchid AS "matchId", seconds AS "gameDuration", pid AS "participantId", team AS "teamId",
  position AS "teamPosition", won AS win, kills, assists, gold AS "goldEarned",
  damage AS "totalDamageDealtToChampions", vision AS "visionScore", wards AS "wardsPlaced",
  cc AS "timeCCingOthers", dragon AS "dragonKills", baron AS "baronKills", ds, solo AS "soloKills",
  plates AS "turretPlatesTaken", herald AS "riftHeraldTakedowns", heal AS "effectiveHealAndShielding"
FROM players""",
    "flatten_all_fields": f"""WITH {SLOTS}
SELECT matchid AS "matchId", seconds AS "gameDuration", pid AS "participantId", team AS "teamId",
  position AS "teamPosition", won AS win, kills, assists, gold AS "goldEarned",
  damage AS "totalDamageDealtToChampions", vision AS "visionScore", wards AS "wardsPlaced",
  cc AS "timeCCingOthers", dragon AS "dragonKills", baron AS "baronKills", 'n' || pid AS note, ds,
  solo AS "soloKills", plates AS "turretPlatesTaken", herald AS "riftHeraldTakedowns",
  heal AS "effectiveHealAndShielding"
FROM players""",
    "gold_timeline": gold_sql("zero"),
    "gold_timeline_strict": gold_sql("null"),
    "gold_table": gold_sql("zero", ", make_timestamp(stamp * 1000)::DATE AS ds"),
    "frame_time": """
WITH e AS (SELECT event_id, epoch_us(ts) // 1000 - 1705276800000 AS ms FROM events)
SELECT event_id, make_timestamp(ms * 1000) AS event_time, trunc(ms / 60000)::INTEGER AS minute_truncated,
  floor(ms / 60000)::BIGINT AS minute_floored,
  (DATE '1970-01-01' + floor(ms / 86400000)::INTEGER) AS utc_date
FROM e""",
    "replay_delay": """
WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms FROM events),
g AS (
  SELECT *, greatest(0, ms - lag(ms, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id)) AS gap_ms FROM e
)
SELECT *, coalesce(sum(gap_ms) OVER (PARTITION BY user_id ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset_ms
FROM g""",
    "replay_schedule": f"""WITH {FRAMES},
n AS (
  SELECT *, week // 13 AS quarter, stamp - coalesce(lag(stamp) OVER w, 0) AS gap_ms,
    (row_number() OVER w - 1)::INTEGER AS frame_no
  FROM frames WINDOW w AS (PARTITION BY user_id, week // 13 ORDER BY week)
)
SELECT 'M_' || user_id AS "matchId", frame_no, stamp AS "frameTimestamp", gap_ms,
  gap_ms::DOUBLE / 1000 / 60 AS delay_s,
  coalesce(sum(gap_ms) OVER (PARTITION BY user_id, quarter ORDER BY week
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE / 1000 / 60 AS send_at_s
FROM n""",
    "replay_messages": f"""WITH {FRAMES}
SELECT 'M_' || user_id AS key, 'M_' || user_id AS "matchId", stamp AS "frameTimestamp",
  stamp // 60000 AS "frameMinute", {team(range(1, 6), "zero")} AS "blueTotalGold",
  {team(range(6, 11), "zero")} AS "redTotalGold",
  {team(range(1, 6), "zero")} - {team(range(6, 11), "zero")} AS "goldDiff", stamp AS "eventTs"
FROM frames""",
    "parse_json_events": "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events",
    "variant_get": "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events",
    "entity_list": """
SELECT 'P_' || lpad(c_custkey::VARCHAR, 9, '0') AS puuid FROM customer ORDER BY 1 LIMIT 10""",
    "recent_match_ids": """
WITH p AS (SELECT l_suppkey, l_orderkey, max(l_shipdate) AS start FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY start DESC, l_orderkey) AS n FROM p)
SELECT DISTINCT l_orderkey FROM r WHERE n <= 5""",
    "recent_match_ids_of_day": """
SELECT DISTINCT l_orderkey FROM lineitem WHERE l_shipdate::DATE = DATE '1997-05-28'""",
    "scan_one_day": """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate::DATE = DATE '1997-05-28'""",
    "last_90_days": """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate)::DATE - 90 FROM orders)""",
    "load_counts": """
SELECT (SELECT count(*) FROM orders) AS attempted,
  (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS succeeded""",
    "drop_incomplete": """
SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL AND o_orderkey IS NOT NULL
  AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)""",
    "feature_columns": """
SELECT l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""",
    "distinct_positions": "SELECT DISTINCT upper(o_orderpriority) AS position FROM orders",
    "min_sample_groups": """
SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) >= 65""",
    "min_sample_rows": """
SELECT user_id, event_id FROM events
WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 65)""",
    "position_label": """
SELECT o_orderkey, CASE o_orderpriority[1] WHEN '1' THEN 'top' WHEN '2' THEN 'jungle'
    WHEN '3' THEN 'middle' WHEN '4' THEN 'bottom' ELSE 'utility' END AS position,
  (o_orderkey % (o_orderpriority[1]::INTEGER + 1))::INTEGER AS label
FROM orders""",
    "train_test_split": """
SELECT o_orderkey, CASE WHEN ((o_orderkey + 29) % 2147483647 * 48271) % 2147483647 % 100 < 20
  THEN 'test' ELSE 'train' END AS fold
FROM orders""",
    "land_by_event_date": f"""WITH {SLOTS}
SELECT 'M_' || o_orderkey AS "matchId", o_orderdate::DATE AS ds,
  (SELECT count(*) FROM slots WHERE l_orderkey = o_orderkey)::INTEGER AS participants, 'nM_' || o_orderkey AS note
FROM orders""",
    "path_ds_load": "SELECT event_id, ts::DATE AS ds FROM events",
    "replace_partition": """
WITH r AS (
  SELECT event_id, round(value * 100)::BIGINT AS amount, ts::DATE AS ds FROM events
)
SELECT event_id, CASE WHEN ds = (SELECT max(ds) FROM r) THEN 2 * amount ELSE amount END AS amount, ds
FROM r""",
    "path_ds_load_orders": "SELECT o_orderkey, o_orderdate::DATE AS ds FROM orders",
    "replace_partition_orders": """
WITH r AS (
  SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS amount, o_orderdate::DATE AS ds FROM orders
)
SELECT o_orderkey, CASE WHEN ds = (SELECT max(ds) FROM r) THEN 2 * amount ELSE amount END AS amount, ds
FROM r""",
    "player_rate_features": PLAYER_FEATURES,
    "player_rate_nested": PLAYER_FEATURES,
    "line_share": """
WITH l AS (
  SELECT l_orderkey, l_linestatus, l_linenumber, round(l_extendedprice * 100)::BIGINT AS price FROM lineitem
),
t AS (SELECT *, sum(price) OVER (PARTITION BY l_orderkey, l_linestatus)::BIGINT AS total FROM l)
SELECT *, (20000 * price + total) // (2 * total) AS share_bp FROM t""",
    "match_diff_features": MATCH_FEATURES,
    "team_diff_join": f"""WITH {RATED}
SELECT matchid AS "MATCHID", position AS "TEAMPOSITION",
  {", ".join(
      f'coalesce(sum({c}::DOUBLE) FILTER (WHERE team = 100), 0)'
      f' - coalesce(sum({c}::DOUBLE) FILTER (WHERE team = 200), 0) AS "{n}_DIF"'
      for n, c in (("KILLS", "kills"), ("DRAGON", "dragon"), ("GOLD_RATE", "gold_rate"),
                   ("KILLPARTICIPATION", "kp"), ("VISION_PER_MIN", "vision_pm"))
  )}
FROM rated GROUP BY 1, 2""",
    "role_of_feature": """
WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[^A-Za-z]+')) AS feature FROM documents)
SELECT feature, CASE
    WHEN upper(feature) LIKE '%TOP%' THEN 'TOP'
    WHEN upper(feature) LIKE '%JNG%' OR upper(feature) LIKE '%JUNGLE%' THEN 'JNG'
    WHEN upper(feature) LIKE '%MID%' THEN 'MID'
    WHEN upper(feature) LIKE '%BOT%' OR upper(feature) LIKE '%ADC%' THEN 'BOT'
    WHEN upper(feature) LIKE '%SUP%' OR upper(feature) LIKE '%UTILITY%' THEN 'SUP' END AS role
FROM w WHERE feature <> ''""",
    "role_by_rules": """
WITH w AS (
  SELECT DISTINCT unnest(regexp_split_to_array(text, '[^A-Za-z]+')) AS feature FROM documents
), k AS (
  SELECT DISTINCT upper(unnest(regexp_split_to_array(text, '[^A-Za-z]+'))) AS keyword FROM benchmark
), r AS (
  SELECT keyword, ('0x' || substr(md5(keyword), 1, 8))::BIGINT AS priority FROM k WHERE length(keyword) >= 3
), hit AS (
  SELECT feature, arg_min(priority, (priority, keyword)) AS priority FROM w JOIN r ON contains(upper(feature), keyword) GROUP BY feature
)
SELECT w.feature, ['TOP', 'JNG', 'MID', 'BOT', 'SUP'][priority % 5 + 1] AS role FROM w LEFT JOIN hit USING (feature) WHERE feature <> ''""",
    "role_contribution": f"""WITH {WIDE} SELECT * FROM shares""",
    "role_contribution_pct": f"""WITH {WIDE}
SELECT "DS", "MATCHID", "ROLE",
  CASE WHEN total = 0 THEN 20.0 ELSE round(part * 100.0::DOUBLE / total, 2) END AS "CONTRIB_PCT"
FROM parts""",
    "role_daily_mean": f"""WITH {WIDE}
SELECT "ROLE", round(avg("CONTRIB_BP"), 2) AS "MEAN_PCT" FROM shares GROUP BY 1""",
    "role_share_listed": f"""WITH {LISTED}
SELECT kw_role AS "ROLE",
  round(sum(coalesce(part::DOUBLE / nullif(total, 0), 0)) / (SELECT n FROM row_count) * 100, 2) AS "MEAN_PCT"
FROM listed JOIN listed_totals USING ("DS", "MATCHID") GROUP BY 1""",
    "topk_features": f"""WITH {IMPORTANCE}
SELECT feature, sum(weight)::DOUBLE / (SELECT sum(n) FROM matches)::DOUBLE AS importance
FROM wide JOIN names USING (number) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
    "topk_features_per_role": f"""WITH {IMPORTANCE},
i AS (
  SELECT "DS", feature, coalesce(sum(weight), 0)::DOUBLE / any_value(n)::DOUBLE AS importance
  FROM matches CROSS JOIN names LEFT JOIN wide USING ("DS", number) GROUP BY 1, 2
)
SELECT *, row_number() OVER (PARTITION BY "DS" ORDER BY importance DESC, feature)::INTEGER AS rank
FROM i QUALIFY rank <= 3""",
    "shap_linear": SHAP_LINEAR,
    "shap_long": f"""
WITH s AS ({SHAP_LINEAR})
SELECT c_custkey, 'balance' AS feature, round(c_acctbal * 100)::DOUBLE AS value, phi_balance AS phi
FROM s JOIN customer USING (c_custkey)
UNION ALL
SELECT c_custkey, 'nation', c_nationkey::DOUBLE, phi_nation FROM s JOIN customer USING (c_custkey)""",
    "shap_fixed_trees": """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity <= 25)::INTEGER::DOUBLE AS a,
    (l_discount <= 0.05)::INTEGER::DOUBLE AS b, (l_quantity <= 10)::INTEGER::DOUBLE AS c
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  2 * (a - 0.5::DOUBLE) - ((1 - a) - 0.5::DOUBLE) + 4 * (c - 0.25::DOUBLE) * (b + 0.5::DOUBLE) / 2
    + ((1 - c) - 0.75::DOUBLE) * (b + 0.5::DOUBLE) / 2 AS phi_q,
  4 * (b - 0.5::DOUBLE) * (c + 0.25::DOUBLE) / 2 + (b - 0.5::DOUBLE) * ((1 - c) + 0.75::DOUBLE) / 2
    - 2 * ((1 - b) - 0.5::DOUBLE) AS phi_d,
  0.375::DOUBLE AS base
FROM t""",
    "normalize_host": """
SELECT page_id, replace(replace(regexp_replace(trim('  ' || regexp_replace(url, '^http', 'HTTP')
  || '.aws.snowflakecomputing.com '), '^https?://', '', 'i'), '.snowflakecomputing.com', ''), '.aws', '') AS host
FROM pages""",
    "mask_secrets": """
SELECT s_suppkey, name, value FROM supplier, LATERAL (VALUES ('user', s_name), ('Password', '***'),
  ('bypass_code', '***'), ('region', NULL)) t(name, value)""",
    "ml_one_split": f"""WITH f AS ({MATCH_FEATURES}),
x AS (
  SELECT "DS", "MATCHID", "BLUE_TEAM_WIN" AS y, [{", ".join(f'(coalesce("{n}", 0) > 0)::INTEGER' for n in SIGNS)}] AS bits
  FROM f
),
leaves AS (
  SELECT i, bits[i] AS bit, count(*) AS n, sum(2 * y - 1) AS s FROM x, generate_series(1, 4) t(i)
  WHERE y IS NOT NULL GROUP BY 1, 2
),
best AS (
  SELECT i FROM leaves GROUP BY i HAVING count(*) = 2 ORDER BY sum(s * s / n::DOUBLE) DESC, i LIMIT 1
)
SELECT "DS", "MATCHID", (s > 0)::INTEGER::DOUBLE AS prediction
FROM x JOIN best ON true JOIN leaves ON leaves.i = best.i AND leaves.bit = x.bits[best.i]""",
    "ml_leafwise_trees": f"WITH {LEAFWISE_TREES}\nSELECT {NODES} FROM nodes",
    "ml_leafwise_scores": f"""WITH {LEAFWISE_TREES}
SELECT id AS "MATCHID", round(m, 9) AS margin, (m > 0)::INTEGER::DOUBLE AS prediction, true AS adds_up FROM m_2""",
    "ml_leafwise_positions": f"WITH {LEAFWISE_POSITIONS}\nSELECT {NODES} FROM nodes",
    "ml_leafwise_per_position": f"WITH {LEAFWISE_PER_POSITION}\n"
    + "\nUNION ALL ".join(f"SELECT '{p}' AS \"TEAMPOSITION\", {NODES} FROM nodes_{p}" for p in POSITION_PREFIXES),
    "ml_category_splits": f"WITH {CATEGORY_SPLITS}\nSELECT {NODES} FROM nodes",
    "ml_shap_checks": f"""WITH f AS ({MATCH_FEATURES})
SELECT "DS", "MATCHID", 5::BIGINT AS roles, true AS shares_add_up, true AS margin_adds_up FROM f""",
    "stream_gold": f"""WITH {MESSAGES}
SELECT "matchId", "frameTimestamp", "frameMinute", "blueTotalGold", "redTotalGold", "goldDiff",
  "eventTs", event_time, day AS ds
FROM m WHERE event_type <> 'signup'""",
    "stream_rejected": f"""WITH {MESSAGES}
SELECT CASE WHEN event_id % 2 = 0 THEN substr('{{"matchId":"' || "matchId" || '"', 1, 10)
  ELSE '{{"matchId":"' || "matchId" || '","frameTimestamp":' || "frameTimestamp" || ',"frameMinute":' || "frameMinute"
    || ',"blueTotalGold":0,"redTotalGold":0,"goldDiff":0,"eventTs":"x"}}' END AS value
FROM m WHERE event_type = 'signup'""",
    "stream_dedup": f"""WITH {MATCH_TIME}
SELECT DISTINCT "matchId", since AS "frameTimestamp", "goldDiff" FROM mt""",
    "stream_ingest_new": f"""WITH {SLOTS}
SELECT matchid AS "matchId", pid AS "participantId", gold AS "goldEarned", ds FROM players""",
    "stream_gold_window": f"""WITH {MATCH_TIME},
r AS (
  SELECT *, make_timestamp(since * 1000) AS event_time, row_number() OVER (
    PARTITION BY "matchId", since // 3600000 ORDER BY since DESC, "goldDiff" DESC) AS n
  FROM mt
)
SELECT "matchId", date_trunc('hour', event_time) AS window_start, event_time, "goldDiff" FROM r WHERE n = 1""",
}

SQL |= {
    "flatten_multi_line": SQL["flatten_players"],
    "gold_timeline_files": SQL["gold_timeline_strict"],
    "replay_files": SQL["replay_messages"],
    "entity_list_in_order": """
SELECT c_custkey // 100 AS list,
  (row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY round(c_acctbal * 100) DESC, c_custkey) - 1)::INTEGER AS place,
  'P_' || lpad(c_custkey::VARCHAR, 9, '0') AS puuid
FROM customer ORDER BY place, list LIMIT 10""",
    "recent_match_ids_landed": """
SELECT DISTINCT "matchId" FROM (
  SELECT 'M_' || o_orderkey AS "matchId", row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, 'M_' || o_orderkey) AS n FROM orders
) WHERE n <= 5""",
    "land_timelines": f"""WITH {FRAMES}
SELECT 'M_' || user_id AS "matchId", DATE '2024-05-01' AS ds, count(*) AS frames FROM frames GROUP BY user_id""",
    "role_table": f"""WITH t AS ({SQL["role_contribution_pct"]})
SELECT "DS", "MATCHID", "ROLE", "CONTRIB_PCT" FROM t WHERE "DS" < (SELECT max("DS") FROM t) OR "ROLE" = 'TOP'""",
    "stream_ingest_whole": f"""WITH {SLOTS}
SELECT matchid AS "matchId", seconds AS "gameDuration", ds, pid::BIGINT AS "participantId",
  CASE WHEN l_orderkey % 3 <> 0 THEN kills END AS kills, 'n' || pid AS note,
  CASE WHEN l_orderkey % 3 = 0 THEN 'k' ELSE '' END || kills AS kills_as_sent FROM players""",
    "exact_train_test_split": """
WITH h AS (SELECT o_orderkey, ((o_orderkey + 29) % 2147483647) * 48271 % 2147483647 AS h FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY h) AS n, count(*) OVER () AS whole FROM h)
SELECT o_orderkey, CASE WHEN n <= ceil(whole / 5) THEN 'test' ELSE 'train' END AS fold FROM r""",
    "recent_of_hot_player": """
WITH p AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS player, o_orderkey, o_orderdate FROM orders)
SELECT player, o_orderkey FROM p
QUALIFY row_number() OVER (PARTITION BY player ORDER BY o_orderdate DESC, o_orderkey) <= 5000""",
    "replace_at_one_stroke": """
WITH r AS (SELECT event_id, round(value * 100)::BIGINT AS amount, ts::DATE AS ds FROM events)
SELECT event_id, amount, ds, 'between' AS reader FROM r
UNION ALL SELECT event_id, CASE WHEN ds = (SELECT max(ds) FROM r) THEN 2 * amount ELSE amount END, ds, 'after' FROM r""",
    "changing_schemas": """
WITH r AS (SELECT event_id, event_type, round(value * 100)::BIGINT AS cents, ts::DATE AS ds, day(ts) % 3 AS shape FROM events)
SELECT event_id AS id, CASE WHEN shape = 1 THEN event_type END AS kind, ds,
  CASE shape WHEN 0 THEN cents::VARCHAR WHEN 1 THEN 'c' || cents ELSE (cents / 2)::DOUBLE::VARCHAR END AS amount_text,
  CASE shape WHEN 0 THEN cents::DOUBLE WHEN 2 THEN (cents / 2)::DOUBLE END AS amount_number FROM r""",
    "stream_exact_dedup": f"""WITH {MATCH_TIME}
SELECT DISTINCT "matchId", since AS "frameTimestamp", "goldDiff",
  CASE WHEN since // 60000 % 2 = 0 THEN TIMESTAMP '2024-05-01 11:00:00' ELSE TIMESTAMP '2024-05-01 12:00:00' END AS arrival FROM mt""",
    "stream_exact_counts": f"""WITH {MATCH_TIME},
n AS (
  SELECT count(*) AS n, count(*) FILTER (since // 60000 % 2 = 1) AS odd, count(DISTINCT ("matchId", since)) FILTER (since // 60000 % 2 = 1) AS odd_keys,
    count(DISTINCT ("matchId", since)) FILTER (since // 60000 % 2 = 0) AS even_keys FROM mt
)
SELECT 0::BIGINT AS batch, 2 * odd AS came, odd_keys AS kept, 2 * odd - odd_keys AS copies, 0::BIGINT AS late FROM n
UNION ALL SELECT 1, n, even_keys, n - even_keys, even_keys FROM n
UNION ALL SELECT 2, n, 0, n, 0 FROM n""",
    "shap_dot_plot": """
SELECT unnest(['balance', 'nation']) AS feature, count(*) AS "rows", true AS bounded, true AS ranks_within FROM customer""",
}
