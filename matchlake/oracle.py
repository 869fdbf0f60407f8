"""Independent SQL (DuckDB dialect) for every registered query.

The driver-table adapter, the conformed layer, the star schema and the
reports are re-stated here as plain SQL over the driver's views (``part``,
``supplier``, ``nation``, ``region``, ``orders``, ``lineitem``, ``events``).
Nothing here is generated from the DataFrame code; it is the cross-check.

Two dialect shims keep the comparison exact:
* ``_round`` rounds half-up on the shortest decimal text of the double, as
  Spark's ``round`` does (DuckDB rounds the binary value: 1.005 -> 1.0).
* averages of integers are written ``SUM(x)::DOUBLE / COUNT(x)``.
"""

from __future__ import annotations

import re

# Fixed values shared with the pipeline: the pinned clock and the season of R03.
AS_OF_SQL = "TIMESTAMP '2024-06-30 12:00:00'"
AS_OF_YEAR = 2024
SEASON = 1998
TOKENS = "('null', 'NULL', 'Null', '')"
TOKENS_STRICT = "('null', 'NULL', 'Null')"


def _round(expr: str, digits: int) -> str:
    return (f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 12)), {digits}) "
            f"AS DOUBLE)")


def _avg(expr: str) -> str:
    return f"(SUM({expr})::DOUBLE / NULLIF(COUNT({expr}), 0))"


def _dk(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def _nz(cols: list[str], strings: set[str], strict: bool) -> str:
    toks = TOKENS_STRICT if strict else TOKENS
    return ", ".join(f"CASE WHEN {c} IN {toks} THEN NULL ELSE {c} END AS {c}" if c in strings
                     else c for c in cols)


def _first_per_key(src: str, keys: list[str], cols: list[str]) -> str:
    rest = [c for c in cols if c not in keys]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    part = ", ".join(keys)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER "
            f"(PARTITION BY {part} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1")


# ------------------------------------------------------------------ raw tables
RAW = {
    "raw_players": """
SELECT p_partkey AS player_id,
  CASE WHEN p_partkey % 10 = 0 THEN 'null' ELSE p_name END AS name,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS first_name,
  p_type AS last_name,
  CASE WHEN p_partkey % 11 = 0 THEN 'NULL' ELSE p_brand END AS country_of_citizenship,
  CASE WHEN p_partkey % 17 = 0 THEN 'Missing' WHEN p_partkey % 19 = 0 THEN 'null'
       ELSE p_type END AS position,
  CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN 'nULL'
       ELSE p_type END AS sub_position,
  CASE WHEN p_partkey % 23 = 0 THEN 'unknown'
       ELSE CAST(CAST(DATE '1980-01-01' + CAST(p_partkey % 9000 AS INTEGER) AS DATE) AS VARCHAR)
  END AS date_of_birth,
  CASE WHEN p_size % 3 = 0 THEN 'right' WHEN p_size % 3 = 1 THEN 'left' ELSE 'both' END AS foot,
  CAST(p_size + 150 AS INTEGER) AS height_in_cm,
  CAST(p_partkey % 100 AS BIGINT) AS current_club_id,
  'Club ' || CAST(p_partkey % 100 AS VARCHAR) AS current_club_name,
  CASE WHEN p_partkey % 4 = 0 THEN ' null ' WHEN p_partkey % 4 = 1 THEN 'Null'
       ELSE 'Agent ' || p_brand END AS agent_name,
  p_brand AS country_of_birth,
  p_name AS city_of_birth,
  replace(p_name, ' ', '-') AS player_code
FROM part""",
    "raw_clubs": """
SELECT s_suppkey AS club_id,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 9 = 4 THEN 'NULL' ELSE s_name END AS name,
  lower(s_name) AS club_code,
  CAST(s_nationkey AS VARCHAR) AS domestic_competition_id,
  CASE WHEN s_suppkey % 41 = 0 THEN NULL ELSE CAST(s_suppkey % 40 AS INTEGER) END AS squad_size,
  CASE WHEN s_suppkey % 43 = 0 THEN NULL ELSE CAST(s_suppkey % 15 AS DOUBLE) + 20.0 END
    AS average_age,
  CAST(s_suppkey % 20 AS INTEGER) AS foreigners_number,
  CAST(s_suppkey % 100 AS DOUBLE) AS foreigners_percentage,
  CAST(s_nationkey % 5 AS INTEGER) AS national_team_players,
  s_name || ' Stadium' AS stadium_name,
  CAST(floor(abs(s_acctbal)) AS INTEGER) AS stadium_seats,
  s_acctbal AS total_market_value,
  CASE WHEN s_acctbal < 0 THEN 'deficit' ELSE 'surplus' END AS net_transfer_record,
  'Coach ' || CAST(s_suppkey AS VARCHAR) AS coach_name,
  CAST(s_suppkey % 25 + 2000 AS INTEGER) AS last_season
FROM supplier""",
    "raw_competitions": """
SELECT CAST(n_nationkey AS VARCHAR) AS competition_id,
  CASE WHEN n_nationkey IN (3, 9) THEN 'premier-liga' ELSE n_name END AS name,
  lower(n_name) AS competition_code,
  CASE WHEN n_nationkey = 24 THEN NULL
       WHEN n_regionkey = 0 THEN 'international_cup'
       WHEN n_regionkey = 1 THEN 'international'
       WHEN n_regionkey = 2 THEN 'domestic_cup'
       ELSE 'domestic_league' END AS type,
  'first_tier' AS sub_type,
  CAST(n_nationkey AS INTEGER) AS country_id,
  CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE r_name END AS country_name,
  CAST(n_nationkey AS VARCHAR) AS domestic_league_code,
  r_name AS confederation
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_games": """
SELECT o_orderkey AS game_id,
  CASE WHEN o_orderkey % 103 = 0 THEN '99' ELSE CAST(o_custkey % 25 AS VARCHAR) END
    AS competition_id,
  CASE WHEN o_orderkey % 89 = 0 THEN 'null'
       WHEN o_orderkey % 97 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '/'
            || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0')
       ELSE CAST(year(o_orderdate) AS VARCHAR) END AS season,
  o_orderpriority AS round,
  CASE WHEN o_orderkey % 101 = 0 THEN 'NULL'
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date,
  o_orderkey % 100 AS home_club_id,
  (o_orderkey + 7) % 100 AS away_club_id,
  CAST(o_custkey % 5 AS INTEGER) AS home_club_goals,
  CAST(o_orderkey % 4 AS INTEGER) AS away_club_goals,
  CAST(o_custkey % 20 + 1 AS INTEGER) AS home_club_position,
  CAST(o_orderkey % 20 + 1 AS INTEGER) AS away_club_position,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS INTEGER) END
    AS attendance,
  o_orderstatus AS competition_type
FROM orders""",
    "raw_appearances": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
         || CAST(l_partkey AS VARCHAR) AS appearance_id,
  CASE WHEN l_linenumber = 7 THEN -1 - l_orderkey ELSE l_orderkey END AS game_id,
  CASE WHEN CAST(floor(l_extendedprice) AS BIGINT) % 50 = 0 THEN NULL ELSE l_partkey END
    AS player_id,
  l_suppkey AS player_club_id,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_partkey % 25 AS VARCHAR) END AS competition_id,
  CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN 'n/a'
       ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date,
  CAST(CAST(floor(l_quantity) AS BIGINT) % 3 AS INTEGER) AS goals,
  CAST(l_linenumber % 2 AS INTEGER) AS assists,
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 END AS INTEGER) AS yellow_cards,
  CAST(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 1 END AS INTEGER) AS red_cards,
  CAST(floor(l_quantity) AS INTEGER) AS minutes_played
FROM lineitem""",
    "raw_club_games": """
SELECT l_orderkey AS game_id,
  l_suppkey AS club_id,
  (l_suppkey + 1) % 100 AS opponent_id,
  CAST(CAST(floor(l_quantity) AS BIGINT) % 5 AS INTEGER) AS own_goals,
  CAST(l_linenumber % 4 AS INTEGER) AS opponent_goals,
  CAST(l_linenumber AS INTEGER) AS own_position,
  CAST(l_linenumber % 3 + 1 AS INTEGER) AS opponent_position,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Home' ELSE 'Away' END AS hosting,
  CASE WHEN l_linestatus = 'F' AND l_linenumber % 2 = 0 THEN 'win'
       WHEN l_linestatus = 'F' THEN '1'
       WHEN l_linenumber % 3 = 0 THEN 'null'
       ELSE '0' END AS is_win
FROM lineitem""",
    "raw_game_events": """
SELECT event_id AS game_event_id,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS game_id,
  event_type AS type,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 'null'
       ELSE event_type || ':' || props END AS description
FROM events""",
    "raw_player_valuations": """
SELECT user_id AS player_id, CAST(ts AS VARCHAR) AS date, ts AS datetime,
  value AS market_value_in_eur
FROM events""",
}

# Column lists (raw order) and which of them are text.
COLS = {
    "players": ["player_id", "name", "first_name", "last_name", "country_of_citizenship",
                "position", "sub_position", "date_of_birth", "foot", "height_in_cm",
                "current_club_id", "current_club_name", "agent_name", "country_of_birth",
                "city_of_birth", "player_code"],
    "appearances": ["appearance_id", "game_id", "player_id", "player_club_id", "competition_id",
                    "date", "goals", "assists", "yellow_cards", "red_cards", "minutes_played"],
    "games": ["game_id", "competition_id", "season", "round", "date", "home_club_id",
              "away_club_id", "home_club_goals", "away_club_goals", "home_club_position",
              "away_club_position", "attendance", "competition_type"],
    "clubs": ["club_id", "name", "club_code", "domestic_competition_id", "squad_size",
              "average_age", "foreigners_number", "foreigners_percentage",
              "national_team_players", "stadium_name", "stadium_seats", "total_market_value",
              "net_transfer_record", "coach_name", "last_season"],
    "competitions": ["competition_id", "name", "competition_code", "type", "sub_type",
                     "country_id", "country_name", "domestic_league_code", "confederation"],
    "game_events": ["game_event_id", "game_id", "type", "description"],
    "club_games": ["game_id", "club_id", "opponent_id", "own_goals", "opponent_goals",
                   "own_position", "opponent_position", "hosting", "is_win"],
    "player_valuations": ["player_id", "date", "datetime", "market_value_in_eur"],
}
TEXT = {
    "players": {"name", "first_name", "last_name", "country_of_citizenship", "position",
                "sub_position", "date_of_birth", "foot", "current_club_name", "agent_name",
                "country_of_birth", "city_of_birth", "player_code"},
    "appearances": {"appearance_id", "competition_id", "date"},
    "games": {"competition_id", "season", "round", "date", "competition_type"},
    "clubs": {"name", "club_code", "domestic_competition_id", "stadium_name",
              "net_transfer_record", "coach_name"},
    "competitions": {"competition_id", "name", "competition_code", "type", "sub_type",
                     "country_name", "domestic_league_code", "confederation"},
    "game_events": {"type", "description"},
    "club_games": {"hosting", "is_win"},
    "player_valuations": {"date"},
}


def _silver(prefix: str, strict: bool) -> dict[str, str]:
    """Conformed tables: n_* normalized, d_* first row per key, then the table."""
    p = prefix
    stamp = f", {AS_OF_SQL} AS ingestion_timestamp" if strict else ""
    ctes = {}
    for t in ("players", "appearances", "games", "clubs", "competitions", "game_events",
              "club_games", "player_valuations"):
        ctes[f"{p}n_{t}"] = f"SELECT {_nz(COLS[t], TEXT[t], strict)} FROM raw_{t}"
    ctes[f"{p}d_players"] = _first_per_key(f"{p}n_players", ["player_id"], COLS["players"])
    ctes[f"{p}d_games"] = _first_per_key(f"{p}n_games", ["game_id"], COLS["games"])
    ctes[f"{p}d_clubs"] = _first_per_key(f"{p}n_clubs", ["club_id"], COLS["clubs"])
    ctes[f"{p}d_competitions"] = _first_per_key(f"{p}n_competitions", ["competition_id"],
                                                COLS["competitions"])
    ctes[f"{p}d_club_games"] = _first_per_key(f"{p}n_club_games", ["game_id", "club_id"],
                                              COLS["club_games"])
    age = (f", CAST({AS_OF_YEAR} - year(TRY_CAST(date_of_birth AS DATE)) AS INTEGER) AS age"
           if strict else "")
    ctes[f"{p}players"] = f"""
SELECT player_id, name, COALESCE(first_name, 'Unknown') AS first_name,
  COALESCE(last_name, 'Unknown') AS last_name,
  COALESCE(country_of_citizenship, 'Unknown') AS country_of_citizenship,
  COALESCE(position, 'Unknown') AS position, COALESCE(sub_position, 'Unknown') AS sub_position,
  TRY_CAST(date_of_birth AS DATE) AS date_of_birth, foot, height_in_cm, current_club_id,
  current_club_name, agent_name, country_of_birth, city_of_birth, player_code,
  COALESCE(name, concat_ws(' ', COALESCE(first_name, 'Unknown'), COALESCE(last_name, 'Unknown')))
    AS full_name{age}{stamp}
FROM {p}d_players"""
    ctes[f"{p}appearances"] = f"""
SELECT appearance_id, game_id, player_id, player_club_id, competition_id,
  TRY_CAST(date AS DATE) AS date, COALESCE(goals, 0) AS goals, COALESCE(assists, 0) AS assists,
  COALESCE(yellow_cards, 0) AS yellow_cards, COALESCE(red_cards, 0) AS red_cards,
  COALESCE(minutes_played, 0) AS minutes_played{stamp}
FROM {p}n_appearances WHERE player_id IS NOT NULL AND game_id IS NOT NULL"""
    ctes[f"{p}games"] = f"""
SELECT game_id, competition_id, season, round, TRY_CAST(date AS DATE) AS date, home_club_id,
  away_club_id, home_club_goals, away_club_goals, home_club_position, away_club_position,
  attendance, competition_type, TRY_CAST(season AS INTEGER) AS season_year,
  home_club_goals + away_club_goals AS total_goals{stamp}
FROM {p}d_games WHERE game_id IS NOT NULL"""
    ctes[f"{p}clubs"] = f"""
SELECT club_id, COALESCE(name, 'Unknown Club') AS name, club_code, domestic_competition_id,
  COALESCE(squad_size, 0) AS squad_size, COALESCE(average_age, 0.0) AS average_age,
  COALESCE(foreigners_number, 0) AS foreigners_number, foreigners_percentage,
  national_team_players, stadium_name, stadium_seats, total_market_value, net_transfer_record,
  coach_name, last_season{stamp}
FROM {p}d_clubs"""
    ctes[f"{p}competitions"] = f"""
SELECT competition_id, name, competition_code, type, sub_type, country_id,
  COALESCE(country_name, 'Unknown') AS country_name, domestic_league_code, confederation,
  COALESCE(type IN ('international_cup', 'international'), FALSE) AS is_international{stamp}
FROM {p}d_competitions"""
    ctes[f"{p}game_events"] = f"""
SELECT game_event_id, game_id, type, COALESCE(description, '') AS description{stamp}
FROM {p}n_game_events WHERE game_id IS NOT NULL"""
    ctes[f"{p}club_games"] = f"SELECT * FROM {p}d_club_games"
    ctes[f"{p}player_valuations"] = f"""
SELECT player_id, TRY_CAST(date AS DATE) AS date, CAST(datetime AS DATE) AS datetime,
  market_value_in_eur FROM {p}n_player_valuations"""
    return ctes


WON = "COALESCE(lower(trim(is_win)) IN ('1', 'win', 'true', 'w'), FALSE)"


def _star_compact() -> dict[str, str]:
    return {
        "c_dim_player": """
SELECT player_id AS player_key, full_name, first_name, last_name, country_of_citizenship,
  date_of_birth, position, sub_position, foot, height_in_cm, current_club_name, agent_name
FROM s_players""",
        "c_dim_club": """
SELECT club_id AS club_key, name, club_code, domestic_competition_id, squad_size, average_age,
  foreigners_number, stadium_name, stadium_seats, coach_name FROM s_clubs""",
        "c_dim_competition": """
SELECT competition_id AS competition_key, name, type, country_name, confederation,
  is_international FROM s_competitions""",
        "c_dim_date": f"""
SELECT date, {_dk('date')} AS date_key, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name,
  monthname(date) AS month_name, dayofweek(date) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT date FROM s_games WHERE date IS NOT NULL)""",
        "c_fact_appearance": f"""
SELECT a.appearance_id AS appearance_key, a.game_id AS game_key, a.player_id AS player_key,
  a.player_club_id AS club_key, COALESCE(a.competition_id, g.competition_id) AS competition_key,
  {_dk('COALESCE(a.date, g.date)')} AS date_key, g.season_year, a.goals, a.assists,
  a.yellow_cards, a.red_cards, a.minutes_played
FROM s_appearances a JOIN s_games g ON a.game_id = g.game_id""",
        "c_fact_game": f"""
SELECT game_id AS game_key, competition_id AS competition_key, home_club_id AS home_club_key,
  away_club_id AS away_club_key, {_dk('date')} AS date_key, season_year, round, home_club_goals,
  away_club_goals, total_goals, attendance FROM s_games""",
        "c_fact_club_perf": f"""
SELECT game_id AS game_key, club_id AS club_key, opponent_id AS opponent_club_key, own_goals,
  opponent_goals, hosting, is_win, {WON} AS won FROM s_club_games""",
    }


def _star_full() -> dict[str, str]:
    return {
        "f_dim_player": """
SELECT player_id AS player_key, full_name, first_name, last_name, country_of_birth,
  city_of_birth, country_of_citizenship, date_of_birth, age, position, sub_position, foot,
  height_in_cm, player_code, current_club_id, current_club_name, agent_name, ingestion_timestamp
FROM sf_players""",
        "f_dim_club": """
SELECT club_id AS club_key, name, club_code, domestic_competition_id, squad_size, average_age,
  foreigners_number, foreigners_percentage, national_team_players, stadium_name, stadium_seats,
  total_market_value, net_transfer_record, coach_name, last_season, ingestion_timestamp
FROM sf_clubs""",
        "f_dim_competition": """
SELECT competition_id AS competition_key, name, competition_code, type, sub_type, country_id,
  country_name, domestic_league_code, confederation, is_international, ingestion_timestamp
FROM sf_competitions""",
        "f_dim_date": f"""
SELECT date, {_dk('date')} AS date_key, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name,
  monthname(date) AS month_name, dayofweek(date) IN (0, 6) AS is_weekend,
  {AS_OF_SQL} AS ingestion_timestamp
FROM (SELECT DISTINCT date FROM sf_games WHERE date IS NOT NULL)""",
        "f_fact_appearance": f"""
SELECT a.game_id AS game_key, a.appearance_id AS appearance_key, a.player_id AS player_key,
  a.player_club_id AS club_key, COALESCE(a.competition_id, g.competition_id) AS competition_key,
  COALESCE(a.date, g.date) AS date, a.goals, a.assists, a.yellow_cards, a.red_cards,
  a.minutes_played, {AS_OF_SQL} AS ingestion_timestamp, g.season, g.round, g.home_club_id,
  g.away_club_id, g.home_club_goals, g.away_club_goals, g.home_club_position,
  g.away_club_position, g.attendance, g.competition_type,
  TRY_CAST(g.season AS INTEGER) AS season_year, g.total_goals,
  {_dk('COALESCE(a.date, g.date)')} AS date_key
FROM sf_appearances a JOIN sf_games g ON a.game_id = g.game_id
WHERE a.player_id IS NOT NULL""",
        "f_fact_game": f"""
SELECT game_id AS game_key, competition_id AS competition_key, home_club_id AS home_club_key,
  away_club_id AS away_club_key, {_dk('date')} AS date_key, season_year, round, home_club_goals,
  away_club_goals, total_goals, home_club_position, away_club_position, attendance,
  competition_type, {AS_OF_SQL} AS ingestion_timestamp FROM sf_games""",
        "f_fact_club_perf": f"""
SELECT game_id AS game_key, club_id AS club_key, opponent_id AS opponent_club_key, own_goals,
  opponent_goals, own_position, opponent_position, hosting, is_win, {WON} AS won,
  {AS_OF_SQL} AS ingestion_timestamp FROM raw_club_games""",
    }


CTES: dict[str, str] = {}
CTES.update(RAW)
CTES.update(_silver("s_", strict=False))
CTES.update(_silver("sf_", strict=True))
CTES.update(_star_compact())
CTES.update(_star_full())

_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it uses (transitively, in dependency order)."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(sql: str) -> None:
        for w in _WORD.findall(sql):
            if w in CTES and w not in seen:
                seen.add(w)
                visit(CTES[w])
                order.append(w)

    visit(body)
    extra = ""
    b = body.strip()
    if b[:5].upper() == "WITH ":
        extra, b = b[5:], ""
    parts = [f"{n} AS ({CTES[n]}\n)" for n in order]
    if extra:
        return "WITH " + ",\n".join(parts + [extra])
    if not parts:
        return b
    return "WITH " + ",\n".join(parts) + "\n" + b


# ------------------------------------------------------------------ reports
def _reports() -> dict[str, str]:
    r = _round
    q = {}
    q["report01_compact"] = """
SELECT p.full_name, p.country_of_citizenship, p.position, x.number_of_clubs
FROM c_dim_player p JOIN (
  SELECT f.player_key, COUNT(DISTINCT c.name) AS number_of_clubs
  FROM c_fact_appearance f JOIN c_dim_club c ON f.club_key = c.club_key
  GROUP BY f.player_key) x ON p.player_key = x.player_key"""
    q["report01_full"] = """
WITH pc AS (
  SELECT DISTINCT f.player_key, c.name AS club_name
  FROM f_fact_appearance f LEFT JOIN f_dim_club c ON f.club_key = c.club_key),
agg AS (
  SELECT player_key,
    COALESCE(list_sort(list(club_name) FILTER (WHERE club_name IS NOT NULL)), []::VARCHAR[])
      AS clubs_played,
    COUNT(club_name) AS number_of_clubs
  FROM pc GROUP BY player_key)
SELECT p.player_key, p.full_name, p.country_of_citizenship, p.position, p.date_of_birth, p.age,
  p.current_club_name, a.clubs_played, COALESCE(a.number_of_clubs, 0) AS number_of_clubs
FROM f_dim_player p LEFT JOIN agg a ON p.player_key = a.player_key"""
    q["report02_compact"] = """
SELECT p.full_name, p.country_of_citizenship, x.intl_apps, x.intl_goals
FROM c_dim_player p JOIN (
  SELECT f.player_key, COUNT(*) AS intl_apps, CAST(SUM(f.goals) AS BIGINT) AS intl_goals
  FROM c_fact_appearance f JOIN c_dim_competition c ON f.competition_key = c.competition_key
  WHERE c.is_international GROUP BY f.player_key) x ON p.player_key = x.player_key"""
    q["report02_full"] = """
SELECT p.player_key, p.full_name, p.country_of_citizenship, p.position,
  x.international_appearances, x.international_goals, x.international_assists, x.total_minutes
FROM f_dim_player p JOIN (
  SELECT f.player_key, COUNT(*) AS international_appearances,
    CAST(SUM(f.goals) AS BIGINT) AS international_goals,
    CAST(SUM(f.assists) AS BIGINT) AS international_assists,
    CAST(SUM(f.minutes_played) AS BIGINT) AS total_minutes
  FROM f_fact_appearance f JOIN f_dim_competition c ON f.competition_key = c.competition_key
  WHERE c.is_international GROUP BY f.player_key) x ON p.player_key = x.player_key
ORDER BY x.international_appearances DESC NULLS LAST, p.player_key ASC NULLS LAST
LIMIT 50"""
    q["report03_compact"] = f"""
SELECT full_name, total_goals, country_of_citizenship FROM (
  SELECT p.player_key, p.full_name, x.total_goals, p.country_of_citizenship
  FROM c_dim_player p JOIN (
    SELECT player_key, CAST(SUM(goals) AS BIGINT) AS total_goals
    FROM c_fact_appearance WHERE season_year = {SEASON} GROUP BY player_key
  ) x ON p.player_key = x.player_key
  ORDER BY x.total_goals DESC NULLS LAST, p.player_key ASC NULLS LAST LIMIT 10)"""
    q["report03_full"] = f"""
SELECT p.player_key, p.full_name, p.country_of_citizenship, p.position, p.current_club_name,
  x.total_goals, x.matches_played, x.total_assists, x.total_minutes,
  {r('x.total_goals::DOUBLE / x.matches_played', 2)} AS goals_per_match
FROM f_dim_player p JOIN (
  SELECT player_key, CAST(SUM(goals) AS BIGINT) AS total_goals,
    COUNT(game_key) AS matches_played, CAST(SUM(assists) AS BIGINT) AS total_assists,
    CAST(SUM(minutes_played) AS BIGINT) AS total_minutes
  FROM f_fact_appearance WHERE season_year = {SEASON}
  GROUP BY player_key HAVING SUM(goals) > 0) x ON p.player_key = x.player_key
ORDER BY total_goals DESC NULLS LAST, goals_per_match DESC NULLS LAST,
  p.player_key ASC NULLS LAST
LIMIT 10"""
    q["report04_compact"] = """
SELECT p.full_name, x.total_reds, x.total_games
FROM c_dim_player p JOIN (
  SELECT player_key, CAST(SUM(red_cards) AS BIGINT) AS total_reds,
    COUNT(game_key) AS total_games
  FROM c_fact_appearance GROUP BY player_key HAVING SUM(red_cards) > 0
) x ON p.player_key = x.player_key"""
    q["report04_full"] = f"""
SELECT p.player_key, p.full_name, p.country_of_citizenship, p.position, p.current_club_name,
  x.total_red_cards, x.total_yellow_cards, x.total_appearances,
  {r('(x.total_red_cards + x.total_yellow_cards)::DOUBLE / x.total_appearances', 2)}
    AS cards_per_game
FROM f_dim_player p JOIN (
  SELECT player_key, CAST(SUM(red_cards) AS BIGINT) AS total_red_cards,
    CAST(SUM(yellow_cards) AS BIGINT) AS total_yellow_cards, COUNT(game_key) AS total_appearances
  FROM f_fact_appearance GROUP BY player_key HAVING SUM(red_cards) > 0
) x ON p.player_key = x.player_key
ORDER BY x.total_red_cards DESC NULLS LAST, x.total_yellow_cards DESC NULLS LAST,
  p.player_key ASC NULLS LAST
LIMIT 5"""
    q["report05_compact"] = """
SELECT name, total_wins FROM (
  SELECT c.club_key, c.name, x.total_wins FROM c_dim_club c JOIN (
    SELECT club_key, CAST(SUM(CASE WHEN won THEN 1 ELSE 0 END) AS BIGINT) AS total_wins
    FROM c_fact_club_perf GROUP BY club_key) x ON c.club_key = x.club_key
  ORDER BY x.total_wins DESC NULLS LAST, c.club_key ASC NULLS LAST LIMIT 20)"""
    q["report05_full"] = f"""
SELECT c.club_key, c.name, c.domestic_competition_id, c.stadium_name, x.total_wins,
  x.total_matches, {r('(x.total_wins::DOUBLE / x.total_matches) * 100', 2)} AS win_percentage,
  x.total_goals_scored, x.total_goals_conceded,
  x.total_goals_scored - x.total_goals_conceded AS goal_difference,
  c.squad_size, c.total_market_value
FROM f_dim_club c JOIN (
  SELECT club_key, CAST(SUM(CASE WHEN won THEN 1 ELSE 0 END) AS BIGINT) AS total_wins,
    COUNT(*) AS total_matches, CAST(SUM(own_goals) AS BIGINT) AS total_goals_scored,
    CAST(SUM(opponent_goals) AS BIGINT) AS total_goals_conceded
  FROM f_fact_club_perf GROUP BY club_key) x ON c.club_key = x.club_key
ORDER BY total_wins DESC NULLS LAST, win_percentage DESC NULLS LAST,
  goal_difference DESC NULLS LAST, c.club_key ASC NULLS LAST
LIMIT 5"""
    q["report06_compact"] = """
SELECT p.full_name, x.total_goals, x.total_assists, x.apps
FROM c_dim_player p JOIN (
  SELECT player_key, CAST(SUM(goals) AS BIGINT) AS total_goals,
    CAST(SUM(assists) AS BIGINT) AS total_assists, COUNT(game_key) AS apps
  FROM c_fact_appearance GROUP BY player_key) x ON p.player_key = x.player_key"""
    q["report06_full"] = f"""
SELECT p.player_key, p.full_name, p.country_of_citizenship, p.position, p.age,
  p.current_club_name, x.total_appearances, x.total_goals, x.total_assists, x.total_minutes,
  x.total_yellows, x.total_reds, x.total_goals + x.total_assists AS goal_contribution,
  {r('x.total_goals::DOUBLE / x.total_appearances', 2)} AS goals_per_appearance
FROM f_dim_player p JOIN (
  SELECT player_key, COUNT(game_key) AS total_appearances,
    CAST(SUM(goals) AS BIGINT) AS total_goals, CAST(SUM(assists) AS BIGINT) AS total_assists,
    CAST(SUM(yellow_cards) AS BIGINT) AS total_yellows,
    CAST(SUM(red_cards) AS BIGINT) AS total_reds,
    CAST(SUM(minutes_played) AS BIGINT) AS total_minutes
  FROM f_fact_appearance GROUP BY player_key HAVING COUNT(game_key) > 0
) x ON p.player_key = x.player_key"""
    q["report07_compact"] = f"""
SELECT c.name, c.type, c.country_name, COUNT(g.game_key) AS total_games,
  {_avg('g.total_goals')} AS avg_goals, {_avg('g.attendance')} AS avg_attendance
FROM c_fact_game g JOIN c_dim_competition c ON g.competition_key = c.competition_key
GROUP BY c.name, c.type, c.country_name"""
    q["report07_full"] = f"""
SELECT c.competition_key, c.name, c.type, c.country_name, c.confederation,
  COALESCE(g.total_games, 0) AS total_games, COALESCE(g.total_goals, 0) AS total_goals,
  {r('COALESCE(g.avg_goals_per_game, 0)', 2)} AS avg_goals_per_game,
  {r('COALESCE(g.avg_attendance, 0)', 0)} AS avg_attendance,
  COALESCE(a.total_red_cards, 0) AS total_red_cards,
  COALESCE(a.total_yellow_cards, 0) AS total_yellow_cards
FROM f_dim_competition c
LEFT JOIN (
  SELECT competition_key, COUNT(game_key) AS total_games,
    CAST(SUM(total_goals) AS BIGINT) AS total_goals,
    {_avg('total_goals')} AS avg_goals_per_game, {_avg('attendance')} AS avg_attendance
  FROM f_fact_game GROUP BY competition_key) g ON c.competition_key = g.competition_key
LEFT JOIN (
  SELECT competition_key, CAST(SUM(red_cards) AS BIGINT) AS total_red_cards,
    CAST(SUM(yellow_cards) AS BIGINT) AS total_yellow_cards
  FROM f_fact_appearance GROUP BY competition_key) a ON c.competition_key = a.competition_key"""
    q["report08_compact"] = """
SELECT full_name, total_assists FROM (
  SELECT p.player_key, p.full_name, x.total_assists FROM c_dim_player p JOIN (
    SELECT player_key, CAST(SUM(assists) AS BIGINT) AS total_assists
    FROM c_fact_appearance GROUP BY player_key) x ON p.player_key = x.player_key
  ORDER BY x.total_assists DESC NULLS LAST, p.player_key ASC NULLS LAST LIMIT 20)"""
    q["report08_full"] = f"""
SELECT p.player_key, p.full_name, p.country_of_citizenship, p.position, p.current_club_name,
  x.total_assists, x.total_goals, x.total_games, x.total_minutes,
  {r('x.total_assists::DOUBLE / x.total_games', 2)} AS assists_per_game
FROM f_dim_player p JOIN (
  SELECT player_key, CAST(SUM(assists) AS BIGINT) AS total_assists,
    CAST(SUM(goals) AS BIGINT) AS total_goals, COUNT(game_key) AS total_games,
    CAST(SUM(minutes_played) AS BIGINT) AS total_minutes
  FROM f_fact_appearance GROUP BY player_key HAVING SUM(assists) > 0
) x ON p.player_key = x.player_key
ORDER BY x.total_assists DESC NULLS LAST, p.player_key ASC NULLS LAST
LIMIT 20"""
    q["report09_compact"] = """
SELECT c.name, x.home_wins, x.away_wins FROM c_dim_club c JOIN (
  SELECT club_key,
    CAST(SUM(CASE WHEN hosting = 'Home' AND won THEN 1 ELSE 0 END) AS BIGINT) AS home_wins,
    CAST(SUM(CASE WHEN hosting = 'Away' AND won THEN 1 ELSE 0 END) AS BIGINT) AS away_wins
  FROM c_fact_club_perf GROUP BY club_key) x ON c.club_key = x.club_key"""
    q["report09_full"] = """
SELECT c.club_key, c.name, x.home_games, x.home_wins,
  CASE WHEN x.home_games > 0 THEN x.home_wins::DOUBLE / x.home_games END AS home_win_pct,
  x.home_goals_scored, x.away_games, x.away_wins,
  CASE WHEN x.away_games > 0 THEN x.away_wins::DOUBLE / x.away_games END AS away_win_pct,
  x.away_goals_scored
FROM f_dim_club c JOIN (
  SELECT club_key,
    CAST(SUM(CASE WHEN hosting = 'Home' THEN CAST(won AS INTEGER) ELSE 0 END) AS BIGINT)
      AS home_wins,
    CAST(SUM(CASE WHEN hosting = 'Home' THEN 1 ELSE 0 END) AS BIGINT) AS home_games,
    CAST(SUM(CASE WHEN hosting = 'Away' THEN CAST(won AS INTEGER) ELSE 0 END) AS BIGINT)
      AS away_wins,
    CAST(SUM(CASE WHEN hosting = 'Away' THEN 1 ELSE 0 END) AS BIGINT) AS away_games,
    CAST(SUM(CASE WHEN hosting = 'Home' THEN own_goals ELSE 0 END) AS BIGINT)
      AS home_goals_scored,
    CAST(SUM(CASE WHEN hosting = 'Away' THEN own_goals ELSE 0 END) AS BIGINT)
      AS away_goals_scored
  FROM f_fact_club_perf GROUP BY club_key) x ON c.club_key = x.club_key
WHERE x.home_games + x.away_games > 0"""
    q["report10_compact"] = f"""
SELECT season_year, CAST(SUM(total_goals) AS BIGINT) AS total_goals,
  {_avg('attendance')} AS avg_attendance
FROM c_fact_game GROUP BY season_year"""
    q["report10_full"] = f"""
SELECT COALESCE(g.season_year, 0) AS season_year, g.total_games, g.total_goals,
  {r('COALESCE(g.avg_goals_per_game, 0)', 2)} AS avg_goals_per_game,
  {r('COALESCE(g.avg_attendance, 0)', 0)} AS avg_attendance,
  COALESCE(c.total_yellows, 0) AS total_yellows, COALESCE(c.total_reds, 0) AS total_reds
FROM (
  SELECT season_year, COUNT(game_key) AS total_games,
    CAST(SUM(total_goals) AS BIGINT) AS total_goals,
    {_avg('total_goals')} AS avg_goals_per_game, {_avg('attendance')} AS avg_attendance
  FROM f_fact_game GROUP BY season_year) g
LEFT JOIN (
  SELECT season_year, CAST(SUM(yellow_cards) AS BIGINT) AS total_yellows,
    CAST(SUM(red_cards) AS BIGINT) AS total_reds
  FROM f_fact_appearance GROUP BY season_year) c ON g.season_year = c.season_year"""
    q["report11_compact"] = f"""
SELECT p.position, {_avg('f.goals')} AS avg_goals_per_player,
  {_avg('f.assists')} AS avg_assists_per_player
FROM c_fact_appearance f JOIN c_dim_player p ON f.player_key = p.player_key
GROUP BY p.position"""
    q["report11_full"] = f"""
SELECT position, total_players, total_goals, total_assists, total_yellows, total_reds,
  total_appearances,
  {r('total_goals::DOUBLE / total_players', 2)} AS goals_per_player,
  {r('total_assists::DOUBLE / total_players', 2)} AS assists_per_player
FROM (
  SELECT p.position, COUNT(DISTINCT f.player_key) AS total_players,
    CAST(SUM(f.goals) AS BIGINT) AS total_goals, CAST(SUM(f.assists) AS BIGINT) AS total_assists,
    CAST(SUM(f.yellow_cards) AS BIGINT) AS total_yellows,
    CAST(SUM(f.red_cards) AS BIGINT) AS total_reds, COUNT(f.game_key) AS total_appearances
  FROM f_fact_appearance f JOIN f_dim_player p ON f.player_key = p.player_key
  GROUP BY p.position)"""
    q["report12_compact"] = """
SELECT home_name, away_name, attendance, total_goals, date_key FROM (
  SELECT g.game_key, h.name AS home_name, a.name AS away_name, g.attendance, g.total_goals,
    g.date_key
  FROM c_fact_game g JOIN c_dim_club h ON g.home_club_key = h.club_key
  JOIN c_dim_club a ON g.away_club_key = a.club_key
  ORDER BY g.attendance DESC NULLS LAST, g.game_key ASC NULLS LAST LIMIT 50)"""
    q["report12_full"] = """
SELECT g.game_key, h.name AS home_club_name, a.name AS away_club_name, g.home_club_goals,
  g.away_club_goals, g.attendance, c.name AS competition_name, d.date,
  CAST(g.home_club_goals AS VARCHAR) || '-' || CAST(g.away_club_goals AS VARCHAR) AS match_result
FROM f_fact_game g
LEFT JOIN f_dim_club h ON g.home_club_key = h.club_key
LEFT JOIN f_dim_club a ON g.away_club_key = a.club_key
LEFT JOIN f_dim_competition c ON g.competition_key = c.competition_key
LEFT JOIN f_dim_date d ON g.date_key = d.date_key
WHERE g.attendance IS NOT NULL
ORDER BY g.attendance DESC, g.game_key ASC
LIMIT 20"""
    q["report13_compact"] = """
SELECT country_of_citizenship, COUNT(*) AS player_count FROM c_dim_player
GROUP BY country_of_citizenship"""
    q["report13_full"] = f"""
SELECT country_of_citizenship, total_players, total_goals, total_assists, total_appearances,
  {r('total_goals::DOUBLE / total_players', 2)} AS goals_per_player
FROM (
  SELECT p.country_of_citizenship, COUNT(DISTINCT p.player_key) AS total_players,
    CAST(COALESCE(SUM(f.goals), 0) AS BIGINT) AS total_goals,
    CAST(COALESCE(SUM(f.assists), 0) AS BIGINT) AS total_assists,
    COUNT(f.game_key) AS total_appearances
  FROM f_dim_player p LEFT JOIN f_fact_appearance f ON p.player_key = f.player_key
  GROUP BY p.country_of_citizenship)"""
    q["report14_compact"] = """
SELECT d.month_name, d.month, CAST(SUM(g.total_goals) AS BIGINT) AS goals
FROM c_fact_game g JOIN c_dim_date d ON g.date_key = d.date_key
GROUP BY d.month_name, d.month"""
    q["report14_full"] = f"""
SELECT month, month_name, total_games, total_goals,
  {r('avg_goals_per_game', 2)} AS avg_goals_per_game, {r('avg_attendance', 0)} AS avg_attendance
FROM (
  SELECT d.month, d.month_name, COUNT(g.game_key) AS total_games,
    CAST(SUM(g.total_goals) AS BIGINT) AS total_goals,
    {_avg('g.total_goals')} AS avg_goals_per_game, {_avg('g.attendance')} AS avg_attendance
  FROM f_fact_game g JOIN f_dim_date d ON g.date_key = d.date_key
  GROUP BY d.month, d.month_name)"""
    q["report15_compact"] = """
SELECT name, squad_size, foreigners_number, average_age FROM c_dim_club"""
    q["report15_full"] = f"""
SELECT c.club_key, c.name, c.squad_size, c.average_age, c.foreigners_number,
  c.foreigners_percentage, c.national_team_players, COALESCE(x.total_wins, 0) AS total_wins,
  COALESCE(x.total_matches, 0) AS total_matches, COALESCE(x.win_rate, 0) AS win_rate
FROM f_dim_club c LEFT JOIN (
  SELECT club_key, CAST(SUM(CASE WHEN won THEN 1 ELSE 0 END) AS BIGINT) AS total_wins,
    COUNT(*) AS total_matches,
    {r('(SUM(CASE WHEN won THEN 1 ELSE 0 END)::DOUBLE / COUNT(*)) * 100', 2)} AS win_rate
  FROM f_fact_club_perf GROUP BY club_key) x ON c.club_key = x.club_key
WHERE c.squad_size > 0"""
    return q


# ------------------------------------------------------------------ operators, layers
def _merge(how: str) -> str:
    key = "COALESCE(a.game_id, g.game_id)" if how in ("RIGHT", "FULL OUTER") else "a.game_id"
    return f"""
SELECT {key} AS game_id, a.appearance_id, a.player_id, a.player_club_id,
  COALESCE(a.competition_id, g.competition_id) AS competition_id,
  COALESCE(a.date, g.date) AS date, a.goals, a.assists, a.yellow_cards, a.red_cards,
  a.minutes_played, g.season, g.round, g.home_club_id, g.away_club_id, g.home_club_goals,
  g.away_club_goals, g.home_club_position, g.away_club_position, g.attendance,
  g.competition_type, g.season_year, g.total_goals
FROM s_appearances a {how} JOIN s_games g ON a.game_id = g.game_id"""


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]

LAYERS = {
    "raw": ["players", "appearances", "club_games", "clubs", "competitions", "game_events",
            "games", "player_valuations"],
    "silver": ["players", "appearances", "games", "clubs", "competitions", "game_events",
               "club_games", "player_valuations"],
    "gold": ["dim_player", "dim_club", "dim_competition", "dim_date", "fact_appearance",
             "fact_game", "fact_club_perf"],
}


def _layer_counts() -> str:
    parts = []
    for t in LAYERS["raw"]:
        parts.append(f"SELECT 'raw' AS layer, '{t}' AS table_name, COUNT(*) AS row_count "
                     f"FROM raw_{t}")
    for t in LAYERS["silver"]:
        parts.append(f"SELECT 'silver', '{t}', COUNT(*) FROM s_{t}")
    for t in LAYERS["gold"]:
        parts.append(f"SELECT 'gold', '{t}', COUNT(*) FROM c_{t}")
    return "\nUNION ALL ".join(parts)


def _others() -> dict[str, str]:
    q = {}
    q["normalize_nulls"] = f"SELECT {_nz(COLS['players'], TEXT['players'], False)} FROM raw_players"
    q["normalize_nulls_strict"] = (f"SELECT {_nz(COLS['players'], TEXT['players'], True)} "
                                   f"FROM raw_players")
    q["dedupe_single"] = _first_per_key("lineitem", ["l_orderkey"], LINEITEM_COLS)
    q["dedupe_composite"] = _first_per_key("raw_club_games", ["game_id", "club_id"],
                                           COLS["club_games"])
    q["fill_defaults"] = """
SELECT club_id, COALESCE(name, 'Unknown Club') AS name, club_code, domestic_competition_id,
  COALESCE(squad_size, 0) AS squad_size, COALESCE(average_age, 0.0) AS average_age,
  COALESCE(foreigners_number, 0) AS foreigners_number, foreigners_percentage,
  national_team_players, stadium_name, stadium_seats, total_market_value, net_transfer_record,
  coach_name, last_season
FROM s_n_clubs"""
    q["conform_dates"] = """
SELECT * REPLACE (TRY_CAST(date AS DATE) AS date) FROM raw_appearances"""
    for how, name in (("INNER", "inner"), ("LEFT", "left"), ("RIGHT", "right"),
                      ("FULL OUTER", "full")):
        q[f"merge_join_{name}"] = _merge(how)
    q["player_age"] = "SELECT player_id, date_of_birth, age FROM sf_players"
    q["ingestion_stamp"] = "SELECT club_id, name, ingestion_timestamp FROM sf_clubs"
    for t in LAYERS["silver"]:
        key = "valuations" if t == "player_valuations" else t
        q[f"silver_{key}"] = f"SELECT * FROM s_{t}"
    for t in LAYERS["gold"]:
        q[t] = f"SELECT * FROM c_{t}"
        q[f"{t}_full"] = f"SELECT * FROM f_{t}"
    q["parquet_scan"] = "SELECT * FROM raw_appearances"
    q["parquet_roundtrip"] = "SELECT * FROM raw_games"
    q["csv_roundtrip"] = "SELECT * FROM raw_players"
    counts = [f"SELECT '{t}' AS table_name, 'ok' AS status, COUNT(*) AS row_count, "
              f"CAST(NULL AS VARCHAR) AS error FROM raw_{t}"
              for t in LAYERS["raw"]]
    counts.append("SELECT 'transfers', 'missing', CAST(NULL AS BIGINT), 'no such file'")
    q["ingest_status"] = "\nUNION ALL ".join(counts)
    q["csv_ingest_rejects"] = """
WITH n AS (SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE player_club_id % 7 = 0) AS a,
  COUNT(*) FILTER (WHERE player_club_id % 11 = 0) AS m FROM raw_appearances)
SELECT c AS column_name, kind, row_count,
  CAST(CASE c WHEN 'assists' THEN a WHEN 'minutes_played' THEN m ELSE 0 END AS BIGINT) AS unparsed_cells
FROM n, (VALUES ('game_id', 'typed'), ('player_id', 'typed'), ('player_club_id', 'typed'),
  ('goals', 'typed'), ('assists', 'typed'), ('yellow_cards', 'typed'), ('minutes_played', 'typed'),
  ('note', 'extra'), ('red_cards', 'missing')) AS t(c, kind)"""
    for t in ("players", "appearances", "games", "clubs", "competitions", "game_events"):
        q[f"silver_{t}_full"] = f"SELECT * FROM sf_{t}"
    q["layer_row_counts"] = _layer_counts()
    q["written_row_counts"] = "\nUNION ALL ".join(
        f"SELECT 'bronze' AS layer, '{t}' AS table_name, COUNT(*) AS row_count FROM raw_{t}" for t in COLS)
    for name, fact in (("player_totals", "c_fact_appearance"), ("player_totals_full", "f_fact_appearance")):
        q[name] = f"""
SELECT player_key, season_year, competition_key, COUNT(*) AS apps, COUNT(game_key) AS games,
  CAST(SUM(goals) AS BIGINT) AS goals, COUNT(goals) AS n_goals, CAST(SUM(assists) AS BIGINT) AS assists,
  COUNT(assists) AS n_assists, CAST(SUM(yellow_cards) AS BIGINT) AS yellow_cards,
  CAST(SUM(red_cards) AS BIGINT) AS red_cards, CAST(SUM(minutes_played) AS BIGINT) AS minutes_played
FROM {fact} GROUP BY ALL"""
    q["ingest_rejects"] = r"""
WITH l AS (
  SELECT *, CASE WHEN player_club_id % 7 = 0 THEN 'n/a' ELSE assists::VARCHAR END AS odd_assists,
    CASE WHEN player_club_id % 11 = 0 THEN '90.5' ELSE minutes_played::VARCHAR END AS odd_minutes FROM raw_appearances
), r AS (
  SELECT *, array_to_string([coalesce(x, '\N') FOR x IN [appearance_id, game_id::VARCHAR, player_id::VARCHAR, player_club_id::VARCHAR,
    competition_id, date, goals::VARCHAR, odd_assists, yellow_cards::VARCHAR, odd_minutes]], ',') AS line FROM l
)
SELECT 'unparsed' AS reason, 'assists' AS column_name, 'n/a' AS cell, appearance_id, TRUE AS has_source
FROM r WHERE player_club_id % 7 = 0
UNION ALL SELECT 'unparsed', 'minutes_played', '90.5', appearance_id, TRUE FROM r WHERE player_club_id % 11 = 0
UNION ALL SELECT 'malformed', NULL, line || ',''late,again''', appearance_id, TRUE FROM r WHERE player_club_id % 13 = 0"""
    q["csv_dialect_roundtrip"] = """
SELECT * REPLACE (stadium_name || ' "The Ground"; Gate 1,' || chr(10) || 'Étage 2 ' AS stadium_name,
  CASE club_id % 5 WHEN 0 THEN '' WHEN 1 THEN '"' ELSE coach_name END AS coach_name) FROM raw_clubs"""
    twice = ("(SELECT * FROM raw_games UNION ALL SELECT * REPLACE (nullif(game_id, 3) AS game_id, CAST(NULL AS INTEGER) AS attendance) "
             "FROM raw_games WHERE game_id % 3 = 0)")
    q["dedupe_sparse_single"] = _first_per_key(twice, ["game_id"], COLS["games"])
    q["dedupe_sparse_composite"] = _first_per_key("raw_club_games", ["game_id", "club_id"], COLS["club_games"])
    q["quality_metrics"] = """
SELECT 'players_with_valid_dob' AS metric, COUNT(*) FILTER (WHERE date_of_birth IS NOT NULL)
  AS value FROM f_dim_player
UNION ALL SELECT 'players_with_position', COUNT(*) FILTER (WHERE position <> 'Unknown')
  FROM f_dim_player
UNION ALL SELECT 'total_goals', CAST(SUM(goals) AS BIGINT) FROM f_fact_appearance
UNION ALL SELECT 'total_assists', CAST(SUM(assists) AS BIGINT) FROM f_fact_appearance
UNION ALL SELECT 'total_games', COUNT(*) FROM f_fact_game"""
    return q


# Conformance counts: (table, keys when de-duplicated, required columns, text date columns).
_CONFORM = [
    ("players", ["player_id"], [], ["date_of_birth"]),
    ("appearances", None, ["player_id", "game_id"], ["date"]),
    ("games", ["game_id"], ["game_id"], ["date"]),
    ("clubs", ["club_id"], [], []),
    ("competitions", ["competition_id"], [], []),
    ("game_events", None, ["game_id"], []),
    ("club_games", ["game_id", "club_id"], [], []),
    ("player_valuations", None, [], ["date"]),
]


def _conform_quality(prefix: str, tables: list[str]) -> str:
    parts = []
    for t, keys, req, dates in _CONFORM:
        if t not in tables:
            continue
        src = f"{prefix}n_{t}"
        miss = " OR ".join(f"{c} IS NULL" for c in req) or "FALSE"
        unparsed = " + ".join(
            f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DATE) IS NULL)"
            for c in dates) or "0"
        kept_src = f"(SELECT DISTINCT {', '.join(keys)} FROM {src})" if keys else src
        parts.append(f"""
SELECT '{t}' AS table_name, i.rows_in, i.rows_in - k.kept AS duplicates_dropped, k.rejected,
  k.kept - k.rejected AS rows_out, i.unparsed_dates
FROM (SELECT COUNT(*) AS rows_in, CAST({unparsed} AS BIGINT) AS unparsed_dates FROM {src}) i,
     (SELECT COUNT(*) AS kept, COUNT(*) FILTER (WHERE {miss}) AS rejected FROM {kept_src}) k""")
    return "\nUNION ALL ".join(parts)


def _conform_rejects(prefix: str, tables: list[str]) -> str:
    parts = []

    def part(t, keys, reason, column, cell, copies, rest):
        key = " || '|' || ".join(f"COALESCE({k}::VARCHAR, '\\N')" for k in keys) or "''"
        parts.append(f"SELECT '{t}' AS table_name, '{reason}' AS reason, {column}::VARCHAR AS column_name, {key} AS row_key, "
                     f"{cell}::VARCHAR AS cell, {copies}::BIGINT AS copies FROM {rest}")

    named = {"appearances": ["appearance_id"]}
    for t, keys, req, dates in _CONFORM:
        if t not in tables:
            continue
        src, shown = f"{prefix}n_{t}", keys or named.get(t, req)
        if keys:
            rest = ", ".join(f"{c} NULLS FIRST" for c in COLS[t] if c not in keys)
            again = (f"(SELECT {', '.join(COLS[t])}, COUNT(*) AS c FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
                     f"{', '.join(keys)} ORDER BY {rest}) AS rn FROM {src}) WHERE rn > 1 GROUP BY ALL)")
            part(t, shown, "duplicate", "NULL", "NULL", "c", again)
        if req:
            lack = " OR ".join(f"{c} IS NULL" for c in req)
            names = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in req) + ")"
            rows = f"{prefix}d_{t}" if keys else src
            part(t, shown, "missing key", names, "NULL", "1", f"{rows} WHERE {lack}")
        for c in dates:
            part(t, shown, "unparsed", f"'{c}'", c, "1", f"{src} WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DATE) IS NULL")
        if t == "games":
            part(t, shown, "unparsed", "'season'", "season", "1", f"{src} WHERE season IS NOT NULL AND TRY_CAST(season AS INTEGER) IS NULL")
    return "\nUNION ALL ".join(parts)


def oracle_queries() -> dict[str, str]:
    bodies = {}
    bodies.update(_others())
    bodies.update(_reports())
    bodies["report_csv_export"] = bodies["report05_compact"]
    bodies["report11_from_totals"] = bodies["report11_full"]
    bodies["fact_appearance_bucketed"] = bodies["fact_appearance"]
    bodies["player_totals_bucketed"] = bodies["player_totals"]
    bodies["games_star_by_stats"] = """
SELECT g.game_key, g.competition_key, g.home_club_key, g.date_key, g.total_goals, c.name AS competition,
  k.name AS home_club, d.month_name
FROM c_fact_game g JOIN c_dim_competition c ON g.competition_key = c.competition_key
JOIN c_dim_club k ON g.home_club_key = k.club_key LEFT JOIN c_dim_date d ON g.date_key = d.date_key"""
    bodies["conform_rejects"] = _conform_rejects("s_", LAYERS["silver"])
    bodies["conform_rejects_full"] = _conform_rejects(
        "sf_", ["players", "appearances", "games", "clubs", "competitions", "game_events"])
    bodies["conform_quality"] = _conform_quality("s_", LAYERS["silver"])
    bodies["conform_quality_full"] = _conform_quality(
        "sf_", ["players", "appearances", "games", "clubs", "competitions", "game_events"])
    out = {name: with_ctes(body) for name, body in bodies.items()}
    out["report_status"] = "\nUNION ALL ".join(
        f"SELECT '{name}' AS report, 'present' AS status, (SELECT COUNT(*) FROM ({sql})) AS row_count, "
        f"CAST(NULL AS VARCHAR) AS error" for name, sql in sorted(out.items()) if re.fullmatch(r"report\d\d_full", name))
    return out
