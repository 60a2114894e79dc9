"""DuckDB text of the derived input views (twins of ``tidemark.sources.fixtures``).

Oracle queries name the views they need; ``with_views`` prepends them as
CTEs in dependency order so each oracle text is self-contained.
"""

from __future__ import annotations

import re

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# Bounds of the data, as ``fixtures.last_year`` and ``fixtures.event_days`` give them.
LAST_YEAR = "(SELECT CAST(max(year(o_orderdate)) AS INTEGER) FROM orders)"
FIRST_DAY = "(SELECT CAST(min(ts) AS DATE) FROM events)"
AS_OF = "(SELECT CAST(max(ts) AS DATE) FROM events)"

VIEWS: dict[str, str] = {
    "actor_films": """
        SELECT c.c_name AS actor, CAST(o.o_custkey AS VARCHAR) AS actorid,
               'film-' || CAST(o.o_orderkey AS VARCHAR) AS film,
               CAST(year(o.o_orderdate) AS INTEGER) AS year,
               CAST(o.o_orderkey % 1000 AS INTEGER) AS votes,
               CAST(floor(o.o_totalprice / 50000) AS DOUBLE) AS rating,
               CAST(o.o_orderkey AS VARCHAR) AS filmid
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "web_events": f"""
        SELECT event_id,
               CASE WHEN event_id % 20 = 0 THEN NULL ELSE user_id END AS user_id,
               CASE WHEN event_id % 11 <> 0 THEN CAST({K} % 16 AS INTEGER) END AS device_id,
               event_type || '.example.com' AS host,
               CAST(user_id % 25 AS VARCHAR) || '.' || event_type AS subhost,
               '10.0.0.' || CAST(user_id % 2 AS VARCHAR) AS ip,
               ts AS event_time,
               event_type
        FROM events""",
    "devices": """
        SELECT device_id, 'browser-' || CAST(device_id % 4 AS VARCHAR) AS browser_type
        FROM (SELECT DISTINCT device_id FROM web_events WHERE device_id IS NOT NULL)""",
    "games": """
        SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date_est,
               CAST(year(o_orderdate) AS INTEGER) AS season,
               CAST(o_custkey % 25 AS BIGINT) AS home_team_id,
               CAST((o_custkey % 25 + 1 + o_orderkey % 24) % 25 AS BIGINT) AS visitor_team_id,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 1
                         WHEN o_orderstatus = 'O' THEN 0
                         WHEN o_orderkey % 10 = 0 THEN NULL
                         ELSE o_orderkey % 2 END AS INTEGER) AS home_team_wins
        FROM orders""",
    "teams": """
        SELECT CAST(n_nationkey AS BIGINT) AS team_id, n_name AS nickname FROM nation
        UNION ALL
        SELECT CAST(n_nationkey AS BIGINT), n_name FROM nation WHERE n_nationkey < 5""",
    "game_details": """
        SELECT g.game_id,
               CASE WHEN l.l_linenumber % 2 = 1 THEN g.visitor_team_id ELSE g.home_team_id END AS team_id,
               l.l_suppkey AS player_id, s.s_name AS player_name, l.l_linestatus AS start_position,
               CASE WHEN l.l_quantity > 45 THEN NULL
                    ELSE CAST(CAST(l.l_quantity AS BIGINT) % 25 AS INTEGER) END AS pts
        FROM lineitem l JOIN games g ON l.l_orderkey = g.game_id
        JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "players": """
        SELECT c.c_name AS player_name, CAST(s.y AS INTEGER) AS current_season,
               EXISTS (SELECT 1 FROM orders o2 WHERE o2.o_custkey = s.cust
                       AND year(o2.o_orderdate) = s.y) AS is_active
        FROM (SELECT cust, unnest(range(first_y, (SELECT max(year(o_orderdate)) FROM orders) + 1)) AS y
              FROM (SELECT o_custkey AS cust, min(year(o_orderdate)) AS first_y
                    FROM orders GROUP BY o_custkey)) s
        JOIN customer c ON c.c_custkey = s.cust""",
    "matches": """
        SELECT o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS completion_date,
               CAST(o_custkey % 25 AS BIGINT) AS mapid, o_orderpriority AS playlist_id
        FROM orders""",
    "match_details": """
        SELECT l_orderkey AS match_id, l_suppkey AS player_gamertag,
               CAST(sum(l_quantity) AS BIGINT) AS player_total_kills
        FROM lineitem GROUP BY l_orderkey, l_suppkey
        UNION ALL SELECT o_orderkey, -o_custkey - 1, 0 FROM orders""",
    "medals_matches_players": """
        SELECT l.l_orderkey AS match_id, l.l_suppkey AS player_gamertag,
               CASE p.p_brand WHEN 'Brand#3' THEN '2896365521' WHEN 'Brand#5' THEN '1080468863' ELSE p.p_brand END AS medal_id,
               CAST(l.l_linenumber AS BIGINT) AS medal_count
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "medals": """
        SELECT p_brand AS medal_id, CASE p_brand WHEN 'Brand#3' THEN 'Team Takedown' WHEN 'Brand#5' THEN 'Perfect Kill'
               WHEN 'Brand#9' THEN NULL ELSE p_brand END AS name FROM part""",
    "maps": "SELECT CAST(n_nationkey AS BIGINT) AS mapid, n_name AS name FROM nation",
    "fx_rates": """
        SELECT o_orderpriority AS ccy, CAST(o_orderdate AS DATE) AS rate_date,
               CAST(sum(o_orderkey % 100) + 100 AS DOUBLE) AS rate
        FROM orders WHERE isodow(o_orderdate) <= 5
        GROUP BY 1, 2""",
    "activity": "SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day FROM orders",
    "ip_ranges": """
        SELECT CAST(167772160 + n_nationkey * 600000 AS BIGINT) AS ip_start,
               CAST(167772160 + n_nationkey * 600000 + 599999 AS BIGINT) AS ip_end,
               n_name AS country, CAST(n_regionkey AS INTEGER) AS region_key
        FROM nation""",
    "nested_ip_ranges": """
        SELECT ip_start, ip_start + n - 1 AS ip_end, network, level FROM (
          SELECT CAST(167772160 + n_nationkey * 600000 AS BIGINT) AS ip_start, 600000 AS n, n_name AS network, 1 AS level FROM nation
          UNION ALL SELECT CAST(167772160 + c_custkey * 10007 % 16000000 AS BIGINT), c_custkey % 4000 + 1, c_name, 2 FROM customer
          UNION ALL SELECT CAST(167772160 + s_suppkey * 40009 % 16000000 AS BIGINT), s_suppkey % 3 * 30000 + 700, s_name, 3 FROM supplier
          UNION ALL SELECT 0, 4294967296, r_name, 0 FROM region WHERE r_regionkey = 0)""",
    "client_events": """
        SELECT event_id, ip_num,
               CAST(ip_num // 16777216 % 256 AS VARCHAR) || '.' || CAST(ip_num // 65536 % 256 AS VARCHAR)
               || '.' || CAST(ip_num // 256 % 256 AS VARCHAR) || '.' || CAST(ip_num % 256 AS VARCHAR) AS ip
        FROM (SELECT event_id,
                     CAST(167772160 + (event_id * 7919 + coalesce(user_id, 0) * 104729) % 16777216 AS BIGINT)
                       AS ip_num
              FROM events)""",
}

# view -> views it reads
DEPS = {
    "devices": ["web_events"],
    "game_details": ["games"],
}


def _ordered(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named views (and what they depend on).

    If ``sql`` itself starts with WITH, its CTEs are appended after ours.
    """
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in _ordered(list(names)))
    body = sql.strip()
    m = re.match(r"(?is)^with\s+", body)
    if m:
        return f"WITH {ctes},\n{body[m.end():]}"
    return f"WITH {ctes}\n{body}"
