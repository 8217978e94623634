"""Assembles the check SQL from named common table expressions."""

from __future__ import annotations

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql.strip(), needs)


def sql(body: str, *needs: str) -> str:
    """``body`` preceded by the expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in CTES[name][1]:
            visit(need)
        order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{name} AS MATERIALIZED (\n{CTES[name][0]}\n)" for name in order)
    return f"WITH {parts}\n{body.strip()}"


cte("ratings", """
SELECT o.o_custkey AS user_id, l.l_partkey + 1 AS item_id,
       CAST(avg(1 + floor((l.l_quantity - 1) / 10)) AS DOUBLE) AS rating, max(o.o_orderdate) AS ts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey, l.l_partkey + 1
""")
cte("items_raw", """
SELECT p_partkey + 1 AS item_id,
       concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') AS title,
       concat(p_type, '|', replace(p_name, ' ', '|')) AS genres_text
FROM part
""")
cte("items", r"""
SELECT item_id, title, genres_text,
       TRY_CAST(regexp_extract(title, '\((\d{4})\)$', 1) AS INTEGER) AS year,
       regexp_replace(regexp_replace(title, '\s*\(\d{4}\)$', ''), '^\s+|\s+$', '', 'g') AS clean_title,
       list_transform(string_split(genres_text, '|'), lambda g: trim(g)) AS genres
FROM items_raw
""", "items_raw")
cte("item_genres", "SELECT item_id, unnest(genres) AS genre FROM items", "items")
cte("sessions", """
SELECT event_id, user_id AS session_id, ts, event_type,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
       CAST(1 + least(4, floor(value / 20)) AS DOUBLE) AS rating
FROM events
""")
cte("session_ratings", """
SELECT session_id, item_id, rating, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY session_id, item_id ORDER BY ts DESC, event_id DESC) AS rn FROM sessions)
WHERE rn = 1
""", "sessions")
cte("item_stats_raw", """
SELECT item_id, count(*) AS n, avg(rating) AS avg_raw, stddev_samp(rating) AS std_raw,
       median(rating) AS median_raw, count(DISTINCT user_id) AS users
FROM ratings GROUP BY item_id
""", "ratings")
