"""DuckDB SQL for the query catalogue, written against the flat tables.

It shares nothing with the operators: no JSON, no explode, no merge.
"""

from __future__ import annotations

SILVER = """
SELECT CAST(o_orderdate AS DATE) AS observation_date,
       CAST(o_orderkey AS VARCHAR) AS asteroid_id,
       CAST(o_custkey AS VARCHAR) AS neo_reference_id,
       '(' || o_orderkey || ')' AS name,
       'https://example.test/' || o_orderkey AS nasa_jpl_url,
       o_totalprice AS absolute_magnitude_h,
       o_totalprice / 1000 AS diameter_min_km,
       o_totalprice / 500 AS diameter_max_km,
       o_totalprice AS diameter_min_m,
       o_totalprice * 2 AS diameter_max_m,
       o_totalprice / 1609 AS diameter_min_mi,
       o_totalprice / 800 AS diameter_max_mi,
       o_totalprice * 3 AS diameter_min_ft,
       o_totalprice * 6 AS diameter_max_ft,
       o_orderpriority = '1-URGENT' AS is_potentially_hazardous,
       o_orderstatus = 'F' AS is_sentry_object,
       CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS close_approach_date,
       strftime(l_shipdate, '%Y-%m-%d') || ' ' || l_returnflag AS close_approach_date_full,
       CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS BIGINT) * 86400000
           AS epoch_date_close_approach,
       l_quantity AS velocity_kps,
       CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS velocity_kph,
       l_tax AS velocity_mph,
       l_discount AS miss_distance_au,
       l_extendedprice AS miss_distance_ld,
       l_quantity * 384400 AS miss_distance_km,
       CASE WHEN l_linestatus <> 'O' THEN l_extendedprice / CAST(1.609344 AS DOUBLE) END
           AS miss_distance_mi,
       'Earth' AS orbiting_body
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
"""

# The row that is largest in the columns behind the key, in silver order, NULL being smallest.
SILVER_ONCE = f"""
SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY observation_date, asteroid_id, epoch_date_close_approach
        ORDER BY neo_reference_id DESC, name DESC, nasa_jpl_url DESC,
                 absolute_magnitude_h DESC, is_potentially_hazardous DESC, is_sentry_object DESC,
                 close_approach_date DESC NULLS LAST, close_approach_date_full DESC,
                 velocity_kps DESC, velocity_kph DESC NULLS LAST, velocity_mph DESC,
                 miss_distance_au DESC, miss_distance_ld DESC, miss_distance_km DESC,
                 miss_distance_mi DESC NULLS LAST) AS nth
    FROM ({SILVER})) WHERE nth = 1
"""

CONVERTED = [
    "observation_date", "close_approach_date", "velocity_kps", "velocity_kph", "velocity_mph",
    "miss_distance_au", "miss_distance_ld", "miss_distance_km", "miss_distance_mi",
]

WEEK_START = (
    "DATE '1992-01-01' + CAST(7 * ((CAST(o_orderdate AS DATE) - DATE '1992-01-01') // 7) AS INTEGER)"
)

# Range of an order's object, NULL where the name has none.
NAMED = f"""
SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'bronze/' || o_orderkey || '/neo-latest.json'
            WHEN o_orderkey % 13 = 0 THEN 'bronze/' || o_orderkey || '/neo-1995-13-01_1995-13-07.json'
            WHEN o_orderkey % 17 = 0 THEN 'bronze/' || o_orderkey || '/neo-1995-02-24_1995-02-30.json'
            ELSE 'bronze/' || o_orderkey || '/neo-' || strftime({WEEK_START}, '%Y-%m-%d') || '_'
                 || strftime({WEEK_START} + 6, '%Y-%m-%d') || '.json' END AS object_name,
       CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0
            THEN {WEEK_START} END AS start_date,
       CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0
            THEN {WEEK_START} + 6 END AS end_date
FROM orders
"""

TARGET = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       CAST(o_orderdate AS DATE) AS day
FROM orders
"""
SOURCE = """
SELECT o_orderkey * 2 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
       o_orderpriority, CAST(o_orderdate AS DATE) AS day
FROM orders
"""

ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "day"]


def _merged(target: str, source: str, missing: tuple[str, ...] = ()) -> str:
    values = ", ".join(
        f"t.{c} AS {c}" if c in missing
        else f"CASE WHEN s.here THEN s.{c} ELSE t.{c} END AS {c}"
        for c in ORDER_VALUES
    )
    return f"""
    SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, {values}
    FROM ({target}) t FULL JOIN (SELECT *, TRUE AS here FROM ({source})) s
      ON t.o_orderkey = s.o_orderkey
    """


def _nulled(rows: str) -> str:
    return f"""
    SELECT CASE WHEN o_custkey % 10 <> 0 THEN o_orderkey END AS o_orderkey,
           o_custkey, o_orderstatus, o_totalprice, o_orderpriority, day
    FROM ({rows})
    """


def _histogram(rows: str, bins: int) -> str:
    return f"""
    WITH v AS ({rows}),
         b AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / {bins} AS w FROM v),
         c AS (SELECT CASE WHEN w = 0 THEN 0
                           ELSE least(CAST(floor((v - lo) / w) AS INTEGER), {bins - 1}) END AS bin,
                      count(*) AS n
               FROM v, b GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, lo + i * w AS bin_start,
           CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * w END AS bin_end,
           coalesce(c.n, 0) AS n
    FROM range({bins}) g(i) CROSS JOIN b LEFT JOIN c ON c.bin = g.i
    WHERE lo IS NOT NULL
    """


def _gold(columns: str) -> str:
    return f"SELECT {columns} FROM ({SILVER_ONCE})"


# Prices of the version of an order that lands last.
RAISED = "(SELECT * REPLACE (o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 5 WHEN o_orderkey % 3 = 0 THEN 3 ELSE 0 END AS o_totalprice) FROM orders) orders"
DAMAGED_STATUS = "CASE WHEN o_orderkey % 8 IN (2, 6) THEN 'no_days' ELSE 'malformed' END"

VIEW_ROWS = "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
VIEW_DAY = "CAST(o_orderdate AS DATE) = DATE '1995-02-18'"

ORACLES = {
    "feed_explode_days": """
        SELECT strftime(o_orderdate, '%Y-%m-%d') AS observation_date,
               CAST(o_orderkey AS VARCHAR) AS asteroid_id
        FROM orders""",
    "feed_flatten_silver": SILVER,
    "feed_malformed_to_null": f"""
        SELECT count(*) AS row_count, {', '.join(f'count({c}) AS n_{c}' for c in CONVERTED)}
        FROM ({SILVER})""",
    "feed_validate_split": """
        SELECT o_orderkey % 8 AS damage,
               CASE WHEN o_orderkey % 8 = 0 THEN 'valid'
                    WHEN o_orderkey % 8 IN (2, 6) THEN 'no_days'
                    ELSE 'malformed' END AS status,
               count(*) AS n
        FROM orders GROUP BY 1, 2""",
    "gold_project": f"""
        SELECT observation_date, name, velocity_kps, miss_distance_ld FROM ({SILVER})""",
    "load_audit_counts": f"""
        SELECT observation_date, count(*) AS row_count FROM ({SILVER}) GROUP BY 1""",
    "calendar_days": """
        SELECT CAST(unnest(range(CAST(min(o_orderdate) AS DATE),
                                 CAST(max(o_orderdate) AS DATE) + INTERVAL 1 DAY,
                                 INTERVAL 1 DAY)) AS DATE) AS all_dates
        FROM orders""",
    "coverage_from_names": NAMED,
    "coverage_days": f"""
        SELECT start_date + CAST(i AS INTEGER) AS all_dates, count(*) AS objects
        FROM ({NAMED}) CROSS JOIN range(7) g(i)
        WHERE start_date IS NOT NULL GROUP BY 1""",
    "missing_ranges": """
        WITH days AS (
            SELECT CAST(unnest(range(DATE '1992-01-01', DATE '2003-01-01', INTERVAL 1 DAY)) AS DATE) AS d),
        covered AS (
            SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE dayofweek(o_orderdate) <> 0)
        SELECT strftime(min(d), '%Y-%m-%d') AS start_date, strftime(max(d), '%Y-%m-%d') AS end_date
        FROM days WHERE d NOT IN (SELECT d FROM covered)
        GROUP BY (d - DATE '1992-01-01') // 7""",
    "covered_intervals": f"""
        WITH days AS (
            SELECT DISTINCT start_date + CAST(i AS INTEGER) AS d FROM ({NAMED}) CROSS JOIN range(7) g(i)
            WHERE start_date IS NOT NULL AND dayofyear(start_date) % 5 <> 0),
        numbered AS (SELECT d, d - CAST(row_number() OVER (PARTITION BY year(d) ORDER BY d) AS INTEGER) AS island FROM days)
        SELECT min(d) AS start_date, max(d) AS end_date FROM numbered GROUP BY year(d), island""",
    "upsert_merge": _merged(TARGET, SOURCE),
    "upsert_partial_columns": _merged(TARGET, SOURCE, ("o_custkey", "o_orderstatus")),
    "upsert_null_keys": _merged(_nulled(TARGET), _nulled(SOURCE)),
    "upsert_create": f"""
        SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM ({TARGET})""",
    "merge_key_violations": """
        SELECT CAST(o_orderdate AS DATE) AS observation_date,
               CAST(o_orderkey AS VARCHAR) AS asteroid_id, count(*) AS source_rows
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "newest_per_key": """
        SELECT * EXCLUDE (nth) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey
                ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                         l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
                         l_returnflag DESC, l_linestatus DESC) AS nth
            FROM lineitem) WHERE nth = 1""",
    "pending_objects": """
        SELECT 'bronze/order-' || o_orderkey || '.json' AS object_name FROM orders
        EXCEPT
        SELECT 'bronze/order-' || l_orderkey || '.json' FROM lineitem WHERE l_returnflag = 'R'""",
    "landed_objects": f"""
        SELECT DISTINCT {WEEK_START} AS start_date, {WEEK_START} + 6 AS end_date FROM orders""",
    "stream_increment": SILVER_ONCE,
    "layers_to_gold": f"""
        SELECT observation_date, name, velocity_kps, miss_distance_ld, asteroid_id,
               epoch_date_close_approach
        FROM ({SILVER_ONCE})""",
    "arrival_order": SILVER_ONCE.replace("FROM orders JOIN", f"FROM {RAISED} JOIN"),
    "rejected_documents": f"""
        SELECT {DAMAGED_STATUS} AS status, count(*) AS n
        FROM orders WHERE o_orderkey % 8 <> 0 GROUP BY 1""",
    "load_report": f"""
        SELECT CAST(turn AS INTEGER) AS turn, job,
               CASE WHEN turn = 1 THEN (SELECT count(*) FROM ({SILVER_ONCE})) ELSE 0 END AS row_count
        FROM range(1, 3) t(turn) CROSS JOIN (VALUES ('silver'), ('gold')) j(job)""",
    "broken_objects": f"""
        WITH w AS (SELECT DISTINCT (CAST(o_orderdate AS DATE) - DATE '1992-01-01') // 7 AS week FROM orders),
             s AS (SELECT (observation_date - DATE '1992-01-01') // 7 AS week, count(*) AS n
                   FROM ({SILVER_ONCE}) GROUP BY 1),
             o AS (SELECT week, CASE WHEN week % 8 IN (3, 7) THEN 'empty' WHEN week % 8 = 6 THEN 'unreadable'
                                     ELSE 'loaded' END AS outcome FROM w)
        SELECT outcome, CAST(CASE outcome WHEN 'unreadable' THEN 2 ELSE 0 END AS BIGINT) AS attempts,
               count(*) AS weeks,
               CAST(coalesce(sum(n) FILTER (outcome = 'loaded'), 0) AS BIGINT) AS silver_rows
        FROM o LEFT JOIN s USING (week) GROUP BY outcome""",
    "bounded_loads": SILVER_ONCE.replace("FROM orders JOIN", f"FROM {RAISED} JOIN"),
    "stored_date_bounds": _gold("min(observation_date) AS first_date, max(observation_date) AS last_date"),
    "stored_miss_distance": f"""
        {_gold("name, miss_distance_ld")} WHERE observation_date = DATE '1995-02-18'""",
    "stored_velocity_histogram": _histogram(
        _gold("velocity_kps AS v") + " WHERE observation_date = DATE '1995-02-18'", 10
    ),
    "stored_row_counts": f"""
        SELECT CAST(date_trunc('month', observation_date) AS DATE) AS observation_date_month, count(*) AS row_count
        FROM ({SILVER_ONCE}) GROUP BY 1""",
    "sql_surface": f"""
        WITH day AS (SELECT * FROM ({SILVER_ONCE}) WHERE observation_date = DATE '1995-02-18')
        SELECT a.asteroid_id, a.epoch_date_close_approach, m.name, m.miss_distance_ld
        FROM day a JOIN day m ON a.name = m.name AND a.miss_distance_ld IS NOT DISTINCT FROM m.miss_distance_ld""",
    "view_date_bounds": f"""
        SELECT CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date
        {VIEW_ROWS}""",
    "view_miss_distance": f"""
        SELECT '(' || o_orderkey || ')' AS name, l_extendedprice AS miss_distance_ld
        {VIEW_ROWS} WHERE {VIEW_DAY}""",
    "view_velocity_histogram": _histogram(f"SELECT l_quantity AS v {VIEW_ROWS} WHERE {VIEW_DAY}", 10),
    "histogram_all_days": _histogram(f"SELECT l_extendedprice AS v {VIEW_ROWS}", 25),
}
# the same days, whichever way they are kept
ORACLES["missing_ranges_kept"] = ORACLES["missing_ranges"]
