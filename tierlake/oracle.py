"""Oracle SQL (DuckDB dialect) for every query key.

The views ``events customer nation region ...`` are the given tables.  The
CTEs below state the listing model with the same fixed mapping as
``tierlake.sources.fixtures``, so that a second engine checks the Spark
operators.  The reports share two summaries: ``market`` by place, type and
day, ``book`` by agent, city and type.
"""

from __future__ import annotations

# ---------------------------------------------------------------- model CTEs

_GEO = """
geo AS (
  SELECT n.n_nationkey, r.r_name AS city, n.n_name AS locality
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

_LISTING = _GEO + """,
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.value,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
         CASE WHEN e.event_type IN ('click', 'signup') THEN 'NEW_LISTING'
              WHEN e.event_type IN ('view', 'purchase') THEN 'PRICE_CHANGE'
              WHEN e.event_type = 'error' THEN 'REMOVED' END AS etype
  FROM events e
),
listing AS (
  SELECT ev.event_id,
         CAST(ev.event_id AS VARCHAR) AS listing_id,
         ev.etype AS event_type, g.city, g.locality,
         CASE WHEN ev.etype = 'REMOVED' THEN NULL
              ELSE CAST(round(ev.value * 100) AS BIGINT) END AS price,
         CAST(ev.k % 5 + 1 AS INTEGER) AS bedrooms,
         CAST(ev.k * 25 + 500 AS INTEGER) AS area_sqft,
         CAST(ev.user_id AS VARCHAR) AS agent_id,
         strftime(ev.ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         ev.ts AS event_timestamp
  FROM ev LEFT JOIN geo g ON g.n_nationkey = ev.k % 25
),
bronze AS (
  SELECT listing_id,
         CASE WHEN event_id % 3 = 0 THEN '  ' || lower(event_type) || ' '
              ELSE event_type END AS event_type,
         CASE WHEN event_id % 7 = 0 THEN ' ' || city || '  ' ELSE city END AS city,
         locality, price, bedrooms, area_sqft, agent_id, "timestamp", 'stream' AS source
  FROM listing
  UNION ALL
  SELECT listing_id,
         CASE WHEN event_id % 3 = 0 THEN '  ' || lower(event_type) || ' '
              ELSE event_type END,
         CASE WHEN event_id % 7 = 0 THEN ' ' || city || '  ' ELSE city END,
         locality, price, bedrooms, area_sqft, agent_id, "timestamp", 'replay'
  FROM listing WHERE event_id % 10 = 0
),
silver AS (
  SELECT listing_id, event_type, city, locality, COALESCE(price, 0) AS price,
         bedrooms, area_sqft, agent_id, event_timestamp,
         TIMESTAMP '2024-01-31 00:00:00' AS ingestion_timestamp
  FROM listing
),
market AS (
  SELECT city, locality, event_type, date_trunc('day', event_timestamp) AS event_date,
         count(*) AS k, count(listing_id) AS listings,
         count(listing_id) FILTER (WHERE price > 0) AS priced,
         CAST(sum(price) FILTER (WHERE price > 0) AS DOUBLE) AS s,
         count(*) FILTER (WHERE price > 0) AS n,
         max(price) FILTER (WHERE price > 0) AS hi, min(price) FILTER (WHERE price > 0) AS lo
  FROM silver GROUP BY ALL
),
book AS (
  SELECT agent_id, city, event_type, count(*) AS k, count(listing_id) AS listings,
         count(listing_id) FILTER (WHERE price > 0) AS priced,
         CAST(sum(price) FILTER (WHERE price > 0) AS DOUBLE) AS s,
         count(*) FILTER (WHERE price > 0) AS n,
         max(price) AS top, min(price) FILTER (WHERE price > 0) AS lo
  FROM silver GROUP BY ALL
)"""

_AGENTS = """,
master AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS agent_id, c.c_name AS agent_name,
         g.locality AS base_city, c.c_mktsegment AS tier,
         CAST(c.c_acctbal AS DOUBLE) AS rating,
         CAST(c.c_custkey % 300 AS BIGINT) AS total_deals,
         c.c_custkey, c.c_nationkey
  FROM customer c LEFT JOIN geo g ON g.n_nationkey = c.c_nationkey
),
scd1 AS (
  SELECT agent_id, agent_name, base_city,
         CASE WHEN c_custkey % 10 = 3 THEN 'BUILDING' ELSE tier END AS tier,
         rating, total_deals
  FROM master
  UNION ALL
  SELECT 'N' || CAST(c_custkey AS VARCHAR), agent_name, base_city, tier, rating,
         CAST(0 AS BIGINT)
  FROM master WHERE c_custkey % 300 = 7
),
feed2 AS (
  SELECT m.agent_id, m.agent_name, g.locality AS base_city, m.tier, m.rating, m.total_deals
  FROM master m LEFT JOIN geo g ON g.n_nationkey = (m.c_nationkey + 7) % 25
  WHERE m.c_custkey % 10 = 0
),
moved AS (
  SELECT f.* FROM feed2 f JOIN scd1 s ON s.agent_id = f.agent_id
  WHERE f.base_city IS DISTINCT FROM s.base_city
),
scd2 AS (
  SELECT s.agent_id, s.agent_name, s.base_city, s.tier, s.rating, s.total_deals,
         TIMESTAMP '2024-01-01 00:00:00' AS effective_start_date,
         CASE WHEN mv.agent_id IS NOT NULL THEN TIMESTAMP '2024-01-15 00:00:00' END
           AS effective_end_date,
         mv.agent_id IS NULL AS is_current,
         CAST(1 AS INTEGER) AS scd_version
  FROM scd1 s LEFT JOIN moved mv ON s.agent_id = mv.agent_id
  UNION ALL
  SELECT agent_id, agent_name, base_city, tier, rating, total_deals,
         TIMESTAMP '2024-01-15 00:00:00', CAST(NULL AS TIMESTAMP), TRUE, CAST(2 AS INTEGER)
  FROM moved
),
agents AS (SELECT * FROM scd2 WHERE is_current),
per_agent AS (
  SELECT agent_id, CAST(sum(listings) AS BIGINT) AS total_listings,
         ROUND(sum(s) / sum(n), 2) AS avg_price, max(top) AS top, min(lo) AS lo,
         map_from_entries(list((event_type, k))) AS by_type
  FROM (SELECT agent_id, event_type, sum(listings) AS listings, CAST(sum(k) AS BIGINT) AS k,
               sum(s) AS s, sum(n) AS n, max(top) AS top, min(lo) AS lo
        FROM book GROUP BY agent_id, event_type)
  GROUP BY agent_id
)"""


def _with(body: str, agents: bool = False) -> str:
    return "WITH " + _LISTING + (_AGENTS if agents else "") + "\n" + body


GOLD1 = """SELECT city, ROUND(sum(s) / sum(n), 2) AS avg_price, max(hi) AS max_price,
       min(lo) AS min_price, CAST(sum(priced) AS BIGINT) AS total_listings
FROM market WHERE event_type <> 'REMOVED' GROUP BY city HAVING sum(n) > 0"""

GOLD2 = """SELECT event_type, CAST(sum(listings) AS BIGINT) AS total_count
FROM market GROUP BY event_type"""

GOLD3 = """SELECT city, locality, event_date, ROUND(sum(s) / sum(n), 2) AS avg_price,
       CAST(sum(priced) AS BIGINT) AS listing_count
FROM market WHERE event_type <> 'REMOVED' GROUP BY 1, 2, 3 HAVING sum(n) > 0"""


def _rows_of(event_type: str) -> str:
    return f"CAST(coalesce(sum(k) FILTER (WHERE event_type = '{event_type}'), 0) AS BIGINT)"


GOLD4 = f"""SELECT city, CAST(sum(listings) AS BIGINT) AS total_events,
       {_rows_of('NEW_LISTING')} AS new_listings, {_rows_of('PRICE_CHANGE')} AS price_changes,
       {_rows_of('REMOVED')} AS removals
FROM market GROUP BY city"""

GOLD5 = """SELECT agent_id, agent_name, base_city, tier, rating, total_deals, total_listings,
       coalesce(by_type['NEW_LISTING'], 0) AS new_listings,
       coalesce(by_type['PRICE_CHANGE'], 0) AS price_changes,
       coalesce(by_type['REMOVED'], 0) AS removals,
       avg_price AS avg_listing_price, top AS max_listing_price, lo AS min_listing_price
FROM agents JOIN per_agent USING (agent_id)"""

GOLD6 = """, offers AS (
  SELECT agent_id, city, sum(s) AS s, sum(n) AS n, CAST(sum(priced) AS BIGINT) AS priced
  FROM book WHERE event_type <> 'REMOVED' GROUP BY 1, 2 HAVING sum(n) > 0
), gaps AS (
  SELECT agent_id, o.city, o.priced, ROUND(o.s / o.n, 2) AS own, level
  FROM offers o JOIN (SELECT city, ROUND(sum(s) / sum(n), 2) AS level FROM offers GROUP BY city) c
    ON c.city = o.city
)
SELECT agent_id, agent_name, tier, city, own AS agent_avg_price, level AS city_avg_price,
       priced AS total_listings, ROUND(own - level, 2) AS price_diff,
       ROUND((own - level) / level * 100, 2) AS pct_above_city_avg,
       ['BELOW AVERAGE', 'AT AVERAGE', 'ABOVE AVERAGE'][CAST(sign(own - level) AS INT) + 2]
         AS performance_flag
FROM gaps JOIN agents USING (agent_id)"""

GOLD7 = """, ladder AS (
  SELECT *, count(*) OVER (PARTITION BY tier ORDER BY total_listings DESC
                           RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead,
         sum(total_listings) OVER (PARTITION BY tier) AS of_tier
  FROM agents JOIN per_agent USING (agent_id)
)
SELECT tier, agent_id, agent_name, base_city, rating, total_listings, avg_price,
       ahead + 1 AS rank_within_tier,
       CAST(ROUND(total_listings * 100.0 / of_tier, 2) AS DOUBLE) AS pct_of_tier_listings
FROM ladder"""

GOLD8 = """, lives AS (
  SELECT *, count(*) OVER (PARTITION BY agent_id) AS versions FROM scd2
), trade AS (
  SELECT agent_id, city, CAST(sum(listings) AS BIGINT) AS listings, ROUND(sum(s) / sum(n), 2) AS price
  FROM book GROUP BY agent_id, city
)
SELECT agent_id, agent_name, city AS listing_city, listings AS listings_in_city,
       price AS avg_price_in_city, if(versions > 1, 'MOVED CITY', 'STABLE') AS agent_status,
       scd_version, effective_start_date, effective_end_date
FROM lives JOIN trade USING (agent_id)"""

DAILY = """, daily AS (
  SELECT city, event_date, ROUND(sum(s) / sum(n), 2) AS avg_price,
         CAST(sum(priced) AS BIGINT) AS listing_count
  FROM market WHERE event_type <> 'REMOVED' GROUP BY 1, 2 HAVING sum(n) > 0
)"""

GATES = """SELECT g.* FROM (
  SELECT COUNT(*) AS total,
         COUNT(*) FILTER (WHERE listing_id IS NULL) AS c1,
         COUNT(*) FILTER (WHERE "timestamp" IS NULL) AS c2,
         COUNT(*) FILTER (WHERE NOT (event_type IN ('NEW_LISTING', 'PRICE_CHANGE', 'REMOVED'))) AS c3,
         COUNT(*) FILTER (WHERE price < 0) AS c4,
         COUNT(*) FILTER (WHERE bedrooms <= 0 OR bedrooms > 20) AS c5,
         COUNT(*) - COUNT(DISTINCT (listing_id, event_type, "timestamp")) AS c6
  FROM bronze
) t, LATERAL (
  SELECT * FROM (VALUES
    ('completeness_listing_id', t.c1, t.total, t.c1 = 0),
    ('completeness_event_timestamp', t.c2, t.total, t.c2 = 0),
    ('validity_event_type', t.c3, t.total, t.c3 = 0),
    ('range_price', t.c4, t.total, t.c4 = 0),
    ('range_bedrooms', t.c5, t.total, t.c5 = 0),
    ('volume', CASE WHEN t.total = 0 THEN 1 ELSE 0 END::BIGINT, t.total, t.total > 0),
    ('uniqueness', t.c6, t.total, t.c6 = 0)
  ) v(check_name, violations, total, passed)
) g"""

def _feed_of_trend() -> str:
    """Changes of Gold 3 between the clean table as it was and as it is."""
    def trend(table: str) -> str:
        return f"""SELECT city, locality, date_trunc('day', event_timestamp) AS event_date,
       ROUND(CAST(sum(price) AS DOUBLE) / count(*), 2) AS avg_price, count(listing_id) AS listing_count
FROM {table} WHERE event_type <> 'REMOVED' AND price > 0 GROUP BY ALL"""

    def images(of: str, other: str, alone: str, changed: str) -> str:
        return f"""SELECT x.*, CASE WHEN y.listing_count IS NULL THEN '{alone}' ELSE '{changed}' END AS _change_type
FROM {of} x LEFT JOIN {other} y ON x.city IS NOT DISTINCT FROM y.city
     AND x.locality IS NOT DISTINCT FROM y.locality AND x.event_date IS NOT DISTINCT FROM y.event_date
WHERE y.listing_count IS NULL OR x.avg_price <> y.avg_price OR x.listing_count <> y.listing_count"""

    return "WITH " + _LISTING + f""",
yesterday AS (
  SELECT listing_id, event_type, city, locality, event_timestamp,
         CASE WHEN CAST(listing_id AS BIGINT) % 13 = 0 AND price > 0 THEN price + 5000000 ELSE price END AS price
  FROM silver WHERE CAST(listing_id AS BIGINT) % 11 <> 0
  UNION ALL
  SELECT 'gone-' || listing_id, event_type, city, locality, event_timestamp, price
  FROM silver WHERE CAST(listing_id AS BIGINT) % 17 = 0
),
was AS ({trend('yesterday')}),
now AS ({trend('silver')})
{images('now', 'was', 'insert', 'update_postimage')}
UNION ALL
{images('was', 'now', 'delete', 'update_preimage')}"""


ORACLE: dict[str, str] = {
    "silver_clean": _with("SELECT * FROM silver"),
    "dedup_latest": _with("""SELECT listing_id, event_type, city, locality, price, bedrooms,
       area_sqft, agent_id, event_timestamp, ingestion_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY agent_id
                               ORDER BY event_timestamp DESC, listing_id DESC) AS rn
  FROM silver) WHERE rn = 1"""),
    "dq_report": _with("""SELECT check_name AS "check", violations, total, passed FROM ("""
                       + GATES + ")"),
    "dq_uniqueness": _with("""SELECT listing_id, event_type, "timestamp", COUNT(*) AS copies
FROM bronze GROUP BY listing_id, event_type, "timestamp" HAVING COUNT(*) > 1"""),
    "dq_timeliness": _with("""SELECT 'timeliness' AS "check",
       COUNT(*) FILTER (WHERE event_timestamp < TIMESTAMP '2024-01-31 00:00:00'
                                               - INTERVAL 7 DAY) AS violations,
       COUNT(*) AS total,
       COUNT(*) FILTER (WHERE event_timestamp < TIMESTAMP '2024-01-31 00:00:00'
                                               - INTERVAL 7 DAY) = 0 AS passed
FROM silver"""),
    "filter_isin": _with("""SELECT agent_id, agent_name, base_city, tier, rating, total_deals
FROM master WHERE agent_id IN ('3', '13', '103', '1003')""", agents=True),
    "scan_count": _with("""SELECT 'bronze' AS layer, COUNT(*) AS row_count FROM bronze
UNION ALL SELECT 'silver', COUNT(*) FROM silver"""),
    "gold_avg_price_by_city": _with(GOLD1),
    "gold_listing_count_by_event": _with(GOLD2),
    "gold_price_trend_by_locality": _with(GOLD3),
    "gold_top_active_cities": _with(GOLD4),
    "point_filter_count": _with("""SELECT COUNT(*) AS count FROM silver
WHERE city = 'ASIA' AND event_type = 'NEW_LISTING'"""),
    "point_filter_city": _with("SELECT * FROM (" + GOLD1 + ") WHERE city = 'EUROPE'"),
    "point_filter_locality": _with("SELECT * FROM (" + GOLD3 + ") WHERE locality = 'NATION_7'"),
    "scd1_upsert": _with("SELECT * FROM scd1", agents=True),
    "change_feed": _with("""SELECT m.agent_id, m.agent_name, m.base_city, m.tier, m.rating,
       m.total_deals, 'update_preimage' AS _change_type
FROM master m JOIN scd1 s ON m.agent_id = s.agent_id WHERE m.tier IS DISTINCT FROM s.tier
UNION ALL
SELECT s.agent_id, s.agent_name, s.base_city, s.tier, s.rating, s.total_deals,
       'update_postimage'
FROM master m JOIN scd1 s ON m.agent_id = s.agent_id WHERE m.tier IS DISTINCT FROM s.tier
UNION ALL
SELECT s.*, 'insert' FROM scd1 s WHERE s.agent_id NOT IN (SELECT agent_id FROM master)""",
                         agents=True),
    "scd2_init": _with("""SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS effective_start_date,
       CAST(NULL AS TIMESTAMP) AS effective_end_date, TRUE AS is_current,
       CAST(1 AS INTEGER) AS scd_version FROM scd1""", agents=True),
    "scd2_apply": _with("SELECT * FROM scd2", agents=True),
    "scd2_current": _with("""SELECT agent_id, agent_name, base_city, tier, scd_version
FROM scd2 WHERE is_current""", agents=True),
    "scd2_history": _with("""SELECT agent_id, agent_name, base_city, is_current,
       effective_start_date, effective_end_date, scd_version
FROM scd2 WHERE agent_id = '10'""", agents=True),
    "scd2_changed_keys": _with("""SELECT agent_id, agent_name, COUNT(*) AS versions
FROM scd2 GROUP BY agent_id, agent_name HAVING COUNT(*) > 1""", agents=True),
    "scd2_counts": _with("""SELECT COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE is_current) AS current_records,
       COUNT(*) FILTER (WHERE NOT is_current) AS historical_records FROM scd2""",
                         agents=True),
    "scd2_dedup": _with("SELECT * FROM scd2", agents=True),
    "gold_agent_performance": _with(GOLD5, agents=True),
    "gold_agent_vs_city_benchmark": "WITH " + _LISTING + _AGENTS + GOLD6,
    "gold_top_agents_by_tier": "WITH " + _LISTING + _AGENTS + GOLD7,
    "gold_agent_city_movement": "WITH " + _LISTING + _AGENTS + GOLD8,
    "gold_trend_maintained": _with(GOLD3),
    "gold_change_feed": _feed_of_trend(),
    "sql_temp_views": _with("""SELECT a.tier, count(*) AS events, count(DISTINCT s.agent_id) AS agents,
       max(s.price) AS top_price
FROM silver s JOIN scd2 a ON a.agent_id = s.agent_id AND a.is_current GROUP BY a.tier""", agents=True),
    "agent_pre_post_move": _with("""SELECT h.agent_id, h.scd_version, h.base_city,
       h.effective_start_date, h.effective_end_date, COUNT(s.listing_id) AS listings,
       ROUND(AVG(CASE WHEN s.price > 0 THEN s.price END), 2) AS avg_price
FROM silver s JOIN scd2 h ON s.agent_id = h.agent_id
  AND s.event_timestamp >= h.effective_start_date
  AND (h.effective_end_date IS NULL OR s.event_timestamp < h.effective_end_date)
GROUP BY h.agent_id, h.scd_version, h.base_city, h.effective_start_date,
         h.effective_end_date""", agents=True),
    "ingestion_mark": _with("""SELECT event_type, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS marks,
       COUNT(*) AS stamped_in_run FROM silver GROUP BY event_type"""),
    "literal_feed": _with("""SELECT agent_id, agent_name, base_city, tier, rating, total_deals FROM master
WHERE agent_id NOT IN ('1', '2', 'L-1')
UNION ALL
SELECT * FROM (VALUES
  ('1', 'Agent One', 'FRANCE', 'BUILDING', CAST(4.5 AS DOUBLE), CAST(12 AS BIGINT)),
  ('2', 'Agent Two', NULL, 'MACHINERY', NULL, 0),
  ('L-1', 'Agent O''Hara', 'JAPAN', 'FURNITURE', 3.25, 7)) v""", agents=True),
    "window_dense_rank": "WITH " + _LISTING + DAILY + """
SELECT city, event_date, avg_price, listing_count,
       CAST(DENSE_RANK() OVER (PARTITION BY event_date ORDER BY avg_price DESC) AS BIGINT)
         AS price_rank
FROM daily""",
    "window_lag_trend": "WITH " + _LISTING + DAILY + """
SELECT city, event_date, avg_price, listing_count,
       LAG(avg_price) OVER (PARTITION BY city ORDER BY event_date) AS prev_avg_price,
       ROUND(avg_price - LAG(avg_price) OVER (PARTITION BY city ORDER BY event_date), 2)
         AS price_change
FROM daily""",
}

_CLEAN_RAW = """SELECT listing_id, event_type, city, locality, price, bedrooms, area_sqft,
       agent_id, "timestamp", 'stream' AS source FROM listing"""
_LANDING = """CASE WHEN "timestamp" < '2024-01-15' THEN 'batch_001' ELSE 'batch_002' END"""
_KEPT = """SELECT * FROM silver s WHERE NOT EXISTS (
  SELECT 1 FROM customer c
  WHERE c.c_custkey % 10 = 0 AND CAST(c.c_custkey AS VARCHAR) = s.agent_id)"""


def _ctes(gold: str) -> str:
    """The leading ``, name AS (...)`` CTE list of a gold query."""
    return gold[:gold.index("\nSELECT ")]


def _final(gold: str) -> str:
    return gold[gold.index("\nSELECT ") + 1:]


def _counts(parts: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM ({sql})"
        for name, sql in parts.items())


ORACLE.update({
    "bronze_json_stream": _with("SELECT * FROM bronze"),
    "stream_resume": _with(_CLEAN_RAW),
    "bronze_csv_stream": _with("""SELECT listing_id, event_type, city, locality,
       CASE WHEN event_type = 'REMOVED' THEN 0 ELSE price END AS price, bedrooms, area_sqft,
       agent_id, "timestamp", 'external-provider' AS source FROM listing"""),
    "bronze_csv_provenance": _with(f"""SELECT {_LANDING} AS landing, COUNT(*) AS row_count
FROM listing GROUP BY 1"""),
    "distinct_files": _with(f"SELECT DISTINCT {_LANDING} AS landing FROM listing"),
    "csv_roundtrip": _with("SELECT * FROM silver"),
    "sql_path_scan": _with("SELECT * FROM silver"),
    "overwrite_roundtrip": _with("""SELECT listing_id, event_type, city, locality, price,
       bedrooms, area_sqft, agent_id, event_timestamp,
       date_trunc('day', event_timestamp) AS event_date
FROM silver WHERE event_type <> 'REMOVED'"""),
    "schema_evolve": _with("""SELECT listing_id, event_type, city, locality, price, bedrooms,
       area_sqft, agent_id, "timestamp",
       CASE WHEN "timestamp" < '2024-01-15' THEN NULL ELSE 'stream' END AS source
FROM listing"""),
    "curve_layout": _with("SELECT * FROM silver"),
    "append_new_columns": _with("""SELECT listing_id, event_type, city, locality,
       CASE WHEN event_type = 'REMOVED' THEN NULL ELSE price END AS price,
       CASE WHEN event_type = 'REMOVED' THEN NULL ELSE bedrooms END AS bedrooms,
       area_sqft, agent_id, event_timestamp, ingestion_timestamp,
       CASE WHEN event_type IS DISTINCT FROM 'REMOVED'
                 AND NOT coalesce(event_timestamp < TIMESTAMP '2024-01-15', FALSE)
            THEN date_trunc('day', event_timestamp) END AS event_date
FROM silver"""),
    "silver_add_batch": _with("SELECT * FROM silver"),
    "increment_price_trend": _with(GOLD3),
    "scd2_merge_slices": _with("SELECT * FROM scd2", agents=True),
    "delete_by_key_slices": _with(_KEPT),
    "stream_compaction": _with("SELECT * FROM bronze"),
    "bronze_rescue": _with("""SELECT feed, outcome, count(*) AS row_count,
       CAST(sum(rescued) AS BIGINT) AS rescued_rows
FROM (SELECT 'events' AS feed,
             CASE WHEN event_id % 20 BETWEEN 1 AND 4 THEN 'malformed'
                  WHEN event_id % 20 = 5 THEN 'no body' ELSE 'kept' END AS outcome,
             CASE WHEN event_id % 20 = 6 THEN 1 ELSE 0 END AS rescued FROM listing
      UNION ALL
      SELECT 'drops', CASE WHEN event_id % 20 BETWEEN 7 AND 9 THEN 'malformed' ELSE 'kept' END, 0
      FROM listing) GROUP BY feed, outcome"""),
    "bounded_stream": _with("SELECT * FROM bronze"),
    "table_properties": _with("""SELECT table_name, label, CASE label WHEN 'tierlake.rows'
         THEN CAST(row_count AS VARCHAR) WHEN 'tierlake.tier'
         THEN CASE table_name WHEN 'silver' THEN 'clean' ELSE 'business' END END AS value
FROM (""" + _counts({"silver": "SELECT * FROM silver", "avg_price_by_city": GOLD1,
                     "listing_count_by_event": GOLD2, "price_trend_by_locality": GOLD3,
                     "top_active_cities": GOLD4}) + """) c
CROSS JOIN (VALUES ('tierlake.rows'), ('tierlake.tier')) l(label)"""),
    "compact_table": _with("SELECT * FROM silver"),
    "cluster_layout": _with("SELECT * FROM silver"),
    "delete_by_key": _with(_KEPT),
    "load_history": _with(f"""SELECT CAST(5 AS BIGINT) AS version, 'WRITE' AS operation,
       (SELECT COUNT(*) FROM silver) AS row_count
UNION ALL SELECT 4, 'OPTIMIZE', (SELECT COUNT(*) FROM ({_KEPT}))
UNION ALL SELECT 3, 'OPTIMIZE', (SELECT COUNT(*) FROM ({_KEPT}))
UNION ALL SELECT 2, 'DELETE', (SELECT COUNT(*) FROM ({_KEPT}))
UNION ALL SELECT 1, 'WRITE',
       (SELECT COUNT(*) FROM silver WHERE event_timestamp >= TIMESTAMP '2024-01-15')"""),
    "table_detail": _with("SELECT 'parquet' AS format, COUNT(*) AS num_rows FROM silver"),
    "layer_row_counts": _with(_counts({
        "bronze": "SELECT * FROM bronze", "silver": "SELECT * FROM silver",
        "avg_price_by_city": GOLD1, "listing_count_by_event": GOLD2,
        "price_trend_by_locality": GOLD3, "top_active_cities": GOLD4})),
    "catalog_counts": "WITH " + _LISTING + _AGENTS + _ctes(GOLD6) + _ctes(GOLD7)
                      + _ctes(GOLD8) + "\n" + _counts({
        "silver_property_events": "SELECT * FROM silver",
        "gold_avg_price_by_city": GOLD1, "gold_listing_count_by_event": GOLD2,
        "gold_price_trend_by_locality": GOLD3, "gold_top_active_cities": GOLD4,
        "gold_agent_performance": GOLD5, "gold_agent_vs_city_benchmark": _final(GOLD6),
        "gold_top_agents_by_tier": _final(GOLD7),
        "gold_agent_city_movement_impact": _final(GOLD8)}),
})


# ---------------------------------------------------------------- rounding
#
# Spark's ROUND on a DOUBLE rounds the value's shortest decimal text HALF_UP
# (an average of exactly 4597.525 becomes 4597.53).  DuckDB's ROUND on a
# DOUBLE works on the binary value (4597.52499999... -> 4597.52).  The
# reference's rounding is Spark's, so every ``ROUND(x, 2)`` of the oracle is
# evaluated the same way: shortest text -> DECIMAL -> ROUND -> DOUBLE.

def _spark_round(sql: str) -> str:
    out, i, token = [], 0, "ROUND("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 0, j + len(token) - 1
        while True:                      # find the matching ')'
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = sql[j + len(token):k]
        comma, depth = None, 0
        for p, ch in enumerate(inner):   # last top-level comma
            depth += ch == "("
            depth -= ch == ")"
            if ch == "," and depth == 0:
                comma = p
        expr, places = _spark_round(inner[:comma]), inner[comma + 1:].strip()
        out.append(f"CAST(ROUND(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), {places})"
                   f" AS DOUBLE)")
        i = k + 1


ORACLE = {key: _spark_round(sql) for key, sql in ORACLE.items()}
