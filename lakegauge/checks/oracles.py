"""SQL over the same tables giving the same rows as each query."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Rows of a key-match report: `l` and `r` hold the left and right keys as column k and, where
# reported, a group s.
_MATCH_BODY = """
, rk AS (SELECT s, k, count(*) AS n FROM r GROUP BY s, k),
j AS (SELECT l.s, l.k, rk.k IS NOT NULL AS hit FROM l LEFT JOIN rk ON l.k = rk.k AND l.s = rk.s),
missed AS (SELECT DISTINCT s, k FROM j WHERE NOT hit),
ranked AS (SELECT s, k, row_number() OVER (PARTITION BY s ORDER BY k) AS i FROM missed),
shown AS (SELECT s, string_agg(CAST({shown} AS varchar), ',' ORDER BY k) AS sample FROM ranked WHERE i <= 10 GROUP BY s),
groups AS (SELECT s FROM l UNION SELECT s FROM r),
rates AS (SELECT s, count(*) AS left_rows, count(CASE WHEN hit THEN 1 END) AS matched FROM j GROUP BY s),
doubles AS (SELECT s, count(*) AS n FROM rk WHERE n > 1 GROUP BY s),
missing AS (SELECT s, count(*) AS n FROM missed GROUP BY s)
SELECT {lead} coalesce(left_rows, 0) AS left_rows, coalesce(matched, 0) AS matched,
       coalesce(left_rows - matched, 0) AS unmatched, coalesce(missing.n, 0) AS unmatched_keys,
       coalesce(doubles.n, 0) AS duplicate_right_keys,
       CASE WHEN coalesce(left_rows, 0) = 0 THEN 1.0e0 ELSE CAST(matched AS double) / left_rows END AS match_rate,
       coalesce(sample, '') AS unmatched_sample
FROM groups LEFT JOIN rates ON groups.s = rates.s LEFT JOIN doubles ON groups.s = doubles.s
LEFT JOIN missing ON groups.s = missing.s LEFT JOIN shown ON groups.s = shown.s
"""


def _match(left: str, right: str, shown: str = "k", lead: str = "") -> str:
    return f"WITH l AS ({left}), r AS ({right})" + _MATCH_BODY.format(shown=shown, lead=lead)


# Rows of a coverage report: `pooled` holds group s, key g and value v, `ref` the expected s and k.
_COVERAGE_BODY = """
, pg AS (SELECT s, g, count(*) AS n FROM (SELECT DISTINCT s, g, v FROM pooled) d GROUP BY s, g),
miss AS (SELECT s, k FROM ref WHERE NOT EXISTS (SELECT 1 FROM pg WHERE pg.g = ref.k AND pg.s = ref.s)),
ranked AS (SELECT s, k, row_number() OVER (PARTITION BY s ORDER BY k) AS i FROM miss),
shown AS (SELECT s, string_agg(CAST(k AS varchar), ',' ORDER BY k) AS sample FROM ranked WHERE i <= 10 GROUP BY s),
units AS (SELECT s, count(*) AS units, min(n) AS lo, median(n) AS mid, avg(n) AS mean, max(n) AS hi FROM pg GROUP BY s),
expected AS (SELECT s, count(*) AS n FROM ref GROUP BY s),
absent AS (SELECT s, count(*) AS n FROM miss GROUP BY s),
lows AS (SELECT pg.s, min(g) AS k FROM pg JOIN units ON pg.s = units.s AND pg.n = units.lo GROUP BY pg.s),
highs AS (SELECT pg.s, min(g) AS k FROM pg JOIN units ON pg.s = units.s AND pg.n = units.hi GROUP BY pg.s),
groups AS (SELECT s FROM ref UNION SELECT s FROM pg)
SELECT {lead} coalesce(units, 0) AS units, coalesce(expected.n, 0) AS reference_units,
       coalesce(absent.n, 0) AS missing_units, coalesce(lo, 0) AS minimum, coalesce(mid, 0.0e0) AS median,
       coalesce(mean, 0.0e0) AS mean, coalesce(hi, 0) AS maximum, lows.k AS minimum_key,
       highs.k AS maximum_key, coalesce(sample, '') AS missing_sample
FROM groups LEFT JOIN units ON groups.s = units.s LEFT JOIN expected ON groups.s = expected.s
LEFT JOIN absent ON groups.s = absent.s LEFT JOIN lows ON groups.s = lows.s
LEFT JOIN highs ON groups.s = highs.s LEFT JOIN shown ON groups.s = shown.s
"""


def _coverage(pooled: str, ref: str, lead: str = "") -> str:
    return f"WITH pooled AS ({pooled}), ref AS ({ref})" + _COVERAGE_BODY.format(lead=lead)


_YEAR = "CAST(year({}) AS bigint)"
_ORDER_YEAR = _YEAR.format("o_orderdate")
_SHIP_YEAR = _YEAR.format("l_shipdate")

ORACLES["join_report_orders"] = _match(
    "SELECT 0 AS s, o_orderkey AS k FROM orders", "SELECT 0 AS s, l_orderkey AS k FROM lineitem"
)
ORACLES["join_report_composite"] = _match(
    "SELECT 0 AS s, (l_partkey, l_suppkey) AS k FROM lineitem WHERE l_returnflag = 'A'",
    "SELECT 0 AS s, (l_partkey, l_suppkey) AS k FROM lineitem WHERE l_returnflag = 'R'",
    shown="concat(k[1], '/', k[2])",
)
ORACLES["join_report_by_season"] = _match(
    f"SELECT {_ORDER_YEAR} AS s, o_orderkey AS k FROM orders",
    f"SELECT {_SHIP_YEAR} AS s, l_orderkey AS k FROM lineitem",
    lead="groups.s AS season,",
)
ORACLES["match_marker"] = """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) THEN 1 ELSE 0 END AS matched
FROM orders
"""
ORACLES["missing_orders"] = """
SELECT DISTINCT o_orderkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
"""
ORACLES["unmatched_orders_sample"] = ORACLES["missing_orders"] + " ORDER BY o_orderkey LIMIT 10"
ORACLES["duplicate_line_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

ORACLES["coverage_report"] = _coverage(
    "SELECT 0 AS s, l_orderkey AS g, l_partkey AS v FROM lineitem UNION ALL SELECT 0, l_orderkey, l_suppkey FROM lineitem",
    "SELECT DISTINCT 0 AS s, o_orderkey AS k FROM orders",
)
ORACLES["coverage_by_season"] = _coverage(
    f"SELECT {_SHIP_YEAR} AS s, l_orderkey AS g, l_partkey AS v FROM lineitem "
    f"UNION ALL SELECT {_SHIP_YEAR}, l_orderkey, l_suppkey FROM lineitem",
    f"SELECT DISTINCT {_ORDER_YEAR} AS s, o_orderkey AS k FROM orders",
    lead="groups.s AS season,",
)
ORACLES["coverage_without_reference"] = """
WITH pg AS (SELECT user_id, count(DISTINCT event_type) AS n FROM events GROUP BY user_id)
SELECT count(*) AS units, CAST(NULL AS bigint) AS reference_units, CAST(0 AS bigint) AS missing_units,
       min(n) AS minimum, median(n) AS median, avg(n) AS mean, max(n) AS maximum,
       (SELECT min(user_id) FROM pg WHERE n = (SELECT min(n) FROM pg)) AS minimum_key,
       (SELECT min(user_id) FROM pg WHERE n = (SELECT max(n) FROM pg)) AS maximum_key
FROM pg
"""
ORACLES["pooled_distinct"] = """
SELECT l_orderkey, count(DISTINCT v) AS n_distinct
FROM (SELECT l_orderkey, l_partkey AS v FROM lineitem UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem) pooled
GROUP BY l_orderkey
"""
ORACLES["null_inclusive_distinct"] = """
SELECT event_type, count(*) AS n_distinct
FROM (SELECT DISTINCT event_type, CASE WHEN user_id % 7 <> 0 THEN user_id END AS u FROM events) d GROUP BY event_type
"""

ORACLES["prev_event"] = """
SELECT event_id, user_id, event_type,
       lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_type FROM events
"""
ORACLES["prev_event_large_groups"] = """
SELECT event_id, event_type,
       lag(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev_user_id FROM events
"""
_RUNNING = """
SELECT event_id, CAST(sum(CAST(round(value * 100) AS bigint)) OVER (PARTITION BY {} ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS running FROM events
"""
ORACLES["running_total_by_user"] = _RUNNING.format("user_id")
ORACLES["running_total_large_groups"] = _RUNNING.format("event_type")
ORACLES["running_total_of_doubles"] = """
SELECT event_id, sum(floor(value * 4096) / 4096.0) OVER (PARTITION BY event_type ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM events
"""
ORACLES["split_csv_documents"] = "SELECT doc_id, text, lang, source FROM documents"
ORACLES["group_sum_cents"] = """
SELECT event_type, CAST(sum(CAST(round(value * 100) AS bigint)) AS bigint) AS cents FROM events GROUP BY event_type
"""
ORACLES["filtered_min_event"] = "SELECT min(event_id) AS m FROM events WHERE event_type = 'click'"

ORACLES["strict_cast_lines"] = """
SELECT CAST(CAST(l_orderkey AS varchar) AS bigint) AS l_orderkey,
       CAST(CAST(l_quantity AS varchar) AS double) AS l_quantity, l_returnflag FROM lineitem
"""
ORACLES["header_drift_tables"] = """
SELECT 'customer' AS name, 'o_orderkey' AS missing, string_agg(column_name, ',') AS unexpected
FROM (DESCRIBE customer) WHERE column_name = 'c_custkey'
"""

ORACLES["name_parts"] = """
WITH named AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'odd_P' ELSE lower(o_orderstatus) || '_feed' ||
         CASE WHEN o_orderpriority = '1-URGENT' THEN '_po_' ELSE '_' END || year(o_orderdate) END AS name FROM orders)
SELECT o_orderkey, name,
       CASE WHEN regexp_matches(name, '^(.+?)(_po)?_([0-9]{4})$')
            THEN regexp_extract(name, '^(.+?)(_po)?_([0-9]{4})$', 1) ELSE name END AS source,
       CASE WHEN regexp_matches(name, '^(.+?)(_po)?_([0-9]{4})$')
            THEN CAST(regexp_extract(name, '^(.+?)(_po)?_([0-9]{4})$', 3) AS bigint) END AS season,
       CASE WHEN regexp_matches(name, '_po_[0-9]{4}$') THEN 1 ELSE 0 END AS playoffs
FROM named
"""
_PAGES = """
WITH entries AS (
  SELECT page_id AS line_no,
         'page_' || (page_id - CASE WHEN page_id % 10 = 9 THEN 1 ELSE 0 END) || '_2020' AS name,
         CASE WHEN url LIKE 'https:%' THEN 'https://raw.githubusercontent.com/own/repo/main/' || page_id || '.tar.xz'
              WHEN strpos(url, '?') > 0 THEN url END AS url
  FROM pages WHERE url NOT LIKE '%#%')
"""
ORACLES["manifest_table"] = _PAGES + "SELECT line_no, name, url FROM entries WHERE url IS NOT NULL"
ORACLES["manifest_fault_lines"] = (
    _PAGES
    + """
SELECT line_no, 'lacks' AS kind FROM entries WHERE url IS NULL
UNION ALL
SELECT line_no, 'repeats' AS kind
FROM (SELECT line_no, row_number() OVER (PARTITION BY name ORDER BY line_no) AS i FROM entries WHERE url IS NOT NULL)
WHERE i = 2
"""
)

ORACLES["archive_roundtrip"] = f"""
SELECT {_ORDER_YEAR} AS season, o_orderkey, strftime(o_orderdate, '%Y%m%d') AS o_orderdate, o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus FROM orders
"""
ORACLES["load_outcome"] = f"""
SELECT 'feed' || CASE WHEN o_orderpriority = '1-URGENT' THEN '_po_' ELSE '_' END || year(o_orderdate) AS name,
       {_ORDER_YEAR} AS season, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS playoffs, count(*) AS rows
FROM orders GROUP BY 1, 2, 3
"""
ORACLES["archive_texts"] = "SELECT CAST(doc_id AS varchar) AS doc_id, text, lang, source FROM documents"
ORACLES["parquet_roundtrip"] = "SELECT * FROM customer"
ORACLES["pending_loads"] = """
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""
ORACLES["fingerprint"] = "SELECT doc_id, sha256(text) AS sha256 FROM documents"
ORACLES["checksum_statuses"] = """
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'unrecorded' WHEN l.toxic = 1 THEN 'stale' ELSE 'valid' END AS status
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

_GAMES = f"SELECT {_ORDER_YEAR} AS s, CAST(o_orderkey AS varchar) AS k FROM orders WHERE o_orderpriority <> '1-URGENT'"
_IN_BOTH = (
    f"IN (SELECT {_ORDER_YEAR} FROM orders WHERE o_orderpriority <> '1-URGENT' "
    f"INTERSECT SELECT {_SHIP_YEAR} FROM lineitem)"
)
ORACLES["shotdetail_event_join"] = (
    _match(
        f"SELECT {_SHIP_YEAR} AS s, (CAST(l_orderkey AS varchar), CAST(l_linenumber AS bigint)) AS k FROM lineitem "
        f"WHERE {_SHIP_YEAR} {_IN_BOTH}",
        f"SELECT {_ORDER_YEAR} AS s, (CAST(o_orderkey AS varchar), o_custkey % 7 + 1) AS k FROM orders "
        f"WHERE o_orderpriority <> '1-URGENT' AND {_ORDER_YEAR} {_IN_BOTH}",
        shown="concat(k[1], '/', k[2])",
        lead="'shotdetail_' || groups.s AS left, 'nbastats_' || groups.s AS right, groups.s AS season,",
    )
    .replace(" AS left,", ' AS "left",')
    .replace(" AS right,", ' AS "right",')
)
ORACLES["matchups_game_coverage"] = _coverage(
    f"SELECT * FROM (SELECT {_SHIP_YEAR} AS s, CAST(l_orderkey AS varchar) AS g, l_partkey AS v FROM lineitem "
    f"UNION ALL SELECT {_SHIP_YEAR}, CAST(l_orderkey AS varchar), l_suppkey FROM lineitem) WHERE s {_IN_BOTH}",
    f"SELECT DISTINCT s, k FROM ({_GAMES}) WHERE s {_IN_BOTH}",
    lead="'matchups_' || groups.s AS dataset, groups.s AS season,",
)
ORACLES["datanba_game_coverage"] = _coverage(
    f"SELECT {_SHIP_YEAR} AS s, CAST(l_orderkey AS varchar) AS g, CASE WHEN l_returnflag <> 'A' THEN l_partkey END AS v "
    f"FROM lineitem WHERE {_SHIP_YEAR} {_IN_BOTH}",
    f"SELECT DISTINCT s, k FROM ({_GAMES}) WHERE s {_IN_BOTH}",
    lead="'datanba_' || groups.s AS dataset, groups.s AS season,",
)

ORACLES["season_view"] = f"SELECT {_ORDER_YEAR} AS season, count(*) AS n FROM orders GROUP BY 1"
ORACLES["season_min_max"] = f"SELECT min({_ORDER_YEAR}) AS lo, max({_ORDER_YEAR}) AS hi FROM orders"
ORACLES["flat_view"] = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
ORACLES["view_join"] = f"""
SELECT {_SHIP_YEAR} AS season, count(*) AS shots FROM lineitem JOIN orders
  ON {_SHIP_YEAR} = {_ORDER_YEAR} AND l_orderkey = o_orderkey AND l_linenumber = o_custkey % 7 + 1
GROUP BY 1
"""
ORACLES["catalog_views"] = """
SELECT 'bronze.nbastats' AS view, count(*) AS n FROM orders
UNION ALL SELECT 'bronze.datanba', count(*) FROM lineitem
UNION ALL SELECT 'silver.part', count(*) FROM part
UNION ALL SELECT 'gold.nation', count(*) FROM nation
"""

ORACLES["compare_statuses"] = """
WITH a AS (SELECT user_id AS k, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY user_id),
     b AS (SELECT user_id AS k, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY user_id)
SELECT CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only'
            WHEN a.n = b.n THEN 'match' ELSE 'mismatch' END AS status, count(*) AS n
FROM a FULL OUTER JOIN b ON a.k = b.k GROUP BY 1
"""
ORACLES["row_difference"] = """
SELECT l_partkey, l_suppkey, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS left_rows,
       count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS right_rows
FROM lineitem WHERE l_linestatus IN ('F', 'O') GROUP BY l_partkey, l_suppkey
HAVING count(CASE WHEN l_linestatus = 'F' THEN 1 END) <> count(CASE WHEN l_linestatus = 'O' THEN 1 END)
"""
_SNAPSHOTS = f"""
WITH a AS (SELECT {_SHIP_YEAR} AS season, l_orderkey, l_linenumber, CAST(l_quantity AS bigint) AS l_quantity FROM lineitem),
     b AS (SELECT season, l_orderkey, l_linenumber,
                  l_quantity * CASE WHEN season = 1995 AND l_linenumber = 1 THEN 2 ELSE 1 END AS l_quantity
           FROM a WHERE season <> 1996 OR l_linenumber <> 2),
     counted AS (SELECT season, l_orderkey, l_linenumber, l_quantity, sum(l) AS left_rows, sum(r) AS right_rows
                 FROM (SELECT *, 1 AS l, 0 AS r FROM a UNION ALL SELECT *, 0, 1 FROM b) both_sides
                 GROUP BY season, l_orderkey, l_linenumber, l_quantity)
"""
ORACLES["unequal_partitions"] = f"""{_SNAPSHOTS}
SELECT season, CAST(sum(left_rows) AS bigint) AS left_rows, CAST(sum(right_rows) AS bigint) AS right_rows,
       min(CASE WHEN left_rows = right_rows THEN 1 ELSE 0 END) AS equal
FROM counted GROUP BY season
"""
ORACLES["row_difference_by_season"] = f"""{_SNAPSHOTS}
SELECT season, l_orderkey, l_linenumber, l_quantity, CAST(left_rows AS bigint) AS left_rows,
       CAST(right_rows AS bigint) AS right_rows
FROM counted WHERE left_rows <> right_rows
"""
ORACLES["distinct_by_bitmaps"] = """
SELECT l_returnflag, count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS n_distinct
FROM (SELECT l_returnflag, l_partkey AS v FROM lineitem
      UNION ALL SELECT l_returnflag, CASE WHEN l_linenumber <> 1 THEN l_suppkey END FROM lineitem) pooled
GROUP BY l_returnflag
"""
ORACLES["stream_reload"] = """
SELECT CAST(o_orderkey AS varchar) AS game,
       o_custkey % 7 + 1 + CASE WHEN o_orderpriority = '1-URGENT' THEN 100 ELSE 0 END AS event
FROM orders
"""
ORACLES["compare_to_answer_key"] = """
WITH key AS (SELECT l_orderkey AS g, l_linenumber AS p, CAST(sum(l_quantity) AS bigint) AS q
             FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
     mine AS (SELECT l_orderkey AS g, l_linenumber AS p, CAST(sum(l_quantity) AS bigint) AS q
              FROM lineitem GROUP BY 1, 2 HAVING l_orderkey IN (SELECT g FROM key))
SELECT CASE WHEN mine.g IS NULL THEN 'right_only' WHEN key.g IS NULL THEN 'left_only'
            WHEN mine.q = key.q THEN 'match' ELSE 'mismatch' END AS status, count(*) AS n
FROM mine FULL OUTER JOIN key ON mine.g = key.g AND mine.p = key.p GROUP BY 1
"""
ORACLES["canonical_fields"] = """
SELECT o_orderkey, lpad(CAST(o_orderkey AS varchar), CAST(greatest(10, length(CAST(o_orderkey AS varchar))) AS integer), '0') AS game_id,
       CAST((o_orderkey % 130 % 13) * 60 + o_custkey % 130 % 60 AS double) AS seconds,
       strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 130 AS home, o_custkey % 130 AS visitor,
       o_orderkey % 130 - o_custkey % 130 AS margin
FROM orders
"""

ORACLES["archive_nullable_column"] = "SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey FROM orders"
_FEED_NAME = "'feed' || CASE WHEN o_orderpriority = '1-URGENT' THEN '_po_' ELSE '_' END || year(o_orderdate)"
ORACLES["capture_runs"] = f"""
WITH landed AS (SELECT {_FEED_NAME} AS name, count(*) AS rows FROM orders GROUP BY 1)
SELECT 1 AS run, name, 0 AS skipped, rows FROM landed
UNION ALL SELECT 2, name, 1, NULL FROM landed
"""
ORACLES["bronze_load"] = f"""
SELECT 'nbastats' || CASE WHEN o_orderpriority = '1-URGENT' THEN '_po_' ELSE '_' END || year(o_orderdate) AS name,
       'nbastats' AS source, {_ORDER_YEAR} AS season,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS playoffs, count(*) AS rows
FROM orders GROUP BY 1, 2, 3, 4
"""
ORACLES["answer_key_load"] = f"""
SELECT {_SHIP_YEAR} AS season, CAST(l_orderkey AS varchar) AS "GAMEID", CAST(l_linenumber AS bigint) AS "PERIOD",
       l_returnflag AS "URL" FROM lineitem
"""
ORACLES["failed_reload"] = "SELECT o_orderkey, CAST(o_custkey AS bigint) AS o_custkey FROM orders"
ORACLES["header_drift_rows"] = """
SELECT CAST(o_orderkey AS varchar) AS name, CASE WHEN o_orderstatus = 'F' THEN 'o_custkey' ELSE '' END AS missing,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'o_extra' ELSE '' END AS unexpected
FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '1-URGENT'
"""
ORACLES["restricted_stays_invisible"] = "SELECT 'silver.part' AS view, count(*) AS n FROM part"
ORACLES["season_landed_later"] = ORACLES["season_view"]
