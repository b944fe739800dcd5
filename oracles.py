"""DuckDB equivalents of the registered queries, on the driver tables.

``SPANS`` maps the tables to light spans exactly as ``testbed.py`` does, in SQL
and without looking at logs or raw tags.
"""

from __future__ import annotations

SPANS = """
lines AS (
  SELECT l_orderkey, l_linenumber, min(l_suppkey) AS suppkey, CAST(max(l_quantity) AS BIGINT) AS quantity,
         max(l_returnflag) AS flag
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
served AS (
  SELECT lines.*, s_nationkey, lower(n_name) AS service,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS nth
  FROM lines JOIN supplier ON s_suppkey = suppkey JOIN nation ON n_nationkey = s_nationkey
),
spans AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS trace_id, 'O' || o_orderkey AS span_id, '' AS parent_span_id,
         lower(c_mktsegment) AS service_name, o_orderpriority AS operation_name,
         1704067200000000 + (o_orderkey % 86400) * 1000000 AS start_us,
         200000 + (o_orderkey % 1000) * 100 AS duration_us, 'CLIENT' AS span_type, o_orderkey * 16 AS arrival_seq,
         CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS tag_error,
         CASE o_orderkey % 5 WHEN 0 THEN 'dc' WHEN 1 THEN 'aws,dc' ELSE 'aws' END AS tag_provider,
         CAST(c_nationkey % 3 + 1 AS VARCHAR) AS tag_tier
  FROM orders JOIN customer ON c_custkey = o_custkey
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'L' || l_orderkey || '-' || l_linenumber, 'O' || l_orderkey,
         service, 'op-' || flag,
         1704067200000000 + (l_orderkey % 86400) * 1000000 + l_linenumber * 1000,
         quantity * 1000, CASE WHEN l_linenumber % 2 = 0 THEN 'SERVER' ELSE 'OTHER' END, l_orderkey * 16 + l_linenumber,
         CASE WHEN flag = 'R' THEN 'true' END,
         CASE s_nationkey % 3 WHEN 0 THEN 'aws' WHEN 1 THEN 'dc' END,
         NULL
  FROM served
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'O' || l_orderkey, '',
         service, 'op-' || flag,
         1704067200000000 + (l_orderkey % 86400) * 1000000 + 500,
         quantity * 1000, 'SERVER', l_orderkey * 16 + 8,
         CASE WHEN flag = 'R' THEN 'true' END,
         CASE s_nationkey % 3 WHEN 0 THEN 'aws' WHEN 1 THEN 'dc' END,
         NULL
  FROM served WHERE nth = 1 AND l_orderkey % 3 = 0 AND s_nationkey % 4 = 0
)
"""

# Distinct spans ranked by arrival, the candidate pairs of both kinds, and the accepted ones.
_PAIRS = """,
distinct_spans AS (
  SELECT * FROM (
    SELECT * REPLACE ({service} AS service_name), start_us // 1000 AS time_ms,
           row_number() OVER (PARTITION BY trace_id, span_id, parent_span_id, {service} ORDER BY arrival_seq) AS copy
    FROM spans
  ) WHERE copy = 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trace_id, span_id ORDER BY arrival_seq) AS rk FROM distinct_spans
),
matched AS (
  SELECT c.span_id AS c_key, c.arrival_seq AS c_seq, s.span_id AS s_key, s.arrival_seq AS s_seq, TRUE AS shared
  FROM ranked c JOIN ranked s ON c.trace_id = s.trace_id AND c.span_id = s.span_id
  WHERE c.span_type = 'CLIENT' AND s.span_type = 'SERVER' AND c.rk <= 2 AND s.rk <= 2
  UNION ALL
  SELECT p.span_id, p.arrival_seq, k.span_id, k.arrival_seq, FALSE
  FROM ranked k JOIN ranked p ON k.trace_id = p.trace_id AND k.parent_span_id = p.span_id
  WHERE p.rk = 1 AND (k.arrival_seq < p.arrival_seq OR k.rk = 1)
    AND p.span_type IN ('CLIENT', 'OTHER') AND k.span_type IN ('SERVER', 'OTHER')
  UNION ALL
  SELECT k.span_id, k.arrival_seq, p.span_id, p.arrival_seq, FALSE
  FROM ranked k JOIN ranked p ON k.trace_id = p.trace_id AND k.parent_span_id = p.span_id
  WHERE p.rk = 1 AND (k.arrival_seq < p.arrival_seq OR k.rk = 1)
    AND p.span_type = 'SERVER' AND k.span_type = 'CLIENT'
),
pairs AS (
  SELECT c.trace_id, c.span_id AS client_span_id, c.service_name AS client_service,
         c.operation_name AS client_operation, c.time_ms AS client_time_ms, c.duration_us AS client_duration_us,
         c.tag_error AS client_error, c.tag_provider AS client_provider, c.tag_tier AS client_tier,
         s.span_id AS server_span_id, s.service_name AS server_service,
         s.time_ms AS server_time_ms, s.duration_us AS server_duration_us,
         s.tag_error AS server_error, s.tag_provider AS server_provider, s.tag_tier AS server_tier,
         shared, greatest(c_seq, s_seq) AS emit_seq
  FROM matched
  JOIN ranked c ON c.span_id = c_key AND c.arrival_seq = c_seq
  JOIN ranked s ON s.span_id = s_key AND s.arrival_seq = s_seq
),
complete AS (SELECT * FROM pairs WHERE client_service <> server_service),
registry AS (
  SELECT server_service AS service_name, min(emit_seq) AS first_shared_seq FROM complete WHERE shared GROUP BY ALL
),
accepted AS (
  SELECT complete.* FROM complete LEFT JOIN registry ON server_service = service_name
  WHERE shared OR first_shared_seq IS NULL OR emit_seq < first_shared_seq
)
"""


def pairs_sql(service: str = "service_name") -> str:
    """The common tables of pairing; ``service`` is an expression for the service of a span."""
    return SPANS + _PAIRS.format(service=service)


PAIRS = pairs_sql()
EDGES = PAIRS + """,
edges AS (
  SELECT client_span_id AS pair_key, client_service AS source, server_service AS destination,
         client_operation AS operation, client_time_ms AS source_timestamp,
         client_error, client_provider, client_tier, server_error, server_provider, server_tier, emit_seq,
         client_time_ms - client_time_ms % 300000 AS window_start
  FROM accepted
)
"""



def replayed_edges(batches: int, interval_ms: int) -> str:
    """Edges of a stream of delayed spans, batch by batch: what is present, what matches, what is remembered after it."""
    steps = [SPANS + """,
fed AS MATERIALIZED (
  SELECT * REPLACE (arrival_seq + batch * 1099511627776 AS arrival_seq, start_us - (k % 86400 - k % 8) * 1000000 AS start_us) FROM (
    SELECT *, CAST(trace_id AS BIGINT) AS k, k % 8 // 2 + CASE arrival_seq % 16
      WHEN 0 THEN CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END WHEN 8 THEN k % 2 ELSE arrival_seq % 16 % 4 END AS batch
    FROM spans
  )
),
ranked AS (SELECT *, start_us // 1000 AS time_ms, start_us // 1000 + duration_us // 1000 AS end_ms FROM fed)"""]
    for b in range(batches):
        before = f"SELECT * FROM kept{b - 1} UNION ALL" if b else ""
        steps.append(f""",
present{b} AS MATERIALIZED (
  SELECT *, CASE WHEN held THEN row_number() OVER (PARTITION BY trace_id, span_id, held ORDER BY arrival_seq) END AS rk FROM (
    {before} SELECT *, TRUE AS held, parent_span_id <> '' AS waiting FROM ranked WHERE batch = {b}
  )
),
matched{b} AS (
  SELECT c.span_id AS c_key, c.arrival_seq AS c_seq, s.span_id AS s_key, s.arrival_seq AS s_seq, TRUE AS shared, greatest(c.batch, s.batch) AS known
  FROM present{b} c JOIN present{b} s ON c.trace_id = s.trace_id AND c.span_id = s.span_id
  WHERE c.span_type = 'CLIENT' AND s.span_type = 'SERVER' AND c.rk <= 2 AND s.rk <= 2
  UNION ALL
  SELECT p.span_id, p.arrival_seq, k.span_id, k.arrival_seq, FALSE, greatest(p.batch, k.batch)
  FROM present{b} k JOIN present{b} p ON k.trace_id = p.trace_id AND k.parent_span_id = p.span_id
  WHERE k.waiting AND p.rk = 1 AND (k.arrival_seq < p.arrival_seq OR k.rk = 1)
    AND p.span_type IN ('CLIENT', 'OTHER') AND k.span_type IN ('SERVER', 'OTHER')
  UNION ALL
  SELECT k.span_id, k.arrival_seq, p.span_id, p.arrival_seq, FALSE, greatest(p.batch, k.batch)
  FROM present{b} k JOIN present{b} p ON k.trace_id = p.trace_id AND k.parent_span_id = p.span_id
  WHERE k.waiting AND p.rk = 1 AND (k.arrival_seq < p.arrival_seq OR k.rk = 1)
    AND p.span_type = 'SERVER' AND k.span_type = 'CLIENT'
),
kept{b} AS MATERIALIZED (
  SELECT * EXCLUDE (id_end, parent_end, cutoff, rk) REPLACE (held AND id_end > cutoff AS held, waiting AND parent_end > cutoff AS waiting) FROM (
    SELECT *, max(end_ms) OVER (PARTITION BY trace_id, span_id, held) AS id_end, max(end_ms) OVER (PARTITION BY trace_id, parent_span_id, waiting) AS parent_end,
      (SELECT max(time_ms) - {interval_ms} FROM ranked WHERE batch <= {b}) AS cutoff
    FROM (
      SELECT * REPLACE (waiting AND (trace_id, parent_span_id) NOT IN (SELECT (trace_id, span_id) FROM present{b} WHERE held) AS waiting) FROM present{b}
    )
  ) WHERE (held AND id_end > cutoff) OR (waiting AND parent_end > cutoff)
)""")
    every = " UNION ALL ".join(f"SELECT c_key, c_seq, s_key, s_seq, shared FROM matched{b} WHERE known = {b}" for b in range(batches))
    steps.append(f""",
matched AS ({every}),
pairs AS (""" + _PAIRS.split("pairs AS (", 1)[1])
    return "".join(steps) + EDGES[len(PAIRS):]


WINDOWED = EDGES + """,
windowed AS (
  SELECT window_start, window_start + 300000 AS window_end, source, destination, operation,
         count(*) AS count, max(source_timestamp) AS last_seen,
         CAST(count(*) FILTER (client_error = 'true') AS BIGINT) AS error_count,
         arg_max(client_provider, emit_seq) AS source_provider, arg_max(client_tier, emit_seq) AS source_tier,
         arg_max(server_provider, emit_seq) AS destination_provider, arg_max(server_tier, emit_seq) AS destination_tier
  FROM edges GROUP BY window_start, source, destination, operation
),
last_tags AS (
  SELECT window_start, source, destination, operation, 'source' AS side, 'infrastructure_provider' AS key, source_provider AS value FROM windowed
  UNION ALL SELECT window_start, source, destination, operation, 'source', 'tier', source_tier FROM windowed
  UNION ALL SELECT window_start, source, destination, operation, 'destination', 'infrastructure_provider', destination_provider FROM windowed
  UNION ALL SELECT window_start, source, destination, operation, 'destination', 'tier', destination_tier FROM windowed
)
"""

NOW_MS = 1_704_067_200_000 + 86_250_000
FROM_MS = (NOW_MS - 86_400_000) // 300_000 * 300_000


def _tags(provider: str, tier: str, error: str | None = None) -> str:
    parts = [f"'error=' || {error}"] if error else []
    parts += [f"'infrastructure_provider=' || {provider}", f"'tier=' || {tier}"]
    return f"concat_ws(';', {', '.join(parts)})"


def _both_tags(source: str = "source", destination: str = "destination") -> str:
    return (
        f"{_tags(f'{source}_provider', f'{source}_tier')} AS source_tags, "
        f"{_tags(f'{destination}_provider', f'{destination}_tier')} AS destination_tags"
    )


def _union(column: str) -> str:
    """Sorted union of the comma-separated values of a group."""
    parts = f"flatten(list(string_split({column}, ',')) FILTER ({column} IS NOT NULL))"
    return f"array_to_string(list_sort(list_distinct({parts})), ',')"


def _merged(name: str, keys: str, lower: int, upper: int, now: int) -> str:
    """A CTE merging windows by the given keys."""
    return f"""
{name} AS (
  SELECT {keys}, CAST(sum(count) AS BIGINT) AS count, max(last_seen) AS last_seen, CAST(sum(error_count) AS BIGINT) AS error_count,
         min(window_start) AS effective_from, max(least(window_end, {now})) AS effective_to,
         {_union('source_provider')} AS source_provider, {_union('source_tier')} AS source_tier,
         {_union('destination_provider')} AS destination_provider, {_union('destination_tier')} AS destination_tier
  FROM windowed WHERE window_start BETWEEN {lower} AND {upper} GROUP BY {keys}
)"""


_ALL = (0, 1 << 50, 1 << 50)
GRAPH = WINDOWED + "," + _merged("graph", "source, destination", FROM_MS, NOW_MS, NOW_MS)
_GRAPH_COLUMNS = "source, destination, count, last_seen, error_count, effective_from, effective_to"

NODES = GRAPH + """,
numbered AS (SELECT *, row_number() OVER (ORDER BY source, destination) AS edge_id FROM graph),
ends AS (
  SELECT source AS name, source_provider AS provider, source_tier AS tier, edge_id AS position FROM numbered
  UNION ALL SELECT destination, destination_provider, destination_tier, edge_id + 1000000000 FROM numbered
),
nodes AS (
  SELECT row_number() OVER (ORDER BY min(position)) AS id, name, provider, tier FROM ends GROUP BY name, provider, tier
)
"""
_FACT = """
  SELECT edge_id AS id, s.id AS "sourceId", d.id AS "destinationId", count AS "statsCount", last_seen AS "statsLastSeen",
         error_count AS "statsErrorCount", effective_from AS "effectiveFrom", effective_to AS "effectiveTo"
  FROM numbered e
  JOIN nodes s ON s.name = source AND s.provider IS NOT DISTINCT FROM source_provider AND s.tier IS NOT DISTINCT FROM source_tier
  JOIN nodes d ON d.name = destination AND d.provider IS NOT DISTINCT FROM destination_provider
              AND d.tier IS NOT DISTINCT FROM destination_tier
"""

HOUR = 3_600_000
BASE_MS = 1_704_067_200_000


def _at_hour(name: str, hour: int, span: int = 24 * HOUR) -> str:
    now = BASE_MS + hour * HOUR
    return _merged(name, "source, destination", (now - span) // 300_000 * 300_000, now, now)


def _hour_name(hour: int) -> str:
    return f"2024-01-01T{hour:02d}:00:00.000Z"


def _json_tags(side: str) -> str:
    return f"""concat_ws(',', '"infrastructure_provider":"' || {side}_provider || '"', '"tier":"' || {side}_tier || '"')"""


_VERTICES = "source, source_provider, source_tier, destination, destination_provider, destination_tier"
_PAIR = "trace_id, client_span_id, client_service, server_span_id, server_service, emit_seq"

_MARKED = """
WITH marked AS (
  SELECT o_orderkey, o_orderkey % 16 AS mask, o_orderstatus, 1704067200000000 + (o_orderkey % 86400) * 1000000 AS moment
  FROM orders
)
"""

_EDGE_ROWS = f"""
  SELECT pair_key, source, destination, operation, source_timestamp,
         {_tags('client_provider', 'client_tier', 'client_error')} AS source_tags,
         {_tags('server_provider', 'server_tier', 'server_error')} AS destination_tags, emit_seq
  FROM edges
"""
_POINTS = """
  SELECT client_span_id AS pair_key, 'latency' AS metric, 'gauge' AS type, 'ms' AS unit,
         (client_duration_us - server_duration_us) // 1000 AS value, client_time_ms // 1000 AS epoch_seconds,
         'mtype=gauge;operationName=' || client_operation || ';serviceName=' || client_service || ';unit=ms' AS tags
  FROM accepted
"""
_WINDOW_ROWS = f"""
  SELECT window_start, window_end, source, destination, operation, count, last_seen, error_count, {_both_tags()} FROM windowed
"""

_V = "count, last_seen, error_count, effective_from, effective_to"

# 24 snapshots: those of even hours over three hours, each stored again half an hour later.
CHAIN = WINDOWED + f""",
taken AS (
  SELECT 2 * h AS hour, 2 * n + 1 + r AS n, printf('2024-01-%02dT%02d:%02d:00.000Z', 1 + 2 * h // 24, 2 * h % 24, 30 * r) AS snapshot_ts
  FROM (SELECT h, h - 1 AS n FROM range(1, 13) AS t(h)), range(0, 2) AS u(r)
),
chain AS (
  SELECT n, snapshot_ts, source, destination, CAST(sum(count) AS BIGINT) AS count, max(last_seen) AS last_seen, CAST(sum(error_count) AS BIGINT) AS error_count,
         min(window_start) AS effective_from, max(least(window_end, {BASE_MS} + hour * {HOUR})) AS effective_to,
         NULLIF({_union('source_provider')}, '') AS source_provider, NULLIF({_union('source_tier')}, '') AS source_tier,
         NULLIF({_union('destination_provider')}, '') AS destination_provider, NULLIF({_union('destination_tier')}, '') AS destination_tier
  FROM taken JOIN windowed ON window_start BETWEEN {BASE_MS} + (hour - 3) * {HOUR} AND {BASE_MS} + hour * {HOUR}
  GROUP BY n, snapshot_ts, source, destination
),
compared AS (
  SELECT coalesce(o.n + 1, w.n) AS n, w.source IS NULL AS gone,
         o.source IS NULL OR w.source IS NULL OR ({', '.join('o.' + c for c in _V.split(', '))}) IS DISTINCT FROM ({', '.join('w.' + c for c in _V.split(', '))}) AS differs
  FROM (SELECT * FROM chain WHERE n < 24) o FULL JOIN chain w
    ON w.n = o.n + 1 AND {' AND '.join(f'o.{c} IS NOT DISTINCT FROM w.{c}' for c in _VERTICES.split(', '))}
)
"""

ORACLES: dict[str, str] = {
    "accumulable_filter": """
        SELECT * FROM (
          SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN '' ELSE CAST(event_id AS VARCHAR) END AS span_id,
                 CASE WHEN event_id % 11 <> 0 THEN event_type END AS service_name, 'op' AS operation_name,
                 CASE event_id % 17 WHEN 0 THEN 0 WHEN 1 THEN -5 ELSE event_id + 1 END AS start_us
          FROM events WHERE event_id % 13 <> 0
        ) WHERE span_id <> '' AND service_name <> '' AND start_us > 0
    """,
    "span_type": _MARKED + """
        SELECT o_orderkey, CAST(mask AS INTEGER) AS bits,
               CASE WHEN mask = 3 THEN 'CLIENT' WHEN mask = 12 THEN 'SERVER' WHEN o_orderstatus = 'F' THEN 'CLIENT'
                    WHEN o_orderstatus = 'O' THEN 'SERVER' ELSE 'OTHER' END AS span_type
        FROM marked
    """,
    "event_timestamp": _MARKED + """
        SELECT o_orderkey, CASE WHEN mask & 1 > 0 THEN moment END AS at_cs, CASE WHEN mask & 2 > 0 THEN moment + 40 END AS at_cr,
               CASE WHEN mask & 4 > 0 THEN moment + 30 END AS at_ss, CASE WHEN mask & 8 > 0 THEN moment + 10 END AS at_sr
        FROM marked
    """,
    "light_span": f"""WITH {SPANS}
        SELECT trace_id, span_id, parent_span_id, start_us // 1000 AS time_ms, service_name, operation_name, duration_us,
               span_type, {_tags('tag_provider', 'tag_tier', 'tag_error')} AS tags, arrival_seq
        FROM spans
    """,
    "span_source_protobuf": f"""WITH {SPANS}
        SELECT trace_id, span_id, parent_span_id, start_us // 1000 AS time_ms, service_name, operation_name, duration_us,
               span_type, {_tags('tag_provider', 'tag_tier', 'tag_error')} AS tags, arrival_seq
        FROM spans
    """,
    "span_source_damaged": f"WITH {SPANS} SELECT 'damaged' AS wrong, count(*) AS messages FROM spans WHERE arrival_seq % 50 = 0",
    "collect_tags": f"""WITH {SPANS}
        SELECT trace_id, span_id, service_name,
               concat_ws(';', 'error=' || tag_error,
                 CASE WHEN span_type = 'CLIENT' THEN 'http.url=/order/' || trace_id END, 'tier=' || tag_tier) AS tags
        FROM spans
    """,
    "is_later_than": f"""WITH {SPANS}
        SELECT trace_id, span_id, service_name, start_us // 1000 + duration_us // 1000 AS end_ms,
               CAST(duration_us // 1000 - arrival_seq % 300 > 0 AS INTEGER) AS later
        FROM spans
    """,
    "dedupe_spans": """
        SELECT trace_id, span_id, parent_span_id, service_name, arrival_seq, duration_us FROM (
          SELECT CAST(l_orderkey AS VARCHAR) AS trace_id, 'L' || l_orderkey || '-' || l_linenumber AS span_id,
                 'O' || l_orderkey AS parent_span_id, lower(n_name) AS service_name, l_partkey AS arrival_seq,
                 CAST(l_quantity AS BIGINT) * 1000 AS duration_us,
                 row_number() OVER (PARTITION BY l_orderkey, l_linenumber, n_name ORDER BY l_partkey, l_quantity) AS copy
          FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
        ) WHERE copy = 1
    """,
    "default_role": f"""WITH {SPANS}
        SELECT trace_id, span_id, service_name, CASE span_type WHEN 'OTHER' THEN 'CLIENT' ELSE span_type END AS as_parent,
               CASE span_type WHEN 'OTHER' THEN 'SERVER' ELSE span_type END AS as_child
        FROM spans
    """,
    "align_from": """
        SELECT event_id, epoch_us(ts) // 300000000 * 300000 AS from_300s, epoch_us(ts) // 1800000000 * 1800000 AS from_1800s FROM events
    """,
    "snapshot_name": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS name FROM events",
    "shared_span_pairs": f"WITH {PAIRS} SELECT {_PAIR} FROM pairs WHERE shared",
    "parent_child_pairs": f"WITH {PAIRS} SELECT {_PAIR} FROM pairs WHERE NOT shared",
    "complete_filter": f"""WITH {pairs_sql("'svc-' || length(service_name)")}
        SELECT {_PAIR}, CAST(shared AS INTEGER) AS shared FROM complete
    """,
    "merge_style_filter": f"WITH {PAIRS} SELECT {_PAIR}, CAST(shared AS INTEGER) AS shared FROM accepted",
    "merge_style_filter_final": f"""WITH {PAIRS}
        SELECT {_PAIR}, CAST(shared AS INTEGER) AS shared FROM complete
        WHERE shared OR server_service NOT IN (SELECT service_name FROM registry)
    """,
    "shared_registry": f"WITH {PAIRS} SELECT service_name, 1 AS use_shared_span, first_shared_seq FROM registry",
    "pair_window": f"""WITH {PAIRS}
        SELECT {_PAIR} FROM complete
        WHERE abs(client_time_ms + client_duration_us // 1000 - server_time_ms - server_duration_us // 1000) <= 150
    """,
    "pair_window_generations": f"""WITH {SPANS},
        keyed AS (
          SELECT *, CAST(trace_id AS BIGINT) AS k, CASE WHEN k % 2 = 1 THEN k % 1000 ELSE k % 400 END AS short,
                 start_us // 1000 - k % 86400 * 995 AS at_ms
          FROM spans
        ),
        renamed AS (
          SELECT 'T' || short AS trace_id, regexp_replace(span_id, '^([OL])[0-9]+', '\\1' || short) AS span_id,
                 regexp_replace(parent_span_id, '^([OL])[0-9]+', '\\1' || short) AS parent_span_id, service_name, span_type, arrival_seq,
                 at_ms, at_ms + duration_us // 1000 AS end_ms
          FROM keyed
        ),
        cut AS (
          SELECT *, coalesce(max(end_ms) OVER (PARTITION BY trace_id, span_id ORDER BY at_ms, arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                             <= at_ms - 2500, TRUE) AS begins
          FROM renamed
        ),
        dealt AS (
          SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY trace_id, span_id ORDER BY at_ms, arrival_seq ROWS UNBOUNDED PRECEDING) AS g FROM cut
        ),
        once AS (
          SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY trace_id, span_id, parent_span_id, service_name, g ORDER BY arrival_seq) AS copy FROM dealt
          ) WHERE copy = 1
        ),
        held AS (
          SELECT *, row_number() OVER (PARTITION BY trace_id, span_id, g ORDER BY arrival_seq) AS rk,
                 min(at_ms) OVER (PARTITION BY trace_id, span_id, g) AS from_ms, max(end_ms) OVER (PARTITION BY trace_id, span_id, g) + 2500 AS until_ms
          FROM once
        ),
        looked AS (
          SELECT c.trace_id, c.span_id AS c_id, c.service_name AS c_service, c.at_ms AS c_at, s.span_id AS s_id, s.service_name AS s_service, s.at_ms AS s_at,
                 1 AS shared, greatest(c.arrival_seq, s.arrival_seq) AS emit_seq
          FROM held c JOIN held s ON c.trace_id = s.trace_id AND c.span_id = s.span_id AND c.g = s.g
          WHERE c.span_type = 'CLIENT' AND s.span_type = 'SERVER' AND c.rk <= 2 AND s.rk <= 2
          UNION ALL
          SELECT p.trace_id, p.span_id, p.service_name, p.at_ms, k.span_id, k.service_name, k.at_ms, 0, greatest(p.arrival_seq, k.arrival_seq)
          FROM held k JOIN held p ON k.trace_id = p.trace_id AND k.parent_span_id = p.span_id AND p.rk = 1
          WHERE (k.rk = 1 OR k.arrival_seq < p.arrival_seq) AND p.span_type IN ('CLIENT', 'OTHER') AND k.span_type IN ('SERVER', 'OTHER')
            AND ((p.from_ms <= k.at_ms AND k.at_ms < p.until_ms) OR (
              k.at_ms < p.from_ms AND p.from_ms < k.end_ms + 2500
              AND NOT EXISTS (SELECT 1 FROM held q WHERE q.trace_id = p.trace_id AND q.span_id = p.span_id AND q.g < p.g AND q.until_ms > k.at_ms)
            ))
        )
        SELECT trace_id, c_id AS client_span_id, c_service AS client_service, s_id AS server_span_id, s_service AS server_service, emit_seq,
               c_at AS client_time_ms, s_at AS server_time_ms, CAST(shared AS INTEGER) AS shared
        FROM looked WHERE c_service <> s_service
    """,
    "graph_edges": f"WITH {EDGES} {_EDGE_ROWS}",
    "latency_points": f"WITH {PAIRS} {_POINTS}",
    "edge_constraints": """
        SELECT l_returnflag AS operation,
               CASE WHEN l_orderkey % 9 <> 0 AND l_orderkey % 10 <> 0 AND l_linenumber <> 7 AND l_returnflag <> ''
                    THEN 'valid' ELSE 'quarantined' END AS verdict, count(*) AS edges
        FROM lineitem GROUP BY ALL
    """,
    "edge_stats": f"WITH {WINDOWED} {_WINDOW_ROWS}",
    "edge_tags_last": f"WITH {WINDOWED} SELECT window_start, source, destination, operation, side, key, value FROM last_tags WHERE value IS NOT NULL",
    "service_graph_merge": f"""WITH {WINDOWED}, {_merged('merged', 'source, destination', *_ALL)}
        SELECT {_GRAPH_COLUMNS}, {_both_tags()} FROM merged
    """,
    "operation_graph_merge": f"""WITH {WINDOWED}, {_merged('merged', 'source, destination, operation', *_ALL)}
        SELECT operation, {_GRAPH_COLUMNS}, {_both_tags()} FROM merged
    """,
    "tag_union": f"""WITH {WINDOWED}
        SELECT source, destination, side, key, string_agg(part, ',' ORDER BY part) AS value FROM (
          SELECT DISTINCT source, destination, side, key, unnest(string_split(value, ',')) AS part FROM last_tags
          WHERE value IS NOT NULL
        ) GROUP BY source, destination, side, key
    """,
    "tag_union_values": f"""WITH {WINDOWED}
        SELECT DISTINCT source, destination, side, key, unnest(string_split(value, ',')) AS value FROM last_tags WHERE value IS NOT NULL
    """,
    "operation_graph": f"""WITH {WINDOWED}
        SELECT source, destination, operation, count, last_seen, error_count, {_both_tags()},
               window_start AS effective_from, least(window_end, {NOW_MS}) AS effective_to
        FROM windowed WHERE window_start BETWEEN {FROM_MS} AND {NOW_MS}
    """,
    "service_graph": f"WITH {GRAPH} SELECT {_GRAPH_COLUMNS}, {_both_tags()} FROM graph",
    "service_graph_range": f"""WITH {WINDOWED}, {_merged(
            'merged', 'source, destination', BASE_MS + 1_200_000, BASE_MS + 9_000_000, BASE_MS + 9_100_000)}
        SELECT {_GRAPH_COLUMNS}, {_both_tags()} FROM merged
    """,
    "service_graph_rollup": f"""WITH {WINDOWED}, {_merged(
            'merged', 'source, destination', BASE_MS + 1_200_000, BASE_MS + 61_234_567, BASE_MS + 61_334_567)}
        SELECT {_GRAPH_COLUMNS}, {_both_tags()} FROM merged
    """,
    "graph_function_services": f"""WITH {GRAPH}, {_merged(
            'merged', 'source, destination', BASE_MS + 1_200_000, BASE_MS + 61_234_567, NOW_MS)}
        SELECT 'day' AS asked, {_GRAPH_COLUMNS}, {_both_tags()} FROM graph UNION ALL SELECT 'range', {_GRAPH_COLUMNS}, {_both_tags()} FROM merged
    """,
    "graph_function_operations": f"""WITH {WINDOWED}
        SELECT source, destination, operation, count, last_seen, error_count, {_both_tags()},
               window_start AS effective_from, least(window_end, {NOW_MS}) AS effective_to
        FROM windowed WHERE window_start BETWEEN {BASE_MS + 1_200_000} AND {NOW_MS}
    """,
    "graph_views": f"""WITH {WINDOWED}
        SELECT source, destination, CAST(sum(count) AS BIGINT) AS calls, count(DISTINCT operation) AS operations,
               count(DISTINCT window_start) AS windows
        FROM windowed WHERE window_start BETWEEN {FROM_MS} AND {NOW_MS} GROUP BY source, destination
    """,
    "edge_count_metric": f"""WITH {GRAPH}
        SELECT 'servicegraph' AS graph, count(*) AS edges FROM graph
        UNION ALL SELECT 'operationgraph', count(*) FROM windowed WHERE window_start BETWEEN {FROM_MS} AND {NOW_MS}
    """,
    "node_dimension": f"WITH {NODES} SELECT id, name, NULLIF(provider, '') AS provider, NULLIF(tier, '') AS tier FROM nodes",
    "edge_fact": f"WITH {NODES} {_FACT}",
    "snapshot_edge_join": f"""WITH {NODES}
        SELECT edge_id, {_VERTICES}, count, last_seen, error_count, effective_from, effective_to FROM numbered
    """,
    "snapshot_as_of": """
        WITH moments AS (SELECT epoch_us(ts) // 1000 AS ms, event_type FROM events)
        SELECT instant_ms, snapshot_ms FROM (SELECT DISTINCT ms AS instant_ms FROM moments)
        ASOF LEFT JOIN (SELECT DISTINCT ms AS snapshot_ms FROM moments WHERE event_type = 'error') ON instant_ms >= snapshot_ms
    """,
    "snapshot_write": f"WITH {WINDOWED}, {_at_hour('h1', 1)}, {_at_hour('h2', 2)}, {_at_hour('h4', 4)}" + "".join(
        f""" {'UNION ALL' if hour > 1 else ''}
        SELECT '{_hour_name(hour)}' AS snapshot_ts, 'edges' AS part, count(*) AS rows FROM h{hour}
        UNION ALL SELECT '{_hour_name(hour)}', 'nodes', count(*) FROM (
          SELECT source, source_provider, source_tier FROM h{hour}
          UNION SELECT destination, destination_provider, destination_tier FROM h{hour})
        """ for hour in (1, 2, 4)
    ),
    "snapshot_read": f"""WITH {WINDOWED}, {_at_hour('h2', 2)}
        SELECT {_VERTICES}, count, last_seen, error_count, effective_from, effective_to FROM h2
    """,
    "snapshot_purge": f"""WITH {WINDOWED}, {_at_hour('h4', 4)}
        SELECT '{_hour_name(4)}' AS snapshot_ts, count(*) AS edges, CAST(4 AS BIGINT) AS purged FROM h4
    """,
    "snapshot_job": f"""WITH {WINDOWED}, {_at_hour('h2', 2, HOUR)}
        SELECT '{_hour_name(2)}' AS name, CAST(0 AS BIGINT) AS purged, source, destination, count, error_count FROM h2
    """,
    "snapshot_history": f"""WITH {WINDOWED}, {_at_hour('h1', 1)}, {_at_hour('h4', 4)}
        SELECT {', '.join(f'coalesce(o.{c}, n.{c}) AS {c}' for c in _VERTICES.split(', '))},
               CASE WHEN o.source IS NULL THEN 'added' WHEN n.source IS NULL THEN 'removed'
                    WHEN o.count <> n.count OR o.error_count <> n.error_count OR o.last_seen <> n.last_seen THEN 'changed'
                    ELSE 'same' END AS change,
               coalesce(n.count, 0) - coalesce(o.count, 0) AS count_delta,
               coalesce(n.error_count, 0) - coalesce(o.error_count, 0) AS error_count_delta
        FROM h1 o FULL JOIN h4 n ON {' AND '.join(f'o.{c} IS NOT DISTINCT FROM n.{c}' for c in _VERTICES.split(', '))}
    """,
    "snapshot_chain_read": f"WITH {CHAIN} SELECT {_VERTICES}, {_V} FROM chain WHERE n = 4",
    "snapshot_chain_changes": f"""WITH {CHAIN}
        SELECT snapshot_ts, CASE WHEN n % 5 = 1 THEN (SELECT count(*) FROM chain c WHERE c.n = t.n) ELSE (SELECT count(*) FROM compared c WHERE c.n = t.n AND differs) END AS stored,
               CASE WHEN n % 5 = 1 THEN 0 ELSE (SELECT count(*) FROM compared c WHERE c.n = t.n AND gone) END AS gone
        FROM taken t
    """,
    "snapshot_intervals": f"""WITH {CHAIN},
        runs AS (
          SELECT *, n - row_number() OVER (PARTITION BY {_VERTICES}, {_V} ORDER BY n) AS run FROM chain
        ),
        merged_runs AS (
          SELECT {_VERTICES}, {_V}, run, min(n) AS first, max(n) AS last, count(*) AS snapshots FROM runs GROUP BY ALL
        )
        SELECT {_VERTICES}, {_V}, f.snapshot_ts AS valid_from, t.snapshot_ts AS valid_to, snapshots
        FROM merged_runs JOIN taken f ON f.n = first LEFT JOIN taken t ON t.n = last + 1
    """,
    "snapshot_csv_write": f"WITH {NODES} SELECT id, name, NULLIF(provider, '') AS provider, NULLIF(tier, '') AS tier FROM nodes",
    "snapshot_csv_read": f"WITH {NODES} {_FACT}",
    "graph_json_write": f"""WITH {GRAPH}
        SELECT '{{"source":{{"name":"' || source || '","tags":{{' || {_json_tags('source')} || '}}}},"destination":{{"name":"'
            || destination || '","tags":{{' || {_json_tags('destination')} || '}}}},"stats":{{"count":' || count || ',"lastSeen":'
            || last_seen || ',"errorCount":' || error_count || '}},"effectiveFrom":' || effective_from || ',"effectiveTo":'
            || effective_to || '}}' AS json
        FROM graph
    """,
    "graph_json_read": f"WITH {GRAPH} SELECT {_GRAPH_COLUMNS}, {_both_tags()} FROM graph",
    "span_source": f"WITH {SPANS} SELECT service_name, count(*) AS spans FROM spans GROUP BY service_name",
    "span_pairs_stream": f"WITH {EDGES} {_EDGE_ROWS}",
    "span_pairs_stream_batches": f"WITH {EDGES} {_EDGE_ROWS}",
    "dedupe_spans_stream": f"""WITH {SPANS},
        light AS (
          SELECT trace_id, span_id, parent_span_id, start_us // 1000 AS time_ms, service_name, operation_name, duration_us, span_type, arrival_seq FROM spans
        )
        SELECT * FROM light WHERE arrival_seq % 16 > 0
        UNION ALL SELECT * REPLACE (time_ms + 2592000000 AS time_ms) FROM light WHERE arrival_seq % 16 = 0
        UNION ALL SELECT * REPLACE (time_ms + 3456000000 AS time_ms) FROM light WHERE arrival_seq % 16 > 0 AND CAST(trace_id AS BIGINT) % 3 = 0
    """,
    "late_spans_stream": f"WITH {EDGES} {_EDGE_ROWS}",
    "state_eviction_stream": f"WITH {replayed_edges(7, 2_500)} {_EDGE_ROWS}",
    "late_spans": f"WITH {EDGES} {_EDGE_ROWS}",
    "state_eviction": f"""WITH {SPANS},
        ended AS (
          SELECT *, start_us // 1000 + duration_us // 1000 AS end_ms,
                 CASE WHEN parent_span_id <> '' AND arrival_seq % 2 = 1 THEN 'X' || trace_id ELSE parent_span_id END AS parent
          FROM spans
        ),
        filed AS (
          SELECT *, max(end_ms) OVER (PARTITION BY trace_id, span_id) AS id_end,
                 max(end_ms) OVER (PARTITION BY trace_id, parent) AS parent_end
          FROM ended
        ),
        kept AS (
          SELECT trace_id, span_id, service_name, CAST(id_end > {BASE_MS + 500_000} AS INTEGER) AS held,
                 CAST(parent LIKE 'X%' AND parent_end > {BASE_MS + 500_000} AS INTEGER) AS waiting
          FROM filed
        )
        SELECT * FROM kept WHERE held = 1 OR waiting = 1
    """,
    "registry_source": f"""WITH {PAIRS}
        SELECT {_PAIR}, CAST(shared AS INTEGER) AS shared FROM complete
        WHERE shared OR server_service NOT IN (SELECT service_name FROM registry)
    """,
    "edge_sink": f"WITH {EDGES} {_EDGE_ROWS}",
    "edge_source": f"WITH {EDGES} SELECT source_timestamp // 3600000 * 3600000 AS hour_ms, count(*) AS edges FROM edges GROUP BY ALL",
    "latest_state_view": f"WITH {GRAPH} SELECT {_GRAPH_COLUMNS}, {_both_tags()} FROM graph",
    "fanout": f"WITH {PAIRS} SELECT 'edges' AS part, count(*) AS rows FROM accepted UNION ALL SELECT 'latency', count(*) FROM accepted UNION ALL SELECT 'registry', count(*) FROM registry",
    "metric_sink": f"WITH {PAIRS} {_POINTS}",
    "registry_sink": f"WITH {PAIRS} SELECT service_name, 1 AS use_shared_span, first_shared_seq FROM registry",
    "tumbling_window": f"WITH {WINDOWED} {_WINDOW_ROWS}",
    "tumbling_window_batches": f"WITH {WINDOWED} {_WINDOW_ROWS}",
    "windowed_compaction": f"WITH {WINDOWED} {_WINDOW_ROWS}",
    "edge_job_twice_same_day": f"WITH {WINDOWED} {_WINDOW_ROWS}",
    "windowed_retention": """
        SELECT epoch_us(ts) // 3600000000 * 3600000 AS window_start, event_type AS source, count(*) AS count, max(epoch_us(ts) // 1000) AS last_seen
        FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY ALL
    """,
    "snapshot_job_live": f"""WITH {WINDOWED}, {_at_hour('h2', 2, HOUR)}
        SELECT '{_hour_name(2)}' AS name, CAST(0 AS BIGINT) AS purged, source, destination, count, error_count FROM h2
    """,
    "span_job": f"WITH {EDGES} {_EDGE_ROWS}",
    "graph_document": f"WITH {GRAPH} SELECT {_GRAPH_COLUMNS}, {_both_tags()} FROM graph",
    "dangling_edges": f"""WITH {NODES}, facts AS ({_FACT})
        SELECT 's1' AS snapshot_ts, id, "sourceId", "destinationId" FROM facts WHERE "sourceId" = 2 OR "destinationId" = 2
    """,
    "late_edges": f"""WITH {WINDOWED}
        SELECT window_start, CAST(sum(count) AS BIGINT) * CASE
                 WHEN window_start + 300000 > (SELECT max(source_timestamp) FROM edges) - 3600000 THEN 2 ELSE 1 END AS calls
        FROM windowed GROUP BY window_start
    """,
}
