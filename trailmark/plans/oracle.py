"""The same rows in DuckDB's SQL, written from the rules and not from the Spark code."""

from __future__ import annotations

E = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us, regexp_extract(props, '(\\d+)', 1)::BIGINT AS k FROM events)"
U = E + ", u AS (SELECT *, user_id * 100000000 + row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS seq FROM e)"
HOUR6, HOUR12, DAY = 21600000000, 43200000000, 86400000000


def greedy(items: str, period: int, most: int = 1 << 40) -> str:
    return f"list_reduce(list_transform({items}, lambda x: [x]), lambda a, b: CASE WHEN len(a) < {most} AND b[1] - a[-1] >= {period} THEN list_append(a, b[1]) ELSE a END)"


def thinned(items: str, period: int, most: int) -> str:
    kept = greedy(items, period, most)
    return f"(CASE WHEN len({kept}) < {most} AND ({kept})[-1] <> ({items})[-1] THEN list_append({kept}, ({items})[-1]) ELSE {kept} END)"


FUTURE = f"""WITH {E}, w AS (
  SELECT event_id, us, list(us) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN CURRENT ROW AND {7 * DAY} FOLLOWING) AS l FROM e
), t AS (SELECT event_id, us, {thinned("l", HOUR12, 64)} AS p FROM w)"""

REQUESTS = f"""{E}, users AS (SELECT user_id, min(us) AS s, max(us) AS t FROM e GROUP BY user_id),
req AS (SELECT user_id AS request_id, CASE WHEN user_id % 7 = 0 THEN s - 1 ELSE s + {DAY} * (user_id % 3) + 12345 END AS ref, user_id % 4 AS known, CASE WHEN user_id % 11 <> 0 THEN 1 END AS rev, s, t FROM users),
st AS (SELECT *, CASE WHEN rev IS NULL THEN 'no_recording' WHEN known <> 0 AND known = rev THEN 'not_modified' WHEN ref < s OR ref > t THEN 'out_of_range' ELSE 'ok' END AS status,
  least(ref + {7 * DAY}, CASE WHEN rev IS NOT NULL THEN t END) AS till FROM req)"""


def grid(most: int) -> str:
    return f"""g0 AS (SELECT *, generate_series(ref, till, {HOUR6}) AS g FROM st WHERE status = 'ok'),
g1 AS (SELECT *, CASE WHEN g[-1] <> till AND len(g) < {most} THEN list_append(g, till) ELSE g END AS h FROM g0),
g2 AS (SELECT *, CASE WHEN len(h) <= {most} THEN h ELSE list_transform(range({most}), lambda i: h[round_even(i * (len(h) - 1)::DOUBLE / {most - 1}, 0)::BIGINT + 1]) END AS f FROM g1),
q AS (SELECT request_id, ref, unnest(f) AS us FROM g2)"""


POINT = "SELECT user_id, us, value AS x, (event_id % 1000) / 10.0::DOUBLE AS y, sin(k * 0.0314::DOUBLE) AS qz, cos(k * 0.0314::DOUBLE) AS qw, k * 0.0628::DOUBLE AS yaw, value / 10 AS vx, k / 10.0::DOUBLE AS vy, value AS speed FROM e"
PACKETS = "p AS (SELECT *, event_id // 5 AS n, max(us) OVER w AS ref, row_number() OVER (PARTITION BY event_id // 5 ORDER BY event_id) - 1 AS pos, event_id // 5 % 9 <> 0 AND count(*) FILTER (k % 46 <= 1) OVER w = 0 AS whole FROM e WINDOW w AS (PARTITION BY event_id // 5))"
GATE = """CASE WHEN a.lr IS NOT NULL AND b.r < a.lr THEN 0 ELSE a.ls END"""


def gate(by: str, source: str, seq: str) -> str:
    passes = f"NOT (({GATE}) <> 0 AND b.s <= ({GATE}))"
    return f"""l AS (SELECT {by}, list({seq} ORDER BY {seq}) AS n, list({{'s': k, 'r': us, 'v': k % 9 <> 0, 'ls': 0::BIGINT, 'lr': NULL::BIGINT, 'o': []::BOOLEAN[], 'back': []::BOOLEAN[]}} ORDER BY {seq}) AS x FROM {source} GROUP BY {by}),
f AS (SELECT {by}, n, list_reduce(list_prepend({{'s': 0::BIGINT, 'r': 0::BIGINT, 'v': true, 'ls': 0::BIGINT, 'lr': NULL::BIGINT, 'o': []::BOOLEAN[], 'back': []::BOOLEAN[]}}, x), lambda a, b: {{
  's': b.s, 'r': b.r, 'v': b.v, 'ls': CASE WHEN {passes} AND b.v THEN b.s ELSE {GATE} END, 'lr': CASE WHEN {passes} AND b.v THEN b.r ELSE a.lr END,
  'o': list_append(a.o, {passes}), 'back': list_append(a.back, a.lr IS NOT NULL AND b.r < a.lr)}}) AS z FROM l)"""


STOP, NAV = "k % 17 = 0", "NOT (k % 11 IN (0, 1)) AND NOT (k % 11 = 2 AND (k + 1) % 4 <> 0)"
INPUT, PLAN = "(k % 5 = 0 OR k % 7 <> 0)", "(k % 4 = 0 OR k % 13 > 3)"
ROUTES = f"""{E}, r AS (
  SELECT event_id, k, value, 'map' AS section, i AS pos, CASE WHEN k % 11 = 3 AND i = 1 THEN false ELSE (k + i) % 4 <> 0 END AS valid, 3 AS expected FROM e, range(3) t(i) WHERE NOT ({STOP}) AND {NAV}
  UNION ALL SELECT event_id, k, value, 'model_input', 0, true, 0 FROM e WHERE NOT ({STOP}) AND {NAV} AND {INPUT} AND k % 5 <> 0)"""
PLANS = f"SELECT event_id, k, value FROM e WHERE NOT ({STOP}) AND {NAV} AND {INPUT} AND {PLAN} AND k % 4 <> 0"
LINES = f"""{ROUTES}, n AS (SELECT event_id, section, count(*) FILTER (valid) AS n FROM r GROUP BY ALL UNION ALL SELECT event_id, 'plan', 3 FROM ({PLANS})),
line AS (SELECT event_id, section, CASE WHEN n < 2 THEN 'navigation' WHEN section = 'plan' THEN 'navigation/model_plan' ELSE 'navigation/route' END AS ns, CASE WHEN n >= 2 AND section = 'model_input' THEN 'base_link' ELSE 'map' END AS frame, CASE WHEN n >= 2 THEN 'ADD' ELSE 'DELETE' END AS action, n FROM n)"""
ARRAYS = f"""{LINES}, a AS (SELECT event_id % 10 AS viewer, event_id * 2 + (section = 'plan')::INT AS seq, CASE section WHEN 'plan' THEN 3 ELSE 1 END AS marker_id, ns, frame, action, CASE WHEN n >= 2 THEN n ELSE 0 END AS n_points FROM line WHERE section <> 'model_input'),
b AS (SELECT *, coalesce(action = 'ADD' AND lag(action) OVER (PARTITION BY viewer, marker_id ORDER BY seq) = 'DELETE', false)::INT AS again FROM a),
c AS (SELECT *, sum(again) OVER (PARTITION BY viewer, marker_id ORDER BY seq) AS life FROM b),
d AS (SELECT *, min(CASE WHEN action = 'ADD' THEN seq END) OVER w AS since, min(CASE WHEN action = 'DELETE' THEN seq END) OVER w AS gone FROM c WINDOW w AS (PARTITION BY viewer, marker_id, life)),
g AS (SELECT *, CASE WHEN action = 'ADD' OR (seq = gone AND since IS NOT NULL) THEN since ELSE seq END AS place, seq AS own FROM d),
h AS (SELECT a.viewer, a.seq, i.marker_id FROM a, (VALUES (1), (3)) i(marker_id)),
arrays AS (SELECT h.viewer, h.seq, row_number() OVER (PARTITION BY h.viewer, h.seq ORDER BY place) - 1 AS at, g.marker_id, ns, frame, action, n_points FROM h ASOF JOIN g ON h.viewer = g.viewer AND h.marker_id = g.marker_id AND h.seq >= g.seq WHERE action = 'ADD' OR own = h.seq)"""
MAPS = """l AS (SELECT label, vec_id, embedding, label || '-' || (vec_id // 64) AS map_id FROM embeddings WHERE label <> 3),
ok AS (SELECT map_id FROM l GROUP BY map_id HAVING count(*) FILTER (vec_id % 97 = 0) = 0), m AS (SELECT * FROM l WHERE map_id IN (SELECT map_id FROM ok))"""


CALIBRATIONS = f"{E}, c AS (SELECT ['camera_cross_left_120fov', 'camera_front_wide_120fov', 'camera_front_tele_30fov', 'camera_cross_right_120fov', 'camera_rear_left_70fov', 'unknown'][event_id % 6 + 1] AS camera, k FROM e WHERE k > 50 QUALIFY row_number() OVER (PARTITION BY event_id % 6 ORDER BY event_id) = 1)"


def crc(text: str) -> str:
    """CRC-32 bit by bit, and its low 31 bits."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: {step}), 4294967295::BIGINT) & 2147483647"


def element(layer: int, part: int, ns: str, n: int, every: int, width: float, z: float) -> str:
    return f"SELECT map_id, {layer} AS layer, row_number() OVER (PARTITION BY map_id ORDER BY vec_id) - 1 AS at, {part} AS part, '{ns}' AS ns, vec_id::VARCHAR AS id, 'map' AS frame, 'ADD' AS action, {n} AS n_points, {width}::DOUBLE AS width, round(embedding[3]::DOUBLE + {z}::DOUBLE, 6) AS z FROM m WHERE vec_id % {every} = 0"


ORACLE = {
    "ego_state": f"WITH {E}, q AS (SELECT *, sin(k * 0.0314::DOUBLE) AS z, cos(k * 0.0314::DOUBLE) AS w FROM e) SELECT event_id AS ingest_seq, us AS stamp_us, round(value, 6) AS x, round((event_id % 1000) / 10.0::DOUBLE, 6) AS y, round(z, 6) AS qz, round(w, 6) AS qw, round(atan2(2 * (w * z), 1 - 2 * (z * z)), 6) AS yaw, round(value, 6) AS speed FROM q",
    "ego_clock_tf": f"WITH {E} SELECT event_id AS ingest_seq, us // 1000000 AS sec, us % 1000000 * 1000 AS nanosec, 'map' AS parent, 'base_link' AS child, round(value, 6) AS tx FROM e",
    "time_split": f"WITH {E}, d AS (SELECT event_id, k, us - 1705363200000000 AS d FROM e), s AS (SELECT *, floor(d::DOUBLE / 1000000)::BIGINT AS sec FROM d) SELECT event_id, sec, (d - sec * 1000000) * 1000 AS nanosec, d AS back_us, round_even((k * 2 + 1) * 0.5::DOUBLE / 1000000::DOUBLE * 1000000::DOUBLE, 0)::BIGINT AS rounded_us FROM s",
    "rollout_segments": f"WITH {U}, b AS (SELECT seq, coalesce((us < lag(us) OVER (ORDER BY seq))::INT, 0) AS b FROM u) SELECT seq AS ingest_seq, sum(b) OVER (ORDER BY seq)::BIGINT AS rollout_id FROM b",
    "executed_path": f"WITH {U}, b AS (SELECT seq, us, coalesce((us < lag(us) OVER (ORDER BY seq))::INT, 0) AS b FROM u), s AS (SELECT *, sum(b) OVER (ORDER BY seq)::BIGINT AS segment FROM b), l AS (SELECT segment, ({greedy('list(us ORDER BY seq)', HOUR6)})[-512:] AS p FROM s GROUP BY segment), x AS (SELECT segment, p[1] AS first, unnest(p) AS us FROM l) SELECT x.segment, s.seq AS ingest_seq, x.us AS stamp_us, x.us - first AS offset_us, 3 AS source FROM x JOIN s ON s.segment = x.segment AND s.us = x.us",
    "executed_path_age_trim": f"WITH {E}, l AS (SELECT user_id, max(us) AS m, {greedy('list(us ORDER BY event_id)', HOUR6)} AS p FROM e GROUP BY user_id), x AS (SELECT user_id, list_filter(p, lambda t: t >= m - {2 * DAY}) AS p FROM l) SELECT user_id, unnest(p) AS stamp_us, unnest(list_transform(p, lambda t: t - p[1])) AS offset_us FROM x",
    "executed_path_summary": f"WITH {E}, l AS (SELECT user_id, ({greedy('list(us ORDER BY event_id)', HOUR6)})[-20:] AS p FROM e GROUP BY user_id) SELECT user_id, p[1] AS reference_us, p[-1] - p[1] AS duration_us, len(p) AS n_points FROM l",
    "actor_current": f"WITH {E} SELECT event_id, user_id::VARCHAR AS track_id, event_type AS label_class, event_type = 'error' AS is_static, round(k / 20.0::DOUBLE, 6) AS dx, round(k / 40.0::DOUBLE, 6) AS dz, round(value / 100, 6) AS speed FROM e",
    "actor_future": f"{FUTURE} SELECT event_id, len(p) AS n_points, list_sum(list_transform(p, lambda x: x - us))::BIGINT AS offsets_us, p[-1] - us AS actual_us, 2 AS source FROM t",
    "actor_prediction": f"{FUTURE} SELECT event_id, len(p) AS n_points, 4 AS source, 'ground_truth_placeholder' AS producer, false AS is_model_generated FROM t",
    "actor_history": f"WITH {E}, j AS (SELECT p.event_id, p.us, s.event_type AS track_id, list(s.us ORDER BY s.us)[-5:] AS ring, max(s.us) AS seen FROM e p JOIN e s ON p.user_id = s.user_id AND s.us <= p.us GROUP BY ALL), v AS (SELECT *, list_filter(ring, lambda x: x >= us - {2 * DAY}) AS l FROM j WHERE us - seen <= {5 * DAY}), t AS (SELECT *, {thinned('l', HOUR12, 64)} AS p FROM v WHERE len(l) > 0) SELECT event_id, track_id, len(p) AS n_points, p[1] AS first_us, p[-1] AS last_us, us - p[1] AS actual_us FROM t",
    "gt_request_status": f"WITH {REQUESTS} SELECT request_id, status, coalesce(rev, 0) AS revision, till AS until_us FROM st",
    "gt_future_grid": f"""WITH {REQUESTS}, {grid(65)}, pt AS ({POINT}),
b AS (SELECT q.*, p.us AS bu, p.x AS bx, p.y AS by_, p.qz AS bz, p.qw AS bw, p.yaw AS ba, p.vx AS bvx, p.vy AS bvy, p.speed AS bs FROM q ASOF LEFT JOIN pt p ON q.request_id = p.user_id AND q.us >= p.us),
c AS (SELECT b.*, p.us AS au, p.x AS ax, p.y AS ay, p.qz AS az, p.qw AS aw, p.yaw AS aa, p.vx AS avx, p.vy AS avy FROM b ASOF LEFT JOIN pt p ON b.request_id = p.user_id AND b.us <= p.us),
d AS (SELECT *, bu = us AS hit, (us - bu)::DOUBLE / (au - bu) AS m, CASE WHEN bz * az + bw * aw < 0 THEN -1.0 ELSE 1.0 END AS sg FROM c),
n AS (SELECT *, (1 - m) * bz + m * (sg * az) AS nz, (1 - m) * bw + m * (sg * aw) AS nw FROM d)
SELECT request_id, us AS stamp_us, us - ref AS offset_us, round(CASE WHEN hit THEN bx ELSE bx + m * (ax - bx) END, 6) AS x, round(CASE WHEN hit THEN by_ ELSE by_ + m * (ay - by_) END, 6) AS y,
  round(CASE WHEN hit THEN bz ELSE nz / sqrt(nz * nz + nw * nw) END, 6) AS qz, round(CASE WHEN hit THEN bw ELSE nw / sqrt(nz * nz + nw * nw) END, 6) AS qw, round(CASE WHEN hit THEN ba ELSE ba + m * (aa - ba) END, 6) AS yaw,
  round(CASE WHEN hit THEN bs ELSE sqrt(pow(bvx + m * (avx - bvx), 2) + pow(bvy + m * (avy - bvy), 2)) END, 6) AS speed FROM n""",
    "gt_future_native": f"""WITH {REQUESTS}, w AS (SELECT st.*, (SELECT coalesce(list(us ORDER BY us), []) FROM e WHERE e.user_id = st.request_id AND e.us BETWEEN ref AND till) AS l FROM st WHERE status = 'ok'),
w1 AS (SELECT *, CASE WHEN len(l) = 0 OR l[1] <> ref THEN list_prepend(ref, l) ELSE l END AS h FROM w), w2 AS (SELECT *, CASE WHEN h[-1] <> till AND len(h) < 256 THEN list_append(h, till) ELSE h END AS f FROM w1),
q AS (SELECT request_id, ref, unnest(f) AS us FROM w2), pt AS ({POINT}),
b AS (SELECT q.*, p.us AS bu, p.x AS bx FROM q ASOF LEFT JOIN pt p ON q.request_id = p.user_id AND q.us >= p.us), c AS (SELECT b.*, p.us AS au, p.x AS ax FROM b ASOF LEFT JOIN pt p ON b.request_id = p.user_id AND b.us <= p.us)
SELECT request_id, us AS stamp_us, us - ref AS offset_us, round(CASE WHEN bu = us THEN bx ELSE bx + (us - bu)::DOUBLE / (au - bu) * (ax - bx) END, 6) AS x FROM c""",
    "gt_future_thinned": f"WITH {REQUESTS}, {grid(10)} SELECT request_id, us AS stamp_us, us - ref AS offset_us FROM q",
    "nav_gate": f"WITH {E}, {gate('user_id', 'e', 'event_id')} SELECT unnest(n) AS event_id, unnest(z.o) AS accepted FROM f",
    "nav_gate_rollback": f"WITH {U}, m AS (SELECT *, user_id % 16 AS stream FROM u), {gate('stream', 'm', 'seq')} SELECT stream, unnest(n) AS ingest_seq, unnest(z.o) AS accepted, unnest(z.back) AS rollback FROM f",
    "nav_enums": f"WITH {E} SELECT event_id, CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS generator, CASE k % 3 WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 0 END AS source FROM e",
    "nav_sections": f"WITH {E} SELECT event_id, k % 5 <> 0 AS emit_map, k % 5 <> 0 AND k % 3 <> 0 AS emit_input, k % 5 <> 0 AND k % 3 <> 0 AND k % 2 = 0 AS emit_plan, k % 5 <> 0 AND k % 3 <> 0 AND k % 2 = 0 AS valid FROM e",
    "nav_layers_latest": f"WITH {E} SELECT event_id, " + ", ".join(f"round(last_value(CASE WHEN event_type = '{c}' THEN value END IGNORE NULLS) OVER w, 6) AS latest_{c}" for c in ("click", "purchase", "view", "error")) + " FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)",
    "map_revisions": f"WITH {E}, b AS (SELECT event_id, event_type, coalesce((event_type <> lag(event_type) OVER w OR k % 3 <> lag(k % 3) OVER w)::INT, 0) AS b FROM e WINDOW w AS (ORDER BY event_id)) SELECT event_id, event_type AS scene_id, 1 + sum(b) OVER (ORDER BY event_id)::BIGINT AS revision FROM b",
    "map_request_status": f"""WITH {E}, b AS (SELECT *, coalesce((event_type <> lag(event_type) OVER w OR k % 3 <> lag(k % 3) OVER w)::INT, 0) AS b FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
c AS (SELECT user_id, arg_max(event_type, event_id) AS scene, 1 + sum(b)::BIGINT AS rev FROM b GROUP BY user_id),
r AS (SELECT DISTINCT CASE WHEN user_id % 5 = 0 THEN -user_id ELSE user_id END AS slot, CASE user_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'click' ELSE 'view' END AS asked, user_id % 2 * (40 + user_id % 20) AS known FROM e)
SELECT slot, CASE WHEN rev IS NULL THEN 'no_map' WHEN asked <> '' AND asked <> scene THEN 'scene_mismatch' WHEN known <> 0 AND known = rev THEN 'not_modified' ELSE 'ok' END AS status, coalesce(rev, 0) AS revision FROM r LEFT JOIN c ON slot = user_id""",
    "map_polylines": "SELECT vec_id, 'map/lane_left_boundaries' AS ns, i AS at, round(embedding[3 * i + 1]::DOUBLE, 6) AS x, round(embedding[3 * i + 3]::DOUBLE + 0.05::DOUBLE, 6) AS z FROM embeddings, range(21) t(i)",
    "lane_edges": "SELECT a.label AS scene_id, a.vec_id::VARCHAR AS lane_id, 'successor_ids' AS relation, (SELECT min(vec_id) FROM embeddings b WHERE b.label = a.label AND b.vec_id > a.vec_id)::VARCHAR AS other_id FROM embeddings a WHERE other_id IS NOT NULL UNION ALL SELECT a.label, a.vec_id::VARCHAR, 'predecessor_ids', (SELECT max(vec_id) FROM embeddings b WHERE b.label = a.label AND b.vec_id < a.vec_id)::VARCHAR AS o FROM embeddings a WHERE o IS NOT NULL",
    "wait_line_style": "SELECT p_partkey, 'map/wait_lines/' || CASE p_partkey % 3 WHEN 0 THEN 'stop' WHEN 1 THEN 'yield' ELSE 'other' END AS ns, CASE p_partkey % 3 WHEN 2 THEN 0.65 ELSE 1.0 END::DOUBLE AS r, CASE p_partkey % 3 WHEN 0 THEN 0.85 WHEN 1 THEN 0.4 ELSE 0.65 END::DOUBLE AS g, CASE p_partkey % 3 WHEN 2 THEN 0.65 ELSE 0.0 END::DOUBLE AS b, CASE WHEN p_size % 2 = 0 THEN 0.45 WHEN p_partkey % 3 = 2 THEN 0.9 ELSE 1.0 END::DOUBLE AS a FROM part",
    "actor_boxes": f"WITH {E}, c AS (SELECT *, CASE event_type WHEN 'click' THEN 'pedestrian' WHEN 'view' THEN 'trailer' ELSE event_type END AS t FROM e) SELECT event_id, 'actors/boxes/' || t AS ns, round(greatest(k / 20.0::DOUBLE, 0.05), 6) AS sx, round(greatest(k / 40.0::DOUBLE, 0.05), 6) AS sz, CASE t WHEN 'pedestrian' THEN 0.95 WHEN 'trailer' THEN 0.65 ELSE 0.55 END::DOUBLE AS r, CASE t WHEN 'pedestrian' THEN 0.15 WHEN 'trailer' THEN 0.2 ELSE 0.55 END::DOUBLE AS g, CASE t WHEN 'pedestrian' THEN 0.15 WHEN 'trailer' THEN 0.9 ELSE 0.55 END::DOUBLE AS b, 0.65::DOUBLE AS a FROM c",
    "actor_labels": f"WITH {E} SELECT event_id, event_type || ' #' || user_id || CASE WHEN event_type = 'error' THEN ' static' ELSE '' END || chr(10) || printf('%.1f', k / 4.0::DOUBLE) || ' m/s' AS text, round(0 + (k / 40.0::DOUBLE / 2 + 0.5), 6) AS z FROM e",
    "actor_arrows": f"WITH {E} SELECT event_id, round(k / 40.0::DOUBLE / 2, 6) AS z, round(value + 0.5 * (value / 10), 6) AS x, round((event_id % 1000) / 10.0::DOUBLE + 0.5 * (k / 10.0::DOUBLE), 6) AS y FROM e WHERE value / 100 > 0.05",
    "camera_magic": f"WITH {E}, c AS (SELECT *, ['camera_cross_left_120fov', 'camera_front_wide_120fov', 'camera_front_tele_30fov', 'camera_cross_right_120fov', 'camera_rear_left_70fov'][event_id % 6 + 1] AS camera FROM e) SELECT event_id, camera, camera || '_optical' AS frame_id, us AS stamp_us, CASE k % 5 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'png' WHEN 2 THEN 'webp' ELSE 'unknown' END AS format FROM c WHERE camera IS NOT NULL",
    "camera_calibration_once": f"WITH {E} SELECT event_type AS camera_logical_id, event_id AS ingest_seq, k AS camera_metadata FROM e WHERE k > 50 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) = 1",
    "topic_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "retained_topics": "SELECT event_type, user_id, event_id AS ingest_seq, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) = 1",
    "receive_queue": "SELECT event_type, event_id AS ingest_seq FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 8",
    "packet_quarantine": f"WITH {E} SELECT event_id, CASE k % 10 WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing timestamp_us' WHEN 2 THEN 'missing position.x' WHEN 3 THEN 'missing orientation.w' WHEN 4 THEN 'missing angular_acceleration' ELSE 'ok' END AS reason, CASE WHEN k % 10 > 4 THEN us END AS stamp_us, CASE WHEN k % 10 > 4 THEN round(value, 6) END AS x, CASE WHEN k % 10 > 4 THEN 'map' END AS pose_frame_id FROM e",
    "finite_points": f"WITH {E} SELECT event_id, k % 7 > 1 AS finite FROM e",
    "actor_snapshot_rows": f"WITH {E}, {PACKETS} SELECT n AS ingest_seq, ref AS ref_us, 'map' AS pose_frame_id, pos AS at, user_id::VARCHAR AS track_id, event_type AS label_class, event_type = 'error' AS is_static, round(k / 20.0::DOUBLE, 6) AS dx, round(value, 6) AS x, round(value / 100, 6) AS speed FROM p WHERE whole",
    "actor_marker_rows": f"""WITH {E}, {PACKETS}
SELECT DISTINCT n AS ingest_seq, -1 AS at, 0 AS kind, '' AS ns, 'map' AS frame, 'DELETEALL' AS action FROM p WHERE whole
UNION ALL SELECT n, pos, 0, 'actors/boxes/' || event_type, 'map', 'ADD' FROM p WHERE whole UNION ALL SELECT n, pos, 1, 'actors/labels', 'map', 'ADD' FROM p WHERE whole
UNION ALL SELECT n, pos, 2, 'actors/velocity', CASE WHEN n % 4 = 0 THEN 'odom' ELSE 'map' END, 'ADD' FROM p WHERE whole AND value / 100 > 0.05""",
    "marker_ids": f"WITH {E} SELECT event_id, {crc("user_id || ':box'")} AS box_id, {crc("'map/road_edges:' || event_id")} AS edge_id FROM e",
    "actor_stale_tracks": f"WITH {E}, s AS (SELECT *, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS nxt FROM e), x AS (SELECT s.user_id, s.event_type AS track_id, s.us AS last_seen_us, min(p.event_id) AS event_id FROM s JOIN e p ON p.user_id = s.user_id AND p.us > s.us + {5 * DAY} AND (nxt IS NULL OR p.event_id < nxt) GROUP BY ALL) SELECT x.*, e.us AS ref_us FROM x JOIN e USING (event_id, user_id)",
    "actor_history_latest": f"WITH {E}, j AS (SELECT p.event_id, p.us, s.event_type AS track_id, max(s.us) AS seen, arg_max(s.value, s.us) AS value FROM e p JOIN e s ON p.user_id = s.user_id AND s.us <= p.us GROUP BY ALL) SELECT event_id, track_id, round(value, 6) AS value FROM j WHERE us - seen <= {2 * DAY}",
    "actor_future_packets": f"{FUTURE} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN p[-1] - us ELSE 0 END AS actual_us, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS n_tracks, 2 AS source, false AS is_model_generated, {7 * DAY} AS requested_us, {HOUR12} AS interval_us FROM t",
    "nav_packets": f"WITH {E} SELECT event_id, CASE WHEN {STOP} THEN 'message_type' ELSE 'ok' END AS reason, CASE WHEN NOT ({STOP}) THEN {NAV} END AS emit_map, CASE WHEN NOT ({STOP}) THEN {NAV} AND {INPUT} END AS emit_input, CASE WHEN NOT ({STOP}) THEN {NAV} AND {INPUT} AND {PLAN} END AS emit_plan FROM e",
    "nav_routes": f"WITH {ROUTES} SELECT event_id, section, CASE WHEN k % 2 = 1 THEN 2 ELSE 1 END AS generator, k + 1 AS sequence, expected, pos AS at, valid, CASE WHEN valid THEN round(value + pos, 6) ELSE 0 END AS x, CASE WHEN valid THEN 4 * pos ELSE 0 END::DOUBLE AS longitudinal_distance FROM r",
    "nav_plans": f"WITH {E} SELECT event_id, CASE WHEN k % 2 = 1 THEN 2 ELSE 4 END AS source, 'planner' AS producer, k % 2 = 1 AS is_model_generated, k % 3 = 0 AS force_gt_active, 3000000 AS requested_us, 3000000 AS actual_us, 3 AS n_points, 1000000 AS last_us, round(value + (value + 1) + (value + 2), 6) AS speeds FROM ({PLANS})",
    "navigation_lines": f"WITH {LINES} SELECT event_id, section, CASE section WHEN 'plan' THEN 3 ELSE 1 END AS marker_id, ns, frame, action, CASE WHEN n >= 2 THEN CASE section WHEN 'plan' THEN 0.26 ELSE 0.28 END END::DOUBLE AS width, CASE WHEN n >= 2 THEN n ELSE 0 END AS n_points, CASE WHEN n >= 2 THEN CASE section WHEN 'plan' THEN 0.8 ELSE 0.1 END END::DOUBLE AS g, CASE WHEN n >= 2 THEN CASE section WHEN 'plan' THEN 1.24 ELSE 0.16 END END::DOUBLE AS z FROM line",
    "navigation_snapshot": f"WITH {ARRAYS} SELECT * FROM arrays QUALIFY seq = max(seq) OVER (PARTITION BY viewer)",
    "map_counts": f"WITH {MAPS} SELECT label::VARCHAR AS scene_id, map_id, 1 AS source_revision, 'map' AS frame_id, count(*) + 1.0::DOUBLE AS extent_x, count(*) AS n_lanes, count(*) FILTER (vec_id % 3 = 0) AS n_road_edges, count(*) FILTER (vec_id % 4 = 0) AS n_traffic_signs, count(*) FILTER (vec_id % 5 = 0) AS n_wait_lines FROM m GROUP BY label, map_id",
    "map_marker_rows": f"WITH {MAPS} SELECT map_id, 0 AS layer, -1 AS at, 0 AS part, '' AS ns, '' AS id, 'map' AS frame, 'DELETEALL' AS action, 0 AS n_points, 0::DOUBLE AS width, NULL::DOUBLE AS z FROM ok UNION ALL " + " UNION ALL ".join(element(*x) for x in ((1, 0, "map/lane_centerlines", 3, 1, 0.02, 0.04), (2, 0, "map/lane_left_boundaries", 2, 1, 0.06, 0.05), (3, 0, "map/road_edges", 2, 3, 0.12, 0.06), (4, 0, "map/wait_lines/stop", 2, 5, 0.2, 0.09), (5, 0, "map/traffic_signs", 1, 4, 0, 0.04), (5, 1, "map/traffic_sign_labels", 1, 4, 0, 0.74))),
    "map_signs": f"WITH {MAPS} SELECT map_id, row_number() OVER (PARTITION BY map_id ORDER BY vec_id) - 1 AS at, 'S' || label || chr(10) || '#' || vec_id AS text, round(embedding[1]::DOUBLE, 6) AS x, round(embedding[3]::DOUBLE + 0.04::DOUBLE, 6) AS sphere_z, round(embedding[3]::DOUBLE + 0.74::DOUBLE, 6) AS label_z FROM m WHERE vec_id % 4 = 0",
    "map_lane_links": f"WITH {MAPS} SELECT map_id, vec_id::VARCHAR AS lane_id, 'successor_ids' AS relation, (vec_id + 1)::VARCHAR AS other_id FROM m",
    "map_client_polls": f"""WITH {E}, b AS (SELECT *, coalesce((event_type <> lag(event_type) OVER w OR k % 3 <> lag(k % 3) OVER w)::INT, 0) AS b FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT user_id, us, event_type, 1 + sum(b) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS revision FROM b),
t AS (SELECT user_id, unnest(generate_series(min(us) - {DAY}, max(us) - {DAY}, {3 * DAY})) AS tick_us FROM e GROUP BY user_id), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tick_us) - 1 AS tick FROM t),
a AS (SELECT n.*, CASE WHEN event_type <> 'error' THEN r.revision END AS asked FROM n ASOF LEFT JOIN r ON n.user_id = r.user_id AND n.tick_us >= r.us),
s AS (SELECT *, max(asked) OVER (PARTITION BY user_id ORDER BY tick) AS revision, max(asked) OVER (PARTITION BY user_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM a)
SELECT user_id, tick, tick_us, revision, CASE WHEN asked IS NULL THEN 'none' WHEN asked = known THEN 'republish' ELSE 'publish' END AS action FROM s""",
    "gt_cache": f"""WITH {E}, g AS (SELECT *, CASE WHEN k % 3 <> 0 THEN k % 2 ELSE 1 END AS v FROM e WHERE k % 7 > 1), b AS (SELECT *, coalesce((event_type <> lag(event_type) OVER w OR v <> lag(v) OVER w)::INT, 0) AS b, row_number() OVER w AS n FROM g WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT event_id, CASE WHEN b = 1 OR n = 1 THEN 'cached' ELSE 'duplicate' END AS status, 1 + sum(b) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS revision, us AS start_us, us + 2 + k AS end_us FROM b
UNION ALL SELECT event_id, 'invalid', NULL, CASE WHEN k % 7 = 1 THEN us END, CASE WHEN k % 7 = 1 THEN us END FROM e WHERE k % 7 <= 1""",
    "gt_future_ticks": f"""WITH {E}, s AS (SELECT user_id, min(us) AS s, max(us) AS t FROM e GROUP BY user_id), t AS (SELECT user_id, t, unnest(generate_series(s, t, {7 * DAY})) AS ref FROM s WHERE user_id % 11 <> 0), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ref) - 1 AS tick, least(ref + {7 * DAY}, t) AS till FROM t),
g AS (SELECT *, generate_series(ref, till, {HOUR6}) AS g FROM n), h AS (SELECT *, CASE WHEN g[-1] <> till THEN list_append(g, till) ELSE g END AS h FROM g),
b AS (SELECT h.*, p.us AS bu, p.value AS bx FROM h ASOF LEFT JOIN e p ON h.user_id = p.user_id AND h.till >= p.us), c AS (SELECT b.*, p.us AS au, p.value AS ax FROM b ASOF LEFT JOIN e p ON b.user_id = p.user_id AND b.till <= p.us)
SELECT user_id, tick, ref AS tick_us, len(h) AS n_points, till - ref AS last_us, round(CASE WHEN bu = till THEN bx ELSE bx + (till - bu)::DOUBLE / (au - bu) * (ax - bx) END, 6) AS last_x FROM c""",
    "executed_path_ticks": f"""WITH {E}, l AS (SELECT user_id, min(us) AS s, max(us) AS t, {greedy('list(us ORDER BY event_id)', HOUR6)} AS p FROM e GROUP BY user_id), k AS (SELECT user_id, p, unnest(generate_series(s, t, {5 * DAY})) AS tick_us FROM l),
q AS (SELECT user_id, tick_us, (list_filter(p, lambda x: x <= tick_us))[-20:] AS q FROM k) SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY tick_us) - 1 AS tick, tick_us, q[1] AS reference_us, q[-1] - q[1] AS duration_us, len(q) AS n_points FROM q""",
    "frame_segments": f"WITH {E}, f AS (SELECT event_id, user_id, us, CASE WHEN event_id // 7 % 2 = 0 THEN 'map' ELSE 'odom' END AS f FROM e WHERE k % 20 <> 0), b AS (SELECT *, coalesce((us < lag(us) OVER w OR f <> lag(f) OVER w)::INT, 0) AS b FROM f WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT event_id, sum(b) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS segment FROM b",
    "duration_rounding": f"WITH {E}, s AS (SELECT event_id, (k * 2 + 1) * 0.5::DOUBLE AS s FROM e) SELECT event_id, round_even(s / 1000000000::DOUBLE * 1000000000::DOUBLE, 0)::BIGINT AS ns, round_even(s * 1000000::DOUBLE, 0)::BIGINT AS us FROM s",
    "framed_packets": f"WITH {E}, f AS (SELECT *, event_id // 20 AS stream, min(CASE WHEN k % 25 = 0 THEN event_id END) OVER (PARTITION BY event_id // 20) AS stop FROM e) SELECT stream, row_number() OVER (PARTITION BY stream ORDER BY event_id) - 1 AS at, '{{\"n\":' || k || '}}' AS payload, k % 4 AS image_bytes FROM f WHERE stop IS NULL OR event_id < stop",
    "camera_static_transforms": f"WITH {CALIBRATIONS} SELECT camera, 'base_link' AS parent, camera || '_optical' AS child, round(k / 2.0::DOUBLE + 2, 6) AS x, round(k / 2.0::DOUBLE, 6) AS qz FROM c WHERE camera <> 'unknown' AND k % 4 <> 3",
    "camera_calibration_json": f"""WITH {CALIBRATIONS}, n AS (SELECT camera, k, k % 4 AS i, chr(10) AS nl, k / 2.0::DOUBLE AS h FROM c),
p AS (SELECT *, '{{' || nl || '        "w": 1,' || nl || '        "x": 0.0,' || nl || '        "y": 0.0,' || nl || '        "z": ' || h || nl || '      }}' AS q, '{{' || nl || '        "x": ' || (h + 2) || ',' || nl || '        "y": ' || (h + 1) || ',' || nl || '        "z": ' || h || nl || '      }}' AS v FROM n),
o AS (SELECT *, CASE i WHEN 0 THEN '"quat": ' || q || ',' || nl || '      "vec": ' || v WHEN 1 THEN '"rotation": ' || q || ',' || nl || '      "translation": ' || v WHEN 2 THEN '"orientation": ' || q || ',' || nl || '      "vec3": ' || v ELSE '"position": ' || v END AS pose FROM p)
SELECT camera AS camera_logical_id, '{{' || nl || '  "available_camera": {{' || nl || '    "logical_id": "' || camera || '",' || nl || '    "rig_to_camera": {{' || nl || '      ' || pose || nl || '    }}' || nl || '  }},' || nl || '  "sensor": {{' || nl || '    "lens": [' || nl || '      ' || k || ',' || nl || '      0.5,' || nl || '      {{' || nl || '        "a": "\\u00e9",' || nl || '        "b": true' || nl || '      }},' || nl || '      []' || nl || '    ],' || nl || '    "model": "f",' || nl || '    "zoom": null' || nl || '  }}' || nl || '}}' AS json FROM o""",
    "actor_quarantine": f"""WITH {E}, {PACKETS}, b AS (SELECT n, count(*) AS n_actors, arg_min(CASE k % 46 WHEN 0 THEN 'track_id' ELSE 'current_state.position.y' END, event_id) FILTER (k % 46 <= 1) AS what FROM p GROUP BY n)
SELECT n AS ingest_seq, CASE WHEN n % 9 = 0 THEN 'message_type' ELSE 'missing actors[].' || what END AS reason, n_actors FROM b""",
    "navigation_arrays": f"WITH {ARRAYS} SELECT * FROM arrays",
    "actor_history_evicted": f"""WITH {E}, s AS (SELECT *, lag(us) OVER w AS before_us, lag(event_id) OVER w AS before_id FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY event_id)),
x AS (SELECT s.*, EXISTS (SELECT 1 FROM e p WHERE p.user_id = s.user_id AND p.event_id < s.event_id AND p.us > s.before_us + {5 * DAY}) AS evicted FROM s),
l AS (SELECT *, sum(evicted::INT) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS life FROM x),
j AS (SELECT p.event_id, p.us, s.event_type AS track_id, s.life, list(s.us ORDER BY s.us)[-19:] AS ring, max(s.us) AS seen FROM e p JOIN l s ON p.user_id = s.user_id AND s.us <= p.us GROUP BY p.event_id, p.us, s.event_type, s.life),
v0 AS (SELECT * FROM j QUALIFY life = max(life) OVER (PARTITION BY event_id, track_id)), v AS (SELECT *, list_filter(ring, lambda x: x >= us - {9 * DAY}) AS l FROM v0 WHERE us - seen <= {5 * DAY}), t AS (SELECT *, {thinned('l', HOUR12, 64)} AS p FROM v WHERE len(l) > 0) SELECT event_id, track_id, len(p) AS n_points, p[1] AS first_us, p[-1] AS last_us FROM t""",
    "executed_path_ticks_age": f"""WITH {E}, l AS (SELECT user_id, min(us) AS s, max(us) AS t, list(us ORDER BY us) AS every, {greedy('list(us ORDER BY event_id)', 10800000000)} AS p FROM e GROUP BY user_id), k AS (SELECT user_id, p, every, unnest(generate_series(s, t, {2 * DAY})) AS tick_us FROM l),
m AS (SELECT *, list_max(list_filter(every, lambda x: x <= tick_us)) AS latest FROM k), q AS (SELECT user_id, tick_us, (list_filter(p, lambda x: x <= latest AND x >= latest - {DAY}))[-4:] AS q FROM m), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tick_us) - 1 AS tick FROM q)
SELECT user_id, tick, tick_us, q[1] AS reference_us, q[-1] - q[1] AS duration_us, len(q) AS n_points FROM n WHERE len(q) > 0""",
}
ORACLE["actor_history_packets"] = f"SELECT event_id, max(actual_us) AS actual_us, count(*) AS n_tracks, 1 AS source, {2 * DAY} AS requested_us, {HOUR12} AS interval_us FROM ({ORACLE['actor_history']}) GROUP BY event_id"
ORACLE["topic_replay"] = f"""WITH {E} SELECT event_id AS ingest_seq, '{{"user_id":' || user_id || ',"k":' || k || '}}' AS payload, event_type AS channel FROM e WHERE event_type IN ('click', 'view')"""
ORACLE["gate_replay"] = f"SELECT user_id, event_id, k AS sequence FROM ({ORACLE['nav_gate']}) g JOIN (WITH {E} SELECT event_id, user_id, k FROM e) USING (event_id) WHERE accepted"
