"""SQL for DuckDB that computes the registered queries on the same tables."""

from oracle_colors import COLOR_CODES, HTML_COLORS

KEY = "flight_id, year, month, day, dep_time"
ORDER = "time, lat, lon, eta, arpt, craft_type"
SAMPLE = "flight_id, year, month, day, time, lat, lon, dep_time, eta, arpt, craft_type"
TRACK = """year, month, day, time, lat, lon, dest_lat, dest_lon, alt, flight_id, dep_airport,
arr_airport, dep_time, eta, status, speed, heading, craft_type"""

AIRPORTS = """
airports AS (
  SELECT cast(n_nationkey AS varchar) AS a_id, n_name AS name, concat('City, ', n_name) AS city,
         CASE WHEN n_regionkey < 4 THEN 'United States' ELSE 'Elsewhere' END AS country,
         concat('N', lpad(cast(n_nationkey AS varchar), 2, '0')) AS faa,
         concat('KN', lpad(cast(n_nationkey AS varchar), 2, '0')) AS icao,
         cast(25 + n_nationkey AS double) AS lat, cast(-120 + 2 * n_nationkey AS double) AS lon,
         cast(n_nationkey * 10 AS double) AS alt, cast(-n_regionkey AS double) AS timezone, 'A' AS dst
  FROM nation
  UNION ALL
  SELECT concat('C', lpad(cast(c_custkey AS varchar), 9, '0')), c_name, concat('City, ', c_mktsegment),
         CASE WHEN c_nationkey % 5 < 4 THEN 'United States' ELSE 'Elsewhere' END,
         concat('C', lpad(cast(c_custkey AS varchar), 9, '0')),
         concat('KC', lpad(cast(c_custkey AS varchar), 9, '0')),
         cast(25 AS double) + cast(c_custkey % 4001 AS double) / 100,
         cast(-120 AS double) + cast(c_custkey * 7 % 5003 AS double) / 100,
         cast(c_custkey % 9000 AS double), cast(-(c_nationkey % 5) AS double), 'U'
  FROM customer)"""

FLIGHTS = f"""
k AS (
  SELECT event_id, event_type, cast(floor(user_id / 5) AS bigint) AS f,
         year(ts) AS y, month(ts) AS m, day(ts) AS d FROM events),
k2 AS (SELECT *, (f*37 + d*211) % 1440 AS dep_min, 60 + (f*13 + d*29) % 300 AS dur,
              (f*3 + d) % 25 AS arr, (f*5 + d*2) % 25 AS dep FROM k),
k3 AS (SELECT *, dep_min + (event_id*17) % (dur + 90) AS t_min, (dep_min + dur) % 1440 AS eta_min FROM k2),
flights AS (
  SELECT cast(y AS int) AS year, cast(m AS int) AS month, cast(d AS int) AS day,
         cast(t_min AS double) / 60 AS time,
         cast(25 + arr AS double) + cast((event_id*7919) % 6001 - 3000 AS double) / 1000 AS lat,
         cast(-120 + 2*arr AS double) + cast((event_id*104729) % 6001 - 3000 AS double) / 1000 AS lon,
         cast(25 + arr AS double) AS dest_lat, cast(-120 + 2*arr AS double) AS dest_lon,
         cast(event_id % 400 AS double) AS alt,
         concat('F', lpad(cast(f AS varchar), 4, '0')) AS flight_id,
         concat('N', lpad(cast(dep AS varchar), 2, '0')) AS dep_airport,
         concat('N', lpad(cast(arr AS varchar), 2, '0')) AS arr_airport,
         cast(dep_min AS double) / 60 AS dep_time, cast(eta_min AS double) / 60 AS eta,
         CASE WHEN event_type = 'signup' THEN 'P' ELSE 'E' END AS status,
         cast(300 + event_id % 200 AS double) AS speed, cast(event_id % 360 AS double) AS heading,
         concat('B', cast(f % 6 AS varchar)) AS craft_type FROM k3)"""


def area(codes: str, reach: float, name: str = "area") -> str:
    return f"""
{name} AS (
  SELECT min(lat) - {reach} AS lat_min, max(lat) + {reach} AS lat_max,
         min(lon) - {reach} AS lon_min, max(lon) + {reach} AS lon_max
  FROM airports WHERE faa IN ({codes}) AND country = 'United States')"""


def lab(source: str) -> str:
    """Samples with the lateness flag, then per flight numbers over the delayed ones."""
    return f"""
lab AS (
  SELECT * RENAME (arr_airport AS arpt),
         CASE WHEN time <= eta THEN 1
              WHEN dep_time > eta AND time >= dep_time AND time <= 24 THEN 2
              WHEN time > 24 AND time % 24 < eta THEN 3
              ELSE 4 END AS branch,
         branch = 4 AS late,
         CASE WHEN branch = 4 THEN 'r' ELSE 'k' END AS label
  FROM {source}),
keys AS (SELECT DISTINCT {KEY} FROM lab WHERE late),
delayed AS (SELECT * FROM lab SEMI JOIN keys USING ({KEY})),
seqd AS (
  SELECT *, row_number() OVER w AS seq, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
  FROM delayed WINDOW w AS (PARTITION BY {KEY} ORDER BY {ORDER})),
top AS (
  SELECT {KEY}, craft_type, time - eta AS delay,
         row_number() OVER (PARTITION BY {KEY} ORDER BY time - eta DESC, craft_type) AS rn FROM delayed),
fd AS (
  SELECT {KEY}, CASE WHEN delay > 0 THEN craft_type END AS craft_type, greatest(delay, 0) AS delay
  FROM top WHERE rn = 1),
firsts AS (
  SELECT {KEY}, time AS first_time, eta AS first_eta, arpt AS first_arpt FROM seqd WHERE seq = 1),
firstlate AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY seq) AS ln FROM seqd WHERE late)
  WHERE ln = 1)"""


def scoped(codes: str, reach: float, both: bool) -> str:
    route = f"arr_airport IN ({codes})" + (f" AND dep_airport IN ({codes})" if both else "")
    return f"""{area(codes, reach)},
scoped AS (
  SELECT flights.* FROM flights, area
  WHERE lat BETWEEN lat_min - 1 AND lat_max + 1 AND lon BETWEEN lon_min - 1 AND lon_max + 1 AND {route})"""


def short(x: str) -> str:
    """Text with at most 12 significant digits, whole numbers with one decimal."""
    return f"regexp_replace(printf('%.12g', {x}), '^(-?[0-9]+)$', '\\1.0')"


def two(x: str) -> str:
    return f"printf('%.2f', {x})"


DATE = "concat(year, '-', month, '-', day)"
COMMENT = f"""concat('Flight ID: ', flight_id, '\\n', 'Date: ', {DATE}, '\\n',
  'Departed Time: ', {short('dep_time')}, '\\n', 'ETA: ', {short('first_eta')}, '\\n',
  'Airport: ', first_arpt, '\\n', 'Time: ', {short('time')}, '\\n')"""

BOUNDARY = """
  SELECT 'west' AS edge, lat_min AS lat_from, lat_max AS lat_to, lon_min AS lon_from, lon_min AS lon_to FROM area
  UNION ALL SELECT 'east', lat_min, lat_max, lon_max, lon_max FROM area
  UNION ALL SELECT 'south', lat_min, lat_min, lon_max, lon_min FROM area
  UNION ALL SELECT 'north', lat_max, lat_max, lon_max, lon_min FROM area"""

SUMMARY = f"""
longest AS (SELECT * FROM fd ORDER BY delay DESC, {KEY} LIMIT 1),
shortest AS (SELECT * FROM fd ORDER BY delay, {KEY} LIMIT 1),
stats AS (
  SELECT s.n AS delayed_flights, s.a AS avg_delay,
         a.flight_id AS max_flight_id, a.year AS max_year, a.month AS max_month, a.day AS max_day,
         a.dep_time AS max_dep_time, a.craft_type AS max_craft_type, a.delay AS max_delay,
         b.flight_id AS min_flight_id, b.year AS min_year, b.month AS min_month, b.day AS min_day,
         b.dep_time AS min_dep_time, b.craft_type AS min_craft_type, b.delay AS min_delay
  FROM (SELECT count(*) AS n, avg(delay) AS a FROM fd) s LEFT JOIN longest a ON true LEFT JOIN shortest b ON true)"""


def _flight_block(prefix: str, first: int) -> str:
    p = prefix
    date = f"concat({p}_year, '-', {p}_month, '-', {p}_day)"
    parts = [f"concat('Flight ID: ', {p}_flight_id)", f"concat('Date: ', {date})",
             f"concat('Departure Time: ', {short(p + '_dep_time')})",
             f"concat('Craft Type: ', coalesce({p}_craft_type, 'None'))",
             f"concat('Delay Time: ', {short(p + '_delay')})"]
    return "".join(f" UNION ALL SELECT {first + i}, {part} FROM stats" for i, part in enumerate(parts))


def report() -> str:
    rule, thick = "-" * 54, "#" * 54
    fixed = {3: rule, 4: "Max Delay:", 5: rule, 11: rule, 12: "Min Delay:", 13: rule, 19: thick, 20: ""}
    return f"""{SUMMARY},
head AS (
  SELECT 1 AS line_no, concat('Number of delayed flights: ', delayed_flights) AS line FROM stats
  UNION ALL SELECT 2, concat('Average Delay Time: ', {short('avg_delay')}) FROM stats
  {_flight_block('max', 6)} {_flight_block('min', 14)}
  UNION ALL SELECT * FROM (VALUES {', '.join(f"({n}, '{t}')" for n, t in fixed.items())})),
sizes AS (SELECT {KEY}, count(*) AS n FROM delayed GROUP BY ALL)
SELECT 0 AS section, cast(NULL AS varchar) AS flight_id, cast(NULL AS int) AS year, cast(NULL AS int) AS month,
       cast(NULL AS int) AS day, cast(NULL AS double) AS dep_time, cast(line_no AS bigint) AS line_no, line FROM head
UNION ALL SELECT 1, {KEY}, 1, concat('Flight ID: ', flight_id) FROM sizes
UNION ALL SELECT 1, {KEY}, 2, concat('Date: ', {DATE}) FROM sizes
UNION ALL SELECT 1, {KEY}, 3, concat('Departed Time: ', {short('dep_time')}) FROM sizes
UNION ALL SELECT 1, {KEY}, n + 4, '' FROM sizes
UNION ALL SELECT 1, {KEY}, n + 5, '' FROM sizes
UNION ALL SELECT 1, {KEY}, seq + 3, concat('Time: ', {two('time')}, chr(9), 'Lat: ', {two('lat')}, chr(9), 'Lon: ',
  {two('lon')}, chr(9), 'Status: ', CASE WHEN late THEN 'Delayed' ELSE 'On-time' END) FROM seqd"""


CODE_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in COLOR_CODES.items())
NAME_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in HTML_COLORS.items())
COLORS = f"""
codes AS (SELECT * FROM (VALUES {CODE_VALUES}) t(code, name)),
names AS (SELECT * FROM (VALUES {NAME_VALUES}) t(name, hex))"""


def picked(values: list[str | None], index: str) -> str:
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"([{items}])[1 + {index} % {len(values)}]"


# Specs that the colour and style queries spread over the events.
COLOR_SPECS = [*COLOR_CODES, *HTML_COLORS, "#0008B", "nosuchcolor", None]
STYLE_TEXT = {
    "color": (["r", None, "", None], 1), "c": (["plum", None, None], 2),
    "edge_color": (["cyan", None, "#123456", ""], 3), "ec": ([None, "k"], 5),
    "face_color": (["blue", None, None], 7), "fc": ([None, "y", ""], 11),
}
STYLE_NUMBER = {
    "alpha": (["0.1", None, "0", None], 1), "edge_alpha": ([None, "0.4", "0"], 2), "ea": (["0.7", None], 3),
    "edge_width": ([None, "10", "0", None], 5), "ew": (["2", None], 7),
    "face_alpha": ([None, None, "0.2"], 11), "fa": ([None, "0.9"], 13),
}


def style_sql() -> str:
    text = ", ".join(f"{picked(v, f'(event_id // {d})')} AS {n}" for n, (v, d) in STYLE_TEXT.items())
    number = ", ".join(
        f"cast({picked(v, f'(event_id // {d})')} AS double) AS {n}" for n, (v, d) in STYLE_NUMBER.items()
    )

    def first(names, default):
        empty = "''" if default.startswith("'") else "0"
        return f"coalesce({', '.join(f'nullif({n}, {empty})' for n in names)}, {default})"

    def hexed(expr):
        return f"""coalesce((SELECT hex FROM names WHERE names.name = coalesce(
          (SELECT codes.name FROM codes WHERE code = {expr}), {expr})), {expr})"""

    return f"""WITH {COLORS},
opts AS (SELECT event_id, {text}, {number} FROM events),
raw AS (
  SELECT event_id, {first(['color', 'c', 'edge_color', 'ec'], "'#000000'")} AS e,
         {first(['color', 'c', 'face_color', 'fc'], "'#000000'")} AS f,
         {first(['alpha', 'edge_alpha', 'ea'], '1.0')} AS edge_alpha,
         {first(['edge_width', 'ew'], '1.0')} AS edge_width,
         {first(['alpha', 'face_alpha', 'fa'], '0.3')} AS face_alpha FROM opts)
SELECT event_id, {hexed('e')} AS edge_color, edge_alpha, edge_width, face_alpha,
       {hexed('f')} AS face_color, {hexed('e')} AS color FROM raw"""


RING = """
ring AS (
  SELECT faa, bearing, radians(lat) AS phi, radians(lon) AS lam, radians(bearing) AS turn,
         cast(CASE WHEN alt = 0 THEN 40 ELSE alt END AS double) / 1000 / 6378.8::double AS arc
  FROM airports, (SELECT unnest(range(0, 360, 10)) AS bearing)),
ring2 AS (
  SELECT *, asin(sin(phi) * cos(arc) + cos(phi) * sin(arc) * cos(turn)) AS phi2 FROM ring),
ring3 AS (
  SELECT *, lam - atan2(sin(turn) * sin(arc) * cos(phi), cos(arc) - sin(phi) * sin(phi2)) + pi() AS x FROM ring2)"""

SHAPES = """
lines AS (
  SELECT user_id, hex, count(*) AS n, arg_min(concat_ws('/', value, -value), event_id) AS first_point,
         arg_max(concat_ws('/', value, -value), event_id) AS last_point,
         string_agg(concat_ws('/', value, -value), ' ' ORDER BY event_id) AS path
  FROM events JOIN (SELECT names.hex FROM codes JOIN names ON names.name = codes.name WHERE code = 'c') ON true
  GROUP BY user_id, hex)"""

CUT_SHAPES = """
spread AS (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq,
         count(*) OVER (PARTITION BY user_id) AS n,
         cast(event_id * 7919 % 179 - 89 AS double) AS lat, cast(event_id * 104729 % 359 - 179 AS double) AS lon FROM events),
cut AS (
  SELECT user_id, seq, n, concat_ws('/', lat, lon) AS point, (seq - 1) // 5 AS piece FROM spread
  UNION ALL SELECT user_id, seq, n, concat_ws('/', lat, lon), (seq - 1) // 5 + 1 FROM spread WHERE seq % 5 = 0 AND seq < n),
lines AS (
  SELECT user_id, piece * 5 + 1 AS start, max(n) AS n, max(seq) AS upto, string_agg(point, ' ' ORDER BY seq) AS path
  FROM cut GROUP BY user_id, piece),
turns AS (
  SELECT user_id, arg_min(concat_ws('/', lat, lon), seq) AS first_point, arg_max(concat_ws('/', lat, lon), seq) AS last_point,
         sum(lon * next_lat - next_lon * lat) AS turned
  FROM (SELECT *, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS next_lat,
               coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS next_lon
        FROM spread WINDOW w AS (PARTITION BY user_id ORDER BY seq)) GROUP BY user_id),
style AS (
  SELECT names.hex, cast(1 AS double) AS edge_alpha, cast(2 AS double) AS edge_width, cast(0.3 AS double) AS face_alpha
  FROM codes JOIN names ON names.name = codes.name WHERE code = 'c')"""
CUT_STYLE = "hex AS edge_color, edge_alpha, edge_width, face_alpha, hex AS face_color, hex AS color"

GRID = """
specs AS (
  SELECT faa, lat - 1.5 AS lat_min, lat + 1.5 AS lat_max, lon - 1.0 AS lon_min, lon + 1.0 AS lon_max,
         cast(5 + cast(alt AS bigint) % 7 AS double) / 10 AS lat_step,
         cast(3 + cast(alt AS bigint) % 5 AS double) / 10 AS lon_step FROM airports),
nums AS (SELECT *, cast(trunc((lat_max - lat_min) / lat_step) AS bigint) AS n_lat,
                cast(trunc((lon_max - lon_min) / lon_step) AS bigint) AS n_lon FROM specs),
lat_lines AS (SELECT *, unnest(range(0, n_lat)) AS line FROM nums),
lon_lines AS (SELECT *, unnest(range(0, n_lon)) AS line FROM nums)"""

ONE = scoped("'N07'", 1.5, False)
TWO = scoped("'N03', 'N06'", 0.5, True)


def _all(tail: str) -> str:
    return f"WITH {FLIGHTS}, {lab('flights')} {tail}"


def _scoped(scope_sql: str, tail: str) -> str:
    return f"WITH {AIRPORTS}, {FLIGHTS}, {scope_sql}, {lab('scoped')} {tail}"


def _geo(tail: str) -> str:
    return f"WITH {AIRPORTS}, {area(chr(39) + 'N03' + chr(39) + ', ' + chr(39) + 'N06' + chr(39), 0.5)} {tail}"


_SUMMARY_OUT = """SELECT * REPLACE (round(avg_delay, 6) AS avg_delay) FROM stats"""
_KEYED = f"{KEY}, craft_type, delay"


def oracle_sql() -> dict[str, str]:
    return {
        "date_spec_scan": f"""WITH {FLIGHTS},
hits AS (
  SELECT '2024/1/7' AS spec, * FROM flights WHERE year = 2024 AND month = 1 AND day = 7
  UNION ALL SELECT '//15', * FROM flights WHERE day = 15
  UNION ALL SELECT '/1/', * FROM flights WHERE month = 1
  UNION ALL SELECT '2024//', * FROM flights WHERE year = 2024
  UNION ALL SELECT '//', * FROM flights)
SELECT spec, year, month, day, count(*) AS samples FROM hits GROUP BY ALL""",
        "scan_counts": f"WITH {FLIGHTS} SELECT year, month, day, count(*) AS samples FROM flights GROUP BY ALL",
        "parse_flight_lines": f"WITH {FLIGHTS} SELECT {TRACK} FROM flights",
        "parse_airport_lines": f"WITH {AIRPORTS} SELECT * FROM airports",
        "project_samples": _all(f"SELECT {SAMPLE} FROM lab"),
        "filter_status": f"WITH {FLIGHTS} SELECT {TRACK} FROM flights WHERE status = 'E'",
        "filter_area": f"""WITH {AIRPORTS}, {FLIGHTS}, {area("'N07'", 1.5)}
SELECT {TRACK} FROM flights, area
WHERE lat BETWEEN lat_min - 1 AND lat_max + 1 AND lon BETWEEN lon_min - 1 AND lon_max + 1""",
        "filter_route_one": f"WITH {FLIGHTS} SELECT {TRACK} FROM flights WHERE arr_airport = 'N07'",
        "filter_route_two": f"""WITH {FLIGHTS} SELECT {TRACK} FROM flights
WHERE arr_airport IN ('N03', 'N06') AND dep_airport IN ('N03', 'N06')""",
        "lookup_airports": f"""WITH {AIRPORTS} SELECT * FROM airports
WHERE faa IN ('N07', 'N09', 'C000000042') AND country = 'United States'""",
        "missing_airports": f"""WITH {AIRPORTS}
SELECT faa FROM (VALUES ('N07'), ('N09'), ('ZZZ')) t(faa)
WHERE faa NOT IN (SELECT faa FROM airports WHERE country = 'United States')""",
        "label_samples": _all(f"SELECT {SAMPLE}, late, label FROM lab"),
        "late_samples": f"""{_all(f"SELECT {SAMPLE} FROM lab WHERE late")}""",
        "late_branch_counts": _all("SELECT branch, count(*) AS samples FROM lab GROUP BY ALL"),
        "delayed_flight_keys": _all("SELECT * FROM keys"),
        "delayed_flight_samples": _all(f"SELECT {SAMPLE}, late, label FROM delayed"),
        "delayed_flight_samples_window": _all(f"SELECT {SAMPLE}, late, label FROM delayed"),
        "flight_delay": _all(f"SELECT {_KEYED} FROM fd"),
        "max_delay_flight": _all(f"SELECT {_KEYED} FROM fd ORDER BY delay DESC, {KEY} LIMIT 1"),
        "min_delay_flight": _all(f"SELECT {_KEYED} FROM fd ORDER BY delay, {KEY} LIMIT 1"),
        "delay_summary": _all(f", {SUMMARY} {_SUMMARY_OUT}"),
        "flight_tracks": _all(f"""
SELECT {KEY}, (seq - 1) // 10000 * 10000 + 1 AS start, cast(count(*) AS int) AS samples,
       string_agg(concat_ws('/', label, time, lat, lon), ' ' ORDER BY seq) AS path
FROM seqd GROUP BY {KEY}, (seq - 1) // 10000"""),
        "track_geojson": _all(f"""
SELECT {KEY}, cast(1 AS bigint) AS start, concat(
  '{{"type":"Feature","geometry":{{"type":"LineString","coordinates":[',
  string_agg(concat('[', lon, ',', lat, ']'), ',' ORDER BY seq),
  ']}},"properties":{{"flight_id":"', flight_id, '","date":"', {DATE}, '","dep_time":', dep_time, ',"start":1}}}}') AS geojson
FROM seqd GROUP BY {KEY} HAVING count(*) > 1"""),
        "flight_tracks_cut": _all(f"""
SELECT {KEY}, (seq - 1) // 5 * 5 + 1 AS start, cast(count(*) AS int) AS samples,
       string_agg(concat_ws('/', label, time, lat, lon), ' ' ORDER BY seq) AS path
FROM seqd GROUP BY {KEY}, (seq - 1) // 5"""),
        "polyline_layer": f"""WITH {COLORS}, {SHAPES}
SELECT user_id, hex AS edge_color, cast(1 AS double) AS edge_alpha, cast(2 AS double) AS edge_width,
       cast(0.3 AS double) AS face_alpha, hex AS face_color, hex AS color, path FROM lines""",
        "polygon_layer": f"""WITH {COLORS}, {SHAPES}
SELECT user_id, hex AS edge_color, cast(1 AS double) AS edge_alpha, cast(2 AS double) AS edge_width,
       cast(0.3 AS double) AS face_alpha, hex AS face_color, hex AS color,
       CASE WHEN n = 1 OR first_point = last_point THEN path ELSE concat(path, ' ', first_point) END AS ring FROM lines""",
        "polyline_layer_cut": f"""WITH {COLORS}, {CUT_SHAPES}
SELECT user_id, start, path, {CUT_STYLE} FROM lines JOIN style ON true""",
        "polygon_layer_cut": f"""WITH {COLORS}, {CUT_SHAPES}
SELECT user_id, start, CASE WHEN upto = n AND last_point <> first_point THEN concat(path, ' ', first_point) ELSE path END AS ring,
       cast(sign(turned) AS int) AS orientation, {CUT_STYLE}
FROM lines JOIN turns USING (user_id) JOIN style ON true""",
        "scatter_circle_layer": f"""WITH {AIRPORTS}, {RING}, {COLORS},
shape AS (
  SELECT faa, string_agg(concat(round(degrees(phi2), 6) + 0.0, '/',
    round(degrees(x - 2 * pi() * floor(x / (2 * pi())) - pi()), 6) + 0.0), ' ' ORDER BY bearing) AS ring
  FROM ring3 GROUP BY faa)
SELECT faa, ring, '#000000' AS color, '#000000' AS edge_color, '#000000' AS face_color, cast(1 AS double) AS edge_alpha,
       cast(1 AS double) AS edge_width, cast(0.3 AS double) AS face_alpha
FROM shape""",
        "track_segments": _all(f"""
SELECT {KEY}, seq, prev_lat AS from_lat, prev_lon AS from_lon, lat AS to_lat, lon AS to_lon, label,
       CASE WHEN late THEN '#FF0000' ELSE '#000000' END AS color, 5 AS width
FROM seqd WHERE seq > 1"""),
        "first_late_marker": _all(f"""
SELECT {KEY}, time, lat, lon, {COMMENT} AS comment, '#0008B' AS color
FROM firstlate JOIN firsts USING ({KEY})"""),
        "first_sample_attrs": _all(f"SELECT {KEY}, first_time, first_eta, first_arpt FROM firsts"),
        "airport_area": _geo("SELECT * FROM area"),
        "area_center": _geo("""
SELECT (lat_min + lat_max) / 2 AS center_lat, (lon_min + lon_max) / 2 AS center_lon FROM area"""),
        "area_boundary": _geo(f"SELECT *, '#6495ED' AS color, 10 AS width FROM ({BOUNDARY})"),
        "area_polygon": _geo("""
SELECT *, concat_ws(' ', concat_ws('/', lat_min, lon_min), concat_ws('/', lat_min, lon_max),
  concat_ws('/', lat_max, lon_max), concat_ws('/', lat_max, lon_min), concat_ws('/', lat_min, lon_min)) AS ring
FROM area"""),
        "point_layer": f"""WITH {COLORS},
points AS (
  SELECT event_id, value AS lat, -value AS lon, CASE WHEN event_type <> 'error' THEN event_type END AS comment,
         {picked(COLOR_SPECS, 'event_id')} AS spec FROM events)
SELECT event_id, lat, lon, coalesce(comment, 'No comment') AS comment,
       substring(coalesce(hex, spec, '#FF0000'), 2) AS color
FROM points LEFT JOIN codes ON code = spec LEFT JOIN names ON names.name = coalesce(codes.name, spec)""",
        "resolve_colors": f"""WITH {COLORS},
points AS (SELECT event_id, {picked(COLOR_SPECS, 'event_id')} AS spec FROM events)
SELECT event_id, spec, coalesce(hex, spec) AS color
FROM points LEFT JOIN codes ON code = spec LEFT JOIN names ON names.name = coalesce(codes.name, spec)""",
        "resolve_style": style_sql(),
        "circle_ring": f"""WITH {AIRPORTS}, {RING}
SELECT faa, cast(bearing AS int) AS bearing, round(degrees(phi2), 6) + 0.0 AS ring_lat,
       round(degrees(x - 2 * pi() * floor(x / (2 * pi())) - pi()), 6) + 0.0 AS ring_lon FROM ring3""",
        "circle_layer": f"""WITH {AIRPORTS}, {RING}, {COLORS},
shape AS (
  SELECT faa, string_agg(concat(round(degrees(phi2), 6) + 0.0, '/',
    round(degrees(x - 2 * pi() * floor(x / (2 * pi())) - pi()), 6) + 0.0), ' ' ORDER BY bearing) AS ring
  FROM ring3 GROUP BY faa),
styled AS (SELECT faa, coalesce(nullif(dst, 'A'), 'c') AS spec, nullif(alt, 0) AS width FROM airports)
SELECT faa, ring, hex AS color, hex AS edge_color, hex AS face_color, cast(1 AS double) AS edge_alpha,
       coalesce(width, 1) AS edge_width, cast(0.5 AS double) AS face_alpha
FROM shape JOIN styled USING (faa) JOIN (
  SELECT 'U' AS spec, 'U' AS hex UNION ALL
  SELECT code, names.hex FROM codes JOIN names ON names.name = codes.name) USING (spec)""",
        "sample_density": f"""WITH {FLIGHTS}
SELECT cast(floor(lat / 0.5) AS bigint) AS lat_cell, cast(floor(lon / 0.5) AS bigint) AS lon_cell,
       count(*) AS samples FROM flights GROUP BY ALL""",
        "heatmap_layer": f"""WITH {FLIGHTS}
SELECT cast(floor((lat - 20.0) / 1.0) AS bigint) AS lat_cell, cast(floor((lon + 130.0) / 1.0) AS bigint) AS lon_cell,
       count(*) AS samples, 10 AS threshold, 35 AS radius, cast(0.6 AS double) AS opacity, false AS dissipating,
       'rgba(12, 24, 36, 0) rgba(60, 70, 80, 1)' AS gradient
FROM flights GROUP BY lat_cell, lon_cell""",
        "grid_lines": f"""WITH {AIRPORTS}, {GRID}
SELECT faa, 'lat' AS axis, line, lat_min + line * lat_step + lat_step / 2 AS lat_from,
       lat_min + line * lat_step + lat_step / 2 AS lat_to,
       lon_min + lon_step / 2 AS lon_from, lon_max + lon_step / 2 AS lon_to, '#000000' AS color FROM lat_lines
UNION ALL
SELECT faa, 'lon', line, lat_min + lat_step / 2, lat_max + lat_step / 2,
       lon_min + line * lon_step + lon_step / 2, lon_min + line * lon_step + lon_step / 2, '#000000' FROM lon_lines""",
        "report_lines": _all(f", {report()}"),
        "numbered_report_lines": f"""
SELECT *, row_number() OVER (ORDER BY section, {', '.join(f'{c} NULLS FIRST' for c in KEY.split(', '))}, line_no) AS report_no
FROM ({_all(f", {report()}")})""",
        "scoped_samples_one": _scoped(ONE, f"SELECT {SAMPLE}, late, label FROM lab"),
        "scoped_samples_two": _scoped(TWO, f"SELECT {SAMPLE}, late, label FROM lab"),
        "scoped_flight_delay_one": _scoped(ONE, f"SELECT {_KEYED} FROM fd"),
        "scoped_flight_delay_two": _scoped(TWO, f"SELECT {_KEYED} FROM fd"),
        "scoped_delay_summary_one": _scoped(ONE, f", {SUMMARY} {_SUMMARY_OUT}"),
        "scoped_delay_summary_two": _scoped(TWO, f", {SUMMARY} {_SUMMARY_OUT}"),
        "scoped_report_lines_one": _scoped(ONE, f", {report()}"),
    }
