import json
import math
import random

import pytest
from helpers import samples_df

from pyspark.sql import functions as F
from skylag.functions.colors import COLOR_CODES, HTML_COLORS, hex_color, resolve_colors
from skylag.operators import layers, tracks
from skylag.operators.style import resolve_style


def test_color_table(spark):
    specs = [*COLOR_CODES, *HTML_COLORS, "#0008B", "other", None]
    frame = spark.createDataFrame([(s, s) for s in specs], "spec string, color string")
    colored = resolve_colors(frame, "color")
    rows = {r.spec: r.color for r in colored.collect()}
    assert len(COLOR_CODES) + len(HTML_COLORS) == 148
    assert rows["r"] == "#FF0000" and rows["k"] == "#000000" and rows["plum"] == "#DDA0DD"
    assert all(rows[s] == hex_color(s) for s in specs[:-1]) and rows[None] is None
    assert hex_color("c") == "#00FFFF" and hex_color("#0008B") == "#0008B"
    assert "Join" not in colored._jdf.queryExecution().executedPlan().toString()


def styled(spark, schema, *row, circle=False):
    return resolve_style(spark.createDataFrame([row], schema), circle).first().asDict()


def test_style_defaults(spark):
    assert styled(spark, "id int", 1) == {
        "id": 1, "edge_color": "#000000", "edge_alpha": 1.0, "edge_width": 1.0,
        "face_alpha": 0.3, "face_color": "#000000", "color": "#000000",
    }


def test_style_color_wins_and_zero_is_absent(spark):
    got = styled(
        spark, "color string, edge_color string, alpha double, ea double, edge_width int, ew int, fc string",
        "plum", "red", 0.0, 0.4, 0, 7, "y",
    )
    assert got == {
        "edge_color": "#DDA0DD", "edge_alpha": 0.4, "edge_width": 7.0, "face_alpha": 0.3,
        "face_color": "#DDA0DD", "color": "#DDA0DD",
    }


def test_style_edge_and_face(spark):
    got = styled(spark, "edge_color string, face_color string, face_alpha double", "teal", "orchid", 0.65)
    assert (got["edge_color"], got["face_color"], got["color"], got["face_alpha"]) == (
        "#008080", "#DA70D6", "#008080", 0.65,
    )


def test_circle_style(spark):
    assert styled(spark, "id int", 1, circle=True)["face_alpha"] == 0.5
    assert styled(spark, "face_alpha double", None, circle=True)["face_alpha"] == 0.5
    assert styled(spark, "alpha double", 0.85, circle=True)["face_alpha"] == 0.85


def distance_m(lat1, lon1, lat2, lon2):
    a, b, c, d = map(math.radians, (lat1, lon1, lat2, lon2))
    cos = math.sin(a) * math.sin(c) + math.cos(a) * math.cos(c) * math.cos(b - d)
    return math.acos(min(1.0, cos)) * 6378.8 * 1000


def test_circle_vertices_lie_on_the_circle(spark):
    points = spark.createDataFrame([(48.2, 16.4, 5000), (-10.0, 179.99, 20000)], "lat double, lon double, radius int")
    rows = layers.circle_ring(points, "radius").collect()
    assert len(rows) == 72
    for r in rows:
        assert distance_m(r.lat, r.lon, r.ring_lat, r.ring_lon) == pytest.approx(r.radius, rel=1e-4)
        assert -180 <= r.ring_lon < 180
    north, west = rows[0], rows[9]
    assert north.ring_lat > north.lat and north.ring_lon == pytest.approx(north.lon)
    assert west.ring_lon < west.lon
    ring = layers.circle_layer(points, "radius").first().ring
    assert [(p.lat, p.lon) for p in ring] == [(r.ring_lat, r.ring_lon) for r in rows[:36]]


@pytest.mark.parametrize("size, s, metres", [(0, None, 40), (None, 75, 75), (500, 75, 500)])
def test_circle_sizes(spark, size, s, metres):
    points = spark.createDataFrame([(48.2, 16.4, size, s)], "lat double, lon double, size int, s int")
    r = layers.circle_ring(points, "size", "s").first()
    assert distance_m(r.lat, r.lon, r.ring_lat, r.ring_lon) == pytest.approx(metres, rel=0.02)


def test_point_layer(spark):
    points = spark.createDataFrame(
        [(1.0, 2.0, None, "r"), (1.0, 2.0, "here", "#0008B")], "lat double, lon double, comment string, color string"
    )
    rows = sorted(tuple(r) for r in layers.point_layer(points).collect())
    assert rows == [(1.0, 2.0, "No comment", "FF0000"), (1.0, 2.0, "here", "0008B")]


def test_grid_lines(spark):
    spec = "lat_min double, lat_max double, lat_step double, lon_min double, lon_max double, lon_step double"
    rows = layers.grid_lines(spark.createDataFrame([(12.5, 13.5, 0.125, 70.0, 71.5, 0.25)], spec)).collect()
    assert [r.axis for r in rows] == ["lat"] * 8 + ["lon"] * 6
    assert rows[0].lat_from == rows[0].lat_to == 12.5 + 0.0625
    assert (rows[0].lon_from, rows[0].lon_to) == (70.0 + 0.125, 71.5 + 0.125)
    assert layers.grid_lines(spark.createDataFrame([(1.0, 1.0, 0.5, 3.0, 2.0, 0.5)], spec)).count() == 0


def test_boundary_edges(spark):
    area = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "lat_min double, lat_max double, lon_min double, lon_max double")
    edges = {r.edge: (r.lat_from, r.lat_to, r.lon_from, r.lon_to) for r in layers.area_boundary(area).collect()}
    assert edges == {
        "west": (1, 2, 3, 3), "east": (1, 2, 4, 4), "south": (1, 1, 4, 3), "north": (2, 2, 4, 3),
    }
    ring = [tuple(p) for p in layers.area_polygon(area).first().ring]
    assert ring[0] == ring[-1] and set(ring) == {(1, 3), (1, 4), (2, 3), (2, 4)}


def test_heatmap_settings(spark):
    df = samples_df(spark, *[{"lat": 30.1}] * 12, {"lat": 40.0})
    cells = layers.sample_density(df, step=0.5, threshold=10)
    row = layers.heatmap_layer(cells, gradient=[(12, 200, 7, 1)]).first()
    assert (row.samples, row.threshold, row.radius, row.opacity, row.dissipating) == (12, 10, 10, 0.6, True)
    assert row.gradient == ["rgba(12, 200, 7, 1)"]
    assert layers.heatmap_layer(cells).first().gradient == []


def test_geojson_pieces_join_up(spark):
    df = samples_df(spark, *[{"time": 9.0 + n, "lat": 30.0 + n, "eta": 9.5} for n in range(5)], {"flight_id": "ONE", "time": 20.0})
    whole = layers.track_geojson(tracks.delayed_tracks(df)).collect()
    assert len(whole) == 1
    feature = json.loads(whole[0].geojson)
    assert feature["properties"] == {"flight_id": "UAL1", "date": "2004-5-1", "dep_time": 9.0, "start": 1}
    assert feature["geometry"]["coordinates"] == [[-118.0, 30.0 + n] for n in range(5)]
    pieces = layers.track_geojson(tracks.delayed_tracks(df), 2).orderBy("start").collect()
    lines = [json.loads(p.geojson)["geometry"]["coordinates"] for p in pieces]
    assert [[y for _, y in line] for line in lines] == [[30, 31], [31, 32, 33], [33, 34]]


def test_circle_colours_and_default_size(spark):
    assert styled(spark, "fc string", "y", circle=True)["face_color"] == "#000000"
    assert styled(spark, "face_color string", "y", circle=True)["face_color"] == "#FFFF00"
    points = spark.createDataFrame([(10.0, 20.0, "r")], "lat double, lon double, color string")
    plain = layers.circle_ring(points).where("bearing = 0").first()
    sized = layers.circle_ring(points.withColumn("size", F.lit(40)), "size").where("bearing = 0").first()
    assert plain.ring_lat == sized.ring_lat
    row = layers.scatter_circle_layer(points).first()
    assert (row.face_alpha, row.face_color, row.edge_color) == (0.3, "#FF0000", "#FF0000")


def test_default_marker_colour(spark):
    points = spark.createDataFrame([(1.0, 2.0, None, None)], "lat double, lon double, comment string, color string")
    assert layers.point_layer(points).first().color == "FF0000"
    assert layers.point_layer(points, layers.SCATTER_COLOR).first().color == "000000"


def shape_points(spark, n=53):
    rnd = random.Random(9)
    rows = [("big", k, rnd.choice([1.0, 2.0, 3.5]), rnd.uniform(-9, 9), "r", 0 if k else 4) for k in range(n)]
    rows += [("one", 5, 1.0, 2.0, "g", 3), ("two", 2, 1.0, 2.0, None, 1), ("two", 1, 0.0, 0.0, "k", 2)]
    rows += [("ring", k, y, x, None, None) for k, (y, x) in enumerate([(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)])]
    rows += [("back", k, y, x, None, None) for k, (y, x) in enumerate([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)])]
    return rows, spark.createDataFrame(rows, "id string, at int, lat double, lon double, color string, ew int").repartition(4)


@pytest.mark.parametrize("size", [1, 2, 5, 10_000])
def test_lines_in_pieces(spark, size):
    """Pieces of any size join up to the whole line; settings are those of the first point."""
    rows, frame = shape_points(spark)
    whole = {}
    for key, at, lat, lon, *_ in sorted(rows, key=lambda r: (r[0], r[1])):
        whole.setdefault(key, []).append((lat, lon))
    got = {}
    for r in layers.polyline_layer(frame, ["id"], "at", size).orderBy("id", "start").collect():
        line = got.setdefault(r.id, [])
        assert r.start == len(line) + 1 and len(r.path) <= size + 1
        own = [tuple(p) for p in r.path]
        if line:
            assert own.pop(0) == line[-1]
        line += own
        if r.id == "big":
            assert r.color == "#FF0000" and r.edge_width == 4
    assert got == whole


@pytest.mark.parametrize("size", [1, 3, 10_000])
def test_rings_in_pieces(spark, size):
    rows, frame = shape_points(spark)
    got, turns = {}, {}
    for r in layers.polygon_layer(frame, ["id"], "at", size).orderBy("id", "start").collect():
        own = [tuple(p) for p in r.ring]
        got.setdefault(r.id, []).extend(own[1:] if r.start > 1 else own)
        turns.setdefault(r.id, set()).add(r.orientation)
    for key, ring in got.items():
        assert ring[0] == ring[-1]
        points = [(lat, lon) for k, at, lat, lon, *_ in sorted(rows, key=lambda r: (r[0], r[1])) if k == key]
        assert ring == points if points[0] == points[-1] else ring == [*points, points[0]]
        area = sum(x0 * y1 - x1 * y0 for (y0, x0), (y1, x1) in zip(ring, ring[1:]))
        assert turns[key] == {(area > 0) - (area < 0)}
    assert (turns["ring"], turns["back"], turns["one"], turns["two"]) == ({1}, {-1}, {0}, {0})


def test_style_needs_no_join(spark):
    frame = spark.createDataFrame([("r", 1)], "label string, id int")
    for df in (resolve_style(frame.withColumnRenamed("label", "c")), layers.segment_layer(frame)):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
