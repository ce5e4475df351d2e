"""Map layers as tables: lines, polygons, points, circles, density, grid."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.functions.colors import hex_color, resolve_colors
from skylag.functions.geo import CIRCLE_STEP_DEG, circle_vertex
from skylag.functions.text import FLIGHT_DATE, marker_comment
from skylag.operators.delays import flight_ends
from skylag.operators.series import in_pieces, numbered
from skylag.operators.style import resolve_style
from skylag.operators.tracks import PATH_SAMPLES, collect_paths
from skylag.schema import KEY
from skylag.sources.stored import StoredTables

# Styles of the delay map, and defaults of points and heat maps.
BOUNDARY_COLOR, BOUNDARY_WIDTH = "cornflowerblue", 10
TRACK_WIDTH = 5
MARKER_COLOR = "#0008B"
NO_COMMENT = "No comment"
POINT_COLOR, SCATTER_COLOR = "#FF0000", "#000000"
POINT_SIZE = 40
HEAT_THRESHOLD, HEAT_RADIUS, HEAT_OPACITY = 10, 10, 0.6


def area_boundary(area: DataFrame) -> DataFrame:
    """The four edges of each area: west, east, south, north."""
    ends = {
        "west": ("lat_min", "lat_max", "lon_min", "lon_min"),
        "east": ("lat_min", "lat_max", "lon_max", "lon_max"),
        "south": ("lat_min", "lat_min", "lon_max", "lon_min"),
        "north": ("lat_max", "lat_max", "lon_max", "lon_min"),
    }
    names = ("lat_from", "lat_to", "lon_from", "lon_to")
    edges = [
        F.struct(F.lit(edge).alias("edge"), *[F.col(c).alias(n) for c, n in zip(columns, names)])
        for edge, columns in ends.items()
    ]
    return area.select(F.inline(F.array(*edges))).select(
        "*",
        F.lit(hex_color(BOUNDARY_COLOR)).alias("color"),
        F.lit(BOUNDARY_WIDTH).alias("width"),
    )


def area_polygon(area: DataFrame) -> DataFrame:
    """Each area as a closed ring of points, from the south-west corner."""
    corners = [("lat_min", "lon_min"), ("lat_min", "lon_max"), ("lat_max", "lon_max"),
               ("lat_max", "lon_min"), ("lat_min", "lon_min")]
    ring = F.array(*[F.struct(F.col(a).alias("lat"), F.col(b).alias("lon")) for a, b in corners])
    return area.select(*area.columns, ring.alias("ring"))


def segment_layer(segments: DataFrame) -> DataFrame:
    """Track segments in the colour of their label."""
    lines = segments.withColumn("color", F.col("label")).withColumn("width", F.lit(TRACK_WIDTH))
    return resolve_colors(lines, "color")


def first_late_marker(samples: DataFrame) -> DataFrame:
    """One marker per delayed flight, at its first late sample."""
    return late_marker(flight_ends(samples))


def late_marker(ends: DataFrame) -> DataFrame:
    """Markers from the flights' first and first late samples."""
    comment = marker_comment("first.eta", "first.arpt", "first_late.time")
    return ends.selectExpr(
        *KEY,
        "first_late.time AS time", "first_late.lat AS lat", "first_late.lon AS lon",
        f"{comment} AS comment",
        f"'{MARKER_COLOR}' AS color",
    )


def track_geojson(tracks: DataFrame, path_samples: int = PATH_SAMPLES) -> DataFrame:
    """Each delayed flight as a GeoJSON line. The later pieces of a long flight start
    at the last point of the piece before; a flight of one sample has no line."""
    points = "transform(path, p -> array(p.lon, p.lat))"
    paths = collect_paths(tracks, "lat", "lon", path_samples=path_samples)
    return paths.where("samples > 1 OR start > 1").selectExpr(
        *KEY, "start",
        f"""to_json(struct(
            'Feature' AS type,
            struct('LineString' AS type,
                   if(start > 1, concat(array(array(lead.prev_lon, lead.prev_lat)), {points}), {points})
                   AS coordinates) AS geometry,
            struct(flight_id, {FLIGHT_DATE} AS date, dep_time, start) AS properties)) AS geojson""",
    )


def point_layer(points: DataFrame, default_color: str = POINT_COLOR) -> DataFrame:
    """Markers from ``lat, lon, comment, color``; the colour becomes an icon name,
    its hex code without the first character. Scattered points have black as default."""
    given = points.withColumn("color", F.coalesce("color", F.lit(default_color)))
    markers = resolve_colors(given, "color")
    return markers.withColumns({
        "comment": F.coalesce("comment", F.lit(NO_COMMENT)),
        "color": F.expr("substring(color, 2)"),
    })


_BEARINGS = f"sequence(0, {360 - CIRCLE_STEP_DEG}, {CIRCLE_STEP_DEG})"


def _metres(sizes: tuple[str, ...]) -> str:
    given = "".join(f"nullif({size}, 0), " for size in sizes)
    return f"cast(coalesce({given}{POINT_SIZE}) AS double)"


def circle_ring(points: DataFrame, *sizes: str) -> DataFrame:
    """Vertices of a circle around each point: 36 rows with ``bearing, ring_lat, ring_lon``.

    The radius in metres is the first of the size columns that is given and not 0,
    else the default point size.
    """
    spread = points.select("*", F.expr(f"explode({_BEARINGS}) AS bearing"))
    lat, lon = circle_vertex("lat", "lon", _metres(sizes), "bearing")
    return spread.selectExpr("*", f"{lat} AS ring_lat", f"{lon} AS ring_lon")


def circle_layer(points: DataFrame, *sizes: str) -> DataFrame:
    """Each point with the settings of a circle and its ring as one array of vertices."""
    return resolve_style(points.selectExpr("*", _ring(sizes)), circle=True)


def scatter_circle_layer(points: DataFrame, *sizes: str) -> DataFrame:
    """Scattered points drawn as circles. Their settings are those of any shape, and
    the face has the main colour."""
    styled = resolve_style(points.selectExpr("*", _ring(sizes)))
    return styled.withColumn("face_color", F.col("color"))


def _ring(sizes: tuple[str, ...]) -> str:
    lat, lon = circle_vertex("lat", "lon", _metres(sizes), "bearing")
    return f"transform({_BEARINGS}, bearing -> struct({lat} AS lat, {lon} AS lon)) AS ring"


def polyline_layer(
    points: DataFrame, key: list[str], order: str, piece_points: int = PATH_SAMPLES, tables: StoredTables | None = None
) -> DataFrame:
    """A line through the points of each key in the given order, with its style.

    Columns beside the key, the order, ``lat`` and ``lon`` are settings; those of the
    first point hold. A line of more than ``piece_points`` points gives several rows, told
    apart by ``start``, the place of their first point of their own; from the second on
    they begin with the last point of the piece before. Points of equal order come in the
    order of lat and lon.
    """
    pieces = _pieces(points, key, order, piece_points, tables)
    return resolve_style(pieces.selectExpr("*", "_points AS path").drop(*_INNER))


def polygon_layer(
    points: DataFrame, key: list[str], order: str, piece_points: int = PATH_SAMPLES, tables: StoredTables | None = None
) -> DataFrame:
    """An area bounded by the points of each key in the given order, with edge and face
    style; else like polyline_layer.

    The last piece ends with the first point, if the points do not end there themselves.
    ``orientation`` is 1 for a ring that turns counterclockwise, -1 for clockwise, 0 for
    none: the sign of the sum of the cross products of neighbouring points.
    """
    pieces = _pieces(points, key, order, piece_points, tables)
    closing = "_piece = _last AND _points[size(_points) - 1] <> _first"
    rings = pieces.selectExpr("*", f"if({closing}, concat(_points, array(_first)), _points) AS ring")
    # Points far from the origin would cost digits, so the first point is the origin.
    cross = """aggregate(sequence(1, greatest(size(ring) - 1, 1)), 0D, (s, i) -> s + if(size(ring) < 2, 0D,
        (ring[i - 1].lon - _first.lon) * (ring[i].lat - _first.lat)
        - (ring[i].lon - _first.lon) * (ring[i - 1].lat - _first.lat)))"""
    turned = F.sum(F.expr(cross)).over(Window.partitionBy(*key))
    return resolve_style(rings.withColumn("orientation", F.signum(turned).cast("int")).drop(*_INNER))


# Columns of pieces that no layer shows.
_INNER = ["_piece", "_points", "_first", "_last"]


def _pieces(points: DataFrame, key: list[str], order: str, piece_points: int, tables: StoredTables | None) -> DataFrame:
    """Key, ``start``, ``_piece, _points, _last`` piece, the key's ``_first`` point and its settings.

    Positions come from ranges and prefix sums; no task and no row holds a whole line.
    """
    tables = tables or StoredTables(points.sparkSession)
    style = [c for c in points.columns if c not in (*key, order, "lat", "lon")]
    seq = numbered(points, key, [order, "lat", "lon"], tables, "_seq", "_total")
    pieces = in_pieces(seq, piece_points, "_seq", "_total", "_piece", "_lead").groupBy(*key, "_piece").agg(
        F.sort_array(F.collect_list(F.struct("_seq", "lat", "lon"))).alias("_rows"), F.max("_total").alias("_total"),
    ).selectExpr(
        *key, f"_piece * {piece_points} + 1 AS start", "_piece", f"(_total - 1) div {piece_points} AS _last",
        "transform(_rows, r -> struct(r.lat AS lat, r.lon AS lon)) AS _points",
    )
    firsts = seq.where("_seq = 1").select(
        *[F.col(k).alias(f"_of_{k}") for k in key], F.struct("lat", "lon").alias("_first"), *style
    )
    return pieces.join(firsts, F.expr(" AND ".join(f"{k} <=> _of_{k}" for k in key))).drop(*[f"_of_{k}" for k in key])


def sample_density(
    samples: DataFrame, step: float, lat0: float = 0.0, lon0: float = 0.0, threshold: int = 1
) -> DataFrame:
    """Samples per grid cell of ``step`` degrees; cells below ``threshold`` are left out."""
    cells = samples.groupBy(
        F.floor((F.col("lat") - lat0) / step).alias("lat_cell"),
        F.floor((F.col("lon") - lon0) / step).alias("lon_cell"),
    ).agg(F.count("*").alias("samples"))
    return cells.where(F.col("samples") >= threshold)


def heatmap_layer(
    density: DataFrame,
    threshold: int = HEAT_THRESHOLD,
    radius: int = HEAT_RADIUS,
    opacity: float = HEAT_OPACITY,
    dissipating: bool = True,
    gradient: list[tuple[int, int, int, int]] | None = None,
) -> DataFrame:
    """Density cells with the display settings of a heat map."""
    colors = [F.lit("rgba(%d, %d, %d, %d)" % stop) for stop in gradient or []]
    return density.withColumns({
        "threshold": F.lit(threshold),
        "radius": F.lit(radius),
        "opacity": F.lit(opacity),
        "dissipating": F.lit(dissipating),
        "gradient": F.array(*colors).cast("array<string>"),
    })


def grid_lines(specs: DataFrame) -> DataFrame:
    """Grid lines for each row of ``lat_min, lat_max, lat_step, lon_min, lon_max, lon_step``.

    An axis has as many lines as whole steps fit between its bounds; all lines
    are moved by half a step on both axes. The black line colour is added.
    """
    def numbers(axis):
        count = f"cast(({axis}_max - {axis}_min) / {axis}_step AS bigint)"
        return f"if({count} > 0, sequence(0L, {count} - 1L), cast(array() AS array<bigint>))"

    def lines(axis):
        ends = {name: (f"{name}_min + {name}_step / 2", f"{name}_max + {name}_step / 2") for name in ("lat", "lon")}
        ends[axis] = (f"{axis}_min + i * {axis}_step + {axis}_step / 2",) * 2
        fields = [f"{text} AS {name}_{end}" for name, pair in ends.items() for end, text in zip(("from", "to"), pair)]
        return f"transform({numbers(axis)}, i -> struct('{axis}' AS axis, i AS line, {', '.join(fields)}))"

    keep = [c for c in specs.columns if not c.startswith(("lat_", "lon_"))]
    return specs.selectExpr(*keep, f"inline(concat({lines('lat')}, {lines('lon')}))").select(
        "*", F.lit("#000000").alias("color")
    )
