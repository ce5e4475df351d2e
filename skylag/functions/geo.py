"""Geometry expressions, as SQL text."""

# Sphere radius in km, and the step in degrees between circle vertices.
EARTH_RADIUS_KM = 6378.8
CIRCLE_STEP_DEG = 10


def circle_vertex(lat: str, lon: str, radius_m: str, bearing: str) -> tuple[str, str]:
    """Point at ``radius_m`` metres from (lat, lon) on the sphere, west of north
    by ``bearing`` degrees; the longitude lies in [-180, 180).

    Constants are double literals; decimal ones would be cut to a few digits.
    """
    arc = f"({radius_m} / 1000D / {EARTH_RADIUS_KM}D)"
    phi, turn = f"radians({lat})", f"radians({bearing})"
    phi2 = f"asin(sin({phi}) * cos({arc}) + cos({phi}) * sin({arc}) * cos({turn}))"
    shift = f"atan2(sin({turn}) * sin({arc}) * cos({phi}), cos({arc}) - sin({phi}) * sin({phi2}))"
    lam2 = f"pmod(radians({lon}) - {shift} + pi(), 2D * pi()) - pi()"
    return f"degrees({phi2})", f"degrees({lam2})"


def round6(x: str) -> str:
    """Six decimals, with minus zero turned into zero."""
    return f"round({x}, 6) + 0D"
