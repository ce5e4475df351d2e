"""Style of map shapes: aliases, defaults and colours."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.functions.colors import resolve_colors

# Setting -> (names that may give it, first one wins; default).
STYLE_RULES = {
    "edge_color": (["color", "c", "edge_color", "ec"], "#000000"),
    "edge_alpha": (["alpha", "edge_alpha", "ea"], 1.0),
    "edge_width": (["edge_width", "ew"], 1.0),
    "face_alpha": (["alpha", "face_alpha", "fa"], 0.3),
    "face_color": (["color", "c", "face_color", "fc"], "#000000"),
    "color": (["color", "c", "edge_color", "ec"], "#000000"),
}
CIRCLE_FACE_ALPHA = 0.5


def _first_given(df: DataFrame, names: list[str], default) -> Column:
    """First column that is present, not null and not empty or 0."""
    empty = F.lit("") if isinstance(default, str) else F.lit(0)
    given = [F.nullif(F.col(n), empty) for n in names if n in df.columns]
    return F.coalesce(*given, F.lit(default))


def resolve_style(df: DataFrame, circle: bool = False) -> DataFrame:
    """Replace the style columns a table has by the six settings of a shape.

    Zero counts as not given, also for an alpha. A circle without a face alpha is
    filled with 0.5 instead of 0.3, and one without a face colour in black: ``fc`` is
    not looked at.
    """
    if circle:
        defaults = {"face_alpha": CIRCLE_FACE_ALPHA, "face_color": "#000000"}
        for name, value in defaults.items():
            given = F.col(name) if name in df.columns else F.lit(None)
            df = df.withColumn(name, F.coalesce(given, F.lit(value)))
    used = {n for names, _ in STYLE_RULES.values() for n in names}
    styled = df.select(
        *[c for c in df.columns if c not in used],
        *[_first_given(df, *rule).alias(setting) for setting, rule in STYLE_RULES.items()],
    )
    return resolve_colors(styled, *[s for s in STYLE_RULES if s.endswith("color")])
