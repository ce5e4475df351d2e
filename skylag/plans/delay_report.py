"""The delay analysis from samples and airports to statistics, tracks and layers."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.operators import delays, layers, scope, tracks
from skylag.plans import report
from skylag.sources.stored import StoredTables

# Default airport and the most airports of a request.
DEFAULT_AIRPORTS = ("LAX",)
MAX_AIRPORTS = 2
# Fixed value: zoom of the map.
ZOOM = 8


@dataclass
class DelayReport:
    """DataFrames of one analysis; each is built when asked for.

    The first that needs ordered tracks stores them (two readings of the samples); from
    then on statistics, lines and layers are read from that table. ``close``, or the end
    of a ``with`` block, drops it.
    """

    area: DataFrame
    scoped: DataFrame
    heavy_samples: int = tracks.HEAVY_SAMPLES

    def __post_init__(self):
        self.tables = StoredTables(self.scoped.sparkSession)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()

    def close(self) -> None:
        self.tables.drop()

    @cached_property
    def center(self) -> DataFrame:
        return scope.area_center(self.area)

    @cached_property
    def view(self) -> DataFrame:
        """Where the map opens: the centre of the area, and the zoom."""
        return self.center.withColumn("zoom", F.lit(ZOOM))

    @cached_property
    def delays(self) -> DataFrame:
        """The tracks hold all samples of the delayed flights, so both sources give the same."""
        return delays.flight_delay(self.__dict__.get("tracks", self.scoped))

    @cached_property
    def summary(self) -> DataFrame:
        return delays.delay_summary(self.delays)

    @cached_property
    def tracks(self) -> DataFrame:
        return tracks.store_tracks(self.scoped, self.tables, self.heavy_samples)

    @cached_property
    def paths(self) -> DataFrame:
        return tracks.flight_tracks(self.tracks)

    @cached_property
    def lines(self) -> DataFrame:
        stored = self.tracks
        return report.report_lines(self.summary, stored)

    @cached_property
    def numbered_lines(self) -> DataFrame:
        stored = self.tracks
        return report.numbered_report_lines(self.summary, stored, self.tables)

    @cached_property
    def layers(self) -> dict[str, DataFrame]:
        return {
            "boundary": layers.area_boundary(self.area),
            "segments": layers.segment_layer(tracks.track_segments(self.tracks)),
            "markers": layers.point_layer(layers.late_marker(tracks.track_ends(self.tracks))),
            "paths": layers.track_geojson(self.tracks),
        }


def request_airports(codes: Sequence[str]) -> list[str]:
    """The codes of a request, or the default. More than two are an error: an analysis of
    fewer airports than asked would look complete."""
    codes = list(dict.fromkeys(codes)) or list(DEFAULT_AIRPORTS)
    if len(codes) > MAX_AIRPORTS:
        raise ValueError(f"at most {MAX_AIRPORTS} airports, not {', '.join(codes)}")
    return codes


def delay_report(
    samples: DataFrame,
    airports: DataFrame,
    codes: Sequence[str] = DEFAULT_AIRPORTS,
    margin: float = scope.MARGIN_DEG,
    status: str | None = None,
    heavy_samples: int = tracks.HEAVY_SAMPLES,
) -> DelayReport:
    """Delays of flights to one airport or between two.

    ``samples`` come from a reader, already pruned by its date specification. The
    bounds are known when the plan is built, so area, route and status filters
    are pushed to the scan.
    """
    codes = request_airports(codes)
    area = scope.checked_area(airports, codes)
    scoped = scope.scope_samples(samples, area, codes, margin, status)
    return DelayReport(scope.airport_area(airports, codes), scoped, heavy_samples)


def write_delay_report(result: DelayReport, path: str, mode: str = "error") -> None:
    """Write the report text, the statistics and the layers under ``path``: Parquet
    tables, and one GeoJSON feature per text line for the paths.

    All outputs read the stored tracks, which are dropped at the end; nothing is kept in
    memory or on local disks.
    """
    with result:
        result.tracks
        result.view.write.mode(mode).parquet(f"{path}/view")
        result.delays.write.mode(mode).parquet(f"{path}/flight_delay")
        result.summary.write.mode(mode).parquet(f"{path}/delay_summary")
        report.write_report(result.numbered_lines, f"{path}/delay_text", mode)
        for name, layer in result.layers.items():
            if "geojson" in layer.columns:
                layer.select("geojson").write.mode(mode).text(f"{path}/layers/{name}")
            else:
                layer.write.mode(mode).parquet(f"{path}/layers/{name}")
