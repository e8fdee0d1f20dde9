"""Geographic operators: nearest reference point and pairs within a radius."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.geo import EARTH_RADIUS_KM, haversine_km, unit_vector
from martkit.operators.joins import split_hot_join
from martkit.session import settle

# A degree of latitude is slightly more than this, so bands never come out too narrow.
_KM_PER_DEGREE = 111.0
_HALF_CIRCUMFERENCE_KM = math.pi * EARTH_RADIUS_KM


def _band(lat: Column, km: float) -> Column:
    return F.floor((lat + 90) * (_KM_PER_DEGREE / km)).cast("int")


def _cells_in_band(band: Column, km: float) -> Column:
    """Cells around one band, wide enough for its neighbour bands as well."""
    height = km / _KM_PER_DEGREE
    low = F.abs((band - 1) * F.lit(height) - 90)
    high = F.abs((band + 2) * F.lit(height) - 90)
    widest = F.least(F.greatest(low, high), F.lit(90.0))
    cells = F.floor(F.lit(360 * _KM_PER_DEGREE / km) * F.cos(F.radians(widest)))
    return F.greatest(F.lit(1), cells.cast("int"))


def _column_in_band(lon: Column, cells: Column) -> Column:
    turned = F.pmod(lon + 180, F.lit(360.0)) / 360
    return F.least(F.floor(turned * cells).cast("int"), cells - 1)


def with_own_cell(df: DataFrame, lat: str, lon: str, km: float) -> DataFrame:
    """Add the grid cell (``_band``, ``_column``) of a point, on a grid made for ``km``."""
    return df.withColumn("_band", _band(F.col(lat), km)).withColumn(
        "_column", _column_in_band(F.col(lon), _cells_in_band(F.col("_band"), km))
    )


def with_near_cells(df: DataFrame, lat: str, lon: str, km: float) -> DataFrame:
    """One row per cell that can hold a point within ``km``, across date line and poles.

    At most nine: three bands, and in each the point's column and its
    neighbours. A band of one or two cells has fewer neighbours.
    """
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    step, cells = F.col("_step"), F.col("_cells")
    distinct = (step == 0) | (cells >= 3) | ((cells == 2) & (step == 1))
    return (
        df.withColumn("_near", F.explode(steps))
        .withColumn("_band", _band(F.col(lat), km) + F.col("_near"))
        .withColumn("_cells", _cells_in_band(F.col("_band"), km))
        .withColumn("_middle", _column_in_band(F.col(lon), cells))
        .withColumn("_step", F.explode(steps))
        .where(distinct)
        .withColumn("_column", F.pmod(F.col("_middle") + step, cells))
        .drop("_near", "_cells", "_middle", "_step")
    )


def _on_globe(lat: Column, lon: Column) -> Column:
    """Latitude from -90 to 90 and a finite longitude; false for null and NaN."""
    lat, lon = lat.cast("double"), lon.cast("double")
    return F.coalesce(lat.between(-90, 90) & (F.abs(lon) < F.lit(float("inf"))), F.lit(False))


def nearest_point(
    events: DataFrame,
    places: DataFrame,
    event_id: str,
    place_id: str,
    lat: str = "lat",
    lon: str = "lon",
    place_lat: str = "lat",
    place_lon: str = "lon",
    keep: Sequence[str] = (),
    max_packed: int = 1000,
    grid_km: float = 25.0,
) -> DataFrame:
    """Add the nearest place (its id, the ``keep`` columns, ``distance_km``) to each event.

    Events without valid coordinates (latitude from -90 to 90, finite longitude)
    get nulls, places without them are left out. The smallest id wins a tie. Up to
    ``max_packed`` places (checked by a count that stops there) are laid over a
    fixed raster, and events look up the few candidates of their raster cell:
    they are neither shuffled nor multiplied. More places go through a grid
    join. ``event_id`` must be unique.
    """
    x, y, z = unit_vector(F.col(place_lat).cast("double"), F.col(place_lon).cast("double"))
    points = places.where(_on_globe(F.col(place_lat), F.col(place_lon))).select(
        F.col(place_id).alias("_id"),
        x.alias("_x"),
        y.alias("_y"),
        z.alias("_z"),
        F.col(place_lat).cast("double").alias("_plat"),
        F.col(place_lon).cast("double").alias("_plon"),
        F.struct(F.col(place_id), *[F.col(c) for c in keep]).alias("_info"),
    )
    if points.limit(max_packed + 1).count() <= max_packed:
        found = _nearest_by_raster(events, points, lat, lon)
    else:
        found = _nearest_by_grid(events, points, event_id, lat, lon, grid_km)
    best = F.col("_best")
    return found.select(
        *events.columns,
        best["info"][place_id].alias(place_id),
        *[best["info"][c].alias(c) for c in keep],
        haversine_km(F.col(lat), F.col(lon), best["plat"], best["plon"]).alias("distance_km"),
    )


_RASTER_DEGREES = 4
_RASTER_COLUMNS = 360 // _RASTER_DEGREES
_RASTER_ROWS = 180 // _RASTER_DEGREES
# no point of a raster cell is farther than this from the cell's centre, on the unit sphere
_RASTER_RADIUS = math.radians(_RASTER_DEGREES / math.sqrt(2)) * 1.001


def _chord(at: tuple[Column, Column, Column], place: Column) -> Column:
    x, y, z = (at[i] - place[name] for i, name in enumerate(("_x", "_y", "_z")))
    return x * x + y * y + z * z


def _nearest_by_raster(events: DataFrame, points: DataFrame, lat: str, lon: str) -> DataFrame:
    """Candidates per raster cell, then the nearest of them per event.

    By the triangle inequality a place can be nearest to some point of a cell
    only if its distance from the centre exceeds the least such distance by at
    most two cell radii. The candidate table has a fixed number of rows (4,050)
    and at most ``max_packed`` small integers in each, about 16 MB at the very
    most, so it is broadcast.
    """
    packed = points.agg(F.array_sort(F.collect_list(F.struct(*points.columns)))).scalar()
    half = _RASTER_DEGREES / 2
    centre = unit_vector(
        F.floor(F.col("_cell") / _RASTER_COLUMNS) * _RASTER_DEGREES - 90 + half,
        F.col("_cell") % _RASTER_COLUMNS * _RASTER_DEGREES - 180 + half,
    )
    names = ("_cx", "_cy", "_cz")
    at_centre = tuple(F.col(n) for n in names)
    reach = F.array_min("_far") + 2 * _RASTER_RADIUS
    cells = (
        events.sparkSession.range(_RASTER_ROWS * _RASTER_COLUMNS)
        .select(F.col("id").cast("int").alias("_cell"), packed.alias("_all"))
        .select("_cell", "_all", *[c.alias(n) for c, n in zip(centre, names)])
        .select("_cell", F.transform("_all", lambda p: F.sqrt(_chord(at_centre, p))).alias("_far"))
        .select(
            "_cell",
            F.filter(
                F.sequence(F.lit(0), F.size("_far") - 1),
                lambda i: F.get("_far", i) <= reach,
            ).alias("_candidates"),
        )
    )
    row = F.least(F.floor((F.col(lat) + 90) / _RASTER_DEGREES), F.lit(_RASTER_ROWS - 1))
    column = F.floor(F.pmod(F.col(lon) + 180, F.lit(360.0)) / _RASTER_DEGREES)
    at = (F.col("_ex"), F.col("_ey"), F.col("_ez"))

    def scored(i: Column) -> Column:
        place = F.get("_all", i)
        return F.struct(_chord(at, place).alias("chord"), place["_id"].alias("id"), i.alias("i"))

    nearest = F.array_min(F.transform("_candidates", scored))["i"]
    chosen = F.get("_all", F.col("_nearest"))
    return (
        events.withColumn("_cell", F.when(_on_globe(F.col(lat), F.col(lon)), (row * _RASTER_COLUMNS + column).cast("int")))
        .join(F.broadcast(cells), "_cell", "left")
        .withColumns(
            {
                "_all": packed,
                **dict(zip(("_ex", "_ey", "_ez"), unit_vector(F.col(lat), F.col(lon)))),
            }
        )
        .withColumn("_nearest", nearest)
        .withColumn(
            "_best",
            F.when(
                F.col("_nearest").isNotNull(),
                F.struct(
                    chosen["_plat"].alias("plat"),
                    chosen["_plon"].alias("plon"),
                    chosen["_info"].alias("info"),
                ),
            ),
        )
        .drop("_cell", "_candidates", "_all", "_ex", "_ey", "_ez", "_nearest")
    )


def _nearest_by_grid(
    events: DataFrame, points: DataFrame, event_id: str, lat: str, lon: str, km: float
) -> DataFrame:
    """Search ever coarser grids; a match no farther than the cell size is final."""
    open_events = events.where(_on_globe(F.col(lat), F.col(lon))).select(
        F.col(event_id).alias("_event"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon")
    )
    chord = _chord(
        unit_vector(F.col("_lat"), F.col("_lon")), F.struct("_x", "_y", "_z")
    )
    candidate = F.struct(
        chord.alias("chord"),
        F.col("_id").alias("id"),
        F.col("_plat").alias("plat"),
        F.col("_plon").alias("plon"),
        F.col("_info").alias("info"),
    )
    found = None
    while True:
        cells = with_near_cells(points, "_plat", "_plon", km)
        matched = (
            with_own_cell(open_events, "_lat", "_lon", km)
            .join(cells, ["_band", "_column"], "left")
            .groupBy("_event", "_lat", "_lon")
            .agg(F.min(F.when(F.col("_id").isNotNull(), candidate)).alias("_best"))
        )
        distance = haversine_km(
            F.col("_lat"), F.col("_lon"), F.col("_best.plat"), F.col("_best.plon")
        )
        final = F.coalesce(distance <= F.lit(km), F.lit(False))
        if km > _HALF_CIRCUMFERENCE_KM:
            final = F.lit(True)
        tried = settle(matched.withColumn("_final", final))
        done = tried.where("_final").select("_event", "_best")
        found = done if found is None else found.unionByName(done)
        open_events = tried.where(~F.col("_final")).select("_event", "_lat", "_lon")
        if open_events.isEmpty():
            break
        km *= 4
    return events.join(found, F.col(event_id) == F.col("_event"), "left").drop("_event")


def pairs_within_km(
    points: DataFrame,
    id_col: str,
    km: float = 1.0,
    lat: str = "lat",
    lon: str = "lon",
    share: str | None = None,
    block_rows: int = 4000,
) -> DataFrame:
    """Unordered pairs (id_left < id_right) at most ``km`` apart, with ``distance_km``.

    With ``share`` the two rows must also agree on that column, which then
    takes part in the join key. An equi-join on grid cells; crowded cells are
    cut into blocks, and only true pairs leave the join.
    """
    usable = points.where(
        F.col(id_col).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()
    )
    keys = ["_band", "_column", *([share] if share else [])]

    def side(name: str) -> DataFrame:
        return usable.select(
            F.col(id_col).alias(f"id_{name}"),
            F.col(lat).cast("double").alias(f"_lat_{name}"),
            F.col(lon).cast("double").alias(f"_lon_{name}"),
            *([share] if share else []),
        )

    left = with_near_cells(side("left"), "_lat_left", "_lon_left", km)
    right = with_own_cell(side("right"), "_lat_right", "_lon_right", km)
    distance = haversine_km(
        F.col("_lat_left"), F.col("_lon_left"), F.col("_lat_right"), F.col("_lon_right")
    )
    pairs = split_hot_join(
        left,
        right,
        keys,
        (F.col("id_left") < F.col("id_right")) & (distance <= km),
        "id_left",
        "id_right",
        block_rows,
    )
    return pairs.select(
        "id_left", "id_right", *([share] if share else []), distance.alias("distance_km")
    )
