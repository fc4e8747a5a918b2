"""Geo operators: centroid lookup, nearest-centroid join, demand grid, map
aggregates.

Nearest centroid against a constant zone list is a pure projection (the zone
coordinates are literals), so it needs neither a join nor a shuffle. For a
zone *table* of any size, ``nearest_centroid_join`` buckets both sides into
grid cells of the search radius and joins on the cell: each point meets only
the zones of its 3x3 cell neighbourhood.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridewise import constants as K
from ridewise.functions.exprs import round_half_up
from ridewise.functions.rules import demand_score
from ridewise.session import cut_lineage
from ridewise.sources.tables import BROADCAST_LIMIT_BYTES, estimated_bytes, maybe_broadcast


def _dist(lat: Column, lon: Column, zlat: float | Column, zlon: float | Column) -> Column:
    dlat = lat - (zlat if isinstance(zlat, Column) else F.lit(zlat))
    dlon = lon - (zlon if isinstance(zlon, Column) else F.lit(zlon))
    return F.sqrt(dlat * dlat + dlon * dlon)


def nearest_centroid(lat: str, lon: str, zones=K.ZONES) -> Column:
    """D7 (constant zones): struct(dist, zone_idx) of the nearest centroid.

    Euclidean distance in degrees; equal distances go to the earlier zone,
    as a strict ``<`` scan does.
    """
    cands = [F.struct(_dist(F.col(lat), F.col(lon), z[1], z[2]).alias("dist"), F.lit(i).alias("zone_idx"))
             for i, z in enumerate(zones)]
    return F.array_min(F.array(*cands))


def assign_zone(df: DataFrame, lat: str, lon: str, max_dist: float | None = K.GRID_MAX_DIST,
                zones=K.ZONES, prefix: str = "nearest") -> DataFrame:
    """D7 + D6: nearest zone name, index and distance; drop points beyond
    ``max_dist``."""
    n = nearest_centroid(lat, lon, zones)
    names = F.array(*[F.lit(z[0]) for z in zones])
    out = (df.withColumn("__n", n)
             .withColumn(f"{prefix}_dist", F.col("__n.dist"))
             .withColumn(f"{prefix}_idx", F.col("__n.zone_idx"))
             .withColumn(f"{prefix}_zone", F.element_at(names, F.col("__n.zone_idx") + 1))
             .drop("__n"))
    if max_dist is not None:
        out = out.where(F.col(f"{prefix}_dist") <= max_dist)
    return out


def nearest_centroid_join(points: DataFrame, zones: DataFrame, point_id: str, lat: str, lon: str,
                          max_dist: float, zone_id: str = "zone_idx") -> DataFrame:
    """D7 (zone table of any size): cell-bucketed equi-join, one row a point.

    Each zone is replicated into the 3x3 cells around its own cell (cell size
    = ``max_dist``), so every zone within ``max_dist`` of a point shares the
    point's cell. A cell is one row with the list of its zones, so a point
    meets one row, its min is taken there, and points are neither multiplied nor
    grouped; with few zones they are not shuffled at all. Points without an id
    are dropped.
    """
    cell = F.lit(float(max_dist))
    z = (zones.withColumn("__cx", F.floor(F.col("lat") / cell)).withColumn("__cy", F.floor(F.col("lon") / cell))
              .withColumn("__d", F.explode(F.array(*[F.array(F.lit(a), F.lit(b))
                                                     for a in (-1, 0, 1) for b in (-1, 0, 1)])))
              .select(zone_id, F.col("lat").alias("__zlat"), F.col("lon").alias("__zlon"),
                      (F.col("__cx") + F.col("__d")[0]).alias("__cx"), (F.col("__cy") + F.col("__d")[1]).alias("__cy")))
    cells = z.groupBy("__cx", "__cy").agg(F.collect_list(F.struct("__zlat", "__zlon", F.col(zone_id).alias("zone"))).alias("__zones"))
    if estimated_bytes(cells) > BROADCAST_LIMIT_BYTES:
        cells = cut_lineage(cells, "zone-cells")                 # a plain exchange, which adaptive execution can split
    p = points.where(F.col(point_id).isNotNull()).withColumn("__cx", F.floor(F.col(lat) / cell)).withColumn("__cy", F.floor(F.col(lon) / cell))
    dists = F.transform("__zones", lambda z: F.struct(_dist(F.col(lat), F.col(lon), z["__zlat"], z["__zlon"]).alias("dist"), z["zone"].alias("zone")))
    j = p.join(maybe_broadcast(cells), ["__cx", "__cy"]).withColumn("__b", F.array_min(F.filter(dists, lambda x: x["dist"] <= max_dist)))
    return j.where(F.col("__b").isNotNull()).select(*points.columns, F.col("__b.dist").alias("nearest_dist"),
                                                    F.col("__b.zone").alias("nearest_zone"))


def grid_axis_size(start: float, stop: float, step: float) -> int:
    """Number of points of an arange(start, stop, step)."""
    return int(math.ceil((stop - start) / step))


def demand_grid_points(spark: SparkSession) -> DataFrame:
    """Lat x lon x hours, coordinates from integer indices (no drift)."""
    n_lat = grid_axis_size(K.GRID_LAT_START, K.GRID_LAT_STOP, K.GRID_RESOLUTION)
    n_lon = grid_axis_size(K.GRID_LON_START, K.GRID_LON_STOP, K.GRID_RESOLUTION)
    lat = spark.range(n_lat).select((F.lit(K.GRID_LAT_START) + F.col("id") * F.lit(K.GRID_RESOLUTION)).alias("lat"))
    lon = spark.range(n_lon).select((F.lit(K.GRID_LON_START) + F.col("id") * F.lit(K.GRID_RESOLUTION)).alias("lon"))
    hours = spark.createDataFrame([(h,) for h in K.GRID_HOURS], "hour int")
    return lat.crossJoin(lon).crossJoin(F.broadcast(hours))


def grid_demand(spark: SparkSession, days: DataFrame, factors: DataFrame | None = None,
                month: int = K.GRID_SCENARIO_MONTH) -> DataFrame:
    """Demand over the grid for each scenario day, decayed with distance
    from the nearest centroid; points beyond 0.06 degrees are dropped.

    ``days`` holds the scenario dates (one row per calendar day, so it is
    bounded by the calendar), scored as days of ``month`` (December); ``factors`` the (date, zone, event_factor)
    calendar. The lattice is generated by ``spark.range`` (distributed) and
    the day table is broadcast into it.
    """
    g = assign_zone(demand_grid_points(spark), "lat", "lon", K.GRID_MAX_DIST)
    g = g.crossJoin(F.broadcast(days.select("date").distinct()))
    if factors is not None:
        f = factors.select("date", F.col("zone").alias("nearest_zone"), "event_factor")
        g = g.join(F.broadcast(f), ["date", "nearest_zone"], "left")
    else:
        g = g.withColumn("event_factor", F.lit(1.0))
    nl = F.element_at(F.array(*[F.lit(z[4]) for z in K.ZONES]), F.col("nearest_idx") + 1)
    tr = F.element_at(F.array(*[F.lit(z[5]) for z in K.ZONES]), F.col("nearest_idx") + 1)
    ds = demand_score(F.col("hour"), F.weekday("date"), F.lit(month), nl, tr, F.col("event_factor"))
    decay = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("nearest_dist") / F.lit(K.GRID_DECAY_DIST))
    return g.select("date", round_half_up(F.col("lat"), 4).alias("lat"), round_half_up(F.col("lon"), 4).alias("lon"),
                    "hour", round_half_up(ds * decay, 3).alias("demand"),
                    F.col("nearest_zone").alias("neighborhood"))


def zone_volume(df: DataFrame, zone: str, value: str) -> DataFrame:
    """Trips and mean value per zone; marker radius 10 + 35*trips/max.
    The max is a one-row aggregate of the (small) per-zone table."""
    s = (df.where(F.col(zone).isNotNull()).groupBy(zone)
           .agg(F.count(F.lit(1)).alias("trips"), F.avg(value).alias("avg_value")))
    m = s.agg(F.max("trips").alias("__max"))
    return (s.crossJoin(F.broadcast(m)).withColumn("radius", F.lit(10.0) + F.lit(35.0) * F.col("trips") / F.col("__max"))
              .drop("__max"))


def zone_means(df: DataFrame, zones: DataFrame, zone: str, value: str) -> DataFrame:
    """Mean per zone of the zone list; a zone without rows gets null."""
    s = df.where(F.col(zone).isNotNull()).groupBy(zone).agg(F.avg(value).alias("avg_value"))
    return zones.join(s, zone, "left")


def map_frames(grid: DataFrame, hour: str = "hour", weight: str = "demand", threshold: float = 0.05) -> DataFrame:
    """One frame per distinct hour: the sorted (lat, lon, weight) points
    above the threshold. An hour whose points are all below keeps an empty
    frame. Frame size is bounded by the grid, not by the data."""
    pts = F.struct(F.col("lat"), F.col("lon"), F.col(weight).alias("weight"))
    keys = [c for c in ("date",) if c in grid.columns] + [hour]
    f = grid.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col(weight) > threshold, pts))).alias("points"))
    return f.withColumn("label", F.format_string("%02d:00", F.col(hour)))


def heat_cells(df: DataFrame, lat: str, lon: str, weight: str, res: float = K.GRID_RESOLUTION) -> DataFrame:
    """E21 at scale: pickups binned into cells, weights summed per cell."""
    cx = F.floor(F.col(lat) / F.lit(res))
    cy = F.floor(F.col(lon) / F.lit(res))
    return (df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
              .groupBy(cx.alias("cell_x"), cy.alias("cell_y"))
              .agg(F.count(F.lit(1)).alias("points"), F.sum(weight).alias("weight")))


def scenario_grid(spark: SparkSession, zone_names: list[str], dow: int, month: int) -> DataFrame:
    """24 hours x zones for one scenario day (tiny, generated)."""
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    z = spark.createDataFrame([(n,) for n in zone_names], "neighborhood string")
    return (hours.crossJoin(F.broadcast(z))
                 .withColumn("day_of_week", F.lit(dow)).withColumn("month", F.lit(month))
                 .withColumn("is_weekend", (F.col("day_of_week") >= 5).cast("int")))
