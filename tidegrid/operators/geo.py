"""Places from coordinates: geocode lookup, point in polygon, completeness of place tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import location_key, percent, simpler_key
from ..session import small_side


def zones_from_shapes(shapes: DataFrame, lookup: DataFrame) -> DataFrame:
    """Outlines with the names and groups of the place table."""
    return shapes.join(lookup, "pu_location_id", "left")


def outline_index(zones: DataFrame, cell_degrees: float = 0.02) -> DataFrame:
    """Place outlines by the square cells their bounding boxes touch.

    ``zones`` has ``pu_location_id`` and ``ring`` (array of x, y structs, first point repeated last).
    One row per cell with the outlines to try there.
    """
    def low(axis: str) -> Column:
        return F.array_min(F.transform("ring", lambda p: p[axis]))

    def high(axis: str) -> Column:
        return F.array_max(F.transform("ring", lambda p: p[axis]))

    def cells(axis: str) -> Column:
        return F.sequence(F.floor(low(axis) / cell_degrees), F.floor(high(axis) / cell_degrees))

    return (
        zones.select("pu_location_id", "ring", F.explode(cells("x")).alias("_cx"), cells("y").alias("_ys"))
        .select("pu_location_id", "ring", "_cx", F.explode("_ys").alias("_cy"))
        .groupBy("_cx", "_cy")
        .agg(F.collect_list(F.struct("pu_location_id", "ring")).alias("_outlines"))
    )


def inside_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd test: an odd number of edges lies to the right of the point."""

    def crossing(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        spans = (a["y"] > y) != (b["y"] > y)
        at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        return F.when(spans & (x < at), 1).otherwise(0)

    edges = F.sequence(F.lit(1), F.size(ring) - 1)
    return F.aggregate(edges, F.lit(0), lambda total, i: total + crossing(i)) % 2 == 1


def locate_points(
    points: DataFrame, zones: DataFrame, x: str = "lon", y: str = "lat", cell_degrees: float = 0.02
) -> DataFrame:
    """``pu_location_id`` for each point, NULL outside all outlines, smallest id on overlap.

    An equi-join on the cell brings each point its few candidate outlines in one array, so a point is
    one row before and after: no pair table, and no grouping to undo it.
    """
    index = small_side(outline_index(zones, cell_degrees), limit=50_000)
    celled = points.withColumns(
        {"_cx": F.floor(F.col(x) / cell_degrees), "_cy": F.floor(F.col(y) / cell_degrees)}
    )
    hits = F.filter("_outlines", lambda o: inside_ring(o["ring"], F.col(x), F.col(y)))
    return (
        celled.join(index, ["_cx", "_cy"], "left")
        .withColumn("pu_location_id", F.array_min(F.transform(hits, lambda o: o["pu_location_id"])))
        .select(*points.columns, "pu_location_id")
    )


def locate_geocodes(geocodes: DataFrame, zones: DataFrame, cell_degrees: float = 0.02) -> DataFrame:
    """Places of the distinct looked-up locations; events then need only a key join."""
    return locate_points(geocodes, zones, "lon", "lat", cell_degrees)


def assign_places(events: DataFrame, located: DataFrame) -> DataFrame:
    """Coordinates and place per event, by location key and group (no group counts as "")."""
    keyed = events.withColumns(
        {
            "location_key": location_key(F.col("event_location")),
            "_group": F.coalesce("event_borough", F.lit("")),
        }
    )
    side = located.select(
        "location_key",
        F.coalesce("borough", F.lit("")).alias("_group"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "pu_location_id",
    )
    return keyed.join(side, ["location_key", "_group"], "left").drop("_group")


def keys_to_retry(geocodes: DataFrame) -> DataFrame:
    """Keys that were looked up without success and have a simpler spelling to try."""
    return (
        geocodes.where(F.col("lat").isNull())
        .withColumn("simpler_key", simpler_key(F.col("location_key")))
        .where(F.col("simpler_key").isNotNull())
        .select("location_key", "borough", "simpler_key")
    )


def geocode_coverage(events: DataFrame) -> DataFrame:
    """Distinct keys, events with and without a place, share with one (2 digits)."""
    n = F.count(F.lit(1))
    placed = F.count("pu_location_id")
    keys = F.count_distinct(
        F.when((F.col("location_key") != "") & F.col("event_borough").isNotNull(),
               F.struct("location_key", "event_borough"))
    )
    return events.agg(
        keys.alias("unique_location_keys"),
        placed.alias("events_geocoded"),
        (n - placed).alias("events_not_geocoded"),
        percent(placed, n, 2).alias("pct_geocoded"),
    )


def complete_by_place(zones: DataFrame, measures: DataFrame, value: str) -> DataFrame:
    """A measure for every place; a place without one is an error, not a zero."""
    joined = zones.join(measures, "pu_location_id", "left")
    problem = F.concat(
        F.lit(f"no {value} for place "), F.coalesce(F.col("pu_location_id").cast("string"), F.lit("?"))
    )
    checked = F.when(F.col(value).isNotNull(), F.col(value)).otherwise(
        F.raise_error(problem).cast(measures.schema[value].dataType)
    )
    return joined.withColumn(value, checked)
