"""Geometry: rings, grid cells, bounding boxes, and signals from measures.

Points are (lng, lat) in degrees on a sphere.  Candidates meet by grid cells and bounding boxes in DataFrame joins;
exact measures of shapes are in shapes.py, nearest features in nearest.py.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.operators.delta import first_wins

#: Metres of a degree, earth's radius, the cell's side in degrees, search radius, and the access limit.
DEGREE_M, EARTH_M, CELL, RADIUS_M, LANDLOCKED_M = 111_320.0, 6_371_008.8, 0.1, 500.0, 400.0
#: The study area as least and greatest longitude and latitude.
ENVELOPE = (-85.8, 33.9, -77.9, 39.6)


# -- column expressions ----------------------------------------------------------------------------------------------

def cell_key(lng: Column, lat: Column, per_degree: int = 10) -> Column:
    """The grid cell of a point, as "lng,lat" of its lower left corner."""
    return F.format_string("%.1f,%.1f", F.floor(lng * per_degree) / per_degree, F.floor(lat * per_degree) / per_degree)


def cells_of(minx: Column, miny: Column, maxx: Column, maxy: Column, per_degree: int = 10) -> Column:
    """All cells that a box touches, as structs of whole numbers."""
    at = lambda x: F.floor(x * per_degree)
    return F.flatten(F.transform(F.sequence(at(minx), at(maxx)), lambda x: F.transform(F.sequence(at(miny), at(maxy)), lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def expanded(box: tuple[Column, Column, Column, Column], metres: float) -> tuple[Column, Column, Column, Column]:
    """A box grown by so many metres."""
    x0, y0, x1, y1 = box
    dy = F.lit(metres / DEGREE_M)
    dx = metres / (DEGREE_M * F.greatest(F.lit(0.1), F.cos(F.radians((y0 + y1) / 2))))
    return x0 - dx, y0 - dy, x1 + dx, y1 + dy


def quarters(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    mx, my = (x0 + x1) / 2, (y0 + y1) / 2
    box = lambda a, b, c, d: F.struct(a.alias("minx"), b.alias("miny"), c.alias("maxx"), d.alias("maxy"))
    return F.array(box(x0, y0, mx, my), box(mx, y0, x1, my), box(x0, my, mx, y1), box(mx, my, x1, y1))


def overlap(a: str, b: str) -> Column:
    """Whether two boxes (structs minx, miny, maxx, maxy) meet."""
    c = F.col
    return (c(f"{a}.minx") <= c(f"{b}.maxx")) & (c(f"{b}.minx") <= c(f"{a}.maxx")) & (c(f"{a}.miny") <= c(f"{b}.maxy")) & (c(f"{b}.miny") <= c(f"{a}.maxy"))


def inside(lng: Column, lat: Column, envelope: tuple = ENVELOPE) -> Column:
    return lng.between(envelope[0], envelope[2]) & lat.between(envelope[1], envelope[3])


def haversine(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def signed_area(ring: Column) -> Column:
    """Shoelace area of a ring, an array of [x, y]: negative if clockwise."""
    n = F.size(ring)
    terms = F.transform(ring, lambda p, i: p[0] * F.element_at(ring, (i + 1) % n + 1)[1] - F.element_at(ring, (i + 1) % n + 1)[0] * p[1])
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) / 2


def multipolygon(rings: Column) -> Column:
    """Rings (of [x, y]) as polygons, each an array of rings with the outer one first.

    The first and every clockwise ring is an outer one, others are holes of the last outer one; open rings are closed and
    those under four points dropped; null rings give null.
    """
    closed = F.transform(rings, lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), r).otherwise(F.concat(r, F.slice(r, 1, 1))))
    none = F.expr("cast(array() as array<array<array<array<double>>>>)")

    def put(parts: Column, ring: Column) -> Column:
        last = F.size(parts) - 1
        with_hole = F.concat(F.slice(parts, F.lit(1), F.greatest(last, F.lit(0))), F.array(F.concat(F.get(parts, last), F.array(ring))))
        return F.when((last < 0) | (signed_area(ring) < 0), F.concat(parts, F.array(F.array(ring)))).otherwise(with_hole)

    return F.aggregate(F.filter(closed, lambda r: F.size(r) >= 4), none, put)


def vertex_mean(ring: Column) -> Column:
    s = F.aggregate(ring, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), lambda a, p: F.struct((a["x"] + p[0]).alias("x"), (a["y"] + p[1]).alias("y")))
    return F.struct(F.try_divide(s["x"], F.size(ring)).alias("lng"), F.try_divide(s["y"], F.size(ring)).alias("lat"))


def sample_points(x0: Column, y0: Column, x1: Column, y1: Column, inset: float = 0.2) -> Column:
    """The centre and four points set in from the corners, as (at, lng, lat)."""
    dx, dy = (x1 - x0) * inset, (y1 - y0) * inset
    p = lambda i, x, y: F.struct(F.lit(i).alias("at"), x.alias("lng"), y.alias("lat"))
    return F.array(p(0, (x0 + x1) / 2, (y0 + y1) / 2), p(1, x0 + dx, y0 + dy), p(2, x1 - dx, y0 + dy), p(3, x0 + dx, y1 - dy), p(4, x1 - dx, y1 - dy))


def point_key(lng: Column, lat: Column) -> Column:
    return F.format_string("%.5f,%.5f", lng, lat)


# -- features ---------------------------------------------------------------------------------------------------------

def geometry_hash(rings: Column) -> Column:
    return F.substring(F.sha2(F.to_json(rings), 256), 1, 32)


def deduplicated(features: DataFrame, key: str = "feature_id", rings: str = "rings", order: str = "ordinal") -> DataFrame:
    """Features, each once: by id or, where there is none, by the hash of its geometry; the first by `order` stays."""
    own = F.coalesce(F.concat(F.lit("id:"), F.col(key).cast("string")), F.concat(F.lit("hash:"), geometry_hash(F.col(rings))))
    return first_wins(features.withColumn("__own", own), ["__own"], [order]).drop("__own")


# -- signals ---------------------------------------------------------------------------------------------------------

def water_signal(measured: DataFrame, covered: DataFrame, by: str = "left_id") -> DataFrame:
    """covered (left_id, has_coverage; where equal shapes are measured once, `by`, the left_id of the measures) with frontage by regime, least distances and named waters, rounded to 0.1.

    measured: left_id, kind (flowline, waterbody, area), ftype, regime, perennial, name, inside_m, overlap_m2, distance_m.
    Only watercourses (ftype 460) have frontage, and only at distance 0; a cell without any feature is no measurement.
    """
    from landrank.functions.measured import js_round
    from landrank.functions.text import WATERCOURSE

    stream = (F.col("kind") == "flowline") & (F.col("ftype") == WATERCOURSE)
    touching = stream & (F.col("distance_m") == 0)
    body = F.col("kind").isin("waterbody", "area")
    g = measured.groupBy(F.col("left_id").alias(by)).agg(
        F.sum(F.when(touching, F.col("inside_m"))).alias("frontage_m"),
        *[F.sum(F.when(touching & (F.col("regime") == r), F.col("inside_m"))).alias(f"frontage_{r}_m") for r in ("perennial", "intermittent", "ephemeral", "unspecified")],
        F.min(F.when(stream, F.col("distance_m"))).alias("flowline_m"), F.min(F.when(body, F.col("distance_m"))).alias("waterbody_m"),
        F.sum(F.when(body, F.col("overlap_m2"))).alias("overlap_m2"), F.bool_or((F.col("kind") == "waterbody") & F.col("perennial") & (F.col("overlap_m2") > 0)).alias("has_pond"),
        F.bool_or((F.col("kind") == "area") & (F.col("ftype") == WATERCOURSE) & (F.col("overlap_m2") > 0)).alias("has_river"),
        F.sort_array(F.collect_set(F.when(F.col("distance_m") == 0, F.col("name")))).alias("named_waters"))
    out = covered.join(g, by, "left")
    number = [c for c in g.columns if c.endswith(("_m", "_m2"))]
    out = out.withColumns({c: F.when(F.col("has_coverage"), js_round(F.col(c), 1)) for c in number})
    return out.withColumn("unknown_reason", F.when(~F.col("has_coverage"), "nhd_no_coverage_in_cell"))


def flood_signal(zones: DataFrame, parcels: DataFrame, by: str = "left_id") -> DataFrame:
    """parcels (left_id, area_m2, coverage; where equal shapes are measured once, `by`, the left_id of the zones) with the share in special hazard areas and the dominant zone (X if none).

    Coverage that is unknown or absent is unknown; zones: left_id, ordinal, zone, overlap_m2.  Of zones that cover equally
    much, to a square millimetre, the first is dominant.
    """
    from landrank.functions.measured import js_round
    from landrank.functions.text import sfha

    g = zones.groupBy(F.col("left_id").alias(by)).agg(F.sum(F.when(sfha(F.col("zone")), F.col("overlap_m2"))).alias("sfha_m2"), F.max_by("zone", F.struct(F.round("overlap_m2", 6), -F.col("ordinal"))).alias("dominant"))
    out = parcels.join(g, by, "left")
    ok = F.col("coverage") == "present"
    return out.select("left_id", F.when(ok, F.coalesce("dominant", F.lit("X"))).alias("zone"), F.when(ok, js_round(F.least(F.lit(100.0), F.coalesce(F.try_divide(
        F.coalesce("sfha_m2", F.lit(0.0)), "area_m2") * 100, F.lit(0.0))), 1)).alias("sfha_pct"), F.when(~F.coalesce(ok, F.lit(False)), "no-coverage").alias("unknown_reason"))


def slope_signal(samples: DataFrame, key: str) -> DataFrame:
    """samples (key, lng, lat, elevation, lng0, lat0, elevation0) to mean and greatest slope from the centre, in %."""
    from landrank.functions.measured import js_round

    run = haversine(F.col("lng0"), F.col("lat0"), F.col("lng"), F.col("lat"))
    slope = F.when(run >= 1, F.abs(F.col("elevation") - F.col("elevation0")) / run * 100)
    g = samples.withColumn("slope", slope).groupBy(key).agg(F.avg("slope").alias("mean"), F.max("slope").alias("most"), F.count("slope").alias("n"),
                                                              (F.max("elevation") - F.min("elevation")).alias("range_m"))
    few = F.col("n") < 1
    return g.select(key, *[F.when(~few, js_round(F.col(c), 1)).alias(f"slope_{c}") for c in ("mean", "most")], js_round(F.col("range_m"), 1).alias("range_m"),
                    F.when(few, "too-few-samples").alias("unknown_reason"))


def road_signal(distance: Column, healthy: Column, radius: float = RADIUS_M) -> Column:
    """distance, landlocked and unknown_reason; no road within a radius under LANDLOCKED_M says nothing."""
    reason = F.when(~F.coalesce(healthy, F.lit(False)), "unhealthy").when(distance.isNull() & F.lit(radius < LANDLOCKED_M), "radius-too-small")
    return F.struct(F.when(reason.isNull(), distance).alias("road_m"), F.when(reason.isNull(), F.coalesce(distance > LANDLOCKED_M, F.lit(True))).alias("landlocked"), reason.alias("unknown_reason"))
