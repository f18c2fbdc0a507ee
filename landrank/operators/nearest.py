"""Nearest features by a packed tree over counts, with DataFrame operations only.

Features lie in the order of a quadtree's cells; eight in a row are a leaf, sixteen nodes in a row a node above, each with
the box of what it holds.  So cells are as small as places are dense, and as large as they are empty.  Points lie in the
same order, eight to a group; groups go down the tree together and keep only nodes that can hold a nearest feature.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landrank.operators.geometry import haversine
from landrank.session import checkpointed

#: Rows of a leaf and nodes of a node above, as powers of two; nodes of a level that may be broadcast whole (some 100 bytes each).
LEAF_BITS, FAN_BITS, BROADCAST = 3, 4, 20_000
#: A node is hot if over one in HOT_SHARE of all pairs are at it, so there are fewer than HOT_SHARE hot ones.
HOT_SHARE = 1000
#: monotonically_increasing_id() has the partition above so many bits.
PART_BITS = 33
_BOX = ("x0", "y0", "x1", "y1")


def morton(lng: Column, lat: Column) -> Column:
    """The place of a point in the order of quadtree cells: bits of longitude and latitude in turn, 31 of each."""
    def spread(x: Column, low: float, wide: float) -> Column:
        v = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / wide)) * float((1 << 31) - 1)).cast("long")
        steps = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))
        return reduce(lambda a, s: a.bitwiseOR(F.shiftleft(a, s[0])).bitwiseAND(F.lit(s[1])), steps, v)

    return spread(lng, -180.0, 360.0).bitwiseOR(F.shiftleft(spread(lat, -90.0, 180.0), 1))


def placed(rows: DataFrame) -> DataFrame:
    """rows (id, lng, lat) in Morton order, numbered by `at`; partitions are ranges, and rows at one place can be in several."""
    by = rows.select("*", morton(F.col("lng"), F.col("lat")).alias("z"), F.monotonically_increasing_id().alias("tie"))
    by = by.repartitionByRange("z", "tie").sortWithinPartitions("z", "tie").drop("z", "tie")
    return checkpointed(by.withColumn("at", F.monotonically_increasing_id()))


def boxes(rows: DataFrame, bits: int) -> DataFrame:
    """Nodes (node, box) of numbered rows, 2^bits numbers each."""
    return rows.groupBy(F.shiftright("at", bits).alias("node")).agg(F.min("lng").alias("x0"), F.min("lat").alias("y0"), F.max("lng").alias("x1"), F.max("lat").alias("y1"))


def levels(most: int, parts: int) -> list[int]:
    """Bits of the tree's levels, from its root down to its leaves: numbers go up to `most` in a partition, of parts + 1."""
    out, bits = [LEAF_BITS], LEAF_BITS + FAN_BITS
    while most >> bits:
        out.append(bits)
        bits += FAN_BITS
    bits = PART_BITS
    while True:
        out.append(bits)
        if not parts >> (bits - PART_BITS):
            return out[::-1]
        bits += FAN_BITS


def half_chord(degrees: Column) -> Column:
    return F.pow(F.sin(F.radians(degrees) / 2), 2)


def bounds(a: str, b: str) -> tuple[Column, Column]:
    """Least and greatest haversine (before the root) of points in two boxes, columns with these prefixes.

    Boxes are no more than 360 degrees wide together, so half a difference of longitudes is in 0 to 180 degrees.
    """
    c = lambda p, k: F.col(f"{p}{k}")
    gap = lambda low, high: F.greatest(F.lit(0.0), c(b, low) - c(a, high), c(a, low) - c(b, high))
    far = lambda low, high: F.greatest(c(b, high) - c(a, low), c(a, high) - c(b, low))
    near_x, far_x, near_y, far_y = gap("x0", "x1"), far("x0", "x1"), gap("y0", "y1"), far("y0", "y1")
    cos = lambda p, k: F.cos(F.radians(c(p, k)))
    least = lambda p: F.least(cos(p, "y0"), cos(p, "y1"))
    most = lambda p: F.when((c(p, "y0") <= 0) & (c(p, "y1") >= 0), 1.0).otherwise(F.greatest(cos(p, "y0"), cos(p, "y1")))
    turn = (near_x <= 180) & (far_x >= 180)
    low = half_chord(near_y) + least(a) * least(b) * F.least(half_chord(near_x), half_chord(far_x))
    high = half_chord(far_y) + most(a) * most(b) * F.when(turn, 1.0).otherwise(F.greatest(half_chord(near_x), half_chord(far_x)))
    return low, high


def below(pairs: DataFrame, children: DataFrame, n_children: int, broadcast: int) -> DataFrame:
    """pairs (node, ...) joined with the children (node, ...) of their nodes.

    Few children are broadcast.  Of many, those of hot nodes are, fewer than HOT_SHARE times the fan; the others are joined
    by a shuffle in which no key has a large share.
    """
    if n_children <= broadcast:
        return pairs.join(F.broadcast(children), "node")
    counts = pairs.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    total = pairs.count()
    hot = checkpointed(counts.filter(F.col("n") * HOT_SHARE > total).select("node"))
    few = F.broadcast(hot)
    cold = pairs.join(few, "node", "left_anti").join(children, "node")
    return cold.unionByName(pairs.join(few, "node").join(F.broadcast(children.join(few, "node")), "node"))


def met(points: DataFrame, features: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """Points (id, lng, lat) with each feature (id, lng, lat, places told apart) that may be their nearest.

    (at, point_id, feature_id, metres), `at` numbering points.  A group of points keeps a node if its least distance is
    within the least, over all nodes, of the greatest distance that a feature there can have; of leaves, so does a point.
    """
    p, f = placed(points), placed(features)
    groups = boxes(p, LEAF_BITS).select(F.col("node").alias("grp"), *[F.col(c).alias(f"p{c}") for c in _BOX])
    most, parts = f.agg(F.max(F.col("at").bitwiseAND((1 << PART_BITS) - 1)), F.max(F.shiftright("at", PART_BITS))).first()
    bits = levels(most, parts)
    size = lambda b: (parts + 1) * ((most >> b) + 1) if b < PART_BITS else (parts >> (b - PART_BITS)) + 1
    ends, leaves, pairs = [f"f{c}" for c in _BOX], checkpointed(boxes(f, LEAF_BITS)), groups.withColumn("node", F.lit(0).cast("long"))

    def kept(found: DataFrame, by: str) -> DataFrame:
        low, high = bounds("p", "f")
        found = found.withColumns({"low": low, "high": high}).withColumn("best", F.min("high").over(Window.partitionBy(by)))
        return found.filter(F.col("low") <= F.col("best") * (1 + 1e-9) + 1e-18)

    # pairs are used once where nodes are broadcast, and then need not be kept
    kept_for = lambda d, b: d if size(b) <= broadcast else checkpointed(d)
    for up, down in zip(bits, bits[1:]):
        nodes = leaves.groupBy(F.shiftright("node", down - LEAF_BITS).alias("node")).agg(*[(F.min if c in ("x0", "y0") else F.max)(c).alias(c) for c in _BOX])
        children = nodes.select(F.shiftright("node", up - down).alias("node"), F.col("node").alias("child"), *[F.col(c).alias(f"f{c}") for c in _BOX])
        found = kept(below(kept_for(pairs.drop(*ends), down), children, size(down), broadcast), "grp")
        pairs = found.select("grp", *[f"p{c}" for c in _BOX], F.col("child").alias("node"), *ends)
    mine = p.select("at", F.shiftright("at", LEAF_BITS).alias("grp"), F.col("id").alias("point_id"), *[F.col(c).alias(f"p{k}") for k, c in zip(_BOX, ("lng", "lat", "lng", "lat"), strict=True)])
    each = kept(mine.join(pairs.select("grp", "node", *ends), "grp"), "at").select("at", "point_id", F.col("px0").alias("lng"), F.col("py0").alias("lat"), "node")
    there = f.select(F.shiftright("at", LEAF_BITS).alias("node"), F.col("id").alias("feature_id"), F.col("lng").alias("u"), F.col("lat").alias("v"))
    each = below(kept_for(each, 0), there, size(0), broadcast)
    return each.select("at", "point_id", "feature_id", haversine(F.col("lng"), F.col("lat"), F.col("u"), F.col("v")).alias("metres"))


def nearest_points(points: DataFrame, features: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """For each point (id, lng, lat) the nearest feature (id, lng, lat): point_id, feature_id, metres.

    Features at one place count as one, the least id.  Ties go to the least feature_id; points without coordinates, or
    all where there is no feature, get null; a point that repeats gets a row each time.
    """
    known = "lng is not null and lat is not null and not isnan(lng) and not isnan(lat)"
    none = [F.lit(None).cast(features.schema["id"].dataType).alias("feature_id"), F.lit(None).cast("double").alias("metres")]
    there = checkpointed(features.filter(known).groupBy("lng", "lat").agg(F.min("id").alias("id")))
    if there.isEmpty():
        return points.select(F.col("id").alias("point_id"), *none)
    here = points.select("id", "lng", "lat").withColumn("known", F.expr(f"coalesce({known}, false)"))
    best = met(here.filter("known").drop("known"), there, broadcast).groupBy("at").agg(F.first("point_id").alias("point_id"), F.min(F.struct("metres", "feature_id")).alias("b"))
    return best.select("point_id", "b.feature_id", "b.metres").unionByName(here.filter("not known").select(F.col("id").alias("point_id"), *none))
