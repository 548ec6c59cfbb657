"""Zone polygons as vertex rows: edges, centroids, reprojection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tripline.functions.geo import NY_LONG_ISLAND_FEET, LambertConic, conic_to_lonlat
from tripline.sources.session import settle

RING = ["LocationID", "part_id", "ring_id"]
# Fixed value: the ring of a part that is its shell; all others are holes.
SHELL = 1
BLOCK = 4096
EDGE_BLOCK = 1 << 13


def _levels(vertices: DataFrame, block: int) -> int:
    """Rounds until the numbers of one ring fall into two blocks, on each side of 0."""
    if block < 2:
        raise ValueError(f"block must be 2 or more, not {block}")
    top = vertices.agg(F.max(F.abs("seq")).alias("top")).first()["top"] or 0
    levels = 0
    while top:
        top, levels = top // block, levels + 1
    return max(1, levels)


def _block_of(seq: str, block: int) -> Column:
    """seq / block, rounded down for negative numbers too."""
    return F.expr(f"({seq} - pmod({seq}, {int(block)}L)) div {int(block)}L")


def _edge(x: Column, y: Column, x1: Column, y1: Column, ox: Column, oy: Column) -> list[Column]:
    """Twice the signed area under an edge seen from (ox, oy), and its moments."""
    u, v, u1, v1 = x - ox, y - oy, x1 - ox, y1 - oy
    cross = u * v1 - u1 * v
    return [cross, (u + u1) * cross, (v + v1) * cross]


def ring_edges(vertices: DataFrame, block: int = EDGE_BLOCK) -> DataFrame:
    """Each vertex with the next one of its ring (``x1``, ``y1``); the last
    connects to the first.

    A window over whole rings would put a huge ring into one task. Here vertices
    are sorted by ring and ``seq`` over the cluster and cut into shares of ``block``
    rows, and the window runs within a ring's part of a share, so a ring may hold
    any part of all vertices and ``seq`` may have gaps of any size. Behind the
    last vertex of a part comes the first one of the ring's next part; only these
    first vertices, a row a part, meet by ring. Two shuffles of vertices in all.
    """
    order = [*RING, "seq"]
    spread = vertices.select(*order, "x", "y").repartitionByRange(*order).sortWithinPartitions(
        *order).withColumn("__part", F.expr(f"monotonically_increasing_id() div {int(block)}L"))
    dealt = settle(spread, "ring-vertices")
    share = [*RING, "__part"]
    within = Window.partitionBy(*share).orderBy("seq")
    rows = dealt.withColumns({"x1": F.lead("x").over(within), "y1": F.lead("y").over(within),
                              "__last": F.lead("seq").over(within).isNull()})
    along = Window.partitionBy(*RING).orderBy("__part")
    heads = dealt.groupBy(*share).agg(F.min(F.struct("seq", "x", "y")).alias("head")).select(
        *share, *(F.coalesce(F.lead(f"head.{c}").over(along), F.first(f"head.{c}").over(
            along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias(f"__{c}")
            for c in "xy"))
    return rows.join(heads, share).select(*order, "x", "y", *(
        F.when(F.col("__last"), F.col(f"__{c}")).otherwise(F.col(f"{c}1")).alias(f"{c}1") for c in "xy"))


def _fold(pieces: DataFrame, *group: str) -> DataFrame:
    """Neighbouring pieces of a ring joined into one per ``group``.

    A piece runs from (fx, fy) to (lx, ly); ``cross``, ``mx`` and ``my`` are
    those of the piece closed on itself, seen from its first vertex. Seen from
    the first vertex of the joined piece, what a piece adds is its own, moved,
    the chord that closed it, and the link to the next piece.
    """
    along = Window.partitionBy(*RING, *group).orderBy("pos")
    o = [F.first("fx").over(along), F.first("fy").over(along)]
    ahead = [F.lead("fx").over(along), F.lead("fy").over(along)]
    rows = pieces.withColumns({"ox": o[0], "oy": o[1], "nx": ahead[0], "ny": ahead[1]})
    c = F.col
    chord = _edge(c("fx"), c("fy"), c("lx"), c("ly"), c("ox"), c("oy"))
    link = [F.coalesce(e, F.lit(0.0))  # the last piece has no next one
            for e in _edge(c("lx"), c("ly"), c("nx"), c("ny"), c("ox"), c("oy"))]
    moved = [c("cross"), c("mx") + 3 * (c("fx") - c("ox")) * c("cross"),
             c("my") + 3 * (c("fy") - c("oy")) * c("cross")]
    rows = rows.select(*RING, *group, "pos", "ox", "oy", "lx", "ly", *(
        (a + b + d).alias(name)
        for a, b, d, name in zip(moved, chord, link, ("cross", "mx", "my"), strict=True)))
    return rows.groupBy(*RING, *group).agg(
        *(F.sum(name).alias(name) for name in ("cross", "mx", "my")),
        F.first("ox").alias("fx"), F.first("oy").alias("fy"),
        F.max_by("lx", "pos").alias("lx"), F.max_by("ly", "pos").alias("ly"))


def polygon_centroids(vertices: DataFrame, block: int = BLOCK) -> DataFrame:
    """Area-weighted planar centroid and area per LocationID.

    Shells add up and holes subtract, by ``ring_id`` and whatever way a ring is
    wound. Each vertex is a piece of its ring; pieces of ``block`` consecutive
    numbers fold into one, and the rest again, until a ring is one piece. So
    vertices shuffle once, no window holds more than a block, and sums relative
    to a piece's first vertex keep digits when a polygon is small and far from
    the origin.
    """
    zero = F.lit(0.0)
    pieces = vertices.select(
        *RING, F.col("seq").alias("pos"), zero.alias("cross"), zero.alias("mx"), zero.alias("my"),
        F.col("x").alias("fx"), F.col("y").alias("fy"), F.col("x").alias("lx"),
        F.col("y").alias("ly"))
    for _ in range(_levels(vertices, block)):
        cut = pieces.withColumn("__block", _block_of("pos", block))
        pieces = _fold(cut, "__block").withColumnRenamed("__block", "pos")
    rings = _fold(pieces)
    sign = F.signum("cross") * F.when(F.col("ring_id") == SHELL, 1).otherwise(-1)
    sums = rings.withColumn("sign", sign).groupBy("LocationID").agg(
        F.sum(F.col("cross") * F.col("sign")).alias("twice_area"),
        *(F.sum((F.col(f"m{c}") + 3 * F.col(f"f{c}") * F.col("cross")) * F.col("sign"))
          .alias(f"m{c}") for c in "xy"))
    return sums.select(
        "LocationID",
        F.try_divide("mx", F.col("twice_area") * 3).alias("longitude"),
        F.try_divide("my", F.col("twice_area") * 3).alias("latitude"),
        F.abs(F.col("twice_area") / 2).alias("area"),
    )


def project_vertices(vertices: DataFrame,
                     system: LambertConic = NY_LONG_ISLAND_FEET) -> DataFrame:
    """Replace projected ``x, y`` by longitude and latitude in degrees."""
    lon, lat = conic_to_lonlat(F.col("x"), F.col("y"), system)
    return vertices.withColumns({"x": lon, "y": lat})


def zone_table(vertices: DataFrame, names: DataFrame,
               system: LambertConic = NY_LONG_ISLAND_FEET) -> DataFrame:
    """The zone dimension from projected polygons and ``LocationID, zone, borough``."""
    centers = polygon_centroids(project_vertices(vertices, system))
    return names.join(centers, "LocationID").select(
        "LocationID", "zone", "borough", "longitude", "latitude")
