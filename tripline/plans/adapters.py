"""Trip-shaped views of the test tables. Each is a narrow projection."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.sources.schemas import RINGS, TABLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def trips_from_events(events: DataFrame) -> DataFrame:
    """Raw trips with outliers, gaps, edge distances and unknown zones."""
    seconds = ("floor(value * 12) + (event_id * 37) % 600 - 60"
               " + CASE WHEN event_id % 50 = 0 THEN 10000 ELSE 0 END")
    return events.selectExpr(
        "event_id AS trip_id",
        "ts AS tpep_pickup_datetime",
        f"ts + make_dt_interval(0, 0, 0, CAST({seconds} AS decimal(18,6))) AS tpep_dropoff_datetime",
        """CASE WHEN event_id % 61 = 0 THEN 0.0D
                WHEN event_id % 89 = 0 THEN 150.0D
                WHEN event_id % 83 = 0 THEN 4.0D
                ELSE value / 5.0D END AS trip_distance""",
        """CASE WHEN event_id % 97 = 0 THEN NULL
                WHEN event_id % 23 = 0 THEN 264
                ELSE CAST((user_id * 7) % 265 + 1 AS int) END AS PULocationID""",
        """CASE WHEN event_id % 101 = 0 THEN NULL
                WHEN event_id % 29 = 0 THEN 265
                ELSE CAST((event_id * 13) % 265 + 1 AS int) END AS DOLocationID""",
    )


def trips_from_orders(orders: DataFrame) -> DataFrame:
    """Trips over 80 months, in the layout of a published month."""
    return orders.selectExpr(
        "o_orderdate AS tpep_pickup_datetime",
        "o_orderdate + make_dt_interval(0, 0, 0, CAST(o_orderkey * 37 % 7500 AS decimal(18,6)))"
        " AS tpep_dropoff_datetime",
        "o_totalprice / 4000.0D AS trip_distance",
        "o_custkey % 265 + 1 AS PULocationID",
        "o_orderkey % 265 + 1 AS DOLocationID",
    )


def requests_from_events(events: DataFrame) -> DataFrame:
    """Prediction requests as text, some of them invalid."""
    return events.selectExpr(
        "event_id AS trip_id",
        """CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 'abc'
                ELSE CAST(value AS string) END AS trip_distance""",
        "CAST((user_id * 7) % 265 + 1 AS string) AS PULocationID",
        """CASE WHEN event_id % 53 = 0 THEN ''
                ELSE CAST((event_id * 13) % 265 + 1 AS string) END AS DOLocationID""",
        """CASE WHEN event_id % 43 = 0 THEN '24'
                ELSE CAST(hour(ts) AS string) END AS pickup_hour""",
        """CASE WHEN event_id % 47 = 0 THEN '0'
                ELSE CAST(dayofweek(ts) AS string) END AS pickup_dow""",
    )


def zones(spark: SparkSession) -> DataFrame:
    """The zone dimension: ids 1 to 263; 264 and 265 stay unknown."""
    return spark.range(1, 264).selectExpr(
        "CAST(id AS int) AS LocationID",
        "concat('Zone_', CAST(id AS string)) AS zone",
        "concat('Borough_', CAST(id % 6 AS string)) AS borough",
        "-74.23D + (id * 37 % 263) * 0.002D AS longitude",
        "40.53D + (id * 91 % 263) * 0.0014D AS latitude",
    )


def zone_feed(spark: SparkSession) -> DataFrame:
    """The zone dimension as it grew: every fifth zone was recorded wrongly at first.
    ``record`` numbers the records."""
    late = zones(spark).withColumn("record", F.col("LocationID").cast("long") + 1000)
    early = zones(spark).filter("LocationID % 5 = 0").withColumns({
        "zone": F.concat(F.lit("Old_"), "zone"), "latitude": F.lit(0.0),
        "record": F.col("LocationID").cast("long")})
    return early.unionByName(late)


def zone_records(events: DataFrame) -> DataFrame:
    """A feed of zone coordinates in which ids repeat; later records win."""
    return events.selectExpr(
        "event_id AS record_id",
        "CAST((user_id * 7) % 265 + 1 AS int) AS LocationID",
        "round(40.53D + value * 0.001D, 6) AS latitude",
        "round(-74.23D + (event_id % 263) * 0.002D, 6) AS longitude",
    )


# Two squares, the first with a hole; closed rings of (part, ring, seq, x, y).
# Centroid (74.5/19, 34.5/19), area 19.
SHAPE = [
    (1, 1, 0, 0.0, 0.0), (1, 1, 1, 4.0, 0.0), (1, 1, 2, 4.0, 4.0), (1, 1, 3, 0.0, 4.0),
    (1, 1, 4, 0.0, 0.0),
    (1, 2, 0, 1.0, 1.0), (1, 2, 1, 1.0, 2.0), (1, 2, 2, 2.0, 2.0), (1, 2, 3, 2.0, 1.0),
    (1, 2, 4, 1.0, 1.0),
    (2, 1, 0, 10.0, 0.0), (2, 1, 1, 12.0, 0.0), (2, 1, 2, 12.0, 2.0), (2, 1, 3, 10.0, 2.0),
    (2, 1, 4, 10.0, 0.0),
]


def rings_from_customers(customers: DataFrame) -> DataFrame:
    """One shape per customer, moved by (k, 2k) with k = key modulo 100. Holes are
    wound like their shell for every third customer, and second parts the other
    way for every fourth."""
    corners = F.array(*[
        F.struct(F.lit(part).alias("part_id"), F.lit(ring).alias("ring_id"),
                 F.lit(seq).cast("bigint").alias("seq"), F.lit(x).alias("x"), F.lit(y).alias("y"))
        for part, ring, seq, x, y in SHAPE])
    shift = F.col("c_custkey") % 100
    return (customers.select(F.col("c_custkey").cast("int").alias("LocationID"),
                             shift.alias("k"), F.explode(corners).alias("v"))
            .select("LocationID", "v.part_id", "v.ring_id", "v.seq",
                    (F.col("v.x") + F.col("k")).alias("x"),
                    (F.col("v.y") + F.col("k") * 2).alias("y"))
            .withColumn("seq", F.when(
                ((F.col("ring_id") == 2) & (F.col("LocationID") % 3 == 0))
                | ((F.col("part_id") == 2) & (F.col("LocationID") % 4 == 0)), 4 - F.col("seq"))
                .otherwise(F.col("seq"))))


def projected_rings_from_customers(customers: DataFrame) -> DataFrame:
    """The same shapes as zone polygons in projected feet."""
    return rings_from_customers(customers).withColumns({
        "x": F.col("x") * 1000 + 930000.0, "y": F.col("y") * 500 + 130000.0})


def zone_names_from_customers(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(
        "CAST(c_custkey AS int) AS LocationID",
        "concat('Zone_', CAST(c_custkey AS string)) AS zone",
        "concat('Borough_', CAST(c_custkey % 6 AS string)) AS borough")


def rings_from_events(events: DataFrame) -> DataFrame:
    """One open ring per zone with a vertex per event; zone 1 has a third of all."""
    turn = ("(unix_timestamp(ts) - unix_timestamp(TIMESTAMP_NTZ'2024-01-01 00:00:00'))"
            f" / 2678400.0D * {2 * math.pi!r}D")
    return events.selectExpr(
        "CASE WHEN event_id % 3 = 0 THEN 1 ELSE CAST(user_id % 250 + 2 AS int) END AS LocationID",
        "1 AS part_id", "1 AS ring_id", "event_id AS seq",
        f"(1 + value / 100.0D) * cos({turn}) AS x",
        f"(1 + value / 100.0D) * sin({turn}) AS y",
    ).select(*RINGS.fieldNames())


# Two public systems as well-known text, the zone polygons' own (two
# parallels, US feet) and one with a single parallel, in metres.
PROJECTIONS = {
    "two": 'PROJCS["NAD_1983_StatePlane_New_York_Long_Island_FIPS_3104_Feet",'
           'GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983",'
           'SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],'
           'UNIT["Degree",0.0174532925199433]],PROJECTION["Lambert_Conformal_Conic"],'
           'PARAMETER["False_Easting",984250.0],PARAMETER["False_Northing",0.0],'
           'PARAMETER["Central_Meridian",-74.0],PARAMETER["Standard_Parallel_1",41.0333333333333],'
           'PARAMETER["Standard_Parallel_2",40.6666666666667],'
           'PARAMETER["Latitude_Of_Origin",40.1666666666667],'
           'UNIT["US survey foot",0.304800609601219]]',
    "one": """PROJCS["JAD2001 / Jamaica Metric Grid",
    GEOGCS["JAD2001", DATUM["Jamaica_2001", SPHEROID["WGS 84", 6378137, 298.257223563,
            AUTHORITY["EPSG", "7030"]]],
        PRIMEM["Greenwich", 0], UNIT["degree", 0.0174532925199433]],
    PROJECTION["Lambert_Conformal_Conic_1SP"],
    PARAMETER["latitude_of_origin", 18], PARAMETER["central_meridian", -77],
    PARAMETER["scale_factor", 1], PARAMETER["false_easting", 750000],
    PARAMETER["false_northing", 650000], UNIT["metre", 1], AUTHORITY["EPSG", "3448"]]""",
}


def vertices_from_events(events: DataFrame) -> DataFrame:
    """Vertices in projected feet, spread over the zones' extent."""
    return events.selectExpr(
        "event_id AS seq",
        "913000.0D + (event_id * 7919) % 160000 + value AS x",
        "120000.0D + (event_id * 104729) % 160000 + value AS y",
    )


def closed_form(trips: DataFrame) -> DataFrame:
    """A predictor any engine can repeat: distance + 4 minutes."""
    return trips.withColumn("prediction", F.col("trip_distance") + 4)
