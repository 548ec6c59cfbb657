"""Distance bands and the first rows of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tripline.sources.schemas import FEATURES, LABEL

# Fixed values: (band, low, high) in miles, closed at both ends, so a distance
# on a shared edge belongs to two bands.
BANDS = [(1, 3.0, 4.0), (2, 4.0, 5.0), (3, 5.0, 6.0), (4, 6.0, 10.0)]
MAX_SAMPLE_ERROR = 1.5
PER_BAND = 5


def assign_bands(df: DataFrame, column: str = "trip_distance",
                 bands: list[tuple[int, float, float]] = BANDS) -> DataFrame:
    """One row per row and matching band, for a short list of bands.

    A generator, not a join: one pass, no nested loop, inside generated code.
    """
    value = F.col(column)
    near = value.between(min(low for _, low, _ in bands), max(high for _, _, high in bands))
    hits = F.array(*[F.when(value.between(low, high), F.lit(band)) for band, low, high in bands])
    return df.filter(near).select("*", F.explode(hits).alias("band")).filter("band is not null")


def band_join(df: DataFrame, bands: DataFrame, column: str = "trip_distance",
              cells: int = 256) -> DataFrame:
    """Join to a table ``(band, lo, hi)`` where ``column`` lies in [lo, hi].

    The range condition rides on an equality over cells, so any number of bands
    joins by hash or sort-merge and never by nested loop. The cells divide the
    span of all finite ends, and one on each side holds all beyond: a band
    lists at most ``cells`` + 3 of them, however wide or open it is. A row has
    one cell, so no pair repeats.
    """
    finite = [F.when(F.abs(c) < float("inf"), F.col(c)) for c in ("lo", "hi")]
    ends = bands.agg(F.least(*map(F.min, finite)).alias("low"),
                     F.greatest(*map(F.max, finite)).alias("high")).first()  # two numbers
    low = ends["low"] if ends["low"] is not None else 0.0
    width = ((ends["high"] - low) / cells if ends["high"] is not None else 0.0) or 1.0

    def cell(value: Column) -> Column:
        place = F.floor((value - low) / width)
        return F.when(~F.isnan(value), F.when(place < 0, -1).when(place > cells, cells + 1)
                      .otherwise(place.cast("int")))

    listed = bands.select("*", F.explode(F.sequence(
        cell(F.col("lo").cast("double")), cell(F.col("hi").cast("double")))).alias("__cell"))
    return (
        df.withColumn("__cell", cell(F.col(column).cast("double"))).join(listed, "__cell")
        .filter(F.col(column).between(F.col("lo"), F.col("hi"))).drop("__cell")
    )


def first_per_group(df: DataFrame, group: str, order: list[str], n: int,
                    rank: str = "rn") -> DataFrame:
    """The first ``n`` rows per group. Catalyst turns the rank filter into a
    window group limit: each task passes on at most n rows per group, so a
    group of any size is cut before the shuffle. ``session.pin`` lifts the
    limit beyond which Catalyst would not do so.
    """
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def first_rows(df: DataFrame, order: list[str], n: int, buckets: int = 256) -> DataFrame:
    """The first ``n`` rows by ``order``, for a small n over any number of partitions.

    A plain top-n brings n rows of every partition into one task. Here the
    partitions meet in ``buckets`` first, and each bucket passes on n rows. How
    rows fall into buckets has no say in the result.
    """
    bucketed = df.withColumn("__bucket", F.spark_partition_id() % buckets)
    return (first_per_group(bucketed, "__bucket", order, n, "__rank")
            .drop("__bucket", "__rank").orderBy(*order).limit(n))


def banded_samples(errors: DataFrame, key: str, per_band: int = PER_BAND,
                   max_error: float = MAX_SAMPLE_ERROR,
                   bands: list[tuple[int, float, float]] = BANDS) -> DataFrame:
    """Well-predicted trips, ``per_band`` per distance band, in one pass.

    ``errors`` carries ``abs_error`` (see ``evaluate.with_abs_error``).
    """
    good = errors.filter(F.col("abs_error") < max_error)
    picked = first_per_group(assign_bands(good, bands=bands), "band",
                             ["trip_distance", key], per_band)
    return picked.select("band", "rn", key, *FEATURES, F.round(LABEL, 2).alias(LABEL))


def banded_samples_union(errors: DataFrame, key: str, per_band: int = PER_BAND,
                         max_error: float = MAX_SAMPLE_ERROR,
                         bands: list[tuple[int, float, float]] = BANDS) -> DataFrame:
    """The rows of all bands as one table without ranks: the union of a top-k per
    band, in one scan."""
    return banded_samples(errors, key, per_band, max_error, bands).drop("rn")


def numbered(rows: DataFrame, order: list[str], index: str = "idx") -> DataFrame:
    """Number already limited rows from 1. The window runs in one task, so only
    the outcome of a limit or top-k belongs here."""
    return rows.withColumn(index, F.row_number().over(Window.orderBy(*order)))
