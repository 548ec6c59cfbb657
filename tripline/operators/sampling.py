"""Repeatable samples and splits, by key hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window

from tripline.functions.keys import key_hash, percentile_bucket
from tripline.sources.session import settle

PREFIX_DIGITS = 4
#: A sample's candidates are about so many times its rows, and a little more for long tasks.
SLACK = 3


def split(df: DataFrame, key: str, train_percent: int = 80, seed: str = "") -> DataFrame:
    """Add ``side``, 'train' or 'test'. Narrow, and the same for any partitioning."""
    return df.withColumn(
        "side", F.when(percentile_bucket(key, seed) < train_percent, "train").otherwise("test"))


def train_test_split(df: DataFrame, key: str, train_percent: int = 80,
                     seed: str = "") -> tuple[DataFrame, DataFrame]:
    """The two sides as two frames: disjoint and complete."""
    sides = split(df, key, train_percent, seed)
    return (sides.filter("side = 'train'").drop("side"),
            sides.filter("side = 'test'").drop("side"))


def _boundary(digests: DataFrame, digits: int, wanted: int) -> tuple[str, int]:
    """The prefix within which the ``wanted``-th row by digest falls, and the rows
    before it. At most 16 ** ``PREFIX_DIGITS`` prefixes meet."""
    counts = digests.groupBy(F.substring("__digest", 1, digits).alias("prefix")).agg(
        F.count("*").alias("rows"))
    # unpartitioned on purpose: the input is the bounded table of prefixes
    running = counts.withColumn("running", F.sum("rows").over(Window.orderBy("prefix")))
    row = running.filter(F.col("running") >= wanted).orderBy("prefix").first()
    return row["prefix"], row["running"] - row["rows"]


def _low(digest: str) -> Column:
    """The first 60 bits of a digest as a number."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _candidates(df: DataFrame, key: str, n: int, seed: str) -> tuple[DataFrame, int]:
    """Rows that may be among the ``n`` lowest by key hash, written once, and the
    number of all rows; one reading of ``df``.

    A task passes its i-th row on if the hash is below a bound that falls with i: of
    as many rows in each of ``tasks`` tasks, about ``SLACK`` * n would lie below it.
    All rows below the lowest bound that any task came to are then among those
    passed on. If these are n, that is all; else, where tasks are very uneven, rows are
    read again below a bound that their number gives, until it takes in n.
    """
    tasks = max(1, df.rdd.getNumPartitions())
    digests = df.withColumn("__digest", key_hash(key, seed))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1).cast("bigint")) + 1
    whole, room = 2.0**60, SLACK * n / tasks
    seen = Observation("rows")
    passed = digests.withColumn("__place", place).observe(
        seen, F.max("__place").alias("longest"), F.count("*").alias("rows")).where(
        _low("__digest").cast("double") * F.col("__place") < F.lit(room * whole)).drop("__place")
    found = settle(passed, "candidates")
    longest, rows = seen.get["longest"] or 0, seen.get["rows"]
    bound = whole * min(1.0, room / longest * (1 - 1e-9)) if longest else whole
    wanted = min(n, rows)
    while found.where(_low("__digest") < F.lit(bound)).count() < wanted:
        rows = df.count()  # observed rows may be too many where a task ran twice
        wanted = min(n, rows)
        bound = whole * min(1.0, max(2 * bound / whole, (n + 10 * n**0.5 + 100) / max(1, rows)))
        found = settle(digests.where(_low("__digest") < F.lit(bound)), "candidates")
    return found, rows


def first_by_hash(df: DataFrame, key: str, n: int, seed: str = "",
                  too_few: str = "error") -> DataFrame:
    """Exactly ``n`` rows without replacement: the lowest key hashes.

    ``key`` must identify a row. ``df`` is read once: candidates, a few times n,
    are written with their digests, and all else is done on them. Two passes over
    them find where the n-th row falls: by the first digits of the hash, then by
    twice as many among the rows alike in the first. Rows below that place pass
    as they are, in as many partitions as they come in; only those at it are ranked.

    With fewer than ``n`` rows it is an error, or takes all with
    ``too_few="take"``.
    """
    if too_few not in ("error", "take"):
        raise ValueError(f"too_few must be 'error' or 'take', not {too_few!r}")
    digests, rows = _candidates(df, key, n, seed)
    if rows < n:
        if too_few == "take":
            return digests.drop("__digest")
        raise ValueError(f"fewer than {n} rows to sample from")
    wanted, prefix, start = n, "", ""
    for digits in (PREFIX_DIGITS, 2 * PREFIX_DIGITS):
        prefix, before = _boundary(digests.filter(F.col("__digest").startswith(start)), digits, wanted)
        wanted, start = wanted - before, prefix
    at = F.substring("__digest", 1, len(prefix))
    ranked = digests.filter(at == prefix).orderBy("__digest", key).limit(wanted)
    return digests.filter(at < prefix).union(ranked).drop("__digest")
