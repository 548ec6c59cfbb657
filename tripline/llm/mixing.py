"""Mixing sources to target weights by Sainte-Lague apportionment.

All words of the mix are seats of ``BLOCK`` words. They go to the sources by
highest quotients, target / (2 s + 1) for the seat after the s-th, and a source's
seats to its shards in the same way by their words, so every shard has a whole
number of blocks to give. A shard is a slice of its source in the order of a
seeded hash; its documents stand in that order on a circle, and the shard gives
its blocks one after the other from a seeded block on, as many rounds as it takes.

Shards hold about ``SHARD`` units and hang in a tree of ``FAN`` children a node, so
no step sees all documents of a source, however large. Rows that are alike are
counted first and cut into units of ``COPIES``, so that copies spread over
shards too. One row a source meets in one task: sources are what a mix has
weights for, and more than ``MOST_SOURCES`` are refused.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripline.llm.common import NOT_SPACE, empty_as, indexes, long
from tripline.sources.session import settle

WEIGHTS = (1, 2, 3)
#: A document is taken at most so many times.
REPEATS = 3
BLOCK = 16
SHARD, FAN_BITS, COPIES = 4096, 10, 4096
MOST_SOURCES = 1_000_000


def apportion(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats of each party by highest quotients votes / (2 s + 1); ties go to the
    party named first, none gets more than ``most``, and if all have that the rest stays.

    A divisor that gives all but the last few seats at once is found by
    halving; only those are dealt one by one.
    """
    most = np.where(votes > 0, most, 0)
    seats = min(int(seats), int(most.sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)

    def given(divisor: float) -> np.ndarray:
        return np.minimum(most, np.floor(votes / divisor + 0.5)).astype(np.int64)

    low = high = float(votes.sum()) / seats
    while given(low).sum() < seats:
        low /= 2
    while given(high).sum() > seats:
        high *= 2
    while low < (middle := (low + high) / 2) < high:
        low, high = (middle, high) if given(middle).sum() > seats else (low, middle)
    held = given(high * (1 + 1e-12))
    waiting = [(-votes[i] / (2 * held[i] + 1), i) for i in np.flatnonzero(held < most).tolist()]
    heapq.heapify(waiting)
    for _ in range(seats - int(held.sum())):
        _, i = heapq.heappop(waiting)
        held[i] += 1
        if held[i] < most[i]:
            heapq.heappush(waiting, (-votes[i] / (2 * held[i] + 1), i))
    return held


def targets(sizes: list[int], weights: list[int], repeats: int = REPEATS) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, none above ``repeats`` times its size."""
    total, free, bound = sum(sizes), set(range(len(sizes))), 0
    while True:
        rest = total - repeats * bound
        weight = sum(weights[i] for i in free)
        over = {i for i in free if repeats * sizes[i] * weight < rest * weights[i]}
        if not over:
            break
        free -= over
        bound += sum(sizes[i] for i in over)
    return [rest * weights[i] / weight if i in free else float(repeats * sizes[i])
            for i in range(len(sizes))]


def _sources(block: int, weights: tuple[int, ...], repeats: int):
    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) > MOST_SOURCES:
            raise ValueError(f"{len(rows)} sources, at most {MOST_SOURCES} can be mixed")
        order = sorted(range(len(rows)), key=lambda i: (rows["name"][i] == "", rows["name"][i]))
        rows = rows.iloc[order].reset_index(drop=True)
        sizes = [int(n) for n in rows["words"]]
        due = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], repeats)
        held = apportion(np.array(due), round(sum(sizes) / block), rows["most"].to_numpy())
        return pd.DataFrame({"name": rows["name"], "source_size": rows["words"], "target": due,
                             "node": np.int64(0), "seats": held})
    return deal


def _children(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node")
    rows["seats"] = apportion(rows["words"].to_numpy(dtype=float), rows["seats"].iloc[0],
                              rows["most"].to_numpy())
    return rows[["name", "node", "seats"]]


def _units(docs: DataFrame, seed: int) -> DataFrame:
    """Rows that share source, doc_id and size, in units of at most ``COPIES``."""
    size = F.regexp_count(empty_as(F.col("text")), F.lit(f"{NOT_SPACE}+")).cast("long")
    alike = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("name"), "doc_id",
        size.alias("size")).groupBy("name", "doc_id", "size").agg(F.count("*").alias("n"))
    cut = F.col("chunk").cast("long") * COPIES
    return alike.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.expr(f"cast((n - 1) div {COPIES} as int)")))).select(
        "name", "doc_id", "size", "chunk", F.least(F.col("n") - cut, long(COPIES)).alias("copies"),
        F.xxhash64(F.lit(seed), "name", "doc_id", "size", "chunk").alias("place"))


def _shards(units: DataFrame, block: int, repeats: int) -> DataFrame:
    """name, bits, shard, words and the blocks that it can give at most."""
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / F.lit(SHARD)))).cast("int")
    # written, so that its size is known and rows of a hot source need not meet for the join
    by_source = settle(units.groupBy("name").agg(bits.alias("bits")), "bits")
    return units.join(by_source, "name").groupBy("name", "bits", _leaf().alias("shard")).agg(
        F.sum(F.col("copies") * F.col("size")).alias("words")).withColumn(
        "most", F.expr(f"words * {repeats} div {block}"))


def _leaf() -> Column:
    return F.expr("if(bits = 0, 0L, shiftrightunsigned(place, 64 - bits))")


def _node(level: int) -> Column:
    """The shard's ancestor so many levels below its source."""
    return F.expr(f"shiftright(shard, bits - least(bits, {level * FAN_BITS}))")


def _quotas(shards: DataFrame, sources: DataFrame) -> DataFrame:
    """name, node (the shard) and its seats, dealt down the tree level by level."""
    dealt = sources.select("name", "node", "seats")
    deepest = shards.agg(F.max("bits")).first()[0] or 0
    for level in range(-(-deepest // FAN_BITS)):
        above = dealt.withColumnRenamed("node", "parent")
        below = shards.groupBy("name", _node(level).alias("parent"), _node(level + 1).alias("node")).agg(
            F.sum("words").alias("words"), F.sum("most").alias("most"))
        dealt = settle(below.join(above, ["name", "parent"]).groupBy("name", "parent").applyInPandas(
            _children, "name string, node long, seats long"), "quotas")
    return dealt


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS,
        block: int = BLOCK, seed: int = 11) -> DataFrame:
    """What the mix takes of every row of ``docs`` (doc_id, text, source).

    Returns doc_id, source, size (words), source_size, target, taken (words,
    repeats counted), passes (times the whole text is taken) and parts (from, to:
    word ranges taken once more). Sources by code point, null last, have
    ``weights`` in turn and share the words of all; what is above ``repeats``
    times a source's size goes to the others.

    A null text is empty and nothing is taken of it; an empty table gives an
    empty one; other columns are ignored. Rows that share doc_id, source and
    size are interchangeable: what is taken of them may differ by a part, and
    which of them has it says nothing. Texts of any length: a block may be a part
    of one. A source's taken words are a multiple of ``block``; a source too small
    for a block gives none. The result depends on rows, weights and seed alone,
    not on partitions.
    """
    units = settle(_units(docs, seed), "units")
    shards = settle(_shards(units, block, repeats), "shards")
    sources = settle(shards.groupBy("name").agg(
        F.sum("words").alias("words"), F.sum("most").alias("most")).groupBy().applyInPandas(
        _sources(block, weights, repeats),
        "name string, source_size long, target double, node long, seats long"), "sources")
    start = F.expr("pmod(xxhash64(%d, name, shard), words div %d + 1)" % (seed + 1, block))
    plan = settle(
        shards.join(_quotas(shards, sources).withColumnRenamed("node", "shard"), ["name", "shard"])
        .join(sources.select("name", "source_size", "target"), "name")
        .select("name", "bits", "shard", "words", "source_size", "target",
                F.expr(f"coalesce(seats * {block} div nullif(words, 0), 0L)").alias("passes"),
                F.expr(f"coalesce(seats * {block} % nullif(words, 0), 0L)").alias("rest"),
                (start * block).alias("start")), "plan")
    bits = plan.groupBy("name").agg(F.first("bits").alias("bits"))
    circle = Window.partitionBy("name", "shard").orderBy("place", "doc_id", "size", "chunk")
    at = F.coalesce(F.sum(F.col("copies") * F.col("size")).over(
        circle.rowsBetween(Window.unboundedPreceding, -1)), long(0))
    placed = units.join(bits, "name").withColumn("shard", _leaf()).drop("bits").withColumn(
        "at", at).join(plan.drop("bits"), ["name", "shard"])
    # Seen from the start block, a row's words may lie behind it or, one round earlier, before it.
    ahead = F.col("at") + F.col("copy") * F.col("size") - F.col("start")

    def part(shift: Column) -> Column:
        first = F.greatest(ahead, shift)
        last = F.least(ahead + F.col("size"), shift + F.col("rest"))
        return F.struct((first - ahead).alias("from"), (last - ahead).alias("to"))

    parts = F.filter(F.array(part(long(0)), part(-F.col("words"))), lambda p: p["from"] < p["to"])
    return placed.withColumn("copy", F.explode(indexes(F.col("copies")))).withColumn(
        "parts", parts).select(
        "doc_id", F.expr("if(name = '', null, substr(name, 2))").alias("source"), "size",
        "source_size", "target", F.expr(
            "passes * size + aggregate(parts, 0L, (a, p) -> a + p.to - p.from)").alias("taken"),
        "passes", "parts")
