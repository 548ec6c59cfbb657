"""Near-duplicates by SimHash, found through deletion-variant signatures.

A fingerprint is cut into so few segments that, of two that differ by at most
``max_bits`` bits, one segment differs by at most one. Every segment is
indexed once per bit with that bit blotted out: two values that differ by one
bit meet under that bit's variant, equal ones under all. Meeting fingerprints
are verified on all 64 bits.

A pair is taken under the first segment and bit that can show it, so it counts
once. What leaves a bucket is a star per group of linked fingerprints, not its
pairs. Buckets beyond ``BLOCK`` are cut into blocks, and the pairs of blocks
are dealt out as groups of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import text_key
from tripline.llm.components import components, spread_join
from tripline.sources.session import settle

SHINGLE, MAX_BITS, SEED = 4, 4, 42
BITS = 64
#: Fingerprints of a bucket that are compared in one go.
BLOCK = 4096
#: Buckets up to this size are compared neighbour by neighbour, all at once.
SMALL = 16
#: Shingle hashes whose bits are unpacked at a time.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash; 0 for a text without words."""
    parts = (text or "").encode().lower().split()  # bytes: A-Z and ASCII space only
    if not parts:
        return 0
    whole = b" ".join(parts)
    ends = np.cumsum([len(p) for p in parts]) + np.arange(len(parts))
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(whole[a:b], SEED) for a, b in zip(
            starts[:len(parts) - width + 1].tolist(), ends[width - 1:].tolist())),
        dtype=">u8", count=len(parts) - width + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        chunk = hashes[at:at + CHUNK]
        ones += np.unpackbits(chunk.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *keep: str) -> DataFrame:
    """doc_id, text_hash, ``keep`` and fingerprint (a signed long) of every row."""
    schema = pa.schema([("fingerprint", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_signed(fingerprint(text.as_py(), shingle)) for text in batch["text"]]
            rest = [batch[name] for name in batch.schema.names if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(values, schema.field(0).type)], names=[*names, "fingerprint"])

    rows = docs.select("doc_id", text_key("text").alias("text_hash"), *keep, "text")
    out = rows.drop("text").schema.add("fingerprint", "long")
    return rows.mapInArrow(run, out)


def segments(max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """(shift, width) of the fewest segments of which one differs by at most one bit."""
    count = max_bits // 2 + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _variants(value: Column, max_bits: int) -> Column:
    """One key per segment and bit: bit's number, then the segment without that bit."""
    keys = []
    for shift, width in segments(max_bits):
        part = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        for bit in range(width):
            blotted = part.bitwiseAND(F.lit(~(1 << bit) & ((1 << width) - 1)).cast("long"))
            keys.append(F.shiftleft(F.lit(shift + bit).cast("long"), 48).bitwiseOR(blotted))
    return F.array(*keys)


def _first_variant(diff: np.ndarray, max_bits: int) -> np.ndarray:
    """Number of the first variant under which a pair with this xor meets, or -1."""
    out = np.full(diff.shape, -1, dtype=np.int64)
    for shift, width in segments(max_bits):
        part = (diff >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        bit = np.bitwise_count(np.maximum(part, np.uint64(1)) - np.uint64(1)).astype(np.int64)
        here = (out < 0) & (np.bitwise_count(part) <= 1)
        out[here] = shift + bit[here]
    return out


def _linked(diff: np.ndarray, variant: np.ndarray, max_bits: int) -> np.ndarray:
    """Which xors are links, and belong to the variant where they were met."""
    near = np.bitwise_count(diff) <= max_bits
    out = np.zeros(diff.shape, dtype=bool)
    if near.any():
        out[near] = _first_variant(diff[near], max_bits) == variant[near]
    return out


def _join_up(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give both ends of each link the smallest label, in place, until at rest."""
    while True:
        low = np.minimum(label[a], label[b])
        if np.array_equal(label[a], low) and np.array_equal(label[b], low):
            return
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            higher = label[label]
            if np.array_equal(higher, label):
                break
            label[:] = higher


def _cross(values: np.ndarray, first: range, second: range, variant: int, label: np.ndarray,
           max_bits: int) -> None:
    """Join up links between two ranges of one bucket, some rows at a time."""
    rows = max(1, (1 << 20) // max(1, len(second)))
    others = values[second.start:second.stop]
    for at in range(first.start, first.stop, rows):
        part = values[at:min(at + rows, first.stop)]
        diff = part[:, None] ^ others[None, :]
        i, j = np.nonzero(_linked(diff, np.broadcast_to(np.int64(variant), diff.shape), max_bits))
        if len(i):
            _join_up(label, i + at, j + second.start)


def link_sorted(keys: np.ndarray, values: np.ndarray, max_bits: int) -> tuple:
    """Stars (member, head) of all buckets in rows sorted by key."""
    n = len(keys)
    label = np.arange(n)
    if n:
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(starts, n))
        small = np.repeat(sizes <= SMALL, sizes)
        for step in range(1, int(sizes[sizes <= SMALL].max(initial=0))):
            i = np.flatnonzero((keys[step:] == keys[:-step]) & small[:-step])
            if not len(i):
                break
            i = i[_linked(values[i] ^ values[i + step], keys[i] >> 48, max_bits)]
            if len(i):
                _join_up(label, i, i + step)
        for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
            whole = range(start, start + size)
            _cross(values, whole, whole, int(keys[start] >> 48), label, max_bits)
    member = np.flatnonzero(label != np.arange(n))
    return values[member], values[label[member]]


_MET = "u long, v long, bucket long, block int"


def _met(u, v, bucket=None, block=None) -> pa.RecordBatch:
    def column(values, kind):
        if values is None:
            return pa.nulls(len(u), kind)
        return pa.array(np.asarray(values).astype(kind.to_pandas_dtype()), kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(u).view(np.int64), pa.int64()),
         pa.nulls(len(u), pa.int64()) if v is None
         else pa.array(np.asarray(v).view(np.int64), pa.int64()),
         column(bucket, pa.int64()), column(block, pa.int32())],
        names=["u", "v", "bucket", "block"])


def link_buckets(batches: Iterator[pa.RecordBatch], max_bits: int,
                 limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Links of sorted (key, fingerprint) rows; memory holds a batch and a block.

    A bucket of more than ``limit`` rows leaves its members too, each with its
    block, for the comparison between blocks.
    """
    keys, values = np.empty(0, np.int64), np.empty(0, np.uint64)
    crowded, block = None, 0  # the bucket of which blocks have gone, and their number
    for batch in chain(batches, [None]):
        final = batch is None
        if not final:
            keys = np.concatenate((keys, batch["key"].to_numpy()))
            values = np.concatenate((values, batch["fingerprint"].to_numpy().view(np.uint64)))
        while len(keys):
            front = int(keys[0])
            end = int(np.searchsorted(keys, front, "right"))
            ended = final or end < len(keys)
            if end > limit or (front == crowded and (ended or end == limit)):
                if front != crowded:
                    crowded, block = front, 0
                take = min(end, limit)
                yield _met(values[:take], None, keys[:take], np.full(take, block))
                block += 1
            elif not ended:
                break
            else:
                starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                sizes = np.diff(np.append(starts, len(keys)))
                stops = starts[sizes > limit].tolist() + [len(keys) if final else int(starts[-1])]
                take = stops[0]
            yield _met(*link_sorted(keys[:take], values[:take], max_bits))
            keys, values = keys[take:], values[take:]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, limit: int = BLOCK) -> DataFrame:
    """u, v: enough links between distinct fingerprints to join all that are linked.

    One shuffle of ``BITS`` small rows a fingerprint, by variant; sorted
    partitions are streamed. Crowded buckets go through a second one, in which
    each pair of blocks is a group.
    """
    variants = distinct.select(
        F.explode(_variants(F.col("fingerprint"), max_bits)).alias("key"), "fingerprint")
    met = settle(
        variants.repartition("key").sortWithinPartitions("key").mapInArrow(
            lambda batches: link_buckets(batches, max_bits, limit), _MET), "met")
    members = met.where("bucket IS NOT NULL").select(
        F.col("u").alias("fingerprint"), "bucket", "block")
    blocks = members.groupBy("bucket").agg((F.max("block") + 1).alias("blocks"))
    dealt = members.join(blocks, "bucket").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other <> block")

    def between(table: pa.Table) -> pa.Table:
        values = table["fingerprint"].to_numpy().view(np.uint64)
        side = table["block"].to_numpy()
        values = values[np.argsort(side, kind="stable")]
        cut = int((side == side.min()).sum())
        label = np.arange(len(values))
        _cross(values, range(cut), range(cut, len(values)),
               table["bucket"][0].as_py() >> 48, label, max_bits)
        member = np.flatnonzero(label != np.arange(len(values)))
        return pa.table({"u": values[member].view(np.int64),
                         "v": values[label[member]].view(np.int64)})

    across = dealt.groupBy("bucket", F.least("block", "other").alias("low"),
                           F.greatest("block", "other").alias("high")).applyInArrow(
        between, "u long, v long")
    return met.where("bucket IS NULL").select("u", "v").union(across)


def classes(prints: DataFrame, max_bits: int = MAX_BITS, limit: int = BLOCK) -> DataFrame:
    """fingerprint -> root, the smallest fingerprint (as a signed number) it can reach."""
    distinct = settle(prints.select("fingerprint").distinct(), "distinct-prints")
    reached = components(links(distinct, max_bits, limit))
    return distinct.join(reached, distinct["fingerprint"] == reached["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest doc_id reachable, of every row.

    Null and empty texts have fingerprint 0 and link like others. A null
    doc_id counts only where its group has no other. Repeated rows each get
    their row; other columns are ignored.
    """
    prints = settle(fingerprints(docs, shingle).select("doc_id", "fingerprint"), "prints")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    rooted = settle(classes(prints, max_bits).join(least, "fingerprint"), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(spread_join(rooted, smallest, "root", "fingerprint").select(
        "fingerprint", "component_id"), "named")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with one row of each group left: the smallest doc_id (a doc_id
    before none, then the smaller hash of the text), and of rows alike in both one.

    The texts are not moved to tell which rows go: a written list of those does,
    by doc_id where it names one row, else with the text's hash. Catalyst
    broadcasts the list below its threshold.
    """
    prints = settle(fingerprints(docs, shingle), "prints")
    rooted = settle(classes(prints, max_bits), "rooted")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = (prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
             .join(rooted, "fingerprint").groupBy("root").agg(F.min("first").alias("first")))
    chosen = settle(spread_join(rooted, first, "root", "fingerprint").select(
        "fingerprint", "first"), "chosen")
    copies = prints.groupBy("doc_id").agg((F.count("*") == 1).alias("single"))
    judged = settle(
        prints.join(chosen, "fingerprint").join(
            copies.withColumnRenamed("doc_id", "copy_id"),
            F.col("doc_id").eqNullSafe(F.col("copy_id")))
        .select("doc_id", "text_hash", "single", (order == F.col("first")).alias("stays")),
        "judged")
    single = F.col("single") & F.col("doc_id").isNotNull()
    by_id = settle(judged.where(~F.col("stays") & single).select(
        F.col("doc_id").alias("gone_id")), "gone-by-id")
    key = [F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash")]
    by_both = settle(judged.where(~F.col("stays") & ~single).select(*key).distinct(), "gone")
    again = settle(judged.where("stays").groupBy("doc_id", "text_hash").count().where(
        "count > 1").select(*key), "again")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", text_key("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("text_hash") == F.col("key_hash"))
    left = rows.join(by_id, F.col("doc_id") == F.col("gone_id"), "left_anti").join(
        by_both, same, "left_anti")
    alike = left.join(again, same, "left_semi").groupBy("doc_id", "text_hash").agg(
        F.first("row").alias("row"))
    return left.join(again, same, "left_anti").select("row.*").union(alike.select("row.*"))


def as_hex(value: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
