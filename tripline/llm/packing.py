"""Packing documents into sequences of fixed length by first-fit decreasing.

A document's ids are cut into full sequences; the rests are packed. Groups of
documents are drawn at random and packed apart from each other, so a group is
bounded and no step sees the whole table. Within a group the rests go, largest
first, to the first bin that takes them; a tournament tree over the bins' free
room finds it in logarithmic time.

Rests of more than ``CUT`` ids are cut again, ``CUT`` at a time, so that small
pieces fill what large ones leave.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm import tokens
from tripline.sources.session import settle

LENGTH = 2048
#: Documents of a group, about.
GROUP = 4096
#: Rests are cut to pieces of at most so many ids.
CUT = 1024

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class FirstFit:
    """Bins in order of opening; ``place`` returns the first with room, and its filling before."""

    def __init__(self, most_bins: int, capacity: int):
        self.leaves = 1 << max(0, (most_bins - 1).bit_length())
        self.capacity = capacity
        self.room = [capacity] * (2 * self.leaves)  # of each match's winner

    def place(self, size: int) -> tuple[int, int]:
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        filled = self.capacity - room[at]
        room[at] -= size
        found = at - self.leaves
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return found, filled


def cuts(total: int, length: int = LENGTH, cut: int = CUT) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full sequences, then the rest cut small."""
    full = total - total % length
    out = [(at, length) for at in range(0, full, length)]
    out += [(at, min(cut, total - at)) for at in range(full, total, cut)]
    return out


def pack(totals: list[int], length: int = LENGTH, cut: int = CUT) -> list[tuple]:
    """(document, start, length, bin, offset) of all pieces of some documents."""
    pieces = [(n, start, size) for n, total in enumerate(totals)
              for start, size in cuts(total, length, cut)]
    order = sorted(range(len(pieces)), key=lambda i: (-pieces[i][2], pieces[i][0], pieces[i][1]))
    bins = FirstFit(max(1, len(pieces)), length)
    placed = [(0, 0)] * len(pieces)
    for i in order:
        placed[i] = bins.place(pieces[i][2])
    return [(*piece, *place) for piece, place in zip(pieces, placed)]


def tokenised(docs: DataFrame, path: str, ranks: str, end: int, length: int = LENGTH,
              cut: int = CUT) -> DataFrame:
    """doc_id, row, doc_tokens and the crc32 of each piece; null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.byte_encoder(path, ranks)
        for batch in batches:
            totals, sums = [], []
            for text in batch["text"]:
                ids = np.append(encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
                totals.append(len(ids))
                sums.append([zlib.crc32(ids[a:a + n].tobytes())
                             for a, n in cuts(len(ids), length, cut)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(totals, pa.int64()),
                 pa.array(sums, pa.list_(pa.int64()))], names=["doc_id", "doc_tokens", "sums"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, doc_tokens long, sums array<long>").withColumn(
        "row", F.monotonically_increasing_id())


def pieces(docs: DataFrame, path: str, ranks: str, end: int, length: int = LENGTH,
           cut: int = CUT, group: int = GROUP) -> DataFrame:
    """All pieces of all documents with their place in a sequence.

    Every id lies in one piece; pieces of a sequence leave no gap. Repeated
    rows and null doc_ids are packed like any other row: groups are drawn by
    the number a row got when the counts were written. An empty table gives no
    pieces; other columns are ignored.
    """
    counted = settle(tokenised(docs, path, ranks, end, length, cut), "tokenised")
    groups = max(1, -(-counted.count() // group))
    drawn = counted.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        packed = pack(table["doc_tokens"].to_pylist(), length, cut)
        doc, start, size, into, offset = (
            np.array(column, dtype=np.int64) for column in zip(*packed))
        first = table["group"][0].as_py() << 32
        return pa.table({
            "doc_id": table["doc_id"].combine_chunks().take(pa.array(doc)),
            "start": start, "length": size,
            "ids_crc32": np.concatenate([np.array(s, dtype=np.int64)
                                         for s in table["sums"].to_pylist()]),
            "doc_tokens": table["doc_tokens"].combine_chunks().take(pa.array(doc)),
            "sequence_id": into + first, "offset": offset})

    return drawn.groupBy("group").applyInArrow(fill, PIECES)
