"""A trie of conversations: who shares which first turns, from double arrays by shard.

Conversations that are alike turn by turn collapse to one sequence of turn digests.
The sequences are sorted over the cluster, so a shard is a slice of the trie
in its own order and shards are even, however many conversations begin alike. A
task numbers its turns densely, packs its slice into BASE and CHECK arrays, walks
every sequence through them and sums up the nodes it reaches from the deepest up.

Only nodes on a shard's first and last path can lie in other shards as well. Those
that do are merged: members add up, and what several shards counted for one node
is taken back from it and all nodes above it.

A node's own members are joined to text in pieces of neighbouring ids and hashed as
a stream, so a sequence that many conversations share costs one task their ids'
bytes, not their rows or memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import NOT_SPACE, empty_as, long
from tripline.sources.session import settle

EMPTY = hashlib.sha256(b"").hexdigest()
#: Ids that differ in their last 12 bits alone make one piece of text.
PIECE_BITS = 12
#: Turns of a shard, about.
SHARD_TURNS = 200_000
#: Gaps tried for a node at least, before it is placed behind all.
GAPS = 32

_SEQUENCE = "array<struct<turn:binary,words:long>>"
#: key and above name a node and its parent where other shards may have them.
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, words long, key binary, "
         "above binary, shard long, path int")
_BATCH = pa.schema([
    *((name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs",
                                      "n_children", "n_leaves", "saved_tokens")),
    ("ends_sha256", pa.string()), ("words", pa.int64()), ("key", pa.binary()),
    ("above", pa.binary()), ("shard", pa.int64()), ("path", pa.int32())])


class DoubleArray:
    """A trie in two arrays: the child of node s by code c is t = base[s] + c if check[t] = s.

    ``children`` lists the codes below each node, parents first; node 0 is the
    root. ``slot`` is each node's place in the arrays.
    """

    def __init__(self, children: list[list[int]], n_codes: int):
        self.base: list[int] = []
        self.check: list[int] = []
        self.slot = [0] * len(children)
        self._grow(n_codes + 2)
        self.check[0] = -2  # the root's own place
        first_gap, node = 1, 0
        for parent, codes in enumerate(children):
            if not codes:
                continue
            while first_gap < len(self.check) and self.check[first_gap] != -1:
                first_gap += 1
            base = self._room(codes, first_gap)
            self._grow(base + codes[-1] + 1)
            at = self.slot[parent]
            self.base[at] = base
            for code in codes:
                node += 1
                self.check[base + code] = at
                self.slot[node] = base + code

    def _grow(self, size: int) -> None:
        if (more := size - len(self.check)) > 0:
            more = max(more, len(self.check))
            self.base += [0] * more
            self.check += [-1] * more

    def _room(self, codes: list[int], gap: int) -> int:
        """A base whose places for ``codes``, in ascending order, are all free."""
        check, size = self.check, len(self.check)
        for _ in range(GAPS + codes[-1] - codes[0]):  # no dearer than the room behind all
            if gap >= size:
                break
            base = gap - codes[0]
            if all(base + c >= size or check[base + c] == -1 for c in codes):
                return base
            gap += 1
            while gap < size and check[gap] != -1:
                gap += 1
        return size - codes[0]

    def child(self, at: int, code: int) -> int:
        """Place of the child, or -1."""
        place = self.base[at] + code
        return place if 0 < place < len(self.check) and self.check[place] == at else -1


def _levels(sequences: list[list[int]]) -> list[list[int]]:
    """Codes below each node, nodes numbered level by level from the root."""
    children, groups, depth = [], [sequences], 0
    while groups:
        below = []
        for group in groups:
            split: dict[int, list] = {}
            for sequence in group:
                if len(sequence) > depth:
                    split.setdefault(sequence[depth], []).append(sequence)
            codes = sorted(split)
            children.append(codes)
            below += [split[c] for c in codes]
        groups, depth = below, depth + 1
    return children


def _chain(key: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(key + turn).digest()


ROOT = hashlib.sha256(b"root").digest()


def _nodes(turns: list[list[bytes]], words: list[list[int]], members: list[int],
           least: list[int], ends: list[str], shard: int) -> dict[str, list]:
    """All nodes of a shard's sequences, which are sorted and distinct."""
    code: dict[bytes, int] = {}
    sequences = [[code.setdefault(t, len(code) + 1) for t in s] for s in turns]
    children = _levels(sequences)
    trie = DoubleArray(children, len(code))
    size = len(trie.check)
    n, low = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depth, last = np.zeros(size, np.int64), np.zeros(size, np.int64)
    sha = {}
    path = np.zeros(size, np.int32)
    keys, above = {0: ROOT}, {0: None}
    for row, sequence in enumerate(sequences):
        at, count, smallest = 0, members[row], least[row]
        n[0] += count
        low[0] = min(low[0], smallest)
        edge = (row == 0) + 2 * (row == len(sequences) - 1)
        path[0] |= edge
        for d, c in enumerate(sequence):
            parent, at = at, trie.child(at, c)
            n[at] += count
            if smallest < low[at]:
                low[at] = smallest
            depth[at], last[at] = d + 1, words[row][d]
            if edge:
                path[at] |= edge
                keys[at] = _chain(keys[parent], turns[row][d])
                above[at] = keys[parent]
        sha[at] = ends[row]
    places = np.array(trie.slot, np.int64)
    check = np.array(trie.check, np.int64)
    leaves, kids = np.zeros(size, np.int64), np.zeros(size, np.int64)
    saved = np.zeros(size, np.int64)
    saved[places] = (n[places] - 1) * last[places]
    below = places[1:]
    np.add.at(kids, check[below], 1)
    leaves[places] = kids[places] == 0
    by_depth = depth[places]  # ascending: nodes are numbered by level
    for d in range(int(by_depth[-1]), 0, -1):
        level = places[np.searchsorted(by_depth, d):np.searchsorted(by_depth, d, "right")]
        np.add.at(leaves, check[level], leaves[level])
        np.add.at(saved, check[level], saved[level])
    parent_low = np.where(places == 0, 0, low[np.maximum(check[places], 0)])
    out = places.tolist()
    return {"conv_id": low[places], "depth": by_depth,
            "parent_conv_id": pa.array(parent_low, pa.int64(), mask=places == 0),
            "n_convs": n[places], "n_children": kids[places], "n_leaves": leaves[places],
            "saved_tokens": saved[places], "ends_sha256": [sha.get(p, EMPTY) for p in out],
            "words": last[places], "key": [keys.get(p) for p in out],
            "above": [above[p] if p in above else keys.get(int(check[p])) for p in out],
            "shard": np.full(len(out), shard), "path": path[places]}


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turns, words, members, least, ends, shard = [], [], [], [], [], 0
    for batch in batches:
        for row in batch.to_pylist():
            turns.append([t["turn"] for t in row["sequence"]])
            words.append([t["words"] for t in row["sequence"]])
            members.append(row["members"])
            least.append(row["least"])
            ends.append(row["ends"])
            shard = row["shard"]
    if turns:
        rows = pa.Table.from_pydict(_nodes(turns, words, members, least, ends, shard), schema=_BATCH)
        yield from rows.to_batches(max_chunksize=100_000)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as digests of role and text, and word counts.

    Turns stand by ``turn``, null first; those with equal ``turn`` by their digest.
    Rows with a null conv_id belong to no conversation.
    """
    role, text = empty_as(F.col("role")), empty_as(F.col("text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").alias("at"), digest.alias("turn"),
            F.regexp_count(text, F.lit(f"{NOT_SPACE}+")).cast("long").alias("words")).alias("t")
    ).groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(
        t["turn"].alias("turn"), t["words"].alias("words"))).alias("sequence"))


def rebuilt(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """conv_id and its sequence, its first h turns taken from the head of its family.

    The head of c is c - c % ``family`` (the remainder has the sign of c); h is
    the unsigned crc32 of c in decimal, modulo ``heads``. A head that is absent
    has no turns; one with fewer than h gives all. Every head serves
    2 * ``family`` - 1 conversations at most.
    """
    own = settle(ordered_turns(conversations), "conversations")
    h = F.expr(f"cast(crc32(encode(cast(conv_id as string), 'utf-8')) % {heads} as int)")
    split = own.select("conv_id", "sequence", h.alias("h"),
                       (F.col("conv_id") - F.col("conv_id") % family).alias("head"))
    first = own.select(F.col("conv_id").alias("head"),
                       F.slice("sequence", 1, heads - 1).alias("first"))
    return split.join(first, "head", "left").select("conv_id", F.concat(
        F.expr("if(h = 0, cast(array() as %s), slice(coalesce(first, array()), 1, h))" % _SEQUENCE),
        F.expr("filter(sequence, (t, i) -> i >= h)")).alias("sequence"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members, smallest conv_id and the hash of all ids of each key; pieces come in order."""
    out: dict[str, list] = {"key": [], "members": [], "least": [], "ends": []}
    now, digest = None, None

    def close() -> None:
        if now is not None:
            out["ends"].append(digest.hexdigest())

    for batch in batches:
        for key, least, n, piece in zip(*(batch[c].to_pylist() for c in ("key", "least", "n", "piece"))):
            if key != now:
                close()
                now, digest = key, hashlib.sha256(piece.encode())
                out["key"].append(key)
                out["members"].append(n)
                out["least"].append(least)
            else:
                digest.update(b"," + piece.encode())
                out["members"][-1] += n
        if len(out["ends"]) >= 10_000:  # the last key may go on
            whole = len(out["ends"])
            yield pa.RecordBatch.from_pydict({c: v[:whole] for c, v in out.items()})
            out = {c: v[whole:] for c, v in out.items()}
    close()
    if out["key"]:
        yield pa.RecordBatch.from_pydict(out)


def sequences(conversations: DataFrame) -> DataFrame:
    """Distinct sequences of conv_id, sequence: with members, the least conv_id and ends,
    the hash of their ids, ascending and comma-joined."""
    keyed = settle(conversations.select("conv_id", "sequence", F.unhex(F.sha2(F.array_join(
        F.transform("sequence", lambda t: F.hex(t["turn"])), ""), 256)).alias("key")), "sequences")
    pieces = keyed.groupBy("key", F.shiftright("conv_id", PIECE_BITS).alias("at")).agg(
        F.min("conv_id").alias("least"), F.count("*").alias("n"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("piece"))
    hashed = pieces.repartition("key").sortWithinPartitions("key", "at").select(
        "key", "least", "n", "piece").mapInArrow(
        _hashed, "key binary, members long, least long, ends string")
    return keyed.select("key", "sequence").distinct().join(hashed, "key").select(
        "sequence", "members", "least", "ends")


def _merged(shared: DataFrame) -> DataFrame:
    """One row a node from those of several shards: key, and its values over all.

    Summed over shards, a node counts (n - 1) words once too often less for each
    further shard, each child once for each shard that has it, and a leaf
    wherever a sequence ends at a shard's edge though others go on. What is too
    much of a node is so for all nodes above it.
    """
    sums = shared.groupBy("key").agg(
        F.min("above").alias("above"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max(F.when(F.col("ends_sha256") != EMPTY, F.col("ends_sha256"))).alias("ends_sha256"),
        F.count("*").alias("shards"), F.max("words").alias("words"),
        F.count_if(F.col("n_children") == 0).alias("false_leaves"),
        F.min(F.struct("shard", "path")).alias("lies"))
    twice = settle(sums.where(F.col("shards") > 1), "merged")
    extra = (F.col("shards") - 1) * F.col("words")
    # Above a node lie the nodes of its shard's path that are less deep.
    where = twice.select("key", "depth", F.col("lies.shard").alias("shard"),
                         F.col("lies.path").alias("path"), extra.alias("extra"), "false_leaves")
    lines = shared.join(twice.select("key"), "key", "left_semi").select(
        "shard", F.col("path").alias("up_path"), F.col("depth").alias("up_depth"), F.col("key").alias("up"))
    mends = where.join(lines, "shard").where(
        (F.col("up_depth") <= F.col("depth")) & (F.col("path").bitwiseAND(F.col("up_path")) != 0)).groupBy(
        F.col("up").alias("key")).agg(F.sum("extra").alias("extra"), F.sum("false_leaves").alias("false_leaves"))
    again = twice.groupBy(F.col("above").alias("key")).agg(F.sum(F.col("shards") - 1).alias("again"))
    return twice.drop("false_leaves").join(mends, "key").join(again, "key", "left").select(
        "key", "above", "conv_id", "depth", "n_convs",
        (F.col("n_children") - F.coalesce("again", long(0))).alias("n_children"),
        (F.col("n_leaves") - F.col("false_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("extra")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie over rows of conv_id and sequence (see ``rebuilt``).

    A row per node: conv_id (its smallest member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256. No
    conversation at all gives no node, not even a root. A sequence is held whole
    by one task, as texts are.
    """
    classes = settle(sequences(conversations), "classes")
    turns = classes.agg(F.sum(F.size("sequence") + 1)).first()[0] or 0
    shards = max(1, -(-turns // shard_turns))
    nodes = settle(classes.repartitionByRange(shards, "sequence").sortWithinPartitions("sequence")
                   .withColumn("shard", F.spark_partition_id().cast("long")).mapInArrow(_tries, NODES),
                   "nodes")
    edge = nodes.where(F.col("path") > 0)
    merged = settle(_merged(edge), "upper")
    # By shard and key, the children of one node are dealt out over the shards they lie in.
    upper = settle(edge.join(merged.select("key", F.col("conv_id").alias("whole")), "key").select(
        F.col("shard").alias("up_shard"), F.col("key").alias("up_key"), "whole"), "upper-shards")
    alone = nodes.where(F.col("path") == 0).unionByName(edge.join(
        merged.select("key"), "key", "left_anti").select(*nodes.columns))
    below = alone.where(F.col("above").isNotNull()).join(upper, (F.col("shard") == F.col("up_shard")) & (
        F.col("above") == F.col("up_key")), "left").withColumn(
        "parent_conv_id", F.coalesce("whole", "parent_conv_id"))
    parents = merged.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return (alone.where(F.col("above").isNull()).select(*COLUMNS)
            .unionByName(below.select(*COLUMNS))
            .unionByName(merged.join(parents, "above", "left").select(*COLUMNS)))
