"""Blocks of token ids, coded by an adaptive context-mixing range coder.

A block is cut into lanes of consecutive ids, and the lanes are coded side by
side: one step codes the next id of every lane, so all work is array work.
Three predictions are kept for the block and learn from all its lanes:

- order 2: the id last seen after the two ids before, with a confidence;
- order 1: the same for the one id before;
- order 0: the frequencies of ids so far.

A mixing table, by both confidences and whether the two agree, holds how often
each was right; it gives the widths of three intervals: order 2, order 1,
neither. "Neither" is followed by the id under order 0. The model starts
afresh with each block, so a block is read without any other.

Layout, little endian: header (magic, version, ids, bound of ids, steps,
words), the lanes' 32-bit words in the order in which they are read, crc32 of
all before.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION = b"TLTB", 1
_HEADER = struct.Struct("<4sIQIIQ")

#: Largest bound of ids; order 0 shares 2**ZERO_BITS among them.
ZERO_BITS, MIX_BITS = 20, 10
MOST_IDS = 1 << (ZERO_BITS - 1)
#: Steps of a lane in a large block; small ones have fewer, to keep some lanes.
STEPS = 256
#: Slots of the order-2 table (a power of two), and confidence levels.
SLOTS, LEVELS = 1 << 18, 8
#: The mixing table is renewed every so many steps, order 0 at powers of two.
MIX_EVERY = 4

_ZERO, _MIX = 1 << ZERO_BITS, 1 << MIX_BITS
_LOW = np.uint64(0xFFFFFFFF)
_WORD = np.uint64(32)
_LIMIT = np.uint64(1 << 32)

#: Change of confidence, when wrong and when right.
_CHANGE = np.array([sure // 2 - sure for sure in range(LEVELS)]
                   + [min(sure + 1, LEVELS - 1) - sure for sure in range(LEVELS)])


class Corrupt(ValueError):
    """The bytes are no whole block."""


def _shares(counts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and widths, none below one, that fill ``total`` along the last axis."""
    spare = total - counts.shape[-1]
    sums = np.maximum(counts.sum(axis=-1, keepdims=True), 1)
    widths = 1 + counts * spare // sums
    top = counts.argmax(axis=-1)[..., None]
    rest = total - widths.sum(axis=-1, keepdims=True)
    np.put_along_axis(widths, top, np.take_along_axis(widths, top, -1) + rest, -1)
    return np.cumsum(widths, axis=-1) - widths, widths


class _Model:
    """What both directions know before an id is coded."""

    def __init__(self, bound: int, decode: bool):
        self.bound, self.decode = bound, decode
        self.one = np.zeros(bound, dtype=np.int64)  # id and confidence in one number
        self.two = np.zeros(SLOTS, dtype=np.int64)
        self.zero_counts = np.zeros(bound, dtype=np.int64)
        self.mix_counts = np.ones((2 * LEVELS * LEVELS, 3), dtype=np.int64)
        self.seen: list[np.ndarray] = []
        self.mixed: list[np.ndarray] = []
        self._renew_zero()
        self._renew_mix()

    def _renew_zero(self) -> None:
        start, width = _shares(self.zero_counts, _ZERO)
        self.zero_start, self.zero_width = start.astype(np.uint64), width.astype(np.uint64)
        if self.decode:
            self.zero_slot = np.repeat(np.arange(self.bound, dtype=np.int32), width)

    def _renew_mix(self) -> None:
        start, width = _shares(self.mix_counts, _MIX)
        self.mix_start = start.astype(np.uint64).ravel()
        self.mix_width = width.astype(np.uint64).ravel()

    def predict(self, before: np.ndarray, before2: np.ndarray) -> None:
        """Ids and table row for lanes whose last ids are ``before``."""
        self.before = before
        self.slot = (before * 40503 ^ before2 * 30011) & (SLOTS - 1)
        self.entry1, self.entry2 = self.one.take(before), self.two.take(self.slot)
        self.id1, self.id2 = self.entry1 >> 3, self.entry2 >> 3
        self.sure1, self.sure2 = self.entry1 & 7, self.entry2 & 7
        self.row = (((self.sure2 << 3 | self.sure1) << 1) | (self.id1 == self.id2)) * 3

    def mix_part(self, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.row + outcome
        return self.mix_start.take(at), self.mix_width.take(at)

    @staticmethod
    def _learnt(entry: np.ndarray, sure: np.ndarray, right: np.ndarray,
                fresh: np.ndarray) -> np.ndarray:
        """Right: surer. Wrong: half as sure, and replaced when that is nothing."""
        case = sure + right * LEVELS
        return np.where(case < 2, fresh, entry + _CHANGE.take(case))

    def learn(self, ids: np.ndarray, outcome: np.ndarray, step: int) -> None:
        fresh = ids << 3 | 1
        self.two[self.slot] = self._learnt(self.entry2, self.sure2, self.id2 == ids, fresh)
        self.one[self.before] = self._learnt(self.entry1, self.sure1, self.id1 == ids, fresh)
        self.mixed.append(self.row + outcome)
        self.seen.append(ids)
        done = step + 1
        if done % MIX_EVERY == 0:
            self.mix_counts += np.bincount(
                np.concatenate(self.mixed), minlength=self.mix_counts.size).reshape(-1, 3)
            self.mixed = []
            self._renew_mix()
        if done & (done - 1) == 0:
            self.zero_counts += np.bincount(np.concatenate(self.seen), minlength=self.bound)
            self.seen = []
            self._renew_zero()


def _narrow(low: np.ndarray, span: np.ndarray, start, width, bits: int) -> None:
    """Move an interval, in place, into the part of it from ``start``, ``width`` wide."""
    span >>= np.uint64(bits)
    low += span * start
    span *= width


def _due(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes whose span fell below a word, and the word they are done with.

    An interval across a word's border is cut at the border, so that its first
    word is settled; both directions do so.
    """
    lanes = np.flatnonzero(span < _LIMIT)
    first = low[lanes]
    tail = first & _LOW
    span[lanes] = np.minimum(span[lanes], _LIMIT - tail) << _WORD
    low[lanes] = tail << _WORD
    return lanes, (first >> _WORD).astype("<u4")


def _plan(count: int) -> tuple[int, int]:
    """(steps, lanes) of a block."""
    steps = min(STEPS, max(16, count >> 8))
    return steps, -(-count // steps)


def encode(ids: np.ndarray) -> bytes:
    """The block of ``ids``, numbers below 2**19; an empty list has a block too."""
    ids = np.ascontiguousarray(ids, dtype=np.int64)
    count = len(ids)
    bound = int(ids.max()) + 1 if count else 1
    if bound > MOST_IDS:
        raise ValueError(f"ids must be below {MOST_IDS}")
    steps, lanes = _plan(count)
    grid = np.zeros(steps * lanes, dtype=np.int64)
    grid[:count] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Model(bound, decode=False)
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, np.iinfo(np.uint64).max, dtype=np.uint64)
    one_back = two_back = np.zeros(lanes, dtype=np.int64)
    out_lanes, out_words = [], []
    for step in range(steps):
        live = lanes if (lanes - 1) * steps + step < count else lanes - 1
        if not live:
            break
        now = grid[step, :live]
        model.predict(one_back[:live], two_back[:live])
        outcome = np.where(model.id2 == now, 0, 2 - (model.id1 == now))
        part_low, part = low[:live], span[:live]
        _narrow(part_low, part, *model.mix_part(outcome), MIX_BITS)
        new = outcome == 2
        _narrow(part_low, part, model.zero_start.take(now) * new,
                np.where(new, model.zero_width.take(now), np.uint64(_ZERO)), ZERO_BITS)
        due, words = _due(part_low, part)
        out_lanes.append(due)
        out_words.append(words)
        model.learn(now, outcome, step)
        two_back, one_back = one_back, now
    words = _reading_order(out_lanes, out_words, low, lanes)
    head = _HEADER.pack(MAGIC, VERSION, count, bound, steps, len(words))
    body = head + words.tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def _reading_order(out_lanes: list, out_words: list, low: np.ndarray, lanes: int) -> np.ndarray:
    """Words as the reader takes them: it is two words ahead in each lane."""
    every = np.arange(lanes)
    written = np.concatenate([*out_lanes, every, every])
    words = np.concatenate([*out_words, (low >> _WORD).astype("<u4"),
                            (low & _LOW).astype("<u4")])
    by_lane = np.argsort(written, kind="stable")
    words = words[by_lane]
    first = np.searchsorted(written[by_lane], every)
    events = np.concatenate([*out_lanes, np.empty(0, np.int64)]).astype(np.int64)
    order = np.argsort(events, kind="stable")
    rank = np.empty(len(events), dtype=np.int64)
    rank[order] = np.arange(len(events)) - np.searchsorted(events[order], events[order])
    return np.concatenate([words[first], words[first + 1], words[first[events] + rank + 2]]
                          ).astype("<u4")


def decode(block: bytes) -> np.ndarray:
    """The ids of a block; raises ``Corrupt`` when a byte is wrong or missing."""
    if len(block) < _HEADER.size + 4 or zlib.crc32(block[:-4]) != struct.unpack(
            "<I", block[-4:])[0]:
        raise Corrupt("checksum of a token block")
    magic, version, count, bound, steps, n_words = _HEADER.unpack_from(block)
    if magic != MAGIC or version != VERSION:
        raise Corrupt("not a token block of this version")
    words = np.frombuffer(block, dtype="<u4", count=n_words, offset=_HEADER.size).astype(np.uint64)
    lanes = -(-count // steps)
    model = _Model(bound, decode=True)
    low = np.zeros(lanes, dtype=np.uint64)
    span = np.full(lanes, np.iinfo(np.uint64).max, dtype=np.uint64)
    code = words[:lanes] << _WORD | words[lanes:2 * lanes]
    taken = 2 * lanes
    grid = np.zeros((steps, lanes), dtype=np.int64)
    one_back = two_back = np.zeros(lanes, dtype=np.int64)
    for step in range(steps):
        live = lanes if (lanes - 1) * steps + step < count else lanes - 1
        if not live:
            break
        model.predict(one_back[:live], two_back[:live])
        part_low, part, part_code = low[:live], span[:live], code[:live]
        unit, offset = part >> np.uint64(MIX_BITS), part_code - part_low
        outcome = ((offset >= unit * model.mix_start.take(model.row + 1)).astype(np.int64)
                   + (offset >= unit * model.mix_start.take(model.row + 2)))
        _narrow(part_low, part, *model.mix_part(outcome), MIX_BITS)
        now = np.where(outcome == 0, model.id2, model.id1)
        new = np.flatnonzero(outcome == 2)
        where = (part_code[new] - part_low[new]) // (part[new] >> np.uint64(ZERO_BITS))
        found = model.zero_slot.take(where.astype(np.int64))
        now[new] = found
        start, width = np.zeros(live, np.uint64), np.full(live, _ZERO, np.uint64)
        start[new], width[new] = model.zero_start.take(found), model.zero_width.take(found)
        _narrow(part_low, part, start, width, ZERO_BITS)
        due, _ = _due(part_low, part)
        part_code[due] = part_code[due] << _WORD | words[taken:taken + len(due)]
        taken += len(due)
        grid[step, :live] = now
        model.learn(now, outcome, step)
        two_back, one_back = one_back, now
    return np.ascontiguousarray(grid.T).reshape(-1)[:count]
