"""Blocks of token ids, coded by mixed predictions and an arithmetic coder.

A block is cut into lanes of neighbouring ids that are coded side by side, one id of every lane a
step, so each step is a few array operations. All lanes share one model, which starts anew with the
block and learns from a step's ids when the step is done; the decoder does the same with the ids it
has read, so both always hold the same numbers. All of the model is whole numbers. Frequencies of order 0 are
counted in each step, and their sums, by which ids are coded, are renewed after every eighth.

The model mixes three predictions. The ids before (two, order 2, and one, order 1) each name the id
that last followed them, with a confidence; how often either name was right at these confidences
gives both their weights. What they leave is shared out by the frequencies of order 0, so
every id has a part of the coder's interval.

The coder is a carry-less range coder with a 64-bit state, which gives out 16 bits at a time.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANE = 256  # ids of a lane in a full block
LANES = 4096
BLOCK = LANE * LANES
HEAD = "<4sIII"  # magic, ids, lanes, crc32 of the ids
HEAD_SIZE = struct.calcsize(HEAD)
MAGIC = b"TKB2"
SLOTS = 1 << 18  # contexts of order 2, by hash
BITS, FIRM = 3, 7  # of a confidence, and the highest one
SCALE = 16  # bits of the weights of the named ids
PARTS = 22  # further bits, by which ids that are not named share what is left
EAGER, EVERY = 32, 8  # order 0 is summed up after each of the first steps, and then after each of these
FIRSTS = 16  # bits of the table that finds ids by counts
STEP = 16  # that an id gains in frequency; a block's frequencies add up to less than 2 ** 25
TOP, NARROW, STATE = np.uint64(1 << 48), np.uint64(1 << 44), np.uint64((1 << 64) - 1)
UNIT, WORD, ONE, TOP_SHIFT = np.uint64(SCALE + PARTS), np.uint64(16), np.uint64(1), np.uint64(48)


class Model:
    """Frequencies of ids, the ids named by their contexts, and how often these were right.

    A context's entry is the id it names and, in the last bits, how firmly it does so. Entries of order 1
    stand before those of order 2; both orders are read and written together, as two rows.
    """

    def __init__(self, size: int, lanes: int):
        self.size = size
        self.frequency = np.ones(size, np.int32)
        self.upto = np.arange(size + 1, dtype=np.int32)
        self.firsts, self.steps = None, 0
        self.entries = np.zeros(size + 1 + SLOTS, np.int32)
        self.seen = np.tile([1, 1, 2], ((FIRM + 1) ** 2 * 2, 1))  # right by order 2, by order 1, by neither
        self.at = np.empty((2, lanes), np.int64)
        self.older = self.last = np.full(lanes, size)

    def name(self) -> tuple[np.ndarray, ...]:
        """For each lane the ids named by order 2 and order 1, and the parts of the first and of both."""
        slot = self.older * 0x9E3779B1
        slot += self.last * 0x85EBCA6B
        slot >>= 7
        slot &= SLOTS - 1
        self.at[0] = self.last
        np.add(slot, self.size + 1, out=self.at[1])
        self.found = self.entries.take(self.at)
        self.firm = self.found & FIRM
        one, two = self.named = self.found >> BITS
        state = self.firm[1] << BITS + 1
        state += self.firm[0] << 1
        state += one == two
        self.state = state.astype(np.int64)
        right, every = self.seen[:, :2] * ((1 << SCALE) - 64), self.seen.sum(axis=1)
        first, second = right[:, 0] // every, right[:, 1] // every
        second[1::2] = 0  # both name the same id
        both = first + second
        self.shares = ((1 << SCALE) - both << PARTS) // int(self.upto[-1])
        return two, one, (first << PARTS).take(self.state), (both << PARTS).take(self.state)

    def learn(self, ids: np.ndarray, left: np.ndarray) -> None:
        """Take in a step's ids; ``left``: those that were not named."""
        hits = self.named == ids
        kind = np.where(hits[1], 0, 2 - hits[0])
        kind += self.state * 3
        self.seen += np.bincount(kind, minlength=self.seen.size).reshape(self.seen.shape)
        missed = np.where(self.firm > 0, self.found - 1, ids << BITS)
        self.entries[self.at] = np.where(hits, np.minimum(self.found + 1, self.found | FIRM), missed)
        np.add.at(self.frequency, left, np.int32(STEP))
        self.steps += 1
        if self.steps <= EAGER or self.steps % EVERY == 0:
            np.cumsum(self.frequency, out=self.upto[1:])
            self.firsts = None
        self.older, self.last = self.last, ids.astype(np.int64)

    def share(self, lanes: np.ndarray) -> np.ndarray:
        """What a count of one weighs in these lanes, among ids that are not named."""
        return self.shares.take(self.state.take(lanes))

    def part(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where the counts of these ids begin, how many they are) in the sums of order 0."""
        begin = self.upto.take(ids)
        return begin, self.upto.take(ids + 1) - begin

    def holder(self, counts: np.ndarray) -> np.ndarray:
        """The ids in whose part of all counts these lie."""
        counts = np.minimum(counts, np.uint64(self.upto[-1] - 1)).astype(np.int32)
        if self.firsts is None:  # the ids that hold the counts at even distances
            self.shift = max(0, int(self.upto[-1]).bit_length() - FIRSTS)
            edges = self.upto + ((1 << self.shift) - 1) >> self.shift
            self.firsts = np.repeat(np.arange(self.size), np.diff(edges))
        found = self.firsts.take(counts >> self.shift)
        rest = np.flatnonzero(counts >= self.upto.take(found + 1))
        found[rest] = self.upto.searchsorted(counts[rest], "right") - 1
        return found


class Coder:
    """The state of every lane: where its interval starts and how wide it is."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, STATE, np.uint64)

    def narrow(self, start: np.ndarray, width: np.ndarray) -> None:
        """Go on to the part (start, width) of every lane, and ``move`` the words that are settled."""
        unit = self.range >> UNIT
        self.low += unit * start.view(np.uint64)
        self.range = unit * width.view(np.uint64)
        lanes, low, size = None, self.low, self.range
        while True:
            settled = (low ^ (low + size)) < TOP
            go = (settled | (size < NARROW)).nonzero()[0]
            if not len(go):
                return
            lanes = go if lanes is None else lanes.take(go)
            low, size, settled = low.take(go), size.take(go), settled.take(go)
            loose = (~settled).nonzero()[0]  # an interval that is narrow but not settled ends at the next multiple
            size[loose] = (~low[loose] + ONE) & (NARROW - ONE)
            self.move(lanes, low)
            low <<= WORD
            size <<= WORD
            self.low[lanes], self.range[lanes] = low, size


class Writer(Coder):
    """Gives out the settled words, lane by lane."""

    def __init__(self, lanes: int, steps: int):
        super().__init__(lanes)
        self.words = np.zeros((lanes, steps + 8), np.uint16)
        self.count = np.zeros(lanes, np.int64)

    def move(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.count.take(lanes)
        if at.max() >= self.words.shape[1]:
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)
        self.words[lanes, at] = low >> TOP_SHIFT
        self.count[lanes] = at + 1

    def finish(self) -> tuple[np.ndarray, bytes]:
        """(words of every lane, all words lane by lane)."""
        lanes = np.arange(len(self.low))
        for _ in range(4):
            self.move(lanes, self.low)
            self.low = self.low << WORD
        return self.count, self.words[np.arange(self.words.shape[1]) < self.count[:, None]].tobytes()


class Reader(Coder):
    """Takes in the words of every lane as they are needed."""

    def __init__(self, counts: np.ndarray, words: np.ndarray):
        super().__init__(len(counts))
        self.words = np.append(words, np.zeros(4, np.uint16)).astype(np.uint64)
        self.next = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.code = np.zeros(len(counts), np.uint64)
        for _ in range(4):
            self.move(np.arange(len(counts)), self.low)

    def move(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.next.take(lanes)
        self.code[lanes] = self.code.take(lanes) << WORD | self.words.take(at, mode="clip")
        self.next[lanes] = at + 1

    def place(self) -> np.ndarray:
        """Where every lane's code stands in its interval."""
        return ((self.code - self.low) // (self.range >> UNIT)).view(np.int64)


def encode_block(ids: np.ndarray, size: int) -> bytes:
    """``ids`` (each below ``size``) as a block of bytes: head, words of every lane, words."""
    lanes = max(1, -(-len(ids) // LANE))
    steps = -(-len(ids) // lanes)
    grid = np.zeros(lanes * steps, np.int32)
    grid[: len(ids)] = ids
    model, writer = Model(size, lanes), Writer(lanes, steps)
    for now in np.ascontiguousarray(grid.reshape(lanes, steps).T):
        two, one, first, both = model.name()
        hit_two = now == two
        hit_one = now == one
        start, width = np.where(hit_two, 0, first), np.where(hit_two, first, both - first)
        plain = np.flatnonzero(~(hit_two | hit_one))
        left = now[plain].astype(np.int64)
        if len(plain):
            share = model.share(plain)
            begin, many = model.part(left)
            start[plain], width[plain] = both.take(plain) + share * begin, share * many
        writer.narrow(start, width)
        model.learn(now, left)
    counts, words = writer.finish()
    raw = np.ascontiguousarray(ids, "<u4").tobytes()
    body = struct.pack(HEAD, MAGIC, len(ids), lanes, zlib.crc32(raw)) + counts.astype("<u4").tobytes() + words
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(block: bytes, size: int) -> np.ndarray:
    """The ids of a block; ValueError where a check sum does not fit."""
    if len(block) < HEAD_SIZE + 4 or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("a block of token ids is damaged")
    magic, count, lanes, check = struct.unpack_from(HEAD, block)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    counts = np.frombuffer(block, "<u4", lanes, HEAD_SIZE).astype(np.int64)
    words = np.frombuffer(block, "<u2", int(counts.sum()), HEAD_SIZE + 4 * lanes)
    steps = -(-count // lanes)
    grid = np.zeros((steps, lanes), np.int32)
    model, reader = Model(size, lanes), Reader(counts, words)
    for now in grid:
        two, one, first, both = model.name()
        place = reader.place()
        hit_two = place < first
        now[:] = np.where(hit_two, two, one)
        start, width = np.where(hit_two, 0, first), np.where(hit_two, first, both - first)
        plain = np.flatnonzero(place >= both)
        left = plain
        if len(plain):
            share, named = model.share(plain), both.take(plain)
            left = model.holder((place.take(plain) - named).view(np.uint64) // share.view(np.uint64))
            begin, many = model.part(left)
            start[plain], width[plain] = named + share * begin, share * many
            now[plain] = left
        reader.narrow(start, width)
        model.learn(now, left)
    ids = grid.T.ravel()[:count].astype("<u4")
    if zlib.crc32(ids.tobytes()) != check:
        raise ValueError("ids of a block do not fit their check sum")
    return ids
