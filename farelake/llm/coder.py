"""Adaptive context-mixing range coder for token ids.

A sequence is cut into blocks of ``BLOCK`` ids. Every block starts from an empty
model; all blocks of a call are coded side by side, step by step, as lanes of
the same array operations.

The model of a block predicts the next id twice: the id that last followed the
same two ids (order 2), or else the same id (order 1). Whether it holds is one
binary decision, whose probability is mixed in the logistic domain from
adaptive estimates for how often the order-2 context held, how often the order-1
context held and agrees, and the last outcomes (order 0); the mixing weights
learn from every decision.

A wrong prediction is followed by the id itself under frequencies that are
counted and written once a segment: those after each of its most frequent ids
(order 1), without the wrong prediction, and by an escape those of all its ids
(order 0). A block can be decoded alone with its segment's tables. All
arithmetic is in integers.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096
EMPTY = (1 << 16) - 1              # no prediction; in frequency tables the escape; ids are below it
BITS1, BITS0 = 12, 16              # resolution of the frequencies of order 1 and 0
CONTEXTS = 255                     # ids with a table, at most
CELLS = 1 << 22                    # of the counts after them, at most
LEAST = 64                         # occurrences of an id with a table
CONTEXT_BITS = 11
PROB_BITS = 12
PART = 1 << 19                     # ids counted at once
STEPS = 64                         # of all lanes, coded at once
_U32 = np.uint64(0xFFFFFFFF)
_S32 = np.uint64(32)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)

_p = (np.arange(1 << PROB_BITS) + 0.5) / (1 << PROB_BITS)
STRETCH = np.round(np.log(_p / (1 - _p)) * 256).astype(np.int64)
HELD = np.array([*range(1, 16), 15, 0], np.int32)  # after 0 to 15 times; 0 where another id followed
_x = np.arange(-2047, 2048) / 256.0
SQUASH = np.clip(np.round((1 << PROB_BITS) / (1 + np.exp(-_x))), 1, (1 << PROB_BITS) - 1).astype(np.int64)


class _Model:
    """The adaptive state of all lanes. ``seen`` holds, for the contexts of order
    1 and then of order 2, a lane after the other, the id that followed and how
    often it held (4 bits); ``prob`` the estimates of order 0, 1 and 2 (16 bits)."""

    def __init__(self, lanes: int):
        every = np.arange(lanes)
        self.base = np.stack([every, every + lanes]) << CONTEXT_BITS
        self.seen = np.full(2 * lanes << CONTEXT_BITS, EMPTY << 4, np.int32)
        self.prob = np.full(3 * lanes * 32, 1 << 15, np.int64)
        self.prob_base = np.stack([every, every + lanes, every + 2 * lanes]) * 32
        self.weight = np.full((3, lanes), 22000, np.int64)
        self.outcomes = np.zeros(lanes, np.int64)
        self.key1, self.key2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)  # of the last id and the one before it
        self.last = np.zeros(lanes, np.int64)
        self.at, self.which = np.empty((2, lanes), np.int64), np.empty((3, lanes), np.int64)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For the first ``n`` lanes: the predicted id and its probability."""
        at, which = self.at[:, :n], self.which[:, :n]
        np.right_shift(self.key1[:n], 3, out=at[0])
        np.bitwise_xor(self.key1[:n], self.key2[:n], out=at[1])
        at[1] >>= 2
        at &= (1 << CONTEXT_BITS) - 1
        at += self.base[:, :n]
        self.was = self.seen.take(at)
        id1, id2 = self.was >> 4
        have = id2 != EMPTY
        guess = np.where(have, id2, id1)
        which[0] = self.outcomes[:n]
        np.bitwise_and(self.was, 15, out=which[1:])
        which[1] += (id1 == guess) * np.int64(16)
        which[2] += have * np.int64(16)
        which += self.prob_base[:, :n]
        self.given = self.prob.take(which)
        self.stretched = STRETCH.take(self.given >> (16 - PROB_BITS))
        x, y, z = self.weight[:, :n] * self.stretched
        x += y
        x += z
        x >>= 16
        x += 2047
        self.mixed = SQUASH.take(x, mode="clip")
        return guess, self.mixed

    def update(self, n: int, ids: np.ndarray, hit: np.ndarray) -> None:
        self.stretched *= hit * np.int64(1 << PROB_BITS) - self.mixed
        self.stretched >>= 10
        self.weight[:, :n] += self.stretched
        self.prob[self.which[:, :n]] = self.given + (hit * np.int64((1 << 16) - 1) - self.given >> 5)
        now = (ids << 4).astype(np.int32)
        self.seen[self.at[:, :n]] = now + HELD.take((self.was - now).view(np.uint32), mode="clip")
        outcomes = self.outcomes[:n]
        outcomes <<= 1
        outcomes &= 15
        outcomes |= hit
        np.multiply(self.last[:n], 60493, out=self.key2[:n])
        np.multiply(ids, 40503, out=self.key1[:n])
        self.last[:n] = ids


class _Tables:
    """The frequencies of a segment. ``ids1`` and ``freq1`` are the entries of
    the order-1 tables, one after another, each table's escape first; table 0 is
    an escape alone."""

    def __init__(self, contexts: np.ndarray, sizes: np.ndarray, ids1: np.ndarray, freq1: np.ndarray, ids0: np.ndarray, freq0: np.ndarray):
        self.contexts, self.sizes, self.ids1, self.freq1, self.ids0, self.freq0 = contexts, sizes, ids1, freq1, ids0, freq0
        table = np.repeat(np.arange(len(sizes)), sizes)
        self.cum1 = np.cumsum(freq1) - freq1 - (table << BITS1)
        self.cum0 = np.cumsum(freq0) - freq0
        self.escape1 = ids1 == EMPTY
        # where an id's entry is: a row for each table, a column for each id
        self.code = np.zeros(EMPTY + 1, np.int64)
        self.code[ids0] = np.arange(len(ids0))
        self.row = np.zeros(EMPTY + 1, np.int64)       # of the id before
        self.row[contexts] = np.arange(1, len(contexts) + 1) * len(ids0)
        self.entry = np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), len(ids0))
        real = ~self.escape1
        self.entry[table[real] * len(ids0) + self.code[ids1[real]]] = np.flatnonzero(real)

    @classmethod
    def of(cls, ids: np.ndarray, size: int) -> "_Tables":
        """The tables of a sequence in blocks of ``size`` ids."""
        count = np.bincount(ids, minlength=EMPTY + 1)
        distinct = np.flatnonzero(count)
        code = np.zeros(EMPTY + 1, np.int64)
        code[distinct] = np.arange(len(distinct))
        most = max(min(CONTEXTS, CELLS // len(distinct) - 1), 0)
        contexts = distinct[np.lexsort((distinct, -count[distinct]))][:most]
        contexts = np.sort(contexts[count[contexts] >= LEAST])
        row = np.zeros(EMPTY + 1, np.int64)
        row[contexts] = np.arange(1, len(contexts) + 1) * len(distinct)
        n = np.zeros((len(contexts) + 1) * len(distinct), np.int64)
        for a in range(0, len(ids), PART):
            now = ids[a:a + PART]
            before = ids[a - 1:a - 1 + len(now)] if a else np.append(EMPTY, now[:-1])
            of_row = row[before]
            of_row[-a % size::size] = 0      # a block's first id follows none
            np.add.at(n, of_row + code[now], 1)
        n = n.reshape(len(contexts) + 1, -1)
        total = n.sum(axis=1)
        held = (n > 1) & (n << (BITS1 - 1) >= total[:, None])
        held[0] = False
        table, col = np.nonzero(held)
        sizes = held.sum(axis=1) + 1
        freq = 1 + n[table, col] * ((1 << BITS1) - sizes[table]) // total[table]
        at = np.arange(len(table)) + table + 1
        ids1, freq1 = np.full(int(sizes.sum()), EMPTY), np.zeros(int(sizes.sum()), np.int64)
        ids1[at], freq1[at] = distinct[col], freq
        freq1[np.cumsum(sizes) - sizes] = (1 << BITS1) - np.bincount(table, weights=freq, minlength=len(sizes)).astype(np.int64)
        n[held] = 0
        rest = n.sum(axis=0)
        freq0 = 1 + rest * ((1 << BITS0) - len(distinct)) // max(int(rest.sum()), 1)
        freq0[np.argmax(freq0)] += (1 << BITS0) - freq0.sum()
        return cls(contexts, sizes, ids1, freq1, distinct, freq0)

    def dump(self) -> bytes:
        sizes = np.array([len(self.sizes), len(self.ids1), len(self.ids0)], "<u4").tobytes()
        return zlib.compress(sizes + b"".join(x.astype("<u4").tobytes() for x in (self.contexts, self.sizes, self.ids1, self.freq1, self.ids0, self.freq0)))

    @classmethod
    def load(cls, data: bytes) -> "_Tables":
        x = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
        k, n1, n0 = x[:3].tolist()
        return cls(*np.split(x[3:], np.cumsum([k - 1, k, n1, n1, n0])))

    def without(self, row: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of predictions that are wrong: where they lie in the tables and how much they take there."""
        e = self.entry.take(row + self.code.take(guess))
        return self.cum1.take(e), self.freq1.take(e) * ((guess != EMPTY) & ~self.escape1.take(e))


def _grid(ids: np.ndarray, lanes: int, size: int) -> np.ndarray:
    """(time, lanes) of a sequence."""
    out = np.zeros(lanes * size, np.uint16)
    out[:len(ids)] = ids
    return np.ascontiguousarray(out.reshape(lanes, size).T)


def encode(ids: np.ndarray) -> tuple[bytes, list[bytes]]:
    """The tables and the blocks of a sequence of ids below 65,535."""
    if not len(ids):
        return b"", []
    ids = np.asarray(ids)
    if int(ids.max()) >= EMPTY:
        raise ValueError(f"ids must be below {EMPTY}")
    lanes = -(-len(ids) // BLOCK)
    size = min(BLOCK, len(ids))
    tail = len(ids) - (lanes - 1) * size
    tables, grid, model = _Tables.of(ids, size), _grid(ids, lanes, size), _Model(lanes)
    every = np.arange(lanes)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, _TOP)
    digits, used = np.zeros((lanes, size * 3 // 2 + 8), np.uint32), np.zeros(lanes, np.int64)

    def put(at: np.ndarray | slice, step: np.ndarray, part: np.ndarray) -> None:
        """Narrow the interval of the lanes ``at``; a carry goes into the digits before."""
        new = low[at] + step
        over = new < step
        if over.any():
            over = every[at][over]
            back = 1
            while len(over):
                digits[over, used[over] - back] += np.uint32(1)
                over = over[digits[over, used[over] - back] == 0]
                back += 1
        out = (part <= _U32).nonzero()[0]
        if len(out):
            go = every[at][out]
            digits[go, used[go]] = new[out] >> _S32
            used[go] += 1
            new[out] <<= _S32
            part[out] <<= _S32
        low[at], width[at] = new, part

    last = np.full((1, lanes), EMPTY)
    for first in range(0, size, STEPS):
        now = grid[first:first + STEPS].astype(np.int64)
        guess, p = np.full(now.shape, EMPTY), np.ones(now.shape, np.int64)
        for t in range(len(now)):
            n = lanes if first + t < tail else lanes - 1
            guess[t, :n], p[t, :n] = model.predict(n)
            model.update(n, now[t, :n], guess[t, :n] == now[t, :n])
        # what the model leaves to the tables
        hit = guess == now
        miss = np.flatnonzero(~hit)
        row, x = tables.row.take(np.concatenate([last, now[:-1]]).ravel()[miss]), tables.code.take(now.ravel()[miss])
        last = now[-1:]
        e = tables.entry.take(row + x)
        gone, taken = tables.without(row, guess.ravel()[miss])
        total, cum, freq = np.ones(hit.shape, np.uint64), np.zeros(hit.shape, np.uint64), np.ones(hit.shape, np.uint64)
        c = tables.cum1.take(e)
        total.ravel()[miss], cum.ravel()[miss], freq.ravel()[miss] = (1 << BITS1) - taken, c - taken * (c > gone), tables.freq1.take(e)
        split = np.where(hit, 0, p).view(np.uint64)
        share = np.where(hit, p, (1 << PROB_BITS) - p).view(np.uint64)
        new = tables.escape1.take(e)
        x, (step, lane) = x[new], np.divmod(miss[new], lanes)
        cum0, freq0 = tables.cum0.take(x).view(np.uint64), tables.freq0.take(x).view(np.uint64)
        ends = np.searchsorted(step, np.arange(len(now) + 1))
        for t in range(len(now)):
            n = lanes if first + t < tail else lanes - 1
            part = width[:n] >> np.uint64(PROB_BITS)
            at = part * split[t, :n]
            part *= share[t, :n]
            part //= total[t, :n]
            at += part * cum[t, :n]
            part *= freq[t, :n]
            put(slice(0, n), at, part)
            a, b = ends[t], np.searchsorted(lane[ends[t]:ends[t + 1]], n) + ends[t]
            if a < b:
                part = width[lane[a:b]] >> np.uint64(BITS0)
                put(lane[a:b], part * cum0[a:b], part * freq0[a:b])
    for shift in (_S32, np.uint64(0)):
        digits[every, used] = (low >> shift) & _U32
        used += 1
    return tables.dump(), [digits[i, :used[i]].astype("<u4").tobytes() for i in range(lanes)]


def decode(head: bytes, blocks: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of consecutive blocks, ``n_ids`` in all."""
    lanes = len(blocks)
    if not lanes:
        return np.zeros(0, np.int64)
    tables, model = _Tables.load(head), _Model(lanes)
    size = min(BLOCK, n_ids)
    tail = n_ids - (lanes - 1) * size
    longest = max(map(len, blocks)) // 4 + 4
    digits = np.zeros((lanes, longest), np.uint32)
    for i, b in enumerate(blocks):
        digits[i, :len(b) // 4] = np.frombuffer(b, "<u4")
    code, width = digits[:, 0].astype(np.uint64) << _S32 | digits[:, 1], np.full(lanes, _TOP)
    flat, used = digits.ravel(), np.arange(lanes) * longest + 2
    slots1 = np.repeat(np.arange(len(tables.ids1), dtype=np.int32), tables.freq1)
    slots0 = np.repeat(np.arange(len(tables.ids0), dtype=np.int32), tables.freq0)
    start = np.zeros(EMPTY + 1, np.int64)
    start[tables.contexts] = np.arange(1, len(tables.contexts) + 1) << BITS1
    every = np.arange(lanes)

    def leave(at: np.ndarray | slice, rest: np.ndarray, part: np.ndarray) -> None:
        """What the lanes ``at`` hold within their intervals, narrowed to ``part``."""
        out = (part <= _U32).nonzero()[0]
        if len(out):
            go = every[at][out]
            rest[out] = rest[out] << _S32 | flat.take(used[go], mode="clip")
            used[go] += 1
            part[out] <<= _S32
        code[at], width[at] = rest, part

    grid = np.zeros((size, lanes), np.uint16)
    last = np.full(lanes, EMPTY)
    for t in range(size):
        n = lanes if t < tail else lanes - 1
        guess, p = model.predict(n)
        now = guess.astype(np.int64)
        part, rest = width[:n] >> np.uint64(PROB_BITS), code[:n].copy()
        split = part * p.view(np.uint64)
        hit = rest < split
        miss = (~hit).nonzero()[0]
        part = np.where(hit, split, (part << np.uint64(PROB_BITS)) - split)
        new = miss[:0]
        if len(miss):
            before = last.take(miss)
            gone, taken = tables.without(tables.row.take(before), guess.take(miss))
            total = (1 << BITS1) - taken
            left, inner = rest.take(miss) - split.take(miss), part.take(miss) // total.view(np.uint64)
            value = np.minimum((left // inner).view(np.int64), total - 1)
            e = slots1.take(start.take(before) + value + taken * (value >= gone))
            cum = tables.cum1.take(e)
            rest[miss] = left - inner * (cum - taken * (cum > gone)).view(np.uint64)
            part[miss] = inner * tables.freq1.take(e).view(np.uint64)
            now[miss] = got = tables.ids1.take(e)
            new = miss[got == EMPTY]
        leave(slice(0, n), rest, part)
        if len(new):
            part, rest = width.take(new) >> np.uint64(BITS0), code.take(new)
            e = slots0.take(np.minimum((rest // part).view(np.int64), (1 << BITS0) - 1))
            leave(new, rest - part * tables.cum0.take(e).view(np.uint64), part * tables.freq0.take(e).view(np.uint64))
            now[new] = tables.ids0.take(e)
        model.update(n, now, hit)
        grid[t, :n] = last[:n] = now
    return grid.T.ravel()[:n_ids].astype(np.int32)


# ---------------------------------------------------------------------------
# a segment: tables, then blocks with their lengths and checksums
# ---------------------------------------------------------------------------

MAGIC = b"FLTOK3\0\0"


def pack(ids: np.ndarray) -> bytes:
    """Magic, ids, blocks, bytes and CRC-32 of the tables; for each block its
    ids, bytes and CRC-32; the tables; the blocks."""
    tables, blocks = encode(ids)
    size = min(BLOCK, len(ids)) or 1
    head = np.array([[min(size, len(ids) - i * size), len(b), zlib.crc32(b)] for i, b in enumerate(blocks)], "<u4")
    return (MAGIC + np.array([len(ids), len(blocks), len(tables), zlib.crc32(tables)], "<u8").tobytes() + head.tobytes()
            + tables + b"".join(blocks))


def _head(segment: bytes) -> tuple[int, np.ndarray, bytes, int]:
    """Ids, the blocks' rows, the tables, and where the blocks begin."""
    if segment[:8] != MAGIC:
        raise ValueError("not a token segment")
    n_ids, n_blocks, n_tables, crc = (int(x) for x in np.frombuffer(segment, "<u8", 4, 8))
    head = np.frombuffer(segment, "<u4", 3 * n_blocks, 40).reshape(n_blocks, 3)
    at = 40 + 12 * n_blocks
    tables = segment[at:at + n_tables]
    if zlib.crc32(tables) != crc:
        raise ValueError("tables: wrong checksum")
    return n_ids, head, tables, at + n_tables


def unpack(segment: bytes) -> np.ndarray:
    """The ids of a segment. Raises where a checksum is wrong."""
    n_ids, head, tables, at = _head(segment)
    blocks = []
    for i, (_, n, crc) in enumerate(head.tolist()):
        blocks.append(segment[at:at + n])
        if zlib.crc32(blocks[-1]) != crc:
            raise ValueError(f"block {i}: wrong checksum")
        at += n
    return decode(tables, blocks, n_ids)


def unpack_block(segment: bytes, block: int) -> np.ndarray:
    """One block alone, by the segment's tables."""
    _, head, tables, at = _head(segment)
    at += int(head[:block, 1].astype(np.int64).sum())
    body = segment[at:at + int(head[block, 1])]
    if zlib.crc32(body) != int(head[block, 2]):
        raise ValueError(f"block {block}: wrong checksum")
    return decode(tables, [body], int(head[block, 0]))
