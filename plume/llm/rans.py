"""Token ids in a static range asymmetric numeral system (rANS) archive.

Archive layout, all Parquet folders under one path:

* ``table``: (id, frequency), one shared table; frequencies add up to
  2**:data:`TABLE_BITS`, every id that occurs has at least 1;
* ``blocks``: (segment, block, first, n, payload, sections, crc32): blocks of
  :data:`BLOCK` ids, each coded by itself with :data:`LANES` interleaved
  coders; ``payload`` is the 24-bit words (little-endian) in the order the decoder reads
  them; ``sections`` holds a checkpoint (word offset and all coder states)
  every :data:`SECTION` ids, so that sections decode in parallel too;
  ``crc32`` is the checksum of the block's ids as little-endian 32-bit;
  ``pieces`` holds (doc_id, at, n): whose ids the block has, in order. Blocks by
  segment and number give the ids of all documents in ascending doc_id order.

Coder states are kept in [2**23, 2**47) and renormalised by 24-bit words.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BLOCK, LANES, SECTION = 1 << 16, 128, 1 << 14
TABLE_BITS = 20
_LOW_BITS, _WORD_BITS = 23, 24  # a word takes TABLE_BITS or more, so one renews any state
_LOW = 1 << _LOW_BITS
_SECTION_STEPS = SECTION // LANES


def quantise(counts: np.ndarray, bits: int = TABLE_BITS) -> np.ndarray:
    """Integer frequencies that add up to 2**bits, at least 1 for every id that occurs."""
    total, goal = int(counts.sum()), 1 << bits
    present = np.flatnonzero(counts)
    if not len(present):
        return np.zeros(len(counts), np.int64)
    if len(present) > goal:
        raise ValueError(f"{len(present)} different ids do not fit a table of 2**{bits}")
    out = np.zeros(len(counts), np.int64)
    exact = counts[present] * (goal / total)
    out[present] = np.maximum(1, np.floor(exact)).astype(np.int64)
    order = present[np.lexsort((present, -counts[present]))]
    excess = int(out.sum()) - goal
    if excess < 0:
        out[order[0]] -= excess
    for i in order:  # rare: many ids rounded up to 1
        if excess <= 0:
            break
        cut = min(excess, int(out[i]) // 2)
        out[i] -= cut
        excess -= cut
    while out.sum() > goal:
        out[order[int(np.argmax(out[order]))]] -= 1
    return out


@dataclass(frozen=True)
class Table:
    frequency: np.ndarray  # by id
    start: np.ndarray  # by id
    slot: np.ndarray  # id by slot

    @classmethod
    def of(cls, frequency: np.ndarray) -> Table:
        frequency = frequency.astype(np.int64)
        return cls(frequency, np.cumsum(frequency) - frequency,
                   np.repeat(np.arange(len(frequency), dtype=np.int32), frequency))


def encode(blocks: list[np.ndarray], t: Table) -> list[tuple[bytes, bytes, int]]:
    """(payload, sections, crc32) of each block; all blocks advance together, lane by lane.

    A short block is filled up with its own first id; the decoder knows ``n``.
    """
    if not blocks:
        return []
    n_blocks = len(blocks)
    steps = max(-(-len(b) // LANES) for b in blocks)
    ids = np.empty((n_blocks, steps * LANES), np.int64)
    for row, b in zip(ids, blocks, strict=True):
        row[:len(b)] = b
        row[len(b):] = b[0]
    ids = np.ascontiguousarray(ids.reshape(n_blocks, steps, LANES).transpose(1, 0, 2)).reshape(steps, -1)
    state = np.full(n_blocks * LANES, _LOW, np.int64)
    words, lanes, at_section = [], [], []
    for step in range(steps - 1, -1, -1):
        own = ids[step]
        f = t.frequency.take(own)
        full = state >= (f << (_LOW_BITS + _WORD_BITS - TABLE_BITS))
        lane = np.flatnonzero(full)
        words.append(state.take(lane).astype(np.uint32))
        lanes.append(lane)
        state >>= full.astype(np.int64) * _WORD_BITS
        quotient = (state / f).astype(np.int64)  # exact: states stay below 2**47
        state += quotient * ((1 << TABLE_BITS) - f) + t.start.take(own)
        if step % _SECTION_STEPS == 0:
            at_section.append((step // _SECTION_STEPS, len(words), state.reshape(n_blocks, LANES).copy()))
    # The decoder reads the steps forward, so words are stored last step first.
    owner = np.concatenate(lanes[::-1]) // LANES
    word = np.concatenate(words[::-1])
    order = np.argsort(owner.astype(np.uint16) if n_blocks < 1 << 16 else owner, kind="stable")
    word, bounds = word[order], np.searchsorted(owner[order], np.arange(n_blocks + 1))
    made = np.cumsum([np.zeros(n_blocks, np.int64), *[np.bincount(x // LANES, minlength=n_blocks) for x in lanes]],
                     axis=0)
    out = []
    for i, b in enumerate(blocks):
        payload = word[bounds[i]:bounds[i + 1]]
        marks = []
        for section, chunks, states in reversed(at_section):
            if section * SECTION < len(b):
                marks.append(np.int64(len(payload) - int(made[chunks][i])).tobytes() + states[i].tobytes())
        out.append((_three_bytes(payload), b"".join(marks), checksum(b)))
    return out


def _three_bytes(words: np.ndarray) -> bytes:
    return words.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def decode(blocks: list[tuple[bytes, bytes, int, int]], t: Table) -> list[np.ndarray]:
    """Ids of blocks given as (payload, sections, n, crc32); all sections of all blocks advance together."""
    size = 8 * (1 + LANES)
    words, offsets, states, owner, counts, base = [], [], [], [], [], 0
    for i, (payload, sections, n, _) in enumerate(blocks):
        own = np.frombuffer(payload, np.uint8).reshape(-1, 3).astype(np.int64) @ (1, 1 << 8, 1 << 16)
        for k in range(len(sections) // size):
            mark = np.frombuffer(sections, "<i8", 1 + LANES, k * size)
            offsets.append(base + int(mark[0]))
            states.append(mark[1:])
            owner.append(i)
            counts.append(min(SECTION, n - k * SECTION))
        words.append(own)
        base += len(own)
    word = np.concatenate([*words, np.zeros(1, np.int64)])
    n_rows = len(counts)
    state = np.concatenate([np.zeros(0, np.int64), *states])
    at, length = np.array(offsets, np.int64), np.array(counts, np.int64)
    steps = -(-int(length.max()) // LANES) if n_rows else 0
    ids = np.empty((steps, n_rows * LANES), np.int32)
    mask = (1 << TABLE_BITS) - 1
    for step in range(steps):
        slot = state & mask
        own = t.slot.take(slot)
        ids[step] = own
        state >>= TABLE_BITS
        state *= t.frequency.take(own)
        state += slot
        state -= t.start.take(own)
        lane = np.flatnonzero(state < _LOW)
        row = lane // LANES
        used = np.bincount(row, minlength=n_rows)
        # The k-th low lane of a row takes the row's k-th next word; a row past its end reads what nobody uses.
        source = np.arange(len(lane)) + (at - (np.cumsum(used) - used)).take(row)
        state[lane] = (state.take(lane) << _WORD_BITS) | word.take(source, mode="clip")
        at += used
    flat = ids.reshape(steps, n_rows, LANES).transpose(1, 0, 2).reshape(n_rows, -1)
    parts: list[list[np.ndarray]] = [[] for _ in blocks]
    for i, n, row in zip(owner, counts, flat, strict=True):
        parts[i].append(row[:n])
    out = []
    for (_, _, n, crc), own in zip(blocks, parts, strict=True):
        joined = np.concatenate([np.zeros(0, np.int32), *own])
        if len(joined) != n or checksum(joined) != crc:
            raise ValueError("a block's checksum does not match its ids")
        out.append(joined)
    return out


def crc32_combine(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings put together, from their crc32s and the second's length."""
    zeros = _zero_operators()
    bit = 0
    while length:
        if length & 1:
            first = _times(zeros[bit], first)
        length >>= 1
        bit += 1
    return first ^ second


def _times(matrix: list[int], vector: int) -> int:
    total, i = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


_operators: list[list[int]] = []


def _zero_operators() -> list[list[int]]:
    """Operator k appends 2**k zero bytes to a crc32, as a matrix over two elements."""
    if not _operators:
        own = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
        for _ in range(3):
            own = [_times(own, x) for x in own]
        for _ in range(48):
            _operators.append(own)
            own = [_times(own, x) for x in own]
    return _operators
