"""CRC-32 of many byte spans at once, from tables indexed by position.

CRC-32 is linear over XOR: a byte's share of the checksum depends on the byte
and on its distance from the end alone, the start value's share on the length
alone. ``TABLE[d, b]`` is the share of byte ``b`` at distance ``d``; the shares
of a span are XORed by ``bitwise_xor.reduceat``, and the constant of its length
is added. Spans longer than ``BLOCK`` bytes are cut into blocks from their end;
a block's checksum is moved over the bytes behind it by ``BLOCK`` zero bytes at a time.
"""

from __future__ import annotations

import numpy as np

#: Distances in the table; longer spans are folded block by block.
BLOCK = 64
#: The reflected polynomial of CRC-32 (fixed value).
POLYNOMIAL = 0xEDB88320


def _tables() -> tuple[np.ndarray, np.ndarray]:
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
    table = np.empty((BLOCK + 4, 256), np.uint32)
    table[0] = one
    for d in range(1, BLOCK + 4):   # one zero byte further from the end
        table[d] = one[table[d - 1] & 0xFF] ^ (table[d - 1] >> 8)
    start = np.empty(BLOCK + 1, np.uint32)
    start[0] = 0xFFFFFFFF
    for n in range(1, BLOCK + 1):   # the start value after n zero bytes
        start[n] = one[start[n - 1] & 0xFF] ^ (start[n - 1] >> 8)
    return table, start


TABLE, START = _tables()
_FLAT = TABLE[:BLOCK].ravel()


def _over_block(state: np.ndarray) -> np.ndarray:
    """States moved over ``BLOCK`` zero bytes: byte k of a state acts like a
    message byte at distance BLOCK - 1 - k."""
    return (TABLE[BLOCK - 1, state & 0xFF] ^ TABLE[BLOCK - 2, (state >> 8) & 0xFF]
            ^ TABLE[BLOCK - 3, (state >> 16) & 0xFF] ^ TABLE[BLOCK - 4, state >> 24])


def _shares(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XOR of the shares of each span; every length is 1 to ``BLOCK``."""
    first = np.concatenate(([0], np.cumsum(length[:-1])))
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    at = np.repeat(start, length) + within
    index = ((np.repeat(length, length) - 1 - within) << 8) | data[at]
    return np.bitwise_xor.reduceat(_FLAT[index], first)


def crc32_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 (unsigned) of ``data[start[i]:end[i]]`` for every i; ``data`` holds
    bytes. Empty spans have checksum 0."""
    start, end = np.asarray(start, np.int64), np.asarray(end, np.int64)
    length = end - start
    out = np.zeros(len(start), np.uint32)
    short = np.flatnonzero((length > 0) & (length <= BLOCK))
    if len(short):
        n = length[short]
        out[short] = _shares(data, start[short], n) ^ START[n] ^ np.uint32(0xFFFFFFFF)
    long = np.flatnonzero(length > BLOCK)
    if len(long):
        out[long] = _folded(data, start[long], length[long])
    return out


def _folded(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Long spans: their first, shorter block with the start value, then block
    by block over all spans that still have one, longest spans first."""
    blocks = (length - 1) // BLOCK          # whole blocks behind the first one
    head = length - blocks * BLOCK
    order = np.argsort(-blocks, kind="stable")
    start, blocks, head = start[order], blocks[order], head[order]
    state = _shares(data, start, head) ^ START[head]
    at = start + head
    alive = len(blocks)
    done = 0
    while alive:
        state[:alive] = _over_block(state[:alive]) ^ _shares(data, at[:alive], np.full(alive, BLOCK, np.int64))
        at[:alive] += BLOCK
        done += 1
        alive = int(np.searchsorted(-blocks, -done, side="left"))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out
