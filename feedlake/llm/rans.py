"""Static range asymmetric numeral system for token ids.

Segment layout (little-endian)::

    4s  magic "RTK1"
    u32 probability bits, u32 lanes, u32 block tokens, u32 steps between checkpoints
    u64 tokens, u32 symbols, u32 blocks, u32 points
    u32  size of the table, then zlib of u32[symbols] gaps of symbols and u32[symbols]
         frequencies, all lowest bytes first, then all second ones, ...; shared by all blocks
    u32[blocks]  crc32 of the block's ids (u32 each)
    u64[points]  word offset, u64[points * lanes] lane states
    u32          crc32 of all bytes so far
    u32[...]     words of all blocks

Token j of a block belongs to lane j mod lanes, step j div lanes; a step's
lanes that renormalise read one word each, in lane order.  Blocks are
independent.  A checkpoint holds what a decoder needs to begin at its step, so
every checkpoint of every block can be decoded at once (here: one NumPy row
each) or by itself.  The last block is padded with the first symbol.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"RTK1"
LANES = 128
BLOCK_TOKENS = 65_536
CHECKPOINT_STEPS = 256
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
_HEAD = struct.Struct("<4sIIIIQIII")


def frequencies(counts: np.ndarray, bits: int) -> np.ndarray:
    """Positive frequencies that sum to 2^bits, near in proportion to positive counts."""
    total = 1 << bits
    freq = np.maximum(1, (counts.astype(np.float64) * (total / counts.sum())).astype(np.int64))
    short = total - int(freq.sum())
    if short > 0:
        freq[np.argmax(freq)] += short
    while short < 0:
        spare = np.minimum(freq - 1, np.maximum(1, (freq * (-short / freq.sum())).astype(np.int64)))
        order = np.argsort(-freq, kind="stable")
        taken = np.minimum(np.cumsum(spare[order]), -short)
        freq[order] -= np.diff(taken, prepend=0)
        short = total - int(freq.sum())
    return freq


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct ids, index of each id among them, counts), without a sort where ids are small."""
    if not len(ids) or ids.max() >= 1 << 24:
        return np.unique(ids, return_inverse=True, return_counts=True)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    index = np.zeros(len(counts), dtype=np.int32)
    index[symbols] = np.arange(len(symbols))
    return symbols, index[ids], counts[symbols]


def encode(ids: np.ndarray, lanes: int = LANES, block_tokens: int = BLOCK_TOKENS,
           checkpoint_steps: int = CHECKPOINT_STEPS) -> bytes:
    """One segment; ``ids`` are unsigned 32-bit integers, none at all included."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    n = len(ids)
    symbols, index, counts = _distinct(ids)
    bits = max(16, len(symbols).bit_length() + 5)
    n_blocks = -(-n // block_tokens)
    steps = -(-n // (max(n_blocks, 1) * lanes))
    block = steps * lanes
    points = -(-steps // checkpoint_steps) if n else 0
    head = [_HEAD.pack(MAGIC, bits, lanes, block, checkpoint_steps, n, len(symbols), n_blocks, points * n_blocks)]
    if not n:
        return head[0] + struct.pack("<I", zlib.crc32(head[0]))
    freq = frequencies(counts, bits)
    start = np.concatenate(([0], np.cumsum(freq)[:-1]))
    limit = np.where(freq < 1 << bits, freq << (63 - bits), np.iinfo(np.int64).max)
    padded = np.zeros(n_blocks * block, dtype=np.int32)
    padded[:n] = index
    by_step = np.ascontiguousarray(padded.reshape(n_blocks, steps, lanes).transpose(1, 0, 2)).reshape(steps, -1)
    words = np.zeros(by_step.shape, dtype=np.uint32)
    emits = np.zeros(by_step.shape, dtype=bool)
    states = np.zeros((points, n_blocks * lanes), dtype=np.uint64)
    x = np.full(n_blocks * lanes, LOW, dtype=np.int64)
    for t in range(steps - 1, -1, -1):
        s = by_step[t].astype(np.intp)
        f = freq[s]
        full = x >= limit[s]
        emits[t] = full
        words[t] = x.astype(np.uint32)
        x = np.where(full, x >> 32, x)
        # x < 2^63 and x / f < 2^47: the quotient of doubles is off by one at most
        q = (x / f).astype(np.int64)
        r = x - q * f
        q += (r >= f).astype(np.int64) - (r < 0)
        x = (q << bits) + (x - q * f) + start[s]
        if t % checkpoint_steps == 0:
            states[t // checkpoint_steps] = x
    per_block = lambda a: a.reshape(a.shape[0], n_blocks, lanes).transpose(1, 0, 2)
    emits = per_block(emits)
    before = np.concatenate(([0], np.cumsum(emits.sum(axis=2).ravel())))[:-1].reshape(n_blocks, steps)
    crcs = [zlib.crc32(ids[k * block:(k + 1) * block].tobytes()) for k in range(n_blocks)]
    table = zlib.compress(np.concatenate([np.diff(symbols.astype(np.int64), prepend=0), freq]).astype("<u4")
                          .view(np.uint8).reshape(-1, 4).T.tobytes())
    head += [struct.pack("<I", len(table)), table, np.array(crcs, "<u4").tobytes(),
             before[:, ::checkpoint_steps].astype("<u8").tobytes(), per_block(states).astype("<u8").tobytes()]
    top = b"".join(head)
    return top + struct.pack("<I", zlib.crc32(top)) + per_block(words)[emits].astype("<u4").tobytes()


def decode(data: bytes, first: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``first`` up to ``stop`` of a segment; reads only the checkpoints that hold them.

    Raises ValueError if the header, a whole decoded block or a final state doesn't check.
    """
    if len(data) < _HEAD.size + 4:
        raise ValueError("not a token segment: too short")
    magic, bits, lanes, block, every, n, n_symbols, n_blocks, n_points = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    try:
        table = take("u1", int(take("<u4", 1)[0])).tobytes() if n else b""
        crcs, offsets, states = take("<u4", n_blocks), take("<u8", n_points), take("<u8", n_points * lanes)
        header = struct.unpack_from("<I", data, at)[0]
    except (ValueError, struct.error) as short:
        raise ValueError("token segment: cut off") from short
    if header != zlib.crc32(data[:at]):
        raise ValueError("token segment: header checksum differs")
    words = np.frombuffer(data, "<u4", offset=at + 4).astype(np.uint64)
    stop = n if stop is None else min(stop, n)
    if first >= stop:
        return np.empty(0, np.uint32)
    planes = np.ascontiguousarray(np.frombuffer(zlib.decompress(table), np.uint8).reshape(4, -1).T).view("<u4").ravel()
    symbols, freq = np.cumsum(planes[:n_symbols]).astype(np.uint32), planes[n_symbols:].astype(np.uint64)
    steps = block // lanes
    per_block = n_points // n_blocks
    span = every * lanes
    lo = first // block * per_block + first % block // span
    hi = (stop - 1) // block * per_block + (stop - 1) % block // span + 1
    length = np.minimum(every, steps - np.arange(lo, hi) % per_block * every)
    start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    symbol_of = np.repeat(np.arange(n_symbols, dtype=np.int32), freq.astype(np.int64))
    x = states.reshape(n_points, lanes)[lo:hi].astype(np.uint64)
    at_word = offsets[lo:hi].astype(np.int64)
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    out = np.zeros((hi - lo, min(every, steps), lanes), dtype=np.uint32)
    for t in range(int(length.max())):
        on = slice(None) if t < length.min() else np.flatnonzero(length > t)
        state, pointer = x[on], at_word[on]
        slot = state & mask
        s = symbol_of[slot.astype(np.int64)]
        out[on, t] = symbols[s]
        state = freq[s] * (state >> shift) + slot - start[s]
        low = state < LOW
        rank = np.cumsum(low, axis=1)
        read = (pointer[:, None] + rank - 1)[low]
        if len(read) and read.max() >= len(words):
            raise ValueError("token segment: words run out")
        state[low] = (state[low] << WORD) | words[read]
        x[on], at_word[on] = state, pointer + rank[:, -1]
    ends = np.arange(lo, hi) % per_block == per_block - 1
    if (x[ends] != LOW).any():
        raise ValueError("token segment: a lane does not end in its first state")
    flat = out.reshape(hi - lo, -1)
    ids = np.concatenate([flat[k, :length[k] * lanes] for k in range(hi - lo)]) if length.min() < out.shape[1] else flat.ravel()
    base = lo // per_block * block + lo % per_block * span
    for k in range(-(-base // block), n_blocks):
        a, b = k * block - base, min((k + 1) * block, n) - base
        if b > len(ids):
            break
        if zlib.crc32(np.ascontiguousarray(ids[a:b], "<u4").tobytes()) != crcs[k]:
            raise ValueError(f"token segment: checksum of block {k} differs")
    return ids[first - base:stop - base]
