"""Range asymmetric numeral system coding of token ids.

A segment holds about ``SEGMENT_TOKENS`` ids with one frequency table that all
its blocks share. A block holds whole documents and is coded on its own by
``LANES`` interleaved states, the i-th id by state i modulo the lanes. States
stay in [2^31, 2^63) and give or take one 32-bit word at a time. Every so many
steps a checkpoint keeps the states and the place in the words, so that
decoding can start there, and a checksum guards the words up to the next one.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LANES = 1024
BLOCK_TOKENS = 1 << 19
SEGMENT_TOKENS = 1 << 21
CHECKPOINT_STEPS = 256
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


class CorruptBlock(ValueError):
    """A block's words do not match their checksum."""


@dataclass(frozen=True)
class Table:
    """Frequencies of the symbols that occur, which add up to 2^bits."""

    bits: int
    symbols: np.ndarray
    freqs: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.freqs) - self.freqs


def make_table(ids: np.ndarray) -> Table:
    """Scaled frequencies of ``ids``; each that occurs keeps at least one slot."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    bits = max(12, int(4 * len(symbols)).bit_length())
    freqs = np.maximum(counts * (1 << bits) // max(1, counts.sum()), 1).astype(np.int64)
    over = int(freqs.sum()) - (1 << bits)
    for at in np.argsort(-freqs, kind="stable"):
        if over == 0:
            break
        # The commonest symbols give or take what rounding left.
        change = min(over, int(freqs[at]) // 2) if over > 0 else over
        freqs[at] -= change
        over -= change
    return Table(bits, symbols.astype(np.uint32), freqs.astype(np.uint32))


@dataclass(frozen=True)
class Block:
    """Coded ids: words, and states, place and checksum at each checkpoint."""

    n: int
    lanes: int
    words: bytes
    states: bytes
    places: tuple[int, ...]
    checksums: tuple[int, ...]


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES) -> Block:
    """Code ids from the last to the first, so that they are decoded in order."""
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    at = np.zeros(int(table.symbols[-1]) + 1 if n else 0, np.uint32)
    at[table.symbols] = np.arange(len(table.symbols))
    at = at[ids]
    freqs = table.freqs.astype(np.uint64)[at]
    starts = table.starts.astype(np.uint64)[at]
    scale, room = np.uint64(1 << table.bits), np.uint64(63 - table.bits)
    state = np.full(lanes, _LOW, np.uint64)
    chunks: list[np.ndarray] = []
    states: list[np.ndarray] = []
    given: list[int] = []
    total = 0
    for step in range(steps - 1, -1, -1):
        lo, hi = step * lanes, min(n, (step + 1) * lanes)
        f, x = freqs[lo:hi], state[: hi - lo]
        full = np.flatnonzero(x >= (f << room))
        out = x[full]
        chunks.append(out.astype(np.uint32))
        total += len(out)
        x[full] = out >> _WORD
        whole = x // f
        # whole * 2^bits + x mod f + the symbol's first slot
        x += whole * (scale - f) + starts[lo:hi]
        if step % CHECKPOINT_STEPS == 0:
            states.append(state.copy())
            given.append(total)
    words = np.concatenate(chunks[::-1]).astype("<u4") if chunks else np.zeros(0, "<u4")
    places = [total - x for x in reversed(given)]
    ends = [*places[1:], total]
    return Block(
        n,
        lanes,
        words.tobytes(),
        np.concatenate(states[::-1]).astype("<u8").tobytes() if states else b"",
        tuple(places),
        tuple(zlib.crc32(words[a:b].tobytes()) for a, b in zip(places, ends)),
    )


def symbol_of_slot(table: Table) -> np.ndarray:
    """Index of the symbol that owns each of the 2^bits slots."""
    return np.repeat(np.arange(len(table.symbols), dtype=np.uint32), table.freqs)


def decode_span(block: Block, table: Table, owner: np.ndarray, span: int) -> np.ndarray:
    """Ids from one checkpoint to the next, without the rest of the block."""
    words = np.frombuffer(block.words, "<u4")
    place = block.places[span]
    stop = block.places[span + 1] if span + 1 < len(block.places) else len(words)
    words = words[place:stop]
    if zlib.crc32(words.tobytes()) != block.checksums[span]:
        raise CorruptBlock(f"span {span} of a block of {block.n} ids")
    words = words.astype(np.uint64)
    lanes = block.lanes
    size = 8 * lanes
    state = np.frombuffer(block.states[span * size : (span + 1) * size], "<u8").copy()
    first = span * CHECKPOINT_STEPS * lanes
    last = min(block.n, first + CHECKPOINT_STEPS * lanes)
    found = np.empty(last - first, np.uint32)
    freqs, starts = table.freqs.astype(np.uint64), table.starts.astype(np.uint64)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    taken = 0
    for lo in range(0, last - first, lanes):
        hi = min(lo + lanes, last - first)
        x = state[: hi - lo]
        slot = x & mask
        at = owner[slot]
        found[lo:hi] = at
        x = freqs[at] * (x >> bits) + slot - starts[at]
        low = np.flatnonzero(x < _LOW)
        x[low] = (x[low] << _WORD) | words[taken : taken + len(low)]
        taken += len(low)
        state[: hi - lo] = x
    return table.symbols[found]


def decode_block(block: Block, table: Table, owner: np.ndarray) -> np.ndarray:
    """All ids of a block."""
    spans = [decode_span(block, table, owner, k) for k in range(len(block.places))]
    return np.concatenate(spans) if spans else np.zeros(0, np.uint32)
