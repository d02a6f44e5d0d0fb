"""Canonical length-limited Huffman codes over numpy arrays.

Codes are numbered by (length, symbol), so their lengths alone describe them.
A block is decoded from many checkpoints at once: every ``spacing`` symbols its
bit offset is known, and one table lookup per symbol advances all of them.
"""

import numpy as np

LONGEST = 20


def code_lengths(counts, longest=LONGEST):
    """Code length of each symbol, 0 where it doesn't occur (package-merge).

    Of all codes with no length over ``longest``, one with the fewest bits.
    A single symbol gets one bit.
    """
    counts = np.asarray(counts, np.int64)
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} symbols don't fit codes of {longest} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used]
    # At each level: the single symbols merged with pairs of the level below.
    # An item is known by its rank; is_pair says which of the two it is.
    merged, is_pair = weights, [np.zeros(len(used), bool)]
    for _ in range(longest - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        is_pair.append(order >= len(weights))
    # Of the last level the first 2n - 2 items are chosen; a chosen pair chooses two items below.
    depth, chosen = np.zeros(len(used), np.int64), 2 * len(used) - 2
    for level in reversed(is_pair):
        pairs = int(level[:chosen].sum())
        depth[: chosen - pairs] += 1
        chosen = 2 * pairs
    lengths[used] = depth
    return lengths


def codes_of(lengths):
    """Canonical code of each symbol with a length, as unsigned integers."""
    codes = np.zeros(len(lengths), np.uint64)
    symbols = np.flatnonzero(lengths)
    symbols = symbols[np.lexsort((symbols, lengths[symbols]))]
    if len(symbols):
        wide = np.uint64(1) << (np.uint64(LONGEST) - lengths[symbols].astype(np.uint64))
        start = np.concatenate([[np.uint64(0)], np.cumsum(wide)[:-1]])
        codes[symbols] = start >> (np.uint64(LONGEST) - lengths[symbols].astype(np.uint64))
    return codes


def decode_table(lengths):
    """For every next ``LONGEST`` bits: symbol << 8 | code length."""
    symbols = np.flatnonzero(lengths)
    symbols = symbols[np.lexsort((symbols, lengths[symbols]))]
    table = np.zeros(1 << LONGEST, np.uint32)
    filled = np.repeat((symbols << 8 | lengths[symbols]).astype(np.uint32), 1 << (LONGEST - lengths[symbols].astype(np.int64)))
    table[: len(filled)] = filled
    return table


def encode_block(ids, codes, lengths, spacing):
    """(bytes, bit offset of every ``spacing``-th symbol) of some ids."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # each code, moved to its place within two 32-bit words
    words = codes[ids] << (64 - (starts & 31) - sizes).astype(np.uint64)
    word = starts >> 5
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    packed = np.bitwise_or.reduceat(words, first)
    out = np.zeros((int(ends[-1]) >> 5) + 2, np.uint32)
    out[word[first]] |= (packed >> np.uint64(32)).astype(np.uint32)
    out[word[first] + 1] |= (packed & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out.astype(">u4").tobytes(), starts[::spacing]


def decode_block(packed, offsets, count, table, spacing):
    """The ids of a block from its bytes and checkpoints."""
    window = np.ndarray((len(packed) - 3,), ">u4", packed, strides=(1,))
    at = offsets.astype(np.int64)
    out = np.empty((spacing, len(at)), np.uint32)
    shift = np.uint32(32 - LONGEST)
    for k in range(spacing):
        here = np.minimum(at >> 3, len(window) - 1)
        bits = (window[here].astype(np.uint32) << (at & 7).astype(np.uint32)) >> shift
        found = table[bits]
        out[k] = found >> np.uint32(8)
        at = at + (found & np.uint32(255))
    return out.T.reshape(-1)[:count]
