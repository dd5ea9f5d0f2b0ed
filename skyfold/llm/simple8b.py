"""Simple-8b: runs of integers in 64-bit words, coded and decoded with numpy.

The four high bits of a word select how many values it holds and in how many bits each; a word takes as many of the
next values as fit. Values of 2^60 and more are escapes: their word only marks the place, and the values follow the
words of the block, in order. All words of one selector are packed or unpacked at once.
"""

from __future__ import annotations

import numpy as np

#: Values in a word by selector; each has 60 // count bits. ESCAPE holds one value outside the word.
COUNTS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BITS = 60 // COUNTS
ESCAPE = 15
_HELD = np.ones(16, np.int64)
_HELD[: len(COUNTS)] = COUNTS


def _longest_fit(values: np.ndarray) -> np.ndarray:
    """Selector of the longest run from each place that fits into a word."""
    n = len(values)
    width = np.full(n + 64, 0, np.uint8)
    width[:n] = np.frexp(values.astype(np.float64))[1]
    widest = {1: width}
    for k in (2, 4, 8, 16, 32):
        half = widest[k // 2]
        widest[k] = np.maximum(half, np.concatenate((half[k // 2 :], np.zeros(k // 2, np.uint8))))
    selector = np.full(n, ESCAPE, np.uint8)
    for s, (k, bits) in enumerate(zip(COUNTS.tolist(), BITS.tolist(), strict=True)):
        base = 1 << (k.bit_length() - 1)
        most = np.maximum(widest[base][:n], widest[base][k - base : k - base + n])
        selector[most <= bits] = s
    return selector


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, escaped values)`` of unsigned integers."""
    values = np.asarray(values, np.uint64)
    selector = _longest_fit(values)
    steps = _HELD[selector].tolist()
    starts, at, n = [], 0, len(values)
    while at < n:
        starts.append(at)
        at += steps[at]
    places = np.array(starts, np.int64)
    chosen = selector[places]
    padded = np.concatenate((values, np.zeros(60, np.uint64)))
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (k, bits) in enumerate(zip(COUNTS.tolist(), BITS.tolist(), strict=True)):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            run = padded[places[rows][:, None] + np.arange(k)] << (np.arange(k) * bits).astype(np.uint64)
            words[rows] |= np.bitwise_or.reduce(run, axis=1)
    return words, values[places[chosen == ESCAPE]]


def decode(words: np.ndarray, escaped: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` values of the words, as unsigned 64-bit integers."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    held = _HELD[selector]
    begins = np.cumsum(held) - held
    out = np.empty(int(held.sum()), np.uint64)
    for s, (k, bits) in enumerate(zip(COUNTS.tolist(), BITS.tolist(), strict=True)):
        rows = np.flatnonzero(selector == s)
        if len(rows):
            mask = np.uint64((1 << bits) - 1)
            out[begins[rows][:, None] + np.arange(k)] = (words[rows][:, None] >> (np.arange(k) * bits).astype(np.uint64)) & mask
    out[begins[selector == ESCAPE]] = escaped
    return out[:count]


def pack(values: np.ndarray, block: int) -> tuple[list[bytes], np.ndarray]:
    """Blocks of ``block`` values each, and for each ``(byte offset, words, escapes, values)``."""
    chunks, index, offset = [], [], 0
    for at in range(0, len(values), block):
        part = values[at : at + block]
        words, escaped = encode(part)
        chunks += [words.astype("<u8").tobytes(), escaped.astype("<u8").tobytes()]
        index.append((offset, len(words), len(escaped), len(part)))
        offset += 8 * (len(words) + len(escaped))
    return chunks, np.array(index, "<u8").reshape(-1, 4)


def unpack(data: memoryview, index: np.ndarray) -> np.ndarray:
    """All values of the blocks that ``index`` lists."""
    out = []
    for offset, n_words, n_escaped, count in index.astype(np.int64).tolist():
        both = np.frombuffer(data, "<u8", n_words + n_escaped, offset)
        out.append(decode(both[:n_words], both[n_words:], count))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)
