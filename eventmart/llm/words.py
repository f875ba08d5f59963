"""Words of many texts at once: places and 64-bit hashes, in NumPy.

The hash of a word is a polynomial of its bytes modulo 2^64, mixed; it is read off
prefix sums, so the cost does not depend on how many words there are.  Equal words
have equal hashes; users of the hashes must not rely on the converse.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a text beyond it is cut between words.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end) of ``data``, all within a slice."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    low = int(starts[0])
    part = data[low : int(ends.max())]
    up, down = powers(max(len(part), SLICE))
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
    return mixed((sums[ends - low] - sums[starts - low]) * down[starts - low])


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a sequence from the hashes of its first part and of its last word."""
    return mixed(left * np.uint64(0xD6E8FEB86659FD93) + (right ^ (right >> np.uint64(17))))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    padded = np.zeros(len(mask) + 2, np.int8)
    padded[1:-1] = mask
    steps = np.diff(padded)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow column of texts and the n + 1 offsets into them; null is empty."""
    column = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"").cast(pa.large_binary())
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, count=n + 1 + column.offset)[column.offset :] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def groups(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE`` bytes together, one text at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def words(data: np.ndarray, in_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end, hash) of each word of the texts between ``offsets``.

    ``data``: bytes in the form that is hashed; ``in_word``: for each of the 256
    bytes whether it belongs to words.  Places are those of ``data``.
    """
    low, high = int(offsets[0]), int(offsets[-1])
    letters = in_word[data[low:high]]
    # A text's start cuts: words never cross texts.
    first = np.zeros(len(letters) + 1, bool)
    first[offsets[:-1][offsets[:-1] < high] - low] = True
    before = np.concatenate(([False], letters[:-1])) if len(letters) else letters
    after = np.concatenate((letters[1:], [False])) if len(letters) else letters
    starts = np.flatnonzero(letters & (~before | first[:-1])) + low
    ends = np.flatnonzero(letters & (~after | first[1:])) + low + 1
    texts = np.searchsorted(offsets, starts, "right") - 1
    found, at = [], 0
    while at < len(starts):
        upto = max(int(np.searchsorted(ends, starts[at] + SLICE, "right")), at + 1)
        found.append(hashes(data, starts[at:upto], ends[at:upto]))
        at = upto
    return texts, starts, ends, np.concatenate(found) if found else np.zeros(0, np.uint64)
