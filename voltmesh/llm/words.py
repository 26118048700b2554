"""Words and their 64-bit hashes, taken from the UTF-8 bytes of whole Arrow columns with numpy.

Separators are ASCII, so bytes can be classified without decoding. Work is done in runs of
rows of about a quarter of a MB, and longer texts are cut at separators, so memory follows the run and
the number of words of one text, never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 18
#: For steps that sum up or learn by run.
LONG_RUN_BYTES = 1 << 21
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)

#: Bytes between words, for words [^\x20\x09-\x0D]+.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Every byte but digits, letters and those of characters beyond ASCII.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[0x30:0x3A] = NOT_ALNUM[0x41:0x5B] = NOT_ALNUM[0x61:0x7B] = False
NOT_ALNUM[0x80:] = False
#: A-Z to a-z, all other bytes kept.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, RUN_BYTES + 1)
        have = np.full(size, np.uint64(base))
        have[0] = 1
        have = np.multiply.accumulate(have, dtype=np.uint64)
        if size <= LONG_RUN_BYTES + 1:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _hash_piece(raw: np.ndarray, fresh: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of raw; fresh: positions at which another text begins."""
    n = len(raw)
    keep = ~sep[raw]
    begin = keep.copy()
    begin[1:] &= ~keep[:-1]
    end = keep.copy()
    end[:-1] &= ~keep[1:]
    inner = fresh[(fresh > 0) & (fresh < n)]
    begin[inner] = keep[inner]
    end[inner - 1] = keep[inner - 1]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if not len(s):
        return s, np.empty(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * _power(_ODD, n), out=total[1:])
    return s, mix((total[e] - total[s]) * _power(_INVERSE, n)[s])


def _cuts(raw: np.ndarray, sep: np.ndarray, run_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of about run_bytes that end at separators."""
    at = 0
    while at < len(raw):
        to = at + run_bytes
        while to < len(raw) and not (hit := np.flatnonzero(sep[raw[to : to + run_bytes]])).size:
            to += run_bytes
        to = min(len(raw), to + int(hit[0]) if to < len(raw) else to)
        yield at, to
        at = to


def text_column(column: pa.Array) -> pa.Array:
    """As large strings without null: a null has no words, as an empty text."""
    return column.cast(pa.large_string()).fill_null("")


def hashed_words(column: pa.Array, sep: np.ndarray, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the words of a run of rows, offsets of each row into them)."""
    column = text_column(column)
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + run_bytes, "right")) - 1)
        raw, bounds = data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        if to == row + 1 and len(raw) > run_bytes:
            parts = [_hash_piece(raw[a:b], np.empty(0, np.int64), sep)[1] for a, b in _cuts(raw, sep, run_bytes)]
            hashes = np.concatenate(parts)
            yield row, hashes, np.array([0, len(hashes)])
        else:
            starts, hashes = _hash_piece(raw, bounds[:-1], sep)
            yield row, hashes, np.searchsorted(starts, bounds)
        row = to


def ranges_hashed(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the words from first to before last, for each of many ranges of one array."""
    n = len(words)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(words) * _power(_ODD, n), out=total[1:])
    return mix((total[last] - total[first]) * _power(_INVERSE, n + 1)[first])


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words of one text, repeats included; of all its words if they are fewer, though not none."""
    if not len(words):
        return words
    k_here = min(k, len(words))
    n = len(words) - k_here + 1
    out = words[:n].copy()
    for j in range(1, k_here):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[j : j + n])
    return out if k_here == k else mix(out + np.uint64(k_here))
