"""Word boundaries and 64-bit word hashes for a whole Arrow string column at once.

An Arrow string column is one run of UTF-8 bytes plus offsets. The helpers
work on that run with numpy, so no Python object is made per word:

* a byte table says which bytes belong to words, a second one folds bytes
  (lower-casing) before they are hashed;
* the hash of a word is a difference of two prefix sums of
  ``byte * BASE**position`` (mod 2**64), moved back to position 0 with the
  inverse of ``BASE``, then mixed with the word's length.

Long columns are handled in pieces of about ``PIECE`` bytes that end between
words, so working memory stays a small multiple of ``PIECE`` whatever the
length of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
BASE = 0x9E3779B97F4A7C15
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL reads as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHasher:
    """Words of texts as hashes; ``word``: which bytes form words, ``fold``: byte map.

    With ``stems`` every word also has the hashes of its first bytes, as many
    as each number says (all of them if it is shorter), in columns.
    """

    def __init__(self, word: np.ndarray, fold: np.ndarray, stems: tuple[int, ...] = ()):
        self.word, self.fold, self.stems = word, fold.astype(np.uint64), stems
        self._grow(1 << 10)

    def _grow(self, n: int) -> None:
        one = np.ones(n, np.uint64)
        with np.errstate(over="ignore"):
            for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                steps = one * np.uint64(base)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def _piece(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(data)
        if n > len(self.powers):
            self._grow(max(n, 2 * len(self.powers)))
        inside = self.word[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        before[cuts] = False
        after[cuts - 1] = False
        start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.fold[data] * self.powers[:n], out=sums[1:])
        ends = [end, *(np.minimum(start + k, end) for k in self.stems)]
        hashes = [mix((sums[e] - sums[start]) * self.inverse[start] + (e - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) for e in ends]
        return start, end, np.stack(hashes, axis=1) if self.stems else hashes[0]

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and hash of every word; no word crosses an offset."""
        starts, ends, hashes, at, n = [], [], [], 0, len(data)
        while at < n:
            stop = min(n, at + PIECE)
            while stop < n:  # move the end of the piece to the next byte between words
                gap = np.flatnonzero(~self.word[data[stop : stop + PIECE]])
                if len(gap):
                    stop += int(gap[0])
                    break
                stop = min(n, stop + PIECE)
            lo, hi = np.searchsorted(offsets, (at, stop))
            s, e, h = self._piece(data[at:stop], offsets[lo:hi] - at)
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(h)
            at = stop
        if not starts:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(np.uint64)
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def ascii_lower() -> np.ndarray:
    fold = np.arange(256)
    fold[65:91] += 32
    return fold


def plain_words() -> WordHasher:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    word = np.ones(256, bool)
    word[list(SPACES)] = False
    return WordHasher(word, ascii_lower())


def runs_of_rows(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about ``limit`` bytes each (one row may hold more)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, min(stop, n)
        at = min(stop, n)
