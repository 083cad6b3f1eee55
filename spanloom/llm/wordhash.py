"""Vectorised tokenising and n-gram hashing of Arrow string columns, used inside tasks.

Texts stay UTF-8 bytes: a word is a maximal run of word bytes, so the byte tables below are the two
word classes of the contracts (their separators are all ASCII).  All hashes are 64-bit and do not
depend on the process, the batch or the machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text handled at once: bounds the working arrays, whatever the batch holds.
CHUNK_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = U64(0xD1342543DE82EF95)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))
_BYTE_CODES = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_powers = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(size, base, U64)
            steps[0] = U64(1)
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


class WordClass:
    """Which bytes belong to words, and what each byte is read as."""

    def __init__(self, is_word: np.ndarray, lower: bool):
        self.is_word = is_word
        self.fold = np.arange(256, dtype=np.uint8)
        if lower:
            self.fold[65:91] += 32
        self.codes = _BYTE_CODES[self.fold]


def _bytes_except(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = False
    return table


_NOT_BLANK = _bytes_except((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x20\x09-\x0D]+`` as it stands.
PLAIN = WordClass(_NOT_BLANK, lower=False)
#: The same words with A-Z lower-cased.
PLAIN_LOWER = WordClass(_NOT_BLANK, lower=True)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits, letters and all non-ASCII.
ALNUM_LOWER = WordClass(_bytes_except((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)), lower=True)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of consecutive rows ``first_row .. first_row + n_rows``."""

    data: np.ndarray  # the bytes, one blank after each row
    starts: np.ndarray  # byte positions in data
    ends: np.ndarray
    row_word: np.ndarray  # first word of each row, and the end: n_rows + 1 entries
    row: np.ndarray  # row of each word, from 0
    first_row: int
    row_byte: np.ndarray  # first byte of each row in data, and the end
    kind: WordClass

    @property
    def n_rows(self) -> int:
        return len(self.row_word) - 1

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        if not len(self.starts):
            return np.zeros(0, U64)
        pow_, inv = powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum(self.kind.codes[self.data] * pow_[:-1], out=sums[1:])
        return mix64((sums[self.ends] - sums[self.starts]) * inv[self.starts] + (self.ends - self.starts).astype(U64))

    def text(self, word: int) -> str:
        return bytes(self.data[self.starts[word] : self.ends[word]]).decode()


def _tokenise(data: np.ndarray, offsets: np.ndarray, first_row: int, kind: WordClass) -> Words:
    n = len(offsets) - 1
    spaced = np.insert(data, offsets[1:], 0x20)
    inside = kind.is_word[spaced]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    row_byte = offsets + np.arange(n + 1)
    row_word = np.searchsorted(starts, row_byte)
    row = np.repeat(np.arange(n), np.diff(row_word))
    return Words(spaced, starts, ends, row_word, row, first_row, row_byte, kind)


def tokenised(column, kind: WordClass, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """The rows of a string column as word tables of about chunk_bytes each; a row is never cut."""
    data, offsets = text_buffers(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1)
        yield _tokenise(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], row, kind)
        row = stop


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, rows not looked at; len(hashes) - n + 1 entries (or none)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    pow_, inv = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * pow_[:-1], out=sums[1:])
    return mix64((sums[n:] - sums[:-n]) * inv[:m] + U64(n))


def same_row(row: np.ndarray, n: int) -> np.ndarray:
    """Whether the n words that start at each position lie in one row."""
    m = len(row) - n + 1
    return row[:m] == row[n - 1 :] if m > 0 else np.zeros(0, bool)


def sliding(best, x: np.ndarray, width: int) -> np.ndarray:
    """best (np.minimum or np.maximum) over each width consecutive values."""
    span = 1
    while span * 2 <= width:
        x = best(x[:-span], x[span:])
        span *= 2
    return best(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def winnow(hashes: np.ndarray, row: np.ndarray, k: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: the k-grams that are the minimum of a window of span words.

    Returns their positions, their hashes and, for each position, the minimum of the window that
    starts there (0 where no window of one row does).  Any two equal spans keep the same k-grams.
    """
    width = span - k + 1
    m = len(hashes) - span + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    grams = np.maximum(ngram_hashes(hashes, k), U64(1))
    least = sliding(np.minimum, grams, width)[:m]
    least = np.where(same_row(row, span), least, U64(0))
    around = np.concatenate((np.zeros(width - 1, U64), least, np.zeros(width - 1, U64)))
    kept = np.flatnonzero(sliding(np.maximum, around, width) == grams)
    return kept, grams[kept], least
