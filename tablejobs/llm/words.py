"""Hashes of the words of many texts at once, taken from the bytes of an Arrow column.

Words are what white space parts, as ``str.split`` sees it. Nothing is done per word in Python and no word is
remembered, so neither time nor memory depends on how many different words there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PRIME = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text a worker takes apart at once; arrays over their words take some thirty times as much.
PART = 1_000_000
#: Bytes of a word that are hashed eight at a time; the few longer words are hashed one by one.
_SHORT = 64
_SPACE, _DIGIT, _LEAD = 1, 2, 3

_kinds = np.zeros(256, np.uint8)
_kinds[[*range(9, 14), *range(28, 33)]] = _SPACE
_kinds[48:58] = _DIGIT
#: Bytes that begin the white space beyond ASCII: U+0085, U+00A0, U+1680, U+2000-200A, 2028, 2029, 202F, 205F, 3000.
_kinds[[0xC2, 0xE1, 0xE2, 0xE3]] = _LEAD
#: The first so many bytes of eight.
_first = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64; different values stay different."""
    values = values * _ODD
    values ^= values >> np.uint64(32)
    values *= _PRIME
    values ^= values >> np.uint64(29)
    return values


def _mark_wide_spaces(data: np.ndarray, kinds: np.ndarray) -> None:
    lead = np.flatnonzero(kinds == _LEAD)
    kinds[lead] = 0
    first, second = data[lead], data[np.minimum(lead + 1, len(data) - 1)]
    two = lead[(first == 0xC2) & ((second == 0x85) | (second == 0xA0))]
    third = data[np.minimum(lead + 2, len(data) - 1)]
    last = (second.astype(np.uint16) << 8) | third
    general = (first == 0xE2) & (
        ((last >= 0x8080) & (last <= 0x808A)) | (last == 0x80A8) | (last == 0x80A9) | (last == 0x80AF) | (last == 0x819F)
    )
    three = lead[general | ((first == 0xE1) & (last == 0x9A80)) | ((first == 0xE3) & (last == 0x8080))]
    for places, length in ((two, 2), (three, 3)):
        for k in range(length):
            kinds[places + k] = _SPACE


class Words:
    """Words of texts (null: none): ``hashes``, whose lowest bit says whether the word has a digit, and where they lie.

    The words of text i are ``hashes[texts[i]:texts[i + 1]]``. Lines, parted by line breaks, are numbered over all
    texts: ``lines`` has the word each one begins with and at the end the number of words, ``first`` the first line of
    each text and at the end the number of lines.
    """

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string())
        if column.null_count:
            column = pc.fill_null(column, "")
        count = len(column)
        _, offsets, data = column.buffers()
        edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + count + 1] if count else np.zeros(1, np.int64)
        size = int(edges[-1] - edges[0])
        padded = np.zeros((size // 8 + 3) * 8, np.uint8)
        if size:
            padded[:size] = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        data = padded[:size]
        kinds = _kinds[data]
        if size:
            _mark_wide_spaces(data, kinds)
        inside = kinds != _SPACE
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        borders = edges[(edges > 0) & (edges < size)]
        begins[borders] = inside[borders]
        stops[borders - 1] = inside[borders - 1]
        starts = np.flatnonzero(begins)
        lengths = np.flatnonzero(stops) + 1 - starts
        self.hashes = _hashes(padded, starts, lengths)
        self.hashes &= ~np.uint64(1)
        digits = np.searchsorted(starts, np.flatnonzero(kinds == _DIGIT), "right") - 1
        self.hashes[digits] |= np.uint64(1)

        breaks = np.flatnonzero(data == 10)
        self.texts = np.searchsorted(starts, edges)
        self.first = np.searchsorted(breaks, edges) + np.arange(count + 1)
        self.lines = np.empty(count + len(breaks) + 1, np.int64)
        others = np.ones(len(self.lines), bool)
        others[self.first] = False
        self.lines[self.first] = self.texts
        self.lines[others] = np.searchsorted(starts, breaks)

    def without(self, dropped: pa.Array) -> Words:
        """The words that are left without some lines of each text: lists of their numbers, or null."""
        numbers = dropped.flatten().to_numpy(zero_copy_only=False)
        if len(numbers):
            sizes = pc.fill_null(pc.list_value_length(dropped), 0).to_numpy(zero_copy_only=False)
            kept = np.ones(len(self.lines) - 1, bool)
            kept[np.repeat(self.first[:-1], sizes) + numbers] = False
            kept = np.repeat(kept, np.diff(self.lines))
            before = np.concatenate([[0], np.cumsum(kept)])
            self.hashes, self.texts, self.lines = self.hashes[kept], before[self.texts], before[self.lines]
        return self


def _hashes(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    eights = padded.view("<u8")

    def part(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Up to eight bytes from each place on, of which ``left`` belong to the word."""
        place, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        found = (eights[place] >> shift) | ((eights[place + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        return found & _first[np.minimum(left, 8)]

    found = mixed(part(starts, lengths) ^ (lengths.astype(np.uint64) * _PRIME))
    some = np.flatnonzero(lengths > 8)
    for k in range(8, _SHORT, 8):
        found[some] = mixed(found[some] ^ part(starts[some] + k, lengths[some] - k))
        some = some[lengths[some] > k + 8]
    for i in some.tolist():
        found[i] = xxhash.xxh64_intdigest(padded[starts[i] : starts[i] + lengths[i]])
    return found


def lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    """Values dealt to one list after another."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)
