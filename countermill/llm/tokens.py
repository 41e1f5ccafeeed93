"""Token ids of whole text columns by a word-splitting BPE tokenizer file.

Most texts go a short way: pieces (letter runs, single digits, other runs) are found with
numpy over the bytes, and each distinct piece is tokenised once per worker. A text that the
short way might cut otherwise than the tokenizer itself (letters beyond U+00FF, special
tokens, contractions, control characters) is given to the tokenizer whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from countermill.llm.wordhash import _BYTE, _power_tables, mix, slices, text_buffers

#: Distinct pieces kept per worker before the table starts anew.
CACHE_PIECES = 1_500_000

_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[0x30:0x3A] = _DIGIT
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = _LETTER

#: Bytes of texts that go the long way: control characters and lead bytes other than that
#: of U+00C0 to U+00FF.
_LONG = np.zeros(256, dtype=bool)
_LONG[[*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F]] = True
_LONG[0xC0:] = True
_LONG[0xC3] = False


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class TextTokens:
    """Tokenises text columns with one tokenizer file; keeps the pieces it has met."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.place: dict[int, int] = {}
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.first = np.zeros(CACHE_PIECES + 2, dtype=np.int64)
        self.used = 0

    def _add(self, key: int, piece: bytes) -> int:
        found = [t.id for t in self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, piece)))]
        at = len(self.place)
        if self.used + len(found) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(found)), dtype=np.uint32)))
        self.ids[self.used : self.used + len(found)] = found
        self.used += len(found)
        self.first[at + 1] = self.used
        self.place[key] = at
        return at

    def whole(self, text: bytes) -> np.ndarray:
        """By the tokenizer itself."""
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=np.uint32)

    def _long_rows(self, data: np.ndarray, at: np.ndarray, lowered: np.ndarray) -> np.ndarray:
        odd = _LONG[data]
        after = data[1:]
        odd[:-1] |= (data[:-1] == 0xC3) & ((after == 0x97) | (after == 0xB7))
        kind = _KIND[lowered[1:]]
        odd[:-1] |= (data[:-1] == 0x27) & (kind == _LETTER)
        sums = np.concatenate(([0], np.cumsum(odd)))
        rows = sums[at[1:]] > sums[at[:-1]]
        raw = data.tobytes()
        for special in self.specials:
            found = raw.find(special)
            while found >= 0:
                rows[np.searchsorted(at, found, side="right") - 1] = True
                found = raw.find(special, found + 1)
        return rows

    def rows(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Token ids (uint32) of each row; none for null or empty."""
        offsets, raw = text_buffers(column)
        for begin, end in slices(offsets):
            at = offsets[begin : end + 1] - offsets[begin]
            yield from self._slice(raw[offsets[begin] : offsets[end]], at)

    def _slice(self, data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        if len(data) == 0:
            for _ in range(len(at) - 1):
                yield np.zeros(0, dtype=np.uint32)
            return
        low = data.copy()
        low[(data >= 0x41) & (data <= 0x5A)] += 0x20
        capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        low[capital] += 0x20
        long_rows = self._long_rows(data, at, low)
        kind = _KIND[low]
        border = np.zeros(len(data) + 1, dtype=bool)
        border[at] = True
        opens = kind != _SPACE
        opens[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | border[1:-1]
        starts = np.flatnonzero(opens)
        ends_here = kind != _SPACE
        ends_here[:-1] &= (kind[1:] != kind[:-1]) | (kind[:-1] == _DIGIT) | border[1:-1]
        ends = np.flatnonzero(ends_here) + 1
        up, down = _power_tables(len(low) + 1)
        sums = np.zeros(len(low) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[low] * up[:-1], out=sums[1:])
        keys = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        distinct, one, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.place) + len(distinct) > CACHE_PIECES:
            self._forget()
            if len(distinct) > CACHE_PIECES:
                self.first = np.zeros(len(distinct) + 2, dtype=np.int64)
        named = distinct.tolist()
        place, get = np.empty(len(named), dtype=np.int64), self.place.get
        for i, key in enumerate(named):
            found = get(key, -1)
            if found < 0:
                s = one[i]
                found = self._add(key, low[starts[s] : ends[s]].tobytes())
            place[i] = found
        begin = self.first[place]
        size = self.first[place + 1] - begin
        sizes = size[inverse]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.ids[np.repeat(begin[inverse] - total[:-1], sizes) + np.arange(total[-1])]
        row_first = total[np.searchsorted(starts, at)]
        for i in range(len(at) - 1):
            if long_rows[i]:
                yield self.whole(data[at[i] : at[i + 1]].tobytes())
            else:
                yield ids[row_first[i] : row_first[i + 1]]
