"""Tokenizing word by word, each word of a worker once: shared by the operators that encode text.

Where a tokenizer never merges across white space, a text's ids are its words' ids in order. A batch
is split and its words are numbered by Arrow; only words that the worker has not met go through the
tokenizer, in one batch call; ids are then gathered by numpy. When the table of known words reaches its
bound, those met in a single batch go, so memory stays flat. It changes time only, never results.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_WORDS = 600_000
SLICE = 4 << 20
AT_ONCE = 8192


class WordTable:
    """Ids of words met so far, as one flat array with offsets; `encode` gives ids and a mark per word."""

    def __init__(self, encode: Callable[[Sequence[str]], tuple[list[list[int]], list[bool]]], dtype: type, most: int = MOST_WORDS):
        self.encode, self.dtype, self.most = encode, dtype, most
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.met = np.zeros(1 << 14, dtype=np.int32)
        self.flat = np.zeros(1 << 16, dtype=self.dtype)
        self.ends = np.zeros(1 << 14, dtype=np.int64)
        self.marks = np.zeros(1 << 14, dtype=bool)
        self.used = 0

    def _thin(self) -> None:
        """Keep the words met in more than one batch, if that frees half of the room."""
        n = len(self.place)
        kept = np.flatnonzero(self.met[:n] > 1)
        if len(kept) > self.most // 2:
            return self._clear()
        names = list(self.place)
        ids, ends = self.take(kept)
        marks, met = self.marks[kept], self.met[kept]
        self._clear()
        self.place = {names[k]: i for i, k in enumerate(kept.tolist())}
        self.flat, self.used = np.array(ids, dtype=self.dtype), len(ids)
        self._room(len(kept))
        self.ends[:len(kept)], self.marks[:len(kept)], self.met[:len(kept)] = ends, marks, met

    def _room(self, n: int) -> None:
        while n > len(self.ends):
            self.ends, self.marks, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.ends, self.marks, self.met))

    def _add(self, words: list[str]) -> None:
        ids, marks = self.encode(words)
        n, total = len(self.place), sum(map(len, ids))
        self._room(n + len(words))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), 1 << 16), dtype=self.dtype)])
        self.flat[self.used:self.used + total] = np.fromiter((x for w in ids for x in w), dtype=self.dtype, count=total)
        self.ends[n:n + len(words)] = self.used + np.cumsum([len(w) for w in ids])
        self.marks[n:n + len(words)] = marks
        self.used += total
        self.place.update(zip(words, range(n, n + len(words)), strict=True))

    def places(self, words: list[str]) -> np.ndarray:
        """Where the distinct `words` are kept, those not met before included."""
        if len(self.place) + len(words) > self.most:
            self._thin()
        new = [w for w in words if w not in self.place]
        # the library's encodings of a word take far more room than its ids
        for at in range(0, len(new), AT_ONCE):
            self._add(new[at:at + AT_ONCE])
        found = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
        self.met[found] += 1
        return found

    def take(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of places in a row, and where each place's ids end; a negative place has none."""
        starts = np.where(code > 0, self.ends[code - 1], 0)
        lengths = np.where(code < 0, 0, self.ends[code] - starts)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)], ends

    def gather(self, split: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the texts, where each text's ids end, and whether it has a marked word. `split` has no nulls."""
        numbered = split.flatten().dictionary_encode()
        code = self.places(numbered.dictionary.to_pylist())[numbered.indices.to_numpy(zero_copy_only=False)]
        ids, ends = self.take(code)
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        last = np.cumsum(counts)
        upto, marked = np.concatenate([[0], ends]), np.concatenate([[0], np.cumsum(self.marks[code])])
        return ids, upto[last], marked[last] > marked[last - counts]


def slices(texts: pa.StringArray, most: int = SLICE) -> list[pa.StringArray]:
    """`texts` in runs of about `most` bytes, so that a batch of long texts is not split at once."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    group = (np.cumsum(size) - size) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
