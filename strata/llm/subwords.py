"""Character n-grams of words for the two learned classifiers, and a table of known words.

Words recur, and both models are linear in a text's n-grams, so what a model makes of a word is
computed once per word and task, and a text is a gather over its words.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from strata.llm.common import U64, Words, mix

_CODE_STEP = U64(0x9E3779B97F4A7C15)


def word_grams(words: list[str], least: int, most: int, bits: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, first): hashed n-grams of ``least`` to ``most`` characters of each lower-cased word with
    its ends marked, and where each word's begin. ``whole`` adds the word itself."""
    marked = ["\x02" + w.lower() + "\x03" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(U64) + U64(1)
    size = np.array([len(m) for m in marked], np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    end = np.repeat(first[1:], size)
    word = np.repeat(np.arange(len(words)), size)
    at, buckets, owner = np.arange(len(codes)), [], []
    h = np.zeros(len(codes), U64)
    for n in range(1, most + 1):
        if n > len(codes):
            break
        h = h[: len(codes) - n + 1] * _CODE_STEP + codes[n - 1:]
        if n >= least:
            fits = at[: len(h)] + n <= end[: len(h)]
            buckets.append((mix(h[fits] + U64(n)) >> U64(64 - bits)).astype(np.int64))
            owner.append(word[: len(h)][fits])
    if whole and len(words):
        power = np.cumprod(np.full(int(size.max()), _CODE_STEP, U64))
        own = mix(np.add.reduceat(codes * power[at - np.repeat(first[:-1], size)], first[:-1]))
        buckets.append((mix(own + U64(99)) >> U64(64 - bits)).astype(np.int64))
        owner.append(np.arange(len(words)))
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    every, of = np.concatenate(buckets), np.concatenate(owner)
    order = np.argsort(of, kind="stable")
    return every[order], np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(words)))))


class WordTable:
    """Rows of ``make(new words)`` (one array row a word) by word hash; it starts anew when some
    ``held_bytes`` are held."""

    def __init__(self, make: Callable[[list[str]], np.ndarray], held_bytes: int = 40 << 20):
        self.make, self.held_bytes = make, held_bytes
        self.row: dict[int, int] = {}
        self.values: np.ndarray | None = None
        self.used = 0

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(row of each word, the table)."""
        distinct, at, back = np.unique(words.hash, return_index=True, return_inverse=True)
        each = 120 + (2 * self.values[0].nbytes if self.values is not None else 0)  # the table grows by doubling
        if self.used and (self.used + len(distinct)) * each > self.held_bytes:
            self.row, self.values, self.used = {}, None, 0
        rows = np.fromiter((self.row.get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(rows < 0)
        if len(new):
            raw = words.data.tobytes()
            made = self.make([raw[a:z].decode(errors="replace") for a, z in zip(words.start[at[new]].tolist(), words.stop[at[new]].tolist(), strict=True)])
            need = self.used + len(new)
            if self.values is None:
                self.values = np.zeros((max(need, 1024), *made.shape[1:]), made.dtype)
            elif need > len(self.values):
                grown = np.zeros((max(need, 2 * len(self.values)), *self.values.shape[1:]), self.values.dtype)
                grown[: self.used] = self.values[: self.used]
                self.values = grown
            self.values[self.used: need] = made
            rows[new] = np.arange(self.used, need)
            self.row.update(zip(distinct[new].tolist(), range(self.used, need), strict=True))
            self.used = need
        return rows[back], self.values if self.values is not None else np.zeros((0, 1))
