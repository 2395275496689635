"""Whole-text statistics over many texts at once, on one array of code points.

`Chars` lays the texts of a slice end to end as code points, finds words
(`[^\\x20\\x09-\\x0D]+`) and lines, and hashes any span in constant time through
prefix sums of a polynomial modulo 2**64, so equal spans have equal hashes.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd

U = np.uint64
MULT = U(0x9E3779B97F4A7C15)
BASE = 0xD1342543DE82EF95          # odd, so it has an inverse modulo 2**64
SYMBOLS = "#*$%&|<>"               # fixed value: symbol characters of the rules
REPEAT_WINDOW = 8                  # fixed value: words in a repeated window

# Letters and digits by code point; above the table all but general punctuation counts as a letter.
_LETTER = np.array([chr(i).isalnum() for i in range(0x250)] + [True])


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: spreads every input bit over the word."""
    x = x.astype(U, copy=True)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for b in (BASE, inverse):
        p = np.full(size, U(b), U)
        p[0] = U(1)
        out.append(np.cumprod(p, dtype=U))
    return out[0], out[1]


class Chars:
    """Code points of several texts, with word and line spans."""

    def __init__(self, texts: list[str], lower_ascii: bool = False, letters: bool = False):
        """`letters`: words are runs of letters and digits instead."""
        self.n = len(texts)
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        if lower_ascii:
            up = (self.codes >= 65) & (self.codes <= 90)
            self.codes = self.codes + (up * 32).astype(np.uint32)
        self.lens = np.fromiter((len(t) for t in texts), np.int64, self.n)
        self.start = np.concatenate([[0], np.cumsum(self.lens)])
        self.size = int(self.start[-1])
        c = self.codes
        self.space = ~_LETTER[np.minimum(c, 0x250)] if letters else (c == 32) | ((c >= 9) & (c <= 13))
        if letters:
            self.space |= ((c >= 0x2000) & (c < 0x2070)) | ((c >= 0x3000) & (c < 0x3040))
        first = np.zeros(self.size + 1, bool)
        first[self.start] = True
        self.first = first
        inside = ~self.space
        before = np.concatenate([[True], self.space[:-1]]) if self.size else self.space
        after = np.concatenate([self.space[1:], [True]]) if self.size else self.space
        self.ws = np.flatnonzero(inside & (before | first[:-1]))
        self.we = np.flatnonzero(inside & (after | first[1:])) + 1
        self.wdoc = np.searchsorted(self.start, self.ws, "right") - 1
        self.n_words = np.bincount(self.wdoc, minlength=self.n).astype(np.int64)
        self._prefix = None

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-character array over each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.start[1:]] - total[self.start[:-1]]

    def spans(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """64-bit hashes of the spans [s, e)."""
        if self._prefix is None:
            size = max(1 << 18, 1 << (self.size + 1).bit_length())
            power, self._inverse = _powers(size)
            value = (self.codes.astype(U) + U(1)) * MULT
            value ^= value >> U(29)
            self._prefix = np.concatenate([np.zeros(1, U), np.cumsum(value * power[:self.size], dtype=U)])
        return mix((self._prefix[e] - self._prefix[s]) * self._inverse[s])

    @functools.cached_property
    def whash(self) -> np.ndarray:
        return self.spans(self.ws, self.we)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every run of `width` words inside one text."""
        h = self.whash
        m = len(h) - width + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        acc = np.zeros(m, U)
        for k in range(width):
            acc = acc * U(BASE) + h[k:k + m]
        at = np.flatnonzero(self.wdoc[:m] == self.wdoc[width - 1:])
        return at, mix(acc[at])

    def by_doc(self, doc: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Hashes made different between texts."""
        return h ^ mix((doc.astype(U) + U(1)) * MULT)

    @functools.cached_property
    def rules(self) -> dict[str, np.ndarray]:
        """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
        symbol = np.zeros(128, bool)
        symbol[[ord(x) for x in SYMBOLS]] = True
        c = self.codes
        low = np.minimum(c, 127)
        is_symbol = symbol[low] & (c < 128)
        # lines: [doc start or after \n, next \n or doc end)
        newline = np.flatnonzero(c == 10)
        starts = np.unique(np.concatenate([self.start[:-1][self.lens > 0], newline + 1]))
        starts = starts[starts < self.size]
        doc = np.searchsorted(self.start, starts, "right") - 1
        nxt = np.searchsorted(newline, starts, "left")
        ends = np.minimum(np.append(newline, self.size)[nxt], self.start[doc + 1])
        has_word = np.searchsorted(self.ws, starts, "left") < np.searchsorted(self.ws, ends, "left")
        starts, ends, doc = starts[has_word], ends[has_word], doc[has_word]
        dup = pd.Series(self.by_doc(doc, self.spans(starts, ends))).duplicated(keep="first").to_numpy()
        at, h = self.windows(REPEAT_WINDOW)
        again = at[pd.Series(self.by_doc(self.wdoc[at], h)).duplicated(keep=False).to_numpy()] if len(at) else at
        cover = np.zeros(len(self.ws) + REPEAT_WINDOW + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + REPEAT_WINDOW, -1)
        covered = np.cumsum(cover)[:len(self.ws)] > 0
        return {"n_words": self.n_words, "word_chars": self.per_doc(~self.space), "n_symbols": self.per_doc(is_symbol),
                "n_dup_lines": np.bincount(doc[dup], minlength=self.n).astype(np.int64),
                "n_repeat_words": np.bincount(self.wdoc[covered], minlength=self.n).astype(np.int64)}

    def char_grams(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every run of `width` code points inside one text."""
        m = self.size - width + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        acc = np.zeros(m, U)
        for k in range(width):
            acc = acc * MULT + self.codes[k:k + m]
        doc = np.repeat(np.arange(self.n), self.lens)
        at = doc[:m] == doc[width - 1:]
        acc = acc[at]
        acc ^= acc >> U(31)
        return doc[:m][at], acc * U(BASE)
