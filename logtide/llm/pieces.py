"""Exact library encodings of whole texts, each distinct piece encoded once per worker.

A text is cut where the tokenizer's own pre-tokenization is certain to cut, so
the ids of the text are the ids of its pieces in order. Pieces repeat; their
encodings are kept per Python worker in two generations of bounded size, and
only what neither holds goes to the library: plain words, which are one
pre-token, to its BPE model, everything else to its whole pipeline in one batch
per slice. When the younger generation is full it becomes the older one and the
older one is dropped; what is met again moves to the younger, so common pieces
stay.
"""

from __future__ import annotations

import array
import functools
import hashlib
import os
import re
from collections.abc import Callable

# Unicode white space, as the libraries' \s
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Runs of plainly Latin letters end at ASCII punctuation or white space for every byte-level pattern;
# anything else stays in one piece up to the next white space.
BYTE_LEVEL = re.compile(rf" ?[A-Za-zÀ-ÖØ-öø-ɏ]+(?=[{SPACE}!-/:-@\[-`{{-~]|\Z)"
                        rf"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WHITE_SPACE = re.compile(rf"[^{SPACE}]+")     # pre-tokenizers that drop white space
LETTERS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")      # one pre-token of a byte-level tokenizer
CACHE_BYTES = 96 << 20      # both generations together, as counted by `Generations`
ENTRY_BYTES = 200           # what a short piece with its value takes in a dictionary
LONG_PIECE = 64
LINE_BYTES = 16 << 20       # both generations of whole lines
LONG_LINE = 1 << 14


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and of how it is used here."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"\nno special tokens added; no truncation; no padding").hexdigest()


class Generations:
    """A dictionary of bounded size: two generations, the older dropped when the younger is full."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.half = limit // 2
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def lacking(self, wanted: set) -> list:
        """The keys that neither generation holds. All others of `wanted` are in the younger one afterwards, and
        what is added next joins them."""
        if self.size > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        fresh = wanted.difference(self.young)
        missing = fresh.difference(self.old)
        known = fresh - missing
        self.young.update(zip(known, map(self.old.__getitem__, known)))
        self.size += len(known) * ENTRY_BYTES + sum(map(len, known))
        return list(missing)

    def add(self, keys: list, values: list, size: int = 0) -> None:
        """Keep new entries; `size` is what their values take beyond some bytes."""
        self.young.update(zip(keys, values))
        self.size += len(keys) * ENTRY_BYTES + sum(map(len, keys)) + size

    def forget(self, keys: list) -> None:
        """Drop entries that are not worth keeping."""
        for key in keys:
            value = self.young.pop(key)
            self.size -= ENTRY_BYTES + len(key) + len(value)


def _byte_symbols() -> str:
    """The symbols of the 256 bytes in a byte-level vocabulary: printable Latin-1 as it is, the others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


class Pieces:
    """Encodings of a tokenizer's texts through a bounded cache; ids are little-endian 32-bit numbers in bytes."""

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # one core per Spark task
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.byte_level = type(self.tok.pre_tokenizer).__name__ == "ByteLevel"
        self.pattern = BYTE_LEVEL if self.byte_level else WHITE_SPACE
        self.cache = Generations(limit)
        self.lines = Generations(LINE_BYTES)
        self.symbols = _byte_symbols()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.split = (re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
                      if self.special else None)

    def segments(self, text: str) -> list[str]:
        """The text cut around special strings, which come as segments of their own."""
        if self.split is None or not any(s in text for s in self.special):
            return [text] if text else []
        return [s for s in self.split.split(text) if s]

    def pieces(self, line: str) -> list[str]:
        """The pieces of a line or of a special string."""
        return [line] if line in self.special else self.pattern.findall(line)

    def cut_lines(self, text: str) -> list[str]:
        """The text cut around line breaks where all its lines begin and end on what is no white space, and around
        special strings. The last break before a line is apart from those before it, as it is for the tokenizer."""
        out: list[str] = []
        for part in self.segments(text):
            lines = part.split("\n")
            if len(lines) == 1 or not all(line == line.strip() for line in lines):
                out.append(part)
                continue
            breaks = -1                                    # since the last line that is not empty
            for line in lines:
                breaks += 1
                if line:
                    if breaks:
                        out += ["\n" * (breaks - 1), "\n"] if breaks > 1 else ["\n"]
                    out.append(line)
                    breaks = 0
            if breaks:
                out.append("\n" * breaks)
        return out

    def _direct(self, piece: str) -> str | None:
        """What the BPE model gets of a piece that is surely one pre-token, None for any other."""
        if self.byte_level:
            if not LETTERS.fullmatch(piece):
                return None
            return piece.replace(" ", self.symbols[32]) if piece.isascii() else piece.encode().decode("latin-1").translate(self.symbols)
        return piece.lower() if piece.isascii() and piece.isalpha() else None

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """The library's ids of each piece."""
        out: list = [self._direct(p) for p in pieces]
        tokenize = self.tok.model.tokenize
        rest = [i for i, word in enumerate(out) if word is None]
        out = [word if word is None else array.array("I", [t.id for t in tokenize(word)]).tobytes() for word in out]
        for i, e in zip(rest, self.tok.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)):
            out[i] = array.array("I", e.ids).tobytes()
        return out

    def learn(self, wanted: set[str]) -> Callable[[str], bytes]:
        """Encode what the cache lacks of `wanted`; returns the lookup of their ids, good until the next call."""
        missing = self.cache.lacking(wanted)
        values = self._encoded(missing)
        long = {p: v for p, v in zip(missing, values) if len(p) > LONG_PIECE}     # not kept for later slices
        self.cache.add([p for p in missing if p not in long], [v for p, v in zip(missing, values) if p not in long])
        young = self.cache.young
        return (lambda p: long[p] if p in long else young[p]) if long else young.__getitem__

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; lines that repeat are not cut into pieces again."""
        cut = [self.cut_lines(t) for t in texts]
        missing = self.lines.lacking(set().union(*cut))
        pieces = [self.pieces(line) for line in missing]
        ids_of = self.learn(set().union(*pieces))
        fresh = [b"".join(map(ids_of, p)) for p in pieces]
        self.lines.add(missing, fresh, sum(map(len, fresh)))
        out = [b"".join(map(self.lines.young.__getitem__, lines)) for lines in cut]
        self.lines.forget([line for line in missing if len(line) > LONG_LINE])
        return out


@functools.lru_cache(maxsize=4)
def shared_pieces(path: str) -> Pieces:
    """One cache per Python worker and tokenizer."""
    return Pieces(path)
