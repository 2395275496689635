"""BPE encoding and decoding through content-defined chunks.

A rolling hash over 16 code points cuts texts into chunks (about 128 code
points) that depend on content alone, so equal passages of different documents
give equal chunks. Each worker encodes a distinct chunk once and keeps, in two
generations of bounded size, the ids between its first and last white space.
What a cut splits is repaired at the join: the last word of the left chunk and
the first of the right (and whole chunks between, while they hold no white
space) are re-encoded together until white space on both sides separates them,
from where on the ids agree exactly with those of the whole text. Special
strings inside texts are handled as the library does by default. Decoding looks
up the token of every id, as this tokenizer, which has no decoder, joins them.

A change of method: what goes to the library of a new chunk are its distinct
words that the worker does not know, not the chunk as one string. This tokenizer
encodes the words between white space apart, so the ids are the same, and words
repeat where chunks do not (see the README for the figures of both).

The reuse is per worker: encoding each chunk once for the whole corpus would
shuffle all texts and all ids (about 3.5 times the input), more than the
encoding that it saves.

Defined results: null and empty texts have no ids and decode to the empty text.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import DataFrame

from logtide.llm.common import TOKEN_SLICE_BYTES, map_texts, texts_of
from logtide.llm.pieces import SPACE, WHITE_SPACE, Generations, Pieces

WINDOW = 16
CHUNK_BITS = 7
CACHE_BYTES = 24 << 20      # of the chunks' generations
_FIRST = re.compile(f"[{SPACE}]")


def cuts(text: str) -> np.ndarray:
    """Positions inside `text` where a chunk begins, by content alone."""
    if len(text) <= WINDOW:
        return np.zeros(0, np.int64)
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    for width in (1, 2, 4, 8):      # hashes of runs of 2, 4, 8, 16
        h = h[:-width] * np.uint32(0x85EBCA77) + (h[width:] ^ (h[width:] >> np.uint32(13)))
    at = np.flatnonzero((h * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - CHUNK_BITS) == 0) + WINDOW
    return at[at < len(text)]


class ChunkCoder:
    """Encodes texts chunk by chunk into little-endian 32-bit ids, and decodes ids."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        tok = self.pieces.tok
        if self.pieces.byte_level:
            raise ValueError("joins are repaired at white space, which this tokenizer keeps")
        self.names = [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size())]
        self.digits = [str(i) for i in range(len(self.names))]
        self.plain = tok.decoder is None                 # decoding joins the token strings with spaces
        self.chunks = Generations(CACHE_BYTES)

    @staticmethod
    def _parts(chunk: str) -> tuple[str, list[str] | None, str]:
        """(head, words between the first and last white space, tail); without white space all is head."""
        first = _FIRST.search(chunk)
        if not first:
            return chunk, None, ""
        between = WHITE_SPACE.findall(chunk, first.end())
        tail = "" if not between or _FIRST.match(chunk[-1]) else between.pop()
        return chunk[:first.start()], between, tail

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. The words of chunks not seen yet and those that cuts split go to the library in one batch."""
        cut: list[list] = []                       # per text: its chunks in lists, special strings as they are
        for text in texts:
            plan: list = []
            for part in self.pieces.segments(text):
                if part in self.pieces.special:
                    plan.append(part)
                else:
                    at = [0, *cuts(part).tolist(), len(part)]
                    plan.append([part[a:b] for a, b in zip(at, at[1:])])
            cut.append(plan)
        chunks = set().union(*(x for plan in cut for x in plan if isinstance(x, list)))
        fresh = {chunk: self._parts(chunk) for chunk in self.chunks.lacking(chunks)}
        known = self.chunks.young
        wanted: set[str] = set()
        for _, between, _ in fresh.values():
            wanted.update(between or ())
        joined: list[list] = []                    # per text: chunks as 1-tuples, words at joins and special strings as they are
        for plan in cut:
            out: list = []
            for x in plan:
                if not isinstance(x, list):
                    out.append(x)
                    continue
                split = ""                         # what the cuts so far have split
                for chunk in x:
                    head, between, tail = known.get(chunk) or fresh[chunk]
                    split += head
                    if between is not None:
                        out += [split, (chunk,)]
                        split = tail
                out.append(split)
            wanted.update([w for w in out if w.__class__ is str])
            joined.append(out)
        wanted.discard("")
        ids_of = self.pieces.learn(wanted)
        for chunk, (head, between, tail) in fresh.items():
            fresh[chunk] = (head, None if between is None else b"".join(map(ids_of, between)), tail)
        self.chunks.add(list(fresh), list(fresh.values()), sum(len(v[1] or b"") for v in fresh.values()))
        return [b"".join([known[x[0]][1] if x.__class__ is tuple else ids_of(x) for x in out if x]) for out in joined]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        if self.plain:
            return " ".join(map(self.names.__getitem__, ids))
        return self.pieces.tok.decode(ids, skip_special_tokens=False)

    def ids_text(self, ids: list[int]) -> str:
        """The ids in decimal, separated by one space."""
        return " ".join(map(self.digits.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def coder(path: str) -> ChunkCoder:
    """One coder, with its caches, per Python worker."""
    return ChunkCoder(path)


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) per document: ids in decimal, separated by one space."""
    def run(part):
        own = coder(tokenizer)
        made = [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(texts_of(part, text_col))]
        return {"n_tokens": np.array(list(map(len, made)), np.int64), "ids": list(map(own.ids_text, made)),
                "decoded": list(map(own.decode, made))}

    return map_texts(docs.select(id_col, text_col), run, "n_tokens long, ids string, decoded string",
                     text_col, [id_col], TOKEN_SLICE_BYTES)
