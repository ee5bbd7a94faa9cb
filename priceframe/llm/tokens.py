"""Token ids of whole texts with a public tokenizer file, chunk by chunk through a cache of bounded size.

Both tokenizers used here cut a text before they merge anything, and no cut piece
spans a single blank between two visible characters.  So a text's ids are the
ids of its blank-separated chunks in a row, and a chunk seen before costs a
dictionary look-up.  A text whose chunks are not independent (blanks beside
other white space) goes to the tokenizer whole.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np

from .common import only_caches_of

CACHE = 1 << 20   #: chunks remembered by one Python worker; the rest are encoded each time they come
LONGEST = 64      #: code points of a chunk that is remembered: an entry has at most some hundred bytes


def vocabulary_path(name: str) -> str:
    """``name`` itself if it is a file here, else the public tokenizer file of that name."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Ids of texts as packed little-endian unsigned integers (2 bytes each if the vocabulary allows)."""

    def __init__(self, name: str, cache: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(vocabulary_path(name))
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"  # native order: little-endian on the machines Spark runs on
        # White space is a token of its own for byte-level vocabularies and dropped by word-end ones.
        self.drops_blanks = not self.tok.encode(" \n ", add_special_tokens=False).ids
        # Ids that begin with a blank, which byte-level vocabularies print as one letter: there a blank-led chunk begins.
        self.starts = None
        blank = self.tok.encode(" ", add_special_tokens=False).tokens
        if not self.drops_blanks and len(blank) == 1:
            size = self.tok.get_vocab_size(with_added_tokens=True)
            self.starts = np.array([(self.tok.id_to_token(i) or "").startswith(blank[0]) for i in range(size)])
        self.limit = cache
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = self.first if self.drops_blanks else {}

    def pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tok.encode(text, add_special_tokens=False).ids)

    def _encode(self, chunks: list[str], lead: str) -> list[bytes]:
        """The ids of each chunk after ``lead``; blank-led ones as one text, cut at the ids that begin with the blank."""
        if lead == " " and self.starts is not None:
            coded = self.tok.encode_batch_fast([lead + lead.join(chunks)], add_special_tokens=False)[0].ids
            ids = np.array(coded, dtype=self.dtype)
            at = self.starts[ids].nonzero()[0] * self.dtype.itemsize
            if len(at) == len(chunks):
                flat = ids.tobytes()
                return [flat[a:b] for a, b in zip(at.tolist(), [*at[1:].tolist(), len(flat)], strict=True)]
        coded = self.tok.encode_batch_fast([lead + c for c in chunks], add_special_tokens=False)
        return [self.pack(e.ids) for e in coded]

    def _look(self, cache: dict, chunks: list[str], lead: str) -> bytes | None:
        """The ids of the chunks in a row, or None if one is not independent of its neighbours (a chunk in the cache is)."""
        new = list(set(chunks).difference(cache))
        if not new:
            return b"".join(map(cache.__getitem__, chunks))
        if not (self.drops_blanks or all(c and not c[0].isspace() and not c[-1].isspace() for c in new)):
            return None
        room = len(cache) + len(new) <= self.limit
        # New chunks are looked up like old ones, then those go that are too long or for which there is no room.
        cache.update(zip(new, self._encode(new, lead), strict=True))
        out = b"".join(map(cache.__getitem__, chunks))
        for c in new:
            if not room or len(c) > LONGEST:
                del cache[c]
        return out

    def encode(self, text: str | None) -> bytes:
        """The packed ids of one text; null and empty texts have none."""
        if not text:
            return b""
        if self.drops_blanks:
            return self._look(self.later, [c for c in text.replace("\n", " ").split(" ") if c], "")
        chunks = text.split(" ")
        rest = self._look(self.later, chunks[1:], " ")
        first = None if rest is None else self._look(self.first, chunks[:1], "")
        return self.whole(text) if first is None else first + rest


@lru_cache(maxsize=1)
def _encoder(name: str, cache: int) -> ChunkEncoder:
    return ChunkEncoder(name, cache)


def encoder(name: str, cache: int = CACHE) -> ChunkEncoder:
    """One encoder per Python worker, until another operator works there."""
    only_caches_of("tokens", _encoder.cache_clear)
    return _encoder(name, cache)
