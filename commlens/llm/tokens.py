"""Exact, cached word-piece encoding shared by the token output and the packer.

A text is cut at ASCII white space and each distinct chunk is encoded once; a
document's ids are the chunks' ids in order.  The result equals encoding the
whole text for tokenizers whose pre-tokenizer drops white space and never
looks across it (each chunk then holds whole pre-tokens).  Texts that hold the
opening mark of a special token are encoded whole.  The cache is bounded and
keeps the earliest words, which in running text are the most frequent ones.
"""

from __future__ import annotations

import zlib

import numpy as np

SPECIAL_MARK = b"<|"
#: A run of these after a word is a pre-token of its own; an apostrophe may start a contraction.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_chars() -> dict[int, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


BYTE_CHARS = _byte_chars()
#: The same for whole letters of two bytes.
LETTER_CHARS = {c: "".join(chr(BYTE_CHARS[b]) for b in chr(c).encode()) for c in range(0x80, 0x130)}


class CachedTokenizer(dict):
    """Chunk to its ids as little-endian bytes, ``width`` bytes an id; a missing chunk is encoded when asked for."""

    def __init__(self, path: str, max_words: int = 500_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.max_words = max_words
        self.width = 2 if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.plain = self._plain_words()

    def _plain_words(self) -> bool:
        """Does one word of Latin letters reach the model as its lower-case bytes, each shown as one character?"""
        words = ["straße", "élan", "ñandú", "word"]
        got = [self._pack(self.tok.encode(w, add_special_tokens=False).ids) for w in words]
        return got == [self._word(w) for w in words]

    def _pack(self, ids) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _word(self, w: str) -> bytes:
        return b"".join([t.id.to_bytes(self.width, "little") for t in self.tok.model.tokenize(w if w.isascii() else w.translate(LETTER_CHARS))])

    def _whole(self, text: bytes) -> bytes:
        return self._pack(self.tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def __missing__(self, chunk: bytes) -> bytes:
        ids = None
        if self.plain and chunk.isalpha():  # of bytes: ASCII letters
            ids = self._word(chunk.decode("ascii"))
        elif self.plain:
            base = chunk.rstrip(MARKS)
            w = base.decode("utf-8", "replace")
            if w.isalpha() and max(w) < "\u0130":
                if len(base) < len(chunk):
                    ids = self[base] + self[chunk[len(base) :]]
                else:
                    ids = self._word(w.lower())  # below U+0130 lower case is a letter's own, whatever stands beside it
        if ids is None:
            ids = self._whole(chunk)
        self[chunk] = ids
        return ids

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """UTF-8 texts (None: empty) to packed ids, without special tokens."""
        if len(self) > self.max_words:
            for k in list(self)[self.max_words // 2 :]:
                del self[k]
        get, join = self.__getitem__, b"".join
        return [b"" if not t else self._whole(t) if SPECIAL_MARK in t else join(map(get, t.lower().split())) for t in texts]


_LOADED: dict[tuple, CachedTokenizer] = {}


def worker_tokenizer(path: str, max_words: int) -> CachedTokenizer:
    """One tokenizer and cache for each Python worker, kept across its tasks."""
    key = (path, max_words)
    if key not in _LOADED:
        _LOADED[key] = CachedTokenizer(path, max_words)
    return _LOADED[key]


def crc32_u32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").view(np.uint8))
