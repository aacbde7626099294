"""Token ids of whole texts by a given tokenizer file; nothing is trained here."""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterable, Iterator

CACHED_WORDS = 400_000
CACHED_LENGTH = 64
# Bytes that byte-level vocabularies write as themselves; the others are written as 256 and up, in order.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_TEXT = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
_encoders: dict[str, "Encoder"] = {}


class _Whole(Exception):
    """A text that has to be encoded in one piece."""


class _Words(dict):
    """Ids of words after a given character (a space, or none at the start of a line).

    Byte-level tokenizers cut before a space that white space does not follow, after a line feed, and between letters and marks, so these
    parts of a text are independent of one another. A word of letters or marks alone is one piece for the merges.
    """

    def __init__(self, tokenizer, before: str):
        super().__init__()
        self.tokenizer, self.pieces, self.before, self.mark = tokenizer, tokenizer.model.tokenize, before, "".join(BYTE_TEXT[ord(c)] for c in before)
        self.starts = self if not before else None
        self.bytes_of = [packed([i]) for i in range(tokenizer.get_vocab_size())]
        self.line = self.pack_pieces(BYTE_TEXT[10])

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = self.pack_pieces(self.mark + (word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_TEXT)))
        elif not word or word[0].isspace() or word[-1].isspace():
            raise _Whole
        elif (core := word.rstrip(string.punctuation)).isalpha():
            ids = self[core] + self.starts[word[len(core):]]
        elif not core:
            ids = self.pack_pieces(self.mark + word)
        elif "\n" in word:
            first, *rest = word.split("\n")
            return b"".join([self[first], *[self.line + self.starts[x] for x in rest]])
        else:
            ids = packed(self.tokenizer.encode(self.before + word, add_special_tokens=False).ids)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def pack_pieces(self, text: str) -> bytes:
        return b"".join([self.bytes_of[t.id] for t in self.pieces(text)])


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, those of the library's own encode() of the whole text.

    A text with white space beside white space, or with an added token of the vocabulary written out, is encoded in one piece.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task uses its own core
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.starts, self.words = _Words(self.tokenizer, ""), _Words(self.tokenizer, " ")
        self.words.starts = self.starts

    def ids(self, text: str | None, end_id: int) -> bytes:
        end = end_id.to_bytes(4, "little")
        if not text:
            return end
        parts = text.split(" ")
        try:
            if any(token in text for token in self.added):
                raise _Whole
            return b"".join([self.starts[parts[0]], *map(self.words.__getitem__, parts[1:]), end])
        except _Whole:
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids) + end


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(texts: Iterable[str | None], path: str, end_id: int) -> Iterator[bytes]:
    own = encoder(path)
    for text in texts:
        yield own.ids(text, end_id)


def checksum(ids: bytes) -> int:
    return zlib.crc32(ids)


def byte_bpe() -> str:
    """Where this machine has the byte-level vocabulary; the path is a parameter of every operator."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
