"""Token ids of texts by the ``tokenizers`` library, each distinct word encoded once.

For tokenizers that split at white space before anything else (the word tokenizer does)
the ids of a text are those of its white-space-separated pieces in order, so a worker
keeps the pieces it has met. Most of them are runs of plain letters, single digits and
runs of plain signs, which the vocabulary's model encodes directly. All other pieces go
through the whole tokenizer, one by one: its batches start threads of their own, which
take CPU from the other tasks of an executor. Long texts are encoded in parts that end at
white space, so what is held besides a text and its ids does not grow with it.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from rowsieve.llm.common import text_bytes

# Pieces that a worker keeps, about 200 bytes each: the newest half and, of those before
# them, the last half. What is met again moves to the newest.
KEPT_PIECES = 400_000

# Bytes of a text that are split into pieces at once.
PART_BYTES = 1 << 20

# Letters that are composed and change case alike in every Unicode version,
# and signs that begin neither a contraction nor a special token.
_ASCII_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_LATIN_LETTERS = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"
_SIGNS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
# What the tokenizer must do before its model, for the short way to be the same.
_STEPS = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pre_tokenizer": ["Split", "ByteLevel"],
}
_LETTERS = _ASCII_LETTERS + _LATIN_LETTERS
_SIGN_BYTES = _SIGNS.encode()
_RUNS = re.compile(f"[{_LETTERS}]+|[0-9]|[{re.escape(_SIGNS)}]+")
_SPACE = re.compile(rb"[ \t\n\r\f\v]")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    """Ids of pieces, learned when first asked for."""

    def __init__(self, learn: Callable[[bytes], bytes], before: dict[bytes, bytes]):
        self.learn = learn
        self.before = before

    def __missing__(self, piece: bytes) -> bytes:
        found = self.before.get(piece)
        if found is None:
            found = self.learn(piece)
        self[piece] = found
        return found


class WordEncoder:
    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        parts = {
            "normalizer": [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])],
            "pre_tokenizer": [x["type"] for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])],
        }
        self.by_word = parts == _STEPS
        self.stand_in = {ord(c): "".join(_byte_letters()[b] for b in c.encode()) for c in _LATIN_LETTERS}
        self.pieces = _Pieces(self._learn, {})

    @property
    def before(self) -> dict[bytes, bytes]:
        return self.pieces.before

    def _learn(self, piece: bytes) -> bytes:
        """Ids of a new piece: by its runs, which are kept as well, or by the tokenizer."""
        core = piece.rstrip(_SIGN_BYTES)
        if core.isalpha():
            low = core.lower()
            if core is not piece:
                return self.pieces[low] + self.pieces[piece[len(core) :]]
            if low != piece:
                return self.pieces[low]
            word = piece.decode()
        else:
            low = piece.decode().lower()
            runs = _RUNS.findall(low)
            if sum(map(len, runs)) != len(low):
                return _packed(self.whole.encode(piece.decode(), add_special_tokens=False).ids)
            keys = [run.encode() for run in runs]
            if keys != [piece]:
                return b"".join([self.pieces[key] for key in keys])
            word = low if low.isascii() else low.translate(self.stand_in)
        return _packed([t.id for t in self.model.tokenize(word)])

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each UTF-8 text."""
        if not self.by_word:
            for text in texts:
                ids = self.whole.encode(text.decode(), add_special_tokens=False).ids
                yield np.array(ids, dtype="<u4")
            return
        for text in texts:
            ids = []
            for part in _parts(text):
                if len(self.pieces) > KEPT_PIECES // 2:
                    self.pieces.before = {}
                    self.pieces = _Pieces(self._learn, self.pieces)
                ids.append(b"".join(map(self.pieces.__getitem__, part.split())))
            yield np.frombuffer(b"".join(ids), dtype="<u4")


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of at least ``PART_BYTES`` that end at white space, but the last."""
    start = 0
    while len(text) - start > PART_BYTES and (end := _SPACE.search(text, start + PART_BYTES)):
        yield text[start : end.start()]
        start = end.end()
    yield text[start:]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def forget(path: str) -> None:
    """Drop the pieces kept; the tokenizer stays."""
    encoder(path).pieces = _Pieces(encoder(path)._learn, {})


def token_ids(column: pa.Array, path: str, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each text of a column and the end id; null counts as empty."""
    end = np.array([end_id], dtype="<u4")
    for ids in encoder(path).encode(text_bytes(column)):
        yield np.concatenate([ids, end])


def crc32(ids: np.ndarray) -> int:
    """Unsigned checksum of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
