"""Byte-level BPE through a sentencepiece model that is serialised from a rank file.

Each ranked byte string becomes a piece of printable characters, one for a byte, scored by its negative rank, so that
sentencepiece merges in rank order; normalisation is the identity. Texts are cut into pre-tokens, which are encoded apart;
the ids are decoded by the inverse mapping. The ids equal those of tiktoken for the same ranks and pattern.

Null texts are empty; every row gives a row; a text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyforge.llm import _base as B

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Entries of the cache of encoded words in each worker; it is emptied when full.
CACHE = 400_000


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is one, else one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One field of a protocol buffer."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model: pieces in rank order, then the unknown piece, which byte pieces never need."""
    letters = byte_letters()
    pieces = [_field(1, _field(1, "".join(letters[b] for b in raw)) + _field(2, -float(rank))) for raw, rank in sorted(ranks.items(), key=lambda x: x[1])]
    unknown = _field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))
    bpe, last = 2, len(pieces)
    trainer = _field(3, bpe) + _field(4, last + 1) + _field(40, last)
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normalizer)


class Codec:
    #: A white-space character beside another, at an end, or other than space and newline.
    _irregular = re.compile(r"\s\s|\A\s|\s\Z|[^\S \n]")

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        if sorted(self.ranks.values()) != list(range(len(self.ranks))):
            raise ValueError(f"the ranks in {path} have gaps")
        self.pieces = [raw for raw, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.ranks))
        self.find = regex.compile(pattern).findall
        self.first: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.newline = struct.pack("<I", self.ranks[b"\n"])

    def _new(self, pretokens: list[str]) -> bytes:
        ids: list[int] = []
        for p in pretokens:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is None:
                ids += self.model.encode(raw.decode("latin-1").translate(self.letters))
            else:
                ids.append(whole)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str, known: dict[str, bytes], before: str) -> bytes:
        if len(known) >= CACHE:
            known.clear()
        made = self._new(self.find(before + word))
        if len(word) < 64:
            known[word] = made
        return made

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._irregular.search(text):
            return self._new(self.find(text))
        # Single spaces and newlines between other characters: no pre-token crosses into the next word, and none looks back.
        out = []
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(self.first.get(words[0]) or self._word(words[0], self.first, ""))
            spaced = self.spaced
            out += [spaced.get(w) or self._word(w, spaced, " ") for w in words[1:]]
            out.append(self.newline)
        out.pop()
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes of every document."""

    def encode(batches):
        own = codec(path, pattern)
        for batch in batches:
            ids = [own.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in ids], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return B.texts(docs).mapInArrow(encode, SCHEMA)
