"""Token ids in patched frame-of-reference files.

A shard holds the ids of a range of doc_id. Ids are cut into blocks of 256: the block's minimum is subtracted, the differences
are packed at the width that holds nine tenths of them, and the others are exceptions, kept whole in a list. Block starts
are indexed behind the blocks, followed by a table of documents and a footer, so that any document is read by seeking.

File: ``TFPF1\\n``, blocks, block starts (u64), documents (i64 id, u8 whether the id is null, u64 number of ids), footer (u64
blocks, u64 documents, u64 offset of the block starts, ``TFPF1\\n``). Block: u16 ids, u32 minimum, u8 width, u16 exceptions,
packed bits, positions (u8), values (u32).

Null texts are empty and have the end id alone; null doc_ids come first; rows of equal doc_id are written one after the other
in the order of their texts, and rows equal in both are alike. A text of any length is encoded whole. Tokenizers that aren't
proven to encode each word by itself get whole texts.
"""

from __future__ import annotations

import array
import functools
import json
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import _base as B
from tallyforge.llm import files
from tallyforge.llm.bpe import byte_letters

MAGIC = b"TFPF1\n"
BLOCK = 256
SHARE = 0.9
END_ID = 1
#: Ids that are packed at once; words and pre-tokens that a worker remembers.
CHUNK = BLOCK * 2048
CACHE = 500_000
#: Printable ASCII, Latin-1 and Latin Extended A and B.
LATIN = r"[\x21-\x7e\xa1-\u024f]+"
#: Fixed value: the pre-token pattern of tokenizers that encode each word by itself.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHARDS = "shard string, part int, n_ids long, n_docs long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"
_HEAD = struct.Struct("<HIBH")
_FOOT = struct.Struct("<QQQ6s")


def pack(ids: np.ndarray) -> list[bytes]:
    """Blocks of up to BLOCK ids each."""
    n = -(-len(ids) // BLOCK)
    grid = np.full(n * BLOCK, ids[-1], "<u4")
    grid[: len(ids)] = ids
    grid = grid.reshape(n, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    limit = np.partition(rest, int(BLOCK * SHARE) - 1, axis=1)[:, int(BLOCK * SHARE) - 1]
    width = np.ceil(np.log2(limit + 1.0)).astype(np.int64)
    over = rest >> width.astype(np.uint32)[:, None] > 0
    over.reshape(-1)[len(ids) :] = False
    block, at = np.nonzero(over)
    values, at = rest[block, at].tobytes(), at.astype(np.uint8).tobytes()
    ends = np.cumsum(np.append(0, over.sum(axis=1))).tolist()
    rest[over] = 0
    packed: list[bytes] = [b""] * n
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        bits = np.unpackbits(rest[own].view(np.uint8).reshape(len(own), BLOCK, 4), axis=2, count=w, bitorder="little")
        rows, size = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little").tobytes(), BLOCK * w // 8
        for k, i in enumerate(own.tolist()):
            packed[i] = rows[k * size : (k + 1) * size]
    sizes = [BLOCK] * (n - 1) + [len(ids) - BLOCK * (n - 1)]
    heads = zip(sizes, low.tolist(), width.tolist(), ends[:-1], ends[1:], packed, strict=True)
    return [b"".join((_HEAD.pack(size, least, w, e - b), own, at[b:e], values[4 * b : 4 * e])) for size, least, w, b, e, own in heads]


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at starts in data."""
    heads = [_HEAD.unpack_from(data, s) for s in starts]
    grid = np.zeros((len(heads), BLOCK), np.int64)
    raw = np.frombuffer(data, np.uint8)
    width = np.array([h[2] for h in heads])
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        size = BLOCK * w // 8
        take = np.array([starts[i] for i in own])[:, None] + _HEAD.size + np.arange(size)
        bits = np.unpackbits(raw[take], axis=1, bitorder="little").reshape(len(own), BLOCK, w)
        grid[own] = bits.astype(np.int64) @ (1 << np.arange(w, dtype=np.int64))
    for i, (_, _, w, n) in enumerate(heads):
        if n:
            at = starts[i] + _HEAD.size + BLOCK * w // 8
            grid[i, raw[at : at + n]] = np.frombuffer(data, "<u4", n, at + n)
    grid += np.array([h[1] for h in heads])[:, None]
    sizes = [h[0] for h in heads]
    return grid.ravel() if sizes[-1] == BLOCK and min(sizes) == BLOCK else np.concatenate([row[:s] for row, s in zip(grid, sizes, strict=True)])


class ShardWriter:
    def __init__(self, uri: str):
        files.make_parent(uri)
        system, path = files.opened(uri)
        self.uri, self.out, self.at = uri, system.open_output_stream(path, compression=None), len(MAGIC)
        self.out.write(MAGIC)
        self.starts: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= CHUNK:
            self._flush(self.held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for begin in range(0, n, CHUNK):
            blocks = pack(ids[begin : min(n, begin + CHUNK)])
            for b in blocks:
                self.starts.append(self.at)
                self.at += len(b)
            self.out.write(b"".join(blocks))
        self.waiting, self.held = [ids[n:]], len(ids) - n

    def close(self) -> tuple[str, int, int]:
        self._flush(self.held)
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array([x or 0 for x, _ in self.docs], "<i8").tobytes() + np.array([x is None for x, _ in self.docs], np.uint8).tobytes() + np.array([n for _, n in self.docs], "<u8").tobytes())
        self.out.write(_FOOT.pack(len(self.starts), len(self.docs), self.at, MAGIC))
        self.out.close()
        return self.uri, self.total, len(self.docs)


class ShardReader:
    def __init__(self, uri: str):
        system, path = files.opened(uri)
        self.source = system.open_input_file(path)
        end = self.source.size()
        n, docs, at, magic = _FOOT.unpack(files.read_range(self.source, end - _FOOT.size, _FOOT.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} has no footer")
        self.starts = np.append(np.frombuffer(files.read_range(self.source, at, 8 * n), "<u8").astype(np.int64), at)
        table = files.read_range(self.source, at + 8 * n, 17 * docs)
        self.ids = [None if null else int(x) for x, null in zip(np.frombuffer(table, "<i8", docs), np.frombuffer(table, np.uint8, docs, 8 * docs), strict=True)]
        self.counts = np.frombuffer(table, "<u8", docs, 9 * docs).astype(np.int64)

    def blocks(self, first: int, last: int) -> np.ndarray:
        data = files.read_range(self.source, int(self.starts[first]), int(self.starts[last] - self.starts[first]))
        return unpack(data, self.starts[first:last] - self.starts[first]).astype("<u4")

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document: only its blocks are read."""
        begin = int(self.counts[:i].sum())
        end = begin + int(self.counts[i])
        if begin == end:
            return np.zeros(0, "<u4")
        return self.blocks(begin // BLOCK, -(-end // BLOCK))[begin % BLOCK :][: end - begin]

    def checksums(self):
        """doc_id, start, number and crc32 of the ids of each document, with one chunk of ids in memory."""
        ends = np.cumsum(self.counts)
        step, doc, crc, at = CHUNK // BLOCK, 0, 0, 0
        for first in range(0, len(self.starts) - 1, step):
            ids = self.blocks(first, min(first + step, len(self.starts) - 1))
            done = 0
            while doc < len(ends) and ends[doc] <= at + len(ids):
                upto = int(ends[doc]) - at
                yield self.ids[doc], int(ends[doc] - self.counts[doc]), int(self.counts[doc]), zlib.crc32(ids[done:upto].tobytes(), crc)
                done, doc, crc = upto, doc + 1, 0
            crc = zlib.crc32(ids[done:].tobytes(), crc)
            at += len(ids)


def cuts_at_spaces(path: str) -> bool:
    """Whether the tokenizer's own JSON proves that it encodes each word by itself.

    It does if normalisation is NFC, white space to one space and lower case letter by letter, pre-tokens are matches of
    PRETOKENS, none of which holds white space, the model has no dropout, and added tokens are taken as they stand and hold no
    white space: no step then looks across a space or a line feed.
    """
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    steps = (made.get("normalizer") or {}).get("normalizers") or []
    cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers") or []
    model, added = made["model"], made.get("added_tokens") or []
    return (
        [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["pattern"], cuts[0]["behavior"], cuts[0]["invert"]) == ({"Regex": PRETOKENS}, "Removed", True)
        and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
        and model["type"] == "BPE"
        and not model.get("dropout")
        and not any(x["lstrip"] or x["rstrip"] or x["normalized"] or x["single_word"] or x["content"].split() != [x["content"]] for x in added)
    )


class TextEncoder:
    """Encodes whole texts with the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array([*self.whole.encode(t, add_special_tokens=False).ids, END_ID], "<u4") for t in texts]


class WordEncoder(dict):
    """Encodes text word by word with the tokenizers library, for tokenizers that ``cuts_at_spaces`` proves to do so.

    A dictionary from word to ids that fills itself. A word goes whole through the library's normalizer and pre-tokenizer; those
    of LATIN characters alone, which NFC leaves as they are and whose classes are the same in every version of Unicode, are
    lower-cased and cut by the same pattern here, and their bytes get their letters here. Pre-tokens always get their ids from the
    library's model.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        whole = Tokenizer.from_file(path)
        self.whole, self.normal, self.cut, self.merge = whole.encode, whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str, whole.model.tokenize
        # Without added tokens the pattern is empty words', which have no ids.
        self.special = regex.compile("|".join(regex.escape(t.content) for t in whole.get_added_tokens_decoder().values()) or r"\A\Z").search
        self.latin, self.pretokens = regex.compile(LATIN).fullmatch, regex.compile(PRETOKENS).findall
        self.plain = re.compile(PRETOKENS.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")).findall
        self.letters = dict(enumerate(byte_letters()))
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHE:
            self.clear()
        if self.special(word):
            made = array.array("I", self.whole(word, add_special_tokens=False).ids).tobytes()
        elif (ascii_only := word.isascii() and word.isprintable()) or self.latin(word):
            known, cut = self.pieces, self.plain if ascii_only else self.pretokens
            made = b"".join([known.get(piece) or self._piece(piece) for piece in cut(word.lower())])
        else:
            made = array.array("I", [t.id for piece, _ in self.cut(self.normal(word)) for t in self.merge(piece)]).tobytes()
        self[word] = made
        return made

    def _piece(self, piece: str) -> bytes:
        """Ids of a pre-token; printable ASCII stands for its own bytes."""
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        made = self.pieces[piece] = array.array("I", [t.id for t in self.merge(letters)]).tobytes()
        return made

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        end, get = struct.pack("<I", END_ID), self.__getitem__
        return [np.frombuffer(b"".join(map(get, t.replace("\n", " ").split(" "))) + end, "<u4") for t in texts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder | TextEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path) if cuts_at_spaces(path) else TextEncoder(path)


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the shards, in ascending doc_id order; a row for each shard. Texts are moved once, ids never."""
    ordered = B.texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    folder = B.fresh_path(docs.sparkSession, "tokens")

    def write(batches):
        own, writer = encoder(tokenizer), None
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for begin in range(0, len(doc_ids), 256):
                part = batch.slice(begin, 256)
                for doc_id, ids in zip(doc_ids[begin : begin + 256], own.encode(part.column("text").to_pylist()), strict=True):
                    writer = writer or ShardWriter(f"{folder}/{uuid.uuid4().hex}.ids")
                    writer.add(doc_id, ids)
        made = [writer.close()] if writer else []
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in made], pa.string()), pa.array([part] * len(made), pa.int32()), pa.array([x[1] for x in made], pa.int64()), pa.array([x[2] for x in made], pa.int64())], ["shard", "part", "n_ids", "n_docs"])

    return B.written(ordered.mapInArrow(write, SHARDS), "shards")


def read_back(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")

    def read(batches):
        for batch in batches:
            for uri, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                columns = list(zip(*ShardReader(uri).checksums(), strict=True)) or [()] * 4
                arrays = [pa.array(c, pa.int64()) for c in columns]
                arrays[1] = pa.array([base + x for x in columns[1]], pa.int64())
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row a shard: the window over all of them sees only their sizes.
    n = max(1, shards.count())
    return shards.select("shard", before).repartition(n).mapInArrow(read, DOCS)
