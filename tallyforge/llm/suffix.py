"""Removal of repeated 100-byte strings: buckets of suffixes, sorted one block at a time, with ranks for long ties.

Two equal 100-byte windows need a sampled position at the same offset. A difference cover by position gives one, but each of
its samples is a record, and a window is met through each of its samples; here the cover is chosen by content: the sample
(anchor) of a window is the leftmost 40-gram of smallest hash in it, one position in 31, and every window has exactly one.
Consecutive windows with one anchor are a run. The anchor's 40-gram names the bucket, and the hash of the run's whole content is
its rank: ties are resolved by comparing ranks instead of up to 160 bytes. A rank is compared for equality only, so it is no
lexicographic order; nothing here needs one.

1. A task scans its texts in blocks of ``BLOCK`` bytes, sorts a block's runs by bucket and rank, and keeps the first run of each
   rank: the others are repeats for certain. Blocks of records, not rows, are shuffled.
2. The records of one block of buckets are sorted together. A run whose rank came before is a repeat. Buckets of one rank
   are done; in buckets of several ranks the first runs of the ranks may share windows, and go on.
3. Their windows are hashed (96 bits), the windows of a block are sorted as the runs were, and those that came before are marked.
4. Marks meet the texts of their documents again, and the bytes that they cover are cut out.

A bucket that has several ranks within one block is known to go on. Its records are dealt by bucket and rank, and only a
notice of it goes to the bucket's own task, so no task gets a hot bucket whole; of a hot run or window each block sends one record.
Blocks of records are dealt by hashes over as many tasks as the bytes of the texts need, so memory is bounded.

Hashes stand for the strings (bucket and rank 64 bits each, window 96 bits). Null texts are empty; texts of any length are
scanned whole; a null doc_id comes first; rows that repeat a doc_id don't remove each other's bytes, whether their texts are
equal or not; other columns are left alone; without documents there are no rows.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import _base as B
from tallyforge.llm.minhash import mixed

LENGTH = 100
GRAM = 40
#: Bytes that are scanned at once; positions in them fit the low 20 bits of a packed value.
CHUNK = (1 << 20) - 256
#: Bytes of text whose runs are sorted together before they are shuffled.
BLOCK = 1 << 24
#: Bytes of text for each task that sorts records or meets texts.
TASK = 1 << 25
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_POSITION = np.uint64((1 << 20) - 1)
#: Kinds of packed rows, and the columns of each: a row of a text is its document and the hash of its document and text.
RUNS, KNOWN, MIXED, MARKS, WINDOWS, TEXT = range(6)
_PLACE = ["<i8", "<i4", "<u4", "u1"]
COLUMNS = {RUNS: ["<u8", "<u8", *_PLACE], KNOWN: ["<u8", "<u8", *_PLACE], MIXED: ["<u8"], MARKS: ["<i8", "<i4", "<u4", "<u4"], WINDOWS: ["<u8", "<u4", *_PLACE[:3]]}
PACKED = "part int, kind int, data binary"


@functools.lru_cache(maxsize=1)
def _tables():
    rng = np.random.default_rng(7071)
    byte = rng.integers(0, 2**64, (3, 256), dtype=np.uint64)
    odd = rng.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def powers(base: int) -> np.ndarray:
        out = np.full(CHUNK + 1, base % 2**64, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    bases = [int(odd[6]), int(odd[7])]
    return byte, odd, [powers(b) for b in bases], [powers(pow(b, -1, 2**64)) for b in bases]


def _sums(data: np.ndarray, which: int) -> np.ndarray:
    """Prefix sums of the bytes' values times powers of a base: the hash of any substring is a difference of two."""
    byte, _, up, _ = _tables()
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte[1 + which][data] * up[which][: len(data)], out=out[1:])
    return out


def _hash(sums: np.ndarray, which: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[begin]) * _tables()[3][which][begin])


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on: of 32 by doubling, with the 8 behind them."""
    byte, odd, _, _ = _tables()
    h, size = byte[0][data], 1
    for k in range(5):
        h = h[:-size] * odd[k] + h[size:]
        size *= 2
        if size == GRAM - 32:
            tail = h
    return mixed(h[: len(tail) - 32] * odd[5] + tail[32:])


def scan(data: np.ndarray, valid: np.ndarray, limits: np.ndarray):
    """Runs of a chunk: start of the first window, number of windows, bucket and rank; a run ends where limits change."""
    with np.errstate(over="ignore"):
        gram = _grams(data)
        low = gram & ~_POSITION | np.arange(len(gram), dtype=np.uint64)
        width, reach = LENGTH - GRAM + 1, 1
        while 2 * reach <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        rest = width - reach
        low = np.minimum(low[:-rest], low[rest:]) if rest else low
        at = np.flatnonzero(valid[: len(low)])
        own = (low[at] & _POSITION).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1) | (limits[at[1:]] != limits[at[:-1]])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        start = at[first]
        return start, count, gram[own[first]], _hash(_sums(data, 0), 0, start, start + count - 1 + LENGTH)


def chunks(texts: list[bytes]):
    """Lists of (document, offset in it, bytes): several short documents or a part of a long one.

    Parts of a long document overlap by LENGTH - 1 bytes, so every window is in one of them."""
    pieces, held = [], 0
    for i, t in enumerate(texts):
        step = CHUNK - LENGTH + 1
        for begin in range(0, len(t) - LENGTH + 1, step):
            part = t[begin : begin + CHUNK]
            if held + len(part) > CHUNK:
                yield pieces
                pieces, held = [], 0
            pieces.append((i, begin, part))
            held += len(part)
    if pieces:
        yield pieces


def runs(texts: list[bytes]):
    """Arrays document, start, n, bucket, rank of all runs of the texts."""
    found = []
    for pieces in chunks(texts):
        data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
        sizes = np.array([len(p) for _, _, p in pieces])
        begin = np.cumsum(sizes) - sizes
        piece = np.repeat(np.arange(len(pieces)), sizes)
        valid = np.arange(len(data)) + LENGTH <= (begin + sizes)[piece]
        start, count, bucket, rank = scan(data, valid, piece)
        of = piece[start]
        found.append((np.array([i for i, _, _ in pieces])[of], start - begin[of] + np.array([b for _, b, _ in pieces])[of], count, bucket, rank))
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2


def settle(a, b, doc, row, start):
    """(order by a, b and place; whether a row is the first of its (a, b); whether its (a, b) came before, in a smaller document or earlier in its own row)."""
    order = np.lexsort((start, row, doc, b, a))
    n = len(order)
    if not n:
        return order, np.zeros(0, bool), np.zeros(0, bool)
    a, b, doc, row, start = (x[order] for x in (a, b, doc, row, start))
    new, own = np.ones(n, bool), np.ones(n, bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    own[1:] = new[1:] | (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])
    since = lambda marks: np.maximum.accumulate(np.where(marks, np.arange(n), 0))
    return order, new, (doc > doc[since(new)]) | (start > start[since(own)])


def several(a: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Whether the a of each row, rows sorted by it, has two firsts or more."""
    if not len(a):
        return np.zeros(0, bool)
    of = np.cumsum(np.append(True, a[1:] != a[:-1])) - 1
    return np.bincount(of, weights=new)[of] > 1


def packed(kind: int, part: np.ndarray, *columns: np.ndarray):
    """(part, kind, data) of the rows of each part, ordered by place, column after column."""
    keys = columns[-3:-1] if kind == WINDOWS else columns[2:5:2] if kind in (RUNS, KNOWN) else columns[:1]
    order = np.lexsort((*keys[::-1], part))
    edges = np.append(np.flatnonzero(np.append(True, np.diff(part[order]) != 0)), len(order)) if len(order) else [0]
    columns = [np.asarray(c)[order].astype(t) for c, t in zip(columns, COLUMNS[kind], strict=True)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield int(part[order[lo]]), kind, b"".join([c[lo:hi].tobytes() for c in columns])


def unpacked(kind: int, blobs: list[bytes]) -> list[np.ndarray]:
    types = [np.dtype(t) for t in COLUMNS[kind]]
    width = sum(t.itemsize for t in types)
    out: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in types]
    for blob in blobs:
        n, at = len(blob) // width, 0
        for t, held in zip(types, out, strict=True):
            held.append(np.frombuffer(blob, t, n, at))
            at += n * t.itemsize
    return [np.concatenate(x) for x in out]


def marks_of(parts: int, doc, row, start, n):
    """Packed marks, those that continue one another joined."""
    if not len(doc):
        return
    order = np.lexsort((start, row, doc))
    doc, row, start = doc[order], row[order], start[order].astype(np.int64)
    end = start + n[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (start[1:] != end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    yield from packed(MARKS, row[first].astype(np.int64) % parts, doc[first], row[first], start[first], end[last] - start[first])


def _rows(made):
    part, kind, data = list(zip(*made, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], ["part", "kind", "data"])


def _blocks(batch, size: int):
    """Slices of a batch of some MB of text, with their texts as bytes."""
    texts, begin, held = [], 0, 0
    for i, t in enumerate(batch.column("text")):
        texts.append(t.as_py().encode())
        held += len(texts[-1])
        if held >= size:
            yield batch.slice(begin, i + 1 - begin), texts
            texts, begin, held = [], i + 1, 0
    if texts:
        yield batch.slice(begin), texts


def _scanned(plain: DataFrame, parts: int, block: int) -> DataFrame:
    """Packed runs of each block: the first of each rank, the others as marks."""

    def find(batches):
        for batch in batches:
            for piece, texts in _blocks(batch, block):
                at, start, n, bucket, rank = runs(texts)
                doc, row = (np.asarray(piece.column(c))[at] for c in ("doc_id", "row"))
                order, new, sure = settle(bucket, rank, doc, row, start)
                crowd = several(bucket[order], new)
                take = lambda mask, *c: [x[order[mask]] for x in c]
                made = list(marks_of(parts, *take(sure, doc, row, start, n)))
                b, r, *place = take(~sure & ~crowd, bucket, rank, doc, row, start, n)
                made += packed(RUNS, (b >> np.uint64(20)) % np.uint64(parts), b, r, *place)
                b, r, *place = take(~sure & crowd, bucket, rank, doc, row, start, n)
                made += packed(KNOWN, (r >> np.uint64(20)) % np.uint64(parts), b, r, *place)
                b = np.unique(b)
                made += packed(MIXED, (b >> np.uint64(20)) % np.uint64(parts), b)
                yield _rows(made)

    return plain.select("doc_id", "row", "text").mapInArrow(find, PACKED)


def _ranked(rows: DataFrame, parts: int) -> DataFrame:
    """Packed marks of the runs whose rank came before, and RUNS whose windows have to be compared, of blocks of buckets."""

    def sort(batches):
        held: dict[int, list[bytes]] = {k: [] for k in COLUMNS}
        for batch in batches:
            own = batch.column("kind").to_pylist()
            through = [k == MARKS for k in own]
            if any(through):
                yield batch.filter(pa.array(through))
            for kind, data in zip(own, batch.column("data"), strict=True):
                if kind != MARKS:
                    held[kind].append(data.as_py())
        told = np.unique(unpacked(MIXED, held[MIXED])[0])
        for kind in (RUNS, KNOWN):
            bucket, rank, doc, row, start, n = unpacked(kind, held.pop(kind))
            order, new, sure = settle(bucket, rank, doc, row, start)
            go = ~sure
            if kind == RUNS:
                go &= several(bucket[order], new) | np.isin(bucket[order], told)
            take = lambda mask, *c: [x[order[mask]] for x in c]
            yield _rows(marks_of(parts, *take(sure, doc, row, start, n)))
            b, r, *place = take(go, bucket, rank, doc, row, start, n)
            yield _rows(packed(RUNS, place[1].astype(np.int64) % parts, b, r, *place))

    return rows.repartitionById(parts, "part").mapInArrow(sort, PACKED)


def _with_texts(rows: DataFrame, plain: DataFrame, parts: int) -> DataFrame:
    """Packed rows and texts of the same part together, the packed rows first."""
    texts = plain.select(F.pmod("row", F.lit(parts)).alias("part"), F.lit(TEXT).alias("kind"), F.lit(None).cast("binary").alias("data"), "doc_id", "row", "text")
    none = lambda c: F.lit(None).cast(plain.schema[c].dataType).alias(c)
    every = rows.select("part", "kind", "data", *[none(c) for c in ("doc_id", "row", "text")]).unionAll(texts)
    return every.repartitionById(parts, "part").sortWithinPartitions("part", "kind")


def _met(batches, kind: int, size: int):
    """(texts' slice, their bytes, first and last place of each in the columns, columns) for each block of texts of a part."""
    part, blobs, columns, place = None, [], None, {}
    for batch in batches:
        own = np.stack([np.asarray(batch.column(c)) for c in ("part", "kind")], axis=1)
        edges = np.append(np.flatnonzero(np.append(True, (np.diff(own, axis=0) != 0).any(axis=1))), len(own)) if len(own) else [0]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if own[lo, 0] != part:
                part, blobs, columns = own[lo, 0], [], None
            if own[lo, 1] != TEXT:
                blobs += [x.as_py() for x in batch.column("data").slice(lo, hi - lo)]
                continue
            if columns is None:
                columns = unpacked(kind, blobs)
                doc, row, start = columns[-4:-1]
                order = np.lexsort((start, row, doc))
                columns, blobs = [c[order] for c in columns], []
                doc, row = columns[-4], columns[-3]
                first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]))) if len(doc) else np.zeros(0, np.int64)
                place = dict(zip(zip(doc[first].tolist(), row[first].tolist(), strict=True), zip(first.tolist(), np.append(first, len(doc))[1:].tolist(), strict=True), strict=True))
            for piece, texts in _blocks(batch.slice(lo, hi - lo), size):
                keys = zip(piece.column("doc_id").to_pylist(), piece.column("row").to_pylist(), strict=True)
                yield piece, texts, [place.get(k, (0, 0)) for k in keys], columns


def windows(texts: list[bytes], of: np.ndarray, start: np.ndarray, n: np.ndarray):
    """(run, start, two hashes) of all windows of the runs: ``of`` is the text of each."""
    sizes = n + (LENGTH - 1)
    ends, out, begin = np.cumsum(sizes), [], 0
    flat = np.frombuffer(b"".join(texts), np.uint8)
    offset = np.cumsum([0, *map(len, texts)])[of] + start
    while begin < len(of):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + CHUNK, "right")))
        size, count = sizes[begin:stop], n[begin:stop]
        at = np.cumsum(size) - size
        data = flat[np.repeat(offset[begin:stop] - at, size) + np.arange(size.sum())]
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        first = np.repeat(at, count) + k
        with np.errstate(over="ignore"):
            hashes = [_hash(_sums(data, w), w, first, first + LENGTH) for w in (0, 1)]
        out.append((np.repeat(np.arange(begin, stop), count), np.repeat(start[begin:stop], count) + k, *hashes))
        begin = stop
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _windows(rows: DataFrame, plain: DataFrame, parts: int, block: int) -> DataFrame:
    """Packed marks of the windows of the runs in rows that came before."""

    def find(batches):
        for _, texts, places, (_, _, doc, row, start, n) in _met(batches, RUNS, block):
            counts = np.array([hi - lo for lo, hi in places])
            if not counts.any():
                continue
            which = np.concatenate([np.arange(lo, hi) for lo, hi in places])
            run, at, a, b = windows(texts, np.repeat(np.arange(len(texts)), counts), start[which].astype(np.int64), n[which].astype(np.int64))
            doc_of, row_of, b = doc[which][run], row[which][run], b >> np.uint64(32)
            order, _, sure = settle(a, b, doc_of, row_of, at)
            take = lambda mask, *c: [x[order[mask]] for x in c]
            d, r, s = take(sure, doc_of, row_of, at)
            made = list(marks_of(parts, d, r, s, np.ones(len(d), np.int64)))
            columns = take(~sure, a, b, doc_of, row_of, at)
            yield _rows(made + list(packed(WINDOWS, (columns[0] >> np.uint64(20)) % np.uint64(parts), *columns)))

    def sort(batches):
        held = []
        for batch in batches:
            marks = [k == MARKS for k in batch.column("kind").to_pylist()]
            if any(marks):
                yield batch.filter(pa.array(marks))
            held += [x.as_py() for x, m in zip(batch.column("data"), marks, strict=True) if not m]
        a, b, doc, row, at = unpacked(WINDOWS, held)
        order, _, sure = settle(a, b, doc, row, at)
        d, r, s = (x[order[sure]] for x in (doc, row, at))
        yield _rows(marks_of(parts, d, r, s, np.ones(len(d), np.int64)))

    return _with_texts(rows, plain, parts).mapInArrow(find, PACKED).repartitionById(parts, "part").mapInArrow(sort, PACKED)


def cut(data: bytes, start: np.ndarray, n: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs and the bytes left when the windows start to start + n - 1 are taken out."""
    if not len(start):
        return 0, 0, data
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, start.astype(np.int64) + n - 1 + LENGTH, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), np.frombuffer(data, np.uint8)[~gone].tobytes()


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id, a null one as the smallest long, row, the hash of doc_id and text, and text."""
    plain = B.texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(-(2**63)).cast("long")))
    return plain.select("doc_id", F.hash("doc_id", "text").alias("row"), "text")


def repeated_windows(plain: DataFrame, parts: int, block: int) -> DataFrame:
    """Packed marks, the windows that came before, of the texts of plain."""
    found = B.written(_ranked(_scanned(plain, parts, block), parts), "ranked_runs")
    late = B.written(_windows(found.where(F.col("kind") == RUNS), plain, parts, block), "window_marks")
    return found.where(F.col("kind") == MARKS).unionAll(late)


def reduced(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    plain, block = ordered(docs), BLOCK
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK))

    def apply(batches):
        for piece, texts, places, (_, _, start, n) in _met(batches, MARKS, block):
            rows = []
            for data, (lo, hi) in zip(texts, places, strict=True):
                removed, spans, left = cut(data, start[lo:hi], n[lo:hi])
                rows.append((len(data), removed, spans, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = _with_texts(repeated_windows(plain, parts, block), plain, parts).mapInArrow(apply, RESULT)
    return done.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(2**63)).cast("long"), F.col("doc_id")))
