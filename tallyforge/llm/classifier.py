"""Quality by votes of the nearest labelled documents in a latent-semantic space.

Terms are the hashed pairs of adjacent bytes and some shape tokens (capitals, digits, symbols, repeated lines and words). On
a bounded sample of labelled documents (``SAMPLE`` rows, those of smallest hash) the weights log(1 + count) * idf are factored
by SVD; the ``RANK`` leading directions and the sample's vectors are broadcast: SAMPLE * RANK + TERMS * RANK floats, 1.2 MB.
Every document is projected, its exact cosines with all labelled vectors are computed in blocks, and the labels of the
``NEIGHBOURS`` nearest vote with weights cosine ** ``SHARP``; a vote of the overall share of label 1 is added. Labelled documents
that are as near as the last of them (within ``TIE``) share the places that are left in equal parts, so no order of rows decides.
The sample's terms are counted on executors: the driver gets SAMPLE vectors, whatever the lengths of the texts.

Only labels of documents with crc32(doc_id) mod 3 != 1 are used; labels, lang, source and doc_id are never inputs of a score.
Null texts are empty: they have no direction, so their score is the share of label 1. Without labels every score is 0.5.
Labels that repeat a document count once, with the lowest mark; repeated rows are scored alike; texts of any length are counted
whole; other columns are left alone, whatever their names; without documents there are no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import _base as B

SAMPLE = 4000
RANK = 48
TERMS = 2048
NEIGHBOURS = 25
SHARP = 4
PRIOR = 0.1
TIE = 1e-5
BLOCK = 512
SHAPES = 12
SCORED = "doc_id long, score double"


def _bins() -> np.ndarray:
    codes = np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((codes >> np.uint64(40)) % np.uint64(TERMS - SHAPES)).astype(np.int64)


_BINS = _bins()
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _CLASS[_b] = 1 if 65 <= _b <= 90 else 2 if 48 <= _b <= 57 else 3 if chr(_b) in "#*$%&|<>" else 4 if chr(_b) in "!?" else 5 if chr(_b) in ".,;:" else 6 if _b == 10 else 7 if _b == 32 else 0


def counts(text: str) -> np.ndarray:
    """Term counts of one text, as shares of its bytes."""
    data = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros(TERMS, np.float32)
    if not len(data):
        return out
    out[: TERMS - SHAPES] = np.bincount(_BINS[data[:-1].astype(np.int64) << 8 | data[1:]], minlength=TERMS - SHAPES)
    kinds = np.bincount(_CLASS[data], minlength=8)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    windows = [tuple(words[i : i + 5]) for i in range(0, max(0, len(words) - 4))]
    shape = [*kinds[1:8], 0, 0, 0, 0, 0]
    shape[7] = len(data) * (len(lines) - len(set(lines))) / max(1, len(lines))
    shape[8] = len(data) * (len(windows) - len(set(windows))) / max(1, len(windows))
    shape[9] = len(data) * (len(words) < 20)
    shape[10] = len(data) / max(1, len(words))
    out[TERMS - SHAPES :] = shape
    return 1000 * out / len(data)


class Space:
    """Directions and labelled vectors; made once on the driver from the terms of the bounded sample."""

    def __init__(self, terms: list[np.ndarray], marks: list[int]):
        self.share = (sum(marks) + 1) / (len(marks) + 2)
        grid = np.array(terms, np.float32).reshape(len(terms), TERMS)
        np.log1p(grid, out=grid)
        self.idf = (np.log((1 + len(terms)) / (1 + (grid > 0).sum(axis=0))) + 1).astype(np.float32)
        grid *= self.idf
        self.mean = grid.mean(axis=0) if len(terms) else np.zeros(TERMS, np.float32)
        grid -= self.mean
        _, vectors = np.linalg.eigh(grid.T @ grid)
        self.axes = vectors[:, ::-1][:, :RANK].astype(np.float32)
        self.labels = np.array(marks, np.float32)
        self.known = self._unit(grid @ self.axes).astype(np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for begin in range(0, len(texts), BLOCK):
            part = texts[begin : begin + BLOCK]
            weights = np.log1p(np.array([counts(t) for t in part])) * self.idf - self.mean
            near = (self._unit(weights @ self.axes).astype(np.float32)) @ self.known.T
            last = np.partition(near, -k, axis=1)[:, -k][:, None]
            above, level = near > last + TIE, np.abs(near - last) <= TIE
            places = above + level * ((k - above.sum(axis=1)) / level.sum(axis=1))[:, None]
            vote = places * np.maximum(near, 0) ** SHARP
            got = vote @ self.labels + PRIOR * self.share
            full = np.array([bool(t) for t in part])
            out[begin : begin + BLOCK] = np.where(full, got / (vote.sum(axis=1) + PRIOR), self.share)
        return out


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame) -> Space:
    marks = labels.select(F.col("doc_id").cast("long").alias("l_doc"), F.col("quality").cast("int").alias("mark")).where("l_doc is not null and mark is not null").groupBy("l_doc").agg(F.min("mark").alias("mark"))
    chosen = marks.where(~held_out(F.col("l_doc"))).orderBy(F.xxhash64("l_doc"), "l_doc").limit(SAMPLE)
    chosen = B.written(chosen, "labelled_sample")
    # At most SAMPLE ids: they may be broadcast, and as many vectors come to the driver.
    rows = B.texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("l_doc")).select("l_doc", "text", "mark")

    def count(batches):
        for batch in batches:
            terms = [counts(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("l_doc"), pa.array(terms, pa.binary()), batch.column("mark")], ["l_doc", "terms", "mark"])

    # Rows that repeat a document count once, with the smallest vector.
    known = rows.mapInArrow(count, "l_doc long, terms binary, mark int").groupBy("l_doc").agg(F.min("terms").alias("terms"), F.min("mark").alias("mark")).orderBy("l_doc")
    terms, votes = [], []
    for row in known.toLocalIterator():
        terms.append(np.frombuffer(row.terms, np.float32))
        votes.append(row.mark)
    return Space(terms, votes)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    space = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))

    def score(batches):
        own = space.value
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own.scores(part.column("text").to_pylist()), pa.float64())], ["doc_id", "score"])

    done = B.texts(docs).mapInArrow(score, SCORED)
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
