"""Near duplicates by an LSH forest over MinHash signatures.

A document's set are its distinct five-word shingles (A-Z lower-cased; fewer words: the whole sequence). Documents with equal
sets are one class, and only its smallest doc_id goes on. Each of ``TREES`` trees orders the classes by ``DEPTH`` of their own
minimum hashes. A region are the classes that share a prefix of a tree's order; it starts at depth ``FIRST`` and is adaptively
deepened while it holds more than ``REGION`` classes. Classes of a region that was deepened are crowded: they get ``MORE`` trees
of full depth besides, as pairs may part where a region is deepened. Candidates:
1. each class with the most central member of its regions, its best one by the number of trees;
2. after linking those, all pairs in a region whose members are still in different components. A large region that the first
   step has connected has few of these, so no group emits all its pairs and no partner is left out.
Pairs of step 2 are compared by sketches of more hashes first (see FINE_AGREE). Every link is
confirmed on the full sets, 100 * intersection >= 75 * union. A pair at exactly 0.75 meets in no region once in 10^7: it shares
no prefix of depth FIRST with a probability of 6.6e-8; if all regions it shares were deepened, both its classes are crowded, and
it parts in all TREES + MORE trees at full depth with 2.5e-8. The sketches of step 2 lose another 1e-7 of the pairs they judge.

Null and empty texts are linked with nothing. Rows that repeat a doc_id are one node; rows without doc_id are kept.
"""

from __future__ import annotations

import functools
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import _base as B
from tallyforge.llm.components import components

SHINGLE = 5
SIMILARITY = 75
TREES = 20
DEPTH = 4
FIRST = 2
#: Further trees of crowded classes: (1 - 0.75^4)^46 = 2.5e-8.
MORE = 26
REGION = 64
#: Hashes of the sketches that pairs in split regions are compared by, and how many have to agree. A pair at 0.75 agrees in
#: 784 of 1,024 on average (four equal bits count), with a deviation of 13.6, so it falls below 713 once in 10^7.
FINE = 1024
FINE_AGREE = 713
#: Words whose hashes a worker remembers.
CACHE = 1_000_000
SIGNED = "doc_id long, n_shingles long, key_a long, key_b long, signature array<int>"
_SLICE = 1024


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers whose every output bit depends on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ x >> np.uint64(32)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        made = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE and len(word) < 64:
            self[word] = made
        return made


@functools.lru_cache(maxsize=1)
def _state():
    rng = np.random.default_rng(20240501)
    n = TREES * DEPTH
    odd = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _Words(), odd, rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text. Lower-casing and splitting bytes touch ASCII letters and space only."""
    known, _, _, weights = _state()
    words = np.array([known[w] for w in text.encode().lower().split()], np.uint64)
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    with np.errstate(over="ignore"):
        total = sum(words[i : len(words) - size + 1 + i] * weights[i] for i in range(size)) + np.uint64(size)
    return np.unique(mixed(total))


def minima(shingles: np.ndarray, odd: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the shingles."""
    low = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), _SLICE):
            low = np.minimum(low, (shingles[i : i + _SLICE, None] * odd + shift).min(axis=0))
    return low


def signature(shingles: np.ndarray) -> np.ndarray:
    _, odd, shift, _ = _state()
    return (minima(shingles, odd, shift) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signed(docs: DataFrame) -> DataFrame:
    """Set size, 128-bit key of the set and signature of each document."""

    def sign(batches):
        for batch in batches:
            sizes, keys, rows = [], ([], []), []
            for text in batch.column("text").to_pylist():
                s = shingle_hashes(text)
                sizes.append(len(s))
                with np.errstate(over="ignore"):
                    keys[0].append(int(mixed(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                    keys[1].append(int(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                rows.append(signature(s) if len(s) else np.zeros(0, np.int32))
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys[0], pa.int64()), pa.array(keys[1], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "n_shingles", "key_a", "key_b", "signature"])

    return B.texts(docs).mapInArrow(sign, SIGNED)


def more_signed(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and more, the minimum hashes of the MORE trees, of the documents ids."""

    def sign(batches):
        rng = np.random.default_rng(20240502)
        odd, shift = rng.integers(0, 2**63, MORE * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, MORE * DEPTH, dtype=np.uint64)
        for batch in batches:
            rows = [(minima(shingle_hashes(text), odd, shift) >> np.uint64(32)).astype(np.uint32).view(np.int32) for text in batch.column("text").to_pylist()]
            ends = np.arange(len(rows) + 1, dtype=np.int32) * (MORE * DEPTH)
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "more"])

    return B.texts(docs).join(ids, "doc_id", "left_semi").mapInArrow(sign, "doc_id long, more array<int>")


def shingle_set(text: Column) -> Column:
    """The set of hashed shingles of a text, by Spark expressions."""
    whole = lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))
    made = lambda w: F.when(F.size(w) < SHINGLE, whole(w)).otherwise(F.array_distinct(B.window_hashes(w, SHINGLE)))
    capitals = "".join(map(chr, range(65, 91)))
    return B.let(B.words(F.translate(text, capitals, capitals.lower())), made)


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    plain = B.texts(docs)
    of = lambda c: plain.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    both = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    common = lambda s: B.let(F.size(F.array_intersect(s["x"], s["y"])), lambda n: 100 * n >= SIMILARITY * (F.size(s["x"]) + F.size(s["y"]) - n))
    alike = B.let(F.struct(shingle_set(F.col("text_a")).alias("x"), shingle_set(F.col("text_b")).alias("y")), common)
    return B.written(both.where(alike).select("a", "b").distinct(), "links")


def regions(classes: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: doc_id, n_shingles, tree, region; stars: doc_id, hub; signatures of crowded classes: doc_id, more) of the classes' trees.

    The hub of a region is its most central member: the one whose regions at depth FIRST are largest in all trees together, as
    those of the text are that the others were copied from.
    """
    path = lambda c, t, k, d: F.xxhash64(F.lit(t), F.lit(d), *[F.get(c, F.lit(k * DEPTH + i)) for i in range(d)])
    at = lambda t, d: path("signature", t, t, d)
    depths = range(FIRST, DEPTH + 1)
    tree = lambda t: F.struct(F.lit(t).alias("tree"), *[at(t, d).alias(f"d{d}") for d in depths])
    active = B.written(classes.select("doc_id", "n_shingles", F.inline(F.array(*[tree(t) for t in range(TREES)]))), "trees")
    members, stars, degrees = [], [], None
    for d in depths:
        key = f"d{d}"
        groups = B.written(active.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "region_sizes")
        placed = B.written(active.join(groups, key), "placed")
        B.drop(active)
        if degrees is None:
            degrees = B.written(placed.groupBy("doc_id").agg(F.sum("n").alias("degree")), "degrees")
            crowded = B.written(placed.where(F.col("n") > REGION).select("doc_id", "n_shingles").distinct(), "crowded")
        central = F.max(F.struct("degree", (-F.col("doc_id")).alias("minus_id"))).alias("top")
        hubs = B.written(placed.join(degrees, "doc_id").groupBy(key).agg(central).select(key, (-F.col("top.minus_id")).alias("hub")), "hubs")
        stars.append(placed.join(hubs, key).select("doc_id", "hub"))
        last = d == DEPTH
        members.append((placed if last else placed.where(F.col("n") <= REGION)).select("doc_id", "n_shingles", "tree", F.col(key).alias("region")))
        if not last:
            active = B.written(placed.where(F.col("n") > REGION).select("doc_id", "n_shingles", "tree", *[f"d{x}" for x in depths if x > d]), "trees")
    more = B.written(more_signed(docs, crowded.select("doc_id").distinct()), "more_signatures")
    deep = lambda k: F.struct(F.lit(TREES + k).alias("tree"), path("more", TREES + k, k, DEPTH).alias("region"))
    active = B.written(crowded.join(more, "doc_id").select("doc_id", "n_shingles", F.inline(F.array(*[deep(k) for k in range(MORE)]))), "more_trees")
    groups = B.written(active.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "region_sizes")
    members.append(active.join(groups.select("region"), "region", "left_semi").select("doc_id", "n_shingles", "tree", "region"))
    union = lambda parts: functools.reduce(DataFrame.unionAll, parts)
    return union(members), union(stars), more


def sketched(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and w0, w1, ...: four bits of each of FINE more minimum hashes, sixteen in a long, of the documents ids."""

    def sketch(batches):
        rng = np.random.default_rng(977)
        odd, shift = rng.integers(0, 2**63, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, FINE, dtype=np.uint64)
        for batch in batches:
            rows = np.zeros((batch.num_rows, FINE // 16), np.uint64)
            for i, text in enumerate(batch.column("text").to_pylist()):
                low = mixed(minima(shingle_hashes(text), odd, shift)) >> np.uint64(60)
                for k in range(16):
                    rows[i] |= low[k::16] << np.uint64(4 * k)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in np.ascontiguousarray(rows.T).view(np.int64)]], ["doc_id", *[f"w{k}" for k in range(FINE // 16)]])

    schema = "doc_id long, " + ", ".join(f"w{k} long" for k in range(FINE // 16))
    return B.texts(docs).join(ids, "doc_id", "left_semi").mapInArrow(sketch, schema)


def crossing(members: DataFrame, roots: DataFrame, signatures: DataFrame, more: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs in one region whose members lie in different components and whose sketches agree enough."""
    placed = members.join(roots, F.col("doc_id") == F.col("node"), "left").select("tree", "region", "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("root"))
    placed = B.written(placed, "members")
    held = placed.groupBy("region", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("region").agg(F.count(F.lit(1)).alias("n_roots"), F.max(F.struct("n", "root")).alias("most"))
    split = B.written(held.where("n_roots > 1").select("region", F.col("most.root").alias("main")), "split_regions")
    mixed_members = B.written(placed.join(split, "region"), "mixed_members")
    ids = B.written(mixed_members.select("doc_id").distinct(), "mixed_ids")
    leaf = lambda c, t, k: F.hash(*[F.get(c, F.lit(k * DEPTH + i)) for i in range(DEPTH)]).alias(f"leaf{t}")
    # Classes that aren't crowded have no ``more``; their leaves of those trees are equal, but no region of a later tree holds them.
    paths = [*[leaf("signature", t, t) for t in range(TREES)], *[leaf("more", TREES + k, k) for k in range(MORE)]]
    leaves = signatures.join(ids, "doc_id", "left_semi").join(more, "doc_id", "left").select("doc_id", *paths)
    wide = B.written(mixed_members.join(leaves, "doc_id").join(B.written(sketched(docs, ids), "sketches"), "doc_id"), "wide_members")
    every, other = wide.alias("y"), wide.where("root != main").alias("x")  # of two components in a region, one at least isn't its main one
    col = lambda side, c: F.col(f"{side}.{c}")
    fits = 100 * F.least(col("x", "n_shingles"), col("y", "n_shingles")) >= SIMILARITY * F.greatest(col("x", "n_shingles"), col("y", "n_shingles"))
    agree = functools.reduce(operator.add, [_same_nibbles(col("x", f"w{k}"), col("y", f"w{k}")) for k in range(FINE // 16)])
    # A pair that shares a whole path of an earlier tree is formed there.
    before = functools.reduce(operator.or_, [(col("x", "tree") > t) & (col("x", f"leaf{t}") == col("y", f"leaf{t}")) for t in range(TREES + MORE - 1)])
    on = (col("x", "region") == col("y", "region")) & (col("x", "root") != col("y", "root")) & fits & ~before & (agree >= FINE_AGREE)
    pairs = other.join(every, on).select(F.least(col("x", "doc_id"), col("y", "doc_id")).alias("a"), F.greatest(col("x", "doc_id"), col("y", "doc_id")).alias("b"))
    return B.written(pairs.distinct(), "near_pairs")


def _same_nibbles(x: Column, y: Column) -> Column:
    """How many of the sixteen groups of four bits are equal."""
    d = x.bitwiseXOR(y)
    d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
    d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
    return 16 - F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each document."""
    own = B.written(signed(docs), "signatures")
    filled = own.where("n_shingles > 0 and doc_id is not null")
    keys = ["n_shingles", "key_a", "key_b"]
    classes = B.written(filled.groupBy(*keys).agg(F.min("doc_id").alias("first")), "classes")
    signatures = B.written(filled.join(classes.select("first"), F.col("doc_id") == F.col("first"), "left_semi").select("doc_id", "n_shingles", "signature"), "class_signatures")
    members, stars, more = regions(signatures, docs)
    votes = stars.where("doc_id != hub").groupBy("doc_id", "hub").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("doc_id").agg(F.max(F.struct("votes", (-F.col("hub")).alias("minus_hub"))).alias("best"))
    first = B.written(best.select((-F.col("best.minus_hub")).alias("a"), F.col("doc_id").alias("b")), "star_pairs")
    links = confirmed(first, docs)
    links = links.unionAll(confirmed(crossing(members, components(links), signatures, more, docs), docs))
    roots = components(links)
    known = classes.join(roots, F.col("first") == F.col("node"), "left").select(*keys, F.coalesce("root", "first").alias("component"))
    known = B.written(known, "class_components")
    done = own.drop("signature").join(known, keys, "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return done.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without those that aren't kept. Rows that repeat a kept doc_id stay."""
    gone = B.written(linked(docs).where("not kept").select(F.col("doc_id").alias("d_gone")).distinct(), "near_copies")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("d_gone"), "left_anti")
