import random

import numpy as np
from brute import DOCS, near, suffix

from tallyforge.llm import components as C
from tallyforge.llm import minhash as M
from tallyforge.llm import suffix as S

EXTRA = DOCS + ", text_a string, kept int"


def texts(seed, n=160):
    """Copies, near copies at many similarities, shared passages, repeats inside a text, odd texts."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    make = lambda k: [rnd.choice(vocabulary) for _ in range(k)]
    bases, passage, out = [make(rnd.randint(20, 120)) for _ in range(12)], make(30), []
    for _ in range(n):
        w = list(rnd.choice(bases)) if rnd.random() < 0.7 else make(rnd.randint(1, 80))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 4, 6])):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        if rnd.random() < 0.3:
            at = rnd.randrange(len(w))
            w[at:at] = passage
        out.append((" " if rnd.random() < 0.9 else "\n").join(w).capitalize())
    return [*out, None, "", " \n", "one", "One", "two words", "a b c d", "A B C D", "x" * 99, "x" * 100, "x" * 400, "ab" * 300, "é" * 250, ("line of words here\n" * 40), "x" * 350]


def frame(spark, items, schema=EXTRA):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash", 3) for i, t in items], schema).repartition(5)


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(30)] + [(5, 5)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r.node: r.root for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in {v for a, b in edges if a != b for v in (a, b)}}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    items = list(enumerate(texts(1)))
    random.Random(2).shuffle(items)
    items = list(enumerate(t for _, t in items))
    want = near(items)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.linked(frame(spark, items)).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}
    docs = frame(spark, [*items, items[3], (None, "no id")])
    kept = M.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i is not None} == {d for d, (_, c) in want.items() if c == d} and None in ids
    assert M.linked(docs.where("false")).count() == 0


def test_deep_regions(spark, monkeypatch):
    """Regions that have to be deepened give the same links."""
    monkeypatch.setattr(M, "REGION", 3)
    items = list(enumerate(texts(9, 120)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.linked(frame(spark, items)).collect()}
    assert got == near(items)


def test_recall_in_a_crowded_region(spark):
    """120 pairs just above and below 0.75 among 240 texts that share most of one boilerplate: components are those of all pairs."""
    rnd = random.Random(31)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(7))
    base, items = [word() for _ in range(100)], []
    for _ in range(120):
        own = [*base, *[word() for _ in range(40)]]
        other = list(own)
        for at in rnd.sample(range(100, 139), rnd.choice([1, 2, 3, 4])):
            other[at] = word()
        items += [" ".join(own), " ".join(other)]
    items = list(enumerate(items))
    want = near(items)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.linked(frame(spark, items)).collect()}
    linked = [d for d, (_, c) in want.items() if c != d]
    found = sum(got[d][1] == want[d][1] for d in linked) / len(linked)
    assert len(items) > 2 * M.REGION and 40 < len(linked) and found == 1.0 and got == want


def test_pairs_of_deepened_regions(spark, monkeypatch):
    """A near pair whose regions are all deepened and part below depth FIRST is found by the trees of crowded classes."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(8))
    base = [word() for _ in range(60)]
    items = [(i, " ".join(word() for _ in range(60))) for i in range(M.REGION + 6)] + [(100, " ".join(base)), (101, " ".join([*base[:59], word()]))]
    rows = []
    for d, t in items:
        s = M.shingle_hashes(t)
        first = [k if i < M.FIRST else d * 1000 + i for k in range(M.TREES) for i in range(M.DEPTH)]
        rows.append((d, len(s), d, d, first))
    monkeypatch.setattr(M, "signed", lambda docs: spark.createDataFrame(rows, M.SIGNED))
    got = {r.doc_id: r.component_id for r in M.linked(frame(spark, items)).collect()}
    assert got == {d: 100 if d == 101 else d for d, _ in items}
    assert (1 - 0.75**M.DEPTH) ** (M.TREES + M.MORE) < 1e-7


def test_repeated_strings(spark):
    items = list(enumerate(texts(3, 60)))
    want = suffix(items)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.reduced(frame(spark, items)).collect()}
    assert got == want
    docs = frame(spark, [(None, "z" * 50), (7, "q" * 120), (8, "q" * 120), (8, "q" * 120)])
    assert sorted((r.doc_id or -1, r.n_removed) for r in S.reduced(docs).collect()) == [(-1, 0), (7, 119), (8, 120), (8, 120)]
    assert S.reduced(docs.where("false")).count() == 0


def test_small_blocks(spark, monkeypatch):
    """Many blocks and tasks: hot runs, buckets that are mixed within a block, across blocks and across both routes."""
    monkeypatch.setattr(S, "BLOCK", 3000)
    monkeypatch.setattr(S, "TASK", 8000)
    items = list(enumerate(texts(5, 150)))
    hot = " of the passage that stands in many documents with other words about it, and is longer than any run of windows can be, "
    rnd = random.Random(6)
    more = [("".join(rnd.choice("abcdefg ") for _ in range(150)) + hot + "".join(rnd.choice("abcdefg ") for _ in range(rnd.randint(0, 99)))) for _ in range(60)]
    items += [(1000 + i, t) for i, t in enumerate([*more, *more[:5], *["same text over and over " * 9] * 40])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.reduced(frame(spark, items)).collect()}
    assert got == suffix(items)
    # Rows of one doc_id with different texts don't remove each other's bytes.
    a, b = more[0], more[1] * 3
    twice = frame(spark, [(4, a), (4, b), (4, b), (5, a)])
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in S.reduced(twice).collect()) == sorted([(4, len(a), 0), *[(4, len(b), 2 * len(more[1]))] * 2, (5, len(a), len(a))])


def test_long_texts(spark):
    """Texts that are scanned in several chunks, through Spark."""
    rnd = random.Random(8)
    a = "".join(rnd.choices("abcd é", k=1_150_000))
    items = [(0, a), (1, a[500_000:540_000] + a[:300]), (2, a[1_030_000:1_060_000] + "!" + a[1_060_001:1_070_000]), (3, "x" * 2000), (4, a[10:1_100_000])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.reduced(frame(spark, items)).collect()}
    assert got == suffix(items)


def test_signature_is_deterministic():
    a = M.shingle_hashes("a b c d e f g h")
    assert len(a) == 4 and (M.signature(a) == M.signature(a[::-1])).all() and a.dtype == np.uint64
