import random
import zlib

from brute import DOCS

from tallyforge.llm import classifier as K
from tallyforge.llm import decontam as D


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def test_leaks(spark):
    rnd = random.Random(4)
    items = [(1, "Anna buys 12 apples for 3.50 dollars and Ben buys 12 pears, so how many fruits do Anna and Ben have in all?"), (2, prose(rnd, 40)), (3, prose(rnd, 30).capitalize() + ".\n" + prose(rnd, 10)), (4, "too few words"), (5, None), (6, prose(rnd, 20))]
    text = dict(items)
    around = lambda t: prose(rnd, 50) + " " + t + " " + prose(rnd, 60)
    docs = {
        0: around(text[1]),
        1: around(text[1].replace("12", "75").replace("3.50", "9").replace("Anna", "Clara").replace("Ben", "Dirk")),
        2: around(text[1].replace("12 pears", "13 pears").replace("Anna and Ben", "Ben and Carl")),
        3: around(text[2]) + text[3],
        4: around(" ".join(text[2].split()[:20])),
        5: prose(rnd, 3000),
        6: None,
        7: "",
        8: around(" ".join(text[6].split()[:18])),
        9: "too few words",
        10: around(text[2].replace(" ", "\n \t")),
    }
    frame = spark.createDataFrame([(i, t, "en", "s", 0, 1, "x") for i, t in docs.items()] + [(3, docs[3], "en", "s", 0, 1, "x"), (None, docs[0], "", "", 0, 1, "")], DOCS + ", at int, h string").repartition(3)
    bench = spark.createDataFrame(items + [items[0]], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.leaks(frame, bench).collect()}
    assert set(got) == {(0, 1), (1, 1), (None, 1), (3, 2), (3, 3), (8, 6), (10, 2)}
    assert all(r.coverage <= 1 for r in got.values()) and got[(3, 2)].coverage > 0.97
    left = D.uncontaminated(frame, bench)
    assert left.columns == frame.columns and sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 6, 7, 9]
    assert D.leaks(frame.where("false"), bench).count() == 0 and D.uncontaminated(frame, bench.where("false")).count() == frame.count()


def test_names_that_open_sentences(spark):
    """Copies with other names and numbers are found wherever the names stand, copies whose names are mixed up are not."""
    item = "Anna has 5 apples. Anna gives 3 to Bob. Bob eats 2 of them. How many apples does Anna have?"
    quoted = "Nora sells 40 red pens every day. 'Nora must rest,' says her boss. Nora sells how many pens in a week of 6 days?"
    other = item.replace("Anna", "Maria").replace("Bob", "Tom").replace("5", "9").replace("3", "4").replace("2", "7")
    rnd = random.Random(11)
    docs = {0: item, 1: other, 2: prose(rnd, 30) + ". " + other + " " + prose(rnd, 30), 3: quoted.replace("Nora", "Iris").replace("40", "35"), 4: other.replace("Maria gives", "Tom gives"), 5: "Maria has 9 pears. Tom runs. Bob eats 2 of the cakes.", 6: "\x04 " + item + " \x05"}
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs.items()], DOCS)
    bench = spark.createDataFrame([(1, item), (2, quoted)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in D.leaks(frame, bench).collect()}
    assert set(got) == {(0, 1), (1, 1), (2, 1), (3, 2), (6, 1)} and all(0.75 <= c <= 1 for c in got.values())
    assert [r.doc_id for r in D.uncontaminated(frame, bench).orderBy("doc_id").collect()] == [4, 5]


def leaked(docs, items):
    """(doc, item) -> coverage, by plain comparison of all windows of all pairs."""
    import regex

    def forms(t):
        t = regex.sub(r"[\x20\x09-\x0D]+", " ", (t or "").strip(" \t\n\x0b\x0c\r"))
        c = regex.sub(r"(?<=[\p{L}\p{N},;] )\p{Lu}\p{Ll}+", "\x01", t)
        c = regex.sub(r"(?<![\p{L}\p{N}\x01]['’-]?)\p{Lu}\p{Ll}+", lambda m: "\x04" + m[0] + "\x05", c).lower()
        c = regex.sub(r"[0-9](?:[0-9.,:/]*[0-9])?", "\x02", c)
        c = regex.sub(rf"(?<=\x02 ?)(?:{D.UNITS})(?![\p{{L}}\p{{N}}\x04])", "\x03", c)
        c = regex.sub(r"[^\p{L}\p{N} \x01-\x05]+", "", c)
        split = lambda x: x.split(" ") if t else []
        return split(c.replace("\x04", "").replace("\x05", "")), split(regex.sub("\x04[^\x05]*\x05", "\x01", c)), split(t.lower())

    literal = lambda w: sum(bool(x) and not regex.search("[\x01-\x03]", x) for x in w)
    out = {}
    for i, item in items.items():
        *shapes, raw = forms(item)
        at = [k for k in range(len(raw) - 4) if literal(shapes[0][k : k + 5]) >= 3]
        for d, text in docs.items():
            *own, own_raw = forms(text)
            hit = set()
            for a, b in zip(shapes, own, strict=True):
                places = {}
                for k in range(len(b) - 4):
                    places.setdefault(tuple(b[k : k + 5]), []).append(k)
                shifts = {}
                for k in at:
                    if literal(a[k : k + 5]):
                        for p in places.get(tuple(a[k : k + 5]), []):
                            shifts.setdefault(p - k, []).append(k)
                for shift, ks in shifts.items():
                    sign = lambda c: regex.sub("[^\x01-\x03]", "", c)
                    pairs = {(sign(a[x]), raw[x].strip(".,;:!?()[]\"'"), own_raw[x + shift].strip(".,;:!?()[]\"'")) for k in ks for x in range(k, k + 5) if sign(a[x])}
                    names = [p for p in pairs if p[0][0] == "\x01"]
                    if len({p[:2] for p in pairs}) == len(pairs) and len({(p[0], p[2]) for p in names}) == len(names):
                        hit |= set(ks)
            if at and len(hit) >= D.COVER * len(at):
                out[d, i] = len(hit) / len(at)
    return out


def test_leaks_by_brute_force(spark):
    """Templates that share hot windows, with names and numbers redrawn, names mixed up, and parts cut off; one text is long."""
    rnd = random.Random(17)
    names, units = ["Anna", "Ben", "Clara", "Dirk", "Élodie"], ["kg", "hours", "km"]
    frames = ["{0} has {1} {4} of flour and {2} loaves. {3} gives {0} {1} more. How many does {0} have in all?", "How many does {0} have in all if {3} brings {1} boxes, then {2} more {4}? {3} knows how many.", "In {2} {4} the train of {3} passes {1} towns, and {0} counts them. How many does {0} have in all?"]

    def fill(f):
        a, b = rnd.sample(names, 2)
        return f.format(a, rnd.randint(1, 60), rnd.randint(1, 60), b, rnd.choice(units))

    items = {i: fill(frames[i % 3]) for i in range(9)} | {20: prose(rnd, 40), 21: "too short", 22: None, 23: prose(rnd, 12) + " 5 6 7 8 9 kg 4 5"}
    docs = {}
    for d in range(120):
        t = fill(rnd.choice(frames)) if d % 3 else rnd.choice([items[20], items[23], items[d % 9]])
        w = t.split()
        if rnd.random() < 0.4:
            w[rnd.randrange(len(w))] = rnd.choice([*names, "x", "7"])
        if rnd.random() < 0.3:
            w = w[rnd.randrange(4) : len(w) - rnd.randrange(6)]
        docs[d] = " ".join([prose(rnd, rnd.randint(0, 9)), *w, prose(rnd, rnd.randint(0, 9))]).strip()
    docs |= {200: None, 201: "", 202: "How many does", 203: prose(rnd, 50000) + " " + docs[3] + " " + prose(rnd, 30000)}
    frame = spark.createDataFrame([(i, t, "en", "s", 0, 1) for i, t in docs.items()], DOCS + ", item_id int").repartition(3)
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items.items()] + [(3, items[3], "x", 1)], "item_id long, text string, doc_id string, at int")
    got = {(r.doc_id, r.item_id): r.coverage for r in D.leaks(frame, bench).collect()}
    want = leaked(docs, items)
    assert got == want and 20 < len(want) and any(d == 203 for d, _ in want)


def test_quality_votes(spark):
    rnd = random.Random(6)
    texts, labels = {}, {}
    for i in range(700):
        good = i % 4 > 0
        words = prose(rnd, rnd.randint(20, 120)).split()
        texts[i] = " ".join(words if good else [w + rnd.choice(["%%%", "$$$", "###"]) for w in words]).capitalize()
        labels[i] = int(good)
    texts |= {700: None, 701: "", 702: "x"}
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 0.5) for i, t in texts.items()] + [(None, "abc", "", "", 0, 0.1)], DOCS + ", score double").repartition(3)
    marks = spark.createDataFrame([(i, q, 0) for i, q in labels.items()] * 2 + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in K.scored(docs, marks).collect()}
    assert len(got) == len(texts) + 1 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in texts) and not got[None].held_out
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) > 0.97 * len(held)
    # Labels of held-out documents change nothing.
    flipped = spark.createDataFrame([(i, 1 - q if got[i].held_out else q, 0) for i, q in labels.items()], "doc_id long, quality int, toxic int")
    again = {r.doc_id: r.score for r in K.scored(docs, flipped).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in texts)
    assert {r.score for r in K.scored(docs, marks.where("false")).collect()} == {0.5} and K.scored(docs.where("false"), marks.where("false")).count() == 0


def votes(texts, labels):
    """Scores by plain loops over an SVD of the labelled documents, in double precision."""
    import numpy as np

    known = [d for d in sorted(labels) if zlib.crc32(str(d).encode()) % 3 != 1]
    grid = np.log1p(np.array([K.counts(texts[d] or "") for d in known], float))
    idf = np.log((1 + len(known)) / (1 + (grid > 0).sum(axis=0))) + 1
    mean = (grid * idf).mean(axis=0)
    _, _, axes = np.linalg.svd(grid * idf - mean, full_matrices=False)
    place = lambda x: (x * idf - mean) @ axes[: K.RANK].T
    share = (sum(labels[d] for d in known) + 1) / (len(known) + 2)
    out = {}
    for d, t in texts.items():
        own = place(np.log1p(K.counts(t or "").astype(float)))
        near = sorted(((float(own @ v / np.linalg.norm(own) / np.linalg.norm(v)), labels[e]) for v, e in zip(place(grid), known, strict=True)), reverse=True)
        last = near[K.NEIGHBOURS - 1][0]
        above, level = [x for x in near if x[0] > last + K.TIE], [x for x in near if abs(x[0] - last) <= K.TIE]
        part = (K.NEIGHBOURS - len(above)) / len(level)
        vote = [(max(c, 0) ** K.SHARP, q) for c, q in above] + [(part * max(c, 0) ** K.SHARP, q) for c, q in level]
        out[d] = (sum(v * q for v, q in vote) + K.PRIOR * share) / (sum(v for v, _ in vote) + K.PRIOR) if t else share
    return out


def test_votes_by_brute_force(spark):
    """Copies of labelled documents with different labels tie at the last place; rows come in any order; one text is long."""
    rnd = random.Random(13)
    texts = {i: prose(rnd, rnd.randint(5, 60)) + rnd.choice(["", "!!", " $%&", " A B C"]) for i in range(200)}
    texts |= {200 + i: texts[7] for i in range(40)} | {300: None, 301: "", 302: prose(rnd, 60000)}
    labels = {i: rnd.randrange(2) for i in texts if i % 5}
    items = [(i, t, "en", "s", 0) for i, t in texts.items()]
    marks = spark.createDataFrame([(i, q, 0, "clash") for i, q in labels.items()], "doc_id long, quality int, toxic int, text string")
    want = votes(texts, labels)
    for seed in (1, 2):
        rnd.shuffle(items)
        got = {r.doc_id: r.score for r in K.scored(spark.createDataFrame(items, DOCS).repartition(seed + 2), marks).collect()}
        assert max(abs(got[i] - want[i]) for i in texts) < 1e-3
