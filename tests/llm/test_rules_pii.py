import random

import pytest
from brute import DOCS, pii, rules

from tallyforge.llm import pii as P
from tallyforge.llm import rules as R

ODD = [
    None,
    "",
    " \t\n",
    "one",
    "\n\n a b \n a b \n",
    "a@b.c%x@y.z d1@e.f a@b.c@d.e not@here x.y@z",
    "1.2.3.4 255.255.255.256 01.002.0003.4 1.2.3.4.5.6.7.8 999.1.1.1 00000000000000000000001.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111110000 1 2 3",
    "+33 (0)1.23.45.67.89 call +1 (528) 555-3435, +12 +123456789012345678",
    "é 𝒳𝒳 mail 𝒳a@b.co é+33 123 456 789 é",
    "a." * 30000 + "@x" + "a-" * 9000,
    "x@" + "y.z" * 20000,
    "0" * 40000 + " " + "1 " * 30000,
    "tok en is re pe at tok en is re pe at tail",
    " ".join(f"w{i % 50}" for i in range(20000)),
    "# * $ % & | < > ! A" * 30,
]


def rows(texts, first=0):
    return [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def test_rules_match_plain_python(spark):
    rnd = random.Random(3)
    texts = ODD + ["\n".join(" ".join(rnd.choice(["a", "bb", "É", "x#", "y!"]) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    docs = spark.createDataFrame(rows(texts), DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in R.apply_rules(docs, labels).collect()}
    for i, t in enumerate(texts):
        want = rules(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, t
        assert r.kept == (not want[-1])


def test_rules_bound_and_columns(spark):
    from math import comb

    for n, k, p in ((50, 0, 0.01), (300, 3, 0.02), (1000, 12, 0.01)):
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        import math

        from pyspark.sql import functions as F

        got = spark.range(1).select(R.log_binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("x")).first().x
        assert got == pytest.approx(math.log(exact), rel=1e-9)
    good = " ".join(f"word{i}" for i in range(40))
    noisy = " ".join(f"word{i}%%%" for i in range(40))
    docs = spark.createDataFrame([(i, f"{i} " + (noisy if i % 5 == 0 else good), "en", "s", 1, 7) for i in range(3000)], DOCS + ", q_kept int")
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(3000)] * 2, "doc_id long, quality int, toxic int")
    kept = R.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(3000) if i % 5}
    assert R.accepted(docs.where("false"), labels).count() == 0 and R.apply_rules(docs.where("false"), labels.where("false")).count() == 0


def test_strata_by_brute_force(spark):
    """Cutoffs of a large stratum, of small ones in a pool, and of one whose good documents are noisy."""
    import math

    from pyspark.sql import functions as F

    rnd, docs, marks = random.Random(5), [], []
    for i in range(900):
        lang = rnd.choice(["en", "en", "en", "de", "de", "fr", "xx", None] if i % 9 else ["es"])
        good = rnd.random() < 0.8
        noise = rnd.choice([0, 0, 3, 12]) if lang == "de" else 0 if good else rnd.choice([8, 20, 40])
        words = [f"w{rnd.randrange(10**6)}" for _ in range(40)]
        docs.append((i, " ".join(w + ("%%" if k < noise else "") for k, w in enumerate(words)), lang, "s", 1))
        if i % 3:
            marks.append((i, int(good), 0))
    frame, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    features = R.counted(frame, "doc_id", "lang")
    steps = {r.doc_id: (r.lang if r.lang in R.STRATA else R.POOL, r.q_step, r.q_symbols_per_word) for r in features.collect()}
    assert all(s == next((i for i, c in enumerate(R.RULES["symbols_per_word"]) if v > c), R.STEPS) for _, s, v in steps.values())
    good = [d for d, q, _ in marks if q]
    level, need = R.ERROR / 5, R.fewest(R.RISK, R.ERROR)
    assert (1 - R.RISK) ** need <= level < (1 - R.RISK) ** (need - 1)
    size = {s: sum(steps[d][0] == s for d in good) for s in (*R.STRATA, R.POOL)}
    pool = {s: s if n >= need else R.POOL for s, n in size.items()}
    want = {}
    for p in set(pool.values()):
        own = [steps[d][1] for d in good if pool[steps[d][0]] == p]
        n, best = len(own), None
        for i in range(R.STEPS):
            k = sum(s <= i for s in own)
            if k <= R.RISK * n and sum(math.comb(n, x) * R.RISK**x * (1 - R.RISK) ** (n - x) for x in range(k + 1)) <= level:
                best = i
        want |= {s: best for s, q in pool.items() if q == p}
    got = {r.q_stratum: r.q_cut for r in R.thresholds(features, labels).collect()}
    assert got == want and want["en"] == R.STEPS - 1 and pool["es"] == R.POOL != pool["de"] and want["de"] != want["en"]
    kept = {r.doc_id: r.kept for r in R.apply_rules(frame, labels).collect()}
    assert kept == {d: not (want[s] is not None and k <= want[s]) for d, (s, k, _) in steps.items()}
    assert {r.doc_id for r in R.accepted(frame.withColumn("q_step", F.lit("clash")), labels).collect()} == {d for d, k in kept.items() if k}


def test_pii_base(spark):
    docs = spark.createDataFrame([(*r, "x") for r in rows(ODD)] + [(None, "a@b.cd", None, None, None, None)], DOCS + ", spans string")
    got = {r.doc_id: r for r in P.detect(docs).collect()}
    for i, t in enumerate(ODD):
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) == pii(t), (t or "")[:80]
    assert got[None].n_email == 1
    assert P.detect(docs.where("false")).count() == 0


def test_pii_terms(spark):
    texts = [f"common words here {i} zanzibar writes from boss@corp.com today {i}" for i in range(5)] + [f"common words here today only {i}" for i in range(60)] + ["boss@corp.com far away " + "pad " * 40 + "Zanzibar"]
    docs = spark.createDataFrame(rows(texts), DOCS)
    got = {r.doc_id: r.spans for r in P.detect(docs).collect()}
    assert "term:20:28" in got[0] and "email" in got[0] and got[7] == ""
    assert got[65].count("term:") >= 1
    clean = {r.doc_id: r for r in P.sanitised(docs).collect()}
    assert "@" not in clean[0].text and "zanzibar" not in clean[0].text and clean[7].text == texts[7]
    assert clean[0].n_chars == len(clean[0].text)
    assert P.sanitised(docs).columns == docs.columns


def test_pii_terms_far_away(spark):
    """A name in the heading of long documents is revealing, wherever the protected value stands."""
    pad = " " + "pad " * 60
    texts = [f"Zanzibar {i}{pad}write to boss@corp.com{pad}" for i in range(4)] + ["boss@corp.com zanzibar"] + [f"only{pad}write to {i}" for i in range(60)]
    docs = spark.createDataFrame(rows(texts), DOCS)
    got = {r.doc_id: r.spans for r in P.detect(docs).collect()}
    assert all("term:0:8" in got[i] for i in range(4)) and "term:14:22" in got[4] and got[9] == ""
    assert not any("zanzibar" in r.text.lower() for r in P.sanitised(docs).collect())


def disclosed(texts, support, generalise):
    """doc -> spans, by plain counts over all texts."""
    import math

    import regex

    base = {d: [s.split(":") for s in pii(t)[-1].split(",") if s] for d, t in texts.items()}
    digits = lambda v: regex.sub("[^0-9]", "", v)
    name = lambda k, v: f"{k}:{digits(v) if k in ('card', 'phone') else v.lower()}"
    held = {d: {name(k, texts[d][int(a) : int(b)]) for k, a, b in spans} for d, spans in base.items()}
    terms = {d: set(regex.findall(r"\p{L}{3,}", t.lower())) for d, t in texts.items()}
    n_term = {}
    for own in terms.values():
        for t in own:
            n_term[t] = n_term.get(t, 0) + 1
    out, rules = {}, {}
    for c in set().union(*held.values()):
        with_c = [d for d in texts if c in held[d]]
        for t in set().union(*[terms[d] for d in with_c]):
            both = [d for d in with_c if t in terms[d]]
            if len({texts[d] for d in both}) < support or len(with_c) == len(texts):
                continue
            score = math.log(len(both) * len(texts) / (n_term[t] * len(with_c))) / math.log(len(texts) / len(with_c))
            if score >= generalise - 1e-9:
                rules.setdefault(c, set()).add(t)
    for d, t in texts.items():
        own = set().union(*[rules.get(c, set()) for c in held[d]])
        taken = [(int(a), k, int(b)) for k, a, b in base[d]]
        more = [(m.start(), "term", m.end()) for m in regex.finditer(r"\p{L}{3,}", t) if m[0].lower() in own and not any(a < m.end() and m.start() < b for a, _, b in taken)]
        order = ("email", "ip", "card", "phone", "term")
        out[d] = ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(taken + more, key=lambda s: (s[0], order.index(s[1]))))
    return out


@pytest.mark.parametrize("support", [1, 3])
def test_disclosure_by_brute_force(spark, support):
    rnd = random.Random(21)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(2, 6))) for _ in range(60)]
    values = ["ann@corp.org", "+33 123 456 789", "10.0.0.7", "4111 1111 1111 1111", "bob@corp.org"]
    texts = {}
    for d in range(120):
        w = rnd.choices(vocabulary, k=rnd.randint(5, 150))
        for v in rnd.sample(range(5), rnd.choice([0, 0, 0, 1, 1, 2])):
            w[rnd.randrange(len(w))] = values[v] + rnd.choice(["", "", ".", "zeb"])
            w[rnd.randrange(len(w))] = ["Zanzibar", "Quito", "oslo", "Lima", "bob"][v]
        texts[d] = " ".join(w)
    texts |= {120: texts[3], 121: texts[3], 122: "", 123: "x@y.z"}
    got = {r.doc_id: r.spans for r in P.detect(spark.createDataFrame(rows(texts.values()), DOCS), support=support).collect()}
    want = disclosed(texts, support, P.GENERALISE)
    assert got == want and any("term:" in x for x in want.values())


def test_long_revealed_texts(spark):
    """Tens of thousands of terms and of base spans in one text: places are right, and the time for each word doesn't grow."""
    import time

    def run(n):
        long = " ".join(f"Zanzibar é𝒳 a{i % 10}@corp.org pad" for i in range(n))
        texts = [long + f" {i}" for i in range(4)] + [f"pad words {i}" for i in range(60)]
        docs = spark.createDataFrame(rows(texts), DOCS)
        began = time.time()
        got = {r.doc_id: r for r in P.detect(docs).collect()}
        clean = {r.doc_id: r.text for r in P.sanitised(docs).collect()}
        return time.time() - began, got, clean

    run(10)
    short, _, _ = run(2500)
    took, got, clean = run(20000)
    assert got[0].n_email == 20000 and got[0].spans.count("term:") == 20000 and got[0].spans.startswith("term:0:8,email:12:23,term:28:36,")
    assert clean[0] == " ".join(" é𝒳 [EMAIL] pad" for _ in range(20000)) + " 0" and clean[9] == "pad words 5"
    assert took < 2 * 8 * short
