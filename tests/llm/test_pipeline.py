"""The corpus pipeline against a brute-force version of its stages."""

import hashlib
import random

import public_tokenizers as P
from brute import DOCS, little, near, pii, rules

import corpus_pipeline
from tallyforge.llm import _base as B
from tallyforge.llm import bpe


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def test_pipeline(spark, tmp_path):
    import tiktoken

    rnd = random.Random(12)
    item = prose(rnd, 30)
    bases = [prose(rnd, 60) for _ in range(6)]
    texts = [b + f" extra{i}" for i in range(3) for b in bases] + [prose(rnd, 5), "same five words and again " * 20, None, "", prose(rnd, 20) + " " + item + " " + prose(rnd, 30)]
    texts += [prose(rnd, 20) + f" write to a{i}@b.org or +33 123 456 78{i} from 10.0.0.{i} " + prose(rnd, 20) for i in range(4)] + ["It's  an odd\n\ntext, with é and 日本 " + prose(rnd, 12)]
    # Good labelled documents without symbols settle every cutoff of English, so that texts full of symbols go.
    first = len(texts)
    texts += [prose(rnd, 14) for _ in range(90)] + [prose(rnd, 14).replace(" ", "%% ") for _ in range(5)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), f"more {i}") for i, t in enumerate(texts)], DOCS + ", hash string")
    labels = [(i, int(i < first + 90), 0) for i in range(first, len(texts) - 2)]
    for name, df in (("documents", docs), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame([(1, item)], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")

    left = {i: t for i, t in enumerate(texts) if not rules(t)[-1] and not (t or "").count("%") > 0.1 * len((t or "").split())}
    assert sum(not rules(t)[-1] for t in texts) == len(left) + 5
    left = {i: left[i] for i, (_, c) in near(list(left.items())).items() if c == i}
    left = {i: t for i, t in left.items() if item not in t}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = {}
    for i, t in left.items():
        spans = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in pii(t)[-1].split(",") if s)]
        out, at = "", 0
        for a, b, k in spans:
            if a >= at:
                out += t[at:a] + f"[{k.upper()}]"
            at = max(at, b)
        ids = encoding.encode_ordinary(out + t[at:])
        want[i] = (len(ids), hashlib.sha256(little(ids)).hexdigest())
    before = len(B.made)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert len(B.made) == before + 1
    assert got == want and 3 < len(want) < len(texts)
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
