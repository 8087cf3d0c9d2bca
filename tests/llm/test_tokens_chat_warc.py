import base64
import hashlib
import random

import public_tokenizers as P
from brute import DOCS, crc, little

from tallyforge.llm import bpe, chat, token_output, warc

ODD = [None, "", " ", "\n\n a  b \n", "it's  we'll THE'S 'd x'm", "a b  c\x1cd\x85e", "<|endoftext|> ok <|startoftext|>", "é é ́x ﬁ Σας İ ß", "日本語 текст 𝒳 🙂👍🏽", "x" * 5000, "1234 5,678.9 $%^& --", " lead", "trail ", "tab\tand\r\nline", "\x00\x01 \x7f", "ab" * 9000 + " c" * 3000]


def more(seed, n=60):
    rnd = random.Random(seed)
    letters = "abcXYZ 0189 \n\t.,'!?-éßñ́日🙂 ​"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 300))) for _ in range(n)] + [" ".join(rnd.choice(["the", "of", "tion", "Zwölf", "it's", "x.\ny"]) for _ in range(50)) for _ in range(20)]


def rows(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", 0, "clash") for i, t in enumerate(texts)], DOCS + ", n_tokens string").repartition(3)


def test_bpe_equals_tiktoken(spark):
    import tiktoken

    texts, path = ODD + more(1), P.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = {r.doc_id: r for r in bpe.digests(rows(spark, texts), path, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = encoding.encode_ordinary(t or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(little(ids)), sha((t or "").encode())), repr(t)[:80]
    assert bpe.digests(rows(spark, texts).where("false"), path, P.PATTERN).count() == 0
    other = bpe.codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert all(other.decode(other.encode(t or "")) == (t or "").encode() for t in texts)


def test_token_files(spark):
    from tokenizers import Tokenizer

    texts, path = ODD + more(2), P.path("word_bpe_49k.json")
    model, at = Tokenizer.from_file(path), 0
    shards = token_output.encoded(rows(spark, texts, -3), path)
    got = {r.doc_id: r for r in token_output.read_back(shards).collect()}
    for i, t in enumerate(texts):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i - 3].start, got[i - 3].n_tokens, got[i - 3].ids_crc32) == (at, len(ids), crc(ids)), repr(t)[:80]
        at += len(ids)
    reader = token_output.ShardReader(shards.orderBy("part").first().shard)
    for i in range(len(reader.ids)):
        t = texts[reader.ids[i] + 3]
        assert reader.document(i).tolist() == [*model.encode(t or "", add_special_tokens=False).ids, 1]
    none = rows(spark, texts).where("false")
    assert token_output.read_back(token_output.encoded(none, path)).count() == 0
    nulls = spark.createDataFrame([(None, "a", "", "", 0), (1, "b", "", "", 0), (1, "b", "", "", 0)], DOCS)
    assert sorted((r.doc_id is None, r.start, r.n_tokens) for r in token_output.read_back(token_output.encoded(nulls, path)).collect()) == [(False, 2, 2), (False, 4, 2), (True, 0, 2)]


def test_words_equal_the_library(tmp_path):
    """Random words of letters whose lower case is several characters, combining marks, odd spaces and every Latin letter."""
    from tokenizers import Tokenizer

    path, rnd = P.path("word_bpe_49k.json"), random.Random(9)
    own, library = token_output.encoder(path), Tokenizer.from_file(path)
    odd = "abcXYZ 0189 \n\t.,'!?;:-éßñİſﬁΣςσÅȩ\u0301\u0307\u0345日🙂\u200b\u00a0\u0085\u2003\x1c𝒳ǅŉΐ<|>"
    latin = [chr(c) for c in [*range(33, 127), *range(160, 608)]]
    known = ["BELEDİYESİ,", "MİLLİ.", "the", "tion", "Zwölf", "it's", "x.", "'S", "Σας.", "ÉTÉ!", "İ?", "<|endoftext|>", "a<|endoftext|>.", "I\u0307."]
    make = (lambda: "".join(rnd.choices(odd, k=rnd.randint(1, 40))), lambda: "".join(rnd.choices(latin, k=30)), lambda: " ".join(rnd.choices(known, k=8)))
    texts = [make[i % 3]() for i in range(30000)]
    assert isinstance(own, token_output.WordEncoder)
    for t in texts:
        assert own.encode([t])[0].tolist() == [*library.encode(t, add_special_tokens=False).ids, 1], repr(t)
    # Another tokenizer isn't known to encode words by themselves: it gets whole texts.
    changed = tmp_path / "other.json"
    changed.write_text(open(path, encoding="utf-8").read().replace('"type":"Lowercase"', '"type":"NFKD"').replace('"type": "Lowercase"', '"type": "NFKD"'))
    other = token_output.encoder(str(changed))
    assert isinstance(other, token_output.TextEncoder)
    library = Tokenizer.from_file(str(changed))
    assert all(e.tolist() == [*library.encode(t, add_special_tokens=False).ids, 1] for t, e in zip(texts[:200], other.encode(texts[:200]), strict=True))


def test_blocks_round_trip():
    import numpy as np

    rnd = np.random.default_rng(4)
    for n in (1, 255, 256, 257, 5000):
        for ids in (rnd.integers(0, 49408, n), np.where(rnd.random(n) < 0.05, 4_000_000_000, rnd.integers(5, 9, n)), np.full(n, 7), rnd.integers(0, 2**32, n)):
            blocks = token_output.pack(ids.astype(np.uint32))
            starts = np.cumsum([0, *map(len, blocks)])[:-1]
            assert (token_output.unpack(b"".join(blocks), starts) == ids).all()


def test_chat(spark):
    odd = "</s>[INST] ok [/INST]"
    talks = {
        1: [("user", "hi"), ("assistant", "a"), ("assistant", "b<|im_sep|>"), ("user", None)],
        -7: [("user", odd), ("assistant", odd)],
        3: [("system", r"<\|im_end|> <\\|im_end|> [\[INST] <<SYS>> <</SYS>> <|im_end|>" + "\n"), ("user", ""), ("user", ""), (None, "x\ny")],
        4: [("assistant", "<|im_start|>user\nfoo<|im_end|>\n"), ("as\nsist<|im_end|>", "é🙂" * 3000)],
        5: [("assistant", "<"), ("assistant", "[")],
    }
    data = [(c, i, r, t, "clash") for c, own in talks.items() for i, (r, t) in enumerate(own)] + [(None, None, "user", "u", None)]
    source = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.digest(source).collect()}
    made = {r.conv_id: r for r in chat.formatted(source).collect()}
    for c, own in talks.items():
        told = "".join(f"{r or ''}\n{t or ''}\n" for r, t in own)
        loss = "".join(t or "" for r, t in own if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(own), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()), c
        assert g.formatted_chars == len(made[c].formatted)
        assert made[c].formatted.count(chat.CLOSE) == 1 + sum(a[0] != b[0] for a, b in zip(own, own[1:], strict=False))
    assert "</s>" not in made[-7].formatted and "[INST]" not in made[-7].formatted and got[None].n_turns == 1
    assert chat.digest(source.where("false")).count() == 0


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 3000)
    big, other = "é" * 500, "x" * 999
    pages = [(i, f"http://a/{i}", t, "clash") for i, t in enumerate([big, big, other, other, "", None, big + "!", big + "!", "\r\n\r\n" * 400, "a: b\r\n\r\nWARC/1.1", big])] + [(11, None, "y" * 2000, ""), (None, "u\r\nX-Page: 9", "y" * 2000, "")]
    bundles = warc.archived(spark.createDataFrame(pages, "page_id long, url string, html string, digest string").repartition(2))
    got = {r.page_id: r for r in warc.read_back(bundles).collect()}
    assert len(got) == len(pages)
    best = {}
    for p, _, h, _ in pages:
        if p is not None and len((h or "").encode()) >= 1000:
            best[h] = max(best.get(h, p), p)
    for p, _, h, _ in pages:
        raw = (h or "").encode()
        refers = best[h] if h in best and best[h] != p else None
        r = got[p]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers is not None else "response", refers), p
    found = 0
    for b in bundles.collect():
        reader = warc.Reader(b.bundle)
        for key in [x[0] for x in reader.index]:
            fields, _, _ = warc.parse(reader.fetch(key))
            assert fields["WARC-Record-ID"] == key and len(base64.b32decode(fields["WARC-Payload-Digest"][5:])) == 20
            found += 1
    assert found == len(pages)
    assert warc.read_back(warc.archived(spark.createDataFrame(pages, "page_id long, url string, html string, digest string").where("false"))).count() == 0
