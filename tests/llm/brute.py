"""Plain Python versions of the contracts, to hold the operators against."""

import hashlib
import re
import struct
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def pii(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, d[::-1]))) % 10 == 0:
            spans.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), 3, "phone", m.end()))
    spans.sort()
    kinds = [s[2] for s in spans]
    text_spans = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    return (*[kinds.count(k) for k in ("email", "ip", "card", "phone")], hashlib.sha256(text_spans.encode()).hexdigest(), text_spans)


def rules(text):
    text = text or ""
    w = SPACE.findall(text)
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    many = {}
    for x in wins:
        many[x] = many.get(x, 0) + 1
    covered = {i + k for i, x in enumerate(wins) if many[x] > 1 for k in range(5)}
    lines, dup, seen = [x for x in text.split("\n") if SPACE.search(x)], 0, set()
    for x in lines:
        dup += x in seen
        seen.add(x)
    n, rep = len(w), len(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, rep, n < 10 or 100 * rep > 20 * n


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = SPACE.findall(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near(docs):
    """doc_id -> (n_shingles, component_id)"""
    sets = {d: shingles(t) for d, t in docs}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def suffix(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256); docs sorted by id"""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            x = b[i : i + length]
            if x in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(x)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def little(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def crc(ids):
    return zlib.crc32(little(ids))
