"""Personal data: fixed patterns, and terms that reveal what the patterns protect.

Base spans are e-mail and IP addresses, card and phone numbers. For the method, each distinct value is a protected entity c
and each lower-cased run of three or more letters of a document that holds it a term t. Over all documents,
    disclosure(t, c) = PMI(t, c) / IC(c) = ln(n(t, c) N / (n(t) n(c))) / ln(N / n(c)),
1 if t always comes with c, 0 if they are independent; each n counts whole documents. Terms in ``support`` different texts with
c or more whose disclosure reaches ``generalise`` become spans of kind ``term`` in the documents that hold c; from ``REMOVE``
on the sanitised text drops them, below it keeps only their kind. A support of 1 judges every term of every entity; as any
rare word of the one document of an entity then reveals it, the queries ask for ``SUPPORT``.

DataFrame operations only; matches are found by regular expressions without backtracking, and places are running sums in
blocks of blocks, so long texts with many spans take linear time. Null texts are empty; each row is judged by itself, and rows
with a null doc_id get base spans only; repeated texts are one text of support; other columns are carried along whatever
their names; without documents there are no rows.
"""

from __future__ import annotations

import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import _base as B

#: Possessive forms of the fixed patterns. A match starts where the last one ended or not inside a run of its first class.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = r"\p{L}{3,}"
SUPPORT = 3
GENERALISE = 0.75
REMOVE = 0.9
#: Rows of candidate terms up to which they are broadcast: 200,000 rows of some 40 bytes.
BROADCAST_TERMS = 200_000
#: Elements of a block of running results, and code points of a piece of text.
_SPREAD = 256
_FAR = 2**31 - 1
_PIECE = 1024
_SPAN = "array<struct<start:int,end:int,value:string>>"
_KINDED = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def running(values: Column, op: Callable[[Column, Column], Column], blocks: int = 1) -> Column:
    """Running results of op, which has 0 as its neutral element, over an array of numbers from 0 on.

    An array that grows inside ``aggregate`` is copied at each step, so it only ever grows to a block; the last results of the
    blocks are treated alike, ``blocks`` times."""
    zero = F.lit(0)

    def plain(xs: Column) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(xs, start, lambda a, x: F.struct(op(a["at"], x).alias("at"), F.concat(a["out"], F.array(op(a["at"], x))).alias("out")), lambda a: a["out"])

    def spread(s: Column) -> Column:
        return F.flatten(F.transform(s["own"], lambda own, i: B.let(F.coalesce(F.get(s["before"], i - 1), zero), lambda base: F.transform(own, lambda x: op(base, x)))))

    def cut(xs: Column) -> Column:
        own = F.transform(F.sequence(zero, F.floor((F.size(xs) - 1) / _SPREAD).cast("int")), lambda i: plain(F.slice(xs, i * _SPREAD + 1, F.lit(_SPREAD))))
        lasts = lambda o: F.struct(o.alias("own"), running(F.transform(o, lambda x: F.element_at(x, -1)), op, blocks - 1).alias("before"))
        return B.let(B.let(own, lasts), spread)

    return B.let(values, lambda xs: F.when(F.size(xs) <= _SPREAD, plain(xs)).otherwise(cut(xs))) if blocks else plain(values)


def matches(text: Column, pattern: str) -> Column:
    """Start, end (exclusive, code points) and value of each match, from the pieces between the matches."""

    def place(s: Column) -> Column:
        sizes = F.zip_with(F.slice(s["gaps"], F.lit(1), F.size(s["hits"])), s["hits"], lambda g, h: F.length(g) + F.length(h))
        span = lambda end, h: F.struct((end - F.length(h)).alias("start"), end.alias("end"), h.alias("value"))
        return F.when(F.size(s["hits"]) == 0, F.array().cast(_SPAN)).otherwise(F.zip_with(running(sizes, operator.add), s["hits"], span))

    return B.let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps")), place)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def good_ip(value: Column) -> Column:
    low = lambda part: B.let(F.ltrim(part, F.lit("0")), lambda z: (F.length(z) <= 3) & (F.coalesce(z.try_cast("int"), F.lit(0)) <= 255))
    return F.forall(F.split(value, r"\."), low)


def good_card(value: Column) -> Column:
    def luhn(d: Column) -> Column:
        digit = lambda i: F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        doubled = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        total = F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + F.when(i % 2 == 1, doubled(digit(i))).otherwise(digit(i)))
        return F.length(d).between(12, 19) & (F.when(F.length(d).between(12, 19), total).otherwise(F.lit(1)) % 10 == 0)

    return B.let(digits(value), luhn)


def good_phone(value: Column) -> Column:
    return F.length(digits(value)).between(9, 15)


def base_spans(text: Column) -> Column:
    """Sorted array of (start, rank, kind, end, value) of the four kinds; text isn't null."""
    none = F.array().cast(_KINDED)

    def of(kind: str, pattern: str, sign: Column, test=None) -> Column:
        rank = KINDS.index(kind)
        found = matches(text, pattern)
        found = F.filter(found, lambda e: test(e["value"])) if test else found
        made = F.transform(found, lambda e: F.struct(e["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), e["end"].alias("end"), e["value"].alias("value")))
        return F.when(sign, made).otherwise(none)

    # The signs are needed by any match and cheap to look for.
    every = F.concat(
        of("email", EMAIL, F.contains(text, F.lit("@"))),
        of("ip", IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), good_ip),
        of("card", CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), good_card),
        of("phone", PHONE, F.contains(text, F.lit("+")), good_phone),
    )
    return F.sort_array(every)


def entity(e: Column) -> Column:
    return F.concat(e["kind"], F.lit(":"), F.when(e["kind"].isin("card", "phone"), digits(e["value"])).otherwise(F.lower(e["value"])))


def disclosing_terms(docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """(protected: doc_id, entities of the documents with base spans; rules: entity, term, disclosure)."""
    plain = B.texts(docs)
    terms_of = lambda text: F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))
    seen = plain.select("doc_id", "text", base_spans(F.col("text")).alias("base")).where(F.size("base") > 0)
    protected = B.written(seen.select("doc_id", F.xxhash64("text").alias("text_hash"), F.array_distinct(F.transform("base", entity)).alias("entities"), terms_of(F.col("text")).alias("terms")), "protected")
    held = protected.select("text_hash", F.explode("entities").alias("entity")).groupBy("entity", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    # A term isn't in ``support`` texts with an entity that itself is in fewer.
    entities = B.written(held.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= support).drop("n_texts"), "entities")
    judged = held.join(entities.select("entity"), "entity").groupBy("text_hash").agg(F.collect_set("entity").alias("judged"))
    once = protected.join(judged, "text_hash", "left_semi").groupBy("text_hash").agg(F.count(F.lit(1)).alias("n"), F.first("terms").alias("terms"))
    by_text = B.written(once.join(judged, "text_hash"), "judged_texts")
    pairs = by_text.select("n", "terms", F.explode("judged").alias("entity")).select("n", "entity", F.explode("terms").alias("term"))
    beside = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= support)
    near = by_text.select("n", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("n").alias("n_near"))
    total = float(plain.count())
    disclosure = lambda n: F.log(F.col("n_both") * total / (F.col(n).cast("double") * F.col("n_entity"))) / F.log(total / F.col("n_entity"))
    # A term occurs in n_near documents at least, so this bound loses nothing and leaves frequent words out early.
    likely = beside.join(entities, "entity").where(F.col("n_entity") < total).join(near, "term").where(disclosure("n_near") >= generalise)
    candidates = B.written(likely.drop("n_near"), "candidates")
    terms = candidates.select("term").distinct()
    occurring = plain.select(F.explode(terms_of(F.col("text"))).alias("term"))
    if candidates.count() <= BROADCAST_TERMS:
        in_texts = occurring.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    else:
        in_texts = occurring.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    rules = candidates.join(in_texts, "term").withColumn("disclosure", disclosure("n_term"))
    return protected, B.written(rules.where(F.col("disclosure") >= generalise).select("entity", "term", "disclosure"), "disclosing")


def apart(base: Column, terms: Column) -> Column:
    """Base spans and those term spans that overlap none of them, sorted."""

    def clear(every: Column) -> Column:
        is_base = lambda e: e["rank"] < len(KINDS)
        ends = running(F.transform(every, lambda e: F.when(is_base(e), e["end"]).otherwise(0)), F.greatest)
        # Starts count from the far end, so that the next base span is a running maximum from the right.
        ahead = F.reverse(running(F.transform(F.reverse(every), lambda e: F.when(is_base(e), _FAR - e["start"]).otherwise(0)), F.greatest))
        kept = lambda s: F.filter(s["every"], lambda e, i: is_base(e) | ((F.get(s["ends"], i) <= e["start"]) & (_FAR - F.get(s["ahead"], i) >= e["end"])))
        return B.let(F.struct(every.alias("every"), ends.alias("ends"), ahead.alias("ahead")), kept)

    return B.let(F.sort_array(F.concat(base, terms)), clear)


def found(docs: DataFrame, *more: str, **settings) -> DataFrame:
    """The columns ``more`` of docs, p_text, p_base and p_all, the sorted base spans and all spans of each document."""
    protected, rules = disclosing_terms(docs, **settings)
    own = protected.where("doc_id is not null").select("doc_id", F.explode("entities").alias("entity")).join(rules, "entity")
    own = own.groupBy("doc_id", "term").agg(F.max("disclosure").alias("disclosure")).groupBy(F.col("doc_id").alias("p_doc")).agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("p_terms"))
    own = B.written(own, "own_terms")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ready = docs.select(*more, F.col("doc_id").cast("long").alias("p_id"), text.alias("p_text")).withColumn("p_base", base_spans(F.col("p_text")))
    clean = ready.where(F.size("p_base") == 0).withColumn("p_all", F.col("p_base"))

    def with_terms(s: Column) -> Column:
        kind = lambda v: F.when(F.element_at(s["terms"], F.lower(v)) >= REMOVE, "drop").otherwise("mask")
        revealed = F.filter(matches(s["text"], TERM), lambda e: F.map_contains_key(s["terms"], F.lower(e["value"])))
        spans = F.transform(revealed, lambda e: F.struct(e["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), e["end"].alias("end"), kind(e["value"]).alias("value")))
        return apart(s["base"], spans)

    # Only documents with base spans meet the terms that reveal them; the others pass without a shuffle.
    marked = ready.where(F.size("p_base") > 0).join(own, F.col("p_id") == F.col("p_doc"), "left")
    marked = marked.withColumn("p_all", F.when(F.col("p_terms").isNull(), F.col("p_base")).otherwise(B.let(F.struct(F.col("p_text").alias("text"), F.col("p_base").alias("base"), F.col("p_terms").alias("terms")), with_terms)))
    names = [*more, "p_id", "p_text", "p_base", "p_all"]
    return clean.select(*names).unionByName(marked.select(*names))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string"))), ",")


def detect(docs: DataFrame, **settings) -> DataFrame:
    """A row for each document: counts of the kinds, digest of the base spans, all spans; settings: support, generalise."""
    of_kind = lambda k: F.size(F.filter("p_base", lambda e: e["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [of_kind(k) for k in KINDS]
    return found(docs, **settings).select(F.col("p_id").alias("doc_id"), *counts, F.sha2(joined(F.col("p_base")), 256).alias("base_sha256"), joined(F.col("p_all")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced: base kinds by ``[KIND]``, terms by ``[TERM]`` or nothing; spans that overlap become one.

    Gaps are taken from pieces of the text, as finding a place in a string means walking to it."""
    sign = lambda e: F.when(e["kind"] != "term", F.concat(F.lit("["), F.upper(e["kind"]), F.lit("]"))).when(e["value"] == "drop", "").otherwise("[TERM]")
    at = lambda place: F.floor(place / _PIECE).cast("int")

    def between(pieces: Column, begin: Column, end: Column) -> Column:
        first, last = at(begin), at(end)
        left = F.coalesce(F.get(pieces, first), F.lit(""))
        whole = F.when(last > first + 1, F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")).otherwise("")
        right = F.substring(F.coalesce(F.get(pieces, last), F.lit("")), F.lit(1), end % _PIECE)
        return F.when(first == last, F.substring(left, begin % _PIECE + 1, end - begin)).otherwise(F.concat(F.substring(left, begin % _PIECE + 1, F.lit(_PIECE)), whole, right))

    def built(s: Column) -> Column:
        before = lambda i: F.coalesce(F.get(s["ends"], i - 1), F.lit(0))
        shown = F.transform(s["spans"], lambda e, i: F.when(e["start"] >= before(i), F.concat(between(s["pieces"], before(i), e["start"]), sign(e))).otherwise(""))
        return F.concat(F.array_join(shown, ""), between(s["pieces"], before(F.size(s["spans"])), s["size"]))

    made = lambda t: F.struct(spans.alias("spans"), running(F.transform(spans, lambda e: e["end"]), F.greatest).alias("ends"), F.regexp_extract_all(t, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0)).alias("pieces"), F.length(t).alias("size"))
    return B.let(B.let(text, made), built)


def sanitised(docs: DataFrame, **settings) -> DataFrame:
    """docs with personal data and revealing terms taken out of text, and n_chars (where there is one) set to the new length."""
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("p_row"), "doc_id", "text")
    done = found(row, "p_row", **settings).withColumn("p_new", F.when(F.size("p_all") == 0, F.col("p_row.text")).otherwise(redacted(F.col("p_text"), F.col("p_all"))))
    new = {"text": F.col("p_new")} | ({"n_chars": F.when(F.size("p_all") == 0, F.col("p_row.n_chars")).otherwise(F.length("p_new").cast(docs.schema["n_chars"].dataType))} if "n_chars" in names else {})
    return done.select(*[new.get(c, F.col(f"p_row.`{c}`")).alias(c) for c in names])
