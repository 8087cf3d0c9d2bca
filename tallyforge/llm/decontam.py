"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items become sequences of canonical words: a number is ``\\x02``, a unit after it ``\\x03``, a capitalised
word inside a sentence ``\\x01`` (a name); the rest is lower-cased without punctuation. Windows of five canonical words with
three literal words or more are hash-joined. Matches on one diagonal (same shift between item and document) are an
alignment; it counts if its slots are consistent: each value of the item stands for one value of the document, and no two
names of the item for one name (two numbers or units may be drawn alike). An
item is leaked into a document if consistent alignments cover 75 % of the item's windows, so verbatim copies and copies with
other numbers, names or units are found alike.

A document that covers 75 % of an item's n windows holds one of any n - ceil(0.75 n) + 1 of them. So a pair of document and
item is only formed by the item's windows that are rarest in the documents; windows that many items and many documents share form none.

A capitalised word that opens a sentence, a quote or the text may be a name or not, so there are two forms of each sequence: it
is a literal in the strict form and ``\\x01`` in the loose one. Windows meet within a form, and alignments of either form cover
the item's windows; which windows count is told by the strict form.

DataFrame operations only. Null and short texts (under five words) and short items match nothing; texts of any length are read
whole; repeated rows of a document or an item count once; documents with a null id are reported under a null id; other columns
are left alone, whatever their names; without documents or items there are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import _base as B

WINDOW = 5
LITERALS = 3
COVER = 0.75
UNITS = "%|kg|mg|g|km|cm|mm|m|mi|ft|lb|lbs|oz|l|ml|h|hr|hrs|min|s|ms|hours?|minutes?|seconds?|days?|weeks?|months?|years?|dollars?|cents?|euros?|usd|eur|meters?|metres?|miles?|feet|inches|degrees?|percent"
#: Rows of benchmark windows, and of documents that hold one, up to which they are broadcast: 2,000,000 longs, some 32 MB.
BROADCAST_WINDOWS = 2_000_000
_EDGE = ".,;:!?()[]\"'"


def canonical(text: Column, raw: bool = True) -> Column:
    """Struct of ``canon``, ``loose`` and, if asked for, ``raw``, arrays of words of one length; text isn't null."""

    def both(t: Column) -> Column:
        c = F.regexp_replace(F.translate(t, "\u0004\u0005", ""), r"(?=\p{Lu})(?<=[\p{L}\p{N},;] )\p{Lu}\p{Ll}+", "\u0001")
        c = F.regexp_replace(c, r"(?=\p{Lu})(?<![\p{L}\p{N}\x01]['’-]?)\p{Lu}\p{Ll}+", "\u0004$0\u0005")
        c = F.regexp_replace(F.lower(c), r"[0-9](?:[0-9.,:/]*[0-9])?", "\u0002")
        c = F.regexp_replace(c, rf"(\u0002 ?)(?:{UNITS})(?![\p{{L}}\p{{N}}\x04])", "$1\u0003")
        c = F.regexp_replace(c, r"[^\p{L}\p{N} \u0001-\u0005]+", "")
        cut = lambda x: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(x, " ", -1))
        read = [cut(F.lower(t)).alias("raw")] if raw else []
        return B.let(c, lambda c: F.struct(cut(F.translate(c, "\u0004\u0005", "")).alias("canon"), cut(F.regexp_replace(c, "\u0004[^\u0005]*\u0005", "\u0001")).alias("loose"), *read))

    # Single spaces, which most gaps are, stay as they are. Patterns that look back first look for the letter they start with.
    return B.let(F.regexp_replace(F.btrim(text, F.lit(B.TRIMMED)), rf"[\x09-\x0D]{B.SPACE}*|\x20{B.SPACE}+", " "), both)


def _hashes(words: Column) -> Column:
    return B.let(words, lambda w: B.window_hashes(w, WINDOW))


def holders(plain: DataFrame, hashes: DataFrame) -> DataFrame:
    """doc_id of the texts that hold a window of ``hashes`` in either form; texts aren't carried along."""
    differ = lambda x: F.concat(x["strict"], F.filter(x["free"], lambda h, i: F.get(x["strict"], i) != h))
    both = lambda w: B.let(F.struct(_hashes(w["canon"]).alias("strict"), _hashes(w["loose"]).alias("free")), differ)
    held = plain.select("doc_id", F.explode(B.let(canonical(F.col("text"), raw=False), both)).alias("h"))
    return B.written(held.join(hashes, "h", "left_semi").select("doc_id").distinct(), "holders")


def with_windows(table: DataFrame, key: str) -> DataFrame:
    """key, canon, loose, raw of table's texts; a row for each hash h of a window at ``at``, of the strict form (in 1), the loose one (2) or both (3)."""

    def flat(x: Column) -> Column:
        row = lambda h, at, form: F.struct(h.alias("h"), at.alias("at"), form.cast("int").alias("in"))
        strict = F.transform(x["strict"], lambda h, i: row(h, i, F.when(F.get(x["free"], i) == h, 3).otherwise(1)))
        free = F.filter(F.transform(x["free"], lambda h, i: F.when(F.get(x["strict"], i) != h, row(h, i, F.lit(2)))), lambda e: e.isNotNull())
        return F.concat(strict, free)

    both = lambda w: F.struct(w["canon"].alias("canon"), w["loose"].alias("loose"), w["raw"].alias("raw"), B.let(F.struct(_hashes(w["canon"]).alias("strict"), _hashes(w["loose"]).alias("free")), flat).alias("hashes"))
    made = table.select(key, B.let(canonical(F.col("text")), both).alias("w"))
    return made.select(key, F.col("w.canon").alias("canon"), F.col("w.loose").alias("loose"), F.col("w.raw").alias("raw"), F.inline("w.hashes"))


def slots(canon: Column, raw: Column) -> Column:
    """Values of a window: placeholders and raw word where the canonical one has a placeholder, else null."""
    return F.zip_with(canon, raw, lambda c, r: F.when(c.rlike("[\u0001-\u0003]"), F.concat(F.regexp_replace(c, "[^\u0001-\u0003]", ""), F.btrim(r, F.lit(_EDGE)))))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows (covered), coverage of each item that leaked into a document."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cut = lambda c: F.slice(c, F.col("at") + 1, F.lit(WINDOW))
    # A row of a window in each form that its hash is the one of.
    of = lambda form, c: F.when(F.col("in").bitwiseAND(form) > 0, F.struct(F.lit(form).alias("form"), slots(cut(F.col(c)), cut(F.col("raw"))).alias("slots")))
    forms = F.inline(F.array_compact(F.array(of(1, "canon"), of(2, "loose"))))
    bench = with_windows(items, "item_id").where(F.size(F.filter(cut(F.col("canon")), lambda c: (F.length(c) > 0) & ~c.rlike("[\u0001-\u0003]"))) >= LITERALS)
    # A loose window without a literal is met anywhere.
    bench = bench.where((F.col("in") != 2) | F.exists(cut(F.col("loose")), lambda c: (F.length(c) > 0) & ~c.rlike("[\u0001-\u0003]")))
    bench = bench.select("item_id", F.col("at").alias("item_at"), "h", forms).withColumnRenamed("slots", "item_slots")
    bench = B.written(bench.dropDuplicates(["item_id", "item_at", "form"]), "bench_windows")
    hashes = bench.select("h").distinct()
    hashes = F.broadcast(hashes) if bench.count() <= BROADCAST_WINDOWS else hashes
    # Most texts hold no window of an item: only those that do are cut into words with their values.
    ids = holders(B.texts(docs), hashes)
    ids = ids.select(F.col("doc_id").alias("d_held"))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_WINDOWS else ids
    held = B.texts(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("d_held")), "left_semi")
    seen = with_windows(held, "doc_id").join(hashes, "h", "left_semi")
    seen = B.written(seen.select("doc_id", "at", "h", forms).withColumnRenamed("slots", "doc_slots"), "seen_windows")
    # Windows of an item by how many of the documents' windows they meet, in either form.
    often = seen.groupBy("h", "form").agg(F.count(F.lit(1)).alias("n_met"))
    places = bench.join(often, ["h", "form"], "left").groupBy("item_id", "item_at").agg(F.coalesce(F.sum("n_met"), F.lit(0)).alias("n_met"))
    by_item = Window.partitionBy("item_id")
    places = places.select("item_id", "item_at", F.row_number().over(by_item.orderBy("n_met", "item_at")).alias("place"), F.count(F.lit(1)).over(by_item).alias("n_item"))
    probes = bench.join(places.where(F.col("place") <= F.col("n_item") - F.ceil(COVER * F.col("n_item")) + 1), ["item_id", "item_at"], "left_semi")
    pairs_met = seen.join(probes.select("h", "form", "item_id"), ["h", "form"]).select(F.col("doc_id").alias("d_met"), "item_id").distinct()
    met = seen.join(pairs_met, F.col("doc_id").eqNullSafe(F.col("d_met"))).join(bench, ["item_id", "h", "form"])
    pair = F.filter(F.zip_with("item_slots", "doc_slots", lambda a, b: F.struct(a.alias("item"), b.alias("doc"))), lambda e: e["item"].isNotNull())
    met = met.select("doc_id", "item_id", "form", "item_at", (F.col("at") - F.col("item_at")).alias("shift"), pair.alias("pairs"))
    aligned = met.groupBy("doc_id", "item_id", "form", "shift").agg(F.collect_set("item_at").alias("at"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    once = lambda pairs, side: F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda e: e[side])))
    consistent = aligned.where(once(F.col("pairs"), "item") & once(F.filter("pairs", lambda e: e["item"].startswith("\u0001")), "doc"))
    covered = consistent.select("doc_id", "item_id", F.explode("at").alias("item_at")).distinct().groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_windows"))
    totals = bench.groupBy("item_id").agg(F.count_distinct("item_at").alias("n_item"))
    return covered.join(totals, "item_id").where(F.col("n_windows") >= COVER * F.col("n_item")).select("doc_id", "item_id", "n_windows", (F.col("n_windows") / F.col("n_item")).alias("coverage"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that an item leaked into."""
    hit = B.written(leaks(docs, benchmark).select(F.col("doc_id").alias("d_hit")).distinct(), "leaked")
    return docs.join(hit, F.col("doc_id").cast("long").eqNullSafe(F.col("d_hit")), "left_anti")
