"""Barcode register: sources by priority, control levels, shared codes, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import gtin as G
from tallyforge.functions import labels as L
from tallyforge.functions import text as T
from tallyforge.functions.labels import DEFAULT, Vocabulary
from tallyforge.operators.relational import asc, first_by, group_size

#: Sources from the surest on; the order settles conflicts.
SOURCES = ("warehouse", "supplier", "price list", "reference is code", "registry", "drug base", "label", "registry model")
SURE = SOURCES[:5]
PROBABLE = ("label", "drug base")
TRUSTED = ("price list", "supplier", "warehouse")


def confidence(source: Column, score: Column, least: float = 0.8) -> Column:
    """sure, probable or to verify, by source and, for probable ones, score; null without a source (ER1)."""
    return F.when(source.isin(*SURE), "sure").when(source.isin(*PROBABLE) & (score.isNull() | (score >= least)), "probable").when(source.isNotNull() & (source != ""), "to verify")


def gathered(reads: dict[str, DataFrame]) -> DataFrame:
    """All readings (item_code, gtin, score, detail, ordinal) under one schema with their source (ER2 to ER5, IO7)."""
    out = None
    for source, df in reads.items():
        have = lambda c, t, df=df: (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
        part = df.select(T.item_code(F.col("item_code").cast("string")).alias("item_code"), have("gtin", "string"), F.lit(source).alias("source"), have("score", "double"), have("detail", "string"), have("ordinal", "long"))
        out = part if out is None else out.unionByName(part)
    return out.where("item_code is not null and gtin is not null")


def register(items: DataFrame, readings: DataFrame, legacy: bool = False) -> DataFrame:
    """Items with the code of their best source; ties go to the first reading (ER6).

    A code that isn't a valid unit code is left out before ranking. legacy: the best source wins first, and an invalid code is
    then nulled, even if another source has a valid one.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("source"))
    ranked = readings.withColumn("_rank", F.when(rank == 0, len(SOURCES) + 1).otherwise(rank))
    if not legacy:
        ranked = ranked.where(G.valid_unit(F.col("gtin")))
    best = first_by(ranked, ["item_code"], asc("_rank", "ordinal", "gtin", "detail")).drop("_rank", "ordinal")
    if legacy:
        best = best.where(G.valid_unit(F.col("gtin")))
    out = items.join(best, "item_code", "left")
    return out.withColumn("confidence", confidence(F.col("source"), F.col("score")))


def coverage(registered: DataFrame) -> DataFrame:
    """Items with a code by source and confidence."""
    return registered.groupBy("source", "confidence").agg(F.count(F.lit(1)).alias("n_items"))


def uniqueness(registered: DataFrame, vocabulary: Vocabulary = DEFAULT) -> DataFrame:
    """Level 1: codes of several items, and whether the items differ as variants (EC2, EC3)."""
    signature = F.struct(L.discriminants(F.col("label"), None, vocabulary).alias("d"), L.numbers(F.col("label")).alias("n"))
    groups = registered.where("gtin is not null").groupBy("gtin").agg(F.count_distinct("item_code").alias("n_items"), F.count_distinct(signature).alias("n_variants"))
    fault = F.when((F.col("n_items") > 1) & (F.col("n_variants") > 1), "shared by distinct variants").when(F.col("n_items") > 1, "shared")
    return registered.join(groups, "gtin", "left").withColumn("level1", F.coalesce(fault, F.lit("")))


def batches(registered: DataFrame, length: int = 6, healthy: float = 0.90, least: int = 5) -> DataFrame:
    """Level 2: whether a code's company prefix is one that trusted sources show for its supplier; bad ones are blamed on the batch (supplier, source) or the row (EC4)."""
    rows = registered.withColumn("prefix", F.substring("gtin", 1, length))
    trusted = rows.where(F.col("source").isin(*TRUSTED) & F.col("prefix").isNotNull() & F.col("supplier").isNotNull()).select("supplier", "prefix").distinct()
    known = rows.join(trusted.select("supplier").distinct().withColumn("_testable", F.lit(True)), "supplier", "left").join(trusted.withColumn("_agrees", F.lit(True)), ["supplier", "prefix"], "left")
    known = known.withColumns({"testable": F.coalesce(F.col("_testable") & F.col("prefix").isNotNull(), F.lit(False)), "agrees": F.coalesce("_agrees", F.lit(False))}).drop("_testable", "_agrees")
    rates = known.where("testable").groupBy("supplier", "source").agg(F.count(F.lit(1)).alias("n_batch"), F.count_if("agrees").alias("n_agree"))
    rates = rates.withColumn("rate", F.round(F.col("n_agree") / F.col("n_batch"), 3))
    state = F.when(F.col("rate") >= healthy, "healthy").when(F.col("n_batch") >= least, "broken").when(F.col("n_batch").isNotNull(), "too small")
    out = known.join(rates.withColumn("batch", state).drop("n_agree"), ["supplier", "source"], "left")
    return out.withColumn("level2", F.when(F.col("testable") & ~F.col("agrees") & (F.col("batch") == "broken"), "foreign prefix, broken batch").when(F.col("testable") & ~F.col("agrees"), "foreign prefix, isolated").otherwise(""))


def crossed(registered: DataFrame, readings: DataFrame) -> DataFrame:
    """Level 3: other sources that have another code for the item (EC, J12)."""
    others = readings.select("item_code", F.col("source").alias("_s"), F.col("gtin").alias("_g")).where("_g is not null").distinct()
    differing = registered.select("item_code", "source", "gtin").join(others, "item_code").where((F.col("_s") != F.col("source")) & (F.col("_g") != F.col("gtin")))
    said = differing.groupBy("item_code").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "_s", "_g"))), ", ").alias("level3"))
    return registered.join(said, "item_code", "left").withColumn("level3", F.coalesce("level3", F.lit("")))


def controlled(registered: DataFrame, readings: DataFrame) -> DataFrame:
    """All levels; the first that fails gives the verdict, the number of those that fail is counted (EC5)."""
    out = crossed(batches(uniqueness(registered.withColumn("level0", G.structure_fault(F.col("gtin"))))), readings)
    levels = ["level0", "level1", "level2", "level3"]
    failed = [(F.col(x) != "") for x in levels]
    verdict = F.when(failed[0], "level 0").when(failed[1], "level 1").when(failed[2], "level 2").when(failed[3], "level 3").otherwise("ok")
    count = failed[0].cast("int") + failed[1].cast("int") + failed[2].cast("int") + failed[3].cast("int")
    return out.withColumns({"verdict": verdict, "n_failed": count})


def shared_verdicts(registered: DataFrame, aliases: DataFrame, least: float = 0.55, legacy: bool = False, vocabulary: Vocabulary = DEFAULT) -> DataFrame:
    """Why several items have one code: duplicates, same company, one base label, alike, ambiguous (EV2, EV3).

    legacy: codes whose items have no reference at all count as duplicates too.
    """
    house = registered.where("gtin is not null").join(aliases.select("supplier", "alias"), "supplier", "left").withColumn("_house", F.coalesce("alias", "supplier")).withColumn("_base", L.base_label(F.col("label"), vocabulary))
    first = house.groupBy("gtin").agg(F.min_by("label", "item_code").alias("_first"))
    near = 1 - F.levenshtein(F.upper("label"), F.upper("_first")) / F.greatest(F.length("label"), F.length("_first"), F.lit(1))
    groups = (
        house.join(first, "gtin")
        .groupBy("gtin")
        .agg(F.count_distinct("item_code").alias("n_items"), F.count_distinct("supplier_ref").alias("n_refs"), F.count_distinct("_house").alias("n_houses"), F.count_distinct("_base").alias("n_bases"), F.min(near).alias("likeness"))
        .where("n_items > 1")
    )
    same = (F.col("n_refs") <= 1) if legacy else (F.col("n_refs") == 1)
    verdict = F.when(same, "duplicates").when(F.col("n_houses") == 1, "same company").when(F.col("n_bases") == 1, "one base label").when(F.col("likeness") >= least, "alike").otherwise("ambiguous")
    return groups.withColumn("shared_verdict", verdict)


def marked(registered: DataFrame, shared: DataFrame, verified: DataFrame) -> DataFrame:
    """Usability and confidence after overrides, later ones over earlier: shared, invalid, short, unverified registry (EV4, EV5)."""
    ok = verified.select("item_code").distinct().withColumn("_verified", F.lit(True))
    out = registered.join(shared.select("gtin", "shared_verdict"), "gtin", "left").join(ok, "item_code", "left")
    reason = (
        F.when(F.length("gtin") < 13, "shorter than 13")
        .when(F.col("gtin").isNotNull() & ~G.digit_holds(F.col("gtin")), "invalid check digit")
        .when(F.col("shared_verdict") == "ambiguous", "ambiguous share")
        .otherwise("")
    )
    down = F.col("source").startswith("registry") & F.col("_verified").isNull()
    return out.withColumns({"mark_reason": reason, "usable": F.col("gtin").isNotNull() & (reason == ""), "confidence": F.when(F.coalesce(down, F.lit(False)), "to verify").otherwise(F.col("confidence"))}).drop("_verified")


def notice(marked_register: DataFrame) -> DataFrame:
    """Indicators of a version (EV6)."""
    return marked_register.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(F.col("gtin").isNotNull()).alias("n_codes"),
        F.count_if("usable").alias("n_usable"),
        F.count_distinct("gtin").alias("n_distinct_codes"),
        F.count_if(F.col("usable") & (F.col("confidence") == "sure")).alias("n_sure"),
        F.count_if(F.col("shared_verdict") == "ambiguous").alias("n_ambiguous"),
    )


def duplicates(registered: DataFrame) -> DataFrame:
    """Rows whose code several items have (EV7)."""
    return group_size(registered, ["gtin"], "n_items").where("n_items > 1")
