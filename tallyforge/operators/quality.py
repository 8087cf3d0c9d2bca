"""Data quality: anomalies, indicators, severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import pricing as P
from tallyforge.functions.gtin import valid_unit
from tallyforge.operators.relational import group_size

#: Problems from worst to least.
PROBLEMS = (
    "price missing",
    "price not positive",
    "price incoherent",
    "tiers inconsistent",
    "duplicate reference, prices differ",
    "duplicate reference",
    "barcode invalid",
    "duplicate barcode, labels differ",
    "barcode missing",
    "pack assumed",
)


def _filled(c: str) -> Column:
    """Whether a column has a text (DQ6)."""
    return F.coalesce(F.trim(F.col(c)) != "", F.lit(False))


def tiers_wrong(offers: DataFrame) -> Column:
    """Whether the tiers of a row contradict its price or each other; never null (DQ3)."""
    faults = P.tier_faults(*[F.col(c) for c in ("unit_cost", "tier2_qty", "tier2_cost", "tier3_qty", "tier3_cost")])
    return F.coalesce(F.size(faults) > 0, F.lit(False))


def with_counts(offers: DataFrame) -> DataFrame:
    """Offers with the size of their reference and barcode groups and the distinct prices and labels in them (DQ5)."""
    refs = offers.where("supplier_ref is not null").groupBy("supplier", "supplier_ref").agg(F.count(F.lit(1)).alias("n_ref"), F.count_distinct("unit_cost").alias("n_ref_prices"))
    codes = offers.where(_filled("gtin_unit")).groupBy("gtin_unit").agg(F.count(F.lit(1)).alias("n_gtin"), F.count_distinct("label").alias("n_gtin_labels"))
    return offers.join(refs, ["supplier", "supplier_ref"], "left").join(codes, "gtin_unit", "left")


def faults(counted: DataFrame) -> Column:
    """Array of the problems of a row of with_counts."""
    tests = {
        "price missing": F.col("unit_cost").isNull(),
        "price not positive": F.col("unit_cost") <= 0,
        "price incoherent": ~F.col("cost_coherent"),
        "tiers inconsistent": tiers_wrong(counted),
        "duplicate reference, prices differ": (F.col("n_ref") > 1) & (F.col("n_ref_prices") > 1),
        "duplicate reference": (F.col("n_ref") > 1) & (F.col("n_ref_prices") <= 1),
        "barcode invalid": _filled("gtin_unit") & ~valid_unit(F.col("gtin_unit")),
        "duplicate barcode, labels differ": (F.col("n_gtin") > 1) & (F.col("n_gtin_labels") > 1),
        "barcode missing": ~_filled("gtin_unit"),
        "pack assumed": F.col("pack_assumed"),
    }
    return F.filter(F.array(*[F.when(F.coalesce(tests[p], F.lit(False)), F.lit(p)) for p in PROBLEMS]), lambda x: x.isNotNull())


def anomalies(offers: DataFrame) -> DataFrame:
    """One row for each offer and problem, with the problem's rank (DQ1, DQ2)."""
    order = F.array(*[F.lit(p) for p in PROBLEMS])
    found = with_counts(offers)
    return found.select("supplier", "supplier_ref", "label", "unit_cost", "gtin_unit", "ordinal", F.explode(faults(found)).alias("problem")).withColumn("severity", F.array_position(order, F.col("problem")).cast("int"))


def indicators(offers: DataFrame) -> DataFrame:
    """Long table (indicator, n, pct) of one pass over the offers (DQ4)."""
    tests = {
        "rows": F.lit(True),
        "with price": F.col("unit_cost") > 0,
        "price missing": F.col("unit_cost").isNull(),
        "coherent": F.col("cost_coherent"),
        "incoherent": ~F.col("cost_coherent"),
        "not checkable": F.col("cost_coherent").isNull(),
        "with barcode": _filled("gtin_unit"),
        "barcode valid": valid_unit(F.col("gtin_unit")),
        "pack known": ~F.col("pack_assumed"),
        "pack assumed": F.col("pack_assumed"),
        "with tiers": F.col("tier2_qty").isNotNull(),
        "with list price": F.col("list_price_gross").isNotNull(),
        "with label": _filled("label"),
    }
    names = list(tests)
    row = offers.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(f"i{k}") for k, t in enumerate(tests.values())])
    long = F.explode(F.array(*[F.struct(F.lit(n).alias("indicator"), F.col(f"i{k}").alias("n"), F.when(F.col("i0") > 0, 100.0 * F.col(f"i{k}") / F.col("i0")).alias("pct")) for k, n in enumerate(names)]))
    return row.select(long.alias("x")).select("x.*")


def by_vat(offers: DataFrame) -> DataFrame:
    """Rows by VAT rate, unknown rates too."""
    return offers.groupBy("vat_rate").agg(F.count(F.lit(1)).alias("n_rows"))


def severity(offers: DataFrame) -> DataFrame:
    """What a row would be highlighted for, the worst only (DQ7)."""
    rule = F.when(F.col("unit_cost").isNull() | (F.col("unit_cost") <= 0), "blocking").when(F.coalesce(~F.col("cost_coherent"), F.lit(False)), "incoherent").when(tiers_wrong(offers), "tiers").when(~_filled("gtin_unit"), "barcode").otherwise("none")
    return offers.withColumn("highlight", rule)


def invariant_breaks(offers: DataFrame) -> DataFrame:
    """Offers that break an identity of the pricing maths: a case price that isn't unit times pack, a tier that isn't cheaper (PR12)."""
    case = F.abs(F.col("case_cost") - F.col("unit_cost") * F.col("pack_size")) > 1e-9 * F.abs(F.col("case_cost"))
    same = (F.col("pack_size") > 1) & (F.col("case_cost") == F.col("unit_cost"))
    return offers.where(F.coalesce(case | same | (F.col("tier2_cost") >= F.col("unit_cost")), F.lit(False)))


def shared_references(offers: DataFrame) -> DataFrame:
    return group_size(offers, ["supplier", "supplier_ref"], "n_sharing")
