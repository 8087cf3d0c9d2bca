"""Price offers: tiers from rows, the matching cascade, pack sizes and guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import pricing as P
from tallyforge.functions import text as T
from tallyforge.functions.gtin import identifier_candidates, valid_unit
from tallyforge.operators.relational import asc, bucketed, first_by, first_met
from tallyforge.sources.readers import write_version


def tier_grid(offers: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key: the smallest quantity gives unit price and pack, the other quantities valid tiers (EX11, PR4).

    offers: keys, qty (null: 1), price, ordinal, label. Prices of one quantity collapse to the lowest before tiers are collected.
    """
    cheapest = offers.where("price > 0").groupBy(*keys, F.coalesce("qty", F.lit(1.0)).alias("qty")).agg(F.min("price").alias("price"))
    grids = cheapest.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("qty", "price"))).alias("grid"))
    named = offers.groupBy(*keys).agg(F.min_by("label", F.struct("ordinal", "label")).alias("label"))
    made = grids.select(*keys, F.get("grid", F.lit(0))["price"].alias("unit_price"), F.get("grid", F.lit(0))["qty"].alias("pack"), P.valid_tiers(F.get("grid", F.lit(0))["price"], F.slice("grid", 2, 1_000_000)).alias("tiers"))
    tier = lambda i: F.get("tiers", F.lit(i))
    slots = {f"tier{i + 2}_{n}": tier(i)[f] for i in (0, 1) for n, f in (("qty", "qty"), ("cost", "price"))}
    return made.join(named, keys).withColumns(slots).withColumns({f"tier{i}_saving": P.tier_saving(F.col("unit_price"), F.col(f"tier{i}_cost")) for i in (2, 3)} | {"tiers_display": P.tiers_display(F.col("tiers"))})


def by_keys(items: DataFrame, offers: DataFrame, offer_keys: dict[str, Column], passes: list[tuple[str, str, Column]], take: list[str]) -> DataFrame:
    """item_code, pass, key_used, ordinal and the offers' columns: the first offer of each key of each kind, met by the items of each pass.

    passes: name, kind of the offers' key, key of the item. All kinds are keyed and all passes met in one shuffle; an offer without
    supplier meets any item, and so does an item without one.
    """
    kept = [F.coalesce("ordinal", F.lit(2**63 - 1)).alias("_at"), "ordinal", "supplier", *take]
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key")) for k, c in offer_keys.items()])).alias("_k")
    held = offers.select(F.struct(*kept).alias("_o"), kinds).where("_k.key is not null").groupBy("_k").agg(F.min("_o").alias("_o"))
    asked = F.explode(F.array(*[F.struct(F.lit(i).alias("pass"), F.lit(n).alias("key_used"), F.struct(F.lit(k).alias("kind"), c.alias("key")).alias("k")) for i, (n, k, c) in enumerate(passes)])).alias("_p")
    wanted = items.select("item_code", "supplier", asked).select("item_code", "supplier", "_p.pass", "_p.key_used", F.col("_p.k").alias("_k")).where("_k.key is not null")
    free = F.col("_o.supplier").isNull() | F.col("supplier").isNull() | (F.col("_o.supplier") == F.col("supplier"))
    return wanted.join(held, "_k").where(free).select("item_code", "pass", "key_used", *[F.col(f"_o.{c}").alias(c) for c in ("ordinal", *take)])


def by_bridge(items: DataFrame, links: DataFrame, offers: DataFrame) -> DataFrame:
    """Candidates over reliable item to code links, first by the offers' order."""
    coded = offers.where(F.length("gtin") >= 8).join(links.select("item_code", "gtin").distinct(), "gtin")
    return first_by(coded.join(items.select("item_code"), "item_code", "left_semi"), ["item_code"], asc("ordinal", "gtin"))


def by_identifier(items: DataFrame, offers: DataFrame, columns: list[str]) -> DataFrame:
    """Candidates over unit codes found inside cells of items and in the code and reference of offers."""
    probe = None
    for i, c in enumerate(columns):
        own = items.select("item_code", F.lit(i).alias("_col"), F.posexplode(identifier_candidates(F.col(c))).alias("_piece", "_code"))
        probe = own if probe is None else probe.unionAll(own)
    index = offers.select("*", F.explode(F.array_distinct(F.filter(F.array("gtin", "supplier_ref"), lambda x: valid_unit(x)))).alias("_code"))
    met = first_by(probe.join(index, "_code"), ["item_code"], asc("_col", "_piece", "ordinal"))
    return met.drop("_col", "_piece", "_code")


def cascade(items: DataFrame, offers: DataFrame, links: DataFrame) -> DataFrame:
    """Items with the first priced offer by strict key, loose key, manufacturer key, code bridge; key_used says which (J1 to J3, PK18)."""
    take = ["supplier_ref", "gtin", "label", "price", "pack"]
    renamed = offers.select("ordinal", "supplier", *take)
    strict, loose = T.strict_ref(F.col("supplier_ref")), T.loose_ref(F.col("supplier_ref"))
    passes = [("strict reference", "strict", strict), ("loose reference", "loose", loose), ("manufacturer reference", "strict", T.strict_ref(F.col("manufacturer_ref")))]
    bare = items.select("item_code", "supplier", "supplier_ref", "manufacturer_ref")
    keyed = by_keys(bare, renamed, {"strict": strict, "loose": loose}, passes, take)
    coded = by_bridge(bare, links, renamed).select("item_code", F.lit(len(passes)).alias("pass"), F.lit("barcode").alias("key_used"), "ordinal", *take)
    met = keyed.unionByName(coded).select("item_code", "pass", "key_used", F.col("ordinal").cast("long").alias("ordinal"), *[F.col(x).alias(f"offer_{x}") for x in take])
    return first_met(items, "item_code", met, "offer_price", [f"offer_{x}" for x in take])


def with_decisions(matched: DataFrame, decisions: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Human decisions fill prices that are missing and never overwrite; conflicts and drifts from the expected price are told."""
    d = first_by(decisions, ["item_code"], asc("decided_on", "decided_price")).select("item_code", "decided_price", "expected_price")
    out = matched.join(d, "item_code", "left")
    empty = F.col("offer_price").isNull() & F.col("decided_price").isNotNull()
    return out.select(
        *[c for c in matched.columns if c != "offer_price"],
        F.coalesce("offer_price", "decided_price").alias("offer_price"),
        empty.alias("validated_link"),
        F.coalesce(F.col("offer_price").isNotNull() & ~P.same_price(F.col("offer_price"), F.col("decided_price")), F.lit(False)).alias("decision_conflict"),
        (F.abs(F.col("decided_price") - F.col("expected_price")) <= tolerance).alias("decision_expected"),
    )


def systematic_factor(rows: DataFrame, keys: list[str], least: int = 5, share: float = 0.6, smallest: int = 5, legacy: bool = False) -> DataFrame:
    """keys and factor of groups whose price ratios land on one pack size: enough rows, the mode (lowest of ties) large and dominant (PK5)."""
    packs = rows.where("ratio is not null").withColumn("_pack", P.round_pack(F.col("ratio"), legacy=legacy))
    counted = packs.groupBy(*keys, "_pack").agg(F.count(F.lit(1)).alias("_n"))
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias("n_comparable"))
    mode = first_by(counted.where("_pack is not null"), keys, [F.col("_n").desc(), F.col("_pack").asc()])
    out = mode.join(totals, keys)
    return out.where((F.col("n_comparable") >= least) & (F.col("_pack") >= smallest) & (F.col("_n") >= share * F.col("n_comparable"))).select(*keys, F.col("_pack").alias("factor"), "n_comparable", F.col("_n").alias("n_on_factor"))


def pack_inference(matched: DataFrame, legacy: bool = False) -> DataFrame:
    """Unit price of each match after the pack is settled, with the divisor, its source and reasons (PK9).

    matched: supplier, offer_price, old_price, offer_label, item_label, offer_pack, pack_assumed, has_tiers, validated.
    """
    ratio = F.col("offer_price") / F.when(F.col("old_price") > 0, F.col("old_price"))
    known = (F.col("offer_pack") > 1) & ~F.coalesce("pack_assumed", F.lit(True))
    rows = matched.withColumns({"ratio": ratio, "_already": F.coalesce(known, F.lit(False)), "_offer": P.announced_pack(F.col("offer_label")), "_item": P.announced_pack(F.col("item_label"))})
    label = F.when(~F.col("_already"), P.label_divisor(F.col("_offer"), F.col("_item")))
    rows = rows.withColumn("_label", label)
    trusted = F.col("ratio").isNull() | F.coalesce("validated", F.lit(False)) | P.follows_factor(F.col("ratio"), F.col("_label"))
    rows = rows.withColumns(
        {
            "_divisor": F.when(F.col("_label") > 1, F.when(trusted, F.col("_label").cast("double"))).when(F.col("_already") & (F.col("_item")["n"] == F.col("offer_pack")), 1 / F.col("offer_pack")),
            "refused": F.when((F.col("_label") > 1) & ~trusted, F.concat(F.lit("label says "), F.col("_label").cast("string"), F.lit(", the old price contradicts"))),
            "uncorroborated": (F.col("_label") > 1) & F.col("ratio").isNull() & ~F.coalesce("validated", F.lit(False)),
        }
    )
    open_rows = rows.where(F.col("_divisor").isNull() & ~F.col("_already"))
    factors = systematic_factor(open_rows, ["supplier"], legacy=legacy).select("supplier", "factor")
    out = rows.join(factors, "supplier", "left")
    # A price is needed for a divisor; without a ratio the supplier's factor is taken but marked.
    take = F.col("_divisor").isNull() & ~F.col("_already") & F.col("factor").isNotNull() & F.col("_item")["n"].isNull() & F.col("offer_price").isNotNull() & (F.col("ratio").isNull() | P.follows_factor(F.col("ratio"), F.col("factor")))
    take = F.coalesce(take, F.lit(False))
    divisor = F.coalesce(F.col("_divisor"), F.when(take, F.col("factor").cast("double")))
    source = F.when(F.col("_divisor") > 1, "label").when(F.col("_divisor") < 1, "item label multiplies").when(take, "systematic").otherwise("none")
    blocked = F.coalesce(F.col("has_tiers"), F.lit(False)) & F.coalesce((divisor > 1) if legacy else (divisor != 1), F.lit(False))
    out = out.withColumns({"divisor": F.when(blocked, 1.0).otherwise(F.coalesce(divisor, F.lit(1.0))), "divisor_source": F.when(blocked, "withdrawn: the offer has tiers").otherwise(source), "uncorroborated": F.coalesce(F.col("uncorroborated"), F.lit(False)) | (take & F.col("ratio").isNull())})
    done = P.apply_divisor(F.col("offer_price"), F.col("divisor"))
    return out.withColumns({"unit_price": done["price"], "min_order": done["min_order"]}).drop("_already", "_offer", "_item", "_label", "_divisor", "factor")


def pack_diagnostic(rows: DataFrame, low: float = 0.70, high: float = 1.30) -> DataFrame:
    """Per supplier: comparable rows, median ratio, whether it is out of band, most frequent pack and its share (PK10)."""
    packs = rows.where("ratio is not null").withColumn("_pack", P.round_pack(F.col("ratio")))
    base = packs.groupBy("supplier").agg(F.count(F.lit(1)).alias("n_rows"), F.median("ratio").alias("median_ratio"))
    mode = first_by(packs.where("_pack is not null").groupBy("supplier", "_pack").agg(F.count(F.lit(1)).alias("n_mode")), ["supplier"], [F.col("n_mode").desc(), F.col("_pack").asc()])
    out = base.join(mode, "supplier", "left")
    return out.select("supplier", "n_rows", "median_ratio", (~F.col("median_ratio").between(low, high)).alias("out_of_band"), F.col("_pack").alias("modal_pack"), (F.coalesce("n_mode", F.lit(0)) / F.col("n_rows")).alias("modal_share"))


def to_settle(rows: DataFrame) -> DataFrame:
    """Cases a person has to settle: the pack signals of a row disagree (PK11)."""
    near = P.round_pack(F.col("ratio"))
    inverse = P.round_pack(1 / F.when(F.col("ratio") > 0, F.col("ratio")))
    out = rows.withColumn("signal_ratio", F.coalesce(near, -inverse)).withColumn("signal_offer", P.announced_pack(F.col("offer_label"))["n"]).withColumn("signal_item", P.announced_pack(F.col("item_label"))["n"])
    return out.where(F.col("signal_ratio").isNotNull() & (F.coalesce("divisor", F.lit(1.0)) == 1))


def write_to_settle(rows: DataFrame, folder: str) -> int:
    """Writes the cases to settle as a numbered table; its version (PK12)."""
    return write_version(to_settle(rows), folder, "to_settle")


def owner_bridge(items: DataFrame, owner: DataFrame) -> DataFrame:
    """Keys of the item master for items that the price owner has validated: item_code, key, price."""
    priced = first_by(owner.where("price > 0").withColumn("item_code", T.item_code(F.col("item_code"))), ["item_code"], asc("ordinal", "price")).select("item_code", "price")
    keys = items.select("item_code", F.coalesce(T.strict_ref(F.col("supplier_ref")), T.strict_ref(F.col("manufacturer_ref"))).alias("key"))
    return keys.where("key is not null").join(priced, "item_code")


def fanned_out(results: DataFrame, items: DataFrame) -> DataFrame:
    """Each registry result for every item that shares its reference."""
    found = results.withColumn("_key", T.strict_ref(F.col("ref"))).where("_key is not null")
    return items.select("item_code", T.strict_ref(F.col("supplier_ref")).alias("_key")).join(found, "_key").drop("_key")


def recurrence(rows: DataFrame, keys: list[str], least: int = 5, gap: float = 0.15) -> DataFrame:
    """Rows with the count of their rounded ratio in the group, and whether it is a systematic gap (PK15)."""
    rounded = rows.withColumn("ratio_2dp", F.floor(F.col("ratio") * 100 + 0.5000001) / 100)
    counts = rounded.where("ratio_2dp is not null").groupBy(*keys, "ratio_2dp").agg(F.count(F.lit(1)).alias("n_same"))
    out = rounded.join(counts, [*keys, "ratio_2dp"], "left")
    return out.withColumn("systematic", F.coalesce((F.col("n_same") >= least) & (F.abs(F.col("ratio_2dp") - 1) > gap), F.lit(False)))


def guarded(rows: DataFrame, limit: float = 10.0, legacy: bool = False) -> DataFrame:
    """Prices whose ratio to the old one is absurd go to a review column (PK16). legacy: the ratio is rounded before the test."""
    r = F.round("ratio", 2) if legacy else F.col("ratio")
    absurd = F.coalesce((r > limit) | (r < 1 / limit), F.lit(False))
    return rows.withColumns({"review_price": F.when(absurd, F.col("offer_price")), "offer_price": F.when(~absurd, F.col("offer_price")), "aberrant": absurd})


def partitioned(rows: DataFrame) -> DataFrame:
    """Each row in one of four buckets (PK17)."""
    return bucketed(rows, "bucket", [("aberrant", F.col("aberrant")), ("no price", F.col("offer_price").isNull()), ("to review", F.col("alert") != "")], "priced")


def reliable_links(links: DataFrame) -> DataFrame:
    """Distinct item to code links that are sure and not doubtful (PK19)."""
    return links.where((F.col("confidence") == "sure") & ~T.doubtful_link(F.col("source"), F.col("ref"))).select("item_code", "gtin").distinct()


def list_of_supplier(suppliers: DataFrame, lists: DataFrame, aliases: DataFrame) -> DataFrame:
    """Price list of each supplier, by alias, else by the most telling words in common."""
    from tallyforge.functions.labels import company_words

    ours = suppliers.select("supplier").distinct().join(aliases, "supplier", "left").select("supplier", F.explode(company_words(F.coalesce("alias", "supplier"))).alias("_w"))
    theirs = lists.select("list_name").distinct().select("list_name", F.explode(company_words(F.col("list_name"))).alias("_w"))
    met = ours.join(theirs, "_w").groupBy("supplier", "list_name").agg(F.count(F.lit(1)).alias("n_words"))
    return first_by(met, ["supplier"], [F.col("n_words").desc(), F.col("list_name").asc()])


def window_share(rows: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys)
    return rows.withColumn("share", F.count(F.lit(1)).over(w))
