"""Which items count: exclusions, doors into the scope, frozen populations, references that several items share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators.relational import asc, first_by, group_size


@dataclass(frozen=True)
class Rules:
    """Exclusion rules of a scope; codes and words are parameters."""

    types: tuple[str, ...] = ()
    families: tuple[str, ...] = ()
    legacy_family: str | None = None
    legacy_starts: tuple[str, ...] = ("FR ", "FAUT")
    legacy_except: str = "VPH"


def legacy_nomenclature(family: Column, label: Column, rules: Rules) -> Column:
    """Items of a family that still bear their old names (SP2)."""
    if rules.legacy_family is None:
        return F.lit(False)
    up = F.upper(F.trim(label))
    starts = F.lit(False)
    for s in rules.legacy_starts:
        starts = starts | up.startswith(s)
    return F.coalesce(F.contains(F.upper(family), F.lit(rules.legacy_family)) & ~up.startswith(rules.legacy_except) & starts, F.lit(False))


def exclusion_reason(type_: Column, family: Column, label: Column, rules: Rules) -> Column:
    """Why an item is out of scope, null if it isn't (SP1)."""
    code = T.type_code(type_)
    return F.when(code.isin(*rules.types), F.concat(F.lit("type "), code)).when(F.trim(family).isin(*rules.families), F.concat(F.lit("family "), F.trim(family))).when(legacy_nomenclature(family, label, rules), "old nomenclature")


def annotated(items: DataFrame, rules: Rules) -> DataFrame:
    """All items with reason and flag; none is dropped (SP3)."""
    return items.withColumn("reason", exclusion_reason(F.col("type"), F.col("family"), F.col("label"), rules)).withColumn("in_scope", F.col("reason").isNull())


def kept(items: DataFrame, rules: Rules) -> DataFrame:
    """Items in scope (SP4)."""
    return annotated(items, rules).where("in_scope")


def by_type(annotated_items: DataFrame) -> DataFrame:
    """Items by type and status, most first (SP5)."""
    return annotated_items.groupBy(T.type_code(F.col("type")).alias("type_code"), "in_scope").agg(F.count(F.lit(1)).alias("n_items")).orderBy(F.col("n_items").desc(), "type_code", "in_scope")


def doors(items: DataFrame, sold: DataFrame, bought: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Items in scope that were sold, bought or are in the catalogue, with the first door they came by (SP6)."""
    flag = lambda d, name: d.select("item_code").distinct().withColumn(name, F.lit(True))
    out = items
    for d, name in ((sold, "sold_12m"), (bought, "bought_12m"), (catalogue, "in_catalogue")):
        out = out.join(flag(d, name), "item_code", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out.withColumn("door", F.when(F.col("sold_12m"), "sold").when(F.col("bought_12m"), "bought").when(F.col("in_catalogue"), "catalogue")).where(F.col("door").isNotNull() & F.col("in_scope"))


def frozen(scope: DataFrame, path: str, expected: int | None = None) -> DataFrame:
    """Writes a population once; refuses to overwrite, and fails if its size isn't the expected one (SP7)."""
    n = scope.count()
    if expected is not None and n != expected:
        raise ValueError(f"the population has {n} rows, {expected} expected")
    scope.write.mode("errorifexists").parquet(path)
    return load_frozen(scope.sparkSession, path, n)


def load_frozen(spark, path: str, expected: int | None = None) -> DataFrame:
    """A frozen population, checked against the expected size (SP8)."""
    scope = spark.read.parquet(path)
    if expected is not None and (n := scope.count()) != expected:
        raise ValueError(f"{path} has {n} rows, {expected} expected")
    return scope


def in_scope_flag(df: DataFrame, scope: DataFrame) -> DataFrame:
    """Flag of rows whose reference or item code is in scope (SP9, SP10, SP14)."""
    refs = scope.select("internal_ref").where("internal_ref is not null").distinct().withColumn("_by_ref", F.lit(True))
    codes = scope.select("item_code").where("item_code is not null").distinct().withColumn("_by_code", F.lit(True))
    return df.join(refs, "internal_ref", "left").join(codes, "item_code", "left").withColumn("in_scope", F.coalesce("_by_ref", "_by_code", F.lit(False))).drop("_by_ref", "_by_code")


def colliding_refs(items: DataFrame) -> DataFrame:
    """Internal references of several items (SP16)."""
    return items.where("internal_ref is not null").groupBy("internal_ref").agg(F.count_distinct("item_code").alias("n_items")).where("n_items > 1")


def latest_order(orders: DataFrame, legacy: bool = False) -> DataFrame:
    """Last order of each item by date, then ordinal; rows without a readable date come last (legacy: first) (SP18)."""
    date = F.col("order_date").desc_nulls_first() if legacy else F.col("order_date").desc_nulls_last()
    rest = [F.col(c).desc_nulls_last() for c in orders.columns if c not in ("item_code", "order_date", "ordinal")]
    return first_by(orders, ["item_code"], [date, F.col("ordinal").desc_nulls_last(), *rest])


def enriched(scope: DataFrame, orders: DataFrame) -> DataFrame:
    """Supplier and reference of each item: its own, else its last order's unless its internal reference is shared, else the manufacturer's (SP17)."""
    last = latest_order(orders).select("item_code", F.col("supplier").alias("_o_supplier"), F.col("supplier_ref").alias("_o_ref"))
    shared = colliding_refs(scope).select("internal_ref", F.lit(True).alias("_shared"))
    out = scope.join(last, "item_code", "left").join(shared, "internal_ref", "left")
    usable = F.col("_shared").isNull()
    order_supplier, order_ref = F.when(usable, F.col("_o_supplier")), F.when(usable, F.col("_o_ref"))
    maker = T.usable_manufacturer_ref(F.col("manufacturer_ref"))
    origin = F.when(F.col("supplier_ref").isNotNull(), "item master").when(order_ref.isNotNull(), "orders").when(maker.isNotNull(), "manufacturer")
    return out.select(*[c for c in scope.columns if c not in ("supplier", "supplier_ref")], F.coalesce("supplier", order_supplier).alias("supplier"), F.coalesce("supplier_ref", order_ref, maker).alias("supplier_ref"), origin.alias("ref_origin"))


def of_supplier(items: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Items of suppliers by equal normalised name (SP15)."""
    return items.withColumn("_key", T.supplier_key(F.col("supplier"))).join(suppliers.select(T.supplier_key(F.col("supplier")).alias("_key")).distinct(), "_key", "left_semi").drop("_key")


def remaining_suppliers(items: DataFrame, swept: DataFrame) -> DataFrame:
    """Suppliers of items that no sweep has seen (SP19)."""
    return items.select(T.supplier_key(F.col("supplier")).alias("supplier")).where("supplier is not null").distinct().join(swept.select(T.supplier_key(F.col("supplier")).alias("supplier")), "supplier", "left_anti")


def to_treat(matched: DataFrame) -> DataFrame:
    """Suppliers with a list and items without a price, most first (SP20)."""
    return matched.groupBy("supplier").agg(F.count_if(F.col("price").isNull()).alias("n_open"), F.count(F.lit(1)).alias("n_items")).where("n_open > 0").orderBy(F.desc("n_open"), "supplier")


def already_priced(items: DataFrame, owner: DataFrame) -> DataFrame:
    """Items with a flag whether the price owner has a positive price (SP21)."""
    done = owner.where("price > 0").select("item_code").distinct().withColumn("owner_priced", F.lit(True))
    return items.join(done, "item_code", "left").withColumn("owner_priced", F.coalesce("owner_priced", F.lit(False)))


def current_price(prices: DataFrame) -> DataFrame:
    """One current price of each item, the first by ordinal (SP22)."""
    return first_by(prices, ["item_code"], asc("ordinal", "price"))


def with_current_price(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """Rows with the current price of their item; codes meet without spaces and the tail of a detour through doubles."""
    known = current_price(prices.withColumn("item_code", T.item_code(F.col("item_code")))).select(F.col("item_code").alias("_code"), F.col("price").alias("current_price"))
    return rows.join(known, T.item_code(F.col("item_code")) == F.col("_code"), "left").drop("_code")


def ordered_by_internal(scope: DataFrame, orders: DataFrame) -> DataFrame:
    """Scope with the last order of its internal reference; missing references meet too and are then turned away."""
    last = first_by(orders.withColumn("_key", F.coalesce("internal_ref", F.lit(""))), ["_key"], [F.col("order_date").desc_nulls_last(), F.col("ordinal").desc(), F.col("supplier").asc_nulls_last()])
    last = last.select(F.col("internal_ref").alias("_ref"), F.col("supplier").alias("_supplier"), F.col("order_date").alias("_date"))
    met = scope.join(last, F.col("internal_ref").eqNullSafe(F.col("_ref")), "left")
    known = F.col("internal_ref").isNotNull()
    return met.withColumns({"ordered_from": F.when(known, F.col("_supplier")), "ordered_on": F.when(known, F.col("_date"))}).drop("_ref", "_supplier", "_date")


def mapped(rows: DataFrame, table: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Rows with the value of their key in a lookup table, whose last row of a key counts."""
    return rows.join(table.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(value)), key, "left")


def to_query(register: DataFrame) -> DataFrame:
    """Items without a code whose reference is worth a query, active first (SP23, SP24)."""
    return register.where(F.col("gtin").isNull() & T.queryable_ref(F.col("ref"), F.coalesce("ref_origin", F.lit("supplier")))).orderBy(F.col("active").desc_nulls_last(), "item_code")


def to_verify(register: DataFrame) -> DataFrame:
    """Usable codes that rest on a doubtful registry link (SP25)."""
    return register.where(F.col("usable") & T.doubtful_link(F.col("source"), F.col("ref")))


def with_stock(items: DataFrame, stock: DataFrame, activity: DataFrame) -> DataFrame:
    """Items with stock and activity, where known (SP26)."""
    return items.join(first_by(stock, ["item_code"], [F.col("stock").desc_nulls_last()]), "item_code", "left").join(first_by(activity, ["item_code"], asc("active")), "item_code", "left")


def share_counts(items: DataFrame, key: str) -> DataFrame:
    return group_size(items, [key], "n_sharing")


def summary_line(scope: DataFrame, version: str) -> DataFrame:
    """Manifest row of a population: version, rows, digest of its codes in order (SP11 to SP13)."""
    return scope.agg(F.lit(version).alias("version"), F.count(F.lit(1)).alias("n_items"), F.sum(F.xxhash64("item_code").cast("decimal(38,0)")).cast("string").alias("fingerprint"))


def activity_window(orders: DataFrame, until: str, months: int = 12) -> DataFrame:
    """Orders in the months before a day, that day included."""
    day = F.lit(until).cast("date")
    return orders.where((F.col("order_date").cast("date") > F.add_months(day, -months)) & (F.col("order_date").cast("date") <= day))


def running_number(df: DataFrame, keys: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*asc(*order))))
