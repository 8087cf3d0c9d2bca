"""Queries of the price side over the driver's tables, each with the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import pricing as P
from tallyforge.functions import text as T
from tallyforge.operators import offers as O
from tallyforge.operators import quality as Q
from tallyforge.operators import reconcile as R
from tallyforge.operators import relational as rel
from tallyforge.operators import scope as S
from tallyforge.plans import views as V
from tallyforge.plans.views import ITEMS, OFFERS, READINGS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_PACKS = "[" + ", ".join(map(str, P.PLAUSIBLE_PACKS)) + "]"
_ALERTS = "[" + ", ".join(map(str, P.ALERT_PACKS)) + "]"
#: Nearest plausible pack of a ratio: the smallest relative gap, then the smallest pack.
_ROUND_PACK = f"list_sort([{{'gap': abs({{r}} - n) / n, 'n': n}} for n in {_PACKS} if abs({{r}} - n) <= 0.06 * n])[1].n"


def round_pack_sql(r: str) -> str:
    return _ROUND_PACK.replace("{r}", r).replace("{{", "{").replace("}}", "}")


MATCHED = f"""{ITEMS}, {OFFERS},
keyed AS (SELECT o.*, upper(replace(supplier_ref, ' ', '')) AS skey, replace(replace(replace(replace(upper(replace(supplier_ref, ' ', '')), '.', ''), '-', ''), '_', ''), '/', '') AS lkey FROM offers o),
strict AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY ordinal) AS rn FROM keyed) WHERE rn = 1),
loose AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lkey ORDER BY ordinal) AS rn FROM keyed) WHERE rn = 1),
ikeys AS (SELECT *, regexp_replace(upper(supplier_ref), '\\.0$', '') AS skey, upper(manufacturer_ref) AS mkey FROM items),
ikeys2 AS (SELECT *, replace(replace(replace(replace(skey, '.', ''), '-', ''), '_', ''), '/', '') AS lkey FROM ikeys),
cands AS (SELECT i.item_code, 0 AS pass, 'strict reference' AS key_used, s.ordinal, s.price FROM ikeys2 i JOIN strict s ON i.skey = s.skey
 UNION ALL SELECT i.item_code, 1, 'loose reference', s.ordinal, s.price FROM ikeys2 i JOIN loose s ON i.lkey = s.lkey
 UNION ALL SELECT i.item_code, 2, 'manufacturer reference', s.ordinal, s.price FROM ikeys2 i JOIN strict s ON i.mkey = s.skey),
matched AS (SELECT i.item_code, i.k, i.old_price, i.label AS item_label, c.key_used, c.price AS offer_price FROM items i LEFT JOIN
 (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_code ORDER BY pass, ordinal) AS rn FROM cands WHERE price IS NOT NULL) WHERE rn = 1) c USING (item_code))"""


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their offer; suppliers are left open, so that keys alone decide."""
    items = V.items(spark, sf_dir)
    offers = V.offers(spark, sf_dir).withColumn("supplier", F.lit(None).cast("string"))
    links = items.select("item_code", F.lit(None).cast("string").alias("gtin")).where("false")
    return O.cascade(items, offers, links)


@query(f"WITH {MATCHED} SELECT item_code, key_used, offer_price FROM matched")
def match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).select("item_code", "key_used", "offer_price")


_ALERT = f"""CASE WHEN offer_price IS NULL THEN '' WHEN old_price IS NULL OR old_price <= 0 THEN 'first price'
 WHEN len([n for n in {_ALERTS} if abs(ratio - n) <= 0.02 * n OR abs(ratio - CAST(1 AS DOUBLE) / n) <= CAST(0.02 AS DOUBLE) / n]) > 0 AND abs(ratio - 1) > 0.3 THEN 'pack size'
 WHEN ratio >= 3 OR ratio <= 1 / CAST(3 AS DOUBLE) THEN 'too far' WHEN abs(ratio - 1) > 1 THEN 'suspect' WHEN abs(ratio - 1) > 0.3 THEN 'review' ELSE '' END"""
_RATIOS = MATCHED + ", ratios AS (SELECT *, CASE WHEN old_price > 0 THEN offer_price / old_price END AS ratio FROM matched)"


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir).withColumn("ratio", F.col("offer_price") / F.when(F.col("old_price") > 0, F.col("old_price")))


@query(f"WITH {_RATIOS} SELECT item_code, {_ALERT} AS alert FROM ratios")
def price_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratios(spark, sf_dir).select("item_code", P.price_alert(F.col("old_price"), F.col("offer_price")).alias("alert"))


_GUARDED = _RATIOS + ", guarded AS (SELECT *, coalesce(ratio > 10 OR ratio < 1 / CAST(10 AS DOUBLE), false) AS aberrant FROM ratios)"


@query(f"WITH {_GUARDED}, b AS (SELECT CASE WHEN aberrant THEN 'aberrant' WHEN offer_price IS NULL THEN 'no price' WHEN ({_ALERT}) <> '' THEN 'to review' ELSE 'priced' END AS bucket FROM guarded) SELECT bucket, count(*) AS n, (SELECT count(*) FROM b) = (SELECT count(*) FROM part) AS conserved FROM b GROUP BY 1")
def price_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ratios(spark, sf_dir)
    rows = rows.withColumn("alert", P.price_alert(F.col("old_price"), F.col("offer_price")))
    return rel.conserved(V.table(spark, sf_dir, "part"), O.partitioned(O.guarded(rows)), "bucket")


@query(f"WITH {_GUARDED} SELECT item_code, CASE WHEN aberrant THEN offer_price END AS review_price, CASE WHEN NOT aberrant THEN offer_price END AS offer_price, aberrant FROM guarded")
def aberrant_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.guarded(ratios(spark, sf_dir)).select("item_code", "review_price", "offer_price", "aberrant")


_LINES = "lines AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS supplier, l_extendedprice / l_quantity / p_retailprice AS ratio FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_retailprice > 0)"


def line_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = V.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice").where("p_retailprice > 0")
    lines = V.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("supplier"), (F.col("l_extendedprice") / F.col("l_quantity") / F.col("p_retailprice")).alias("ratio"))


@query(
    f"""WITH {_LINES}, packs AS (SELECT *, {round_pack_sql("ratio")} AS pack FROM lines), base AS (SELECT supplier, count(*) AS n_rows, median(ratio) AS median_ratio FROM packs GROUP BY 1),
 modes AS (SELECT supplier, pack, count(*) AS n_mode, row_number() OVER (PARTITION BY supplier ORDER BY count(*) DESC, pack) AS rn FROM packs WHERE pack IS NOT NULL GROUP BY 1, 2)
 SELECT b.supplier, n_rows, median_ratio, NOT (median_ratio BETWEEN 0.7 AND 1.3) AS out_of_band, CAST(pack AS INT) AS modal_pack, coalesce(n_mode, 0) / CAST(n_rows AS DOUBLE) AS modal_share FROM base b LEFT JOIN (SELECT * FROM modes WHERE rn = 1) m USING (supplier)"""
)
def pack_diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.pack_diagnostic(line_ratios(spark, sf_dir))


@query(
    f"""WITH {_LINES}, packs AS (SELECT *, {round_pack_sql("ratio")} AS pack FROM lines WHERE ratio > 1.5), c AS (SELECT supplier, pack, count(*) AS n, sum(count(*)) OVER (PARTITION BY supplier) AS total FROM packs GROUP BY 1, 2),
 m AS (SELECT *, row_number() OVER (PARTITION BY supplier ORDER BY n DESC, pack) AS rn FROM c WHERE pack IS NOT NULL)
 SELECT supplier, CAST(pack AS INT) AS factor, CAST(total AS BIGINT) AS n_comparable, n AS n_on_factor FROM m WHERE rn = 1 AND total >= 5 AND pack >= 2 AND n >= 0.02 * total"""
)
def systematic_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a small share, as the table's ratios are spread out."""
    return O.systematic_factor(line_ratios(spark, sf_dir).where("ratio > 1.5"), ["supplier"], share=0.02, smallest=2)


@query(
    f"""WITH {_LINES}, r AS (SELECT *, floor(ratio * 100 + 0.5000001) / 100 AS ratio_2dp FROM lines), c AS (SELECT supplier, ratio_2dp, count(*) AS n_same FROM r GROUP BY 1, 2)
 SELECT supplier, ratio_2dp, n_same, n_same >= 5 AND abs(ratio_2dp - 1) > 0.15 AS systematic, count(*) AS n_rows FROM r JOIN c USING (supplier, ratio_2dp) GROUP BY 1, 2, 3, 4"""
)
def systematic_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.recurrence(line_ratios(spark, sf_dir), ["supplier"])
    return rows.groupBy("supplier", "ratio_2dp", "n_same", "systematic").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"""WITH {OFFERS}, cheap AS (SELECT part, qty, min(price) AS price FROM offers WHERE price > 0 GROUP BY 1, 2), first AS (SELECT part, arg_min(price, qty) AS unit_price, min(qty) AS pack FROM cheap GROUP BY 1),
 good AS (SELECT c.part, c.qty, c.price, row_number() OVER (PARTITION BY c.part ORDER BY c.qty) AS rn FROM cheap c JOIN first f ON c.part = f.part WHERE c.qty > f.pack AND c.qty > 1 AND c.price < f.unit_price)
 SELECT f.part, unit_price, pack, t2.qty AS tier2_qty, t2.price AS tier2_cost, t3.qty AS tier3_qty, t3.price AS tier3_cost, 1 - t2.price / unit_price AS tier2_saving, 'offer ' || f.part AS label
 FROM first f LEFT JOIN good t2 ON f.part = t2.part AND t2.rn = 1 LEFT JOIN good t3 ON f.part = t3.part AND t3.rn = 2"""
)
def tier_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.tier_grid(V.offers(spark, sf_dir), ["part"]).select("part", "unit_price", "pack", "tier2_qty", "tier2_cost", "tier3_qty", "tier3_cost", "tier2_saving", "label")


@query(
    f"""WITH {OFFERS}, cheap AS (SELECT part, qty, min(price) AS price FROM offers WHERE price > 0 GROUP BY 1, 2), first AS (SELECT part, arg_min(price, qty) AS base FROM cheap GROUP BY 1),
 wanted AS (SELECT unnest([1.0, 7.0, 20.0, 45.0]) AS wanted), asked AS (SELECT part, base, wanted, ceil(wanted / 4) * 4 AS ordered FROM first, wanted)
 SELECT a.part, CAST(wanted AS DOUBLE) AS wanted, CAST(ordered AS DOUBLE) AS ordered, least(base, coalesce((SELECT min(c.price) FROM cheap c WHERE c.part = a.part AND c.qty > 1 AND c.qty <= a.ordered), base)) AS unit_price FROM asked a"""
)
def price_for_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = O.tier_grid(V.offers(spark, sf_dir), ["part"]).withColumn("wanted", F.explode(F.array(*[F.lit(x) for x in (1.0, 7.0, 20.0, 45.0)])))
    told = P.price_for_quantity(F.col("unit_price"), F.lit(4.0), F.col("tiers"), F.col("wanted"))
    return grid.select("part", "wanted", told.alias("t")).select("part", "wanted", F.col("t.ordered"), F.col("t.unit_price"))


@query(
    "SELECT l_orderkey, l_linenumber, p / (1 + l_tax) * (1 - l_discount) AS recomputed, abs(p / (1 + l_tax) * (1 - l_discount) - n) AS gap, abs(p / (1 + l_tax) * (1 - l_discount) - n) < 0.05 AS coherent FROM (SELECT *, l_extendedprice / l_quantity AS p, l_extendedprice / l_quantity / (1 + l_tax) * (1 - l_discount) + CASE WHEN l_orderkey % 3 = 0 THEN 0.06 ELSE 0.04 END AS n FROM lineitem)"
)
def price_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_extendedprice") / F.col("l_quantity")
    net = p / (1 + F.col("l_tax")) * (1 - F.col("l_discount")) + F.when(F.col("l_orderkey") % 3 == 0, 0.06).otherwise(0.04)
    return V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", P.coherence(p, F.col("l_tax"), F.col("l_discount"), net).alias("c")).select("l_orderkey", "l_linenumber", "c.*")


_FROZEN = "x AS (SELECT item_code, EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = k AND l_returnflag = 'R') AS sold_12m, EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = k AND l_linestatus = 'O') AS bought_12m, k % 5 = 0 AS in_catalogue, type, family FROM items)"
_TYPES, _FAMILIES = ("PROMO", "ECONOMY"), ("Brand#11", "Brand#23")


def scope_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.annotated(V.items(spark, sf_dir), S.Rules(types=_TYPES, families=_FAMILIES))


_REASON = "CASE WHEN upper(trim(split_part(type, '-', 1))) IN ('PROMO', 'ECONOMY') THEN 'type ' || upper(trim(split_part(type, '-', 1))) WHEN family IN ('Brand#11', 'Brand#23') THEN 'family ' || family END"


@query(f"WITH {ITEMS} SELECT item_code, {_REASON} AS reason, ({_REASON}) IS NULL AS in_scope FROM items")
def scope_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope_items(spark, sf_dir).select("item_code", "reason", "in_scope")


@query(f"WITH {ITEMS} SELECT upper(trim(split_part(type, '-', 1))) AS type_code, ({_REASON}) IS NULL AS in_scope, count(*) AS n_items FROM items GROUP BY 1, 2")
def scope_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.by_type(scope_items(spark, sf_dir))


@query(f"WITH {ITEMS}, {_FROZEN} SELECT item_code, sold_12m, bought_12m, in_catalogue, CASE WHEN sold_12m THEN 'sold' WHEN bought_12m THEN 'bought' ELSE 'catalogue' END AS door FROM x WHERE (sold_12m OR bought_12m OR in_catalogue) AND ({_REASON}) IS NULL")
def scope_doors(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = V.table(spark, sf_dir, "lineitem")
    code = F.col("l_partkey").cast("string").alias("item_code")
    sold, bought = line.where("l_returnflag = 'R'").select(code), line.where("l_linestatus = 'O'").select(code)
    items = scope_items(spark, sf_dir)
    return S.doors(items, sold, bought, items.where("k % 5 = 0")).select("item_code", "sold_12m", "bought_12m", "in_catalogue", "door")


@query(f"WITH {ITEMS} SELECT internal_ref, count(DISTINCT item_code) AS n_items FROM items GROUP BY 1 HAVING count(DISTINCT item_code) > 1")
def colliding_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.colliding_refs(V.items(spark, sf_dir))


_ORDERS = "hist AS (SELECT CAST(l_partkey AS VARCHAR) AS item_code, 'S' || CAST(l_suppkey AS VARCHAR) AS supplier, CASE WHEN l_orderkey % 50 <> 0 THEN o_orderdate END AS order_date, l_orderkey AS ordinal, l_extendedprice AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = V.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_extendedprice")
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_partkey").cast("string").alias("item_code"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("supplier"), F.when(F.col("l_orderkey") % 50 != 0, F.col("o_orderdate")).alias("order_date"), F.col("l_orderkey").alias("ordinal"), F.col("l_extendedprice").alias("amount"))


@query(f"WITH {_ORDERS} SELECT item_code, supplier, order_date, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY item_code ORDER BY order_date DESC NULLS LAST, ordinal DESC, supplier DESC, amount DESC) AS rn FROM hist) WHERE rn = 1")
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.latest_order(order_history(spark, sf_dir)).select("item_code", "supplier", "order_date", "ordinal")


@query(
    f"""WITH {ITEMS}, {_ORDERS}, last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_code ORDER BY order_date DESC NULLS LAST, ordinal DESC, supplier DESC, amount DESC) AS rn FROM hist) WHERE rn = 1),
 shared AS (SELECT internal_ref FROM items GROUP BY 1 HAVING count(DISTINCT item_code) > 1)
 SELECT i.item_code, coalesce(i.supplier, CASE WHEN s.internal_ref IS NULL THEN l.supplier END) AS supplier, coalesce(i.supplier_ref, CASE WHEN s.internal_ref IS NULL AND l.supplier IS NOT NULL THEN 'ORD-' || i.item_code END, i.manufacturer_ref) AS supplier_ref,
 CASE WHEN i.supplier_ref IS NOT NULL THEN 'item master' WHEN s.internal_ref IS NULL AND l.supplier IS NOT NULL THEN 'orders' ELSE 'manufacturer' END AS ref_origin FROM items i LEFT JOIN last l USING (item_code) LEFT JOIN shared s ON i.internal_ref = s.internal_ref"""
)
def enriched_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = order_history(spark, sf_dir).withColumn("supplier_ref", F.concat(F.lit("ORD-"), "item_code"))
    return S.enriched(V.items(spark, sf_dir), orders).select("item_code", "supplier", "supplier_ref", "ref_origin")


@query(f"WITH {ITEMS} SELECT DISTINCT i.supplier FROM items i WHERE i.supplier IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey % 2 = 0 AND 'S' || CAST(s.s_suppkey AS VARCHAR) = i.supplier)")
def remaining_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    swept = V.table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("supplier"))
    return S.remaining_suppliers(V.items(spark, sf_dir), swept)


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reconciled(*V.owner_and_ours(spark, sf_dir))


@query(f"WITH {READINGS} SELECT item_code, supplier, owner_price, our_price, price_class, ratio, CASE WHEN price_class <> 'DIVERGE' THEN '' WHEN origin LIKE 'supplier list%' THEN 'reading' WHEN origin LIKE '%internal%' THEN 'decision' ELSE 'undetermined' END AS nature FROM classed")
def reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir).select("item_code", "supplier", "owner_price", "our_price", "price_class", "ratio", "nature")


@query(
    f"""WITH {READINGS}, g AS (SELECT supplier, count(*) AS n_compared, count(*) FILTER (WHERE price_class = 'AGREE') AS n_agree, count(*) FILTER (WHERE price_class = 'DIVERGE') AS n_diverge, median(ratio) AS median_ratio, min(ratio) AS min_ratio, max(ratio) AS max_ratio
 FROM classed WHERE price_class IN ('AGREE', 'DIVERGE') AND supplier IS NOT NULL GROUP BY 1)
 SELECT *, CASE WHEN n_diverge = 0 THEN 'OK' WHEN n_compared < 5 THEN 'TOO_FEW' WHEN abs(median_ratio - 1) <= 0.005 THEN 'SINGLE_ROWS' WHEN max_ratio - min_ratio <= 0.02 THEN 'SYSTEMATIC' ELSE 'DISPERSED' END AS verdict FROM g"""
)
def reconcile_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.supplier_verdicts(_reconciled(spark, sf_dir))


@query(f"WITH {READINGS} SELECT price_class, count(*) AS n_rows, 100.0 * count(*) / CAST((SELECT count(*) FROM classed) AS DOUBLE) AS pct FROM classed GROUP BY 1")
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.summary(_reconciled(spark, sf_dir))


@query("SELECT item_code, price, added FROM (SELECT 'C' || CAST(c_custkey AS VARCHAR) AS item_code, c_acctbal AS price, false AS added FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'C' || CAST(o_custkey AS VARCHAR), min(o_totalprice), true FROM orders WHERE o_custkey % 3 <> 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1)")
def merge_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = V.table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("item_code"), F.col("c_acctbal").alias("price"))
    new = V.table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("item_code")).agg(F.min("o_totalprice").alias("price"))
    return R.appended(existing, new).select("item_code", "price", "added")


@query("WITH s AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_partkey % 3 <> 1), p AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 2 = 0) SELECT (SELECT count(*) FROM s) AS n_scope, (SELECT count(*) FROM p) AS n_priced, (SELECT count(*) FROM s JOIN p USING (k)) AS n_covered, 100.0 * (SELECT count(*) FROM s JOIN p USING (k)) / CAST((SELECT count(*) FROM s) AS DOUBLE) AS covered_pct")
def merge_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = V.table(spark, sf_dir, "lineitem").where("l_partkey % 3 <> 1").select(F.col("l_partkey").cast("string").alias("item_code"))
    merged = V.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("item_code"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice")).alias("price"))
    return R.coverage(scope, merged)


_STATE = f"""WITH {MATCHED}, hand AS (SELECT item_code, CASE WHEN k % 10 = 1 THEN 1.0 END AS fixed, CASE WHEN k % 10 = 2 THEN 2.0 END AS annotated, k % 10 = 3 AS keep FROM items), base AS (SELECT i.item_code, i.supplier, i.k, i.old_price, m.offer_price, CASE WHEN m.offer_price IS NOT NULL THEN CASE WHEN i.k % 4 = 0 THEN 'owner' ELSE 'list' END END AS origin, h.* EXCLUDE (item_code)
 FROM items i JOIN matched m USING (item_code) JOIN hand h USING (item_code)), priced AS (SELECT *, CASE WHEN origin = 'owner' THEN offer_price WHEN keep AND old_price IS NOT NULL THEN old_price ELSE coalesce(annotated, fixed, offer_price) END AS price FROM base),
 st AS (SELECT *, CASE WHEN supplier = 'S13' THEN 4 WHEN price IS NOT NULL AND origin = 'owner' THEN 1 WHEN price IS NOT NULL THEN 2 ELSE 3 END AS status FROM priced)
 SELECT item_code, supplier, old_price, CAST(price AS DOUBLE) AS price, origin, CAST(price AS DOUBLE) / old_price - 1 AS gap, CAST(status AS INT) AS status, CASE WHEN status = 3 THEN CASE WHEN k % 6 = 0 THEN 'reference not in list' WHEN supplier IS NULL THEN 'no supplier' ELSE 'no list received' END END AS reason FROM st"""


@query(_STATE)
def item_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matched(spark, sf_dir)
    k = F.col("k")
    prices = m.where("offer_price is not null").select("item_code", F.col("offer_price").alias("price"), F.when(k % 4 == 0, "owner").otherwise("list").alias("origin"), F.lit(None).cast("double").alias("old_price"), F.lit(0).alias("priority"), F.lit(0).alias("ordinal"))
    reasons = m.where("k % 6 = 0").select("item_code", F.lit("gap").alias("kind"), F.lit("reference not in list").alias("reason"), F.lit(0).alias("ordinal"))
    kind = F.when(k % 10 == 1, "fixed").when(k % 10 == 2, "annotated").when(k % 10 == 3, "keep")
    overrides = V.items(spark, sf_dir).select("item_code", kind.alias("kind"), F.when(k % 10 == 1, 1.0).otherwise(2.0).alias("price")).where("kind is not null")
    dropped = spark.createDataFrame([("S13",)], "supplier string")
    items = V.items(spark, sf_dir)
    return R.state(items.select("item_code", "supplier"), items.select("item_code", "old_price"), prices, reasons, overrides, dropped)


@query(
    "SELECT set_aside, CASE set_aside WHEN 'dropped' THEN 'dropped' WHEN 'discontinued' THEN 'discontinued' WHEN 'annotated' THEN 'set aside' WHEN 'family' THEN 'set aside' WHEN 'parked' THEN 'set aside' WHEN 'no_catalogue' THEN 'no catalogue' ELSE 'open' END AS sheet, count(*) AS n_items FROM (SELECT CASE WHEN p_partkey % 17 = 0 THEN 'dropped' WHEN p_partkey % 13 = 0 THEN 'discontinued' WHEN p_partkey % 11 = 0 THEN 'annotated' WHEN p_partkey % 7 = 0 THEN 'family' WHEN p_partkey % 5 = 0 THEN 'parked' WHEN p_partkey % 3 = 0 THEN 'no_catalogue' ELSE '' END AS set_aside FROM part) GROUP BY 1, 2"
)
def set_aside_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"dropped": 17, "discontinued": 13, "annotated": 11, "family": 7, "parked": 5, "no_catalogue": 3}
    rows = V.table(spark, sf_dir, "part").withColumns({n: F.col("p_partkey") % m == 0 for n, m in flags.items()})
    return R.sheets(R.set_aside(rows)).groupBy("set_aside", "sheet").agg(F.count(F.lit(1)).alias("n_items"))


_OFFER_ROWS = f"""{ITEMS}, {V.GTINS}, q AS (SELECT i.k, i.label, CASE WHEN i.k % 30 = 0 THEN NULL WHEN i.k % 31 = 0 THEN -1.0 ELSE old_price END AS unit_cost, 'R' || CAST(i.k // 2 AS VARCHAR) AS supplier_ref, g.gtin AS gtin_unit, i.k % 4 = 0 AS pack_assumed, CASE i.k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS cost_coherent,
 CASE WHEN i.k % 5 = 0 THEN 6.0 END AS tier2_qty, CASE WHEN i.k % 5 = 0 THEN old_price * CASE WHEN i.k % 10 = 0 THEN CAST(1.1 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END END AS tier2_cost FROM items i JOIN gtins g USING (item_code))"""


def offer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    rows = V.items(spark, sf_dir).drop("supplier_ref", "supplier").join(V.gtins(spark, sf_dir).select("item_code", F.col("gtin").alias("gtin_unit")), "item_code")
    return rows.select(
        F.lit("X").alias("supplier"), F.concat(F.lit("R"), F.floor(k / 2).cast("string")).alias("supplier_ref"), "label", F.when(k % 30 == 0, None).when(k % 31 == 0, -1.0).otherwise(F.col("old_price")).alias("unit_cost"), "gtin_unit", k.alias("ordinal"),
        (k % 4 == 0).alias("pack_assumed"), F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("cost_coherent"), F.when(k % 5 == 0, 6.0).alias("tier2_qty"), F.when(k % 5 == 0, F.col("old_price") * F.when(k % 10 == 0, 1.1).otherwise(0.9)).alias("tier2_cost"),
        F.lit(None).cast("double").alias("tier3_qty"), F.lit(None).cast("double").alias("tier3_cost"), F.lit(None).cast("double").alias("list_price_gross"), (F.col("k") % 3).cast("double").alias("vat_rate"),
    )


_HAS = "coalesce(trim(gtin_unit) <> '', false)"


@query(
    f"""WITH {_OFFER_ROWS}, r AS (SELECT supplier_ref, count(*) AS n_ref, count(DISTINCT unit_cost) AS n_ref_prices FROM q GROUP BY 1), c AS (SELECT gtin_unit, count(*) AS n_gtin, count(DISTINCT label) AS n_labels FROM q WHERE {_HAS} GROUP BY 1),
 a AS (SELECT q.*, n_ref, n_ref_prices, n_gtin, n_labels FROM q JOIN r USING (supplier_ref) LEFT JOIN c USING (gtin_unit)),
 u AS (SELECT k, unit_cost, unnest([CASE WHEN unit_cost IS NULL THEN 'price missing' END, CASE WHEN unit_cost <= 0 THEN 'price not positive' END, CASE WHEN NOT cost_coherent THEN 'price incoherent' END, CASE WHEN tier2_cost > unit_cost THEN 'tiers inconsistent' END,
 CASE WHEN n_ref > 1 AND n_ref_prices > 1 THEN 'duplicate reference, prices differ' END, CASE WHEN n_ref > 1 AND n_ref_prices <= 1 THEN 'duplicate reference' END, CASE WHEN {_HAS} AND NOT {V.valid_sql("gtin_unit")} THEN 'barcode invalid' END,
 CASE WHEN n_gtin > 1 AND n_labels > 1 THEN 'duplicate barcode, labels differ' END, CASE WHEN NOT {_HAS} THEN 'barcode missing' END, CASE WHEN pack_assumed THEN 'pack assumed' END]) AS problem, generate_subscripts([1,2,3,4,5,6,7,8,9,10], 1) AS severity FROM a)
 SELECT k AS ordinal, problem, CAST(severity AS INT) AS severity FROM u WHERE problem IS NOT NULL"""
)
def quality_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.anomalies(offer_rows(spark, sf_dir)).select("ordinal", "problem", "severity")


@query(
    f"""WITH {_OFFER_ROWS}, t AS (SELECT count(*) AS n0, count_if(unit_cost > 0) AS n1, count_if(unit_cost IS NULL) AS n2, count_if(cost_coherent) AS n3, count_if(NOT cost_coherent) AS n4, count_if(cost_coherent IS NULL) AS n5, count_if({_HAS}) AS n6, count_if({V.valid_sql("gtin_unit")}) AS n7, count_if(NOT pack_assumed) AS n8, count_if(pack_assumed) AS n9, count_if(tier2_qty IS NOT NULL) AS n10, 0 AS n11, count(*) AS n12 FROM q)
 SELECT indicator, CAST(n AS BIGINT) AS n, 100.0 * n / CAST(n0 AS DOUBLE) AS pct FROM (SELECT n0, unnest(['rows', 'with price', 'price missing', 'coherent', 'incoherent', 'not checkable', 'with barcode', 'barcode valid', 'pack known', 'pack assumed', 'with tiers', 'with list price', 'with label']) AS indicator, unnest([n0, n1, n2, n3, n4, n5, n6, n7, n8, n9, n10, n11, n12]) AS n FROM t)"""
)
def quality_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.indicators(offer_rows(spark, sf_dir))


@query("SELECT p_partkey, text, try_cast(replace(regexp_replace(replace(text, ',', '.'), '[^0-9.-]', '', 'g'), ' ', '') AS DOUBLE) / CASE WHEN contains(text, '%') THEN 100 ELSE 1 END AS value FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '1 ' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || ',50 €' WHEN 1 THEN CAST(p_size AS VARCHAR) || ' %' WHEN 2 THEN '-' ELSE '1.234,' || CAST(p_size AS VARCHAR) END AS text FROM part)")
def number_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    text = F.when(k % 4 == 0, F.concat(F.lit("1 "), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(",50 €"))).when(k % 4 == 1, F.concat(F.col("p_size").cast("string"), F.lit(" %"))).when(k % 4 == 2, "-").otherwise(F.concat(F.lit("1.234,"), F.col("p_size").cast("string")))
    return V.table(spark, sf_dir, "part").select("p_partkey", text.alias("text")).withColumn("value", T.clean_number(F.col("text")))


@query(
    f"WITH {ITEMS} SELECT item_code, regexp_replace(upper(supplier_ref), '\\.0$', '') AS strict_ref, replace(replace(replace(replace(regexp_replace(upper(supplier_ref), '\\.0$', ''), '.', ''), '-', ''), '_', ''), '/', '') AS loose_ref, nullif(regexp_extract(manufacturer_ref, '([0-9]{{6,}})', 1), '') AS stem, length(supplier_ref) >= 9 AS reliable FROM items WHERE supplier_ref IS NOT NULL"
)
def reference_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.col("supplier_ref")
    return V.items(spark, sf_dir).where("supplier_ref is not null").select("item_code", T.strict_ref(ref).alias("strict_ref"), T.loose_ref(ref).alias("loose_ref"), T.reference_stem(F.col("manufacturer_ref")).alias("stem"), T.reliable_ref(ref).alias("reliable"))


@query("SELECT s_suppkey, text, CASE text WHEN '20+10%' THEN 28.0 WHEN '28% (20+10%)' THEN 28.0 WHEN '7,5%' THEN 7.5 END AS pct FROM (SELECT s_suppkey, ['20+10%', '28% (20+10%)', '7,5%', '120%', 'none'][CAST(s_suppkey % 5 + 1 AS INT)] AS text FROM supplier)")
def compound_discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(x) for x in ("20+10%", "28% (20+10%)", "7,5%", "120%", "none")])
    rows = V.table(spark, sf_dir, "supplier").select("s_suppkey", F.element_at(kinds, (F.col("s_suppkey") % 5 + 1).cast("int")).alias("text"))
    return rows.withColumn("pct", P.compound_discount(F.col("text")))


@query(
    f"""WITH {MATCHED}, r AS (SELECT m.*, i.family AS supplier, CASE WHEN m.old_price > 0 THEN offer_price / m.old_price END AS ratio, CASE WHEN m.k % 7 > 0 THEN CAST(m.k % 7 * 2 AS INT) END AS n FROM matched m JOIN items i USING (item_code)),
 t AS (SELECT *, n IS NOT NULL AND (ratio IS NULL OR (ratio > sqrt(n) AND ratio >= n / 1.5e0 AND ratio <= n * 1.5e0)) AS trusted FROM r),
 packs AS (SELECT supplier, {round_pack_sql("ratio")} AS pack FROM t WHERE NOT trusted AND ratio IS NOT NULL), c AS (SELECT supplier, pack, count(*) AS n_on, sum(count(*)) OVER (PARTITION BY supplier) AS total FROM packs GROUP BY 1, 2),
 f AS (SELECT supplier, pack AS factor FROM (SELECT *, row_number() OVER (PARTITION BY supplier ORDER BY n_on DESC, pack) AS rn FROM c WHERE pack IS NOT NULL) WHERE rn = 1 AND total >= 5 AND pack >= 5 AND n_on >= 0.6 * total),
 d AS (SELECT t.*, factor, NOT trusted AND factor IS NOT NULL AND offer_price IS NOT NULL AND (ratio IS NULL OR (ratio > sqrt(factor) AND ratio >= factor / 1.5e0 AND ratio <= factor * 1.5e0)) AS taken FROM t LEFT JOIN f USING (supplier)),
 e AS (SELECT *, CAST(CASE WHEN trusted THEN n WHEN taken THEN factor ELSE 1 END AS DOUBLE) AS divisor FROM d)
 SELECT item_code, divisor, CASE WHEN trusted THEN 'label' WHEN taken THEN 'systematic' ELSE 'none' END AS divisor_source, offer_price / divisor AS unit_price, CASE WHEN divisor > 1 THEN divisor ELSE 1e0 END AS min_order,
 CASE WHEN n IS NOT NULL AND NOT trusted THEN 'label says ' || CAST(n AS VARCHAR) || ', the old price contradicts' END AS refused, ratio IS NULL AND (n IS NOT NULL OR taken) AS uncorroborated FROM e"""
)
def pack_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matched(spark, sf_dir)
    rows = m.select("item_code", F.col("family").alias("supplier"), "offer_price", "old_price", F.concat(F.lit("box of "), (F.col("k") % 7 * 2).cast("string")).alias("offer_label"), F.col("label").alias("item_label"), F.col("offer_pack"), F.lit(True).alias("pack_assumed"), F.lit(False).alias("has_tiers"), F.lit(False).alias("validated"))
    return O.pack_inference(rows).select("item_code", "divisor", "divisor_source", "unit_price", "min_order", "refused", "uncorroborated")
