"""Queries of operators that no flow above reaches by itself, each with the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import gtin as G
from tallyforge.functions import labels as L
from tallyforge.functions import pricing as P
from tallyforge.functions import text as T
from tallyforge.operators import extract as X
from tallyforge.operators import matching as M
from tallyforge.operators import offers as O
from tallyforge.operators import quality as Q
from tallyforge.operators import reconcile as R
from tallyforge.operators import scope as S
from tallyforge.plans import views as V
from tallyforge.plans.code_queries import _W
from tallyforge.plans.price_queries import _ORDERS, _REASON, _reconciled, order_history, query, round_pack_sql, scope_items
from tallyforge.plans.views import GTINS, ITEMS, OFFERS, READ_CODES, READINGS
from tallyforge.sources import readers


def _words(c: str) -> str:
    return _W.replace("{c}", c)


_TELLING = "list_filter({w}, lambda w: length(w) >= 3 AND NOT list_contains(" + str(list(L.DEFAULT.company)) + ", w) AND NOT regexp_full_match(w, '[0-9]+'))"


@query(
    f"""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '' END AS filled, CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS DOUBLE) END AS tier, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE split_part(p_name, ' ', 1) END AS first_word,
 replace(CAST(CAST(p_size * 12.5 AS DECIMAL(9, 1)) AS VARCHAR), '.', ',') || ' %' AS share, array_to_string(list_filter({_words("p_name || ' no ' || p_type || ' ' || p_brand")}, lambda w: length(w) > 2)[1:4], '_') AS file, regexp_replace(regexp_replace(regexp_replace(upper(p_name), '\\bLARGE\\b', 'L'), '\\bSMALL\\b', 'S'), '\\bMEDIUM\\b', 'M') || ' XL M' AS sized FROM part"""
)
def text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled texts, tiers, first groups, shares, file names and sizes (SC31, SC21, SC45, SC46, IO34, MT32)."""
    k, name = F.col("p_partkey"), F.col("p_name")
    return V.table(spark, sf_dir, "part").select(
        "p_partkey",
        T.filled(F.when(k % 3 == 0, F.concat(F.lit("  "), name, F.lit(" "))).when(k % 3 == 1, " NaN")).alias("filled"),
        T.tier_number(F.when(k % 4 == 0, "none").otherwise(F.col("p_size").cast("string"))).alias("tier"),
        T.first_group(F.when(k % 5 != 0, name), r"^([a-z]+)\s").alias("first_word"),
        T.comma_percent(F.col("p_size") / 8).alias("share"),
        T.file_name(F.concat_ws(" ", name, F.lit("no"), "p_type", "p_brand")).alias("file"),
        L.harmonised_sizes(F.concat(name, F.lit(" Extra Large medium"))).alias("sized"),
    )


_CHOSEN = f"{ITEMS}, chosen AS (SELECT item_code, k, coalesce(supplier_ref, CASE WHEN k % 4 > 1 THEN manufacturer_ref WHEN k % 4 = 1 AND k % 8 = 1 THEN lpad(CAST(k AS VARCHAR), 12, '0') END) AS ref, CASE WHEN supplier_ref IS NOT NULL THEN 'supplier' WHEN k % 4 > 1 OR k % 8 = 1 THEN 'manufacturer' END AS ref_origin FROM items)"


def chosen_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    maker = F.when(k % 4 == 0, "voir liste").when(k % 8 == 1, F.lpad(k.cast("string"), 12, "0")).when(k % 4 == 1, "2024-01-05").otherwise(F.col("manufacturer_ref"))
    return V.items(spark, sf_dir).select("item_code", "k", "internal_ref", T.reference_with_origin(F.col("supplier_ref"), maker).alias("_r")).select("item_code", "k", "internal_ref", "_r.*")


@query(f"WITH {_CHOSEN} SELECT item_code, ref, ref_origin, coalesce(length(ref) >= 9, false) AND (ref_origin <> 'manufacturer' OR regexp_full_match(ref, '[0-9]+')) AS queryable, k % 2 = 0 AND coalesce(length(ref), 0) < 9 AS doubtful FROM chosen")
def reference_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference to use, its origin, whether it is worth a query, and doubtful links (SC38 to SC42)."""
    rows = chosen_references(spark, sf_dir)
    source = F.when(F.col("k") % 2 == 0, "registry").when(F.col("k") % 3 == 0, "supplier")
    return rows.select("item_code", "ref", "ref_origin", T.queryable_ref(F.col("ref"), F.col("ref_origin")).alias("queryable"), T.doubtful_link(source, F.col("ref")).alias("doubtful"))


@query(
    f"""WITH {GTINS} SELECT item_code, CASE k % 8 WHEN 1 THEN 'wrong check digit, expected ' || substr(good, 13, 1) WHEN 2 THEN '14 digits, unit with leading zero' WHEN 3 THEN '14 digits, wrong check digit' WHEN 4 THEN 'not numeric' WHEN 5 THEN 'all zeros' WHEN 6 THEN 'absent' ELSE 'ok' END AS reason FROM gtins"""
)
def code_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a code is none (SC11)."""
    return V.gtins(spark, sf_dir).select("item_code", G.diagnosis(F.col("gtin")).alias("reason"))


@query(
    "SELECT l_linenumber, count(*) AS n_rows, count(*) FILTER (WHERE l_orderkey % 5 = 0) AS n_case, count(*) FILTER (WHERE l_orderkey % 5 = 0 OR l_orderkey % 7 = 0) AS n_breaks FROM lineitem GROUP BY 1"
)
def pricing_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case prices and offers that break an identity (PR2, PR12)."""
    key, unit = F.col("l_orderkey"), F.col("l_extendedprice") / F.col("l_quantity")
    case = P.case_cost(unit, F.col("l_linenumber").cast("double")) * F.when(key % 5 == 0, 1.001).otherwise(1.0)
    rows = V.table(spark, sf_dir, "lineitem").select("l_linenumber", "l_orderkey", unit.alias("unit_cost"), case.alias("case_cost"), F.col("l_linenumber").cast("double").alias("pack_size"), (unit * F.when(key % 7 == 0, 1.1).otherwise(0.9)).alias("tier2_cost"))
    broken = Q.invariant_breaks(rows).groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n_breaks"), F.count_if(F.col("l_orderkey") % 5 == 0).alias("n_case"))
    every = rows.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"))
    return every.join(broken, "l_linenumber", "left").select("l_linenumber", "n_rows", F.coalesce("n_case", F.lit(0)).alias("n_case"), F.coalesce("n_breaks", F.lit(0)).alias("n_breaks"))


@query("SELECT 'f' || CAST(s_suppkey AS VARCHAR) AS file, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey % 5 + 1 ELSE 0 END AS header_row, CASE WHEN s_suppkey % 3 <> 0 THEN 2 END AS price_col FROM supplier")
def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header rows by witness words, row 0 where there are none, and the price's column (EX1 to EX3, IO4, IO5)."""
    k = F.col("s_suppkey")
    cell = lambda row, col, value: F.struct(row.cast("int").alias("row_no"), F.lit(col).alias("col_no"), value.alias("value"))
    cells = F.array(
        cell(F.lit(0), 0, F.lit("Reference of the sheet")),
        cell(k % 5 + 1, 1, F.lit(" RÉFÉRENCE ")),
        cell(k % 5 + 1, 2, F.when(k % 3 != 0, "Unit Price (EUR)").otherwise("Unit")),
        cell(k % 5 + 2, 2, F.lit("price")),
        cell(k % 5 + 3, 1, F.lit("reference price")),
    )
    grid = V.table(spark, sf_dir, "supplier").select(F.concat(F.lit("f"), k.cast("string")).alias("file"), F.lit("s").alias("sheet"), F.inline(cells)).where(~((F.col("row_no") > k % 5 + 1) & (k % 3 == 0)))
    heads = X.header_with(grid, ["reference", "price"])
    headings = grid.join(heads, ["file", "sheet"]).where("row_no = header_row")
    files = grid.select("file", "sheet").distinct().join(heads, ["file", "sheet"], "left").join(X.column_of(headings, "price"), ["file", "sheet"], "left")
    return files.select("file", F.coalesce("header_row", F.lit(0)).alias("header_row"), F.col("col_no").alias("price_col"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 < 2 AND l_partkey BETWEEN 2 AND 500 THEN CAST(l_partkey AS INT) END AS lot FROM lineitem")
def lots_of_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lot sizes that labels give (EX21)."""
    n, k = F.col("l_partkey").cast("string"), F.col("l_orderkey")
    label = F.when(k % 3 == 0, F.concat(F.lit("soap, lot of "), n)).when(k % 3 == 1, F.concat(F.lit("Pack "), n, F.lit(" rolls"))).otherwise(F.concat(n, F.lit(" pieces")))
    return V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", X.lot_of_label(label).alias("lot"))


@query(f"WITH {ITEMS} SELECT family, count(*) AS n_items FROM items WHERE ({_REASON}) IS NULL GROUP BY 1")
def scope_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that the rules keep (SP4)."""
    return S.kept(V.items(spark, sf_dir), S.Rules(types=("PROMO", "ECONOMY"), families=("Brand#11", "Brand#23"))).groupBy("family").agg(F.count(F.lit(1)).alias("n_items"))


@query(f"WITH {ITEMS} SELECT 'v1' AS version, count(*) AS n_items, true AS stable FROM items WHERE ({_REASON}) IS NULL")
def scope_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest line of a population; its fingerprint doesn't depend on the order of rows (SP11 to SP13)."""
    rows = scope_items(spark, sf_dir).where("in_scope")
    again = S.summary_line(rows.orderBy(F.desc("item_code")), "v1").select(F.col("fingerprint").alias("_again"))
    return S.summary_line(rows, "v1").join(again, F.col("fingerprint") == F.col("_again"), "left").select("version", "n_items", F.col("_again").isNotNull().alias("stable"))


@query(f"WITH {ITEMS} SELECT supplier, count(*) AS n_items FROM items WHERE CAST(substr(supplier, 2) AS INT) % 3 = 0 AND CAST(substr(supplier, 2) AS INT) IN (SELECT s_suppkey FROM supplier) GROUP BY 1")
def items_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of suppliers whose names are written in other ways (SP15)."""
    names = V.table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.concat(F.lit(" s"), F.col("s_suppkey").cast("string"), F.lit("-")).alias("supplier"))
    return S.of_supplier(V.items(spark, sf_dir), names).groupBy("supplier").agg(F.count(F.lit(1)).alias("n_items"))


@query(f"WITH {ITEMS}, {OFFERS}, cur AS (SELECT part, arg_min(price, ordinal) FILTER (WHERE ordinal = 1) AS p FROM offers GROUP BY 1) SELECT i.item_code, c.p AS current_price FROM items i LEFT JOIN (SELECT part, max(CASE WHEN ordinal = 1 THEN price END) AS p FROM offers GROUP BY 1) c ON c.part = i.item_code")
def current_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their current price over codes written in two ways (SP22, J7)."""
    prices = V.offers(spark, sf_dir).select(F.concat(F.lit(" "), "part", F.when(F.col("k") % 2 == 0, ".0").otherwise(" ")).alias("item_code"), "price", "ordinal")
    return S.with_current_price(V.items(spark, sf_dir), prices).select("item_code", "current_price")


@query(
    f"""WITH {_CHOSEN} SELECT item_code, false AS verify FROM chosen WHERE k % 3 = 0 AND coalesce(length(ref) >= 9, false) AND (coalesce(ref_origin, 'supplier') <> 'manufacturer' OR regexp_full_match(ref, '[0-9]+'))
 UNION ALL SELECT item_code, true FROM chosen WHERE k % 5 <> 0 AND k % 2 = 0 AND coalesce(length(ref), 0) < 9"""
)
def codes_to_work_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose code is to be searched, and usable codes to verify (SP23 to SP25)."""
    k = F.col("k")
    rows = chosen_references(spark, sf_dir).withColumns({"gtin": F.when(k % 3 != 0, "x"), "active": k % 2 == 0, "usable": k % 5 != 0, "source": F.when(k % 2 == 0, "registry")})
    return S.to_query(rows).select("item_code", F.lit(False).alias("verify")).unionAll(S.to_verify(rows).select("item_code", F.lit(True).alias("verify")))


@query(f"WITH {ITEMS} SELECT i.item_code, s.stock, a.active FROM items i LEFT JOIN (SELECT l_partkey AS k, max(l_quantity) AS stock FROM lineitem WHERE l_partkey % 3 <> 0 GROUP BY 1) s USING (k) LEFT JOIN (SELECT l_partkey AS k, min(l_returnflag) AS active FROM lineitem WHERE l_partkey % 4 <> 0 GROUP BY 1) a USING (k)")
def stocked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with stock and activity (SP26)."""
    line, code = V.table(spark, sf_dir, "lineitem"), F.col("l_partkey").cast("string").alias("item_code")
    stock = line.where("l_partkey % 3 <> 0").select(code, F.col("l_quantity").alias("stock"))
    return S.with_stock(V.items(spark, sf_dir), stock, line.where("l_partkey % 4 <> 0").select(code, F.col("l_returnflag").alias("active"))).select("item_code", "stock", "active")


@query(
    f"""WITH names AS (SELECT DISTINCT p_name AS supplier FROM part), n AS (SELECT supplier, unnest({_TELLING.replace("{w}", _words("supplier"))}) AS w FROM names), d AS (SELECT p_partkey AS k, unnest({_TELLING.replace("{w}", _words("p_name || ' GmbH'"))}) AS w FROM part WHERE p_partkey % 7 = 0)
 SELECT supplier, 'M' || CAST(min(k) AS VARCHAR) AS manufacturer_id, bool_or(list_contains({_words("supplier")}, 'RING')) AS with_ring FROM n JOIN d USING (w) GROUP BY 1"""
)
def manufacturers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered manufacturer of each name, and names that share a telling word with another (MT28 to MT30)."""
    part = V.table(spark, sf_dir, "part")
    devices = part.where("p_partkey % 7 = 0").select(F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("manufacturer_id"), F.concat("p_name", F.lit(" GmbH")).alias("manufacturer_name"), F.col("p_partkey").alias("ordinal"))
    found = M.manufacturer_of(part.select(F.col("p_name").alias("supplier")).distinct(), devices)
    return found.withColumn("with_ring", F.coalesce(L.same_company(F.col("supplier"), F.lit("Ring Group")), F.lit(False)))


_DEVICES = "devices AS (SELECT p_partkey AS ordinal, 'AB-' || lpad(CAST(p_partkey % 500 AS VARCHAR), 5, '0') || '/x' || CAST(p_partkey % 37 + 1000 AS VARCHAR) AS reference, 'G' || CAST(p_partkey AS VARCHAR) AS gtin FROM part)"


@query(f"WITH {_DEVICES} SELECT piece, arg_min(gtin, ordinal) AS gtin FROM (SELECT *, unnest(list_filter(string_split_regex(upper(reference), '[^A-Z0-9]+'), lambda p: length(p) >= 4)) AS piece FROM devices) GROUP BY 1")
def registry_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First device of each piece of a reference (MT31)."""
    k = F.col("p_partkey")
    reference = F.concat(F.lit("AB-"), F.lpad((k % 500).cast("string"), 5, "0"), F.lit("/x"), (k % 37 + 1000).cast("string"))
    return M.registry_index(V.table(spark, sf_dir, "part").select(k.alias("ordinal"), reference.alias("reference"), F.concat(F.lit("G"), k.cast("string")).alias("gtin"))).select("piece", "gtin")


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 1 THEN 'DELUXE' WHEN 2 THEN CASE WHEN p_name LIKE '%ring%' THEN NULL WHEN p_name LIKE '%new%' THEN 'SET' ELSE 'NEW SET' END END AS variant FROM part")
def commercial_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that only the other label has (MT36)."""
    k, name = F.col("p_partkey"), F.col("p_name")
    theirs = F.when(k % 3 == 0, name).when(k % 3 == 1, F.concat(F.lit("Deluxe "), name)).otherwise(F.concat(F.regexp_replace(name, "ring", "bolt"), F.lit(" set new")))
    return V.table(spark, sf_dir, "part").select("p_partkey", L.commercial_variant(name, theirs).alias("variant"))


@query("SELECT p_partkey, CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size WHEN p_partkey % 3 = 0 THEN 6 WHEN p_partkey % 5 = 0 THEN 12 ELSE 1 END AS DOUBLE) AS divisor, CASE WHEN p_partkey % 2 = 0 THEN 'label' WHEN p_partkey % 3 = 0 THEN 'item master' WHEN p_partkey % 5 = 0 THEN 'systematic' ELSE 'none' END AS source FROM part")
def divisor_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First divisor that is known (PK6)."""
    k = F.col("p_partkey")
    chosen = P.choose_divisor(F.when(k % 2 == 0, F.col("p_size")), F.when(k % 3 == 0, 6), F.when(k % 5 == 0, 12))
    return V.table(spark, sf_dir, "part").select("p_partkey", chosen.alias("d")).select("p_partkey", "d.*")


_SIGNALS = "sig AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) ELSE CAST(1 AS DOUBLE) / p_size END AS ratio FROM part)"


@query(f"WITH {_SIGNALS} SELECT p_partkey, CAST(coalesce({round_pack_sql('ratio')}, -{round_pack_sql('(CAST(1 AS DOUBLE) / ratio)')}) AS INT) AS signal_ratio, CASE WHEN p_size >= 2 THEN p_size END AS signal_offer FROM sig WHERE p_partkey % 5 <> 0 AND coalesce({round_pack_sql('ratio')}, -{round_pack_sql('(CAST(1 AS DOUBLE) / ratio)')}) IS NOT NULL")
def cases_to_settle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose ratio looks like a pack while no divisor was taken (PK11)."""
    k, n = F.col("p_partkey"), F.col("p_size")
    rows = V.table(spark, sf_dir, "part").select("p_partkey", F.when(k % 2 == 0, n.cast("double")).otherwise(1 / n).alias("ratio"), F.concat(F.lit("box of "), n.cast("string")).alias("offer_label"), F.lit("soap").alias("item_label"), F.when(k % 5 == 0, 2.0).alias("divisor"))
    return O.to_settle(rows).select("p_partkey", "signal_ratio", "signal_offer")


@query(f"WITH {READ_CODES} SELECT DISTINCT item_code, gtin FROM readings WHERE ordinal % 3 <> 0 AND NOT (source = 'registry' AND length('REF' || item_code) < 9)")
def reliable_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sure links from item to code that don't rest on a short reference (PK19)."""
    made = None
    for name, rows in V.readings(spark, sf_dir).items():
        own = rows.where("gtin is not null").select("item_code", "gtin", F.when(F.col("ordinal") % 3 != 0, "sure").otherwise("probable").alias("confidence"), F.lit(name).alias("source"), F.concat(F.lit("REF"), "item_code").alias("ref"))
        made = own if made is None else made.unionAll(own)
    return O.reliable_links(made)


@query(f"WITH {READINGS} SELECT item_code, supplier, owner_price, false AS with_ours FROM classed WHERE price_class = 'ONLY_OWNER'")
def class_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one class without the columns that none fills (RC6)."""
    own = R.view(_reconciled(spark, sf_dir), "ONLY_OWNER")
    return own.select("item_code", "supplier", "owner_price", F.lit("our_price" in own.columns).alias("with_ours"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_code, round(CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE p_retailprice * 2 END, 4) AS price, CASE WHEN p_partkey % 3 = 0 THEN 'consolidation' ELSE 'supplier list' END AS origin FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 <> 0")
def price_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One positive price for each item, consolidation first (MG1)."""
    k, p = F.col("p_partkey"), F.col("p_retailprice")
    head = [k.cast("string").alias("item_code"), k.alias("ordinal")]
    part = V.table(spark, sf_dir, "part")
    consolidated = part.select(*head, F.when(k % 3 == 0, p).otherwise(0.0).alias("price"))
    lists = part.where("p_partkey % 5 <> 0").select(*head, (p * 2).alias("price")).unionAll(part.select(*head, F.lit(-1.0)))
    return R.proposals(consolidated, lists).select("item_code", "price", "origin")


@query("SELECT 'maker ' || split_part(p_name, ' ', 1) AS supplier, min('list of ' || CASE WHEN p_name LIKE 'red %' THEN 'house' ELSE split_part(p_name, ' ', 1) END) AS list_name FROM part GROUP BY 1")
def supplier_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price list of each supplier, by its alias or by telling words."""
    first = F.split("p_name", " ")[0]
    part = V.table(spark, sf_dir, "part")
    lists = part.select(F.concat(F.lit("list of "), F.when(first == "red", "house").otherwise(first)).alias("list_name"))
    aliases = part.where(first == "red").select(F.concat(F.lit("maker "), first).alias("supplier"), F.lit("House Inc").alias("alias")).distinct()
    return O.list_of_supplier(part.select(F.concat(F.lit("maker "), first).alias("supplier")), lists, aliases).select("supplier", "list_name")


@query("SELECT s_suppkey AS code, s_name AS name, s_acctbal AS balance FROM supplier")
def resolved_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by any of their names (SC47, IO11, IO12)."""
    return readers.resolved(V.table(spark, sf_dir, "supplier"), {"code": ["key", "S_SUPPKEY"], "name": ["s_name"], "balance": ["s_acctbal", "s_name"]})


@query(
    f"""WITH {ITEMS}, {_ORDERS}, keyed AS (SELECT h.*, CASE WHEN i.k % 6 <> 0 THEN i.internal_ref END AS internal_ref FROM hist h JOIN items i USING (item_code)), last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY internal_ref ORDER BY order_date DESC NULLS LAST, ordinal DESC, supplier) AS rn FROM keyed) WHERE rn = 1)
 SELECT i.item_code, l.supplier AS ordered_from, l.order_date AS ordered_on FROM items i LEFT JOIN last l ON l.internal_ref = CASE WHEN i.k % 6 <> 0 THEN i.internal_ref END"""
)
def internal_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the last order of their internal reference; missing references get none."""
    items = V.items(spark, sf_dir).withColumn("internal_ref", F.when(F.col("k") % 6 != 0, F.col("internal_ref")))
    orders = order_history(spark, sf_dir).join(items.select("item_code", "internal_ref"), "item_code")
    return S.ordered_by_internal(items, orders).select("item_code", "ordered_from", "ordered_on")


@query("SELECT e.event_id, m.nature FROM events e LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS nature FROM events WHERE value > 100 GROUP BY 1) m USING (user_id)")
def last_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup whose last row of a key counts."""
    ev = V.table(spark, sf_dir, "events")
    return S.mapped(ev.select("event_id", "user_id"), ev.where("value > 100").select("user_id", F.col("event_type").alias("nature"), F.col("event_id").alias("at")), "user_id", "nature", "at").select("event_id", "nature")


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_code, 'G' || CAST(s_suppkey AS VARCHAR) AS gtin FROM part JOIN supplier ON p_partkey % 150 = s_suppkey")
def fanned_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry results for every item that shares the reference."""
    items = V.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("item_code"), F.concat(F.lit("ref "), (F.col("p_partkey") % 150).cast("string")).alias("supplier_ref"))
    results = V.table(spark, sf_dir, "supplier").select(F.concat(F.lit(" REF"), F.col("s_suppkey").cast("string")).alias("ref"), F.concat(F.lit("G"), F.col("s_suppkey").cast("string")).alias("gtin"))
    return O.fanned_out(results, items).select("item_code", "gtin")


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_code, d.decision, CAST(d.sheet AS INT) AS sheet_rank FROM part LEFT JOIN (SELECT l_partkey, arg_min('line ' || CAST(l_orderkey AS VARCHAR), (l_linenumber, l_orderkey, 'line ' || CAST(l_orderkey AS VARCHAR))) AS decision, min(l_linenumber) AS sheet FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) d ON p_partkey = l_partkey")
def annotated_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with the first decision over all sheets (CL6, J16)."""
    notes = V.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("item_code"), F.when(F.col("l_returnflag") != "N", F.concat(F.lit("line "), F.col("l_orderkey").cast("string"))).alias("decision"), F.col("l_linenumber").cast("int").alias("sheet_rank"), F.col("l_orderkey").alias("ordinal"))
    return R.with_annotations(V.items(spark, sf_dir).select("item_code"), notes)


@query(f"WITH {ITEMS} SELECT item_code, upper(regexp_replace(coalesce(supplier_ref, manufacturer_ref), '\\.0$', '')) AS key, old_price AS price FROM items WHERE old_price > 0 AND k % 4 <> 0")
def owner_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the item master for items that the price owner has validated."""
    items = V.items(spark, sf_dir)
    owner = items.select(F.concat("item_code", F.lit(".0")).alias("item_code"), F.when(F.col("k") % 4 != 0, F.col("old_price")).otherwise(0.0).alias("price"), F.col("k").alias("ordinal"))
    return O.owner_bridge(items, owner)


@query(f"WITH {ITEMS} SELECT item_code, coalesce(supplier, CASE WHEN k % 2 = 0 THEN family END) AS supplier, CASE WHEN supplier IS NOT NULL THEN 'supplier' WHEN k % 2 = 0 THEN 'manufacturer' END AS supplier_origin FROM items")
def makers_as_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without supplier under the manufacturer's name (CL5, CL7)."""
    items = V.items(spark, sf_dir).withColumn("manufacturer", F.when(F.col("k") % 2 == 0, F.col("family")))
    return R.in_columns(R.with_makers(items), ["item_code", "supplier", "supplier_origin"])


@query("SELECT p_partkey, p_partkey % 3 = 0 OR p_partkey % 4 = 0 AS tiers_wrong, p_partkey % 5 > 1 AS has_code FROM part")
def quality_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose tiers contradict themselves and rows with a code (DQ3, DQ6)."""
    k, p = F.col("p_partkey"), F.col("p_retailprice")
    rows = V.table(spark, sf_dir, "part").select("p_partkey", p.alias("unit_cost"), F.lit(6).alias("tier2_qty"), (p * F.when(k % 3 == 0, 1.5).otherwise(0.9)).alias("tier2_cost"), F.when(k % 4 == 0, 5).when(k % 7 != 0, 12).alias("tier3_qty"), F.when(k % 7 != 0, p * 0.8).alias("tier3_cost"), F.when(k % 5 == 0, " ").when(k % 5 > 1, "4006381333931").alias("gtin_unit"))
    return rows.select("p_partkey", Q.tiers_wrong(rows).alias("tiers_wrong"), Q._filled("gtin_unit").alias("has_code"))
