"""The driver's tables under the names of this library, once for Spark and once as SQL for the oracle (one formula each)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions.gtin import expected_digit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad(k: Column, n: int) -> Column:
    return F.lpad(k.cast("string"), n, "0")


def _code(k: Column) -> Column:
    body = F.concat(F.lit("376"), _pad(k, 9))
    return F.concat(body, expected_digit(F.concat(body, F.lit("0"))).cast("string"))


def gtins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_code, good (clean code), gtin (damaged by key % 8)."""
    k = F.col("p_partkey")
    d = table(spark, sf_dir, "part").select(k.cast("string").alias("item_code"), k.alias("k"), _code(k).alias("good"), _code(F.greatest(k - 1, F.lit(0))).alias("before"))
    m = F.col("k") % 8
    wrong = F.concat(F.substring("good", 1, 12), ((F.substring("good", 13, 1).cast("int") + 1) % 10).cast("string"))
    damaged = (
        F.when(m == 1, wrong)
        .when(m == 2, F.concat(F.lit("0"), "good"))
        .when(m == 3, F.concat(F.lit("1"), "good"))
        .when(m == 4, F.concat(F.lit("AB"), "good"))
        .when(m == 5, "0000000000000")
        .when(m == 6, None)
        .when(m == 7, F.col("before"))
        .otherwise(F.col("good"))
    )
    return d.select("item_code", "k", "good", damaged.alias("gtin"))


_DIGIT = "CAST((10 - list_sum([CAST(substr({b}, i, 1) AS INT) * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END for i in range(1, 13)]) % 10) % 10 AS VARCHAR)"
_BODY = "'376' || lpad(CAST({k} AS VARCHAR), 9, '0')"
_GOOD = "(" + _BODY + ") || " + _DIGIT.replace("{b}", "(" + _BODY + ")")
GTINS = f"""gtins0 AS (SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_partkey AS k, {_GOOD.replace("{k}", "p_partkey")} AS good, {_GOOD.replace("{k}", "greatest(p_partkey - 1, 0)")} AS before FROM part),
gtins AS (SELECT item_code, k, good, CASE k % 8 WHEN 1 THEN substr(good, 1, 12) || CAST((CAST(substr(good, 13, 1) AS INT) + 1) % 10 AS VARCHAR) WHEN 2 THEN '0' || good WHEN 3 THEN '1' || good
 WHEN 4 THEN 'AB' || good WHEN 5 THEN '0000000000000' WHEN 6 THEN NULL WHEN 7 THEN before ELSE good END AS gtin FROM gtins0)"""
#: Whether column g is a valid unit code.
VALID = "(coalesce(regexp_full_match({g}, '[0-9]{{13}}'), false) AND {g} <> '0000000000000' AND substr({g}, 13, 1) = " + _DIGIT.replace("{b}", "lpad(coalesce({g}, '0'), 13, '0')").replace("CAST(substr(", "TRY_CAST(substr(") + ")"


def valid_sql(g: str) -> str:
    return VALID.replace("{{", "{").replace("}}", "}").replace("{g}", g)


def item_refs(k: Column) -> Column:
    pad = _pad(k, 6)
    dotted = F.when(k % 7 == 0, F.concat(F.substring(pad, 1, 3), F.lit("."), F.substring(pad, 4, 3))).otherwise(pad)
    return F.when(k % 17 != 0, F.concat(F.lit("PK-"), dotted, F.when(k % 13 == 0, ".0").otherwise("")))


_REF = "CASE WHEN p_partkey % 17 <> 0 THEN 'PK-' || CASE WHEN p_partkey % 7 = 0 THEN substr(lpad(CAST(p_partkey AS VARCHAR), 6, '0'), 1, 3) || '.' || substr(lpad(CAST(p_partkey AS VARCHAR), 6, '0'), 4, 3) ELSE lpad(CAST(p_partkey AS VARCHAR), 6, '0') END || CASE WHEN p_partkey % 13 = 0 THEN '.0' ELSE '' END END"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.cast("string").alias("item_code"),
        k.alias("k"),
        F.concat(F.lit("R"), (k - F.when(k % 40 == 1, 1).otherwise(0)).cast("string")).alias("internal_ref"),
        F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("label"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("family"),
        F.when(k % 9 != 0, F.concat(F.lit("S"), (k % 100).cast("string"))).alias("supplier"),
        item_refs(k).alias("supplier_ref"),
        F.concat(F.lit("MF"), _pad(k, 6)).alias("manufacturer_ref"),
        F.when(k % 11 != 0, F.col("p_retailprice")).alias("old_price"),
    )


ITEMS = f"""items AS (SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_partkey AS k, 'R' || CAST(p_partkey - CASE WHEN p_partkey % 40 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS internal_ref,
 p_name || ' ' || CAST(p_size AS VARCHAR) AS label, p_type AS type, p_brand AS family, CASE WHEN p_partkey % 9 <> 0 THEN 'S' || CAST(p_partkey % 100 AS VARCHAR) END AS supplier,
 {_REF} AS supplier_ref, 'MF' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS manufacturer_ref, CASE WHEN p_partkey % 11 <> 0 THEN p_retailprice END AS old_price FROM part)"""

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers of each part in a fixed order; some have the maker's reference, some no price."""
    k = F.col("l_partkey")
    ordinal = F.row_number().over(Window.partitionBy("l_partkey").orderBy(*LINE))
    ref = F.when(k % 5 == 0, F.concat(F.lit("MF"), _pad(k, 6))).when(k % 3 == 0, F.concat(F.lit("pk "), _pad(k, 6))).otherwise(F.concat(F.lit("PK-"), _pad(k, 6)))
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("ordinal", ordinal.cast("long"))
        .select(
            k.cast("string").alias("part"),
            k.alias("k"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("supplier"),
            ref.alias("supplier_ref"),
            _code(k).alias("gtin"),
            F.concat(F.lit("offer "), k.cast("string")).alias("label"),
            F.when((k % 23 != 0) | (F.col("ordinal") > 1), F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("l_quantity").alias("qty"),
            F.lit(1.0).alias("pack"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("vat"),
            "ordinal",
        )
    )


OFFERS = f"""offers0 AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {", ".join(LINE)}) AS ordinal FROM lineitem),
offers AS (SELECT CAST(l_partkey AS VARCHAR) AS part, l_partkey AS k, 'S' || CAST(l_suppkey AS VARCHAR) AS supplier,
 CASE WHEN l_partkey % 5 = 0 THEN 'MF' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') WHEN l_partkey % 3 = 0 THEN 'pk ' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') ELSE 'PK-' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') END AS supplier_ref,
 CASE WHEN l_partkey % 23 <> 0 OR ordinal > 1 THEN l_extendedprice / l_quantity END AS price, l_quantity AS qty, l_discount AS discount, l_tax AS vat, ordinal FROM offers0)"""


def owner_and_ours(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scope, the owner's reading and ours: lowest unit price of (part, supplier), disturbed by key."""
    k, p = F.col("l_partkey"), F.col("p")
    base = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.min(F.col("l_extendedprice") / F.col("l_quantity")).alias("p"))
    supplier = F.when(k % 10 != 0, F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("supplier")
    head = [k.cast("string").alias("item_code"), F.lit("1").alias("variant"), supplier]
    tier = F.when(k % 3 == 0, 1.0).when(k % 3 == 1, None).otherwise(6.0)
    origin = F.when(k % 4 == 0, "supplier list 2024").when(k % 4 == 1, "internal file")
    owner = base.where(k % 6 != 5).select(*head, p.alias("owner_price"), tier.alias("tier"), origin.alias("origin"))
    ours = base.where(k % 6 != 4).select(*head, F.when(k % 6 == 1, p * 1.0002).when(k % 6 == 2, p * 2).when(k % 6 == 3, p * 1.1).otherwise(p).alias("our_price"), F.lit(None).cast("double").alias("tier"))
    # A null supplier stands for several, so one row of each item stays.
    once = lambda d, c: d.groupBy("item_code", "variant", "supplier").agg(F.min(c).alias(c), *[F.min(x).alias(x) for x in d.columns if x not in ("item_code", "variant", "supplier", c)])
    scope = table(spark, sf_dir, "part").where(F.col("p_partkey") % 13 != 0).select(F.col("p_partkey").cast("string").alias("item_code"), F.lit("1").alias("variant"))
    return scope, once(owner, "owner_price"), once(ours, "our_price")


READINGS = """prices AS (SELECT l_partkey AS k, l_suppkey AS s, min(l_extendedprice / l_quantity) AS p FROM lineitem GROUP BY 1, 2),
owner AS (SELECT CAST(k AS VARCHAR) AS item_code, CASE WHEN k % 10 <> 0 THEN 'S' || CAST(s AS VARCHAR) END AS supplier, min(p) AS owner_price, min(CASE k % 3 WHEN 0 THEN 1.0 WHEN 2 THEN 6.0 END) AS tier,
 min(CASE k % 4 WHEN 0 THEN 'supplier list 2024' WHEN 1 THEN 'internal file' END) AS origin FROM prices WHERE k % 6 <> 5 AND k % 13 <> 0 GROUP BY 1, 2),
ours AS (SELECT CAST(k AS VARCHAR) AS item_code, CASE WHEN k % 10 <> 0 THEN 'S' || CAST(s AS VARCHAR) END AS supplier, min(CASE k % 6 WHEN 1 THEN p * CAST(1.0002 AS DOUBLE) WHEN 2 THEN p * 2 WHEN 3 THEN p * CAST(1.1 AS DOUBLE) ELSE p END) AS our_price FROM prices WHERE k % 6 <> 4 AND k % 13 <> 0 GROUP BY 1, 2),
joined AS (SELECT coalesce(o.item_code, u.item_code) AS item_code, CASE WHEN o.item_code IS NOT NULL THEN o.supplier ELSE u.supplier END AS supplier, o.owner_price, u.our_price, o.origin,
 CASE WHEN o.item_code IS NOT NULL THEN coalesce(o.tier, 1) = 1 END AS comparable FROM owner o FULL OUTER JOIN ours u ON o.item_code = u.item_code AND o.supplier IS NOT DISTINCT FROM u.supplier),
classed AS (SELECT *, CASE WHEN owner_price IS NOT NULL AND our_price IS NOT NULL AND NOT coalesce(comparable, true) THEN 'NOT_COMPARABLE'
 WHEN abs(owner_price - our_price) <= greatest(0.005, 0.0005 * abs(our_price)) THEN 'AGREE' WHEN owner_price IS NOT NULL AND our_price IS NOT NULL THEN 'DIVERGE'
 WHEN owner_price IS NOT NULL THEN 'ONLY_OWNER' WHEN our_price IS NOT NULL THEN 'ONLY_OURS' ELSE 'NO_PRICE' END AS price_class, CASE WHEN owner_price > 0 THEN our_price / owner_price END AS ratio FROM joined)"""


def readings(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Barcode readings of several sources from events: item = event_id % parts."""
    parts = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n"))
    names = ("label", "price list", "registry", "supplier", "warehouse")
    kinds = table(spark, sf_dir, "events").select("event_type").distinct().withColumn("_i", F.row_number().over(Window.orderBy("event_type")))
    ev = table(spark, sf_dir, "events").join(F.broadcast(kinds), "event_type").crossJoin(F.broadcast(parts))
    source = F.element_at(F.array(*[F.lit(n) for n in names]), F.least(F.col("_i"), F.lit(5)))
    codes = gtins(spark, sf_dir).select("item_code", F.col("gtin"))
    rows = ev.select((F.col("event_id") % F.col("n")).cast("string").alias("item_code"), source.alias("source"), F.col("event_id").alias("ordinal"), (F.col("value") / 500).alias("score")).join(codes, "item_code")
    rows = rows.withColumn("gtin", F.when(F.col("ordinal") % 19 == 0, "4006381333931").otherwise(F.col("gtin")))
    return {n: rows.where(F.col("source") == n).drop("source") for n in names}


READ_CODES = f"""{GTINS},
kinds AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS i FROM (SELECT DISTINCT event_type FROM events)),
readings AS (SELECT item_code, source, CASE WHEN ordinal % 19 = 0 THEN '4006381333931' ELSE gtin END AS gtin, ordinal, score FROM
 (SELECT CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) AS item_code, ['label', 'price list', 'registry', 'supplier', 'warehouse'][least(i, 5)] AS source, event_id AS ordinal, value / 500 AS score FROM events JOIN kinds USING (event_type)) JOIN gtins USING (item_code)
 WHERE CASE WHEN ordinal % 19 = 0 THEN '4006381333931' ELSE gtin END IS NOT NULL)"""
