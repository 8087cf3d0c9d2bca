"""Queries of the barcode and label side over the driver's tables, each with the SQL it is held against where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions import gtin as G
from tallyforge.functions import labels as L
from tallyforge.functions import text as T
from tallyforge.operators import extract as X
from tallyforge.operators import matching as M
from tallyforge.operators import register as R
from tallyforge.operators import relational as rel
from tallyforge.plans import views as V
from tallyforge.plans.price_queries import query as _query
from tallyforge.plans.price_queries import round_pack_sql
from tallyforge.plans.views import GTINS, ITEMS, READ_CODES
from tallyforge.sources import readers
from tallyforge.streaming import collectors

query = _query
_V = V.valid_sql


@query(
    f"""WITH {GTINS}, c AS (SELECT *, CASE WHEN regexp_full_match(gtin, '0[0-9]{{13}}') AND {_V("substr(gtin, 2, 13)")} THEN substr(gtin, 2, 13) ELSE regexp_replace(gtin, '[^0-9]', '', 'g') END AS cleaned FROM gtins)
 SELECT item_code, gtin, cleaned, coalesce({_V("gtin")}, false) AS valid, CASE WHEN regexp_matches(gtin, '^[0-9]{{13}}$') THEN gtin WHEN regexp_matches(gtin, '^0[0-9]{{13}}$') THEN substr(gtin, 2, 13) END AS unit,
 CASE WHEN gtin IS NULL THEN 'no code' WHEN NOT regexp_full_match(gtin, '[0-9]+') THEN 'not numeric' WHEN length(gtin) <> 13 THEN 'length ' || CAST(length(gtin) AS VARCHAR) WHEN NOT {_V("gtin")} THEN 'wrong check digit' ELSE '' END AS fault FROM c"""
)
def gtin_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.col("gtin")
    return V.gtins(spark, sf_dir).select("item_code", "gtin", G.clean_gtin(g).alias("cleaned"), G.valid_unit(g).alias("valid"), G.unit_of_gtin(g).alias("unit"), G.structure_fault(g).alias("fault"))


@query(
    f"""WITH {GTINS} SELECT item_code, '0' || good AS ai_01, good AS unit, '24' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0') || CASE WHEN k % 3 = 0 THEN '00' ELSE '15' END AS ai_17, 'L' || item_code AS ai_10,
 CASE WHEN k % 3 = 0 THEN CAST(last_day(make_date(2024, CAST(k % 12 + 1 AS INT), 1)) AS DATE) ELSE make_date(2024, CAST(k % 12 + 1 AS INT), 15) END AS expires FROM gtins"""
)
def gs1_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even items have the spelled form, odd ones the raw form."""
    k = F.col("k")
    day = F.concat(F.lit("24"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.when(k % 3 == 0, "00").otherwise("15"))
    spelled = F.concat(F.lit("(01)0"), "good", F.lit("(17)"), day, F.lit("(10)L"), "item_code")
    raw = F.concat(F.lit("]C1010"), "good", F.lit("17"), day, F.lit("10L"), "item_code", F.lit(G.SEPARATOR))
    e = V.gtins(spark, sf_dir).select("item_code", G.gs1_elements(F.when(k % 2 == 0, spelled).otherwise(raw)).alias("e"))
    at = lambda ai: F.element_at("e", F.lit(ai))
    return e.select("item_code", at("01").alias("ai_01"), G.gs1_unit(F.col("e")).alias("unit"), at("17").alias("ai_17"), at("10").alias("ai_10"), G.gs1_date(at("17")).alias("expires"))


_SOURCES = "[" + ", ".join(f"'{s}'" for s in R.SOURCES) + "]"
_BEST = READ_CODES + f", best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_code ORDER BY list_position({_SOURCES}, source), ordinal, gtin) AS rn FROM readings WHERE {_V('gtin')}) WHERE rn = 1)"
_CONF = "CASE WHEN source IN ('warehouse', 'supplier', 'price list', 'reference is code', 'registry') THEN 'sure' WHEN source = 'label' AND (score IS NULL OR score >= 0.8) THEN 'probable' WHEN source IS NOT NULL THEN 'to verify' END"


def registered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = V.items(spark, sf_dir).select("item_code", "k", "label", "supplier_ref", F.col("family").alias("supplier"))
    reads = R.gathered(V.readings(spark, sf_dir))
    return R.register(items, reads), reads


@query(f"WITH {_BEST} SELECT CAST(p_partkey AS VARCHAR) AS item_code, gtin, source, {_CONF} AS confidence FROM part LEFT JOIN best ON item_code = CAST(p_partkey AS VARCHAR)")
def register_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registered(spark, sf_dir)[0].select("item_code", "gtin", "source", "confidence")


@query(f"WITH {_BEST} SELECT source, {_CONF} AS confidence, count(*) AS n_items FROM part LEFT JOIN best ON item_code = CAST(p_partkey AS VARCHAR) GROUP BY 1, 2")
def register_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.coverage(registered(spark, sf_dir)[0])


_REG = _BEST + ", reg AS (SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_brand AS supplier, gtin, source, substr(gtin, 1, 6) AS prefix FROM part LEFT JOIN best ON item_code = CAST(p_partkey AS VARCHAR))"


@query(
    f"""WITH {_REG}, trusted AS (SELECT DISTINCT supplier, prefix FROM reg WHERE source IN ('price list', 'supplier', 'warehouse') AND prefix IS NOT NULL),
 k AS (SELECT r.*, r.prefix IS NOT NULL AND r.supplier IN (SELECT supplier FROM trusted) AS testable, t.prefix IS NOT NULL AS agrees FROM reg r LEFT JOIN trusted t ON r.supplier = t.supplier AND r.prefix = t.prefix)
 SELECT supplier, source, count(*) AS n_batch, count(*) FILTER (WHERE agrees) AS n_agree FROM k WHERE testable GROUP BY 1, 2"""
)
def control_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.batches(registered(spark, sf_dir)[0]).where("testable")
    return rows.groupBy("supplier", "source").agg(F.count(F.lit(1)).alias("n_batch"), F.count_if("agrees").alias("n_agree"))


@query(
    f"""WITH {_REG}, g AS (SELECT gtin, count(DISTINCT item_code) AS n FROM reg WHERE gtin IS NOT NULL GROUP BY 1), x AS (SELECT DISTINCT reg.item_code FROM reg JOIN readings r ON reg.item_code = r.item_code WHERE r.source <> reg.source AND r.gtin <> reg.gtin)
 SELECT reg.item_code, coalesce(n > 1, false) AS shared, x.item_code IS NOT NULL AS crossed FROM reg LEFT JOIN g USING (gtin) LEFT JOIN x ON x.item_code = reg.item_code"""
)
def control_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = R.controlled(*registered(spark, sf_dir))
    return done.select("item_code", (F.col("level1") != "").alias("shared"), (F.col("level3") != "").alias("crossed"))


@query(f"WITH {GTINS} SELECT gtin, count(DISTINCT item_code) AS n_items FROM gtins WHERE gtin IS NOT NULL GROUP BY 1 HAVING count(DISTINCT item_code) > 1")
def shared_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.gtins(spark, sf_dir).select("item_code", "gtin")
    return R.duplicates(rows).groupBy("gtin").agg(F.count_distinct("item_code").alias("n_items"))


_W = "list_filter(string_split(trim(regexp_replace(upper({c}), '[^A-Z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
_BASE = f"nullif(array_to_string(list_filter({_W.replace('{c}', 'label')}, lambda w: NOT list_contains({list(L.DEFAULT.discriminant + L.DEFAULT.letters)}, w) AND NOT regexp_full_match(w, 'T?[0-9]+')), ' '), '')"


def _shared_sql(rows: str) -> str:
    """Two relations over ``rows`` (item_code, label, supplier_ref, house, gtin): the last one, shared, has a verdict for each code."""
    return f"""based AS (SELECT *, {_BASE} AS base, arg_min(label, item_code) OVER (PARTITION BY gtin) AS first FROM {rows} WHERE gtin IS NOT NULL),
 shared AS (SELECT *, CASE WHEN n_refs = 1 THEN 'duplicates' WHEN n_houses = 1 THEN 'same company' WHEN n_bases = 1 THEN 'one base label' WHEN likeness >= 0.55e0 THEN 'alike' ELSE 'ambiguous' END AS shared_verdict FROM
 (SELECT gtin, count(DISTINCT item_code) AS n_items, count(DISTINCT supplier_ref) AS n_refs, count(DISTINCT house) AS n_houses, count(DISTINCT base) AS n_bases,
 min(1 - levenshtein(upper(label), upper(first)) / CAST(greatest(length(label), length(first), 1) AS DOUBLE)) AS likeness FROM based GROUP BY 1) WHERE n_items > 1)"""


@query(f"WITH {GTINS}, {ITEMS}, rows AS (SELECT i.item_code, label, supplier_ref, CASE WHEN family IN ('Brand#11', 'Brand#12') THEN 'House' ELSE family END AS house, gtin FROM items i JOIN gtins g USING (item_code)), {_shared_sql('rows')} SELECT * FROM shared")
def shared_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.items(spark, sf_dir).select("item_code", "label", "supplier_ref", F.col("family").alias("supplier")).join(V.gtins(spark, sf_dir).select("item_code", "gtin"), "item_code")
    aliases = spark.createDataFrame([("Brand#11", "House"), ("Brand#12", "House")], "supplier string, alias string")
    return R.shared_verdicts(rows, aliases)


@query(
    f"""WITH {_BEST}, {ITEMS}, reg AS (SELECT i.item_code, i.k, i.label, i.supplier_ref, i.family AS house, gtin, source, {_CONF} AS confidence FROM items i LEFT JOIN best USING (item_code)), {_shared_sql('reg')},
 marks AS (SELECT gtin, shared_verdict, gtin IS NOT NULL AND shared_verdict IS DISTINCT FROM 'ambiguous' AS usable, CASE WHEN source = 'registry' AND k % 2 <> 0 THEN 'to verify' ELSE confidence END AS confidence FROM reg LEFT JOIN shared USING (gtin))
 SELECT count(*) AS n_items, count(gtin) AS n_codes, count(*) FILTER (WHERE usable) AS n_usable, count(DISTINCT gtin) AS n_distinct_codes, count(*) FILTER (WHERE usable AND confidence = 'sure') AS n_sure, count(*) FILTER (WHERE shared_verdict = 'ambiguous') AS n_ambiguous FROM marks"""
)
def register_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg, _ = registered(spark, sf_dir)
    aliases = spark.createDataFrame([], "supplier string, alias string")
    return R.notice(R.marked(reg, R.shared_verdicts(reg, aliases), reg.where("k % 2 = 0")))


@query(f"""SELECT item_code, array_to_string(list_sort(list_distinct(list_transform(list_filter({_W.replace("{c}", "label")}, lambda w: length(w) >= 3 AND NOT list_contains({list(L.DEFAULT.stop)}, w) AND NOT regexp_full_match(w, '[0-9]+')), lambda w: substr(w, 1, 5)))), ' ') AS words, array_to_string(list_sort(list_distinct(regexp_extract_all(label, '[0-9]+'))), ' ') AS numbers,
 array_to_string(list_sort(list_distinct(list_filter({_W.replace("{c}", "label")}, lambda w: list_contains({list(L.DEFAULT.discriminant)}, w)))), ' ') AS discriminants FROM (SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_name || ' ' || CAST(p_size AS VARCHAR) AS label FROM part)""")
def label_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("label")
    return V.items(spark, sf_dir).select("item_code", F.array_join(L.words(c), " ").alias("words"), F.array_join(L.numbers(c), " ").alias("numbers"), F.array_join(L.discriminants(c), " ").alias("discriminants"))


@query("SELECT w AS word, count(*) AS n_labels FROM (SELECT unnest(list_distinct(list_filter(string_split(trim(regexp_replace(upper(p_name), '[^A-Z0-9]+', ' ', 'g')), ' '), lambda x: x <> ''))) AS w FROM part) GROUP BY 1")
def word_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.word_frequencies(V.table(spark, sf_dir, "part").select(F.col("p_name").alias("label")))


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Items, and a catalogue of their labels with the words in another order and every tenth with another size."""
    part = V.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    items = part.select(k.cast("string").alias("item_code"), F.col("p_brand").alias("supplier"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string"), F.concat(F.lit("MODEL"), F.hex(k))).alias("label"), F.col("p_retailprice").alias("old_price"))
    other = F.concat_ws(" ", F.concat(F.lit("MODEL"), F.hex(k)), (F.col("p_size") + F.when(k % 10 == 0, 1).otherwise(0)).cast("string"), "p_name")
    catalogue = part.select(F.col("p_brand").alias("supplier"), other.alias("label"), F.concat(F.lit("C"), k.cast("string")).alias("gtin"), k.alias("ordinal"), (F.col("p_retailprice") * F.when(k % 4 == 0, 12).otherwise(1.1)).alias("price"))
    return items, catalogue


_LABELLED = f"""part2 AS (SELECT p_partkey AS k, p_brand AS supplier, p_name || ' ' || CAST(p_size AS VARCHAR) || ' MODEL' || hex(p_partkey) AS label, 'MODEL' || hex(p_partkey) || ' ' || CAST(p_size + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS VARCHAR) || ' ' || p_name AS c_label, p_retailprice AS price FROM part)"""


def _features_sql(label: str) -> str:
    words = _W.replace("{c}", label)
    return f"""list_sort(list_distinct(list_transform(list_filter({words}, lambda w: length(w) >= 3 AND NOT list_contains({list(L.DEFAULT.stop)}, w) AND NOT regexp_full_match(w, '[0-9]+')), lambda w: substr(w, 1, 5)))) AS words,
 list_distinct(list_transform(regexp_extract_all({label}, '[0-9]+'), lambda n: CAST(CAST(n AS BIGINT) AS VARCHAR))) AS numbers, list_sort(list_distinct(list_filter({words}, lambda w: list_contains({list(L.DEFAULT.discriminant)}, w)))) AS discriminants"""


@query(
    f"""WITH {_LABELLED}, i AS (SELECT k, supplier, {_features_sql("label")} FROM part2), c AS (SELECT k, supplier, c_label, {_features_sql("c_label")} FROM part2),
 met AS (SELECT i.k, c.k AS ordinal, c.c_label, len(list_intersect(i.words, c.words)) / CAST(len(i.words) AS DOUBLE) AS score FROM i JOIN c ON i.supplier = c.supplier WHERE len(i.words) >= 2 AND i.discriminants = c.discriminants AND (len(i.numbers) = 0 OR len(c.numbers) = 0 OR len(list_intersect(i.numbers, c.numbers)) > 0)),
 best AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, length(c_label), ordinal) AS rn FROM met WHERE score >= 0.6)
 SELECT CAST(k AS VARCHAR) AS item_code, c_label, CASE WHEN n_items = 1 THEN 'C' || CAST(ordinal AS VARCHAR) END AS gtin, score, n_items FROM (SELECT *, count(*) OVER (PARTITION BY ordinal) AS n_items FROM best WHERE rn = 1)"""
)
def label_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, catalogue = _labelled(spark, sf_dir)
    return M.without_shared(M.best_by_label(items, M.indexed(catalogue))).select("item_code", "c_label", "gtin", "score", "n_items")


#: Best candidate of each item by the likeness of models: the words but for numbers, stop words and discriminants. Both sides start
#: with the common words, so only their ends are compared character by character, in the bits of a long.
_MODEL = f"list_filter({_W}, lambda w: NOT list_contains({list(L.DEFAULT.stop + L.DEFAULT.discriminant)}, w) AND NOT regexp_full_match(w, '[0-9]+'))"
_BIT = "(CAST(1 AS BIGINT) << CAST(i - 1 AS BIGINT))"
_BEST_MODEL = f"""{_LABELLED}, i AS (SELECT k, supplier, list_distinct({_MODEL.replace("{c}", "label")}) AS model, {_features_sql("label")} FROM part2), c AS (SELECT k, supplier, c_label, list_distinct({_MODEL.replace("{c}", "c_label")}) AS model, {_features_sql("c_label")} FROM part2),
 met AS (SELECT i.k, c.k AS ordinal, c.c_label, array_to_string(list_sort(list_intersect(i.model, c.model)), ' ') AS common,
 array_to_string(list_sort(list_filter(i.model, lambda w: NOT list_contains(c.model, w))), ' ') AS a, array_to_string(list_sort(list_filter(c.model, lambda w: NOT list_contains(i.model, w))), ' ') AS b
 FROM i JOIN c ON i.supplier = c.supplier WHERE len(i.model) >= 2 AND i.discriminants = c.discriminants AND len(list_intersect(i.words, c.words)) > 0 AND (len(i.numbers) = 0 OR len(c.numbers) = 0 OR len(list_intersect(i.numbers, c.numbers)) > 0)),
 ends AS (SELECT *, CASE WHEN common = '' OR a = '' THEN a ELSE ' ' || a END AS ea, CASE WHEN common = '' OR b = '' THEN b ELSE ' ' || b END AS eb FROM met),
 grown AS (SELECT *, length(ea) - bit_count(list_reduce(string_split(eb, ''), lambda v, ch: ((v + (v & mask[ch])) | xor(v, v & mask[ch])) & ((CAST(1 AS BIGINT) << CAST(length(ea) AS BIGINT)) - 1), (CAST(1 AS BIGINT) << CAST(length(ea) AS BIGINT)) - 1)) AS tail
 FROM (SELECT *, map_from_entries([(ch, CAST(coalesce(list_sum([{_BIT} for i in range(1, length(ea) + 1) if substr(ea, i, 1) = ch]), 0) AS BIGINT)) for ch in list_distinct(string_split(eb, ''))]) AS mask FROM (SELECT DISTINCT ea, eb FROM ends WHERE ea <> '' AND eb <> ''))),
 scored AS (SELECT k, ordinal, c_label AS candidate, CASE WHEN common <> '' AND (ea = '' OR eb = '') THEN 100e0 ELSE greatest(200e0 * (length(common) + tail) / (2 * length(common) + length(ea) + length(eb)),
 CASE WHEN common <> '' THEN 200e0 * length(common) / (2 * length(common) + length(ea)) ELSE 0e0 END, CASE WHEN common <> '' THEN 200e0 * length(common) / (2 * length(common) + length(eb)) ELSE 0e0 END) END AS score FROM ends LEFT JOIN grown USING (ea, eb)),
 best AS (SELECT *, row_number() OVER w AS rn, coalesce(lead(score) OVER w, 0e0) AS second FROM scored WINDOW w AS (PARTITION BY k ORDER BY score DESC, candidate))"""


@query(
    f"""WITH {_BEST_MODEL}, told AS (SELECT p.c_label AS expected, b.candidate, b.score, coalesce(b.score >= t AND b.score - b.second >= 8, false) AS given, t AS threshold FROM part2 p LEFT JOIN best b ON b.k = p.k AND b.rn = 1, unnest([84e0, 88e0, 92e0]) AS u(t)),
 n AS (SELECT threshold, count(*) FILTER (WHERE given AND candidate = expected) AS n_right, count(*) FILTER (WHERE given AND candidate <> expected) AS n_wrong, count(*) FILTER (WHERE NOT given) AS n_silent FROM told GROUP BY 1)
 SELECT *, n_right / CAST(nullif(n_right + n_wrong, 0) AS DOUBLE) AS precision, n_right / CAST(nullif(n_right + n_wrong + n_silent, 0) AS DOUBLE) AS recall FROM n"""
)
def label_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, catalogue = _labelled(spark, sf_dir)
    pairs = M.most_alike(items, M.indexed(catalogue))
    truth = items.join(catalogue.select(F.substring("gtin", 2, 20).alias("item_code"), F.col("label").alias("expected")), "item_code").select("item_code", "expected")
    return M.calibrated(truth, pairs, [84, 88, 92])


@query(
    f"""WITH {_BEST_MODEL}, priced AS (SELECT CAST(b.k AS VARCHAR) AS item_code, candidate, score, second, c.price * CASE WHEN c.k % 4 = 0 THEN 12e0 ELSE 1.1e0 END / CASE WHEN i.price > 0 THEN i.price END AS ratio FROM best b JOIN part2 c ON c.k = b.ordinal JOIN part2 i ON i.k = b.k WHERE rn = 1 AND score >= 88 AND score - second >= 8),
 v AS (SELECT *, CASE WHEN ratio IS NULL THEN 'proposed' WHEN ratio BETWEEN 0.8e0 AND 1.25e0 THEN 'corroborated' WHEN ratio BETWEEN 0.5e0 AND 2e0 THEN 'plausible' WHEN {round_pack_sql("ratio")} IS NOT NULL THEN 'pack size' ELSE 'rejected' END AS price_verdict FROM priced)
 SELECT item_code, candidate, score, second, price_verdict, CASE WHEN count(*) OVER (PARTITION BY candidate) > 1 THEN 'shared candidate' ELSE price_verdict END AS level FROM v"""
)
def label_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, catalogue = _labelled(spark, sf_dir)
    best = M.unique_best(M.most_alike(items, M.indexed(catalogue))).where("reason = ''")
    priced = best.join(catalogue.select("gtin", "price"), "gtin").join(items.select("item_code", "old_price"), "item_code")
    return M.reviewed(M.corroborated(priced)).select("item_code", "candidate", "score", "second", "price_verdict", "level")


_NO_MODEL = "'[0-9]{1,3}|[0-9]+(ML|CL|L|GR?|KG)'"
_GLUED = f"list_filter(list_transform(list_filter({{grams}}, lambda g: len(list_filter(g, lambda p: regexp_full_match(p, '[0-9]+'))) > 0 AND len(list_filter(g, lambda p: length(p) > 4 AND NOT regexp_matches(p, '[0-9]'))) = 0), lambda g: array_to_string(g, '')), lambda t: length(t) BETWEEN 4 AND 12 AND NOT regexp_full_match(t, {_NO_MODEL}))"


def _tokens_sql(label: str) -> str:
    ws = _W.replace("{c}", label)
    spoken = _W.replace("{c}", f"regexp_replace(upper({label}), '\\b[0-9]+([.,][0-9]+)?\\s*(ML|CL|L|GR?|KG)\\b', ' ', 'g')")
    grams = f"list_concat([{spoken}[j:j + 1] for j in range(1, len({spoken}))], [{spoken}[j:j + 2] for j in range(1, len({spoken}) - 1)])"
    kept = f"list_filter({ws}, lambda w: length(w) >= 3 AND NOT list_contains({list(L.DEFAULT.stop + L.DEFAULT.discriminant + L.DEFAULT.suffixes)}, w) AND NOT regexp_full_match(w, {_NO_MODEL}))"
    return f"list_distinct(list_concat({kept}, {_GLUED.replace('{grams}', grams)}))"


#: The labels have no capacities, traits, sides, letter sizes or suffixes, so variants are compared by numbers and discriminants.
@query(
    f"""WITH {_LABELLED}, i AS (SELECT k, supplier, price, {_tokens_sql("label")} AS tokens, {_features_sql("label")} FROM part2), c AS (SELECT k, supplier, c_label, price * CASE WHEN k % 4 = 0 THEN 12e0 ELSE 1.1e0 END AS price, {_tokens_sql("c_label")} AS tokens, {_features_sql("c_label")} FROM part2),
 ct AS (SELECT k, supplier, unnest(tokens) AS w FROM c), useful AS (SELECT supplier, w FROM ct GROUP BY 1, 2 HAVING count(*) < greatest(3, (SELECT count(*) FROM c WHERE c.supplier = ct.supplier) / 2e0)),
 met AS (SELECT it.k, ct.k AS ordinal, count(*) AS n_common FROM (SELECT k, supplier, unnest(tokens) AS w FROM i) it JOIN useful USING (supplier, w) JOIN ct USING (supplier, w) GROUP BY 1, 2),
 fit AS (SELECT m.*, c.c_label, abs(c.price / CASE WHEN i.price > 0 THEN i.price END - 1) AS gap FROM met m JOIN i ON i.k = m.k JOIN c ON c.k = m.ordinal WHERE (len(i.numbers) = 0 OR len(c.numbers) = 0 OR len(list_intersect(i.numbers, c.numbers)) > 0)
 AND (len(i.discriminants) = 0 OR len(c.discriminants) = 0 OR len(list_intersect(i.discriminants, c.discriminants)) > 0))
 SELECT CAST(k AS VARCHAR) AS item_code, CAST(rank AS INT) AS rank, c_label AS o_label, n_common, gap FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n_common DESC, gap, ordinal, c_label) AS rank FROM fit) WHERE rank <= 4"""
)
def model_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, catalogue = _labelled(spark, sf_dir)
    return M.by_model(items, catalogue).select("item_code", "rank", "o_label", "n_common", "gap")


@query(
    f"""WITH {_LABELLED}, w AS (SELECT k, unnest(list_distinct(list_filter({_W.replace("{c}", "label")}, lambda w: length(w) >= 3 AND NOT regexp_full_match(w, '[0-9]+')))) AS word FROM part2),
 f AS (SELECT word, count(DISTINCT k) AS n FROM w GROUP BY 1) SELECT CAST(k AS VARCHAR) AS item_code, CAST(rank AS INT) AS rank, word FROM (SELECT k, word, row_number() OVER (PARTITION BY k ORDER BY n, length(word) DESC, word) AS rank FROM w JOIN f USING (word)) WHERE rank <= 3"""
)
def query_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _ = _labelled(spark, sf_dir)
    return M.words_to_query(items, M.word_frequencies(items))


@query("SELECT CAST(user_id AS VARCHAR) AS item_code, arg_max(event_type, (ts, event_id)) AS nature, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY 1")
def last_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = V.table(spark, sf_dir, "events")
    scans = ev.select(F.col("user_id").cast("string").alias("item_code"), F.col("event_id").cast("string").alias("gtin"), F.col("event_type").alias("nature"), F.col("ts").alias("scanned_at"), F.col("event_id").alias("ordinal"))
    return readers.last_scan(scans).select("item_code", "nature", F.col("gtin").cast("long").alias("last_event"))


@query("SELECT event_id, user_id, last_value(CASE WHEN event_id % 5 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS current_type FROM events")
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = V.table(spark, sf_dir, "events").withColumn("current_type", F.when(F.col("event_id") % 5 == 0, F.col("event_type")))
    return rel.forward_fill(ev, ["user_id"], ["ts", "event_id"], ["current_type"]).select("event_id", "user_id", "current_type")


@query("SELECT event_id, CAST(sum(jump) OVER (PARTITION BY user_id ORDER BY value, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM (SELECT *, CASE WHEN value - lag(value) OVER (PARTITION BY user_id ORDER BY value, event_id) > 6 THEN 1 ELSE 0 END AS jump FROM events)")
def value_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.islands(V.table(spark, sf_dir, "events"), ["user_id"], ["value", "event_id"], "value", 6.0).select("event_id", "island")


@query(
    """SELECT event_id, near_id FROM (SELECT a.event_id, b.event_id AS near_id, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.value - b.value), b.event_id) AS rn FROM events a JOIN events b ON a.user_id = b.user_id AND abs(a.value - b.value) <= 8
 WHERE a.event_id <> b.event_id) WHERE rn = 1"""
)
def nearest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the nearest other one, over all events."""
    ev = V.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    right = ev.select(F.col("event_id").alias("near_id"), "user_id", F.col("value").alias("near_value"))
    return rel.nearest(ev, right, ["user_id"], "value", "near_value", 8.0, [F.col("near_id").asc()], F.col("event_id") != F.col("near_id")).select("event_id", "near_id")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as sheets of cells, one sheet a brand: a title, a heading row, a row a part."""
    part = V.table(spark, sf_dir, "part").withColumn("row_no", (F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) + 1).cast("long"))
    cells = [F.concat(F.lit("PK-"), F.col("p_partkey").cast("string")), F.col("p_name"), F.concat(F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")), F.lit(" €")), F.replace((F.col("p_retailprice") * 0.5).cast("string"), F.lit("."), F.lit(",")), F.lit("6")]
    heads = ["Item ref.", "Product", "Net purchase price", "Price from 12", "Pack"]
    cell = lambda n, v: F.struct(F.lit(n).cast("long").alias("col_no"), v.alias("value"))
    body = part.select(F.lit("list").alias("file"), F.col("p_brand").alias("sheet"), "row_no", F.explode(F.array(*[cell(i, c) for i, c in enumerate(cells)])).alias("c"))
    top = part.select("p_brand").distinct().select(F.lit("list").alias("file"), F.col("p_brand").alias("sheet"), F.lit(1).cast("long").alias("row_no"), F.explode(F.array(*[cell(i, F.lit(h)) for i, h in enumerate(heads)])).alias("c"))
    title = part.select("p_brand").distinct().select(F.lit("list").alias("file"), F.col("p_brand").alias("sheet"), F.lit(0).cast("long").alias("row_no"), cell(0, F.lit("Price list 2024")).alias("c"))
    return body.unionAll(top).unionAll(title).select("file", "sheet", "row_no", "c.col_no", "c.value", F.lit(None).cast("string").alias("number_format"))


@query("SELECT 'PK-' || CAST(p_partkey AS VARCHAR) AS supplier_ref, p_name AS label, p_retailprice AS unit_cost, CAST(6.0 AS DOUBLE) AS pack_size, CAST(1 AS INT) AS n_tiers, p_retailprice * 0.5 AS tier2_cost FROM part")
def grid_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.offers_of_grid(_grid(spark, sf_dir), "X")
    return rows.select("supplier_ref", "label", "unit_cost", "pack_size", F.size("tiers").alias("n_tiers"), F.get("tiers", F.lit(0))["price"].alias("tier2_cost"))


@query("SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(DISTINCT 'R' || CAST(l_partkey AS VARCHAR)) AS n_refs FROM lineitem GROUP BY 1")
def acknowledgement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as acknowledgement texts and read back."""
    line = V.table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(*V.LINE)
    shown = line.select(F.col("l_orderkey").cast("string").alias("file"), F.row_number().over(w).alias("line_no"), F.format_string("%d R%d part number %d   %d  12,50  10 %%  100,00", F.col("l_linenumber").cast("long"), "l_partkey", "l_partkey", F.col("l_quantity").cast("long")).alias("line"))
    head = line.select("l_orderkey").distinct().select(F.col("l_orderkey").cast("string").alias("file"), F.lit(0).alias("line_no"), F.concat(F.lit("Acknowledgement A"), F.col("l_orderkey").cast("string"), F.lit("  Order date 18-SEP-26")).alias("line"))
    rows = X.acknowledgement(shown.unionAll(head), "X")
    return rows.groupBy(F.col("file").cast("long").alias("l_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"), F.sum("qty").cast("long").alias("qty"), F.count_distinct("supplier_ref").alias("n_refs"))


@query(
    f"""WITH {GTINS} SELECT item_code AS query, CASE k % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'absent' WHEN 2 THEN 'absent' ELSE 'found' END AS status, CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 200000 ELSE 1 END AS total, CASE WHEN k % 4 = 3 THEN good END AS first_code FROM gtins"""
)
def registry_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    found = F.concat(F.lit('{"totalElements":1,"content":[{"primaryDi":"123"},{"primaryDi":"0'), "good", F.lit('"}]}'))
    body = F.when(k % 4 == 0, "<html>busy</html>").when(k % 4 == 1, '{"totalElements":0,"content":[]}').when(k % 4 == 2, F.concat(F.lit('{"totalElements":200000,"content":[{"primaryDi":"'), "good", F.lit('"}]}'))).otherwise(found)
    return readers.registry_answers(V.gtins(spark, sf_dir).select(F.col("item_code").alias("query"), body.alias("body"))).select("query", "status", F.col("total").cast("int").alias("total"), "first_code")


@query("SELECT CAST(user_id AS VARCHAR) AS key, CAST(count(*) AS INT) AS attempts, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY 1")
def collector_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after two batches of answers. Answers of one time are told apart by a microsecond for each of their rank by event."""
    tie = F.row_number().over(Window.partitionBy("user_id", "ts").orderBy("event_id")) - 1
    ev = V.table(spark, sf_dir, "events").withColumn("at", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + tie))
    answers = ev.select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("status"), F.col("at").alias("answered_on"), F.lit(None).cast("string").alias("gtin"))
    cut = F.lit("2024-01-15").cast("timestamp")
    state = collectors.merged_state(spark.createDataFrame([], collectors.STATE), answers.where(F.col("answered_on") < cut))
    return collectors.merged_state(state, answers.where(F.col("answered_on") >= cut)).select("key", "attempts", "status")


@query("SELECT c_custkey, upper(trim(regexp_replace(c_name, '[^A-Za-z0-9]+', ' ', 'g'))) AS supplier_key, lower(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) AS heading, upper(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) AS flat FROM customer")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_name")
    return V.table(spark, sf_dir, "customer").select("c_custkey", T.supplier_key(n).alias("supplier_key"), T.heading_key(n).alias("heading"), T.flat_name(n).alias("flat"))
