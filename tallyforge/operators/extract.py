"""Offers out of cell grids, word geometry and text lines. A grid has a row for each cell: file, sheet, row_no, col_no, value, number_format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import pricing as P
from tallyforge.functions import text as T
from tallyforge.functions.gtin import clean_gtin
from tallyforge.operators.relational import asc, first_by, islands, nearest

SHEET = ["file", "sheet"]
#: Role, and what a heading's key starts with; the first role that fits takes a heading.
ROLES = (
    ("gtin", ("ean", "gtin", "barcode")),
    ("reimb_code", ("lppr", "reimb")),
    ("vat_rate", ("vat", "tva", "tax")),
    ("eco_fee", ("eco",)),
    ("pack_size", ("pack", "cond", "lot")),
    ("label", ("label", "designation", "description", "product", "name")),
    ("price", ("price", "cost", "prix", "tarif", "net")),
    ("supplier_ref", ("ref", "code", "item")),
)
#: Words in a price heading and what they add to its score; None: such a column is never the purchase price.
PRICE_WORDS = (("net", 100), ("purchase", 100), ("unit", 30), ("discount", 30), ("case", -50), ("box", -50), ("public", None), ("retail", None), ("sale", None))


def header_with(grid: DataFrame, keywords: list[str], depth: int = 60) -> DataFrame:
    """First row of each sheet whose cells hold all keywords (EX1, EX2, IO4, IO5)."""
    key = T.heading_key(F.col("value"))
    found = [F.max(F.contains(key, F.lit(k)).cast("int")).alias(f"_k{i}") for i, k in enumerate(keywords)]
    rows = grid.where(F.col("row_no") < depth).groupBy(*SHEET, "row_no").agg(*found)
    for i in range(len(keywords)):
        rows = rows.where(F.col(f"_k{i}") == 1)
    return rows.groupBy(*SHEET).agg(F.min("row_no").alias("header_row"))


def column_of(headings: DataFrame, fragment: str) -> DataFrame:
    """First column of each sheet whose heading holds a fragment (EX3)."""
    return headings.where(F.contains(T.heading_key(F.col("value")), F.lit(fragment))).groupBy(*SHEET).agg(F.min("col_no").alias("col_no"))


def role(heading: Column) -> Column:
    """Role of a heading, null if none; a barcode may stand anywhere in it, other roles at its start (EX6, EX7)."""
    key = T.heading_key(heading)
    out = F
    for i, (name, starts) in enumerate(ROLES):
        fits = F.lit(False)
        for s in starts:
            fits = fits | (F.contains(key, F.lit(s)) if name in ("gtin", "price") else key.startswith(s))
        out = (F if i == 0 else out).when(fits, name)
    return out.otherwise(None)


def best_header(grid: DataFrame, depth: int = 25) -> DataFrame:
    """Header row of each sheet: two cells or more, a label, and a reference or a price; most roles, the first on ties (EX4, EX9)."""
    has = lambda n: F.max((F.col("_role") == n).cast("int"))
    rows = grid.where((F.col("row_no") < depth) & F.col("value").isNotNull()).withColumn("_role", role(F.col("value")))
    scored = rows.groupBy(*SHEET, "row_no").agg(F.count(F.lit(1)).alias("_cells"), has("label").alias("_l"), has("supplier_ref").alias("_r"), has("price").alias("_p"), has("gtin").alias("_g"))
    good = scored.fillna(0).where("_cells >= 2 and _l = 1 and (_r = 1 or _p = 1)").withColumn("score", F.col("_l") + F.col("_r") + F.col("_p") + F.col("_g"))
    return first_by(good, SHEET, [F.col("score").desc(), F.col("row_no").asc()]).select(*SHEET, F.col("row_no").alias("header_row"), "score")


def column_roles(grid: DataFrame, headers: DataFrame) -> DataFrame:
    """Role of each column: the first column wins a role; a second barcode is the case's; price columns keep score, rank and tier quantity (EX5, EX10, EX14)."""
    heads = grid.join(headers.select(*SHEET, "header_row"), SHEET).where(F.col("row_no") == F.col("header_row")).select(*SHEET, "col_no", F.col("value").alias("heading"), role(F.col("value")).alias("role")).where("role is not null")
    key = T.heading_key(F.col("heading"))
    score, excluded = F.lit(0), F.lit(False)
    for word, weight in PRICE_WORDS:
        held = F.contains(key, F.lit(word))
        if weight is None:
            excluded = excluded | held
        else:
            score = score + F.when(held, weight).otherwise(0)
    explicit = F.contains(key, F.lit("purchase")) | F.contains(key, F.lit("net"))
    # A sale price is consumed by its heading, but it is no offer price.
    heads = heads.withColumns({"score": F.when(F.col("role") == "price", score), "_out": (F.col("role") == "price") & excluded & ~explicit}).where("not _out").drop("_out")
    heads = heads.withColumn("tier_qty", F.when(F.col("role") == "price", F.coalesce(T.blank_to_null(F.regexp_extract("heading", r"(?:from|>=|by|x|des|par)\s*(\d+)", 1)).try_cast("double"), F.lit(1.0))))
    w = Window.partitionBy(*SHEET, "role")
    ranked = heads.withColumn("role_rank", F.row_number().over(w.orderBy(F.when(F.col("role") == "price", F.col("tier_qty")).asc_nulls_last(), F.col("score").desc_nulls_last(), "col_no")))
    named = F.when((F.col("role") == "gtin") & (F.col("role_rank") == 2), "gtin_case").otherwise(F.col("role"))
    return ranked.withColumn("role", named).where((F.col("role").isin("price", "gtin_case")) | (F.col("role_rank") == 1))


def offers_of_grid(grid: DataFrame, supplier: str) -> DataFrame:
    """Offers of sheets of any layout: rows with a label, a reference or code, and a positive price (EX8, EX11 to EX13)."""
    headers = best_header(grid)
    roles = column_roles(grid, headers)
    cells = grid.join(headers.select(*SHEET, "header_row"), SHEET).where(F.col("row_no") > F.col("header_row")).join(roles, [*SHEET, "col_no"])
    one = lambda r: F.first(F.when(F.col("role") == r, T.clean_text(F.col("value"))), ignorenulls=True).alias(r)
    priced = F.array_sort(F.collect_list(F.when((F.col("role") == "price") & (T.clean_number(F.col("value")) > 0), F.struct(F.col("tier_qty").alias("qty"), (-F.col("score")).alias("minus_score"), T.clean_number(F.col("value")).alias("price"), F.col("heading")))))
    rows = cells.groupBy(*SHEET, "row_no").agg(*[one(r) for r in ("supplier_ref", "label", "gtin", "gtin_case", "vat_rate", "pack_size", "eco_fee", "reimb_code")], priced.alias("_p"))
    first = F.get("_p", F.lit(0))
    pack = P.pack_size(T.clean_number(F.col("pack_size")))
    tiers = F.transform(F.slice("_p", 2, 1000), lambda t: F.struct(t["qty"].alias("qty"), t["price"].alias("price")))
    rows = rows.where((F.size("_p") > 0) & F.col("label").isNotNull() & (F.col("supplier_ref").isNotNull() | F.col("gtin").isNotNull()))
    return rows.select(
        F.lit(supplier).alias("supplier"),
        F.coalesce("supplier_ref", "gtin").alias("supplier_ref"),
        "label",
        clean_gtin(F.col("gtin")).alias("gtin_unit"),
        clean_gtin(F.col("gtin_case")).alias("gtin_case"),
        first["price"].alias("unit_cost"),
        first["heading"].alias("price_column"),
        pack["size"].alias("pack_size"),
        pack["assumed"].alias("pack_assumed"),
        P.valid_tiers(first["price"], tiers).alias("tiers"),
        T.clean_number(F.col("vat_rate")).alias("vat_rate"),
        T.clean_number(F.col("eco_fee")).alias("eco_fee"),
        "reimb_code",
        F.col("file").alias("source_file"),
        F.col("row_no").alias("ordinal"),
    )


#: Columns of an offer and their types.
OFFER = {
    "supplier": "string", "supplier_ref": "string", "item_code": "string", "label": "string", "gtin_unit": "string", "gtin_case": "string", "unit_cost": "double",
    "price_column": "string", "pack_size": "double", "case_cost": "double", "pack_assumed": "boolean", "list_price_gross": "double", "vat_rate": "double",
    "discount_rate": "double", "recomputed_cost": "double", "cost_gap": "double", "cost_coherent": "boolean", "tier2_qty": "double", "tier2_cost": "double",
    "tier2_saving": "double", "tier3_qty": "double", "tier3_cost": "double", "tier3_saving": "double", "tiers_display": "string", "eco_fee": "double",
    "reimb_amount": "double", "reimb_code": "string", "is_device": "string", "origin": "string", "source_file": "string", "alerts": "array<string>",
}


def finalised(offers: DataFrame) -> DataFrame:
    """Offers under the fixed schema: missing columns null, values that can't be cast null, alerts kept (EX27)."""

    def cast(c: str, t: str) -> Column:
        if c not in offers.columns:
            return F.lit(None).cast(t).alias(c)
        return (F.col(c).cast(t) if t.startswith("array") else F.col(c).cast("string").try_cast(t)).alias(c)

    return offers.select(*[cast(c, t) for c, t in OFFER.items()])


def conditions(rows: DataFrame) -> DataFrame:
    """Rows of a conditions sheet told apart and tied to category and product (EX15).

    rows: file, sheet, row_no, label, price, threshold, tier_price. A label with a price is a product, without one a category,
    which ends the product before it; a tier price without label belongs to the current product.
    """
    kind = F.when(F.col("label").isNotNull() & F.col("price").isNotNull(), "product").when(F.col("label").isNotNull(), "category").when(F.col("tier_price").isNotNull(), "tier")
    w = Window.partitionBy(*SHEET).orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("kind", kind).where("kind is not null")
    last = lambda c: F.last(c, ignorenulls=True).over(w)
    marked = marked.withColumns({"category": last(F.when(F.col("kind") == "category", F.col("label"))), "_cat_row": last(F.when(F.col("kind") == "category", F.col("row_no"))), "product_row": last(F.when(F.col("kind") == "product", F.col("row_no")))})
    current = F.col("product_row") > F.coalesce("_cat_row", F.lit(-1))
    marked = marked.where((F.col("kind") != "tier") | F.coalesce(current, F.lit(False)))
    tier = F.when(F.col("threshold").isNotNull() & F.coalesce("tier_price", F.when(F.col("kind") == "product", F.col("price"))).isNotNull(), F.struct(F.col("threshold").cast("double").alias("qty"), F.coalesce("tier_price", "price").cast("double").alias("price")))
    products = marked.where(F.col("kind") != "category").groupBy(*SHEET, "product_row").agg(
        F.max(F.when(F.col("kind") == "product", F.concat_ws(" | ", "category", "label"))).alias("label"), F.max(F.when(F.col("kind") == "product", F.col("price"))).alias("unit_cost"), F.array_sort(F.collect_list(tier)).alias("tiers")
    )
    return products


def bands(words: DataFrame, tolerance: float = 6.0) -> DataFrame:
    """Words (file, page, text, x0, x1, top) numbered by line: a gap to the previous word above tolerance starts a new one (EX16)."""
    return islands(words, ["file", "page"], ["top", "x0", "text"], "top", tolerance, "band")


def price_edge(words: DataFrame, left: float = 45, right: float = 10) -> DataFrame:
    """Bounds of each file's price column: the upper median of the currency signs, else of the amounts' right edges plus 2 (EX17)."""
    upper = lambda c: F.get(F.array_sort(F.collect_list(c)), F.floor(F.count(c) / 2).cast("int"))
    signs, amounts = F.when(F.col("text") == "€", F.col("x0")), F.when(F.col("text").rlike(r"^\d{1,6},\d\d$"), F.col("x1") + 2)
    at = words.groupBy("file").agg(upper(signs).alias("_s"), upper(amounts).alias("_a"))
    return at.select("file", (F.coalesce("_s", "_a") - left).alias("price_from"), (F.coalesce("_s", "_a") + right).alias("price_to"))


def zones(banded: DataFrame, edges: DataFrame, label_x: float = 70, isolated_x: float = 230) -> DataFrame:
    """Reference, label and amount of each band by the words' place; a lone ``x`` far right is dropped, amounts are glued (EX18, EX20, EX23)."""
    # One small row a file: the planner broadcasts them if they are few, and adaptive execution splits a large file otherwise.
    words = banded.join(edges, "file").where(~((F.lower("text") == "x") & (F.col("x0") >= isolated_x)))
    zone = F.when(F.col("x0").between(F.col("price_from"), F.col("price_to")), "price").when(F.col("x0") < label_x, "ref").otherwise("label")
    text = lambda z, sep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_z") == z, F.struct("x0", "text")))), lambda s: s["text"]), sep)
    rows = words.withColumn("_z", zone).groupBy("file", "page", "band").agg(F.min("top").alias("top"), text("ref", " ").alias("ref"), text("label", " ").alias("label"), text("price", "").alias("_amount"))
    amount = F.regexp_replace("_amount", r"[^\d,]", "")
    return rows.withColumn("price", F.when(amount.rlike(r"^\d{1,6},\d\d$"), F.replace(amount, F.lit(","), F.lit(".")).try_cast("double"))).drop("_amount")


def with_comments(rows: DataFrame, comments: DataFrame, within: float = 8.0) -> DataFrame:
    """Comments (file, page, top, comment) tied to the nearest row of their page (EX19)."""
    met = nearest(comments.withColumnRenamed("top", "c_top"), rows.select("file", "page", "band", "top"), ["file", "page"], "c_top", "top", within, [F.col("band").asc()])
    said = met.groupBy("file", "page", "band").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_top", "comment"))), lambda s: s["comment"]), " ").alias("comment"))
    return rows.join(said, ["file", "page", "band"], "left")


def lot_of_label(label: Column, low: int = 2, high: int = 500) -> Column:
    """Lot size that a label gives, within bounds (EX21)."""
    n = F.regexp_extract(F.upper(label), r"(?:LOT|PACK|BOX|SET)\s*(?:OF|DE)?\s*(\d{1,3})\b", 1).try_cast("int")
    return F.when(n.between(low, high), n)


def page_offers(rows: DataFrame) -> DataFrame:
    """Offers of banded pages: a band without amount continues the label above it, zero prices go, repeated (ref, price) once, references with several prices are told (EX22, EX24)."""
    w = Window.partitionBy("file").orderBy("page", "band").rowsBetween(Window.unboundedPreceding, 0)
    start = (F.col("ref") != "") & F.col("price").isNotNull()
    grouped = rows.withColumn("_g", F.sum(start.cast("int")).over(w)).where("_g > 0")
    whole = grouped.groupBy("file", "_g").agg(F.max(F.when(start, F.col("ref"))).alias("ref"), F.max(F.when(start, F.col("price"))).alias("price"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "band", "label"))), lambda s: s["label"]), " ").alias("label"))
    once = first_by(whole.where("price > 0"), ["file", "ref", "price"], asc("_g"))
    many = once.groupBy("file", "ref").agg(F.count(F.lit(1)).alias("n_prices"))
    return once.join(many, ["file", "ref"]).select("file", F.col("ref").alias("supplier_ref"), F.trim("label").alias("label"), F.col("price").alias("unit_cost"), F.when(F.col("n_prices") > 1, F.array(F.lit("several prices"))).otherwise(F.array().cast("array<string>")).alias("alerts"))


#: A line of an acknowledgement: position, reference, label, quantity, unit price, discount in per cent or none, amount.
ACK_LINE = r"^\s*(\d+)\s+(\S+)\s+(.+?)\s+(\d+(?:[.,]\d+)?)\s+(\d+(?:[ .]\d{3})*,\d{2,4})\s+(?:(-?\d+(?:,\d+)?)\s*%\s+)?(\d+(?:[ .]\d{3})*,\d{2})\s*$"


def acknowledgement(lines: DataFrame, supplier: str) -> DataFrame:
    """Order lines of acknowledgement texts (file, line_no, line), with the header fields of their file (EX25, EX26, IO18)."""
    clean = lines.withColumn("line", T.without_invisible(F.col("line")))
    field = lambda p: F.max(T.blank_to_null(F.regexp_extract("line", p, 1)))
    heads = clean.groupBy("file").agg(field(r"Acknowledgement\s+(\S+)").alias("ack_no"), field(r"Your order\s+(\S+)").alias("our_order_no"), field(r"Order date\s+(\d{1,2}-\w{3}-\d{2})").alias("_date"), field(r"Delivery\s+(\d{1,2}-\w{3}-\d{2})").alias("_delivery"))
    part = lambda i: T.blank_to_null(F.regexp_extract("line", ACK_LINE, i))
    rows = clean.where(F.col("line").rlike(ACK_LINE))
    unit, discount = T.plain_number(part(5)), T.plain_number(part(6))
    return rows.join(heads, "file").select(
        F.lit(supplier).alias("supplier"), "file", "ack_no", "our_order_no", part(2).alias("supplier_ref"), T.clean_line(part(3)).alias("label"), T.plain_number(part(4)).alias("qty"), unit.alias("unit_price"), discount.alias("discount_pct"),
        P.net_price(unit, F.coalesce(discount, F.lit(0.0))).alias("net_price"), T.plain_number(part(7)).alias("line_amount"), T.english_date(F.col("_delivery")).alias("delivery_date"), T.english_date(F.col("_date")).alias("order_date"),
    )
