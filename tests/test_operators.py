"""Small cases of the operators that the driver's tables can't show."""

from pyspark.sql import functions as F

from tallyforge.operators import extract as X
from tallyforge.operators import matching as M
from tallyforge.operators import offers as O
from tallyforge.operators import reconcile as R
from tallyforge.operators import register as G
from tallyforge.operators import relational as rel
from tallyforge.operators import scope as S
from tallyforge.sources import readers
from tallyforge.streaming import collectors


def test_null_keys_are_equal(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    got = {(r.k, r.a, r.b, r.in_left, r.in_right) for r in rel.null_safe_join(a, b, ["k"]).collect()}
    assert got == {(None, 1, 3, True, True), ("x", 2, None, True, False), ("y", None, 4, False, True)}


def test_cascade_prefers_earlier_keys_and_prices(spark):
    items = spark.createDataFrame([("1", "S", "A-1", "M1"), ("2", "S", "B-2", None), ("3", "S", None, "m3"), ("4", "S", "Z", None)], "item_code string, supplier string, supplier_ref string, manufacturer_ref string")
    offers = spark.createDataFrame(
        [(1, "S", "a-1", None, "x", None, 1.0), (2, "S", "a-1", None, "x", 9.0, 1.0), (3, "S", "a1", None, "x", 5.0, 1.0), (4, "S", "b2", None, "x", 7.0, 1.0), (5, "S", "M3", None, "x", 8.0, 1.0), (6, "T", "q", "4006381333931", "x", 3.0, 1.0)],
        "ordinal int, supplier string, supplier_ref string, gtin string, label string, price double, pack double",
    )
    links = spark.createDataFrame([("4", "4006381333931")], "item_code string, gtin string")
    got = {r.item_code: (r.key_used, r.offer_price) for r in O.cascade(items, offers, links).collect()}
    # The first offer of either key of A-1 has no price; later priced offers of a key don't count.
    assert got == {"1": (None, None), "2": ("loose reference", 7.0), "3": ("manufacturer reference", 8.0), "4": ("barcode", 3.0)}


def test_decisions_fill_and_never_overwrite(spark):
    matched = spark.createDataFrame([("1", 5.0), ("2", None)], "item_code string, offer_price double")
    d = spark.createDataFrame([("1", "2024-01-01", 6.0, 6.0), ("2", "2024-01-01", 7.0, 7.5)], "item_code string, decided_on string, decided_price double, expected_price double")
    got = {r.item_code: (r.offer_price, r.validated_link, r.decision_conflict, r.decision_expected) for r in O.with_decisions(matched, d).collect()}
    assert got == {"1": (5.0, False, True, True), "2": (7.0, True, False, False)}


def test_packs(spark):
    rows = [("s", 100.0, 10.0, "BOX OF 10", "glove", False), ("s", 100.0, 90.0, "BOX OF 10", "glove", False), ("s", 100.0, None, "BOX OF 10", "glove", False), ("s", 100.0, 10.0, "BOX OF 10", "glove", True)] + [("t", 60.0 + i, 10.0, "plain", "glove", False) for i in range(0, 4)] + [("t", 60.0, 10.0, "plain", "glove", False)] * 2
    df = spark.createDataFrame(rows, "supplier string, offer_price double, old_price double, offer_label string, item_label string, has_tiers boolean").withColumns({"offer_pack": F.lit(1.0), "pack_assumed": F.lit(True), "validated": F.lit(False)})
    got = [(r.supplier, r.divisor, r.divisor_source, r.uncorroborated, r.refused is not None) for r in O.pack_inference(df).orderBy("supplier", "has_tiers", F.col("old_price").asc_nulls_first(), "offer_price").collect()]
    assert got[0] == ("s", 10.0, "label", True, False) and got[1] == ("s", 10.0, "label", False, False) and got[2][1] == 1.0 and got[2][4]
    assert got[3][1:3] == (1.0, "withdrawn: the offer has tiers") and {g[1] for g in got[4:]} == {6.0}


def test_register_validates_before_ranking(spark):
    items = spark.createDataFrame([("1",)], "item_code string")
    reads = G.gathered({"warehouse": spark.createDataFrame([("1", "4006381333932", 1)], "item_code string, gtin string, ordinal int"), "label": spark.createDataFrame([("1.0", "4006381333931", 0.7)], "item_code string, gtin string, score double")})
    assert [(r.gtin, r.confidence) for r in G.register(items, reads).collect()] == [("4006381333931", "to verify")]
    assert [r.gtin for r in G.register(items, reads, legacy=True).collect()] == [None]


def test_verdicts(spark):
    items = spark.createDataFrame([("a", "1", False, 2), ("b", "1", False, 2), ("c", "1", False, 1), ("d", "1", True, 1), ("e", "1", False, 0), ("f", "1", False, 1), ("g", "1", False, 2)], "item_code string, gtin string, supplier_answered boolean, n_words int")
    answers = spark.createDataFrame([("a", 1, "absent", 0, None), ("a", 2, "found", 3, "1"), ("b", 1, "found", 1, "2"), ("c", 1, "absent", 0, None), ("f", 1, "found", 500, None), ("g", 1, "failed", 0, None), ("g", 2, "found", 1, "1")], "item_code string, rank int, status string, total int, hit string")
    got = {r.item_code: r.verdict for r in M.verdicts(items, answers).collect()}
    assert got == {"a": "confirmed", "b": "corrected", "c": "rejected", "d": "supplier answer", "e": "not tested", "f": "inconclusive", "g": "inconclusive"}


def test_latest_order_and_scope(spark):
    orders = spark.createDataFrame([("1", "A", "2024-01-02", 1), ("1", "B", None, 2), ("1", "C", "2024-01-01", 3)], "item_code string, supplier string, order_date string, ordinal int")
    assert S.latest_order(orders).first().supplier == "A" and S.latest_order(orders, legacy=True).first().supplier == "B"
    rules = S.Rules(types=("X",), families=("F1",), legacy_family="CHAIR")
    items = spark.createDataFrame([("X - t", "F", "a"), ("Y", "F1", "a"), ("Y", "CHAIRS", "FR old"), ("Y", "CHAIRS", "VPH FR"), (None, None, None)], "type string, family string, label string")
    assert [r.reason for r in S.annotated(items, rules).collect()] == ["type X", "family F1", "old nomenclature", None, None]


def test_owner_rows_and_catalogues(spark):
    owner = spark.createDataFrame([("1", "v", None, 5.0, 6.0), ("1", "v", None, 4.0, None), ("2", "v", "S", 3.0, 6.0), ("2", "v", "S", 2.0, 1.0)], "item_code string, variant string, supplier string, owner_price double, tier double")
    got = {(r.item_code, r.owner_price, r.n_tiers, r.comparable) for r in R.owner_unit_rows(owner).collect()}
    assert got == {("1", 4.0, 2, True), ("2", 2.0, 2, True)}
    items = spark.createDataFrame([("Acme Medical",), ("Zed",), (None,)], "supplier string")
    lists = spark.createDataFrame([("ACME",), ("Other",)], "catalogue string")
    assert {(r.supplier, r.has_catalogue) for r in R.has_catalogue(items, lists).collect()} == {("Acme Medical", True), ("Zed", False), (None, False)}


def test_conditions_sheet(spark):
    rows = spark.createDataFrame(
        [("f", "s", 0, "Gloves", None, None, None), ("f", "s", 1, "Soft", 10.0, None, None), ("f", "s", 2, None, None, 12.0, 9.0), ("f", "s", 3, "Masks", None, None, None), ("f", "s", 4, None, None, 5.0, 1.0), ("f", "s", 5, "Flat", 3.0, 6.0, None)],
        "file string, sheet string, row_no int, label string, price double, threshold double, tier_price double",
    )
    got = [(r.label, r.unit_cost, [(t.qty, t.price) for t in r.tiers]) for r in X.conditions(rows).orderBy("product_row").collect()]
    assert got == [("Gloves | Soft", 10.0, [(12.0, 9.0)]), ("Masks | Flat", 3.0, [(6.0, 3.0)])]


def test_page_words(spark):
    words = [("R1", 10, 40, 100), ("soft", 80, 120, 101), ("glove", 125, 160, 100), ("12,", 300, 318, 102), ("50", 319, 330, 102), ("€", 332, 338, 102), ("large", 80, 110, 112), ("R2", 10, 40, 130), ("mask", 80, 120, 130), ("3,00", 310, 328, 130), ("€", 332, 338, 130)]
    df = spark.createDataFrame([("f", 1, t, float(a), float(b), float(c)) for t, a, b, c in words], "file string, page int, text string, x0 double, x1 double, top double")
    rows = X.zones(X.bands(df), X.price_edge(df))
    told = X.with_comments(rows, spark.createDataFrame([("f", 1, 133.0, "new")], "file string, page int, top double, comment string"))
    assert {r.ref: r.comment for r in told.collect() if r.ref}["R2"] == "new"
    got = {r.supplier_ref: (r.label, r.unit_cost) for r in X.page_offers(rows).collect()}
    assert got == {"R1": ("soft glove large", 12.5), "R2": ("mask", 3.0)}


def test_sources(spark, tmp_path):
    (tmp_path / "g.csv").write_text("Ref;Label;Net price\nA1;Glove;1,50\n", encoding="utf-8")
    readers.register_sources(spark)
    grid = spark.read.format("tally_grid").option("paths", str(tmp_path / "g.csv")).option("sep", ";").load()
    got = X.finalised(X.offers_of_grid(grid, "S")).first()
    assert (got.supplier_ref, got.label, got.unit_cost, got.pack_size, got.pack_assumed) == ("A1", "Glove", 1.5, 1.0, True)
    (tmp_path / "scan.csv").write_text("code_article;ean;nature;horodatage\n1;a;x;2024-01-01\n1;b;y;2024-01-02\n", encoding="utf-8-sig")
    assert readers.scan_log(spark, str(tmp_path / "scan.csv")).first().gtin == "b"
    folder = str(tmp_path / "v")
    for i in range(11):
        assert readers.write_version(spark.range(i + 1), folder, "t", i + 1) == i + 1
    assert readers.latest_version(spark, folder, "t").count() == 11
    assert readers.table_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    assert len(readers.fingerprints(spark, str(tmp_path / "g.csv")).first().fingerprint) == 16


def test_collector_stream(spark, tmp_path):
    state = spark.createDataFrame([("a", 1, "found", None, "x"), ("b", 1, "failed", None, None)], collectors.STATE)
    batch = spark.createDataFrame([("a", "failed", None, None), ("b", "found", None, "y"), ("c", "absent", None, None)], "key string, status string, answered_on timestamp, gtin string")
    got = {r.key: (r.attempts, r.status, r.gtin) for r in collectors.merged_state(state, batch).collect()}
    assert got == {"a": (2, "found", "x"), "b": (2, "found", "y"), "c": (1, "absent", None)}
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    batch.write.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    q = stream.writeStream.foreachBatch(collectors.collector(spark, out)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{out}/0").count() == 3
    wanted = spark.createDataFrame([("a",), ("z",)], "key string")
    assert [r.key for r in collectors.open_keys(wanted, spark.read.parquet(f"{out}/0")).collect()] == ["z"]


def test_nearest_over_all_events(spark):
    from tallyforge import registry

    events = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "value").collect()]
    want = {}
    for i, u, v in events:
        near = [(abs(v - y), j) for j, w, y in events if w == u and j != i and abs(v - y) <= 8]
        if near:
            want[i] = min(near)[1]
    rows = registry.queries()["nearest_events"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(want) and {r.event_id: r.near_id for r in rows} == want


def test_sinks(spark, tmp_path):
    """Numbered tables of cases to settle, of classes and of sheets (PK12, RC7, CL8)."""
    from tallyforge.operators import offers as O
    from tallyforge.operators import reconcile as R
    from tallyforge.sources import readers

    cases = spark.createDataFrame([("a", 6.0, "box of 6", "soap"), ("b", 1.01, "soap", "soap")], "item_code string, ratio double, offer_label string, item_label string").selectExpr("*", "cast(null as double) as divisor")
    assert [O.write_to_settle(cases, f"{tmp_path}/a") for _ in range(2)] == [1, 2]
    assert [r.item_code for r in readers.latest_version(spark, f"{tmp_path}/a", "to_settle").collect()] == ["a"]
    rows = spark.createDataFrame([("x", "S", "AGREE", 1.0, 1.0, 1.0), ("y", "S", "ONLY_OURS", None, 2.0, None)], "item_code string, supplier string, price_class string, owner_price double, our_price double, ratio double")
    versions = R.write_views(rows, f"{tmp_path}/b")
    assert versions == {"agree": 1, "only_ours": 1, "suppliers": 1}
    assert "owner_price" not in readers.latest_version(spark, f"{tmp_path}/b", "only_ours").columns
    kinds = spark.createDataFrame([(str(i), k) for i, k in enumerate(["dropped", "annotated", "", "no_catalogue", ""])], "item_code string, set_aside string")
    assert set(R.write_sheets(kinds, f"{tmp_path}/c", ["item_code", "set_aside", "note"]).values()) == {1}
    back = readers.latest_version(spark, f"{tmp_path}/c", "open")
    assert back.columns == ["item_code", "set_aside", "note"] and back.count() == 2


def test_lists_and_frozen_scopes(spark, tmp_path):
    """Lists with either separator, populations of a fixed size, tables replaced by key (IO8, IO9, SP7, SP8, IO20)."""
    import pytest

    from tallyforge.operators import scope as S
    from tallyforge.sources import readers

    for name, sep in (("a.csv", ";"), ("b.csv", ",")):
        (tmp_path / name).write_text(f"item{sep}variant\n007{sep}1\n008{sep}2\n", encoding="utf-8")
        got = readers.frozen_list(spark, str(tmp_path / name), ["item", "variant"])
        assert sorted((r.item, r.variant) for r in got.collect()) == [("007", "1"), ("008", "2")]
    rows = spark.range(5).selectExpr("cast(id as string) as item_code")
    assert S.frozen(rows, f"{tmp_path}/scope", 5).count() == 5
    with pytest.raises(ValueError):
        S.load_frozen(spark, f"{tmp_path}/scope", 4)
    with pytest.raises(ValueError):
        S.frozen(rows, f"{tmp_path}/other", 6)
    first = spark.createDataFrame([("S1", 1), ("S2", 2)], "supplier string, n int")
    readers.replace_partitions(first, f"{tmp_path}/index", "supplier")
    readers.replace_partitions(spark.createDataFrame([("S2", 3), ("S2", 4)], "supplier string, n int"), f"{tmp_path}/index", "supplier")
    assert sorted((r.supplier, r.n) for r in spark.read.parquet(f"{tmp_path}/index").collect()) == [("S1", 1), ("S2", 3), ("S2", 4)]


def test_labels_of_one_kind_form_one_pair(spark, monkeypatch):
    names = [f"BLUE RING {n} {m}" for n in ("", "5", "7", "5 7") for m in ("", "MODELA", "MODELB", "BOX OF 3", "LARGE")] + ["OLD RING 5 MODELA", "BLUE ANVIL 9"]
    items = spark.createDataFrame([(str(i), "S", n) for i, n in enumerate(names)], "item_code string, supplier string, label string")
    rows = spark.createDataFrame([("S", n[::-1] if i % 5 == 4 else n, f"C{i}", i) for i, n in enumerate(names)], "supplier string, label string, gtin string, ordinal int")
    index, counts, pairs = M.indexed(rows), [], M.kind_pairs
    monkeypatch.setattr(M, "kind_pairs", lambda *a: counts.append(pairs(*a).count()) or pairs(*a))
    got = {r.item_code: (r.c_label, r.gtin, r.score) for r in M.best_by_label(items, index).collect()}
    i, c = M.L.features(F.col("label")), F.col("c")
    score = M.L.share_of(i["words"], c["words"])
    every = items.join(index, "supplier").where((F.size(i["words"]) >= 2) & M.L.compatible(i, c) & (score >= 0.6)).groupBy("item_code").agg(F.min(F.struct(-score, F.length("c_label"), "ordinal", "gtin", "c_label")).alias("b"))
    want = {r.item_code: (r.b.c_label, r.b.gtin, -r.b[0]) for r in every.collect()}
    assert got == want and len(got) > 15
    # All pairs of labels would be over 200.
    assert counts[0] < 50
