import pytest
from pyspark.sql import functions as F

from tallyforge.plans import chain as C


def test_chain(spark, tmp_path):
    steps = [C.Step("a", lambda t: t["x"].where("id > 1"), ("x",)), C.Step("b", lambda t: t["a"].agg(F.sum("id").alias("s")), ("a",), lambda d: "" if d.first().s < 10 else "too much")]
    folder, x = str(tmp_path), {"x": spark.range(4).toDF("id")}
    assert C.run(spark, steps, x, folder, dry=True).done == [("a", 0), ("b", 0)]
    full = C.run(spark, steps, x, folder)
    assert full.done == [("a", 1), ("b", 1)] and not full.failed
    again = C.run(spark, steps, {}, folder, start="b")
    assert again.done == [("b", 2)] and again.skipped == ["a"]
    assert C.run(spark, steps, {"x": spark.range(9).toDF("id")}, folder).failed == "b: too much"
    assert C.run(spark, steps, {}, folder, only=("a",)).failed == "a needs x"
    with pytest.raises(ValueError, match="no step"):
        C.run(spark, steps, x, folder, start="z")


def test_reconciliation_chain(spark, tmp_path):
    scope = spark.createDataFrame([("1", "v"), ("2", "v")], "item_code string, variant string")
    owner = spark.createDataFrame([("1", "v", "S", 5.0, None, "supplier list"), ("2", "v", "S", 5.0, None, "internal")], "item_code string, variant string, supplier string, owner_price double, tier double, origin string")
    ours = spark.createDataFrame([("1", "v", "S", 5.0, None), ("2", "v", "S", 6.0, None)], "item_code string, variant string, supplier string, our_price double, tier double")
    tables = {"scope": scope, "owner": owner, "ours": ours}
    assert C.run(spark, C.RECONCILIATION, tables, str(tmp_path)).done == [("reconciled", 1), ("verdicts", 1)]
    bad = C.run(spark, C.RECONCILIATION, tables | {"ours": ours.withColumn("our_price", F.lit(9.0))}, str(tmp_path))
    assert bad.failed == "reconciled: 1 divergences of reading"
