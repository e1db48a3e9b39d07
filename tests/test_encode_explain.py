import pytest
from pyspark.sql import functions as F

import fixtures
from oddspend import schema as S
from oddspend.operators import encode as E, explain as X, insights as I


def rows(spark):
    return spark.createDataFrame([(0, "a", 1.0, 5.0), (1, "a", 2.0, 5.0), (2, "b", 3.0, 5.0), (3, "a", 6.0, 5.0)],
                                 "row_id long, MCC string, x double, c double")


@pytest.mark.parametrize("kind,want", [("standard", (3.0, 3.5 ** 0.5)), ("robust", (2.5, 2.0)), ("minmax", (1.0, 5.0))])
def test_scalers(spark, kind, want):
    got = E.fit_scaler(rows(spark), ["x", "c"], kind)
    assert got["x"] == pytest.approx(want)
    assert got["c"] == (5.0, 1.0)
    assert {r.c_scaled for r in E.scale(rows(spark), got).collect()} == {0.0}


def test_encoder(spark, tmp_path):
    df = rows(spark)
    enc = E.Encoder()
    with pytest.raises(RuntimeError):
        enc.transform(df)
    enc.fit(df, ["x", "c"])
    assert enc.feature_columns() == ["MCC_freq", "x_scaled", "c_scaled"]
    new = df.withColumn("MCC", F.lit("never seen"))
    assert {r.MCC_freq for r in enc.transform(new).collect()} == {0.25}
    with pytest.raises(ValueError, match="absent"):
        enc.transform(df.drop("x"))
    enc.save(str(tmp_path))
    again = E.Encoder.load(spark, str(tmp_path))
    assert again.feature_columns() == enc.feature_columns()
    cols = ["row_id", *enc.feature_columns()]
    assert again.transform(df).select(cols).orderBy("row_id").collect() == enc.transform(df).select(cols).orderBy("row_id").collect()
    m = enc.matrix(df).filter("row_id = 2").first()
    assert m.features == [m.MCC_freq, m.x_scaled, m.c_scaled]


def test_explanations(spark):
    df = rows(spark).withColumnsRenamed({"x": "Amount_scaled", "c": "MCC_freq"})
    stats = X.reference_stats(df, ["MCC_freq", "Amount_scaled"])
    assert stats["MCC_freq"] == (5.0, 1.0)  # no spread counts as 1
    top = X.explain_rows(df.filter("row_id = 3"), stats, 1).first()
    assert (top.feature, top.z_score, top.value, top.reference_mean) == ("Amount_scaled", 1.604, 6.0, 3.0)
    text = X.explain_text(df.filter("row_id = 3"), stats).first().explanation
    assert text == ("Flagged mainly for: size of the payment (far above normal, z=+1.60); MCC (far below normal, z=+0.00).")


def test_base_feature(spark):
    got = spark.range(1).select(*[X.base_feature(F.lit(c)).alias(c) for c in ("Amount_scaled", "MCC_freq", "plain")]).first()
    assert tuple(got) == ("Amount", "MCC", "plain")


def test_box_and_histogram(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 7.0)], "g string, Amount double")
    box = {r.g: r for r in I.box_stats(df, "g").collect()}
    assert (box["a"].q1, box["a"].median, box["a"].q3, box["a"].whisker_low, box["a"].whisker_high) == (2, 3, 4, 1, 4)
    assert box["b"].n == 1
    assert {(r.bin, r.n) for r in I.histogram(df, "Amount", 10).collect()} == {(0, 5), (9, 1)}


def test_impact(spark):
    df = spark.createDataFrame([(10.0, 1), (30.0, 0)], "Amount double, is_anomaly int")
    assert tuple(I.impact_summary(df).first()) == (2, 1, 50.0, 10.0, 25.0)
