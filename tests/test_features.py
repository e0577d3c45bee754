import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import by_key, subscribers
from loyalscope import schema
from loyalscope.functions import binary_code, flag, labelled_bin, open_bin, relabel, revenue_category, risk_band
from loyalscope.operators import cleaning, features
from loyalscope.plans import churn


def values(spark, numbers, expression):
    df = spark.createDataFrame([(float(n) if n is not None else None,) for n in numbers], "v double")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_codes(featured):
    rows = by_key(featured)
    assert {r["Churn"] for r in rows.values()} == {0, 1} and rows["ed"]["Churn"] == 1
    assert featured.schema["Churn"].dataType.simpleString() == "int"
    assert rows["bo"]["gender_encoded"] == 1 and rows["ann"]["gender_encoded"] == 0
    for c in schema.YES_NO_COLUMNS:
        assert all(r[f"{c}_encoded"] == (1 if r[c] == "Yes" else 0) for r in rows.values())


@pytest.mark.parametrize("value", ["Maybe", None])
def test_strict_code_fails_on_unknown(spark, value):
    df = spark.createDataFrame([(value,)], "c string")
    with pytest.raises(PySparkException, match="no code for value"):
        df.select(binary_code(F.col("c"), schema.YES_NO)).collect()
    assert df.select(binary_code(F.col("c"), schema.YES_NO, default=0)).first()[0] == 0
    assert df.select(flag(F.col("c"), "Yes")).first()[0] == 0


def test_labels_survive_one_hot(featured):
    for c in schema.LABEL_COLUMNS:
        assert c in featured.columns
    assert "MultipleLines" not in featured.columns
    assert "PaymentMethod_Bank transfer (automatic)" in featured.columns
    row = by_key(featured)["cy"]
    assert row["Contract_One year"] is True and row["Contract_Two year"] is False


def test_one_hot_levels_from_data(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, None)], "c string, n int")
    out = features.one_hot(df, ["c", "n"], keep=["c"])
    assert out.columns == ["c", "c_a", "c_b", "n_1", "n_2"]
    assert tuple(out.where("c is null").first())[1:] == (False, False, False, False)
    with pytest.raises(ValueError, match="levels"):
        features.find_levels(df, ["c", "n"], max_levels=3)


def test_reverse_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    dummies = features.one_hot(df, ["c"])
    assert [r["c"] for r in features.decode_one_hot(dummies, "c").select("c").collect()] == ["b", "a", "a"]
    assert [r["c"] for r in features.decode_one_hot(dummies, "c", strict=True).select("c").collect()] == ["b", "a", None]
    assert features.decode_one_hot(df, "c") is df


def test_tenure_groups(spark, featured):
    rows = by_key(featured)
    assert [rows[k]["tenure_group"] for k in sorted(rows)] == ["0-1 Year", "2-4 Years", "4-6 Years", "0-1 Year", "1-2 Years"]
    closed = lambda c: labelled_bin(c, schema.TENURE_EDGES, schema.TENURE_LABELS)
    ends = lambda c: open_bin(c, schema.TENURE_EDGES, schema.TENURE_LABELS)
    probes = [0, 1, 12, 13, 24, 48, 72, 73, None, float("nan")]
    assert values(spark, probes, closed) == [
        None, "0-1 Year", "0-1 Year", "1-2 Years", "1-2 Years", "2-4 Years", "4-6 Years", None, None, None]
    assert values(spark, probes, ends) == [
        "0-1 Year", "0-1 Year", "0-1 Year", "1-2 Years", "1-2 Years", "2-4 Years", "4-6 Years", "4-6 Years", "4-6 Years", "4-6 Years"]


def test_bad_bins():
    with pytest.raises(ValueError):
        labelled_bin(None, [0, 1], ["a", "b"])
    with pytest.raises(ValueError):
        labelled_bin(None, [0, 1], ["a"], closed="both")


def test_revenue_category(spark):
    probes = [34.99, 35, 69.99, 70, None, float("nan")]
    assert values(spark, probes, revenue_category) == ["Low", "Medium", "Medium", "High", "Low", "Low"]
    assert values(spark, [None], lambda c: revenue_category(c, missing="High")) == ["High"]


def test_risk_bands(spark):
    probes = [0.0, 0.35, 0.3501, 0.65, 0.6501, 1.0, None]
    assert values(spark, probes, risk_band) == ["Low", "Low", "Medium", "Medium", "High", "High", None]
    assert values(spark, probes, lambda c: risk_band(c, "left")) == ["Low", "Medium", "Medium", "High", "High", "High", None]


def test_engineered_columns(featured):
    rows = by_key(featured)
    for r in rows.values():
        assert r["AnnualRevenue"] == pytest.approx(r["MonthlyCharges"] * 12)
        assert 0 <= r["LoyaltyScore"] <= 1
        assert None not in (r["RevenueCategory"], r["tenure_group"])
    assert rows["cy"]["LoyaltyScore"] == 1.0 and rows["bo"]["LoyaltyScore"] == 0.5
    assert rows["di"]["RevenueCategory"] == "Low" and rows["ed"]["RevenueCategory"] == "High"


def test_loyalty_variants(spark, raw):
    rows = by_key(features.normalise_by_max(raw, "tenure", "l", schema.FORM_MAX_TENURE, digits=3))
    assert rows["bo"]["l"] == 0.417
    zero = spark.createDataFrame([(0,), (0,)], "tenure int")
    assert features.normalise_by_max(zero, "tenure", "l").first()["l"] is None


def test_relabel(spark):
    assert values(spark, [0, 1, 2], lambda c: relabel(c, {0: "Retained", 1: "Churned"})) == ["Retained", "Churned", None]


def test_profile_features(spark):
    form = spark.createDataFrame(
        [("Yes", 6, 90.0, None, "Male", "No", "No", "Yes", "Yes"), ("No", 6, 90.0, 500.0, "Female", "Yes", "Yes", "No", "No")],
        "SeniorCitizen string, tenure int, MonthlyCharges double, TotalCharges double, gender string, Partner string, "
        "Dependents string, PhoneService string, PaperlessBilling string")
    one, two = features.profile_features(form).select(*schema.FEATURES).collect()
    assert tuple(one) == (1, 6, 90.0, 540.0, 1, 0, 0, 1, 1, 1080.0, 0.083)
    assert tuple(two) == (0, 6, 90.0, 500.0, 0, 1, 1, 0, 0, 1080.0, 0.083)


def test_light_transform(spark):
    rows = by_key(churn.light_transform(subscribers(
        spark, {"customerID": "odd", "Churn": "?", "gender": None, "tenure": 90, "MonthlyCharges": None})))
    assert rows["di"]["TotalCharges"] == 0.0
    odd = rows["odd"]
    assert (odd["ChurnFlag"], odd["gender_encoded"], odd["tenure_group"], odd["RevenueCategory"]) == (0, 0, "4-6 Years", "High")


def test_partitioning_does_not_change_the_result(spark, raw):
    reference = sorted(map(tuple, churn.transform(raw).collect()))
    for n in (1, 3, 7):
        shuffled = raw.repartition(n).orderBy(F.rand(n))
        assert sorted(map(tuple, churn.transform(shuffled).collect())) == reference


def test_cleaning_keeps_every_column(raw):
    assert cleaning.clean(raw).columns == schema.RAW.fieldNames()


def test_one_hot_columns_follow_the_data_or_the_given_values(spark):
    rows = subscribers(spark, {"customerID": "n", "Contract": " Three year "})
    found = churn.transform(rows)
    assert by_key(found)["n"]["Contract_Three year"] is True
    assert "PaymentMethod_Mailed check" in found.columns and len(found.columns) == 54 + 1
    fixed = churn.transform(rows, schema.LEVELS)
    assert "Contract_Three year" not in fixed.columns and by_key(fixed)["n"]["Contract"] == "Three year"
