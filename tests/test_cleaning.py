import math

import pytest
from pyspark.sql import functions as F, types as T

from conftest import by_key, subscribers
from loyalscope import schema
from loyalscope.functions import ascii_only, is_blank, number, percent_text, rate, round_even, strip
from loyalscope.operators import cleaning, quality


def test_blank_total_becomes_the_median(cleaned):
    assert isinstance(cleaned.schema["TotalCharges"].dataType, T.DoubleType)
    rows = by_key(cleaned)
    assert len(rows) == 5
    assert rows["di"]["TotalCharges"] == pytest.approx(1275.0)
    assert rows["ann"]["TotalCharges"] == 213.3


def test_zero_strategy(raw):
    assert by_key(cleaning.clean(raw, strategy="zero"))["di"]["TotalCharges"] == 0.0
    with pytest.raises(ValueError):
        cleaning.clean(raw, strategy="mean")


def test_approximate_median_is_close(raw):
    assert by_key(cleaning.clean(raw, approx=True))["di"]["TotalCharges"] in (1230.0, 1320.0)


def test_median_counts_duplicates_and_twins_stay_apart(spark):
    copy = {"customerID": "X", "TotalCharges": "10000"}
    twin = {"customerID": "Y ", "TotalCharges": "1"}
    rows = subscribers(spark, copy, copy, copy, twin, {**twin, "customerID": "Y"})
    out = cleaning.clean(rows)
    # totals 1 1 213.3 1230 1320 1518.75 10000 x3: the fifth of nine in order
    assert by_key(out)["di"]["TotalCharges"] == 1320.0
    ids = sorted(r["customerID"] for r in out.collect())
    assert ids == ["X", "Y", "Y", "ann", "bo", "cy", "di", "ed"]


def test_strings_are_stripped_of_any_space(spark):
    out = cleaning.clean(subscribers(spark, {"customerID": "\t Z \n", "gender": " Male "}))
    assert by_key(out)["Z"]["gender"] == "Male"


def test_impute_many_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5), (3.0, 4.0, None), (None, 8.0, 7), (math.nan, 6.0, 9)], "a double, b double, c int")
    out = cleaning.impute_median(df, ["a", "b", "c"]).collect()
    assert [r["a"] for r in out] == [1.0, 3.0, 2.0, 2.0]
    assert [r["b"] for r in out] == [6.0, 4.0, 8.0, 6.0]
    assert [r["c"] for r in out] == [5.0, 7.0, 7.0, 9.0]


def test_impute_column_without_any_value_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert [r["a"] for r in cleaning.impute_median(df, ["a"]).collect()] == [None, None]


def test_zero_fill_adds_and_orders(spark):
    df = spark.createDataFrame([("k", None, math.nan)], "id string, b int, a double")
    out = cleaning.zero_fill(df, ["a", "b", "c"], keep=["id"])
    assert out.columns == ["id", "a", "b", "c"]
    assert tuple(out.first()) == ("k", 0.0, 0, 0)


@pytest.mark.parametrize("text, value", [
    (" 7 ", 7.0), ("", None), ("  ", None), ("abc", None), ("1d", None), ("2.5f", None), ("1e3", 1000.0),
    ("NaN", None), (None, None), ("-0.5", -0.5), ("1,000", None)])
def test_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(number(F.col("t"))).first()[0] == value


def test_text_helpers(spark):
    df = spark.createDataFrame([(" café \U0001f600 ", 0.72, 1, 0)], "t string, p double, a int, b int")
    row = df.select(ascii_only(F.col("t")).alias("x"), percent_text(F.col("p")).alias("p"), strip(F.col("t")).alias("s"),
                    is_blank(F.lit(" \t")).alias("blank"), rate(F.col("a"), F.col("b")).alias("r"),
                    round_even(F.lit(0.125), 2).alias("even")).first()
    assert row["x"] == "caf" and row["p"] == "72.0%" and row["s"] == "café \U0001f600"
    assert row["blank"] is True and row["r"] is None and row["even"] == 0.12


# Quality reports


def test_null_report_lists_only_gaps(spark):
    df = spark.createDataFrame([(1, None, math.nan), (2, "x", 1.0), (3, None, 2.0)], "a int, b string, c double")
    rows = {r["column"]: (r["missing_count"], r["missing_pct"]) for r in quality.null_report(df).collect()}
    assert rows == {"b": (2, 66.67), "c": (1, 33.33)}


def test_duplicates_are_counted_and_listed(spark, monkeypatch):
    monkeypatch.setattr(quality, "COPIES_PER_TASK", 7)
    df = spark.createDataFrame([("hot", 1)] * 100 + [("pair", 2)] * 2 + [("one", None)] + [(None, None)] * 3, "k string, v int")
    assert quality.duplicate_count(df).first()[0] == 99 + 1 + 2
    listed = quality.duplicate_rows(df).groupBy("k", "v").count().collect()
    assert {(r["k"], r["v"]): r["count"] for r in listed} == {("hot", 1): 99, ("pair", 2): 1, (None, None): 2}
    writers = quality.duplicate_rows(df).where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(writers) >= 4 and max(r["count"] for r in writers) < 60


@pytest.mark.parametrize("copies", [1, 2, 3, 7, 8, 9, 14, 15, 16])
def test_duplicate_listing_at_slice_edges(spark, monkeypatch, copies):
    monkeypatch.setattr(quality, "COPIES_PER_TASK", 7)
    df = spark.createDataFrame([("a",)] * copies, "k string")
    assert quality.duplicate_rows(df).count() == copies - 1


def test_validation_passes_on_clean_data(featured):
    assert quality.is_valid(featured, "Churn")


def test_validation_fails_on_nulls_and_on_text_label(spark):
    gaps = spark.createDataFrame([(0, 1.0), (1, 2.0), (None, None)], "Churn int, col double")
    report = {r["check"]: r for r in quality.validate(gaps, "Churn").collect()}
    assert not report["no_missing_values"]["passed"] and report["no_missing_values"]["detail"] == "Churn=1, col=1"
    assert not quality.is_valid(gaps, "Churn")
    text = spark.createDataFrame([("Yes",), ("No",), ("Yes",)], "Churn string")
    report = {r["check"]: r["passed"] for r in quality.validate(text, "Churn").collect()}
    assert report == {"no_missing_values": True, "no_duplicate_rows": False, "label_is_integer": False}


def test_validation_reports_unbinned_tenure(spark):
    from loyalscope.plans import churn
    out = churn.transform(subscribers(spark, {"customerID": "new", "tenure": 0, "TotalCharges": " "}))
    report = {r["check"]: r for r in quality.validate(out, "Churn").collect()}
    assert report["no_missing_values"]["detail"] == "tenure_group=1"


def test_before_and_after(raw, cleaned):
    rows = {r["metric"]: (r["before"], r["after"]) for r in quality.compare(raw, cleaned, "TotalCharges").collect()}
    assert rows == {"Total Rows": ("5", "5"), "Null Values": ("1", "0"), "Duplicate Rows": ("0", "0"),
                    "TotalCharges dtype": ("string", "double")}


def test_key_uniqueness(spark, raw):
    assert quality.is_unique(raw, schema.KEY)
    assert not quality.is_unique(raw.unionAll(raw.limit(1)), schema.KEY)
    assert not quality.is_unique(spark.createDataFrame([(1,), (None,)], "k int"), "k")


def test_blank_rows_and_profile(raw):
    assert [r["customerID"] for r in quality.blank_rows(raw, "TotalCharges").collect()] == ["di"]
    profile = quality.dataset_profile(raw).orderBy("position").collect()
    assert [r["column"] for r in profile] == schema.RAW.fieldNames()
    assert {r["total_rows"] for r in profile} == {5} and {r["total_columns"] for r in profile} == {21}


def jobs_of(spark, work):
    """Ids of the jobs that a function starts, and its result."""
    group = f"watched-{id(work)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_watched_counts_are_those_of_a_scan_and_cost_none(spark, raw, tmp_path):
    from loyalscope.sources import files

    df = cleaning.coerce_number(raw, "TotalCharges").withColumn("od`d. name", F.when(F.col("tenure") > 20, F.lit(float("nan"))))
    rows, seen = quality.watched(df, "Churn", ["Yes", "No"])
    copy, writing = jobs_of(spark, lambda: files.snapshot(rows, str(tmp_path / "copy")))
    _, plain = jobs_of(spark, lambda: files.snapshot(df, str(tmp_path / "plain")))
    assert writing == plain
    for of in (quality.null_report, quality.dataset_profile):
        got, reads = jobs_of(spark, lambda: sorted(map(tuple, of(copy, seen).collect())))  # noqa: B023
        assert got == sorted(map(tuple, of(copy).collect())) and reads == 0
    assert seen.rows() == 5 and seen.labels() == {"Yes": 2, "No": 3} and seen.missing()["od`d. name"] == 2
    report = lambda watch: sorted(map(tuple, quality.intake_report(copy, "Churn", watch).collect()))
    (got, reads), (want, scans) = jobs_of(spark, lambda: report(seen)), jobs_of(spark, lambda: report(None))
    assert got == want and reads < scans
    checks = lambda watch: sorted(map(tuple, quality.validate(copy, "tenure", watch).collect()))
    assert checks(seen) == checks(None)


def test_label_values_not_watched_for_are_counted_by_a_scan(spark, tmp_path):
    from loyalscope.sources import files

    df = spark.createDataFrame([("Yes", 1), ("perhaps", 2), (None, 3)], "Churn string, k int")
    rows, seen = quality.watched(df, "Churn", ["Yes", "No"])
    copy = files.snapshot(rows, str(tmp_path / "copy"))
    assert seen.labels() is None
    assert sorted(map(tuple, quality.intake_report(copy, "Churn", seen).collect())) == sorted(map(tuple, quality.intake_report(copy, "Churn").collect()))
    empty, none = quality.watched(df.where("1 = 0"))
    files.snapshot(empty, str(tmp_path / "empty"))
    assert none.rows() == 0 and none.missing() == {"Churn": 0, "k": 0} and quality.null_report(df, none).count() == 0
