import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import by_key
from loyalscope import schema
from loyalscope.operators import learning, offers, reports, segments
from loyalscope.plans import churn
from loyalscope.session import scratch_path, shared_folder
from loyalscope.sources import artifacts, eventlog, files, tables, versions


def same_rows(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_required_columns(raw):
    assert files.require_columns(raw, schema.RAW.fieldNames()) is raw
    with pytest.raises(ValueError, match=r"Missing required columns: \['A', 'B'\]"):
        files.require_columns(raw, ["customerID", "A", "B"])


def test_csv_round_trip_keeps_blanks(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    files.write_csv(raw, path)
    back = files.read_raw(spark, path)
    assert back.schema.simpleString() == schema.RAW.simpleString()
    assert same_rows(back, raw)


def test_csv_columns_are_found_by_name(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    files.write_csv(raw.select(F.lit("x").alias("extra"), *reversed(raw.columns)), path)
    back = files.read_raw(spark, path)
    assert back.columns[0] == "extra"
    assert same_rows(back.select(*raw.columns), raw)
    files.write_csv(raw.drop("Churn", "tenure"), path)
    with pytest.raises(ValueError, match=r"\['tenure', 'Churn'\]"):
        files.read_raw(spark, path)


def test_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_raw(spark, str(tmp_path / "absent"))


def test_parquet_source_and_nan(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    files.write_parquet(raw.withColumn("MonthlyCharges", F.lit(float("nan"))), path)
    back = files.read_raw(spark, path, "parquet")
    assert back.where("MonthlyCharges is null").count() == 5


def test_snapshot_is_overwritten(spark, raw, tmp_path):
    path = str(tmp_path / "backup")
    assert files.snapshot(raw, path).count() == 5
    assert files.snapshot(raw.limit(2), path).count() == 2


def failing(df):
    """The rows, but for one that fails while it is written."""
    return df.withColumn("tenure", F.when(F.col("customerID") == "di", F.raise_error(F.lit("lost on the way")).cast("int")).otherwise(F.col("tenure")))


def test_a_failed_snapshot_leaves_the_last_one(spark, raw, tmp_path):
    path = str(tmp_path / "backup")
    first = files.snapshot(raw.limit(3), path)
    with pytest.raises(Exception, match="lost on the way"):
        files.snapshot(failing(raw), path)
    assert versions.read(spark, path).count() == 3 and len(versions.versions(spark, path)) == 1
    second = files.snapshot(raw, path)
    assert (first.count(), second.count(), versions.read(spark, path).count()) == (3, 5, 5)  # who reads the last one may finish
    files.snapshot(raw.limit(1), path)
    assert [p.name for p in sorted((tmp_path / "backup").iterdir())] == [v.rsplit("/", 1)[1] for v in versions.versions(spark, path)]
    assert len(versions.versions(spark, path)) == 1 + versions.KEPT and versions.read(spark, path).count() == 1


def test_plain_files_are_their_own_version(spark, raw, tmp_path):
    path = str(tmp_path / "plain")
    files.write_parquet(raw, path)
    assert versions.current(spark, path) == path and versions.read(spark, path).count() == 5
    assert versions.versions(spark, str(tmp_path / "absent")) == []


@pytest.mark.parametrize("placed", [True, False])
def test_a_failed_replacement_leaves_the_table(spark, raw, tmp_path, placed):
    name = f"t{uuid.uuid4().hex[:8]}"
    path = str(tmp_path / "table") if placed else None
    rows = tables.raw_table_rows(raw)
    tables.replace_table(rows.limit(3), name, path)
    before = spark.table(name)
    with pytest.raises(Exception, match="lost on the way"):
        tables.replace_table(failing(rows), name, path)
    assert spark.table(name).count() == 3
    tables.replace_table(rows, name, path)
    assert spark.table(name).count() == 5 and before.count() in (3, 5)
    tables.replace_table(rows.limit(2).select("customerID", "tenure"), name, path)  # other columns
    assert spark.table(name).columns == ["customerID", "tenure"] and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("fmt, write", [("csv", files.write_csv), ("parquet", files.write_parquet)])
def test_processed_rows_come_back_typed(spark, featured, tmp_path, fmt, write):
    path = str(tmp_path / "processed")
    write(featured, path)
    back = files.read_stage(spark, path, fmt)
    assert back.dtypes == featured.dtypes
    assert same_rows(back, featured)


def test_processed_rows_written_by_pandas(spark, featured, tmp_path):
    path = tmp_path / "processed.csv"
    featured.toPandas().to_csv(path, index=False)
    back = files.read_stage(spark, str(path))
    assert back.dtypes == featured.dtypes
    assert same_rows(back, featured)


def test_first_available_source(spark, featured, tmp_path):
    name = f"t{uuid.uuid4().hex[:8]}"
    scored, processed = str(tmp_path / "scored"), str(tmp_path / "processed")
    candidates = [tables.Source("scored", "csv", scored), tables.Source("processed", "csv", processed), tables.Source("table", "table", name)]
    with pytest.raises(FileNotFoundError):
        tables.resolve_source(spark, candidates)
    tables.replace_table(tables.cleaned_table_rows(featured), name, str(tmp_path / "table"))
    assert tables.resolve_source(spark, candidates)[1] == "table"
    files.write_csv(featured, processed)
    assert tables.resolve_source(spark, candidates)[1] == "processed"
    files.write_csv(featured, scored)
    assert tables.resolve_source(spark, candidates)[1] == "scored"


def test_tables_are_created_and_replaced(spark, raw, featured, tmp_path):
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    cleaned_name = prefix + schema.CLEANED_TABLE
    tables.create_tables(spark, prefix, str(tmp_path))
    assert spark.table(cleaned_name).count() == 0
    assert spark.table(cleaned_name).columns == schema.CLEANED.fieldNames()
    for _ in range(2):
        tables.load_tables(featured, raw, prefix, str(tmp_path))
    loaded = spark.table(cleaned_name)
    assert loaded.columns == schema.CLEANED.fieldNames()
    assert by_key(loaded)["bo"]["Contract"] == "Two year" and loaded.count() == 5
    assert spark.table(prefix + schema.RAW_TABLE).count() == 5


def test_table_rows_rebuild_lost_labels(featured):
    rows = tables.cleaned_table_rows(featured.drop(*schema.LABEL_COLUMNS))
    assert same_rows(rows, tables.cleaned_table_rows(featured))


def test_jdbc_settings():
    options = tables.jdbc_options("jdbc:x", "t", {"user": "u"}, batchsize=tables.BATCH_ROWS, numPartitions=8)
    assert options == {"url": "jdbc:x", "dbtable": "t", "user": "u", "batchsize": "5000", "numPartitions": "8"}


def test_jdbc_slices():
    slices = tables.Slices("id", 1, 900, 6)
    assert tables.slice_options("jdbc:x", "t", slices) == {
        "url": "jdbc:x", "dbtable": "t", "partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "6"}


def test_run_hands_both_tables_to_the_database(spark, raw, tmp_path, monkeypatch):
    """No database may be started here, so the writers are caught just before they would connect."""
    caught = []
    monkeypatch.setattr(tables, "_save", caught.append)
    seen = []
    plain = tables.jdbc_options
    monkeypatch.setattr(tables, "jdbc_options", lambda url, table, properties=None, **o: seen.append((table, o)) or plain(url, table, properties, **o))
    churn.run(spark, churn.RunConfig(str(tmp_path), with_training=False, with_tables=False, table_prefix="p_",
                                     database=tables.Database("jdbc:none", {"user": "u"}, connections=3)), raw)
    assert [t for t, _ in seen] == ["p_" + schema.RAW_TABLE, "p_" + schema.CLEANED_TABLE] and len(caught) == 2
    assert all("numPartitions" not in o for _, o in seen)


def test_unreachable_database_is_no_source(spark, featured, tmp_path):
    path = str(tmp_path / "processed")
    files.write_csv(featured, path)
    database = tables.Database("jdbc:nothing://nowhere/x", slices=None)
    candidates = [tables.Source("database", "jdbc", "t", database), tables.Source("processed", "csv", path)]
    assert tables.resolve_source(spark, candidates)[1] == "processed"


def test_dotted_names_from_file_to_export(spark, raw, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    dotted = raw.withColumn("PaymentMethod", F.when(F.col("PaymentMethod") == "Mailed check", "Co. card").otherwise(F.col("PaymentMethod")))
    files.write_csv(dotted.withColumn("plan.code", F.lit("a.b")), source)
    rows = churn.transform(files.read_raw(spark, source))
    assert "PaymentMethod_Co. card" in rows.columns and "plan.code" in rows.columns
    scored = learning.add_risk(rows.withColumn("score", F.lit(0.9)))
    offered = offers.recommend(scored)
    files.export(offered, ["customerID", "plan.code", "PaymentMethod_Co. card", "OfferID"], out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["customerID", "plan.code", "PaymentMethod_Co. card", "OfferID"] and back.count() == 5
    assert {r["PaymentMethod_Co. card"] for r in back.collect()} == {"true", "false"}


def test_intermediate_tables_are_removed(spark, raw, tmp_path):
    import os

    from loyalscope import session

    start = session.written_so_far()
    one, two = session.written(raw, "one"), session.written(raw, "two")
    assert one.count() == two.count() == 5
    path = session.last_written()
    session.cleanup(spark, start, keep=[path])
    assert session.written_so_far() == start + 1 and os.path.exists(path)
    session.cleanup(spark, start)
    assert session.written_so_far() == start and not os.path.exists(path)


def test_late_rows_count_by_arrival(spark):
    log = spark.createDataFrame([(1, "10:00"), (2, "09:00"), (3, "11:00"), (4, "08:00")], "id int, at string")
    assert [r["id"] for r in segments.latest_n(log, "at", "id", 2).collect()] == [3, 4]


def test_access_log(spark, tmp_path):
    path = tmp_path / "log.csv"
    assert eventlog.read_access_log(spark, str(path)).count() == 0
    path.write_text("timestamp,username,role,event,detail,ip\n"
                    "2026-05-15 11:09:38,ann,admin,LOGIN_SUCCESS,,localhost\n"
                    "2026-05-15 11:18:08,ann,admin,PAGE_VIEW,Executive Dashboard,localhost\n"
                    "2026-05-15 11:19:00,bob,user,LOGIN_FAILED,\"a, b\",localhost\n")
    log = eventlog.read_access_log(spark, str(path))
    assert log.schema == schema.ACCESS_LOG
    counters = {"logins_ok": "LOGIN_SUCCESS", "logins_failed": "LOGIN_FAILED", "page_views": "PAGE_VIEW"}
    assert tuple(reports.event_counters(log, counters).first()) == (3, 1, 1, 1)
    latest = segments.last_n(log, ["timestamp"], 2).orderBy(F.desc("timestamp")).collect()
    assert [r["username"] for r in latest] == ["bob", "ann"] and latest[0]["detail"] == "a, b"


def test_metrics_document(spark, tmp_path):
    metrics = spark.createDataFrame(
        [("A", 0.75, 0.5, 0.25, 0.3333, 0.8, 7, 1, 2, 3), ("B", 0.5, 0.5, 0.5, 0.5, 0.7, 1, 2, 3, 4)],
        "model string, accuracy double, precision double, recall double, f1 double, roc_auc double, tn long, fp long, fn long, tp long")
    weights = spark.createDataFrame([("x", 0.7), ("y", 0.3)], "feature string, importance double")
    path = str(tmp_path / "metrics")
    assert artifacts.read_metrics(spark, path) is None
    artifacts.write_metrics(artifacts.metrics_document(metrics, weights, "A"), path)
    stored = artifacts.read_metrics(spark, path)
    assert {r["model"]: r["is_best"] for r in stored.models.collect()} == {"A": True, "B": False}
    assert same_rows(stored.models.drop("is_best"), metrics)
    assert same_rows(stored.importance, weights)


def test_metrics_document_written_elsewhere(spark, tmp_path):
    path = tmp_path / "metrics.json"
    path.write_text(json.dumps({
        "best_model": "Second", "feature_importance": {"height": 0.75, "width": 0.25},
        "model_results": {"Second": {"accuracy": 0.9, "precision": 0.8, "recall": 0.8, "f1": 0.8,
                                     "roc_auc": 0.95, "confusion_matrix": [[14, 1], [1, 4]]}}}, indent=2))
    stored = artifacts.read_metrics(spark, str(path))
    row = stored.models.first()
    assert (row["model"], row["tn"], row["fp"], row["fn"], row["tp"], row["is_best"]) == ("Second", 14, 1, 1, 4, True)
    assert artifacts.top_features(stored.importance, 1).first()["feature"] == "height"


def test_shared_folder_is_the_session_setting(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# Whole runs

SMALL = {"LogisticRegression": {"maxIter": 20}}


def test_whole_run(spark, tmp_path):
    from loyalscope.catalogue.base import raw as staged_raw
    raw = staged_raw(spark, "/root/testdata/sf0.001")
    source = str(tmp_path / "in")
    files.write_csv(raw, source)
    config = churn.RunConfig(str(tmp_path / "out"), source=source, models=("LogisticRegression",), model_settings=SMALL,
                             with_light_run=True, table_prefix=f"t{uuid.uuid4().hex[:8]}_")
    result = churn.run(spark, config)
    assert result.scored and result.final.count() == raw.count() == 150
    for c in ("ChurnProbability", "ChurnRisk", "WillChurn_Predicted", "OfferID", "OfferAction"):
        assert c in result.final.columns
    assert spark.table(config.table_prefix + schema.CLEANED_TABLE).count() == 150
    assert artifacts.read_metrics(spark, config.path("metrics")).models.first()["model"] == "LogisticRegression"
    assert {(r["topic"], r["name"]): r["count"] for r in result.intake.collect()}[("rows", "total")] == 150
    assert {r["check"] for r in result.report.collect()} == {"no_missing_values", "no_duplicate_rows", "label_is_integer"}
    # the model stays for runs without training
    scores = lambda run: sorted(map(tuple, run.final.select("customerID", "ChurnProbability").collect()))
    first = scores(result)
    again = churn.run(spark, churn.RunConfig(config.folder, source=source, with_training=False, with_tables=False))
    assert again.scored and scores(again) == first


def test_run_without_a_model_loads_unscored_rows(spark, raw, tmp_path):
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    result = churn.run(spark, churn.RunConfig(str(tmp_path), with_training=False, table_prefix=prefix), raw)
    assert not result.scored and "OfferID" not in result.final.columns
    assert spark.table(prefix + schema.CLEANED_TABLE).count() == 5


def test_light_run(spark, raw, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    files.write_csv(raw, source)
    churn.light_run(spark, source, target)
    rows = by_key(spark.read.option("header", True).csv(target))
    assert rows["di"]["TotalCharges"] == "0.0" and rows["ed"]["ChurnFlag"] == "1"
