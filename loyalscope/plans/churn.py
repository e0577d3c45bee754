"""Raw subscribers to model-ready, scored and recommended rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from loyalscope import schema
from loyalscope.functions import binary_code, flag, revenue_category
from loyalscope.operators import cleaning, evaluation, features, learning, offers, quality
from loyalscope.operators.formulas import Formula
from loyalscope.session import cleanup, last_written, written, written_so_far
from loyalscope.sources import artifacts, files, tables


def one_hot_levels(raw: DataFrame, max_levels: int = features.MAX_LEVELS) -> dict[str, list]:
    """The values the one-hot columns have in the data, from one narrow scan; more than ``max_levels`` are an error."""
    return features.find_levels(cleaning.trim_strings(raw.select(*schema.LEVELS)), list(schema.LEVELS), max_levels)


def encode(cleaned: DataFrame, levels: dict | None = None) -> DataFrame:
    """0/1 codes, one-hot columns with the three label columns kept, and the tenure group.

    Without ``levels`` the one-hot values are taken from the data, at the cost of one job.
    """
    codes = {"gender": schema.GENDER, **{c: schema.YES_NO for c in schema.YES_NO_COLUMNS}}
    out = cleaned.withColumn("Churn", binary_code(F.col("Churn"), schema.YES_NO))
    out = features.encode_binary(out, codes)
    out = features.one_hot(out, list(schema.LEVELS), levels, keep=schema.LABEL_COLUMNS)
    return features.bin_column(out, "tenure", schema.TENURE_EDGES, schema.TENURE_LABELS, "tenure_group")


def engineer(encoded: DataFrame, max_from: DataFrame | None = None) -> DataFrame:
    """Revenue category, annual revenue and loyalty score."""
    out = encoded.withColumns({
        "RevenueCategory": revenue_category(F.col("MonthlyCharges")),
        "AnnualRevenue": F.col("MonthlyCharges") * 12,
    })
    return features.normalise_by_max(out, "tenure", "LoyaltyScore", max_from=max_from)


def transform(raw: DataFrame, levels: dict | None = None, approx: bool = False,
              max_levels: int = features.MAX_LEVELS) -> DataFrame:
    """Clean, encode and engineer as one lazy plan.

    Dropping duplicates changes neither the longest tenure nor the set of values to encode, so both
    are read off the raw rows: few columns, no shuffle of whole rows. Give ``levels`` (for instance
    ``schema.LEVELS``) for columns that do not depend on the data, and to save that job.
    """
    levels = levels or one_hot_levels(raw, max_levels)
    return engineer(encode(cleaning.clean(raw, approx=approx), levels), max_from=raw)


def light_transform(raw: DataFrame) -> DataFrame:
    """The shorter transformation: blanks as 0, lenient flags, open-ended tenure groups."""
    out = cleaning.blank_to(raw, "TotalCharges", 0.0).withColumns({
        "ChurnFlag": flag(F.col("Churn"), "Yes"),
        "gender_encoded": flag(F.col("gender"), "Male"),
        "RevenueCategory": revenue_category(F.col("MonthlyCharges"), missing="High"),
    })
    return features.bin_column(out, "tenure", schema.TENURE_EDGES, schema.TENURE_LABELS, "tenure_group", open_ends=True)


def light_run(spark: SparkSession, source: str, target: str, fmt: str = "csv") -> DataFrame:
    """Read, transform lightly, write CSV; returns the plan that was written."""
    out = light_transform(files.read_raw(spark, source, fmt))
    files.write_csv(out, target)
    return out


@dataclass
class Training:
    models: dict[str, PipelineModel]
    metrics: DataFrame
    best: str
    importance: DataFrame
    metrics_path: str = ""

    @property
    def model(self) -> PipelineModel:
        return self.models[self.best]


def train(rows: DataFrame, models=tuple(learning.MODELS), settings: dict | None = None,
          seed: int = learning.SEED, fitted: dict[str, PipelineModel] | None = None,
          partitions: int | None = None) -> Training:
    """Prepare, split, fit, evaluate and choose; models already ``fitted`` on the same rows are taken as they are.

    The prepared rows are written once, because the split reads them several times, and so are the
    held-out scores, which the metrics read three times. Of what was written on the way only the metrics
    stay, as the result reads them.
    """
    start = written_so_far()
    prepared = learning.prepare(rows)
    training, test = learning.stratified_split(written(prepared.rows, "prepared"), seed=seed)
    missing = [m for m in models if m not in (fitted or {})]
    every = {**(fitted or {}), **learning.fit_models(training, prepared.features, missing, settings, seed, partitions)}
    every = {m: every[m] for m in models}
    scores = written(learning.predictions(every, test), "held-out")
    metrics = written(evaluation.evaluate(scores), "metrics")
    path = last_written()
    cleanup(rows.sparkSession, start, keep=[path])
    best = evaluation.select_best(metrics, models).first()["model"]
    return Training(every, metrics, best, learning.importance(every[best], rows.sparkSession), path)


def score_profiles(profiles: DataFrame, model: PipelineModel | Formula) -> DataFrame:
    """Features, score and offer for raw profiles of any number, as a prediction form would give them."""
    return offers.recommend(learning.score(features.profile_features(profiles), model, fill="zero"), with_priority=True)


@dataclass
class RunConfig:
    """One run. Leave out a path to skip that output; ``source`` may be a path or come as ``raw``."""

    folder: str
    source: str | None = None
    source_format: str = "csv"
    with_training: bool = True
    with_tables: bool = True
    with_light_run: bool = False
    table_prefix: str = ""
    model_settings: dict[str, dict[str, Any]] = field(default_factory=dict)
    models: tuple[str, ...] = tuple(learning.MODELS)
    training_partitions: int | None = None
    levels: dict[str, list] | None = None  # one-hot values; None takes them from the data
    max_levels: int = features.MAX_LEVELS  # so many one-hot columns at most, or the run fails
    database: tables.Database | None = None  # both tables go there as well
    approx: bool = False

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"


@dataclass
class RunResult:
    final: DataFrame
    intake: DataFrame
    report: DataFrame
    training: Training | None
    scored: bool


def run(spark: SparkSession, config: RunConfig, raw: DataFrame | None = None) -> RunResult:
    """Extract, transform, train, score, recommend and load.

    The transformed rows are written once and read back by training, scoring and loading, which
    also keeps the run restartable when executors are lost. Without a trained model scoring is
    skipped and the transformed rows are loaded. All results are read from the run's folder; other tables
    written on the way are removed, but for the metrics of the training.
    """
    start = written_so_far()
    if raw is None:
        raw = files.read_raw(spark, config.source, config.source_format)
    # rows, gaps and labels are counted while the rows are written
    raw, seen = quality.watched(files.require_columns(raw, schema.RAW.fieldNames()), schema.LABEL, list(schema.YES_NO))
    raw = files.snapshot(raw, config.path("backup"))

    made, seen_made = quality.watched(transform(raw, config.levels, config.approx, config.max_levels))
    files.write_parquet(made, config.path("processed"))
    processed = spark.read.parquet(config.path("processed"))
    # written, so that a later run into the same folder can't change what this one found
    files.write_parquet(quality.intake_report(raw, schema.LABEL, seen), config.path("intake"))
    files.write_parquet(quality.validate(processed, schema.LABEL, seen_made), config.path("report"))
    intake, report = (spark.read.parquet(config.path(name)) for name in ("intake", "report"))

    training = None
    if config.with_training:
        training = train(processed, config.models, config.model_settings, partitions=config.training_partitions)
        artifacts.save_model(training.model, config.path("model"))
        document = artifacts.metrics_document(training.metrics, training.importance, training.best)
        artifacts.write_metrics(document, config.path("metrics"))

    try:
        model = artifacts.load_model(spark, config.path("model"))
    except FileNotFoundError:
        final, scored = processed, False
    else:
        files.write_parquet(offers.recommend(learning.score(processed, model, approx=config.approx)), config.path("scored"))
        final, scored = spark.read.parquet(config.path("scored")), True

    if config.with_tables:
        tables.load_tables(final, raw, config.table_prefix, config.path("tables"))
    if config.database:
        tables.load_database(final, raw, config.database, config.table_prefix)
    if config.with_light_run:
        files.write_csv(light_transform(raw), config.path("light"))
    cleanup(spark, start, keep=[training.metrics_path] if training else [])
    return RunResult(final, intake, report, training, scored)
