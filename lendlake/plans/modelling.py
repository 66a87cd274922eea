"""Training, scoring and evaluation of the default model."""

from __future__ import annotations

from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake import schemas as S
from lendlake.functions.dates import as_date
from lendlake.operators.metrics import auc, auc_of_counts, score_counts
from lendlake.sources.store import Store

HOLDOUT = ["test", "val"]
MANIFEST = ["model_name", "model_dir", "run_date", "split", "auc", "preds_path"]


def fit_model(train: DataFrame, features: list[str] | None = None, max_iter: int = 50) -> PipelineModel:
    """Median imputation, standard scaling and a binomial logistic regression.

    The stages pass over ``train`` several times, so it should be a written table.
    A feature without any value has no median and is left out.
    """
    features = features or S.MODEL_FEATURES
    values = train.agg(*[F.count(c).alias(c) for c in features]).first()
    features = [c for c in features if values[c] > 0]
    filled = [f"{c}_filled" for c in features]
    stages = [
        Imputer(strategy="median", inputCols=features, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(labelCol="label", featuresCol="features", maxIter=max_iter),
    ]
    model = Pipeline(stages=stages).fit(train.select("label", *features))
    # The training summary holds the session, which cannot go to tasks once a write of the session has been observed.
    model.stages[-1]._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return model


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Probability of default and hard prediction for every row."""
    scored = model.transform(rows).withColumn("probability", vector_to_array("probability")[1])
    keep = ["loan_id", "snapshot_date", "label", "probability", "prediction"]
    return scored.select(*keep, *[c for c in ("split",) if c in rows.columns])


def evaluate(predictions: DataFrame) -> DataFrame:
    """Exact area under the curve of each set."""
    return auc(predictions, "label", "probability", ["split"])


def manifest_rows(
    predictions: DataFrame, model_name: str, model_dir: str, run_date: date | str, preds_path: str
) -> DataFrame:
    """One row per set: which model scored it, when, how well, and where the rows are."""
    return manifest_lines(evaluate(predictions), model_name, model_dir, run_date, preds_path)


def manifest_lines(areas: DataFrame, model_name: str, model_dir: str, run_date: date | str, preds_path: str) -> DataFrame:
    return areas.select(
        F.lit(model_name).alias("model_name"),
        F.lit(model_dir).alias("model_dir"),
        F.lit(as_date(run_date)).alias("run_date"),
        "split",
        "auc",
        F.lit(preds_path).alias("preds_path"),
    )


def training_manifest(manifest: DataFrame) -> DataFrame:
    """Test and validation area of each training run, side by side."""
    areas = [F.max(F.when(F.col("split") == name, F.col("auc"))).alias(f"auc_{name}") for name in HOLDOUT]
    return manifest.groupBy("model_dir", F.col("run_date").alias("trained_on")).agg(*areas)


def run_folder(model_name: str, run_date: date | str) -> str:
    """Partition folder of one model run."""
    return f"model_name={model_name}/run_date={as_date(run_date).isoformat()}"


def train(store: Store, run_date: date | str, model_name: str = "logistic", max_iter: int = 50) -> str:
    """Fit on the ``train`` set, save the model, record its holdout areas in the manifest, and return its path."""
    rows = store.read("gold", "splits").where(F.col("split") == "train")
    model_dir = f"{store.root}/model_bank/{model_name}_{as_date(run_date):%Y_%m_%d}"
    fit_model(rows, max_iter=max_iter).write().overwrite().save(model_dir)
    score_sets(store, model_dir, run_date, model_name)
    return model_dir


def run_predictions(store: Store, model_name: str, run_date: date | str, sets: list[str] | None = None) -> DataFrame:
    """What one run has predicted for the chosen sets."""
    rows = store.read("gold", "predictions")
    own = (F.col("model_name") == model_name) & (F.col("run_date") == F.lit(as_date(run_date)))
    return rows.where(own & F.col("split").isin(sets or HOLDOUT))


def run_counts(store: Store, model_name: str, run_date: date | str, sets: list[str] | None = None) -> DataFrame:
    """Bads and goods by snapshot and distinct score of what one run has predicted."""
    own = (F.col("model_name") == model_name) & (F.col("run_date") == F.lit(as_date(run_date)))
    return store.read("gold", "score_counts").where(own & F.col("split").isin(sets or HOLDOUT))


def score_sets(
    store: Store, model_dir: str, run_date: date | str, model_name: str = "logistic", sets: list[str] | None = None
) -> DataFrame:
    """Score the chosen sets, write predictions and manifest of this run, and return the manifest.

    Predictions and manifest rows belong to model, run date and set; other runs keep theirs. A set without rows has
    neither, also if an earlier call wrote some.
    """
    sets = sets or HOLDOUT
    rows = store.read("gold", "splits").where(F.col("split").isin(sets))
    return record(store, score(PipelineModel.load(model_dir), rows), model_dir, run_date, model_name, sets)


def record(
    store: Store, scored: DataFrame, model_dir: str, run_date: date | str, model_name: str = "logistic", sets: list[str] | None = None
) -> DataFrame:
    """Predictions of one run (columns of ``score``, with split) into the store, with their score counts and manifest rows; the manifest.

    The counts are a row per set, snapshot and distinct score. They are read from the predictions once; every area, of the manifest,
    of a snapshot or of any range of snapshots, comes from them.
    """
    sets = sets or HOLDOUT
    named = {"model_name": F.lit(model_name), "run_date": F.lit(as_date(run_date))}
    scored = scored.where(F.col("split").isin(sets)).withColumns(named)
    own = [f"{run_folder(model_name, run_date)}/split={name}" for name in sets]
    keys = ("model_name", "run_date", "split")
    store.write(scored, "gold", "predictions", partition_by=(*keys, S.SNAPSHOT), aligned=True, own=own)
    predictions = run_predictions(store, model_name, run_date, sets)
    counts = score_counts(predictions, "label", "probability", [*keys, S.SNAPSHOT])
    store.write(counts, "gold", "score_counts", partition_by=(*keys, S.SNAPSHOT), own=own)
    folder = f"{store.path('gold', 'predictions')}/{run_folder(model_name, run_date)}"
    areas = auc_of_counts(run_counts(store, model_name, run_date, sets), ["split"])
    lines = manifest_lines(areas, model_name, model_dir, run_date, folder)
    lines = lines.withColumn("preds_path", F.concat("preds_path", F.lit("/split="), "split"))
    store.write(lines, "gold", "model_manifest", partition_by=keys, own=own)
    return store.read("gold", "model_manifest")
