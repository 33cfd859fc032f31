"""Churn model: encoding, training, evaluation, scoring, risk segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions import cut
from stayline.operators.metrics import class_balance, classification_report, confusion_matrix
from stayline.operators.quantile import quantile_values
from stayline.operators.split import stratified_split
from stayline.sources.staging import checkpoint_root, stage

# Model inputs and settings, risk limits.
MODEL_FEATURES = (
    "frequency",
    "monetary",
    "avg_review_score",
    "min_review_score",
    "late_delivery_pct",
    "late_delivery_count",
    "category_diversity",
    "avg_installments",
    "avg_items_per_order",
    "avg_freight_paid",
    "top_category_encoded",
)
# Inputs that may be missing, and the columns the learner reads in their place.
FILLED = {
    c: f"{c}_input" for c in ("avg_freight_paid", "avg_review_score", "min_review_score", "monetary")
}
MISSING = {c: f"{c}_missing" for c in FILLED}
TARGET = "is_churned"
TREES = 300
DEPTH = 5
LEARNING_RATE = 0.05
ROW_SAMPLE = 0.8
COLUMN_SAMPLE = "0.8"
TEST_SHARE = 0.2
SEED = 42
THRESHOLD = 0.5
RISK_EDGES = (0, 40, 65, 80, 100)
RISK_LABELS = ("Low", "Medium", "High", "Critical")


def risk_segment(score: Column) -> Column:
    return cut(score, RISK_EDGES, RISK_LABELS)


def category_encoder(features: DataFrame) -> PipelineModel:
    """Adds ``top_category_encoded``: 0..n-1 in alphabetical order, n for any other.

    The code is a plain number, as the trees split it by size. Labels are as
    many as there are categories, so they fit the driver.
    """
    indexer = StringIndexer(
        inputCol="top_category",
        outputCol="top_category_index",
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    ).fit(features)
    as_number = SQLTransformer(
        statement="SELECT *, CAST(top_category_index AS INT) AS top_category_encoded FROM __THIS__"
    )
    return PipelineModel([indexer, as_number])


class GapFiller(Estimator):
    """Fits, on the rows it is given, what stands for a missing model input.

    The learner needs a number everywhere: the fitted stage adds a copy of every input that may be
    NULL, gaps filled with the median of those rows. For inputs that have gaps there, it also adds a
    0/1 column that says where, so that the trees can tell a missing value from a median one. The
    columns themselves stay as they are.
    """

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        medians = quantile_values(dataset, list(FILLED), 0.5)
        counts = dataset.agg(*[F.count_if(F.col(c).isNull()) for c in FILLED]).first()
        added = [f"COALESCE(CAST({c} AS DOUBLE), {float(m or 0.0)!r}D) AS {FILLED[c]}" for c, m in zip(FILLED, medians)]
        added += [f"CAST({c} IS NULL AS INT) AS {MISSING[c]}" for c, n in zip(FILLED, counts) if n]
        return SQLTransformer(statement=f"SELECT *, {', '.join(added)} FROM __THIS__")


def category_codes(features: DataFrame) -> DataFrame:
    encoded = category_encoder(features).transform(features.select("top_category"))
    return encoded.select("top_category", "top_category_encoded").distinct()


@dataclass(frozen=True)
class TrainedChurn:
    """Fitted stages, and the held-out rows with probability and prediction."""

    model: PipelineModel
    held_out: DataFrame

    def auc(self) -> float:
        return BinaryClassificationEvaluator(
            labelCol=TARGET, rawPredictionCol="churn_probability", numBins=0
        ).evaluate(self.held_out)

    def report(self) -> DataFrame:
        return classification_report(self.held_out, TARGET, "predicted")

    def confusion(self) -> DataFrame:
        return confusion_matrix(self.held_out, TARGET, "predicted")

    def importance(self) -> DataFrame:
        return feature_importance(self.model)


def train(features: DataFrame, trees: int = TREES, positive_weight: float | None = None) -> TrainedChurn:
    """Fit on 80 % of the rows. ``features`` is read several times: pass a stored table.

    The encoder's labels and the class weight come from all rows; what stands for gaps, and the
    trees, from the training rows. Boosting cuts its lineage in the checkpoint folder.
    """
    spark = features.sparkSession
    checkpoint_root(spark)
    encoder = category_encoder(features)
    if positive_weight is None:
        positive_weight = class_balance(features, TARGET).first()["positive_weight"]
    if not positive_weight:
        raise ValueError("training needs both churned and active customers")

    weight = F.when(F.col(TARGET) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
    split = stratified_split(features, TARGET, "customer_unique_id", TEST_SHARE, SEED)
    split = stage(split, "split_features")
    encoded = encoder.transform(split.where(~F.col("is_test")))
    filler = GapFiller().fit(encoded)
    training = filler.transform(encoded)
    inputs = [FILLED.get(c, c) for c in MODEL_FEATURES] + [c for c in MISSING.values() if c in training.columns]
    assembler = VectorAssembler(inputCols=inputs, outputCol="inputs")
    training = assembler.transform(training)
    trees_model = GBTClassifier(
        featuresCol="inputs",
        labelCol=TARGET,
        weightCol="row_weight",
        maxIter=trees,
        maxDepth=DEPTH,
        stepSize=LEARNING_RATE,
        subsamplingRate=ROW_SAMPLE,
        featureSubsetStrategy=COLUMN_SAMPLE,
        seed=SEED,
    ).fit(training.select("inputs", TARGET, weight.alias("row_weight")))

    model = PipelineModel([*encoder.stages, filler, assembler, trees_model])
    # Three reports read the held-out predictions.
    return TrainedChurn(model, stage(predict(model, split.where("is_test")), "held_out"))


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Features with the encoded category, churn probability and 0/1 prediction."""
    probability = vector_to_array("probability")[1]
    return (
        model.transform(features)
        .withColumn("churn_probability", probability)
        .withColumn("predicted", (F.col("churn_probability") >= THRESHOLD).cast("int"))
        .drop("top_category_index", "inputs", "rawPrediction", "probability", "prediction")
        .drop(*FILLED.values(), *MISSING.values())
    )


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Features, encoded category, score 0-100 with one decimal, risk segment."""
    scored = predict(model, features).withColumn(
        "churn_risk_score", F.bround(F.col("churn_probability") * 100, 1)
    )
    return scored.drop("churn_probability", "predicted").withColumn(
        "risk_segment", risk_segment(F.col("churn_risk_score"))
    )


def feature_importance(model: PipelineModel, k: int | None = None) -> DataFrame:
    """Model inputs by importance, highest first; an input and whether it is missing count as one."""
    feature = {added: c for names in (FILLED, MISSING) for c, added in names.items()}
    sums = dict.fromkeys(MODEL_FEATURES, 0.0)
    for name, value in zip(model.stages[-2].getInputCols(), model.stages[-1].featureImportances):
        sums[feature.get(name, name)] += float(value)
    spark = SparkSession.getActiveSession()
    ranked = spark.createDataFrame(list(sums.items()), "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return ranked if k is None else ranked.limit(k)


def segment_distribution(scored: DataFrame) -> DataFrame:
    return (
        scored.where(F.col("risk_segment").isNotNull())
        .groupBy("risk_segment")
        .agg(F.count("*").alias("customers"))
        .orderBy(F.desc("customers"), "risk_segment")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
