"""MLlib pipelines: forecast, colour words, value bands, forests and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.colour import WORD_RGB, lab_to_rgb, rgb_to_lab
from ..session import cut_lineage
from ..sources.readers import grid
from .features import cluster_size_score, sparse_features, standardise
from .resample import hash_folds
from .sports import VALUE_BANDS
from .relational import cast_columns, first_band

# Inputs of the value-band classifier and the two network shapes.
BAND_INPUTS = (
    "age", "weight_kg", "overall", "pace", "physic", "agility", "stamina", "aggression",
    "passing", "shooting", "defending", "dribbling",
)
BAND_LAYERS = [len(BAND_INPUTS), 130, 6]
COLOUR_LAYERS = [3, 30, 11]


def train_forecast(pairs: DataFrame, with_yesterday: bool = True, depth: int = 8) -> PipelineModel:
    """Next maximum from place, day of the year and, if wanted, the day before."""
    inputs = ["latitude", "longitude", "elevation", "dy"] + (["yesterday_tmax"] if with_yesterday else [])
    passed = ", ".join(c for c in inputs if c != "dy")
    statement = f"SELECT station, date, {passed}, dayofyear(date) AS dy, tmax FROM __THIS__"
    stages = [
        SQLTransformer(statement=statement),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        DecisionTreeRegressor(featuresCol="features", labelCol="tmax", maxDepth=depth, seed=1),
    ]
    return Pipeline(stages=stages).fit(pairs)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def train_colours(df: DataFrame, space: str = "rgb", max_iter: int = 100) -> PipelineModel:
    """Colour word from RGB or LAB coordinates by a small network."""
    lab = space == "lab"
    stages = [
        VectorAssembler(inputCols=["labL", "labA", "labB"] if lab else ["R", "G", "B"], outputCol="features"),
        StringIndexer(inputCol="word", outputCol="label", handleInvalid="keep"),
        MultilayerPerceptronClassifier(layers=COLOUR_LAYERS, maxIter=max_iter, seed=1),
    ]
    data = rgb_to_lab(df, keep=tuple(c for c in df.columns if c not in "RGB")) if lab else df
    return Pipeline(stages=stages).fit(data)


def predict_grid(model: PipelineModel, spark: SparkSession, light: float = 70.0, resolution: int = 256, space: str = "rgb") -> DataFrame:
    """Predicted word and its display colour over a slice of LAB space."""
    labels = next(s for s in model.stages if isinstance(s, StringIndexerModel)).labels
    plane = grid(spark, {"labL": (light, light, 1), "labA": (-100, 100, resolution), "labB": (-100, 100, resolution)})
    rgb = lab_to_rgb(plane, keep=("labL", "labA", "labB")).withColumn("word", F.lit(labels[0]))
    known = IndexToString(inputCol="prediction", outputCol="predicted", labels=[*labels, *["unknown"] * (COLOUR_LAYERS[-1] - len(labels))])
    words = known.transform(model.transform(rgb))
    shown = spark.createDataFrame([(w, *c) for w, c in WORD_RGB.items()], "predicted string, show_r int, show_g int, show_b int")
    # the table of colour words is a constant
    return words.join(F.broadcast(shown), "predicted", "left").select("labA", "labB", "R", "G", "B", "predicted", "show_r", "show_g", "show_b")


def band_table(players: DataFrame) -> DataFrame:
    """Complete players with the value band as label."""
    typed = cast_columns(players, BAND_INPUTS).dropna(subset=[*BAND_INPUTS, "value_eur"])
    return typed.withColumn("value_range", first_band("value_eur", VALUE_BANDS))


def train_value_bands(df: DataFrame, max_iter: int = 500) -> PipelineModel:
    stages = [
        VectorAssembler(inputCols=list(BAND_INPUTS), outputCol="features"),
        MultilayerPerceptronClassifier(layers=BAND_LAYERS, labelCol="value_range", maxIter=max_iter, seed=1),
    ]
    return Pipeline(stages=stages).fit(df)


def train_forest(df: DataFrame, features: Sequence[str], label: str, trees: int = 100) -> PipelineModel:
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestRegressor(labelCol=label, numTrees=trees, seed=1),
    ]
    return Pipeline(stages=stages).fit(df)


def cv_auc(df: DataFrame, features: Sequence[str], label: str, id: str, folds: int = 3, trees: int = 400) -> DataFrame:
    """Area under the ROC curve of a forest on each hash fold."""
    data = hash_folds(VectorAssembler(inputCols=list(features), outputCol="features").transform(df), [id], folds, 1)
    data = data.select("features", F.col(label).cast("double").alias("label"), "fold").persist()
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC")
    try:
        scores = []
        for f in range(folds):
            model = RandomForestClassifier(numTrees=trees, seed=1).fit(data.where(F.col("fold") != f))
            scores.append((f, float(evaluator.evaluate(model.transform(data.where(F.col("fold") == f))))))
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(scores, "fold int, auc double")


def train_black_box(df: DataFrame, kind: str = "gbt", inputs: int | None = None):
    """Gradient-boosted trees, a network, or logistic regression on ``features`` and ``label``."""
    if kind == "gbt":
        return GBTClassifier(maxIter=20, seed=1).fit(df)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(layers=[inputs, 10, 2], maxIter=100, seed=1).fit(df)
    return LogisticRegression(maxIter=100, regParam=0.001).fit(df)


def feature_importances(model, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """Importance per input of a tree model (the last stage of a pipeline)."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(n, float(v)) for n, v in zip(names, tree.featureImportances.toArray(), strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double")


def detect(df: DataFrame, categories: Sequence[str], numbers: Sequence[str], id: str, k: int = 8, threshold: float = 0.97, seed: int = 1) -> DataFrame:
    """Rows in unusually small clusters: encode, standardise, cluster, score by cluster size."""
    scaled = standardise(df.select(id, *categories, *numbers), numbers)
    vectors = cut_lineage(sparse_features(scaled, categories, numbers, id))  # read once per iteration
    labelled = cut_lineage(KMeans(k=k, seed=seed).fit(vectors).transform(vectors).select(id, F.col("prediction").alias("cluster")))
    return cluster_size_score(labelled, "cluster").where(F.col("score") >= threshold).select(id, "score")
