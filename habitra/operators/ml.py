"""Datasets, splits, models, scores and metrics."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habitra.operators.gold import numbered
from habitra.operators.occurrences import hash_order

TARGETS = {"PRESENT": 1, "ABSENT": 0}


def encode_target(status: Column) -> Column:
    """PRESENT 1, ABSENT 0; anything else raises."""
    out = F.when(status == "PRESENT", 1).when(status == "ABSENT", 0)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown status: "), F.coalesce(status, F.lit("NULL")))).cast("int"))


def suffixed_join(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_all", "_species")) -> DataFrame:
    """Inner join on the key, cut to a whole number; columns that both have get a suffix."""
    both = set(left.columns) & set(right.columns) - {key}
    a, b = (t.withColumn(key, F.col(key).cast("long")).withColumnsRenamed({c: c + s for c in both}) for t, s in zip((left, right), suffixes))
    return a.join(b, key)


def prepare(left: DataFrame, right: DataFrame, key: str, target: str, drop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Features and encoded targets, each with the key: join, rows with missing values dropped, then columns dropped."""
    joined = suffixed_join(left, right, key).na.drop("any")
    missing = set(drop) - set(joined.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    rows = joined.drop(*drop)
    return rows.drop(target), rows.select(key, encode_target(F.col(target)).alias(target))


def split(df: DataFrame, train: float, validation: float | None = None, key: str = "id") -> DataFrame:
    """``part`` train, validation or test by places in hash order; validation is a share of the whole."""
    ranked = numbered(df.withColumn("_h", hash_order(F.col(key))), ["_h", key], "_i").drop("_h")
    total = df.agg(F.count("*").alias("_n"))
    first = F.floor(F.lit(train) * F.col("_n"))
    part = F.when(F.col("_i") < first, "train")
    if validation is not None:
        rest = F.col("_n") - first
        part = part.when(F.col("_i") < first + F.floor(F.lit(validation / (1 - train)) * rest), "validation")
    return ranked.crossJoin(F.broadcast(total)).withColumn("part", part.otherwise("test")).drop("_i", "_n")


def confusion_matrix(df: DataFrame, truth: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """``truth, predicted, n`` for all pairs of classes."""
    counts = df.agg(*[F.count_if((F.col(truth) == t) & (F.col(predicted) == p)).alias(f"{t}_{p}") for t in classes for p in classes])
    cells = F.explode(F.array(*[F.struct(F.lit(t).alias("truth"), F.lit(p).alias("predicted"), F.col(f"{t}_{p}").alias("n")) for t in classes for p in classes]))
    return counts.select(cells.alias("c")).select("c.*")


def classification_report(df: DataFrame, truth: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """``label, precision, recall, f1, support`` of each class, and their plain and weighted means; undefined ratios are 0."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    t, p = F.col(truth), F.col(predicted)
    counts = df.agg(*[c for k in classes for c in (F.count_if((t == k) & (p == k)).alias(f"tp{k}"), F.count_if(p == k).alias(f"pp{k}"), F.count_if(t == k).alias(f"s{k}"))], F.count("*").alias("all"))
    rows, parts = [], []
    for k in classes:
        precision, recall = ratio(F.col(f"tp{k}"), F.col(f"pp{k}")), ratio(F.col(f"tp{k}"), F.col(f"s{k}"))
        f1 = ratio(2 * precision * recall, precision + recall)
        parts.append((precision, recall, f1, F.col(f"s{k}")))
        rows.append(F.struct(F.lit(str(k)).alias("label"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), F.col(f"s{k}").alias("support")))
    mean = lambda i, weighted: sum((x[i] * (x[3] if weighted else 1) for x in parts), F.lit(0.0)) / (F.col("all") if weighted else len(parts))
    for label, weighted in (("macro avg", False), ("weighted avg", True)):
        rows.append(F.struct(F.lit(label).alias("label"), *[mean(i, weighted).alias(n) for i, n in enumerate(("precision", "recall", "f1"))], F.col("all").alias("support")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def hard_auc(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """``roc_auc`` of labels rather than scores, and ``accuracy``."""
    t, p = F.col(truth), F.col(predicted)
    rate = lambda k: F.try_divide(F.count_if((t == k) & (p == k)), F.count_if(t == k))
    return df.agg(((rate(1) + rate(0)) / 2).alias("roc_auc"), F.try_divide(F.count_if(t == p), F.count("*")).alias("accuracy"))


def train(df: DataFrame, features: Sequence[str], target: str, trees: int = 20, depth: int = 4, seed: int = 1) -> PipelineModel:
    """Gradient-boosted trees over the features."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), GBTClassifier(labelCol=target, featuresCol="features", maxIter=trees, maxDepth=depth, seed=seed)]
    return Pipeline(stages=stages).fit(df)


#: What is searched, each between two ends, evenly or in logarithms: the leaves of a tree (as its depth, their logarithm), the rate of
#: learning, the least rows of a leaf, and two brakes: the share of rows and of gain that a tree or split needs.
SPACE = {"maxDepth": (5, 6, "int"), "stepSize": (0.08, 0.2, "log"), "minInstancesPerNode": (40, 300, "int"), "subsamplingRate": (0.5, 1.0, "even"), "minInfoGain": (1e-4, 1e-2, "log")}


def draw(space: dict[str, tuple[float, float, str]], evaluations: int, seed: int) -> list[dict[str, float]]:
    """Settings drawn at random from a space of (low, high, way) by parameter; the same seed gives the same ones."""
    r = random.Random(seed)
    ways = {"int": lambda a, b: r.randint(int(a), int(b)), "log": lambda a, b: math.exp(r.uniform(math.log(a), math.log(b))), "even": r.uniform}
    return [{name: ways[way](a, b) for name, (a, b, way) in space.items()} for _ in range(evaluations)]


def stratified_folds(df: DataFrame, target: str, folds: int, key: str | None = None, out: str = "fold") -> DataFrame:
    """Folds from 0 with equal shares of each class, to one row: numbers in hash order by class, modulo folds.

    The order is by the hash of ``key``, or of all columns.
    """
    by = F.xxhash64(key) if key else F.xxhash64(*df.columns)
    ranked = numbered(df.withColumns({"_t": F.col(target), "_h": by}), ["_t", "_h"], "_i")
    return ranked.withColumn(out, (F.col("_i") % folds).cast("int")).drop("_t", "_h", "_i")


def tune(df: DataFrame, features: Sequence[str], target: str, depths: Sequence[int] = (), rates: Sequence[float] = (), evaluations: int = 4, folds: int = 5, trees: int = 20, seed: int = 1, space: dict[str, tuple[float, float, str]] = SPACE) -> tuple[PipelineModel, list[dict]]:
    """The best model by cross-validated log loss over stratified folds, and each trial's settings and metric.

    Tried are ``evaluations`` random settings of the space, or the grid of
    ``depths`` and ``rates`` if these are given.
    """
    model = GBTClassifier(labelCol=target, featuresCol="features", maxIter=trees, seed=seed)
    drawn = [{"maxDepth": a, "stepSize": b} for a in depths for b in rates] if depths and rates else draw(space, evaluations, seed)
    grid = [{model.getParam(k): v for k, v in x.items()} for x in drawn]
    stages = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), model])
    folded = stratified_folds(df.select(*features, target), target, folds)
    loss = MulticlassClassificationEvaluator(labelCol=target, metricName="logLoss")
    found = CrossValidator(estimator=stages, estimatorParamMaps=grid, evaluator=loss, numFolds=folds, foldCol="fold").fit(folded)
    return found.bestModel, [x | {"metric": m} for x, m in zip(drawn, found.avgMetrics)]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """``ABSENT`` and ``PRESENT`` probabilities beside the kept columns."""
    p = vector_to_array("probability")
    return model.transform(df).select(*keep, p[0].alias("ABSENT"), p[1].alias("PRESENT"))


def assemble(rows: DataFrame, predictions: DataFrame, key: str, species: Sequence[str]) -> DataFrame:
    """Rows with one column of presence probabilities for each species, joined by key."""
    wide = predictions.groupBy(key).pivot("species", list(species)).agg(F.first("PRESENT"))
    return rows.join(wide, key, "left")
