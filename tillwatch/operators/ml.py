"""Spark ML ensemble: fit, save, load once, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, Imputer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwatch.operators.scoring import mean_probability

MEMBERS = ("boosted", "forest", "linear")
VARYING = "varying_features"


@dataclass(frozen=True)
class Ensemble:
    preprocessor: PipelineModel
    members: dict[str, PipelineModel]

    def save(self, path: str) -> None:
        self.preprocessor.write().overwrite().save(f"{path}/preprocessor")
        for name, model in self.members.items():
            model.write().overwrite().save(f"{path}/{name}")

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``fraud_probability``, the mean of the members' probabilities of class 1."""
        original = df.columns
        out = self.preprocessor.transform(df)
        for model in self.members.values():
            out = model.transform(out)
        members = [vector_to_array(F.col(f"{name}_probability"))[1] for name in self.members]
        return out.select(*original, mean_probability(members).alias("fraud_probability"))


def _bounded(rows: DataFrame, max_rows: int) -> DataFrame:
    """About ``max_rows`` of the rows if there are more, chosen by a hash of their content."""
    n = rows.count()
    if n <= max_rows:
        return rows
    return rows.filter(F.pmod(F.xxhash64(*rows.columns), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))


def fit_ensemble(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    trees: int = 20,
    depth: int = 5,
    seed: int = 7,
    max_rows: int | None = None,
    hash_width: int = 256,
) -> Ensemble:
    """Fit the preprocessor and the three classifiers on all labelled rows of ``df``, or on about ``max_rows`` if given.

    Categories are hashed into ``hash_width`` indicator columns. So there may be
    any number of them, no list of them is made, and the linear model sees them as
    indicators. Columns of a single value tell boosted trees and the linear model
    nothing and are left out for them, whose many passes carry each column; a
    forest draws its columns from all. ``df`` is read about ten times, so write
    it first if it is costly: each classifier keeps rows in a form of its own,
    on disk where memory ends, and no other copy of them is kept.
    """
    imputed = [f"{name}_filled" for name in numeric]
    stages = [Imputer(inputCols=list(numeric), outputCols=imputed, strategy="mean")]
    inputs = list(imputed)
    if categorical:
        stages.append(FeatureHasher(
            inputCols=list(categorical), outputCol="_categories", numFeatures=hash_width,
            categoricalCols=list(categorical)))
        inputs.append("_categories")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))

    rows = df.select(F.col(label).cast("double").alias("label"), *numeric, *categorical)
    if max_rows is not None:
        rows = _bounded(rows, max_rows)
    assembled = Pipeline(stages=stages).fit(rows)
    preprocessor = PipelineModel([*assembled.stages, _varying_only(assembled.transform(rows))])
    prepared = preprocessor.transform(rows).select("label", "features", VARYING)

    estimators = {
        "boosted": GBTClassifier(featuresCol=VARYING, maxIter=trees, maxDepth=depth, seed=seed),
        "forest": RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed),
        "linear": LogisticRegression(featuresCol=VARYING, maxIter=25, regParam=0.01),
    }
    for name, estimator in estimators.items():
        estimator.setProbabilityCol(f"{name}_probability")
        estimator.setRawPredictionCol(f"{name}_raw")
        estimator.setPredictionCol(f"{name}_prediction")
    members = {name: _without_summary(Pipeline(stages=[est]).fit(prepared)) for name, est in estimators.items()}
    return Ensemble(preprocessor, members)


def _varying_only(prepared: DataFrame) -> VectorSlicer:
    """Takes the features that have more than one value in ``prepared``; the first one if none has."""
    least, greatest = prepared.select(Summarizer.metrics("min", "max").summary(F.col("features")).alias("of")).select(
        "of.min", "of.max").first()
    varying = [i for i, (a, b) in enumerate(zip(least.toArray(), greatest.toArray())) if a != b]
    return VectorSlicer(inputCol="features", outputCol=VARYING, indices=varying or [0])


def _without_summary(model: PipelineModel) -> PipelineModel:
    """Drop the training summaries: they hold the session, which tasks cannot be sent once it has observed metrics."""
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def load_ensemble(spark: SparkSession, path: str) -> Ensemble:
    """Load a saved ensemble; the same objects again in this process, until it is saved anew."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MEMBERS[-1]}/metadata")
    status = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(folder)
    return _loaded(path, status.getModificationTime())


@lru_cache(maxsize=8)
def _loaded(path: str, saved_at: int) -> Ensemble:
    return Ensemble(
        PipelineModel.load(f"{path}/preprocessor"),
        {name: PipelineModel.load(f"{path}/{name}") for name in MEMBERS},
    )
