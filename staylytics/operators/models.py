"""Price models: linear regression and boosted trees as ``pyspark.ml`` pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler, StandardScaler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylytics.operators.boosting import HistogramBoosting
from staylytics.operators.features import fill_numeric
from staylytics.sources.staging import materialize
from staylytics.sources.tables import literal_table


def _encoders(num: Sequence[str], cat: Sequence[str], output: str) -> list:
    indexed = [f"{c}_indexed" for c in cat]
    stages: list = []
    if cat:
        stages.append(StringIndexer(inputCols=list(cat), outputCols=indexed, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*num, *indexed], outputCol=output, handleInvalid="skip"))
    return stages


def linear_pipeline(num: Sequence[str], cat: Sequence[str] = (), target: str = "price_clean") -> Pipeline:
    """Index categories, assemble, centre and scale, then ordinary least squares."""
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    line = LinearRegression(featuresCol="features", labelCol=target, predictionCol="prediction")
    return Pipeline(stages=[*_encoders(num, cat, "features_raw"), scaler, line])


def gbt_pipeline(
    num: Sequence[str],
    cat: Sequence[str] = (),
    target: str = "price_clean",
    depth: int = 8,
    iters: int = 100,
    step: float = 0.05,
    bins: int = 64,
    subsample: float = 0.8,
    seed: int = 42,
) -> Pipeline:
    """Index categories, assemble, boost. ``bins`` must exceed the categories of any column."""
    trees = HistogramBoosting(
        featuresCol="features",
        labelCol=target,
        predictionCol="prediction",
        maxDepth=depth,
        maxIter=iters,
        stepSize=step,
        maxBins=bins,
        subsamplingRate=subsample,
        seed=seed,
    )
    encoders = _encoders(num, cat, "features")
    trees.columns = encoders[-1].getInputCols()
    return Pipeline(stages=[*encoders, trees])


def fit(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """Fit on the columns the pipeline reads; rows marked ``test`` stay out when there is a split."""
    if "split" in df.columns:
        df = df.where("split = 'train'")
    stages = pipeline.getStages()
    wanted = {stages[-1].getLabelCol()}
    for s in stages:
        if isinstance(s, (StringIndexer, VectorAssembler)):
            wanted |= set(s.getInputCols())
    return pipeline.fit(df.select(*[c for c in df.columns if c in wanted]))


def score(model: PipelineModel, df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Add the model's prediction, and nothing else, to ``df``."""
    return model.transform(df).select(*df.columns, F.col("prediction").alias(prediction))


def score_all(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """One prediction column per model on the same rows: one scan, no join."""
    for name, model in models.items():
        df = score(model, df, name)
    return df


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_names(model: PipelineModel) -> list[str]:
    """Vector slots by name: the assembler's inputs."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def coefficients(model: PipelineModel) -> DataFrame:
    """``feature, coefficient`` of the linear model, in slot order."""
    rows = zip(feature_names(model), (float(x) for x in model.stages[-1].coefficients.toArray()))
    return literal_table(SparkSession.getActiveSession(), rows, "feature string, coefficient double")


def importances(model: PipelineModel) -> DataFrame:
    """``feature, importance`` of the tree model, in slot order."""
    rows = zip(feature_names(model), (float(x) for x in model.stages[-1].featureImportances.toArray()))
    return literal_table(SparkSession.getActiveSession(), rows, "feature string, importance double")


def encode_alphabetical(df: DataFrame, cols: Sequence[str], missing: str = "missing") -> DataFrame:
    """Replace each category by its position in alphabetical order; null counts as ``missing``.

    The labels are numbered as a table and joined, so none of them passes through the driver. A column of very many labels
    (one that is no category) is sorted by range first; a label's number is its place in its range plus the sizes of those before.
    """
    coded = fill_numeric(df).na.fill(missing, subset=list(cols))
    for c in cols:
        labels = coded.select(F.col(c).alias("__label")).distinct().repartitionByRange("__label")
        labels = materialize(labels.withColumn("__part", F.spark_partition_id()), "labels")
        sizes = labels.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
        before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
        place = F.row_number().over(Window.partitionBy("__part").orderBy("__label")) - 1
        codes = materialize(labels.withColumn("__place", place).join(starts, "__part"), "codes")
        codes = codes.select("__label", (F.col("__start") + F.col("__place")).cast("int").alias("__code"))
        coded = coded.join(codes, coded[c] == codes["__label"]).withColumn(c, F.col("__code")).drop("__label", "__code")
    return coded.select(*df.columns)
