"""Training and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import dates, scoring, tiers
from tidemark.operators import boosting
from tidemark.schemas import FEATURES, NEXT_SESSION, SCALED
from tidemark.sources import store

_VECTOR = "_vector"
_SCORES = ("rawPrediction", "_probability", "_prediction", _VECTOR)


def assemble(df: DataFrame, columns: Sequence[str] = SCALED) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=_VECTOR).transform(df)


def spread(rows: DataFrame) -> DataFrame:
    """The rows in even parts, one for each core.

    For steps that cost much more than the bytes of their rows tell, by which files and shuffles are cut.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _labelled(train: DataFrame) -> DataFrame:
    """Labels and vectors in even parts; trainers pass over them hundreds of times.

    Their first passes, before they hold the rows, read the shuffled rows and not the table again.
    """
    rows = train.filter(F.col("target").isNotNull())
    rows = rows.select(F.col("target").cast("double").alias("label"), *SCALED)
    return assemble(spread(rows)).select("label", _VECTOR)


def _columns(estimator):
    return (
        estimator.setFeaturesCol(_VECTOR)
        .setLabelCol("label")
        .setPredictionCol("_prediction")
        .setProbabilityCol("_probability")
    )


def fit_gbt(
    train: DataFrame,
    trees: int = 100,
    depth: int = 5,
    rate: float = 0.05,
    seed: int = 42,
) -> Model:
    """Boosted trees on log loss, grown by ``boosting`` where tasks can run at once, else by Spark ML.

    Spark ML's checkpoint every ten trees bounds the lineage.
    """
    gbt = GBTClassifier(
        maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed, checkpointInterval=10
    )
    gbt = _columns(gbt)
    known = train.filter(F.col("target").isNotNull())
    return boosting.fit(gbt, known, "target", SCALED) or gbt.fit(_labelled(train))


def fit_logistic(train: DataFrame, iterations: int = 1000) -> LogisticRegressionModel:
    """L2 logistic regression; the penalty per row equals a unit penalty per fit."""
    rows = _labelled(train)
    lr = LogisticRegression(
        maxIter=iterations,
        regParam=1.0 / max(rows.count(), 1),
        elasticNetParam=0.0,
        standardization=False,
    )
    return _columns(lr).fit(rows)


def fit_forest(
    train: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42
) -> Model:
    """A forest. The node of each row and tree is kept, so that no level walks from the roots again."""
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True, checkpointInterval=10
    )
    return _columns(forest).fit(_labelled(train))


def linear_scorer(model: LogisticRegressionModel, name: str = "logistic") -> scoring.LinearScorer:
    """A fitted logistic model as a column expression."""
    weights = dict(zip(FEATURES, model.coefficients.toArray().tolist(), strict=True))
    return scoring.LinearScorer(name, float(model.intercept), weights)


def tree_scorer(model: Model, name: str = "trees") -> scoring.TreeScorer:
    """A fitted boosted model or forest as a column expression.

    The nodes are read from the stored form of the model: as many rows as it has nodes, at most
    two to the power of its depth for each tree.
    """
    spark = SparkSession.active()
    path = store.new_path(spark, "trees")
    save_model(model, path)
    boosted = isinstance(model, GBTClassificationModel)
    stage = f"{path}/stages/*"
    node, stats = F.col("nodeData"), F.col("nodeData.impurityStats")
    value = node["prediction"] if boosted else stats[1] / (stats[0] + stats[1])
    rows = spark.read.parquet(f"{stage}/data").select(
        F.struct(
            F.col("treeID").alias("tree"),
            node["id"].alias("id"),
            F.when(node["leftChild"] >= 0, node["split"]["featureIndex"]).otherwise(-1).alias("feature"),
            F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            F.coalesce(value, F.lit(0.0)).alias("value"),
        ).alias("n")
    )
    nodes = rows.agg(F.sort_array(F.collect_list("n"))).first()[0]
    weights = model.treeWeights
    place = {(n["tree"], n["id"]): at for at, n in enumerate(nodes)}
    roots = tuple(place[tree, 0] for tree in range(len(weights)))
    # Children follow their parent, so depths are known in order.
    depth = [0] * len(nodes)
    for at, n in enumerate(nodes):
        for child in (n["left"], n["right"]):
            if n["feature"] >= 0:
                depth[place[n["tree"], child]] = depth[at] + 1

    def child(n, side: str) -> int:
        return place[n["tree"], n[side]] if n["feature"] >= 0 else -1

    return scoring.TreeScorer(
        name,
        roots,
        max(depth),
        tuple(n["feature"] for n in nodes),
        tuple(n["threshold"] if n["feature"] >= 0 else 0.0 for n in nodes),
        tuple(child(n, "left") for n in nodes),
        tuple(child(n, "right") for n in nodes),
        tuple(n["value"] * (weights[n["tree"]] if boosted else 1.0) for n in nodes),
        boosted,
    )


def save_model(model: Model, path: str) -> None:
    PipelineModel([model]).write().overwrite().save(path)


def load_model(path: str) -> Model:
    return PipelineModel.load(path).stages[0]


def compiled(model: Model | scoring.Scorer) -> Model | scoring.Scorer:
    """The model as a column expression; models of other kinds stay as they are."""
    if isinstance(model, LogisticRegressionModel):
        return linear_scorer(model)
    if isinstance(model, (GBTClassificationModel, RandomForestClassificationModel)):
        return tree_scorer(model)
    return model


def score(model: Model | scoring.Scorer, df: DataFrame) -> DataFrame:
    """Add ``probability`` and ``prediction``."""
    if isinstance(model, scoring.Scorer):
        with_p = df.withColumn("probability", model.on_scaled())
    else:
        p = vector_to_array("_probability")[1]
        with_p = model.transform(assemble(df)).withColumn("probability", p).drop(*_SCORES)
    return with_p.withColumn("prediction", scoring.hard_class(F.col("probability")))


def score_next(
    model: Model | scoring.Scorer, latest: DataFrame, as_of: str
) -> DataFrame:
    """Next-session prediction for the newest row of each ticker."""
    today = F.lit(as_of).cast("date")
    return (
        score(model, latest)
        .withColumn("prediction_date", today)
        .withColumn("predicted_for_date", dates.next_trading_day(today))
        .withColumn("signal", tiers.signal(F.col("prediction")))
        .withColumn("confidence", tiers.confidence_tier(F.col("probability")))
        .select(*NEXT_SESSION.fieldNames())
    )


def align_features(
    df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Columns in the model's order: missing ones become 0.0, extra ones go."""
    have = set(df.columns)
    return df.select(
        *keep,
        *(F.col(name) if name in have else F.lit(0.0).alias(name) for name in expected),
    )


def align_by_position(df: DataFrame, count: int) -> DataFrame:
    """For a model without names: cut to ``count`` columns or fill up with 0.0."""
    names = df.columns[:count]
    extra = [F.lit(0.0).alias(f"feat_{i}") for i in range(len(names), count)]
    return df.select(*names, *extra)


def _shares(model: Model | scoring.LinearScorer) -> list[float]:
    """Share of each feature: split gains of trees, or sizes of linear weights."""
    if isinstance(model, scoring.LinearScorer):
        sizes = [abs(float(model.weights.get(name, 0.0))) for name in FEATURES]
    elif isinstance(model, LogisticRegressionModel):
        sizes = [abs(weight) for weight in model.coefficients.toArray().tolist()]
    else:
        sizes = model.featureImportances.toArray().tolist()
    total = sum(sizes) or 1.0
    return [size / total for size in sizes]


def feature_importance(
    spark: SparkSession, model: Model | scoring.LinearScorer, top: int = 3
) -> DataFrame:
    """The strongest features of a model with their share in percent."""
    rows = list(zip(FEATURES, _shares(model), strict=True))
    order = W.partitionBy(F.lit(1)).orderBy(F.desc("importance"), "feature")
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("rank", "feature", F.round(F.col("importance") * 100, 1).alias("percent"))
    )
