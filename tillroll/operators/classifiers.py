"""Repeat-purchase models: fitting, scoring, cross-validation and explanation, on pyspark.ml."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tillroll.operators import forest
from tillroll.operators.scaling import feature_stages, stratified_folds
from tillroll.operators.scores import add_class_weight, classifier_metrics, confusion_matrix
from tillroll.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES, SEED, TARGET
from tillroll.session import pinned, written

CV_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def logistic_regression(rows: int, seed: int = SEED, c: float = 1.0) -> LogisticRegression:
    """L2 model with strength C on balanced weights.

    The weights sum to the number of rows, and Spark's loss is a mean, so the penalty is 1 / (C * rows).
    """
    return LogisticRegression(
        weightCol="weight", labelCol="label", regParam=1.0 / (c * max(rows, 1)), standardization=False, maxIter=2000
    )


def decision_tree(rows: int = 0, seed: int = SEED) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        weightCol="weight", labelCol="label", impurity="gini", maxDepth=8, minInstancesPerNode=5, seed=seed
    )


def random_forest(rows: int = 0, seed: int = SEED, trees: int = 200) -> RandomForestClassifier:
    return RandomForestClassifier(
        weightCol="weight", labelCol="label", impurity="gini", numTrees=trees, maxDepth=12, minInstancesPerNode=3, seed=seed
    )


MODELS: dict[str, Callable] = {
    "Logistic Regression": logistic_regression,
    "Decision Tree": decision_tree,
    "Random Forest": random_forest,
}


def labelled(df: DataFrame, target: str = TARGET) -> DataFrame:
    """The design matrix with a double ``label`` and balanced ``weight``."""
    return add_class_weight(df.withColumn("label", F.col(target).cast("double")))


def fit(
    train: DataFrame,
    model: Callable,
    target: str = TARGET,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    **options,
) -> PipelineModel:
    """Fit feature preparation and classifier as one estimator, on these rows only."""
    rows = train.count()
    estimator = Pipeline(stages=[*feature_stages(numeric, categorical), model(rows, **options)])
    return estimator.fit(labelled(train, target))


def predict(model: PipelineModel, df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows with ``label``, ``prediction`` and the class-1 probability as ``score``."""
    scored = model.transform(df.withColumn("label", F.col(target).cast("double")))
    return scored.withColumn("score", vector_to_array("probability")[1])


def evaluate(model: PipelineModel, test: DataFrame, target: str = TARGET) -> DataFrame:
    return classifier_metrics(predict(model, test, target))


def train_and_score(train: DataFrame, test: DataFrame, name: str, target: str = TARGET, **options) -> dict[str, object]:
    """Fitted model, test predictions, metric row and confusion matrix of one classifier."""
    model = fit(train, MODELS[name], target, **options)
    predictions = predict(model, test, target)
    return {
        "model": model,
        "predictions": predictions,
        "metrics": classifier_metrics(predictions),
        "confusion_matrix": confusion_matrix(predictions, n_classes=2),
    }


def prediction_table(results: dict[str, DataFrame], key: str = "CustomerID") -> DataFrame:
    """Truth, prediction and probability of every model side by side, one row per customer."""
    out = None
    for name, df in results.items():
        short = name.lower().replace(" ", "_")
        part = df.select(
            key,
            F.col("label").cast("int").alias("actual"),
            F.col("prediction").cast("int").alias(f"{short}_prediction"),
            F.col("score").alias(f"{short}_probability"),
        )
        out = part if out is None else out.join(part.drop("actual"), key)
    return out


def metric_table(metrics: dict[str, DataFrame]) -> DataFrame:
    """One metric row per model."""
    out = None
    for name, row in metrics.items():
        named = row.select(F.lit(name).alias("model"), "*")
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def best_model(metrics: DataFrame, preferred: str = "Random Forest") -> str:
    """The model with the highest ROC-AUC; the preferred one wins ties."""
    order = [F.desc_nulls_last("roc_auc"), F.desc(F.col("model") == preferred), F.asc("model")]
    return metrics.orderBy(*order).first().model


def cross_validate(df: DataFrame, model: Callable, target: str = TARGET, **options) -> DataFrame:
    """``cross_validate_all`` of one model."""
    return cross_validate_all(df, {"": model}, target, **options).drop("model")


def cross_validate_all(
    df: DataFrame,
    models: Mapping[str, Callable],
    target: str = TARGET,
    key: str = "CustomerID",
    folds: int = 5,
    seed: int = SEED,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    at_once: int = 4,
    settings: Mapping[str, Mapping] | None = None,
    **options,
) -> DataFrame:
    """Metrics of each model and fold, and an ``overall`` row with mean and population deviation for each model.

    Feature preparation is refitted in every fold, so the held-out rows never shape it; all models read its
    written features. ``at_once`` fits run side by side, one forest among them. ``settings`` are options of single models. Forests are
    grown by ``forest``, with the settings and rules of Spark's estimator: its own passes take many times as long.
    """
    dealt = pinned(stratified_folds(df, target, key, folds, seed))

    def prepare(i: int) -> tuple[DataFrame, DataFrame]:
        train = labelled(dealt.filter(F.col("fold") != i), target)
        held = dealt.filter(F.col("fold") == i).withColumn("label", F.col(target).cast("double"))
        stages = Pipeline(stages=feature_stages(numeric, categorical)).fit(train)
        return written(stages.transform(train).select(key, "label", "weight", "features")), written(stages.transform(held).select("label", "features"))

    def run(task: tuple[str, int]) -> tuple:
        name, i = task
        train, held = prepared[i]
        model = models[name](train.count(), **{**options, **(settings or {}).get(name, {})})
        if forest.supports(model, [r["label"] for r in train.select("label").distinct().collect()]):
            scored = written(forest.fit_forest(train, model, key).predict(held))
        else:
            scored = model.fit(train).transform(held).withColumn("score", vector_to_array("probability")[1])
        got = classifier_metrics(scored).first()
        return (name, str(i + 1), *[None if got[m] is None else float(got[m]) for m in CV_METRICS])

    spark = df.sparkSession
    aside = {name for name in models if isinstance(models[name](1, **{**options, **(settings or {}).get(name, {})}), RandomForestClassifier)}
    with ThreadPoolExecutor(at_once) as pool, ThreadPoolExecutor(1) as alone:  # one forest at a time, as the driver holds its trees
        prepared = list(pool.map(inheritable_thread_target(spark)(prepare), range(folds)))
        fits = [(alone if name in aside else pool).submit(inheritable_thread_target(spark)(run), (name, i)) for name in models for i in range(folds)]
        rows = [f.result() for f in fits]
    table = spark.createDataFrame(rows, "model string, fold string, " + ", ".join(f"{m} double" for m in CV_METRICS))
    spread = []
    for m in CV_METRICS:
        spread += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    overall = table.groupBy("model").agg(*spread).withColumn("fold", F.lit("overall"))
    return table.unionByName(overall, allowMissingColumns=True)


def feature_names(model: PipelineModel, df: DataFrame, features: str = "features") -> list[str]:
    """Names of the vector entries: numbers by column, categories by column and level."""
    meta = model.transform(df.limit(0).withColumn("label", F.lit(0.0))).schema[features].metadata["ml_attr"]
    size = meta["num_attrs"]
    names = [f"f{i}" for i in range(size)]
    for group in meta.get("attrs", {}).values():
        for attr in group:
            names[attr["idx"]] = attr.get("name", names[attr["idx"]])
    assembler = model.stages[0]
    numbers = assembler.getInputCols() if assembler.getOutputCol() == "_numbers" else []
    for i, name in enumerate(numbers):
        names[i] = name
    return [n[1:].replace("_hot_", "_") if "_hot_" in n else n for n in names]


def importance_table(model: PipelineModel, df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Feature importances of a tree model, largest first."""
    pairs = list(zip(feature_names(model, df), (float(v) for v in model.stages[-1].featureImportances.toArray())))
    out = df.sparkSession.createDataFrame(pairs, "feature string, importance double")
    out = out.orderBy(F.desc("importance"), "feature")
    return out.limit(top_n) if top_n else out


def coefficient_table(model: PipelineModel, df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Coefficients of the linear model, largest magnitude first."""
    pairs = list(zip(feature_names(model, df), (float(v) for v in model.stages[-1].coefficients.toArray())))
    out = df.sparkSession.createDataFrame(pairs, "feature string, coefficient double")
    out = out.orderBy(F.desc(F.abs("coefficient")), "feature")
    return out.limit(top_n) if top_n else out


def tabular_mlp(
    train: DataFrame,
    target: str = TARGET,
    hidden: Sequence[int] = (64, 32),
    max_iter: int = 200,
    seed: int = SEED,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> PipelineModel:
    """Feature preparation and a perceptron with the given hidden layers (unweighted)."""
    data = train.withColumn("label", F.col(target).cast("double"))
    prepared = Pipeline(stages=feature_stages(numeric, categorical)).fit(data)
    size = prepared.transform(data.limit(0)).schema["features"].metadata["ml_attr"]["num_attrs"]
    net = MultilayerPerceptronClassifier(layers=[size, *hidden, 2], labelCol="label", maxIter=max_iter, seed=seed)
    fitted = net.fit(prepared.transform(data))
    return PipelineModel(stages=[*prepared.stages, fitted])


def vector_mlp(
    train: DataFrame, size: int, n_classes: int = 10, hidden: Sequence[int] = (128, 64), max_iter: int = 100, seed: int = SEED
):
    """A perceptron over a ``features`` vector and a ``label``."""
    net = MultilayerPerceptronClassifier(layers=[size, *hidden, n_classes], labelCol="label", maxIter=max_iter, seed=seed)
    return net.fit(train)
