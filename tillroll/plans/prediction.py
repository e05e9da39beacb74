"""Repeat-purchase prediction from sales lines to scored models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.operators import classifiers
from tillroll.operators.customers import (
    customer_features,
    design_matrix,
    future_target,
    split_dates,
)
from tillroll.operators.scaling import stratified_split
from tillroll.schema import SEED, TARGET
from tillroll.session import pinned


def labelled_customers(sales: DataFrame, dates: dict[str, object] | None = None) -> DataFrame:
    """Features before the cut-off and the label after it, one row per past customer.

    The cut-off (one row) is fetched first, so that it enters the scan filters as a literal.
    """
    dates = dates or split_dates(sales)

    def at(name: str) -> Column:
        return F.timestamp_micros(F.lit(dates[name]))

    features = customer_features(sales, at("historical_end"), at("historical_start"))
    target = future_target(sales, at("historical_end"), at("future_start"), at("future_end"))
    return design_matrix(features, target)


def predict_repeat_purchase(
    sales: DataFrame,
    models: Sequence[str] = tuple(classifiers.MODELS),
    cv_folds: int = 5,
    trees: int = 200,
    seed: int = SEED,
) -> dict[str, object]:
    """Split, fit and score the models, cross-validate them and explain the best ones."""
    dates = split_dates(sales)
    # One row for each customer, read by every fit below.
    matrix = pinned(stratified_split(pinned(labelled_customers(sales, dates)), TARGET, seed=seed))
    train, test = matrix.filter(~F.col("is_test")), matrix.filter("is_test")

    results, settings = {}, {}
    for name in models:
        options = {"trees": trees} if name == "Random Forest" else {}
        results[name], settings[name] = classifiers.train_and_score(train, test, name, seed=seed, **options), options
    chosen = {n: classifiers.MODELS[n] for n in models}
    folds = classifiers.cross_validate_all(matrix, chosen, folds=cv_folds, seed=seed, settings=settings) if cv_folds else None
    metrics = classifiers.metric_table({n: r["metrics"] for n, r in results.items()})
    out = {
        "dates": dates,
        "matrix": matrix,
        "metrics": metrics,
        "best_model": classifiers.best_model(metrics),
        "predictions": classifiers.prediction_table({n: r["predictions"] for n, r in results.items()}),
        "confusion": {n: r["confusion_matrix"] for n, r in results.items()},
        "cross_validation": folds,
        "models": {n: r["model"] for n, r in results.items()},
    }
    if "Random Forest" in results:
        out["importances"] = classifiers.importance_table(results["Random Forest"]["model"], train)
    if "Logistic Regression" in results:
        out["coefficients"] = classifiers.coefficient_table(results["Logistic Regression"]["model"], train)
    return out


def perceptron_baseline(matrix: DataFrame, hidden: Sequence[int] = (64, 32), max_iter: int = 200, seed: int = SEED) -> dict:
    """A perceptron on the same split, with train and test metrics."""
    train, test = matrix.filter(~F.col("is_test")), matrix.filter("is_test")
    model = classifiers.tabular_mlp(train, hidden=hidden, max_iter=max_iter, seed=seed)
    return {
        "model": model,
        "train_metrics": classifiers.evaluate(model, train),
        "test_metrics": classifiers.evaluate(model, test),
    }
