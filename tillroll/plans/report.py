"""The full study: cleaning, summary, segments, prediction and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.operators import narrative
from tillroll.operators.customers import temporal_split
from tillroll.operators.prepare import clean_dataset
from tillroll.plans.exploration import short_summary
from tillroll.plans.prediction import perceptron_baseline, predict_repeat_purchase
from tillroll.plans.segmentation import segment_customers
from tillroll.schema import K_RANGE
from tillroll.sources.sinks import save_tables


def full_report(
    raw: DataFrame,
    folder: str | None = None,
    k_values=K_RANGE,
    n_init: int = 10,
    cv_folds: int = 5,
    trees: int = 200,
    mlp_iterations: int = 200,
) -> dict[str, object]:
    """Run every part; result tables go to ``folder`` if one is given."""
    clean, sales = clean_dataset(raw)
    summary = short_summary(clean, sales)
    segmented = segment_customers(sales, k_values=k_values, n_init=n_init)
    predicted = predict_repeat_purchase(
        sales, models=("Random Forest", "Logistic Regression"), cv_folds=cv_folds, trees=trees
    )
    baseline = perceptron_baseline(predicted["matrix"], max_iter=mlp_iterations)

    best = predicted["best_model"]
    metrics = predicted["metrics"].filter(F.col("model") == best).first().asDict()
    top = predicted["importances"].limit(2).collect()
    models = narrative.model_facts(
        raw.sparkSession,
        best=best,
        metrics=metrics,
        k=segmented["best_k"],
        quality=segmented["quality"],
        features=[(r.feature, r.importance) for r in top],
        mlp_auc=baseline["test_metrics"].first().roc_auc,
    )
    facts = narrative.recommendation_facts(
        segmented["profiles"],
        summary["top10_countries_by_transactions"],
        summary["top10_products_by_revenue"],
        summary["monthly_volume"],
        temporal_split(sales),
        models,
    )
    out = {
        "summary": summary,
        "segments": segmented,
        "prediction": predicted,
        "baseline": baseline,
        "facts": facts,
        "recommendations": narrative.recommendations(facts),
    }
    if folder:
        tables = {f"eda_{k}": v for k, v in summary.items()}
        tables |= {f"segments_{k}": segmented[k] for k in ("sweep", "profiles", "zscores", "explained_variance")}
        tables |= {f"prediction_{k}": predicted[k] for k in ("metrics", "importances", "coefficients")}
        tables["facts"] = facts
        out["paths"] = save_tables(tables, folder)
    return out
