"""Classification scores from counts: confusion tables, averages, curves, loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.columns import row_count, safe_divide
from tillroll.functions.ranks import running_totals


def class_range(df: DataFrame, n: int, name: str) -> DataFrame:
    return df.sparkSession.range(n).select(F.col("id").cast("int").alias(name))


def cell_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")).agg(
        row_count().alias("count")
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", n_classes: int | None = None
) -> DataFrame:
    """Count of every actual/predicted pair, zeros included.

    Labels are 0..n-1 when ``n_classes`` is given, else all that occur on either side. The table has
    one row for each pair of classes, so the label lists fit in one row.
    """
    cells = cell_counts(df, label, prediction)
    if n_classes is None:
        seen = cells.select(F.explode(F.array("actual", "predicted")).alias("c"))
        labels = seen.agg(F.array_sort(F.collect_set("c")).alias("labels"))
    else:
        labels = df.sparkSession.range(1).select(F.sequence(F.lit(0), F.lit(n_classes - 1)).alias("labels"))
    grid = labels.select(F.explode("labels").alias("actual"), "labels").select(
        "actual", F.explode("labels").alias("predicted")
    )
    return grid.join(cells, ["actual", "predicted"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def confusion_pivot(matrix: DataFrame, n_classes: int) -> DataFrame:
    """One row for each actual class, one column ``pred_<class>`` for each predicted class."""
    wide = matrix.groupBy("actual").pivot("predicted", list(range(n_classes))).agg(F.first("count"))
    return wide.select("actual", *[F.coalesce(F.col(f"`{i}`"), F.lit(0)).alias(f"pred_{i}") for i in range(n_classes)])


def normalised_confusion(matrix: DataFrame) -> DataFrame:
    """Each cell as a share of its actual class; empty classes give zeros."""
    from pyspark.sql import Window

    total = F.sum("count").over(Window.partitionBy("actual"))
    return matrix.withColumn("share", F.coalesce(safe_divide(F.col("count"), total), F.lit(0.0)))


def class_scores(matrix: DataFrame) -> DataFrame:
    """Per class: support, precision, recall and F1 (0 where undefined)."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)
    by_actual = matrix.groupBy(F.col("actual").alias("class")).agg(
        F.sum("count").alias("support"), F.sum(hit).alias("hits")
    )
    by_predicted = matrix.groupBy(F.col("predicted").alias("class")).agg(F.sum("count").alias("claimed"))
    both = by_actual.join(by_predicted, "class")
    zero = F.lit(0.0)
    both = both.withColumns(
        {
            "precision": F.coalesce(safe_divide(F.col("hits"), F.col("claimed")), zero),
            "recall": F.coalesce(safe_divide(F.col("hits"), F.col("support")), zero),
        }
    )
    f1 = safe_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return both.withColumn("f1", F.coalesce(f1, zero))


ABOVE_ALL = float("inf")  # the threshold of a curve's first point


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve; null if only one class occurs.

    Scores are counted per distinct value. Each step then adds its negatives times the positives
    above it (half for ties), so no neighbour row is needed.
    """
    steps = score_steps(df, label, score)
    sums = steps.agg(
        F.sum(F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2)).alias("area"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    return sums.select(safe_divide(F.col("area"), F.col("p") * F.col("n")).alias("roc_auc"))


def score_steps(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score, from the highest: positives, negatives and their running sums."""
    y = F.col(label).cast("int")
    counts = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    return running_totals(counts, [-F.col("threshold")], {"tp": F.col("pos"), "fp": F.col("neg")})


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rate at each distinct score, and the origin above all scores."""
    steps = score_steps(df, label, score)
    totals = steps.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    points = steps.withColumn("t", totals).select(
        "threshold",
        safe_divide(F.col("fp"), F.col("t.n")).alias("fpr"),
        safe_divide(F.col("tp"), F.col("t.p")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(F.lit(ABOVE_ALL).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision and recall at each distinct score, and precision 1 at recall 0, with the share of positives as base line."""
    steps = score_steps(df, label, score)
    totals = steps.agg(F.struct(F.sum("pos").alias("p"), F.sum(F.col("pos") + F.col("neg")).alias("all"))).scalar()
    base = safe_divide(F.col("t.p"), F.col("t.all")).alias("base_rate")
    points = steps.withColumn("t", totals).select(
        "threshold",
        safe_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_divide(F.col("tp"), F.col("t.p")).alias("recall"),
        base,
    )
    start = df.sparkSession.range(1).withColumn("t", totals)
    start = start.select(F.lit(ABOVE_ALL).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), base)
    return points.unionByName(start)


def pr_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the precision-recall curve by the trapezoid rule, starting at recall 0, precision 1.

    The point before each step is known from the step's own counts.
    """
    steps = score_steps(df, label, score)
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    now = safe_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    then = F.coalesce(safe_divide(before_tp, before_tp + before_fp), F.lit(1.0))
    sums = steps.agg(F.sum(F.col("pos") * (now + then) / 2).alias("area"), F.sum("pos").alias("p"))
    return sums.select(safe_divide(F.col("area"), F.col("p")).alias("pr_auc"))


def classifier_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str | None = "score"
) -> DataFrame:
    """Accuracy, macro precision, recall and F1, supports, imbalance and ROC-AUC as one row."""
    scores = class_scores(confusion_matrix(df, label, prediction))
    support = {c: F.max(F.when(F.col("class") == c, F.col("support"))) for c in (0, 1)}
    out = scores.agg(
        safe_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.coalesce(support[1], F.lit(0)).alias("support_positive"),
        F.coalesce(support[0], F.lit(0)).alias("support_negative"),
    )
    out = out.withColumn(
        "imbalance_ratio_neg_to_pos", safe_divide(F.col("support_negative"), F.col("support_positive"))
    )
    return out.withColumn("roc_auc", roc_auc(df, label, score).scalar()) if score else out


def multiclass_metrics(df: DataFrame, n_classes: int, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 as one row, with per-class F1 in an array."""
    scores = class_scores(confusion_matrix(df, label, prediction, n_classes))

    def weighted(c: str) -> Column:
        return safe_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"{c}_weighted")

    in_order = F.array_sort(F.collect_list(F.struct("class", "f1")))
    return scores.agg(
        safe_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
        F.transform(in_order, lambda s: s.getField("f1")).alias("per_class_f1"),
        F.sum("support").alias("n_samples"),
        F.lit(n_classes).alias("num_classes"),
    )


def log_loss(df: DataFrame, label: str = "label", score: str = "score", eps: float = 1e-7) -> DataFrame:
    """Mean negative log probability of the true class, for a class-1 probability."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    truth = F.when(F.col(label).cast("int") == 1, p).otherwise(1 - p)
    return df.agg(F.avg(-F.log(truth)).alias("log_loss"))


def vector_log_loss(df: DataFrame, label: str, probabilities: str, eps: float = 1e-7) -> DataFrame:
    """Mean negative log probability of the true class, for an array of class probabilities."""
    p = F.element_at(F.col(probabilities), F.col(label).cast("int") + 1)
    return df.agg(F.avg(-F.log(F.greatest(p, F.lit(eps)))).alias("log_loss"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(row_count().alias("count"))
    totals = counts.agg(F.struct(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    weight = F.col("t.rows") / (F.col("t.classes") * F.col("count"))
    return counts.withColumn("t", totals).select("label", "count", weight.alias("weight"))


def add_class_weight(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """The class weight beside each row; the weight table has one row for each class."""
    weights = class_weights(df, label).select(F.col("label").alias("_class"), F.col("weight").alias(name))
    return df.join(F.broadcast(weights), F.col(label) == F.col("_class")).drop("_class")


def class_balance(df: DataFrame, label: str = "label", n_classes: int = 10) -> DataFrame:
    """Count and share of every class 0..n-1, zeros included."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(row_count().alias("count"))
    total = df.agg(row_count()).scalar()
    out = class_range(df, n_classes, "label").join(counts, "label", "left")
    out = out.withColumn("count", F.coalesce("count", F.lit(0)))
    return out.withColumn("percentage", F.coalesce(safe_divide(F.col("count") * 100, total), F.lit(0.0)))
