"""Array-valued samples: flattening, scaling, one-hot labels, shape checks, arg-max."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.columns import col
from tillroll.functions.ranks import hash_sample

PIXEL_MAX = 255.0


def flat(c: str | Column, depth: int = 1) -> Column:
    return F.flatten(col(c)) if depth == 2 else col(c)


def normalise(df: DataFrame, column: str, depth: int = 1, divisor: float = PIXEL_MAX, output: str = "pixels") -> DataFrame:
    """Flatten a (nested) array, cast to float and divide."""
    scaled = F.transform(flat(column, depth), lambda x: (x.cast("float") / F.lit(divisor)).cast("float"))
    return df.withColumn(output, scaled)


def as_vector(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def onehot_label(df: DataFrame, label: str, n_classes: int, output: str = "onehot") -> DataFrame:
    places = F.sequence(F.lit(0), F.lit(n_classes - 1))
    return df.withColumn(output, F.transform(places, lambda i: (i == F.col(label)).cast("float")))


def shape_check(
    df: DataFrame, column: str, label: str, size: int | tuple[int, int], n_classes: int
) -> DataFrame:
    """Counts of samples with a wrong shape or label, as one row."""
    if isinstance(size, tuple):
        rows, width = size
        bad = (F.size(column) != rows) | F.exists(F.col(column), lambda r: F.size(r) != width)
    else:
        bad = F.size(column) != size
    return df.agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_if(F.coalesce(bad, F.lit(True))).alias("wrong_shape"),
        F.count_if(F.col(label).isNull()).alias("missing_label"),
        F.count_if(~F.col(label).between(0, n_classes - 1)).alias("label_out_of_range"),
    )


def validate_shapes(df: DataFrame, column: str, label: str, size: int | tuple[int, int], n_classes: int) -> bool:
    """Raise ValueError unless every sample has the shape and a label 0..n-1."""
    row = shape_check(df, column, label, size, n_classes).first().asDict()
    faults = {k: v for k, v in row.items() if k != "samples" and v}
    if faults:
        raise ValueError(f"bad samples: {faults}")
    return True


def argmax(c: str | Column) -> Column:
    """Zero-based position of the largest entry; the first wins ties."""
    return F.array_position(col(c), F.array_max(col(c))) - 1


def add_argmax(df: DataFrame, column: str, output: str = "predicted_class") -> DataFrame:
    return df.withColumn(output, argmax(column).cast("int"))


def sampled_predictions(df: DataFrame, key: str, label: str, prediction: str, n: int = 16, seed: int = 42) -> DataFrame:
    """A repeatable sample of predictions with truth, prediction and hit flag."""
    shown = df.select(
        key, F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")
    )
    return hash_sample(shown, n, [key], seed).withColumn("hit", F.col("actual") == F.col("predicted"))
