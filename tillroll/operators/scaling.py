"""Scaling, encoding, and repeatable stratified splits."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions.columns import number
from tillroll.functions.ranks import hash_ranks, running_totals
from tillroll.operators.prepare import add_log1p, ensure_datetime, ensure_numeric, ensure_string
from tillroll.schema import CATEGORICAL_FEATURES, ID_COLUMNS, NUMERIC_FEATURES, RFM_COLUMNS, SEED, present, require

# Columns scaled for the analytical data set.
ANALYTICAL_COLUMNS = ["Quantity", "UnitPrice", "TotalAmount", "Year", "Month", "Day", "Hour", "DayOfWeek"]


def _usable(df: DataFrame, columns: Sequence[str], exclude_ids: bool) -> list[str]:
    names = present(df, columns)
    return [c for c in names if not (exclude_ids and c in ID_COLUMNS)]


def scale_numeric(
    df: DataFrame, columns: Sequence[str], method: str = "standard", exclude_ids: bool = True
) -> DataFrame:
    """Add ``<column>_Scaled``: z-scores over the population deviation, or the 0..1 range.

    Missing values count as zero. A constant column scales to zero. All parameters come from one
    pass and enter the projection as a single scalar.
    """
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown scaling method {method!r}: use 'standard' or 'minmax'")
    names = _usable(df, columns, exclude_ids)
    filled = {c: F.coalesce(number(df, c).cast("double"), F.lit(0.0)) for c in names}

    def fitted(c: str) -> list[Column]:
        x = filled[c]
        if method == "standard":
            return [F.avg(x).alias(f"{c}_at"), F.stddev_pop(x).alias(f"{c}_by")]
        return [F.min(x).alias(f"{c}_at"), (F.max(x) - F.min(x)).alias(f"{c}_by")]

    if not names:
        return df
    stats = df.agg(F.struct(*[e for c in names for e in fitted(c)]).alias("fit")).scalar()
    scaled = {}
    for c in names:
        at, by = F.col(f"_fit.{c}_at"), F.col(f"_fit.{c}_by")
        scaled[f"{c}_Scaled"] = (filled[c] - at) / F.when(by == 0, F.lit(1.0)).otherwise(by)
    return df.withColumn("_fit", stats).withColumns(scaled).drop("_fit")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def levels(df: DataFrame, column: str) -> DataFrame:
    """(level, code): the distinct values as text, numbered from 0 in sorted order, however many there are."""
    distinct = df.select(_text(column).alias("level")).distinct()
    return running_totals(distinct, [F.col("level")], {"place": F.lit(1)}).select("level", (F.col("place") - 1).cast("int").alias("code"))


def _coded(df: DataFrame, column: str, output: str) -> DataFrame:
    """The code of each row's value; the join follows the sizes, and AQE splits values too frequent for one task."""
    codes = levels(df, column).select(F.col("level").alias("_level"), F.col("code").alias(output))
    return df.withColumn("_text", _text(column)).join(codes, F.col("_text") == F.col("_level"), "left").drop("_text", "_level")


def encode_label(df: DataFrame, columns: Sequence[str], exclude_ids: bool = True) -> DataFrame:
    """Add ``<column>_Encoded``: zero-based code of the value in sorted order."""
    out = df
    for c in _usable(df, columns, exclude_ids):
        out = _coded(out, c, f"{c}_Encoded")
    return out


def encode_onehot(
    df: DataFrame, columns: Sequence[str], exclude_ids: bool = True, wide: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Add ``<column>_OneHot``: a sparse indicator vector (size, indices, values) over all levels, none dropped.

    Entry i stands for the level with code i (``levels``). A column in ``wide`` gets one boolean column
    ``<column>_<level>`` for each level listed there instead.
    """
    out = df
    for c in _usable(df, columns, exclude_ids):
        if c in (wide or {}):
            out = out.withColumns({f"{c}_{v}": _text(c) == F.lit(v) for v in wide[c]})
            continue
        size = levels(df, c).agg(F.count(F.lit(1)).cast("int")).scalar()
        hot = F.struct(size.alias("size"), F.array("_code").alias("indices"), F.array(F.lit(1.0)).alias("values"))
        out = _coded(out, c, "_code").withColumn(f"{c}_OneHot", hot).drop("_code")
    return out


def encode_categorical(df: DataFrame, columns: Sequence[str], method: str = "label", **options) -> DataFrame:
    if method == "label":
        return encode_label(df, columns, **options)
    if method == "onehot":
        return encode_onehot(df, columns, **options)
    raise ValueError(f"unknown encoding method {method!r}: use 'label' or 'onehot'")


def analytical_dataset(df: DataFrame, scaling: bool = True, encoding: bool = False) -> dict[str, DataFrame]:
    """Typed and trimmed lines, with scaled measures and, if asked, country codes."""
    base = ensure_numeric(df, ["Quantity", "UnitPrice", "TotalAmount", "CustomerID"])
    base = ensure_string(ensure_datetime(base, ["InvoiceDate"]), ["InvoiceNo", "StockCode", "Description", "Country"])
    out = {"base": base}
    if scaling:
        out["scaled"] = scale_numeric(base, ANALYTICAL_COLUMNS)
    if encoding:
        out["encoded"] = encode_label(base, ["Country"])
    return out


def scale_features(table: DataFrame, columns: Sequence[str] = RFM_COLUMNS, output: str = "features") -> DataFrame:
    """Z-scores of the columns as one vector beside the key."""
    require(table, columns)
    scaled = scale_numeric(table, columns, exclude_ids=False)
    names = [f"{c}_Scaled" for c in columns]
    return VectorAssembler(inputCols=names, outputCol=output).transform(scaled)


def log_scaled_rfm(table: DataFrame) -> DataFrame:
    """Log1p and z-score of recency, frequency and amount as a ``features`` vector."""
    require(table, RFM_COLUMNS)
    return scale_features(add_log1p(table), [f"Log_{c}" for c in RFM_COLUMNS])


class PopulationFactor(Estimator):
    """Turns z-scores by the sample deviation into z-scores by the population deviation."""

    def __init__(self, input_col: str, output_col: str, size: int):
        super().__init__()
        self.input_col, self.output_col, self.width = input_col, output_col, size

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        n = dataset.count()
        factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        return ElementwiseProduct(scalingVec=Vectors.dense([factor] * self.width), inputCol=self.input_col, outputCol=self.output_col)


def feature_stages(
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    output: str = "features",
) -> list:
    """Estimators that z-score the numbers and one-hot encode the categories.

    An unknown category becomes all zeros; other columns do not enter the vector.
    """
    if not numeric and not categorical:
        raise ValueError("a feature vector needs at least one column")
    stages, parts = [], []
    if numeric:
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol="_numbers", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="_numbers", outputCol="_centred", withMean=True, withStd=True))
        stages.append(PopulationFactor("_centred", "_scaled", len(numeric)))
        parts.append("_scaled")
    for c in categorical:
        stages.append(
            StringIndexer(inputCol=c, outputCol=f"_{c}_index", handleInvalid="keep", stringOrderType="alphabetAsc")
        )
        stages.append(OneHotEncoder(inputCol=f"_{c}_index", outputCol=f"_{c}_hot", dropLast=True))
        parts.append(f"_{c}_hot")
    stages.append(VectorAssembler(inputCols=parts, outputCol=output))
    return stages


def feature_pipeline(numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> Pipeline:
    return Pipeline(stages=feature_stages(numeric, categorical))


def stratified_split(
    df: DataFrame, label: str, key: str = "CustomerID", test_size: float = 0.30, seed: int = SEED
) -> DataFrame:
    """Add ``is_test``: in each class the first share of a repeatable shuffled order.

    Class sizes in the test part are rounded half up.
    """
    ranked = hash_ranks(df, [key], [label], seed, "_rank")
    sizes = df.groupBy(F.col(label).alias("_class")).agg(
        F.floor(F.count(F.lit(1)) * F.lit(test_size) + 0.5).alias("_take")
    )
    # One row for each class.
    placed = ranked.join(F.broadcast(sizes), F.col(label).eqNullSafe(F.col("_class")))
    return placed.withColumn("is_test", F.col("_rank") < F.col("_take")).drop("_rank", "_class", "_take")


def stratified_folds(df: DataFrame, label: str, key: str = "CustomerID", folds: int = 5, seed: int = SEED) -> DataFrame:
    """Add ``fold`` (0-based): each class is dealt out in a repeatable shuffled order."""
    ranked = hash_ranks(df, [key], [label], seed, "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank"), F.lit(folds)).cast("int")).drop("_rank")
