"""Feature-vector stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StandardScalerModel, StringIndexer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from farebox.operators.labels import Labels, fit_labels, index_labels, label_slots
from farebox.schema import FEATURES_13


def feature_pipeline(
    categorical: Sequence[str] = (), numeric: Sequence[str] = FEATURES_13, scale: bool = True
) -> Pipeline:
    """Index and one-hot encode categories, assemble ``features_raw``, standardise to ``features``.

    A null input is an error: part such rows off first, with their reason, by ``quarantine`` and
    ``complete_rules``, so that none is lost unnoticed. Unseen categories get an index of their
    own. Fit it on the training side only, with categories by ``fit_features``. The slot names
    ``<c>_index``, ``<c>_encoded`` and ``features_raw`` are fixed values.
    """
    stages = []
    encoded = [f"{c}_encoded" for c in categorical]
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=list(categorical),
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="frequencyDesc",
            )
        )
        stages.append(
            OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True)
        )
    assembled = "features_raw" if scale else "features"
    stages.append(
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol=assembled, handleInvalid="error")
    )
    if scale:
        stages.append(
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
        )
    return Pipeline(stages=stages)


MAX_LABELS = 10_000


def check_labels(df: DataFrame, cols: Sequence[str], max_labels: int = MAX_LABELS) -> None:
    """Refuse columns with more than about ``max_labels`` values, before MLlib's index of them is fitted.

    That index keeps every value on the driver and one-hot encoding names a slot for each, so it
    is meant for codes and zones; ``CategoryFeatures`` has no such bound. The count is one pass of
    sketches (2 % off).
    """
    found = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in cols]).first().asDict() if cols else {}
    large = {c: n for c, n in found.items() if n > 1.05 * max_labels}
    if large:
        raise ValueError(f"more than {max_labels} labels: {large}")


def fit_features(
    train: DataFrame, categorical: Sequence[str] = (), numeric: Sequence[str] = FEATURES_13, scale: bool = True,
    max_labels: int = MAX_LABELS,
) -> PipelineModel:
    """``feature_pipeline`` fitted, after ``check_labels`` of its categories."""
    check_labels(train, categorical, max_labels)
    return feature_pipeline(categorical, numeric, scale).fit(train)


def index_categories(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``<col>_index``, most frequent training value first, ties in alphabetical order.

    Nulls and values that training does not have get the number after the last. The index is a
    written table that is joined (``operators.labels``), so any number of values will do.
    """
    for col, labels in fit_labels(train, cols).items():
        df = index_labels(df, labels, f"{col}_index")
    return df


@dataclass(frozen=True)
class CategoryFeatures:
    """Standardised numbers and one-hot categories of any size as one sparse vector.

    Slots: the numeric columns in order, then for each categorical one a slot for each label, most
    frequent first, and one for nulls and labels not seen. Nothing but means, deviations and slot numbers
    is on the driver; the vector carries no slot names.
    """

    numeric: Sequence[str]
    moments: Mapping[str, tuple[float, float]]
    labels: Mapping[str, Labels]

    @property
    def size(self) -> int:
        return label_slots(self.labels, len(self.numeric))[""]

    def transform(self, df: DataFrame, out: str = "features", **join: object) -> DataFrame:
        """Add the vector. A null number is an error, as in ``feature_pipeline``. ``join``: see ``index_labels``."""
        kept = df.columns
        starts = label_slots(self.labels, len(self.numeric))
        for i, (col, labels) in enumerate(self.labels.items()):
            df = index_labels(df, labels, f"_slot_{i}", **join)
        scaled = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in {c}")).cast("double")).otherwise(
            (F.col(c).cast("double") - F.lit(mean)) / F.lit(std) if std else F.lit(0.0)) for c, (mean, std) in self.moments.items()]
        slots = [F.lit(i) for i in range(len(scaled))]
        slots += [(F.col(f"_slot_{i}") + F.lit(starts[c])).cast("int") for i, c in enumerate(self.labels)]
        # the struct that a sparse vector is stored as, read back as one
        fields = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(self.size).alias("size"), F.array(*slots).alias("indices"),
            F.array(*scaled, *[F.lit(1.0)] * len(self.labels)).alias("values"),
        )
        vector = F.from_json(F.to_json(F.struct(fields.alias("v"))), StructType([StructField("v", VectorUDT())]))
        return df.select(*[F.col(f"`{c}`") for c in kept], vector["v"].alias(out))


def fit_category_features(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = ()) -> CategoryFeatures:
    """Label tables and moments of the training side, each in one scan; a constant column scales to 0."""
    row = train.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(numeric) for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first() if numeric else {}
    moments = {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(numeric)}
    return CategoryFeatures(tuple(numeric), moments, fit_labels(train, categorical))


def scaler_statistics(model: PipelineModel, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The fitted mean and standard deviation of every vector slot, as a small table."""
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    rows = [
        (i, name, float(mean), float(std))
        for i, (name, mean, std) in enumerate(zip(names, scaler.mean, scaler.std, strict=True))
    ]
    return df.sparkSession.createDataFrame(rows, "slot int, feature string, mean double, std double")


def to_gold(df: DataFrame, fare: str = "fare_amount") -> DataFrame:
    """Name the target ``label``."""
    return df.withColumn("label", F.col(fare).cast("double")).drop(fare)
