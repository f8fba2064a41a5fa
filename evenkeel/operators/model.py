"""Random-forest regression on numeric features, and its labels.

Training rows are dealt out by the hash of their key, to a number of partitions
that follows from the number of rows, and sorted there: the bootstrap, which
draws by partition, gives the same forest however the table was stored. Vectors
of more than ``max_width`` entries are folded into a hashed space of that width,
so that the memory of a node does not grow with the number of categories.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import col, cols, number
from evenkeel.functions.hashing import key_text
from evenkeel.functions.vectors import folded_vector, sized, vector_parts
from evenkeel.operators.clean import align_features, binarize, drop_missing, numeric_features
from evenkeel.operators.validate import require_columns
from evenkeel.spec import LABEL_THRESHOLD, SEED, ValidationError

# Entries that a vector may have before it is folded.
MAX_WIDTH = 1024
# Training rows per partition, and most partitions.
LAYOUT_ROWS, LAYOUT_PARTS = 5_000, 4_096

_FEATURES = "__features"


@dataclass(frozen=True)
class TrainedModel:
    target: str
    features: tuple[str, ...]
    stages: PipelineModel
    folded: tuple[str, ...] = ()
    width: int = MAX_WIDTH


def _wide_vectors(df: DataFrame, features: Sequence[str], width: int) -> list[str]:
    """Vectors that are wider, or that do not tell how wide they are."""
    sizes = {f.name: f.metadata.get("ml_attr", {}).get("num_attrs") for f in df.schema.fields if isinstance(f.dataType, VectorUDT)}
    return [c for c in features if c in sizes and (sizes[c] is None or sizes[c] > width)]


def _with_folded(df: DataFrame, folded: Sequence[str], width: int) -> DataFrame:
    for c in folded:
        parts, out = f"{c}__parts", f"{c}__folded"
        df = df.withColumn(parts, vector_parts(col(c)))
        vector = folded_vector(col(parts), width).alias(out, metadata=sized(width))
        df = df.select(*cols(n for n in df.columns if n != parts), vector)
    return df


def training_layout(rows: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """The rows dealt out and sorted by the hash of their key, or of all their
    columns without one; the partitions depend on the rows alone."""
    parts = min(LAYOUT_PARTS, rows.count() // LAYOUT_ROWS + 1)
    names = list(key) if key else [f.name for f in rows.schema.fields if not isinstance(f.dataType, VectorUDT)]
    order = [F.md5(key_text(names, prefixed=True))]
    if not key:
        order += [F.to_json(F.struct(col(f.name))) for f in rows.schema.fields if isinstance(f.dataType, VectorUDT)]
    return rows.withColumn("__order", F.md5(F.concat(*order))).repartition(parts, "__order").sortWithinPartitions("__order")


def train_regressor(
    train: DataFrame,
    target: str,
    trees: int = 100,
    seed: int = SEED,
    exclude: Sequence[str] = (),
    max_depth: int = 8,
    max_bins: int = 32,
    key: Sequence[str] | None = None,
    max_width: int = MAX_WIDTH,
) -> TrainedModel:
    """Fit on all numeric columns but the target, the ``key`` and ``exclude``.

    All features are considered at every split. Trees are bounded by
    ``max_depth`` (at most 30), vectors by ``max_width``. The same rows give the
    same model, however they are partitioned; without a ``key``, rows are told
    apart by their features and target.
    """
    require_columns(train, [target, *(key or ())])
    features = numeric_features(train, target, [*exclude, *(key or ())])
    folded = _wide_vectors(train, features, max_width)
    label = F.expr(f"{number(train, target)} AS __label")
    rows = drop_missing(train, [target]).select(
        *cols(features), label, *[col(k).alias(f"__key{i}") for i, k in enumerate(key or ())])
    rows = _with_folded(training_layout(rows, [f"__key{i}" for i in range(len(key or ()))]), folded, max_width)
    inputs = [f"{c}__folded" if c in folded else c for c in features]
    forest = RandomForestRegressor(
        featuresCol=_FEATURES,
        labelCol="__label",
        predictionCol="__score",
        numTrees=trees,
        maxDepth=max_depth,
        maxBins=max_bins,
        featureSubsetStrategy="all",
        seed=seed,
        maxMemoryInMB=512,
    )
    assembler = VectorAssembler(inputCols=inputs, outputCol=_FEATURES, handleInvalid="keep")
    stages = Pipeline(stages=[assembler, forest]).fit(rows.select(*cols(inputs), "__label"))
    return TrainedModel(target, tuple(features), stages, tuple(folded), max_width)


def predict(
    model: TrainedModel, test: DataFrame, out: str = "prediction", threshold: float = LABEL_THRESHOLD
) -> DataFrame:
    """Add the score as ``<out>_regression`` and the 0/1 label as ``out``."""
    kept = align_features(model.features, test)
    if len(kept) < len(model.features):
        raise ValidationError("the test table lacks training features")
    known = _with_folded(test, model.folded, model.width)
    scored = model.stages.transform(known).withColumn(f"{out}_regression", F.col("__score"))
    helpers = [f"{c}__folded" for c in model.folded]
    return binarize(scored, f"{out}_regression", out, threshold).drop(_FEATURES, "__score", *helpers)
