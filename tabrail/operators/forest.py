"""Random-forest regression and scoring (M1-M6) on Spark ML.

Training is Spark's distributed histogram algorithm: executors aggregate
bin statistics per node and only split choices reach the driver. The input
is given a fixed partitioning and order before the fit, because the forest
(bagging, split-candidate sampling) depends on partition contents.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrail.config import FOREST_DEPTH, FOREST_PARTITIONS, FOREST_STATS_MB, FOREST_TREES, SEED


def forest_estimator(
    features: Sequence[str],
    label: str = "target",
    num_trees: int = FOREST_TREES,
    max_depth: int = FOREST_DEPTH,
    seed: int = SEED,
    handle_invalid: str = "error",
    **params,
) -> Pipeline:
    """M1: assembler + forest. Defaults as the reference: 100 trees, depth
    10, seed 42, variance impurity, 32 bins, bootstrap, subset 'auto'.
    ``handle_invalid='error'`` makes a null or NaN feature fail, as there."""
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid=handle_invalid
    )
    params.setdefault("maxMemoryInMB", FOREST_STATS_MB)
    # No node-id cache: it keeps a number a row and tree twice over, and writes
    # them to the checkpoint folder, so that its size goes with rows x trees.
    # Rows find their nodes by walking the trees; the model is the same.
    params.setdefault("cacheNodeIds", False)
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        **params,
    )
    return Pipeline(stages=[assembler, forest])


def stump_estimator(features: Sequence[str], label: str = "target", max_bins: int = 64, seed: int = SEED) -> Pipeline:
    """M2: the forest call restricted to 1 tree, depth 1, no bootstrap, all
    features, and ``maxBins`` above the distinct count of every feature, so
    the split is the exact best one over all distinct-value midpoints."""
    return forest_estimator(
        features, label, num_trees=1, max_depth=1, seed=seed,
        bootstrap=False, featureSubsetStrategy="all", maxBins=max_bins,
    )


def stable_input(df: DataFrame, key: Sequence[str], partitions: int = FOREST_PARTITIONS) -> DataFrame:
    """Fix partition contents and order so that a fit repeats exactly,
    whatever the session's shuffle partitions are."""
    if not key:
        return df
    return df.repartition(partitions, *key).sortWithinPartitions(*key)


def fit_columns(estimator: Pipeline, df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """The columns that the estimator and the fixed order (``key``) read; all
    of them where a stage is not known here."""
    if not all(isinstance(s, (VectorAssembler, RandomForestRegressor)) for s in estimator.getStages()):
        return df
    used = set(key)
    for s in estimator.getStages():
        for p in ("inputCols", "labelCol", "weightCol"):
            if s.hasParam(p) and s.isDefined(p):
                v = s.getOrDefault(p)
                used |= {v} if isinstance(v, str) else set(v)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in used])


def fit(estimator: Pipeline, train: DataFrame, key: Sequence[str] = ()) -> PipelineModel:
    """Fit on a fixed-order copy of ``train``, of the columns it needs; the
    copy is cached for the many passes of the tree builder and released
    afterwards."""
    data = stable_input(fit_columns(estimator, train, key), key)
    # The key has given the order; only what the stages read is kept.
    data = fit_columns(estimator, data).persist()
    try:
        return estimator.fit(data)
    finally:
        data.unpersist()


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """M3: add ``prediction``. The assembler and trees run as expressions in
    the same stage as the scan: no shuffle."""
    out = model.transform(df)
    cols = list(keep) if keep is not None else [c for c in df.columns]
    return out.select(*cols, "prediction")


def predict_frame(model: PipelineModel, df: DataFrame, id_col: str) -> DataFrame:
    """M4 at scale: (request id, prediction) for a frame of feature rows."""
    return score(model, df, keep=[id_col])


def predict_batch(spark, model: PipelineModel, rows: Sequence[dict], features: Sequence[str]) -> list[float]:
    """M4 at the API edge: list of feature dicts -> predictions in the same
    order; the single-row call is the one-row case. Values are cast to
    double as the reference does (a missing key raises KeyError)."""
    from tabrail.sources.tables import rows_to_frame

    frame = rows_to_frame(spark, rows, features, with_index=True)
    out = predict_frame(model, frame, "_tr_idx").orderBy("_tr_idx")
    return [float(r.prediction) for r in out.collect()]


def predict_one(spark, model: PipelineModel, features: Sequence[str], **values) -> float:
    return predict_batch(spark, model, [values], features)[0]


_SPLIT = re.compile(r"If \(feature (\d+) <= ([^)]+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


def stump_summary(model: PipelineModel) -> dict:
    """The single split of an M2 model: feature, threshold and both leaf
    means, read from the model's printed tree (a driver-side object)."""
    assembler, forest = model.stages[0], model.stages[-1]
    text = forest.trees[0].toDebugString
    split = _SPLIT.search(text)
    leaves = _LEAF.findall(text)
    names = assembler.getInputCols()
    if not split:
        return {"feature": None, "threshold": None, "left": float(leaves[0]), "right": None}
    return {
        "feature": names[int(split.group(1))],
        "threshold": float(split.group(2)),
        "left": float(leaves[0]),
        "right": float(leaves[1]),
    }


def evaluate(
    estimator: Pipeline,
    data: DataFrame,
    key: Sequence[str],
    label: str = "target",
    train_fraction: float = 0.8,
    seed: int = SEED,
):
    """M6: split, fit on train, score test, report. Returns (model,
    predictions on test, report frame)."""
    from tabrail.operators.metrics import regression_report
    from tabrail.operators.split import bernoulli_split

    parts = bernoulli_split(data, key, train_fraction, seed)
    train = parts.where(F.col("part") == "train").drop("part")
    test = parts.where(F.col("part") == "test").drop("part")
    model = fit(estimator, train, key)
    predictions = score(model, test)
    return model, predictions, regression_report(predictions, label, "prediction")
