"""Boosted trees with a share of the columns and rows per tree, and errors along the path.

Spark's own booster samples columns anew at every node and keeps rows by chance. Here each
tree sees one subset of the columns, chosen by the seed and its round, and the rows whose key
hashes into the round's share, so a lost executor computes the same again.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from math import ceil, sqrt

from pyspark.ml import Estimator
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasCheckpointInterval,
    HasFeaturesCol,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasSeed,
    HasStepSize,
)
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column, require
from tidegauge.session import checkpointed

#: Hashes are compared with a share of this many cells.
CELLS = 1 << 30


class ShareBoostedTrees(
    Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize, HasSeed, HasCheckpointInterval
):
    """Squared-error boosting from the mean: every round adds ``stepSize`` times a tree.

    ``columnShare`` of the columns (rounded up, at least one) and ``rowShare`` of the rows, by
    the hash of ``keyCol``, make a tree. A round costs one tree over the rows; the running
    prediction is checkpointed every ``checkpointInterval`` rounds, so plans stay short. The
    fitted model is Spark's own ``GBTRegressionModel`` (a tree without splits holds the mean),
    so it scores in the JVM and is stored and loaded like one. Rows without a label are left
    out; a table without any label is an error. Features must be finite: impute first.
    """

    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "candidate splits of a column plus one", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows in a leaf", TypeConverters.toInt)
    columnShare = Param(Params._dummy(), "columnShare", "share of the columns that a tree sees", TypeConverters.toFloat)
    rowShare = Param(Params._dummy(), "rowShare", "share of the rows that a tree sees", TypeConverters.toFloat)
    keyCol = Param(Params._dummy(), "keyCol", "column that decides which rows a tree sees", TypeConverters.toString)

    def __init__(self, **settings):
        super().__init__()
        self._setDefault(
            maxIter=200, maxDepth=6, maxBins=32, stepSize=0.1, columnShare=0.8, rowShare=0.8, minInstancesPerNode=1,
            seed=42, checkpointInterval=10, featuresCol="features", labelCol="label", predictionCol="prediction",
        )
        self._set(**settings)

    def columns_of(self, turn: int, width: int) -> list[int]:
        """Columns that the tree of round ``turn`` sees."""
        take = max(1, min(width, ceil(self.getOrDefault("columnShare") * width - 1e-9)))
        return sorted(random.Random(self.getSeed() * 1_000_003 + turn).sample(range(width), take))

    def _rows_of(self, df: DataFrame, turn: int) -> DataFrame:
        share = self.getOrDefault("rowShare")
        if share >= 1:
            return df
        return df.filter(F.pmod(F.xxhash64("_key", F.lit(self.getSeed() + turn)), F.lit(CELLS)) < int(share * CELLS))

    def _tree(self, features: str, depth: int) -> DecisionTreeRegressor:
        return DecisionTreeRegressor(
            featuresCol=features, labelCol="_rest", predictionCol="_step", maxDepth=depth, seed=self.getSeed(),
            maxBins=self.getOrDefault("maxBins"), minInstancesPerNode=self.getOrDefault("minInstancesPerNode"),
        )

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        sampled = self.getOrDefault("rowShare") < 1
        if sampled and not self.isDefined("keyCol"):
            raise ValueError("set keyCol: it decides which rows a tree sees")
        label, features = column(self.getLabelCol()).cast("double"), column(self.getFeaturesCol())
        key = column(self.getOrDefault("keyCol")) if sampled else F.lit(None).cast("long")
        require(dataset, [self.getLabelCol(), self.getFeaturesCol()])
        known = dataset.select(features.alias("_x"), label.alias("_y"), key.alias("_key")).filter("_y is not null")
        held = checkpointed(known.withColumn("_sum", F.lit(0.0)))
        first = held.select("_x").first()
        if first is None:
            raise ValueError("no row has a label")
        width, step = len(first["_x"]), self.getStepSize()
        trees, weights = [], []
        for turn in range(self.getMaxIter() + 1):
            rest = held.withColumn("_rest", F.col("_y") - F.col("_sum"))
            if turn == 0:
                tree, weight, mask = self._tree("_x", 0).fit(rest), 1.0, None
            else:
                # Columns that the tree does not see are constant, so it cannot split on them,
                # and keeps the numbers of the others.
                chosen = set(self.columns_of(turn, width))
                mask = ElementwiseProduct(
                    scalingVec=Vectors.dense([float(i in chosen) for i in range(width)]), inputCol="_x", outputCol="_seen"
                )
                part = self._rows_of(rest, turn)
                if sampled and part.isEmpty():
                    continue
                tree, weight = self._tree("_seen", self.getOrDefault("maxDepth")).fit(mask.transform(part)), step
            trees.append(tree)
            weights.append(weight)
            scored = tree.copy({tree.featuresCol: "_x"}).transform(held)
            held = scored.select("_x", "_y", "_key", (F.col("_sum") + weight * F.col("_step")).alias("_sum"))
            if turn % self.getCheckpointInterval() == 0 and turn < self.getMaxIter():
                held = checkpointed(held)
        return self._joined(dataset, trees, weights)

    def _joined(self, dataset: DataFrame, trees: list, weights: list[float]) -> GBTRegressionModel:
        """The trees as one model of Spark's."""
        context = dataset.sparkSession.sparkContext
        kind = context._jvm.org.apache.spark.ml.regression
        many = context._gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
        factors = context._gateway.new_array(context._jvm.double, len(trees))
        for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
            many[i], factors[i] = tree._java_obj, weight
        model = GBTRegressionModel(kind.GBTRegressionModel(f"{self.uid}_model", many, factors))
        model._set(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol())
        model._transfer_params_to_java()
        return model


def path_rmse(model: GBTRegressionModel, df: DataFrame, lengths: Sequence[int], lead: int = 0) -> dict[int, float]:
    """RMSE of the model's first ``n`` trees for each n of ``lengths``, from one scoring of ``df``.

    ``lead``: trees before the first round (one, the mean, in models of ``ShareBoostedTrees``).
    Where a model has fewer rounds than asked for, its last error counts.
    """
    squares = model.evaluateEachIteration(df, "squared")
    return {n: sqrt(squares[min(n + lead, len(squares)) - 1]) for n in lengths}
