"""Why the forest scored a transaction as it did.

On a row's way down a tree the chance of fraud changes at every node. The change
from a node to the child that the row goes to belongs to the feature that the
node asks for. Summed over the trees' paths and divided by their number, the
changes and the chance at the roots (the base) add up to the row's probability.

The node table of a forest has at most trees * 2 ** (depth + 1) rows, whatever
the data; it is sent to all tasks as arrays, and a batch of rows goes down all
trees together, level by level.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ledgerlens.operators.model import save_model
from ledgerlens.operators.scoring import score_model
from ledgerlens.schema import MODEL_FEATURES
from ledgerlens.session import work_dir


class Forest:
    """All trees in one set of arrays; a leaf's children are itself."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree", "id"], ignore_index=True)
        start = nodes.groupby("tree")["id"].transform("size").groupby(nodes["tree"]).first()
        offset = dict(zip(start.index, np.concatenate([[0], np.cumsum(start.to_numpy())[:-1]])))
        shift, own = nodes["tree"].map(offset).to_numpy(), np.arange(len(nodes))
        self.leaf = nodes["left"].to_numpy() < 0
        self.left = np.where(self.leaf, own, nodes["left"].to_numpy() + shift)
        self.right = np.where(self.leaf, own, nodes["right"].to_numpy() + shift)
        self.feature = np.where(self.leaf, 0, nodes["feature"].to_numpy())
        self.threshold = nodes["threshold"].fillna(0.0).to_numpy()
        self.chance = nodes["chance"].to_numpy()
        self.roots = np.array(sorted(offset.values()))
        self.base = float(self.chance[self.roots].mean())

    def contributions(self, values: np.ndarray) -> np.ndarray:
        """Rows x features: what each feature adds to the base."""
        rows = np.arange(len(values))[:, None]
        at = np.repeat(self.roots[None, :], len(values), axis=0)
        out = np.zeros(values.shape)
        while not self.leaf[at].all():
            feature = self.feature[at]
            to = np.where(values[rows, feature] <= self.threshold[at], self.left[at], self.right[at])
            np.add.at(out, (np.broadcast_to(rows, at.shape), feature), self.chance[to] - self.chance[at])
            at = to
        return out / len(self.roots)


def node_table(model: RandomForestClassificationModel, spark) -> pd.DataFrame:
    """(tree, id, left, right, feature, threshold, chance) of every node, from the saved model."""
    path = work_dir(spark, "forest-nodes")
    save_model(model, path)
    stats = F.col("nodeData.impurityStats")
    rows = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"), F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"), F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.coalesce(F.try_divide(stats[1], F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)), F.lit(0.0)).alias("chance"),
    )
    return rows.toPandas()


def _reasons(top: int) -> Column:
    pairs = F.arrays_zip(F.array(*map(F.lit, MODEL_FEATURES)).alias("feature"), F.col("contributions").alias("contribution"))
    raising = F.filter(pairs, lambda p: p["contribution"] > 0)
    ordered = F.array_sort(raising, lambda a, b: F.when(a["contribution"] > b["contribution"], -1).when(a["contribution"] < b["contribution"], 1).otherwise(0))
    return F.slice(ordered, 1, top)


def explain(df: DataFrame, model: RandomForestClassificationModel, top: int = 3) -> DataFrame:
    """Model-scored transactions with base, contributions (by MODEL_FEATURES) and the ``top`` reasons that raise the score.

    A row that lacks a feature is not scored and has no contributions.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(Forest(node_table(model, spark)))

    @F.pandas_udf(ArrayType(DoubleType()))
    def contributions(values: pd.Series) -> pd.Series:
        known = values[values.notna()].to_list()
        found = iter(shared.value.contributions(np.stack(known).astype(np.float64)) if known else [])
        return pd.Series([next(found) if whole else None for whole in values.notna()], dtype=object)

    scored = score_model(df, model)
    whole = F.array(*[F.col(c).cast("double") for c in MODEL_FEATURES])
    given = F.when(~F.exists(whole, lambda v: v.isNull()), whole)
    explained = scored.withColumn("contributions", contributions(given)).withColumn("base", F.lit(shared.value.base))
    return explained.withColumn("reasons", _reasons(top))
