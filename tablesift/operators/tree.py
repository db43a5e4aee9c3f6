"""Decision-tree classification pipeline (Spark ML).

Categorical features (at most ``max_categories`` distinct values) are
indexed by ``VectorIndexer``, fitted on all data; a ``DecisionTreeClassifier``
is trained on a seeded split by the digest of the ids.  The fitted tree can be
written as rows and compiled to one CASE expression.  Training, prediction and evaluation
are Spark ML's distributed jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TreeConfig:
    max_categories: int = 4
    train_fraction: float = 0.7
    seed: int = 42
    max_depth: int = 5


def labelled_vectors(df: DataFrame, id_col: str, array_col: str, label_col: str) -> DataFrame:
    """``(id, label double, features vector)`` from an array column."""
    return df.select(
        F.col(id_col).alias("id"),
        F.col(label_col).cast("double").alias("label"),
        array_to_vector(F.col(array_col)).alias("features"),
    )


# hexadecimal digits of a row's digest that name its bucket: 65,536 buckets at any size
BUCKET_DIGITS = 4


def split(df: DataFrame, id_col: str, cfg: TreeConfig = TreeConfig()) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the digest of the id: the first ``floor(train_fraction * rows)`` in its order are train.

    The part of a row depends on the ids only, not on how the rows are
    partitioned.  Rows are ranked inside the bucket of their digest's first
    digits, and the counts of the buckets before it make that a rank in the
    whole table, so nothing is sorted in one task but the bucket counts.
    Rows that repeat an id are told apart by a hash of all columns; null ids
    count as empty text."""
    digest = F.md5(F.concat(F.lit(f"{cfg.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(row.alias("row"), digest.alias("digest"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("tie"))
    rows = rows.withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("bucket")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy())
    counts = counts.select("bucket", before.alias("before"), F.floor(F.lit(cfg.train_fraction) * total).alias("n_train"))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("digest", "tie"))
    ranked = rows.withColumn("rank", rank).join(counts, "bucket")
    is_train = F.col("before") + F.col("rank") <= F.col("n_train")
    return ranked.where(is_train).select("row.*"), ranked.where(~is_train).select("row.*")


def fit(data: DataFrame, train: DataFrame, cfg: TreeConfig = TreeConfig()) -> PipelineModel:
    indexer = VectorIndexer(
        inputCol="features", outputCol="indexedFeatures", maxCategories=cfg.max_categories
    ).fit(data)
    tree = DecisionTreeClassifier(
        labelCol="label", featuresCol="indexedFeatures", maxDepth=cfg.max_depth, seed=cfg.seed
    )
    return Pipeline(stages=[indexer, tree]).fit(train)


def tree_text(model: PipelineModel) -> str:
    """The learned tree as text."""
    return model.stages[-1].toDebugString


def tree_rules(model: PipelineModel) -> list[dict]:
    """The fitted tree as rows, root first: node, feature, threshold or values (what goes left), left, right, prediction.

    Inner nodes have a feature and a test on its raw value, leaves a
    prediction.  The rows are bounded by the tree's depth."""
    indexer, tree = model.stages
    raw_of = {int(f): {int(i): float(v) for v, i in m.items()} for f, m in indexer.categoryMaps.items()}
    rows: list[dict] = []

    def visit(node) -> int:
        row = {"node": len(rows), "feature": None, "threshold": None, "values": None, "left": None, "right": None, "prediction": None}
        rows.append(row)
        if node.getClass().getSimpleName() == "LeafNode":
            row["prediction"] = float(node.prediction())
            return row["node"]
        test = node.split()
        row["feature"] = int(test.featureIndex())
        if test.getClass().getSimpleName() == "ContinuousSplit":
            row["threshold"] = float(test.threshold())
        else:
            row["values"] = sorted(raw_of[row["feature"]][int(i)] for i in test.leftCategories())
        row["left"], row["right"] = visit(node.leftChild()), visit(node.rightChild())
        return row["node"]

    visit(tree._java_obj.rootNode())
    return rows


def compiled(rules: list[dict], features: Column) -> Column:
    """The rows of ``tree_rules`` as one CASE expression over an array of raw features."""

    def at(i: int) -> Column:
        r = rules[i]
        if r["feature"] is None:
            return F.lit(r["prediction"])
        value = F.get(features, F.lit(r["feature"])).cast("double")
        left = value <= F.lit(r["threshold"]) if r["threshold"] is not None else value.isin(r["values"])
        return F.when(left, at(r["left"])).otherwise(at(r["right"]))

    return at(0)


def accuracy(predictions: DataFrame) -> float:
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName="accuracy"
    ).evaluate(predictions)


def metrics_frame(model: PipelineModel, train: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: train/test sizes, accuracy, test error, tree shape.  The
    accuracy is ``avg(prediction = label)``, the evaluator's definition, as
    one aggregate."""
    tree = model.stages[-1]
    n_train = train.count()
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return predictions.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg(hit).alias("accuracy"),
        (F.lit(1.0) - F.avg(hit)).alias("test_error"),
    ).select(
        F.lit(n_train).cast("long").alias("n_train"),
        F.col("n_test").cast("long"),
        "accuracy",
        "test_error",
        F.lit(tree.depth).alias("depth"),
        F.lit(tree.numNodes).alias("num_nodes"),
    )
