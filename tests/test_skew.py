"""Hot keys: one value in a third of all rows, one substring in every text.
Results must not change when AQE is pushed to split skewed partitions."""

from __future__ import annotations

import contextlib
import random

from pyspark.sql import functions as F

from tablesift.operators import attributes as A
from tablesift.operators import ind
from tablesift.operators.lcs import best_common_substrings
from tablesift.operators.relational import group_top

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_table(spark, n=6000):
    # A third of all rows hold the value 0 in every column.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"),
        F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") % 50) * 3 + 1).alias("b"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 2).alias("c"),
    )


def test_hot_value_inds(spark):
    df = skewed_table(spark)
    space = A.AttributeSpace.build(spark, {"t": df}, A.TRIMMED)
    plain = {tuple(r) for r in ind.unary_inds(space).collect()}
    with conf(spark, SKEW_CONF):
        skewed = {tuple(r) for r in ind.unary_inds(space).collect()}
    assert plain == skewed == {("b", "a")}
    prof = {r.attribute: r.n_distinct for r in A.attribute_profile(space).collect()}
    assert prof["b"] == 51


def test_hot_group_top(spark):
    df = skewed_table(spark).withColumn("g", F.when(F.col("a") == 0, "hot").otherwise("cold"))
    with conf(spark, SKEW_CONF):
        top = {r.g: r.c for r in group_top(df, "g", "c", ["a"], "a").collect()}
    assert top == {"hot": 0, "cold": 11998}


def test_hot_substring_lcs(spark):
    rng = random.Random(9)
    rows = [(i, "common_" + "".join(rng.choice("xyzw") for _ in range(6))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string")
    plain = {r.id: r.substring for r in best_common_substrings(df, "id", "text", method="index").collect()}
    with conf(spark, SKEW_CONF):
        skewed = {r.id: r.substring for r in best_common_substrings(df, "id", "text", method="index").collect()}
    assert plain == skewed
    assert all(v.startswith("common_") or len(v) >= 7 for v in plain.values())
