"""Decision-tree pipeline and the LIBSVM reader."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tablesift.operators import tree
from tablesift.sources.formats import JdbcOptions, read_libsvm
from tests.conftest import SF_SMALL


def ids(rows):
    return sorted(r.vec_id for r in rows.select("vec_id").collect())


def test_split_is_exact_and_independent_of_the_layout(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    train, test = tree.split(e, "vec_id")
    a, b = ids(train), ids(test)
    assert sorted(a + b) == ids(e) and len(a) == int(0.7 * len(a + b))
    for layout in (e.repartition(7), e.orderBy(F.col("vec_id").desc()).coalesce(1)):
        again, rest = tree.split(layout, "vec_id")
        assert (ids(again), ids(rest)) == (a, b)
    other, _ = tree.split(e, "vec_id", tree.TreeConfig(seed=7))
    assert ids(other) != a


def test_split_edges(spark):
    schema = "vec_id int, rank int, `a.b` string"
    empty = spark.createDataFrame([], schema)
    assert [p.count() for p in tree.split(empty, "vec_id")] == [0, 0]
    same = spark.createDataFrame([(1, 2, "x")] * 10 + [(None, 2, "x")] * 10, schema).repartition(3)
    train, test = tree.split(same, "vec_id")
    assert (train.count(), test.count()) == (14, 6) and train.columns == ["vec_id", "rank", "a.b"]


def test_pipeline_fit_predict_metrics(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    data = tree.labelled_vectors(e, "vec_id", "embedding", "label")
    train, test = tree.split(data, "id")
    model = tree.fit(data, train)
    text = tree.tree_text(model)
    assert "DecisionTreeClassificationModel" in text and "If (feature" in text
    preds = model.transform(test)
    assert {"prediction", "indexedFeatures"} <= set(preds.columns)
    m = tree.metrics_frame(model, train, preds).collect()[0]
    assert abs(m.accuracy - tree.accuracy(preds)) < 1e-12
    assert abs(m.accuracy + m.test_error - 1.0) < 1e-12
    assert m.n_test == test.count() and m.n_train == train.count()


def test_compiled_tree_equals_transform(spark):
    """Continuous and categorical splits; the raw values of the categories are not their indexes."""
    rows = [(i, float((i * 7 % 11) + (3 if i % 4 == 1 else 0) > 6), [float([10, 20, 55][i % 3]), i * 0.37 % 5, float(i % 4 - 2)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id int, label double, embedding array<double>")
    data = tree.labelled_vectors(df, "vec_id", "embedding", "label")
    model = tree.fit(data, data)
    rules = tree.tree_rules(model)
    assert any(r["values"] for r in rules) and any(r["threshold"] is not None for r in rules)
    assert len(rules) == model.stages[-1].numNodes
    want = {r.id: r.prediction for r in model.transform(data).collect()}
    got = df.select("vec_id", tree.compiled(rules, F.col("embedding")).alias("p")).collect()
    assert {r.vec_id: r.p for r in got} == want and len(set(want.values())) == 2


def test_libsvm_reader(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sample.txt")
    with open(path, "w") as f:
        f.write("1 1:0.5 3:1.0\n0 2:2.0\n1 1:1.5 2:0.1 3:3.0\n")
    df = read_libsvm(spark, path)
    assert df.columns == ["label", "features"]
    rows = df.collect()
    assert [r.label for r in rows] == [1.0, 0.0, 1.0] and rows[0].features.size == 3


def test_jdbc_options():
    opts = JdbcOptions(
        "jdbc:postgresql://db/x", "t", user="u", password="p", partition_column="id",
        lower_bound=0, upper_bound=100, num_partitions=4, fetch_size=1000,
    ).to_options()
    assert opts["dbtable"] == "t" and opts["numPartitions"] == "4" and opts["fetchsize"] == "1000"
    try:
        JdbcOptions("jdbc:x", "t", partition_column="id").to_options()
    except ValueError:
        pass
    else:
        raise AssertionError("missing bounds must be refused")
