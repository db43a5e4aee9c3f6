"""Session settings, typed CSV, date/null frame, IND records, plan shape."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tablesift.operators import attributes as A
from tablesift.operators import ind, relational
from tablesift.sources.csv import read_typed_csv
from tablesift.sources.tables import STAR_TABLES, read_tables
from tests.conftest import SF_SMALL


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("spark.checkpoint.dir")


def test_typed_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "employees.csv")
    with open(path, "w") as f:
        f.write("Name,Age,Salary,Company\nAnn,97,10.5,Apple\nBob,30,20.0,Microsoft\n")
    df = read_typed_csv(spark, path)
    assert [t for _, t in df.dtypes] == ["string", "int", "double", "string"]
    df.createOrReplaceTempView("employee")
    assert [r.Name for r in spark.sql("SELECT * FROM employee WHERE Age > 95").collect()] == ["Ann"]
    typed = read_typed_csv(spark, path, schema="Name string, Age long, Salary double, Company string")
    assert typed.dtypes[1] == ("Age", "bigint")


def test_date_frame(spark):
    frame = spark.range(5).withColumns(
        {"day": F.current_date(), "made_at": F.current_timestamp(), "note": F.lit(None).cast("string")}
    )
    filled = relational.fill_and_flag_nulls(frame, "unset", ["day", "made_at", "note"])
    rows = filled.select(
        "id",
        F.date_add("day", 7).alias("week_later"),
        F.col("note").alias("filled_note"),
        F.col("note").isNull().alias("note_missing"),
        (F.datediff(F.date_add("day", 7), "day")).alias("days"),
    ).collect()
    assert len(rows) == 5
    assert all(r.filled_note == "unset" and r.note_missing is False and r.days == 7 for r in rows)


def test_ind_records_dedupe(spark):
    space = A.AttributeSpace.build(spark, read_tables(spark, SF_SMALL, STAR_TABLES), A.STRICT)
    inds = ind.unary_inds(space)
    recs = ind.ind_records(inds.unionByName(inds))
    assert recs.count() == 95
    r = recs.first().ind
    assert isinstance(r.dependent_columns, list) and len(r.referenced_columns) == 1


def test_scans_read_only_needed_columns(spark):
    space = A.AttributeSpace.build(spark, read_tables(spark, SF_SMALL, STAR_TABLES), A.TRIMMED)
    plan = ind.ind_check(space, [("l_orderkey", "o_orderkey")])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "customer" not in plan


def test_spread_only_small_scans(spark):
    from tablesift.plans import partitioning as P

    one = spark.range(100).coalesce(1)
    assert P.spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(P.SPREAD_MAX_INPUT_PARTITIONS + 1)
    assert P.spread(many) is many


def test_materialize_uses_session_checkpoint_dir(spark):
    from tablesift.plans import partitioning as P

    assert P.shared_checkpoint_dir(spark) is not None  # set by the test session
    df = P.materialize(spark.range(5))
    assert df.count() == 5
    assert "LogicalRDD" in df._jdf.queryExecution().optimizedPlan().toString()


def test_scale_conf():
    from tablesift.session import scale_conf

    conf = scale_conf(100 * 1024**4, cores=8000)
    # not 409,600 reducers of 256 MB: neither side of a shuffle has more than 65,536 tasks
    assert int(conf["spark.sql.shuffle.partitions"]) == 65_536
    assert int(conf["spark.sql.files.maxPartitionBytes"]) * 65_536 >= 100 * 1024**4
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == conf["spark.sql.files.maxPartitionBytes"]
    assert scale_conf(100 * 1024**4, cores=40_000)["spark.sql.shuffle.partitions"] == "80000"
    one_tb = scale_conf(1024**4, cores=800)
    assert one_tb["spark.sql.shuffle.partitions"] == "4096" and one_tb["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)
    assert scale_conf(10 * 1024**2, cores=8)["spark.sql.shuffle.partitions"] == "16"
